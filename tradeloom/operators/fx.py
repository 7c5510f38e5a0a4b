"""Exchange-rate enrichment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.session import stage

RATE = "exchange_currency_rate"
CODE = "exchange_currency_code"


@dataclass(frozen=True)
class Rates:
    """Rates ``(date, from_currency_code, to_currency_code, value)``, written and measured once."""

    frame: DataFrame

    @classmethod
    def measure(cls, frame: DataFrame, from_currency: str | None = None) -> Rates:
        """Refuse a key that would multiply fact rows.

        ``from_currency`` chooses one where rates from several are given. The
        written table has its real size, by which the planner decides whether
        the fact rows must move; of a computed one it would only have a guess.
        """
        frame = frame.select("date", "from_currency_code", "to_currency_code", "value")
        if from_currency is not None:
            frame = frame.where(F.col("from_currency_code") == from_currency)
        frame = stage(frame, "rates")
        repeated = (
            frame.where("date is not null and to_currency_code is not null")
            .groupBy("date", "to_currency_code")
            .agg(F.count(F.lit(1)).alias("n"))
            .where("n > 1")
            .first()
        )
        if repeated is not None:
            raise ValueError(
                f"several exchange rates for one date and target currency: {repeated['date']},"
                f" {repeated['to_currency_code']}; name a from_currency"
            )
        return cls(frame)


def with_exchange_rate(
    df: DataFrame,
    rates: Rates | None,
    date: Column | str,
    currency: str,
    enabled: bool = True,
) -> DataFrame:
    """Add rate and code; rows without a rate get 1 and their own currency.

    The planner broadcasts rates below its size threshold, so the fact rows do
    not move. Larger ones are joined by shuffle, where adaptive execution splits
    a hot date.
    """
    if not enabled:
        return df.withColumns(
            {RATE: F.lit(1).cast("decimal(38,9)"), CODE: F.col(currency)}
        )
    if rates is None:
        raise ValueError("currency conversion needs a rates table")
    date = F.col(date) if isinstance(date, str) else date
    side = rates.frame.select(
        F.col("date").alias("_fx_day"),
        F.col("to_currency_code").alias("_fx_to"),
        F.col("from_currency_code").alias("_fx_from"),
        F.col("value").cast("decimal(38,9)").alias("_fx_value"),
    )
    joined = df.join(
        side, (date == F.col("_fx_day")) & (F.col(currency) == F.col("_fx_to")), "left"
    )
    return joined.withColumns(
        {
            RATE: F.coalesce("_fx_value", F.lit(1).cast("decimal(38,9)")),
            CODE: F.coalesce("_fx_from", currency),
        }
    ).drop("_fx_day", "_fx_to", "_fx_from", "_fx_value")
