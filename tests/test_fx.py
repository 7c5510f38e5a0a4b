import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import Rates, with_exchange_rate

DAY = datetime.date(2024, 1, 1)


@pytest.fixture
def rates(spark):
    return spark.createDataFrame(
        [(DAY, "EUR", "USD", Decimal("1.5")), (None, "EUR", "CAD", Decimal("2"))],
        "date date, from_currency_code string, to_currency_code string, value decimal(38,9)",
    )


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [(1, DAY, "USD"), (2, DAY, "INR"), (3, DAY, None), (4, None, "USD"), (5, None, "CAD")],
        "id int, day date, ccy string",
    )


@pytest.mark.parametrize("hint", ["broadcast", "merge"])
def test_rate_and_fallback(facts, rates, rows, hint):
    out = with_exchange_rate(facts, Rates.measure(rates.hint(hint)), "day", "ccy")
    assert rows(out.select("id", F.col("exchange_currency_rate").cast("double"), "exchange_currency_code")) == [
        (1, 1.5, "EUR"), (2, 1.0, "INR"), (3, 1.0, None), (4, 1.0, "USD"), (5, 1.0, "CAD"),
    ]
    assert dict(out.dtypes)["exchange_currency_rate"] == "decimal(38,9)"


def test_the_planner_chooses_the_join(facts, rates):
    joined = with_exchange_rate(facts, Rates.measure(rates), "day", "ccy")
    assert "hint" not in joined._jdf.queryExecution().analyzed().toString().lower()


def test_disabled_needs_no_rates(facts, rows):
    out = with_exchange_rate(facts, None, "day", "ccy", enabled=False)
    assert rows(out, "id", "exchange_currency_code")[:3] == [(1, "USD"), (2, "INR"), (3, None)]
    with pytest.raises(ValueError):
        with_exchange_rate(facts, None, "day", "ccy")


def test_several_rates_for_one_key_are_refused(rates):
    with pytest.raises(ValueError, match="several exchange rates.*2024-01-01, USD"):
        Rates.measure(rates.unionByName(rates))
    other = rates.withColumn("from_currency_code", F.lit("CHF"))
    assert Rates.measure(rates.unionByName(other), from_currency="CHF").frame.count() == 2


def test_facts_stay_where_computed_rates_are_few(spark, facts):
    spark.range(200_000).createOrReplaceTempView("numbers")
    try:
        rates = spark.sql(
            "SELECT date_add(DATE'2024-01-01', CAST(id % 9 AS INT)) AS date, 'EUR' AS from_currency_code, ccy AS to_currency_code,"
            " CAST(2 AS DECIMAL(38, 9)) AS value FROM numbers CROSS JOIN VALUES ('USD'), ('CAD') AS c(ccy)"
            " WHERE repeat(CAST(id AS STRING), 9) <> '' GROUP BY ALL"
        )
        joined = with_exchange_rate(facts, Rates.measure(rates), "day", "ccy")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert joined.where("id = 1").first()["exchange_currency_rate"] == 2
    finally:
        spark.catalog.dropTempView("numbers")
