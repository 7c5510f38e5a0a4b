"""The look-back watermark on batch time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import BATCH_RUNTIME, LOOKBACK_MS


def watermark(target: DataFrame, lookback_ms: int = LOOKBACK_MS) -> DataFrame:
    """One row: newest loaded batch minus the look-back, 0 for no batch."""
    return target.agg(
        F.coalesce(F.max(BATCH_RUNTIME) - F.lit(lookback_ms), F.lit(0)).alias("max_loaded")
    )


def max_loaded(target: DataFrame | None, lookback_ms: int = LOOKBACK_MS) -> int:
    return 0 if target is None else watermark(target, lookback_ms).first()["max_loaded"]


def footer_watermark(
    spark: SparkSession, path: str | Sequence[str], lookback_ms: int = LOOKBACK_MS
) -> DataFrame:
    """``watermark`` of the Parquet files below ``path``, one folder or several, from the statistics in its footers.

    The maximum is pushed into the scan, which reads no column. The settings
    this needs hold in a session of their own. All files must have one layout,
    as those of a staged table do. A file whose batch times are all NULL has no
    such statistics and is an error, as is a table without files; ``loaded_at``
    reads the column then.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    newest = footers.read.parquet(*_listed(path)).agg(F.max(BATCH_RUNTIME).alias("newest"))
    return newest.select(F.coalesce(F.col("newest") - F.lit(lookback_ms), F.lit(0)).alias("max_loaded"))


def _listed(path: str | Sequence[str]) -> Sequence[str]:
    return [path] if isinstance(path, str) else path


def loaded_at(spark: SparkSession, path: str | Sequence[str], lookback_ms: int = LOOKBACK_MS) -> int:
    """The watermark of the Parquet files below ``path``, from its footers where they have it."""
    try:
        return footer_watermark(spark, path, lookback_ms).first()["max_loaded"]
    except Exception as error:
        if not any(reason in str(error) for reason in ("No min/max found", "UNABLE_TO_INFER_SCHEMA")):
            raise
        return max_loaded(spark.read.schema(f"{BATCH_RUNTIME} bigint").parquet(*_listed(path)), lookback_ms)


def since(df: DataFrame, loaded: int | None) -> DataFrame:
    """Rows of the look-back window; ``None`` (first run) keeps all rows."""
    return df if loaded is None else df.where(F.col(BATCH_RUNTIME) >= F.lit(loaded))
