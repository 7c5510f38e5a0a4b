"""Un-nesting of arrays and JSON, and star-except."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, path: str) -> DataFrame:
    """One row per element of an array, a row with NULL for none.

    ``"A"`` un-nests column ``A`` in place. ``"A.B"`` reads array ``B`` inside
    the already un-nested ``A`` and adds column ``B``. Un-nesting two arrays of
    one parent gives their product per parent row.
    """
    return df.withColumn(path.rsplit(".", 1)[-1], F.explode_outer(F.col(path)))


def unnest_json(df: DataFrame, column: str, outer: bool = False) -> DataFrame:
    """Rows of a JSON-array text column as ``pos`` and VARIANT ``value``.

    The default drops rows whose array is empty or missing.
    """
    tvf = df.sparkSession.tvf
    explode = tvf.variant_explode_outer if outer else tvf.variant_explode
    parsed = F.parse_json(F.col(column))
    return df.lateralJoin(explode(parsed.outer())).drop("key")


def star_except(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
