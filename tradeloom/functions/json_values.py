"""JSON text and VARIANT helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeloom.functions.columns import LEAF_TYPES


def parse_json_text(col: Column | str, safe: bool = False) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(col) if safe else F.parse_json(col)


def json_field(variant: Column | str, path: str, dtype: str = "string") -> Column:
    """Typed value at a dotted path of a VARIANT; absent paths give NULL."""
    variant = F.col(variant) if isinstance(variant, str) else variant
    return F.variant_get(variant, f"$.{path}", LEAF_TYPES.get(dtype, dtype))
