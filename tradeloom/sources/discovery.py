"""Find raw tables by name and read brand and store out of the name."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.config import Config


@dataclass(frozen=True)
class RawSource:
    """A raw table: full three-part name plus where its rows come from.

    Exactly one of ``path`` (Parquet folder), ``table`` (catalog name) and
    ``frame`` is set.
    """

    name: str
    path: str | None = None
    table: str | None = None
    frame: DataFrame | None = None

    def brand_store(self, cfg: Config) -> tuple[str, str]:
        parts = self.name.split(".")[2].split("_")
        brand = parts[cfg.brand_position] if cfg.brand_from_name else cfg.default_brand
        store = parts[cfg.store_position] if cfg.store_from_name else cfg.default_store
        return brand, store


def matches(name: str, like: str) -> bool:
    """LIKE on one name, in any case: ``%`` any characters, ``_`` one."""
    pattern = "".join({"%": ".*", "_": "."}.get(c, re.escape(c)) for c in like.lower())
    return re.fullmatch(pattern, name.lower(), re.S) is not None


def discover_names(names: DataFrame, like: str, column: str = "name") -> DataFrame:
    """Full names whose table part matches a LIKE pattern, both in lower case."""
    table = F.lower(F.element_at(F.split(F.col(column), r"\."), 3))
    return names.where(table.like(like.lower())).select(
        F.col(column).alias("tables"), F.lower(F.col(column)).alias("tables_lowercase")
    )


def discover_tables(spark: SparkSession, like: str, schema: str | None = None) -> list[RawSource]:
    """Catalog tables matching ``like``; the catalog decides the name's case."""
    schema = schema or spark.catalog.currentDatabase()
    catalog = spark.catalog.currentCatalog()
    return [
        RawSource(f"{catalog}.{schema}.{t.name}", table=f"{catalog}.{schema}.{t.name}")
        for t in sorted(spark.catalog.listTables(schema), key=lambda t: t.name)
        if not t.isTemporary and matches(t.name, like)
    ]


def discover_paths(
    spark: SparkSession, root: str, like: str, prefix: str = "raw.landing"
) -> list[RawSource]:
    """Parquet folders ``root/<Brand>_<Store>_..._<Report>`` matching ``like``."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listing = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    hits = sorted(n for n in listing if matches(n, like))
    return [RawSource(f"{prefix}.{n}", path=f"{root.rstrip('/')}/{n}") for n in hits]


def tag_columns(name: Column | str, cfg: Config) -> tuple[Column, Column]:
    """Brand and store as expressions over a column of full table names."""
    name = F.col(name) if isinstance(name, str) else name
    parts = F.split(F.element_at(F.split(name, r"\."), 3), "_")
    brand = parts[cfg.brand_position] if cfg.brand_from_name else F.lit(cfg.default_brand)
    store = parts[cfg.store_position] if cfg.store_from_name else F.lit(cfg.default_store)
    return brand, store
