"""Scan raw tables, bring them to one schema and put them together."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.config import BATCH_RUNTIME, LAST_UPDATED, LINEAGE, RUN_ID, Config
from tradeloom.functions.columns import as_utc
from tradeloom.sources.discovery import RawSource

SOURCE_NO = "_source_no"
OFFSET = "_offset_hours"
_FOLDER = "_folder"
_SCHEMA_READERS = 16


def normalize_lineage(df: DataFrame, prefix: str) -> DataFrame:
    """Rename a connector's lineage columns, with or without leading ``_``.

    ``prefix`` is the connector's own word: with ``"conn"`` both
    ``conn_batch_id`` and ``_conn_batch_id`` become ``_batch_id``.
    """
    return df.withColumnsRenamed(_lineage_names(df.columns, prefix))


def _lineage_names(columns: Sequence[str], prefix: str) -> dict[str, str]:
    present = {c.lower(): c for c in columns} if prefix else {}
    renames = {}
    for name in LINEAGE:
        for spelling in (f"_{prefix}{name}", f"{prefix}{name}"):
            if spelling.lower() in present:
                renames[present[spelling.lower()]] = name
    return renames


def stamp(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns({LAST_UPDATED: F.current_timestamp(), RUN_ID: F.lit(run_id)})


def clip(actual: T.DataType, wanted: T.DataType) -> T.DataType:
    """The stored type cut down to the nested fields of ``wanted``."""
    if isinstance(wanted, T.StructType) and isinstance(actual, T.StructType):
        have = {f.name.lower(): f for f in actual.fields}
        fields = []
        for field in wanted.fields:
            if field.name.lower() not in have:
                raise ValueError(f"raw table has no field {field.name}")
            stored = have[field.name.lower()]
            fields.append(T.StructField(stored.name, clip(stored.dataType, field.dataType)))
        return T.StructType(fields)
    if isinstance(wanted, T.ArrayType) and isinstance(actual, T.ArrayType):
        return T.ArrayType(clip(actual.elementType, wanted.elementType))
    return actual


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in its order and spelling.

    Timestamps become UTC wall clock, JSON text and semi-structured VARIANT
    values are decoded to the nested type, every other type passes through. A missing column is an error.
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for field in schema.fields:
        stored = have.get(field.name.lower())
        actual = stored.dataType if stored else None
        if isinstance(actual, T.VariantType) and not isinstance(field.dataType, T.VariantType):
            out.append(_from_variant(field).alias(field.name))
        elif isinstance(actual, T.StringType) and isinstance(field.dataType, T.ArrayType):
            # Broken text must not pass for an empty array.
            decoded = F.from_json(field.name, field.dataType, {"mode": "FAILFAST"})
            out.append(decoded.alias(field.name))
        elif isinstance(field.dataType, T.TimestampNTZType) and actual not in (
            None,
            field.dataType,
        ):
            out.append(as_utc(field.name, actual.simpleString()).alias(field.name))
        elif stored and stored.name != field.name:
            out.append(F.col(field.name).alias(field.name))
        else:
            out.append(field.name)
    return df.select(*out)


def _from_variant(field: T.StructField) -> Column:
    """A VARIANT column as the feed's type; a value of another shape is an error."""
    if isinstance(field.dataType, T.TimestampNTZType):
        return as_utc(F.variant_get(field.name, "$", "string"), "string")
    return F.variant_get(field.name, "$", field.dataType.simpleString())


def scan(spark: SparkSession, source: RawSource, schema: T.StructType, prefix: str = "") -> DataFrame:
    """Rows of one raw table with only the fields of ``schema``.

    For a folder the clipped schema goes to the reader: Catalyst prunes below
    one array level, the reader prunes below any number of them.
    """
    if source.frame is not None:
        df = source.frame
    elif source.table is not None:
        df = spark.table(source.table)
    else:
        stored = spark.read.parquet(source.path).schema
        df = spark.read.schema(_clipped(stored, schema, prefix)).parquet(source.path)
    return conform(_normalized(df, prefix), schema)


def _clipped(stored: T.StructType, schema: T.StructType, prefix: str) -> T.StructType:
    """The stored schema cut down to ``schema``, in the stored spelling."""
    spelled = {new.lower(): old for old, new in _lineage_names(stored.names, prefix).items()}
    spelled = {**{n.lower(): n for n in stored.names}, **spelled}
    wanted = [T.StructField(spelled.get(f.name.lower(), f.name), f.dataType) for f in schema.fields]
    return clip(stored, T.StructType(wanted))


def _folder_uris(spark: SparkSession, sources: Sequence[RawSource]) -> list[str]:
    """The folders as the paths of their files begin."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    uris = []
    for source in sources:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source.path)
        uri = folder.getFileSystem(conf).makeQualified(folder).toUri().toString().rstrip("/") + "/"
        uris.append(re.sub(r"^(\w+):///", r"\1:/", uri))  # the reader leaves an empty authority out
    return uris


def _apart(uris: Sequence[str]) -> bool:
    """Whether no folder is another one or lies in it."""
    ordered = sorted(uris)
    return not any(b.startswith(a) for a, b in zip(ordered, ordered[1:]))


def _place_of(path: Column, folders: Sequence[tuple[str, int]]) -> Column:
    """The number of the folder that holds a file: a binary search among literals.

    ``folders`` are sorted. Of folders that lie apart, a file's is the last one
    that is not after its path.
    """
    if len(folders) == 1:
        return F.lit(folders[0][1])
    half = len(folders) // 2
    after = _place_of(path, folders[half:])
    return F.when(path >= F.lit(folders[half][0]), after).otherwise(_place_of(path, folders[:half]))


def scan_folders(
    spark: SparkSession,
    sources: Sequence[RawSource],
    schema: T.StructType,
    tags: T.StructType,
    values: Sequence[tuple],
    since: int | None,
    prefix: str = "",
) -> list[DataFrame]:
    """One scan for all folders of one stored schema, with ``tags`` per folder.

    Schemas are looked up side by side. A row knows its folder from the path of
    its file, which is a constant of the file: a few comparisons with literals
    find the folder's place, and its tags are taken from arrays of literals. No
    folder may lie in another one. Folders that lack a column in their files
    are read one by one.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    with ThreadPoolExecutor(min(len(sources), _SCHEMA_READERS)) as pool:
        stored = list(pool.map(lambda s: reader.parquet(s.path).schema, sources))
    uris = _folder_uris(spark, sources)
    groups: dict[str, list[int]] = {}
    frames = []
    for i, found in enumerate(stored):
        have = {n.lower() for n in found.names} | {n.lower() for n in _lineage_names(found.names, prefix).values()}
        if have >= {n.lower() for n in schema.names}:
            groups.setdefault(found.json(), []).append(i)
        else:
            frames.append(_scan_tagged(spark, sources[i], schema, tags, values[i], since, prefix))
    for members in groups.values():
        clipped = _clipped(stored[members[0]], schema, prefix)
        paths = [sources[i].path for i in members]
        df = spark.read.option("recursiveFileLookup", "true").schema(clipped).parquet(*paths)
        folders = sorted((uris[i], at) for at, i in enumerate(members, 1))
        df = df.withColumn(_FOLDER, _place_of(F.col("_metadata.file_path"), folders))
        if since is not None:
            df = df.where(F.col(_lineage_spelling(clipped, prefix)) >= F.lit(since))
        own = conform(_normalized(df, prefix), T.StructType([*schema.fields, T.StructField(_FOLDER, T.IntegerType())]))
        rows = [values[i] for i in members]
        tagged = {tag.name: _tag(tag, [row[k] for row in rows]) for k, tag in enumerate(tags.fields)}
        frames.append(own.withColumns(tagged).drop(_FOLDER))
    return frames


def _tag(tag: T.StructField, values: Sequence) -> Column:
    """The value of a row's folder; one literal where all folders share it."""
    if len(set(values)) == 1:
        return F.lit(values[0]).cast(tag.dataType)
    return F.get(F.array(*map(F.lit, values)), F.col(_FOLDER) - 1).cast(tag.dataType)


def _scan_tagged(
    spark: SparkSession,
    source: RawSource,
    schema: T.StructType,
    tags: T.StructType,
    values: tuple,
    since: int | None,
    prefix: str,
) -> DataFrame:
    df = scan(spark, source, schema, prefix)
    if since is not None:
        df = df.where(F.col(BATCH_RUNTIME) >= F.lit(since))
    literals = zip(tags.names, values, strict=True)
    return df.withColumns({name: F.lit(value) for name, value in literals})


def _lineage_spelling(schema: T.StructType, prefix: str) -> str:
    names = _lineage_names(schema.names, prefix)
    return next((old for old, new in names.items() if new == BATCH_RUNTIME), BATCH_RUNTIME)


def _normalized(df: DataFrame, prefix: str) -> DataFrame:
    return normalize_lineage(df, prefix) if prefix else df


def consolidate(
    spark: SparkSession, frames: Sequence[DataFrame], schema: T.StructType
) -> DataFrame:
    """Bag union by name; no frames give an empty frame of ``schema``."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)


def tagged_scan(
    spark: SparkSession,
    sources: Sequence[RawSource],
    schema: T.StructType,
    cfg: Config,
    tz_aware: bool,
    since: int | None,
    prefix: str = "",
) -> DataFrame:
    """All sources in one frame, each row knowing brand, store and source.

    Folders of one schema are one scan, however many they are.
    The source number lets one window serve every source at once. The
    look-back predicate is a literal on the raw column, so it reaches the
    Parquet row groups.
    """
    tags = T.StructType.fromDDL(f"brand string, store string, {SOURCE_NO} int, {OFFSET} int")
    tagged = []
    for number, source in enumerate(sources):
        hours = cfg.offset_for(source.name) if tz_aware else 0
        tagged.append((source, (*source.brand_store(cfg), number, hours)))
    folders = [t for t in tagged if t[0].path]
    if not _apart(_folder_uris(spark, [s for s, _ in folders])):
        folders = []  # a file in two folders would be read twice by one scan
    frames = []
    if folders:
        found, values = zip(*folders, strict=True)
        frames = scan_folders(spark, found, schema, tags, values, since, prefix)
    together = {values[2] for _, values in folders}
    for source, values in tagged:
        if values[2] in together:
            continue
        frames.append(_scan_tagged(spark, source, schema, tags, values, since, prefix))
    return consolidate(spark, frames, T.StructType(schema.fields + tags.fields))
