"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_END_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_DIRS: dict[str, str] = {}
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def get_session(app: str = "tradeloom", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tradeloom-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(folder, True)


def stage(
    df: DataFrame,
    label: str,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    folders: int = 0,
    keep: bool = False,
    codec: str | None = None,
) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Cuts the lineage, survives lost executors, and gives later joins the real
    size of the data. Inside ``staged_tables`` the files go when the block
    ends, unless they are to ``keep``; elsewhere they stay, like checkpoint
    files, until the owner of the folder removes them. With ``partition_by``,
    tasks sort their rows first, to write one folder after the other; where
    there are at most ``folders`` of them, each task keeps a file of each open
    instead. ``codec`` compresses the files otherwise than the session does.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    owned = _OWNED.get()
    if owned is not None and not keep:
        owned.append(path)
    with _setting(spark, _WRITERS, str(folders) if folders else None):
        df.write.partitionBy(*partition_by).parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str | None) -> Iterator[None]:
    """A setting of the session inside the block; ``None`` changes nothing."""
    before = spark.conf.get(name, None)
    if value is not None:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        if value is not None and before is None:
            spark.conf.unset(name)
        elif value is not None:
            spark.conf.set(name, before)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Delete what ``stage`` writes inside the block, also after an error.

    Shuffle files of a query inside the block go when that query ends; else they
    stay until the driver's memory is next collected, those of all queries together.
    The shared folder is asked for at once, so that a cluster without one is
    told before any work, whatever the size of the data.
    """
    shared_dir(spark)
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        with _setting(spark, _END_SHUFFLES, "true"):
            yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            delete_path(spark, path)
