"""Scheduled refresh as a stream: new raw files trigger the incremental run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom.config import BATCH_RUNTIME, Config, Feed
from tradeloom.operators.fx import Rates
from tradeloom.plans.runner import run_feed
from tradeloom.sources import discover_paths


def folder_glob(root: str, like: str) -> str:
    """Glob of the folders under ``root`` that match a LIKE pattern in any case."""
    letters = {"%": "*", "_": "?"}
    parts = (letters.get(c) or (f"[{c.lower()}{c.upper()}]" if c.isalpha() else c) for c in like)
    return f"{root.rstrip('/')}/{''.join(parts)}"


def refresh_stream(
    spark: SparkSession,
    feed: Feed,
    root: str,
    target: str,
    checkpoint: str,
    cfg: Config | None = None,
    rates: Rates | DataFrame | None = None,
    prefix: str = "",
    on_duplicate: str = "error",
) -> StreamingQuery:
    """Take all new files of the feed's raw folders into ``target``, then stop.

    One stream watches all folders under ``root`` that the feed's pattern
    matches, so a folder that is added later is taken like any other. The
    stream only tells that files have arrived. Each micro-batch lists the
    folders and re-reads the whole look-back window: keep-latest and sequence
    numbers depend on rows of earlier files. A batch that is replayed after a
    failure merges the same rows again.
    """
    clock = T.StructType.fromDDL(f"{BATCH_RUNTIME} bigint")
    arrivals = spark.readStream.schema(clock).parquet(folder_glob(root, feed.like))

    def refresh(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            session = batch.sparkSession
            sources = discover_paths(session, root, feed.like)
            run_feed(session, feed, sources, target, cfg, rates, prefix, on_duplicate=on_duplicate)

    return (
        arrivals.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
