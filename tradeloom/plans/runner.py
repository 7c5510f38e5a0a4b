"""One generic plan for every feed, and the incremental run around it."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.config import (
    BATCH_ID,
    BATCH_RUNTIME,
    LINEAGE,
    SEQ_ID,
    Col,
    Config,
    Feed,
    Latest,
)
from tradeloom.functions import as_utc, cast_leaf, day_of, default_key, shift_hours
from tradeloom.operators.checks import WriteChecks, run_checks
from tradeloom.operators.fx import Rates, with_exchange_rate
from tradeloom.operators.incremental import loaded_at
from tradeloom.operators.latest import keep_latest
from tradeloom.operators.nested import unnest
from tradeloom.operators.sequence import group_sizes, number_rows, split_hot
from tradeloom.operators.sink import (
    merge_into,
    prune_snapshots,
    read_target,
    table_paths,
    target_exists,
    write_full,
)
from tradeloom.plans.shared import SharedRows, share, sharing
from tradeloom.session import stage, staged_tables
from tradeloom.sources import RawSource, stamp
from tradeloom.sources.raw import OFFSET, SOURCE_NO, tagged_scan

_FX_DAY = "_fx_date"
# Keys by which raw rows were chosen before un-nesting, kept so that the rows need not move again.
_CHOSEN = "_chosen_key"
# Rows of one task before a window, and raw rows of one task that un-nests them before a window.
_TASK_ROWS = 200_000
_TASK_RAW_ROWS = 20_000
_MOST_TASKS = 20_000
_DAY_KEY = re.compile(r"day\((\w+)\)")


def _key(name: str) -> Column:
    day = _DAY_KEY.fullmatch(name)
    return day_of(day.group(1)) if day else F.col(_carried(name))


def _carried(name: str) -> str:
    """Column that carries a raw nested key such as ``summaries.brand``."""
    return "_key_" + name.replace(".", "_") if "." in name else name


def _stored(raw: DataFrame, path: str) -> str:
    """The type a raw value is stored with, as Spark writes it in SQL."""
    return raw.select(path).schema[0].dataType.simpleString()


def _project(col: Col, shift: bool, raw: DataFrame) -> Column | str:
    moved = shift and col.kind in ("stamp", "leaf_stamp")
    if col.kind in ("plain", "stamp") and not moved and col.default is None:
        return col.name
    value = F.col(col.path)
    if col.kind == "date":
        value = day_of(value)
    elif col.kind == "leaf":
        value = cast_leaf(value, col.dtype, _stored(raw, col.path))
    elif col.kind == "leaf_stamp":
        value = as_utc(value, _stored(raw, col.path))
    if moved:
        value = shift_hours(value, F.col(OFFSET))
    if col.default is not None:
        value = default_key(value, col.default)
    return value.alias(col.name)


def project(raw: DataFrame, feed: Feed, cfg: Config, unnested: int = 0) -> DataFrame:
    """Filter, un-nest and project the raw rows of all sources.

    A nested field is read and cast right after its own level is un-nested,
    before deeper levels multiply the rows. The first ``unnested`` levels of
    the raw rows are un-nested already.
    """
    for column, value in feed.where_not:
        raw = raw.where(F.col(column) != F.lit(value))
    if feed.fx and feed.fx.raw:
        raw = raw.withColumn(_FX_DAY, day_of(feed.fx.date))
    shift = feed.tz_aware and cfg.convert_timezone and bool(cfg.offset_hours)
    dotted = [k for step in feed.latest for k in step.keys if "." in k]
    done, chosen = set(), []
    if feed.unnest and not unnested and _chosen_before_unnest(feed):
        # Un-nesting drops no row: only the newest raw rows of a key can win.
        step = feed.latest[-1]
        order = [*step.order, *(c for c in (BATCH_RUNTIME, BATCH_ID) if c not in step.order)]
        named = {c.name: c for c in feed.columns}
        keys = [_raw_key(k, named, shift, raw) for k in step.keys]
        chosen = [f"{_CHOSEN}{i}" for i in range(len(keys))]
        raw = _newest(raw.withColumns(dict(zip(chosen, keys))), [*chosen, SOURCE_NO], order, cfg)
    for depth, path in enumerate(feed.unnest):
        if depth >= unnested:
            raw = unnest(raw, path)
        level = path.rsplit(".", 1)[-1] + "."
        mine = [c for c in feed.columns if "leaf" in c.kind and c.path.startswith(level)]
        read = {c.name: _project(c, shift, raw) for c in mine}
        read |= {_carried(k): F.col(k) for k in dotted if k.startswith(level)}
        if read:
            raw = raw.withColumns(read)
        done |= {c.name for c in mine}
    carried = [_FX_DAY] if feed.fx and feed.fx.raw else []
    return raw.select(
        "brand",
        "store",
        *[c.name if c.name in done else _project(c, shift, raw) for c in feed.columns],
        *LINEAGE,
        SOURCE_NO,
        *carried,
        *[_carried(k) for k in dotted],
        *chosen,
    )


def _newest(raw: DataFrame, keys: Sequence[str], order: Sequence[str], cfg: Config) -> DataFrame:
    """The newest raw rows of every key.

    One shuffle into tasks of bounded size serves this choice and the one after
    un-nesting; a window over the scan's tasks would sort whole files first.
    Only rows of keys too large for a task are thinned out in the scan's tasks.
    """
    group = [F.col(k) for k in keys]
    largest, total = group_sizes(raw, group, cfg.hot_rows)
    if largest <= cfg.hot_rows:
        return keep_latest(_in_tasks(raw, total, group), group, order, ties="all", hot=False)
    hot, rest = split_hot(raw, group, cfg.hot_rows)
    hot, rest = (keep_latest(r, group, order, ties="all", hot=False) for r in (hot, _in_tasks(rest, total, group)))
    return rest.unionByName(hot)


def _chosen_before_unnest(feed: Feed) -> bool:
    """Whether the newest row of a key can be told from the raw columns alone."""
    step = feed.latest[-1]
    nested = {c.name for c in feed.columns if "leaf" in c.kind}
    lineage = {*LINEAGE}
    names = [_DAY_KEY.sub(r"\1", k) for k in step.keys]
    flat = {c.name for c in feed.columns} - nested
    return (
        len(feed.latest) == 1
        and step.ties == "one"
        and all(n in flat for n in names)
        and set(step.order) <= lineage
    )


def _raw_key(key: str, named: Mapping[str, Col], shift: bool, raw: DataFrame) -> Column:
    day = _DAY_KEY.fullmatch(key)
    value = _project(named[day.group(1) if day else key], shift, raw)
    value = F.col(value) if isinstance(value, str) else value
    return day_of(value) if day else value


def _final_stage(feed: Feed) -> tuple[Latest, ...]:
    """Drop a keep-latest stage that the last one implies.

    The last stage keeps one row on a subset of the earlier keys with an order
    that decides before, or equally to, the earlier one: the row it picks has
    passed the earlier stage. Rows that are numbered in between need both.
    """
    if feed.sequence and feed.sequence.before_last:
        return feed.latest
    last = feed.latest[-1]
    return tuple(
        s
        for s in feed.latest[:-1]
        if not (
            last.ties == "one"
            and set(last.keys) <= set(s.keys)
            and set(s.order) <= set(last.order)
            and set(last.order[: last.order.index(s.order[0])]) <= set(s.keys)
        )
    ) + (last,)


def _group(keys: Sequence[str], per_source: bool) -> list[Column]:
    # The source number goes last, so that sorts compare telling keys first.
    return [_key(k) for k in keys] + ([F.col(SOURCE_NO)] if per_source else [])


def _deduplicate(
    df: DataFrame, feed: Feed, hot: bool, steps: Sequence[Latest] | None = None
) -> DataFrame:
    for step in _final_stage(feed) if steps is None else steps:
        order = list(step.order)
        if step.ties == "one":
            order += [c for c in (BATCH_RUNTIME, BATCH_ID) if c not in order]
        used = {*order, *step.keys, *LINEAGE}
        ties = [c.name for c in feed.columns if c.name not in used]
        chosen = [c for c in df.columns if c.startswith(_CHOSEN)]
        group = [F.col(c) for c in (*chosen, SOURCE_NO)] if chosen else _group(step.keys, True)
        df = keep_latest(df, group, order, step.ties, ties, hot)
    return df


def _number(df: DataFrame, feed: Feed, cfg: Config, hot: bool) -> DataFrame:
    seq = feed.sequence
    last = feed.latest[-1]
    one_left = last.ties == "one" and set(last.keys) <= set(seq.keys)
    if seq.per_source and one_left and not seq.before_last:
        return df.withColumn(SEQ_ID, F.lit(1).cast("bigint"))  # one row per key is left
    named = {o.lstrip("-") for o in seq.order}
    rest = [c.name for c in feed.columns if c.name not in {*named, *seq.keys}]
    order = list(dict.fromkeys([*seq.order, *rest, BATCH_RUNTIME, BATCH_ID, SOURCE_NO]))
    order = [o for o in order if "-" + o not in order]
    return number_rows(
        df, _group(seq.keys, seq.per_source), order, hot_rows=cfg.hot_rows, split=hot
    )


def _distinct_rows(rows: DataFrame, feed: Feed, cfg: Config) -> DataFrame:
    """Keep-latest and sequence numbers.

    Keep-latest with ties and the numbering put whole groups into one task, so
    the largest group is measured first, on the key columns alone. Without a
    hot group one shuffle on the shorter key serves all windows.
    """
    seq = feed.sequence
    if seq and seq.before_last:
        group = _group(seq.keys, seq.per_source)
        largest, total = group_sizes(rows, group, cfg.hot_rows)
        hot = largest > cfg.hot_rows
        if not hot and all(set(seq.keys) <= set(s.keys) for s in feed.latest):
            rows = _in_tasks(rows, total, group)
        rows = _deduplicate(rows, feed, hot, feed.latest[:-1])
        return _deduplicate(_number(rows, feed, cfg, hot), feed, hot, feed.latest[-1:])
    if feed.latest[-1].ties == "one":
        # One row per key is left; a numbered group holds one per marketplace.
        if not feed.unnest:
            rows = _bounded(rows, feed, cfg)
        result = _deduplicate(rows, feed, hot=False)
        return _number(result, feed, cfg, hot=False) if seq else result
    per_source = seq is None or seq.per_source
    group = _group(seq.keys if seq else feed.latest[-1].keys, per_source)
    largest, total = group_sizes(rows, group, cfg.hot_rows)
    hot = largest > cfg.hot_rows
    if not hot:
        rows = _in_tasks(rows, total, group)
    result = _deduplicate(rows, feed, hot)
    return _number(result, feed, cfg, hot) if seq else result


def _bounded(rows: DataFrame, feed: Feed, cfg: Config) -> DataFrame:
    """Rows in bounded tasks for a feed that keeps one row per key.

    As long as no key is too large for a task; else the window thins the rows
    out in the scan's tasks.
    """
    seq = feed.sequence
    steps = _final_stage(feed)
    keys = steps[-1].keys
    if seq and seq.per_source and set(seq.keys) <= set(keys):
        keys = seq.keys
    if not all(set(keys) <= set(s.keys) for s in steps):
        return rows
    group = _group(keys, True)
    largest, total = group_sizes(rows, group, cfg.hot_rows)
    return rows if largest > cfg.hot_rows else _in_tasks(rows, total, group)


def _in_tasks(rows: DataFrame, total: int, group: Sequence[Column]) -> DataFrame:
    """Rows shuffled by group into tasks whose size does not grow with the table.

    Left to adaptive execution, tasks are sized by compressed bytes, and a
    window over the scan's tasks sorts whole files before the shuffle.
    """
    least = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(min(max(total // _TASK_ROWS + 1, least), _MOST_TASKS), *group)


def build(
    spark: SparkSession,
    feed: Feed,
    sources: Sequence[RawSource],
    cfg: Config | None = None,
    rates: Rates | DataFrame | None = None,
    loaded: int | None = None,
    prefix: str = "",
    shared: SharedRows | None = None,
) -> DataFrame:
    """The staged rows of one feed over all its raw tables.

    ``loaded`` is the look-back watermark of an incremental run, ``None`` for
    a full refresh. ``prefix`` is the connector word in the raw lineage names.
    With ``shared`` rows the raw tables themselves are not read.
    """
    cfg = cfg or Config()
    if shared is None:
        schema = T.StructType.fromDDL(feed.raw_ddl)
        raw, unnested = tagged_scan(spark, sources, schema, cfg, feed.tz_aware, loaded, prefix), 0
    else:
        raw, unnested = shared.of(feed, loaded)
    if feed.unnest and feed.latest[-1].ties == "one" and not _chosen_before_unnest(feed):
        # All rows are sorted where they are un-nested: a small file can hold very many.
        tasks = min(raw.count() // _TASK_RAW_ROWS + 1, _MOST_TASKS)
        raw = raw.repartition(tasks) if tasks > 1 else raw
    rows = project(raw, feed, cfg, unnested)
    if feed.unnest and feed.latest[-1].ties == "all" and shared is None:
        # Read for the largest group and for the windows: decoded and un-nested once.
        rows = stage(rows, "unnested")
    result = _distinct_rows(rows, feed, cfg)
    if feed.fx:
        if isinstance(rates, DataFrame) and cfg.convert_currency:
            rates = Rates.measure(rates)
        date = _FX_DAY if feed.fx.raw else day_of(feed.fx.date)
        result = with_exchange_rate(result, rates, date, feed.fx.currency, cfg.convert_currency)
    return stamp(result, cfg.run_id).select(*feed.column_names())


def run_feed(
    spark: SparkSession,
    feed: Feed,
    sources: Sequence[RawSource],
    target: str,
    cfg: Config | None = None,
    rates: Rates | DataFrame | None = None,
    prefix: str = "",
    full_refresh: bool = False,
    on_duplicate: str = "error",
    shared: SharedRows | None = None,
    checks: WriteChecks | None = None,
) -> None:
    """Full refresh on the first run, else watermark, transform and merge.

    Intermediate tables go to the shared folder and are deleted at the end,
    also after an error. ``checks`` are measured on the way, where the whole
    table is written.
    """
    cfg = cfg or Config()
    with staged_tables(spark):
        loaded = _loaded(spark, target, cfg, full_refresh)
        rows = build(spark, feed, sources, cfg, rates, loaded, prefix, shared)
        if loaded is None:
            snapshots = feed.partition_by is None
            write_full(rows, target, feed.partition_by, feed.cluster_by, snapshots, checks)
            return
        # Written once: the merge reads it for days, repeated keys and rows.
        rows = stage(rows, feed.name)
        merge_into(
            target,
            rows,
            feed.merge_keys,
            feed.merge_exclude,
            feed.partition_by,
            feed.cluster_by,
            on_duplicate,
            latest_by=(BATCH_RUNTIME, BATCH_ID),
            checks=checks,
        )
    prune_snapshots(spark, target)


def _loaded(spark: SparkSession, target: str, cfg: Config, full_refresh: bool) -> int | None:
    """Where the look-back begins; None if the whole table is written."""
    if full_refresh or not target_exists(spark, target):
        return None
    return loaded_at(spark, table_paths(spark, target), cfg.lookback_ms)


@dataclass(frozen=True)
class FeedRun:
    """How one feed of a whole run ended."""

    name: str
    error: str | None = None
    failed_checks: tuple[str, ...] = ()

    @property
    def ok(self) -> bool:
        return self.error is None and not self.failed_checks


def run_all(
    spark: SparkSession,
    feeds: Mapping[str, Feed],
    find_sources,
    cfg: Config,
    rates: DataFrame | None = None,
    prefix: str = "",
    full_refresh: bool = False,
    on_duplicate: str = "error",
    check: bool = False,
    as_of: str | None = None,
) -> list[FeedRun]:
    """Run every enabled feed into ``cfg.out_dir`` and tell how each ended.

    ``find_sources(like)`` lists the raw tables of one name pattern. Nested
    feeds over the same raw tables share one scan of them. A feed that fails
    does not stop the others. With ``check`` the declared checks are measured
    during each load, or after it where only some days are written; failures of
    severity ``error`` fail the feed.
    """
    if not cfg.out_dir:
        raise ValueError("a whole run needs Config.out_dir")
    with staged_tables(spark):  # the rates
        measured = Rates.measure(rates) if cfg.convert_currency and rates is not None else None
        chosen = {name: item for name, item in feeds.items() if cfg.is_enabled(name)}
        ended = {}
        for group in sharing(chosen):
            with staged_tables(spark):
                shared = _share(spark, group, find_sources, cfg, prefix, full_refresh) if len(group) > 1 else None
                for name, item in group.items():
                    target = f"{cfg.out_dir}/{name}"
                    try:
                        sources = [] if shared else find_sources(item.like)
                        checks = WriteChecks(item, as_of, cfg.recency_timezone) if check else None
                        run_feed(
                            spark, item, sources, target, cfg, measured, prefix, full_refresh, on_duplicate, shared, checks
                        )
                        failed = failed_checks(checks.report(read_target(spark, target))) if check else ()
                        ended[name] = FeedRun(name, failed_checks=failed)
                    except Exception as error:  # the other feeds go on; the caller sees what failed
                        ended[name] = FeedRun(name, error=f"{type(error).__name__}: {error}")
    return [ended[name] for name in chosen]


def _share(
    spark: SparkSession, group: Mapping[str, Feed], find_sources, cfg: Config, prefix: str, full_refresh: bool
) -> SharedRows | None:
    """One scan for the feeds of a group.

    None if it fails, for instance on a field that only one feed reads: each
    feed then reads the raw tables on its own, and those that cannot say why.
    """
    try:
        marks = [_loaded(spark, f"{cfg.out_dir}/{name}", cfg, full_refresh) for name in group]
        loaded = None if None in marks else min(marks)
        sources = find_sources(next(iter(group.values())).like)
        return share(spark, list(group.values()), sources, cfg, loaded, prefix)
    except Exception:
        return None


def failed_checks(report: DataFrame) -> tuple[str, ...]:
    """Checks of severity ``error`` with failures; a report has one row per check."""
    failed = report.where("severity = 'error' and failures > 0").collect()
    return tuple(f"{r['check']}({r['columns']})" for r in failed)


def check_feed(
    spark: SparkSession,
    feed: Feed,
    target: str,
    cfg: Config | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Report of the feed's declared checks on its staged table."""
    zone = (cfg or Config()).recency_timezone
    return run_checks(read_target(spark, target), feed, as_of, zone)
