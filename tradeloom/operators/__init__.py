from tradeloom.operators.bucketed import merge_bucketed, prune_versions, write_bucketed
from tradeloom.operators.checks import (
    WriteChecks,
    null_violations,
    recency_violations,
    run_checks,
    unique_violations,
    value_violations,
)
from tradeloom.operators.fx import Rates, with_exchange_rate
from tradeloom.operators.incremental import footer_watermark, loaded_at, max_loaded, since
from tradeloom.operators.latest import keep_latest
from tradeloom.operators.merge import duplicate_matches, merge_upsert
from tradeloom.operators.nested import star_except, unnest, unnest_json
from tradeloom.operators.sequence import has_hot_group, number_rows
from tradeloom.operators.sink import merge_into, read_target, target_exists, write_full

__all__ = [
    "Rates",
    "WriteChecks",
    "duplicate_matches",
    "footer_watermark",
    "has_hot_group",
    "keep_latest",
    "loaded_at",
    "max_loaded",
    "merge_bucketed",
    "merge_into",
    "merge_upsert",
    "null_violations",
    "number_rows",
    "prune_versions",
    "read_target",
    "recency_violations",
    "run_checks",
    "since",
    "star_except",
    "target_exists",
    "unique_violations",
    "unnest",
    "unnest_json",
    "value_violations",
    "with_exchange_rate",
    "write_bucketed",
    "write_full",
]
