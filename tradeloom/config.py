"""Settings and the declarative description of a feed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

USER_ID = "_user_id"
BATCH_RUNTIME = "_batch_runtime"
BATCH_ID = "_batch_id"
LINEAGE = (USER_ID, BATCH_RUNTIME, BATCH_ID)
LINEAGE_DDL = f"{USER_ID} bigint, {BATCH_RUNTIME} bigint, {BATCH_ID} bigint"

LAST_UPDATED = "_last_updated"
RUN_ID = "_run_id"
SEQ_ID = "_seq_id"

# Fixed value: 30 days of batch time in milliseconds.
LOOKBACK_MS = 2592000000

# A group with more rows than this is numbered in several tasks.
HOT_ROWS = 4_000_000


@dataclass(frozen=True)
class Config:
    """Run settings; every flag of the public surface is one field."""

    brand_from_name: bool = True
    brand_position: int = 0
    default_brand: str = ""
    store_from_name: bool = True
    store_position: int = 1
    default_store: str = ""
    convert_currency: bool = False
    convert_timezone: bool = False
    offset_hours: Mapping[str, int] = field(default_factory=dict)  # names in any case
    recency_timezone: str = "America/Los_Angeles"
    enabled: Mapping[str, bool] = field(default_factory=dict)
    out_dir: str | None = None
    run_id: str = "manual"
    lookback_ms: int = LOOKBACK_MS
    hot_rows: int = HOT_ROWS

    def is_enabled(self, name: str) -> bool:
        return self.enabled.get(name, True)

    def offset_for(self, source_name: str) -> int:
        if not self.convert_timezone:
            return 0
        hours = {name.lower(): h for name, h in self.offset_hours.items()}
        return hours.get(source_name.lower(), 0)


@dataclass(frozen=True)
class Col:
    """One output column: how it is read from the raw row and cleaned."""

    name: str
    kind: str = "plain"  # plain | stamp | date | leaf | leaf_stamp
    source: str = ""
    dtype: str = "string"
    default: object = None

    @property
    def path(self) -> str:
        return self.source or self.name


@dataclass(frozen=True)
class Latest:
    """Keep the newest row (``ties="one"``) or newest batch (``"all"``) per key.

    A key written ``day(x)`` is the calendar day of output column ``x``.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...] = (BATCH_RUNTIME,)
    ties: str = "one"


@dataclass(frozen=True)
class Sequence:
    """Number rows per key; ``"-x"`` in ``order`` sorts ``x`` descending.

    ``before_last`` numbers the rows that the last keep-latest stage chooses
    from, so that the rows it keeps need not be the first ones.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    per_source: bool = False
    before_last: bool = False


@dataclass(frozen=True)
class Fx:
    """Where the exchange-rate lookup takes its date and currency.

    ``raw`` looks the date up in the raw row, before any hour shift.
    """

    date: str
    currency: str
    raw: bool = False


@dataclass(frozen=True)
class Check:
    kind: str  # unique | not_null | accepted | recent
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    days: int = 0
    severity: str = "error"


@dataclass(frozen=True)
class Feed:
    """One raw report turned into one staged table."""

    name: str
    like: str
    columns: tuple[Col, ...]
    merge_keys: tuple[str, ...]
    latest: tuple[Latest, ...]
    unnest: tuple[str, ...] = ()
    nested_ddl: str = ""
    where_not: tuple[tuple[str, str], ...] = ()
    sequence: Sequence | None = None
    fx: Fx | None = None
    merge_exclude: tuple[str, ...] = ()
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    tz_aware: bool = False
    checks: tuple[Check, ...] = ()

    @property
    def raw_ddl(self) -> str:
        """Schema of exactly the raw fields this feed reads."""
        nested = {part.strip().split(" ")[0].lower() for part in _top_level(self.nested_ddl)}
        flat: dict[str, str] = {}
        for col in self.columns:
            if "leaf" not in col.kind:
                flat.setdefault(col.path.lower(), f"{col.path} {_raw_type(col)}")
        if self.fx and self.fx.raw:
            flat.setdefault(self.fx.date.lower(), f"{self.fx.date} timestamp_ntz")
        parts = [ddl for name, ddl in flat.items() if name not in nested]
        if self.nested_ddl:
            parts.append(self.nested_ddl)
        return ", ".join([*parts, LINEAGE_DDL])

    @property
    def partition_in_key(self) -> bool:
        """True when a merge match can only sit in the source row's own day."""
        keys = {k.lower() for k in self.merge_keys}
        return self.partition_by is not None and self.partition_by.lower() in keys

    def column_names(self) -> list[str]:
        names = ["brand", "store", *(c.name for c in self.columns)]
        if self.fx:
            names += ["exchange_currency_rate", "exchange_currency_code"]
        names += [*LINEAGE, LAST_UPDATED, RUN_ID]
        return names + [SEQ_ID] if self.sequence else names


def _raw_type(col: Col) -> str:
    return "timestamp_ntz" if col.kind == "stamp" else col.dtype


def _top_level(ddl: str) -> list[str]:
    """Split a DDL list on the commas outside any angle bracket."""
    parts, depth, current = [], 0, ""
    for ch in ddl:
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    return [*parts, current] if current.strip() else parts
