"""Short constructors for column lists; a name may carry ``:type``."""

from __future__ import annotations

from tradeloom.config import Check, Col


def _split(names: str, dtype: str) -> list[tuple[str, str]]:
    pairs = []
    for word in names.split():
        name, _, given = word.partition(":")
        pairs.append((name, given or dtype))
    return pairs


def plain(names: str, dtype: str = "string") -> list[Col]:
    return [Col(n, dtype=t) for n, t in _split(names, dtype)]


def stamps(names: str) -> list[Col]:
    return [Col(n, "stamp", dtype="timestamp_ntz") for n in names.split()]


def dates(names: str) -> list[Col]:
    return [Col(n, "date", dtype="date") for n in names.split()]


def keys(names: str) -> list[Col]:
    return [Col(n, default="N/A") for n in names.split()]


def zeros(names: str) -> list[Col]:
    return [Col(n, dtype="bigint", default=0) for n in names.split()]


def leaves(parent: str, fields: str, prefix: str | None = None, default: object = None) -> list[Col]:
    """Nested fields ``field[:type][>output_name]`` of an un-nested column."""
    out = []
    for word in fields.split():
        word, _, renamed = word.partition(">")
        field, _, dtype = word.partition(":")
        name = f"{prefix or parent}_{renamed or field}"
        out.append(Col(name, "leaf", f"{parent}.{field}", dtype or "string", default))
    return out


def leaf_stamp(parent: str, field: str) -> list[Col]:
    return [Col(f"{parent}_{field}", "leaf_stamp", f"{parent}.{field}")]


REPORT_HEAD = (
    *stamps("ReportstartDate ReportendDate ReportRequestTime"),
    *plain("sellingPartnerId marketplaceName marketplaceId"),
)


def checks(
    unique: str = "", recent: str = "", not_null: str = "", brand: bool = True, days: int = 1
) -> tuple[Check, ...]:
    """The declared checks of one feed; ``recent`` is also checked for NULL."""
    out = []
    if unique:
        out.append(Check("unique", tuple(unique.split())))
    if recent:
        out.append(Check("recent", (recent,), days=days))
        out.append(Check("not_null", (recent,)))
    if brand:
        out.append(Check("accepted", ("brand",), values=("Default",)))
    out += [Check("not_null", (c,)) for c in not_null.split()]
    return tuple(out)
