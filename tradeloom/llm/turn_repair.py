"""Cheapest repair of the turn structure of conversations.

A repaired conversation's role initials read ``(s?(ua)+)?``. Its rows are kept,
re-roled to user or assistant, deleted, or empty rows are inserted between
them. The search is a Viterbi over four states (nothing yet, after system,
after user, after assistant) and made parallel by rank convergence:

* The rows, one per different turn, role and text, are range-partitioned by
  conversation and turn, so a conversation of any length is spread over tasks.
  A chunk is a run of one conversation in a task; a row is one byte of it.
* Every chunk runs backwards from a speculative vector of costs-to-go, the last
  one of a conversation from the true one.
* Fix-up passes rerun chunks whose successor starts with another vector, old
  and new vector side by side, until the two differ by a constant only; from
  there on the old run holds, moved by the constant. A pass reaches over twice
  as many chunks as the one before, so the passes grow with the logarithm of
  the chunks even where vectors never converge.
* With the stitched vectors every chunk traces the least audit from each state
  it can be entered in, and the entered states are chained, four numbers a chunk.

Vectors are kept less their smallest cost. There are few of those, so steps and
choices are remembered per vector and row kind.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import stage, text_slices, trimmed

# Fixed values of the edit costs.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
CHUNK_ROWS = 1 << 12
_OUT_BYTES = 1 << 22
_KEY = ["none", "conv"]
_ORDER = ["turn", "role", "start", "digest"]

START, SYSTEM, USER, ASSISTANT = range(4)
_INSERTED = (USER, USER, ASSISTANT, USER)  # the state after an inserted or re-roled row
_KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
_INITIALS = "sua"
_CLEAN, _CUT, _DROP = range(3)  # what is wrong with a row
Vector = tuple[int, int, int, int]
END: Vector = (0, 2 * INSERT, INSERT, 0)


def _closed(costs: list[int]) -> list[int]:
    """Costs with insertions before the row allowed; two are always enough."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[_INSERTED[q]]) for q, c in enumerate(costs)]
    return costs


def _moves(after: Vector, code: int, state: int) -> list[tuple[str, int, int]]:
    """``(edit, cost to go, next state)`` of the edits of one row in a state."""
    initial, wrong = divmod(code, 3)
    found = [("D", DELETE + after[state], state)]
    if wrong != _DROP:
        more = TRUNCATED if wrong == _CUT else 0
        kept = _KEPT[state].get(_INITIALS[initial : initial + 1])
        if kept is not None:
            found.append(("K", more + after[kept], kept))
        found.append(("R", REROLE + more + after[_INSERTED[state]], _INSERTED[state]))
    return found


class Steps:
    """Remembered steps backwards and choices forwards."""

    def __init__(self) -> None:
        self.back: dict[tuple[Vector, int], tuple[int, Vector]] = {}
        self.forth: dict[tuple[Vector, int], list[tuple[str, int]]] = {}

    def _costs(self, after: Vector, code: int) -> list[int]:
        return _closed([min(m[1] for m in _moves(after, code, q)) for q in range(4)])

    def before(self, after: Vector, code: int) -> tuple[int, Vector]:
        """The constant and the vector before a row, from the vector after it."""
        found = self.back.get((after, code))
        if found is None:
            costs = self._costs(after, code)
            least = min(costs)
            found = self.back[after, code] = least, tuple(c - least for c in costs)
        return found

    def choices(self, after: Vector, code: int) -> list[tuple[str, int]]:
        """For each state the least edits of a row, insertions first, and the next state."""
        found = self.forth.get((after, code))
        if found is None:
            costs = self._costs(after, code)
            found = [self._choice(after, code, q, costs) for q in range(4)]
            self.forth[after, code] = found
        return found

    def _choice(self, after: Vector, code: int, state: int, costs: list[int]) -> tuple[str, int]:
        edits = ""
        while True:
            moves = {edit: to for edit, cost, to in _moves(after, code, state) if cost == costs[state]}
            if "D" in moves:
                return edits + "D", moves["D"]
            if INSERT + costs[_INSERTED[state]] == costs[state]:
                edits, state = edits + "I", _INSERTED[state]
                continue
            edit = min(moves)
            return edits + edit, moves[edit]


def backwards(steps: Steps, codes: bytes, extra: list[int] | None, after: Vector) -> tuple[Vector, int]:
    """The vector before a chunk and the constant, from the vector after it."""
    total = DELETE * sum(extra or ())
    for code in reversed(codes):
        cost, after = steps.before(after, code)
        total += cost
    return after, total


def rerun(
    steps: Steps, codes: bytes, old: tuple[Vector, Vector, int], after: Vector
) -> tuple[Vector, int]:
    """``backwards`` from ``after``, given the run ``(after, before, constant)`` from another
    vector: it ends where the two vectors differ by a constant only."""
    was, before, total = old
    moved = 0
    for code in reversed(codes):
        if was == after:
            return before, total + moved
        cost, after = steps.before(after, code)
        cost_was, was = steps.before(was, code)
        moved += cost - cost_was
    return (before, total + moved) if was == after else (after, total + moved)


def trace(steps: Steps, codes: bytes, after: Vector, last: bool, states: list[int]) -> list[tuple[str, int]]:
    """The least audit of a chunk's rows, without extra copies, and the state after it, per entry state."""
    vectors = [after]
    for code in reversed(codes):
        vectors.append(steps.before(vectors[-1], code)[1])
    vectors.reverse()
    out = []
    for state in states:
        edits = []
        for code, then in zip(codes, vectors[1:], strict=True):
            edit, state = steps.choices(then, code)[state]
            edits.append(edit)
        if last:
            edits.append("I" * (END[state] // INSERT))
        out.append(("".join(edits), state))
    return out


@dataclass
class Repair:
    """``conversations``: ``(none, conv, gaps, blank, duplicate, truncated, illegal, cost, audit)``;
    ``rows``: the repaired rows ``(none, conv, place, edit, role, text)``, ordered within tasks
    that hold whole conversations. ``none`` is true for the conversation with the NULL id,
    whose ``conv`` is 0."""

    conversations: DataFrame
    rows: DataFrame


def turns_of(
    table: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``(none, conv, turn, role, text)``; a NULL role or text is one space."""
    conv = table[conv_col].cast("long")
    return table.select(
        conv.isNull().alias("none"),
        F.coalesce(conv, F.lit(0)).alias("conv"),
        table[turn_col].cast("long").alias("turn"),
        F.coalesce(table[role_col].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(table[text_col].cast("string"), F.lit(" ")).alias("text"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or re-roled by the checksum of conversation and turn."""
    conv = F.when(F.col("none"), F.lit(" ")).otherwise(F.col("conv").cast("string"))
    turn = F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    how = F.crc32(F.concat_ws(":", conv, turn).cast("binary")) % 20
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", ""))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = turns.withColumn("how", how).where("how <> 0")
    kept = kept.withColumns({"text": text.otherwise(F.col("text")), "role": role})
    return kept.withColumn("copy", F.explode(copies)).drop("how", "copy")


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows with what orders them within a conversation besides the turn."""
    return turns.withColumns(
        {"start": F.substring("text", 1, 64), "digest": F.unhex(F.sha2(F.col("text"), 256))}
    )


def _kinds(turns: DataFrame) -> DataFrame:
    """One row per different row: ``n`` equal ones, and whether it repeats an earlier one."""
    bare = trimmed(F.col("text"))
    wrong = F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "cut").otherwise("")
    rows = _ordered(turns).withColumn("wrong", wrong)
    rows = stage(rows.groupBy(*_KEY, *_ORDER, "wrong").agg(F.count("*").alias("n")), "kinds")
    said = ["none", "conv", "role", "digest"]
    firsts = rows.groupBy(*said).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns"))
    firsts = firsts.where("turns > 1").select(*said, "first")
    joined = rows.join(firsts, said, "left")
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return joined.select(*_KEY, *_ORDER, "wrong", "n", later.alias("later"))


_CHUNK_COLUMNS = (
    "none boolean, conv long, task int, part int, codes binary, extra array<long>, blank long, duplicate long, "
    "truncated long, illegal long, first_role string, last_role string, least_turn long, most_turn long, turns long, "
    "turn long, role string, start string, digest binary"
)
_LEGAL = {"su", "ua", "au"}


def _chunks(kinds: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks of the sorted rows, numbered within their conversation, with their statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in _CHUNK_COLUMNS.split(", ")]
        task, part, open_ = TaskContext.get().partitionId(), 0, None
        ready: list[dict] = []

        def closed(chunk: dict) -> dict:
            extra = chunk["extra"] if any(chunk["extra"]) else None
            return chunk | {"codes": bytes(chunk["codes"]), "extra": extra}

        def table(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        schema = pa.schema(
            [
                (name, {"boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
                        "string": pa.string(), "array<long>": pa.list_(pa.int64())}[p.split()[1]])
                for name, p in zip(names, _CHUNK_COLUMNS.split(", "), strict=True)
            ]
        )
        for batch in batches:
            for row in batch.to_pylist():
                same = open_ is not None and (open_["none"], open_["conv"]) == (row["none"], row["conv"])
                if not same or len(open_["codes"]) >= chunk_rows:
                    if open_ is not None:
                        ready.append(closed(open_))
                    open_ = {k: row[k] for k in (*_KEY, *_ORDER)} | {
                        "task": task, "part": part, "codes": bytearray(), "extra": [], "blank": 0, "duplicate": 0,
                        "truncated": 0, "illegal": 0, "first_role": row["role"][:1], "last_role": None,
                        "least_turn": None, "most_turn": None, "turns": 0,
                    }
                    part += 1
                c, n, initial = open_, row["n"], row["role"][:1]
                blank = row["wrong"] == "blank"
                gone = n if blank or row["later"] else n - 1
                c["blank" if blank else "duplicate"] += gone
                cut = row["wrong"] == "cut" and not row["later"]
                c["truncated"] += cut
                wrong = _DROP if gone == n else _CUT if cut else _CLEAN
                place = _INITIALS.find(initial) if initial else -1
                c["codes"].append((place if place >= 0 else 3) * 3 + wrong)
                c["extra"].append(n - 1)
                if c["last_role"] is not None:
                    c["illegal"] += c["last_role"] + initial not in _LEGAL
                c["illegal"] += n - 1  # equal rows side by side have the same initial
                c["last_role"] = initial
                if row["turn"] is not None:
                    c["turns"] += row["turn"] != c["most_turn"]
                    c["least_turn"] = row["turn"] if c["least_turn"] is None else c["least_turn"]
                    c["most_turn"] = row["turn"]
            if len(ready) >= 1000 or sum(len(x["codes"]) for x in ready) > _OUT_BYTES // 8:
                yield table(ready)
                ready = []
        if open_ is not None:
            ready.append(closed(open_))
        if ready:
            yield table(ready)

    sorted_ = kinds.repartitionByRange(*_KEY, *_ORDER).sortWithinPartitions(*_KEY, *_ORDER)
    found = stage(sorted_.mapInArrow(run, _CHUNK_COLUMNS), "chunks")
    along = Window.partitionBy(*_KEY).orderBy("task", "part")  # one row per chunk
    before = F.lag("last_role").over(along)
    joint = F.when(before.isNotNull() & ~F.concat(before, "first_role").isin(*_LEGAL), 1).otherwise(0)
    shared = F.when(F.lag("most_turn").over(along) == F.col("least_turn"), 1).otherwise(0)
    numbered = found.withColumns(
        {
            "chunk": F.row_number().over(along),
            "chunks": F.count("*").over(Window.partitionBy(*_KEY)),
            "illegal": F.col("illegal") + joint,
            "turns": F.col("turns") - shared,
        }
    )
    return stage(numbered.drop("task", "part", "first_role", "last_role"), "chunks")


_STATE = "none boolean, conv long, chunk int, after array<int>, before array<int>, total long, changed boolean"


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.bool_(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.bool_()]
    names = [p.split()[0] for p in _STATE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)


def _speculated(chunks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = Steps()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                before, total = backwards(steps, r["codes"], r["extra"], END)
                rows.append((r["none"], r["conv"], r["chunk"], END, before, total, False))
            if rows:
                yield _emit(rows)

    return chunks.select(*_KEY, "chunk", "codes", "extra").mapInArrow(run, _STATE)


def _fixed(chunks: DataFrame, state: DataFrame, reach: int) -> DataFrame:
    """One fix-up pass: runs of ``reach`` chunks are stitched from their ends."""
    back = F.col("chunks") - F.col("chunk")
    rows = chunks.join(state.drop("changed"), [*_KEY, "chunk"])
    rows = rows.withColumns({"back": back.cast("long"), "run": F.floor(back / reach)})
    ends = rows.where((F.col("back") + 1) % reach == 0)
    given = ends.select(*_KEY, (F.col("run") + 1).alias("run"), F.col("before").alias("given"))
    rows = rows.join(given, [*_KEY, "run"], "left").drop("chunks")
    rows = rows.repartition(*_KEY, "run").sortWithinPartitions(*_KEY, "run", "back")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, at, carried = Steps(), None, END
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                here = r["none"], r["conv"], r["run"]
                if here != at:
                    at, carried = here, tuple(r["given"] or END)
                after, before, total = tuple(r["after"]), tuple(r["before"]), r["total"]
                changed = carried != after
                if changed:
                    before, total = rerun(steps, r["codes"], (after, before, total), carried)
                out.append((r["none"], r["conv"], r["chunk"], carried, before, total, changed))
                carried = before
            if out:
                yield _emit(out)

    return rows.mapInArrow(run, _STATE)


def _stitched(chunks: DataFrame) -> DataFrame:
    """Costs-to-go after and before every chunk, and its constant."""
    state = stage(_speculated(chunks), "speculated")
    several = stage(chunks.where("chunks > 1").select(*_KEY, "chunk", "chunks", "codes"), "several")
    if several.isEmpty():
        return state
    alone = state.join(several.select(*_KEY, "chunk"), [*_KEY, "chunk"], "left_anti")
    state = stage(state.join(several.select(*_KEY, "chunk"), [*_KEY, "chunk"], "left_semi"), "speculated")
    reach, changed = 1, True
    while changed:
        state = stage(_fixed(several, state, reach), "fixed")
        changed = not state.where("changed").isEmpty()
        reach *= 2
    return alone.unionByName(state)


def _traced(chunks: DataFrame, state: DataFrame) -> DataFrame:
    """``(none, conv, chunk, audit)``: the least audit of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, out, held = Steps(), [], 0
        for batch in batches:
            for r in batch.to_pylist():
                states = [START] if r["chunk"] == 1 else list(range(4))
                found = trace(steps, r["codes"], tuple(r["after"]), r["chunk"] == r["chunks"], states)
                audits, exits = zip(*found, strict=True)
                out.append({k: r[k] for k in (*_KEY, "chunk")} | {"audits": audits, "exits": exits})
                held += 64 + sum(map(len, audits))
                if held > _OUT_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema(
        [("none", pa.bool_()), ("conv", pa.int64()), ("chunk", pa.int32()), ("audits", pa.list_(pa.string())),
         ("exits", pa.list_(pa.int32()))]
    )

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, entered = None, START
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                here = r["none"], r["conv"]
                entered = entered if here == at else START
                out.append(entered if r["chunk"] > 1 else START)
                at, entered = here, r["exits"][out[-1]]
            columns = [batch.column("none"), batch.column("conv"), batch.column("chunk"), pa.array(out, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["none", "conv", "chunk", "entered"])

    rows = chunks.select(*_KEY, "chunk", "chunks", "codes").join(state.select(*_KEY, "chunk", "after"), [*_KEY, "chunk"])
    traces = stage(rows.mapInArrow(run, "none boolean, conv long, chunk int, audits array<string>, exits array<int>"), "traces")
    exits = traces.select(*_KEY, "chunk", "exits").repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk")
    entered = exits.mapInArrow(chain, "none boolean, conv long, chunk int, entered int")
    chosen = traces.join(entered, [*_KEY, "chunk"])
    return chosen.select(*_KEY, "chunk", F.get("audits", F.col("entered")).alias("audit"))


_ROWS = "none boolean, conv long, place long, edit string, role string, text string"


def _applied(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired rows: audits and rows of a conversation stream in order through one task."""
    steps = audits.select(
        *_KEY, *_ORDER, F.lit(0).alias("flag"), "chunk", "audit", "extra", F.lit(None).cast("string").alias("text")
    )
    texts = _ordered(turns).select(
        *_KEY,
        *_ORDER,
        F.lit(1).alias("flag"),
        F.lit(0).alias("chunk"),
        F.lit(None).cast("string").alias("audit"),
        F.lit(None).cast("array<long>").alias("extra"),
        "text",
    )
    both = steps.unionByName(texts).repartition(*_KEY).sortWithinPartitions(*_KEY, *_ORDER, "flag", "chunk")
    both = both.select(*_KEY, "role", "flag", "audit", "extra", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, place, copies = None, START, 0, 0
        waiting: deque = deque()
        out: list[tuple] = []
        held = 0

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place, held, state
            out.append((*at, place, edit, role, text))
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            place, held = place + 1, held + len(text) + 64

        def insert() -> None:
            put("I", "assistant" if state == USER else "user", "")

        def inserted() -> None:
            """Insertions that come before the next row."""
            while waiting:
                audit, _, spot, _ = waiting[0]
                if spot < len(audit) and audit[spot] == "I":
                    waiting[0][2] += 1
                    insert()
                elif spot >= len(audit):
                    waiting.popleft()
                else:
                    return

        def table() -> pa.RecordBatch:
            kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            names = [p.split()[0] for p in _ROWS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names)

        for batch in text_slices(batches, "text"):
            for none, conv, role, flag, audit, extra, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (none, conv):
                    inserted()
                    at, state, place, copies = (none, conv), START, 0, 0
                    waiting.clear()
                if not flag:
                    waiting.append([audit, extra, 0, 0])
                elif copies:
                    copies -= 1
                else:
                    inserted()
                    audit, extra, spot, row = waiting[0]
                    waiting[0][2:] = spot + 1, row + 1
                    copies = extra[row] if extra else 0
                    if audit[spot] == "K":
                        put("K", role, text)
                    elif audit[spot] == "R":
                        put("R", "assistant" if state == USER else "user", text)
                if held > _OUT_BYTES:
                    yield table()
                    out, held = [], 0
        inserted()
        if out:
            yield table()

    return both.mapInArrow(run, _ROWS)


def repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> Repair:
    """The least of the cheapest repairs of every conversation of ``turns_of``.

    Rows are taken by turn, NULL first; rows of one turn by role, the first 64
    characters and the digest of the text. A row is blank without a character
    besides white space, else a duplicate if role and text came earlier, else
    truncated if its last such character does not end a sentence. Blank rows
    and duplicates are deleted; roles of other initials than s, u and a, empty
    ones too, can be re-roled or deleted only. Equal rows are one row with a
    count until they are deleted. Texts of any length are streamed. An empty
    table gives no rows. Extra columns are not read.

    The audit of a conversation is one value of one row and grows with it.
    """
    kinds = _kinds(turns)
    chunks = _chunks(kinds, chunk_rows)
    state = stage(_stitched(chunks), "stitched")
    audits = stage(_traced(chunks, state), "audits")
    parts = chunks.join(audits, [*_KEY, "chunk"]).join(state.select(*_KEY, "chunk", "before", "total"), [*_KEY, "chunk"])
    whole = _with_copies(parts.select(*_KEY, "chunk", "audit", "extra"))
    first = F.max(F.when(F.col("chunk") == 1, F.get("before", F.lit(START))))
    gaps = F.max("most_turn") - F.min("least_turn") + 1 - F.sum("turns")
    found = parts.groupBy(*_KEY).agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        (F.sum("total") + first).cast("long").alias("cost"),
    )
    rows = _applied(turns, parts.select(*_KEY, *_ORDER, "chunk", "audit", "extra"))
    return Repair(found.join(whole, _KEY), rows)


def _with_copies(audits: DataFrame) -> DataFrame:
    """``(none, conv, audit)``: chunk audits with the deletions of equal rows, put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = []
            for audit, extra in zip(batch.column("audit").to_pylist(), batch.column("extra").to_pylist(), strict=True):
                if extra:
                    more, parts = iter(extra), []
                    for edit in audit:
                        parts.append(edit if edit == "I" else edit + "D" * next(more))
                    audit = "".join(parts)
                full.append(audit)
            columns = [batch.column("none"), batch.column("conv"), batch.column("chunk"), pa.array(full, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["none", "conv", "chunk", "audit"])

    parts = audits.mapInArrow(run, "none boolean, conv long, chunk int, audit string")
    listed = F.sort_array(F.collect_list(F.struct("chunk", "audit")))
    return parts.groupBy(*_KEY).agg(F.array_join(F.transform(listed, lambda p: p["audit"]), "").alias("audit"))


def digests(rows: DataFrame) -> DataFrame:
    """``(none, conv, repaired_sha256)`` of repaired rows that stream in order.

    Such a digest has no parallel form: a conversation passes through one task,
    which remembers a few bytes of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None

        def done() -> pa.RecordBatch:
            columns = [pa.array([at[0]], pa.bool_()), pa.array([at[1]], pa.int64()), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(columns, ["none", "conv", "repaired_sha256"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("none", "conv", "role", "text"))
            for none, conv, role, text in zip(*columns, strict=True):
                if at != (none, conv):
                    if at is not None:
                        yield done()
                    at, digest = (none, conv), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode("utf-8", "replace"))
        if at is not None:
            yield done()

    return rows.mapInArrow(run, "none boolean, conv long, repaired_sha256 string")
