"""Turn repair beside a brute-force search over whole conversations."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tradeloom.llm.turn_repair import END, Steps, backwards, damaged, digests, repair, rerun, turns_of

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        out += [(conv, turn, role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return out


def brute_repair(rows):
    """``rows``: (turn, role, text) of one conversation, after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)

    # a shortest-path search over (place, last initial) with the audit as tie-break
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, made, kept = heapq.heappop(heap)
        if (at, made) in done:
            continue
        if at == len(rows) and made in ("", "a"):
            return faults, cost, audit, kept
        done.add((at, made))
        following = "a" if made == "u" else "u"
        new = "assistant" if following == "a" else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", at, following, (*kept, (new, ""))))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, made, kept))
            if faults[at] not in ("blank", "duplicate"):
                more = 3 * (faults[at] == "truncated")
                heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, following, (*kept, (new, text))))
                if role[:1] == following or (role[:1] == "s" and made == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[:1], (*kept, (role, text))))
    raise AssertionError


def brute(rows, hurt=True):
    out = {}
    after = brute_damage(rows) if hurt else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in after if r[0] == conv]
        faults, cost, audit, kept = brute_repair(own)
        turns = sorted(t for t, _, _ in own if t is not None)
        gaps = turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).digest()))
        roles = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def found(turns, chunk_rows):
    done = repair(turns, chunk_rows)
    rows = done.conversations.join(digests(done.rows), ["none", "conv"], "left").collect()
    empty = hashlib.sha256(b"").hexdigest()
    return {
        None if r.none else r.conv: (
            r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256 or empty
        )
        for r in rows
    }


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        size = rng.randrange(1, longest)
        texts = ["Yes.", "No!", "what", "", " ", "a b?", "c", None, "x" * 100, "x" * 99 + "."]
        for turn in range(size):
            text = rng.choice(texts) if rng.random() < 0.4 else f"t {rng.randrange(10 * size)}" + rng.choice(["", ".", "?\n"])
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text))
    return rows


@pytest.mark.parametrize(("seed", "longest", "chunk_rows"), [(1, 12, 4096), (2, 40, 3), (3, 25, 1)])
def test_brute_force(spark, seed, longest, chunk_rows):
    rows = random_rows(seed, 30, longest)
    turns = turns_of(spark.createDataFrame(rows, SCHEMA))
    assert found(turns, chunk_rows) == brute(rows, hurt=False)


def test_damage(spark):
    rows = random_rows(5, 20, 9)
    turns = damaged(turns_of(spark.createDataFrame(rows, SCHEMA)))
    got = sorted(map(str, ((None if r.none else r.conv, r.turn, r.role, r.text) for r in turns.collect())))
    assert got == sorted(map(str, brute_damage(rows)))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries()["op13_turn_repair"](spark, SF)
    assert {r.conv_id: tuple(r)[1:] for r in got.collect()} == brute(rows)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_vectors_that_never_agree(spark):
    """Cut rows of other roles keep the difference of two vectors: every chunk waits for the next."""
    rows = [(1, i, "tool", f"cut {i}") for i in range(300)] + [(1, 400, "assistant", "end.")]
    rows = [(1, -1, "user", "start."), *rows]
    assert found(turns_of(spark.createDataFrame(rows, SCHEMA)), 2) == brute(rows, hurt=False)


def test_hot_rows(spark):
    """Many equal rows and one long conversation."""
    rows = [(1, None, "user", "again.")] * 700 + [(2, i, "ua"[i % 2], "ok.") for i in range(500)] + [(1, 3, "assistant", "b.")] * 3
    assert found(turns_of(spark.createDataFrame(rows, SCHEMA)), 7) == brute(rows, hurt=False)


def test_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(turns_of(empty), 8) == {}
    rows = spark.createDataFrame([(1, 0, "user", "a.")], SCHEMA).withColumns(
        {c: F.lit(1) for c in ("none", "conv", "digest", "start", "chunk", "n", "copy", "how")}
    )
    assert found(turns_of(rows), 8)[1][5:7] == (3, "KI")


def test_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", "x" * 3_000_000)]
    assert found(turns_of(spark.createDataFrame(rows, SCHEMA)), 8) == brute(rows, hurt=False)


def test_rerun_equals_whole_run():
    rng, steps = random.Random(3), Steps()
    for _ in range(200):
        codes = bytes(rng.randrange(12) for _ in range(rng.randrange(30)))
        before, total = backwards(steps, codes, None, END)
        other = (rng.randrange(3), rng.randrange(4), rng.randrange(3), 0)
        other = tuple(c - min(other) for c in other)
        assert rerun(steps, codes, (END, before, total), other) == backwards(steps, codes, None, other)
