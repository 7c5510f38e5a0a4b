import random

from pyspark.sql import functions as F

from tradeloom.operators import has_hot_group, number_rows


def _brute(data, key, order):
    """Reference numbering; order is a list of (index, descending)."""
    groups = {}
    for row in data:
        groups.setdefault(row[key], []).append(row)

    def sort_key(row):
        out = []
        for i, desc in order:
            v = row[i]
            if desc:
                out.append((v is None, 0 if v is None else -v))
            else:
                out.append((v is not None, 0 if v is None else v))
        return out

    return sorted(
        (row + (n,) for rows in groups.values() for n, row in enumerate(sorted(rows, key=sort_key), 1)),
        key=str,
    )


def test_hot_key_is_numbered_like_a_plain_window(spark):
    rng = random.Random(7)
    data = [
        (
            "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"k{i % 50}"),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, *range(40)]),
            i,
        )
        for i in range(3000)
    ]
    df = spark.createDataFrame(data, "k string, a int, b int, id int").repartition(5)
    order = ["a", "-b", "id"]
    want = _brute(data, 0, [(1, False), (2, True), (3, False)])
    for limit in (10, 100, 10_000):
        got = number_rows(df, ["k"], order, hot_rows=limit)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want, limit


def test_equal_copies_are_split_and_numbered_once(spark):
    df = spark.range(900).select(F.lit("k").alias("k"), F.lit(1).alias("a"))
    got = number_rows(df, ["k"], ["a"], hot_rows=50)
    assert sorted(r["_seq_id"] for r in got.collect()) == list(range(1, 901))


def test_hot_work_is_spread_over_tasks(spark):
    df = spark.range(4000).select(F.lit("k").alias("k"), F.col("id").alias("a"))
    got = number_rows(df, ["k"], ["a"], hot_rows=100)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "_range" in text
    assert got.agg(F.max("_seq_id"), F.count_distinct("_seq_id")).first()[:] == (4000, 4000)


def test_group_size_check(spark):
    df = spark.range(100).selectExpr("id % 10 AS k")
    assert has_hot_group(df, ["k"], 9)
    assert not has_hot_group(df, ["k"], 10)
