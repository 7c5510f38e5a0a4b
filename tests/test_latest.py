import pytest
from pyspark.sql import functions as F

from tradeloom.operators import keep_latest

ROWS = [
    ("a", 1, "x"), ("a", 2, "y"), ("a", 3, "p"), ("a", 3, "q"),
    (None, 1, "n"), (None, 2, "m"), ("N/A", 1, "l"),
    ("z", None, "u"), ("z", 1, "v"), ("w", None, "s"), ("w", None, "t"),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k string, t int, v string")


def test_one_row_per_key_with_a_repeatable_choice(df, rows):
    kept = keep_latest(df, ["k"], ["t"], tie_break=["v"])
    assert rows(kept, "k", "v") == [(None, "m"), ("N/A", "l"), ("a", "p"), ("w", "s"), ("z", "v")]


@pytest.mark.parametrize("hot", [True, False])
def test_whole_newest_batch_in_both_plans(df, rows, hot):
    kept = keep_latest(df, ["k"], ["t"], ties="all", hot=hot)
    assert rows(kept, "k", "v") == [
        (None, "m"), ("N/A", "l"), ("a", "p"), ("a", "q"), ("w", "s"), ("w", "t"), ("z", "v"),
    ]


@pytest.mark.parametrize("hot", [True, False])
def test_several_order_columns_and_expression_keys(df, rows, hot):
    kept = keep_latest(df, [F.length("k")], ["t", "v"], ties="all", hot=hot)
    assert rows(kept, "k", "v") == [(None, "m"), ("N/A", "l"), ("a", "q")]


def test_one_row_plan_trims_before_the_shuffle(df):
    plan = keep_latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("Final"), plan.index("Partial")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_hot_plan_has_no_window(df):
    plan = keep_latest(df, ["k"], ["t"], ties="all")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "LeftSemi" in plan


def test_unknown_ties(df):
    with pytest.raises(ValueError):
        keep_latest(df, ["k"], ["t"], ties="some")
