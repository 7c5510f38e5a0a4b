from tradeloom.operators import star_except, unnest, unnest_json


def test_outer_unnest_keeps_every_parent_at_every_level(spark, rows):
    df = spark.sql(
        """SELECT * FROM VALUES
        (1, array(named_struct('b', array(named_struct('c', 1), named_struct('c', 2))))),
        (2, array(named_struct('b', cast(array() AS array<struct<c:int>>)))),
        (3, array(named_struct('b', cast(NULL AS array<struct<c:int>>)))),
        (4, cast(array() AS array<struct<b:array<struct<c:int>>>>)),
        (5, NULL),
        (6, array(cast(NULL AS struct<b:array<struct<c:int>>>)))
        AS t(id, a)"""
    )
    flat = unnest(unnest(df, "a"), "a.b")
    assert rows(flat, "id", "b.c") == [(1, 1), (1, 2), (2, None), (3, None), (4, None), (5, None), (6, None)]


def test_siblings_multiply_and_empty_siblings_do_not_drop(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, array(1, 2), array(1, 2, 3)),
        (2, cast(array() AS array<int>), array(1, 2, 3)) AS t(id, x, y)"""
    )
    flat = unnest(unnest(df, "x"), "y")
    assert flat.where("id = 1").count() == 6
    assert flat.where("id = 2").count() == 3


def test_json_flatten_inner_drops_and_outer_keeps(spark, rows):
    df = spark.createDataFrame([(1, "[1,2]"), (2, "[]"), (3, None)], "id int, j string")
    inner = unnest_json(df, "j").selectExpr("id", "cast(value AS int) AS v")
    outer = unnest_json(df, "j", outer=True).selectExpr("id", "cast(value AS int) AS v")
    assert rows(inner) == [(1, 1), (1, 2)]
    assert rows(outer) == [(1, 1), (1, 2), (2, None), (3, None)]


def test_star_except(spark):
    assert star_except(spark.range(1).selectExpr("id", "1 AS a", "2 AS b"), ["a"]).columns == ["id", "b"]
