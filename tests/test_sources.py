import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import Config
from tradeloom.plans import build, feed
from tradeloom.sources import (
    RawSource,
    conform,
    consolidate,
    discover_names,
    discover_paths,
    discover_tables,
    normalize_lineage,
    scan,
)
from tradeloom.sources.discovery import matches
from tradeloom.sources.raw import clip, tagged_scan


def test_discovery_by_name_skips_decoys(spark, rows):
    names = spark.createDataFrame(
        [
            ("c.s.Acme_US_Hub_FBAManageInventory",),
            ("c.s.acme_uk_hub_fbamanageinventory",),
            ("c.s.Acme_US_Hub_FBAManageInventoryHealthReport",),
            ("c.fbamanageinventory.Acme_US_Hub_Other",),
        ],
        "name string",
    )
    found = rows(discover_names(names, "%fbamanageinventory"), "tables")
    assert found == [
        ("c.s.Acme_US_Hub_FBAManageInventory",),
        ("c.s.acme_uk_hub_fbamanageinventory",),
    ]
    assert discover_names(names, "%listorder").isEmpty()


def test_discovery_of_folders_keeps_case(spark, tmp_path):
    for name in ("Acme_US_Hub_ListOrder", "Globex_UK_Hub_LISTORDER", "Acme_US_Hub_Other"):
        spark.range(1).write.parquet(f"{tmp_path}/{name}")
    found = discover_paths(spark, str(tmp_path), "%listorder")
    assert [s.name for s in found] == [
        "raw.landing.Acme_US_Hub_ListOrder",
        "raw.landing.Globex_UK_Hub_LISTORDER",
    ]
    assert found[0].brand_store(Config()) == ("Acme", "US")
    assert spark.read.parquet(found[1].path).count() == 1


def test_discovery_in_the_catalog(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS landing")
    for name in ("acme_us_hub_listorder", "acme_us_hub_listorderitems"):
        spark.sql(f"CREATE TABLE landing.{name} (x INT) USING parquet LOCATION '{tmp_path}/{name}'")
    found = discover_tables(spark, "%listorder", "landing")
    assert [s.table for s in found] == ["spark_catalog.landing.acme_us_hub_listorder"]
    spark.sql("DROP DATABASE landing CASCADE")


def test_brand_and_store_defaults():
    source = RawSource("c.s.Acme_US_Hub_ListOrder")
    assert source.brand_store(Config(brand_position=2)) == ("Hub", "US")
    fixed = Config(brand_from_name=False, default_brand="B", store_from_name=False, default_store="S")
    assert source.brand_store(fixed) == ("B", "S")


def test_lineage_spellings(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "conn_user_id int, _conn_batch_runtime int, CONN_batch_id int, x int")
    assert normalize_lineage(df, "conn").columns == ["_user_id", "_batch_runtime", "_batch_id", "x"]


def test_folder_scan_prunes_nested_fields_and_renames_lineage(spark, tmp_path):
    spark.sql(
        "SELECT array(named_struct('a', 1, 'b', array(named_struct('c', 'x', 'd', 'y')), 'e', 2)) AS items,"
        " 5L AS _conn_batch_runtime, 6L AS _conn_batch_id, 7L AS _conn_user_id, 'unused' AS other"
    ).write.parquet(f"{tmp_path}/t")
    schema = T.StructType.fromDDL(
        "items array<struct<b:array<struct<c:string>>>>, _user_id bigint, _batch_runtime bigint, _batch_id bigint"
    )
    df = scan(spark, RawSource("a.b.c_d", path=f"{tmp_path}/t"), schema, "conn")
    plan = df.where("_batch_runtime >= 5")._jdf.queryExecution().executedPlan().toString()
    assert "items:array<struct<b:array<struct<c:string>>>>" in plan
    assert "GreaterThanOrEqual(_conn_batch_runtime,5)" in plan
    assert df.first().asDict(recursive=True) == {
        "items": [{"b": [{"c": "x"}]}], "_user_id": 7, "_batch_runtime": 5, "_batch_id": 6,
    }


def test_folders_of_one_schema_are_one_scan(spark, tmp_path):
    lineage = "1L AS _user_id, 5L AS _batch_runtime, 6L AS _batch_id"
    for i in range(12):
        spark.sql(f"SELECT '{i}' AS a, {i % 2 == 0} AS other, 'p' AS day, {lineage}").write.partitionBy("day").parquet(f"{tmp_path}/B{i}_US_x")
    spark.sql(f"SELECT '77' AS a, 1 AS more, {lineage}").write.parquet(f"{tmp_path}/B77_UK_x")
    schema = T.StructType.fromDDL("a string, _user_id bigint, _batch_runtime bigint, _batch_id bigint")
    cfg = Config(convert_timezone=True, offset_hours={"RAW.landing.b3_us_x": -7})
    sources = discover_paths(spark, str(tmp_path), "b%_x")
    df = tagged_scan(spark, sources, schema, cfg, True, 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(sources) == 13 and plan.count("FileScan parquet") == 2
    assert "GreaterThanOrEqual(_batch_runtime,5)" in plan
    got = {(r.brand, r.store, r.a, r._offset_hours) for r in df.collect()}
    want = {(f"B{i}", "US", str(i), -7 if i == 3 else 0) for i in range(12)} | {("B77", "UK", "77", 0)}
    assert got == want
    assert len({r._source_no for r in df.collect()}) == 13


def test_folders_by_their_files_paths(spark, tmp_path):
    """Names that begin alike, blanks, equal names in different places, and one folder twice."""
    lineage = "1L AS _user_id, 5L AS _batch_runtime, 6L AS _batch_id"
    names = ["A_S_x", "A_S_x-1", "A_S_x_2", "A_S_x y", "A_S_xé", "other/A_S_x", "A_S_x.z"]
    for name in names:
        spark.sql(f"SELECT '{name}' AS a, {lineage}").write.parquet(f"{tmp_path}/{name}")
    schema = T.StructType.fromDDL("a string, _user_id bigint, _batch_runtime bigint, _batch_id bigint")
    sources = [RawSource(f"r.l.B{i}_S_x", path=f"{tmp_path}/{name}") for i, name in enumerate(names)]
    df = tagged_scan(spark, sources, schema, Config(), False, None)
    assert {(r.brand, r.a) for r in df.collect()} == {(f"B{i}", name) for i, name in enumerate(names)}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan parquet") == 1
    twice = [*sources, RawSource("r.l.In_S_x", path=f"{tmp_path}/other/A_S_x")]
    got = {(r.brand, r.a) for r in tagged_scan(spark, twice, schema, Config(), False, None).collect()}
    assert ("In", "other/A_S_x") in got and ("B5", "other/A_S_x") in got


def test_hundreds_of_folders_need_no_join(spark, tmp_path):
    lineage = "1L AS _user_id, 5L AS _batch_runtime, 6L AS _batch_id"
    spark.range(200).selectExpr("id AS a", *lineage.split(", "), "concat('B', id) AS t").repartition(8).write.partitionBy("t").parquet(f"{tmp_path}/all")
    schema = T.StructType.fromDDL("a bigint, _user_id bigint, _batch_runtime bigint, _batch_id bigint")
    sources = [RawSource(f"r.l.B{i}_S_x", path=f"{tmp_path}/all/t=B{i}") for i in range(200)]
    df = tagged_scan(spark, sources, schema, Config(), False, None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan parquet") == 1
    got = df.select("brand", "a", "_source_no").collect()
    assert sorted((r.brand, r.a, r._source_no) for r in got) == sorted((f"B{i}", i, i) for i in range(200))


def test_like_on_names():
    assert matches("Acme_US_ListOrder", "%listorder") and matches("aXb", "A_B") and not matches("ab", "a_b")
    assert not matches("a.b", "a_") and matches("a%b", "a%b")


def test_missing_fields_are_errors(spark, tmp_path):
    actual = T.StructType.fromDDL("a array<struct<b:int>>")
    with pytest.raises(ValueError, match="no field c"):
        clip(actual, T.StructType.fromDDL("a array<struct<c:int>>"))
    with pytest.raises(AnalysisException):
        conform(spark.range(1), T.StructType.fromDDL("missing string"))


def test_conform_reads_text_timestamps_and_json(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00+02:00", '[{"b":"x"}]')], "at string, items string")
    out = conform(df, T.StructType.fromDDL("at timestamp_ntz, items array<struct<b:string>>")).first()
    assert out.at == datetime.datetime(2024, 1, 1, 8)
    assert out["items"][0].b == "x"


def test_conform_reads_variant_columns(spark, tmp_path):
    rows = """[{"b": "x", "inner": [{"n": 1.5}, {"n": null}]}, {"inner": []}]"""
    spark.createDataFrame([(rows, '"2024-01-01T10:00:00+02:00"', "7"), (None, None, None), ("[]", "null", "8")], "items string, at string, n string").selectExpr(
        "parse_json(items) AS items", "parse_json(at) AS at", "parse_json(n) AS n"
    ).write.parquet(f"{tmp_path}/t")
    schema = T.StructType.fromDDL("items array<struct<b:string,inner:array<struct<n:double>>>>, at timestamp_ntz, n bigint")
    out = {r.n: r for r in scan(spark, RawSource("a.b.c_d", path=f"{tmp_path}/t"), schema).collect()}
    assert out[7]["items"][0].asDict(True) == {"b": "x", "inner": [{"n": 1.5}, {"n": None}]}
    assert out[7]["items"][1].asDict(True) == {"b": None, "inner": []} and out[7].at == datetime.datetime(2024, 1, 1, 8)
    assert out[None]["items"] is None and out[8]["items"] == [] and out[8].at is None
    broken = spark.sql("SELECT parse_json('{}') AS items")
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        conform(broken, T.StructType.fromDDL("items array<struct<b:string>>")).collect()


def test_consolidate(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    both = consolidate(spark, [a, a.select("v", "k")], a.schema)
    assert both.count() == 2 and both.columns == ["k", "v"]
    empty = consolidate(spark, [], a.schema)
    assert empty.isEmpty() and empty.schema == a.schema


def test_no_raw_table_gives_an_empty_frame_with_the_layout(spark):
    for name in ("ListOrder", "ListFinancialEventsOrderTaxes", "FBAReturnsReport"):
        item = feed(name)
        df = build(spark, item, [])
        assert df.isEmpty()
        assert df.columns == item.column_names()


def test_many_sources_share_one_literal_filter(spark):
    item = feed("FBAManageInventory")
    schema = T.StructType.fromDDL(item.raw_ddl)
    frame = spark.createDataFrame([], schema)
    df = build(spark, item, [RawSource(f"a.b.B{i}_S_x", frame=frame) for i in range(20)], loaded=5)
    assert df.columns == item.column_names()
    assert df.where(F.col("brand") == "B7").count() == 0
