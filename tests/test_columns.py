import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom import functions as fn

D = datetime.datetime


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_utc_wall_clock_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT '2024-01-01 02:00:00 America/Los_Angeles' AS region, '  2024-01-01 02:00:00 PST' AS short,"
            " '   2024-01-01 10:00:00' AS padded, timestamp_seconds(1704103200) AS moment, timestamp_ntz'2024-01-01 10:00:00' AS wall,"
            " '2024-01-01T10:00:00Z' AS zulu, '2024-01-01T15:30:00+05:30' AS east,"
            " '2024-01-01T03:00:00-07:00' AS west, '2024-01-01 10:00:00' AS bare, '2024-01-01' AS day"
        )
        out = df.select(
            fn.as_utc("moment", "timestamp"),
            fn.as_utc("wall"),
            *[fn.as_utc(c, "string") for c in ("zulu", "east", "west", "bare", "region", "short", "padded")],
            fn.as_utc("day", "string"),
            fn.from_epoch_ms(F.lit(1704103200123)),
        ).first()
        assert list(out[:9]) == [D(2024, 1, 1, 10)] * 9
        assert out[9] == D(2024, 1, 1)
        assert out[10] == D(2024, 1, 1, 10, 0, 0, 123000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_an_unknown_zone_is_an_error(spark):
    df = spark.sql("SELECT '2024-01-01 10:00:00 Nowhere/Land' AS text")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(fn.as_utc("text", "string")).collect()


def test_shift_changes_the_day_key(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp_ntz'2024-03-10 23:30:00', timestamp_ntz'2024-03-10 00:30:00', NULL)) AS t"
    )
    days = [r[0] for r in df.select(fn.day_of(fn.shift_hours("t", -7))).collect()]
    assert days == [datetime.date(2024, 3, 10), datetime.date(2024, 3, 9), None]


def test_intervals(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-31 00:00:00' AS t")
    out = df.select(fn.add_interval("t", 1, "month"), fn.add_interval("t", -1, "second")).first()
    assert list(out) == [D(2024, 2, 29), D(2024, 1, 30, 23, 59, 59)]


def test_leaf_casts(spark):
    df = spark.sql("SELECT 1.5D AS a, 2.5D AS b, -1.6D AS c, '12' AS d, '1.25' AS e, 'x' AS f")
    out = df.select(
        *[fn.cast_leaf(c, "integer", "double") for c in "abc"],
        fn.cast_leaf("d", "integer"),
        fn.cast_leaf("e", "numeric"),
        fn.cast_leaf("f", "integer", safe=True),
    ).first()
    assert list(out) == [2, 3, -2, 12, Decimal("1.250000000"), None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(fn.cast_leaf("f", "integer")).collect()


def test_country_and_defaults(spark):
    df = spark.createDataFrame([("UK",), ("Amazon.de",), (None,)], "m string")
    assert [r[0] for r in df.select(fn.country_name("m")).collect()] == ["United Kingdom", "Amazon.de", None]
    assert [r[0] for r in df.select(fn.default_key("m")).collect()] == ["UK", "Amazon.de", "N/A"]


def test_json_values(spark):
    df = spark.createDataFrame([('{"a":{"b":"7"},"c":2}',), ("broken",)], "j string")
    v = fn.parse_json_text("j", safe=True)
    out = df.select(
        fn.json_field(v, "a.b", "integer"), fn.json_field(v, "c", "numeric"), fn.json_field(v, "zz")
    ).collect()
    assert [tuple(r) for r in out] == [(7, Decimal("2.000000000"), None), (None, None, None)]
