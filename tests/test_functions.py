from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickmill.functions import (
    classify_action,
    date_parts,
    decode_clicks,
    delimited_fields,
    delimited_line,
    encode_json,
    encode_tsv,
    hour_bucket,
    hour_bucket_literal,
    hour_day,
    previous_page,
    within_hours,
)
from clickmill.schema import ACTIVITY, CLICK_EVENT, KAFKA_ROW

EMPTY = dict.fromkeys(ACTIVITY.names)


PAYLOADS = pytest.mark.parametrize(
    ("payload", "expected"),
    [
        ("not json", {}),
        ('{"eventTime" 1', {}),
        ('{"eventTime":3600001,"product":"x","page":"cut of', {}),
        ('{"eventTime":3600001,"product":"x"', {}),
        ('{"product":"x","page":}', {}),
        ("[]", {}),
        ("", {}),
        (None, {}),
        ('{"eventTime":"5","action":"x"}', {"action": "x"}),
        ('{"eventTime":1.5,"page":"p"}', {"page": "p"}),
        ('{"eventtime":7}', {}),
        ('{"action":"x","extra":1}', {"action": "x"}),
        ('{"eventTime":3600001}', {"eventtime": 3600001, "timestamp_hour": 3600000}),
    ],
)


def decoded(spark, payload, **options):
    rows = spark.createDataFrame([(payload,)], "value string")
    return decode_clicks(rows.withColumn("value", F.col("value").cast("binary")), **options).first().asDict()


@PAYLOADS
def test_decode_edge_payloads(spark, payload, expected):
    assert decoded(spark, payload) == EMPTY | expected


@PAYLOADS
def test_decoding_fewer_columns_changes_none(spark, payload, expected):
    for columns in (["product", "timestamp_hour", "action"], ["page"], ["eventtime", "product"]):
        whole = EMPTY | expected
        assert decoded(spark, payload, columns=columns) == {name: whole[name] for name in columns}


def test_json_round_trip_keeps_every_field(spark):
    click = (1588003200000, "Internal", "purchase", "Page-3", "Visitor-9", "Page-1",
             'Trident,"White Gum, Spearmint"', 1588003200000)
    rows = spark.createDataFrame([click], ACTIVITY)
    encoded = rows.select(encode_json().cast("binary").alias("value"))
    assert tuple(decode_clicks(encoded).first()) == click


def test_json_names_order_and_nulls(spark):
    rows = spark.createDataFrame([(5, None, "a", "", "v", "p", "x", 0)], ACTIVITY)
    assert rows.select(encode_json()).first()[0] == (
        '{"eventTime":5,"referrer":null,"action":"a","prevPage":"","visitor":"v","page":"p","product":"x"}'
    )


def test_tsv(spark):
    rows = spark.createDataFrame([(5, "Bing", "a", "", "v", "p", "x,y", 0)], ACTIVITY)
    assert rows.select(encode_tsv()).first()[0] == "5\tBing\ta\t\tv\tp\tx,y"


@pytest.mark.parametrize(
    ("millis", "hour"),
    [
        (1588003199999, 1587999600000),
        (1588003200000, 1588003200000),
        (0, 0),
        (-1, -3600000),
        (None, None),
    ],
)
def test_hour_bucket(spark, millis, hour):
    row = spark.createDataFrame([(millis,)], "t bigint").select(hour_bucket("t").alias("h"))
    assert row.schema["h"].dataType.simpleString() == "bigint"
    assert row.first().h == hour


def test_dividing_as_doubles_does_not_truncate(spark):
    times = spark.range(1588003200000, 1588003300000)
    both = times.select(hour_bucket("id").alias("a"), hour_bucket_literal("id").alias("b"))
    assert both.select("a").distinct().count() == 1
    assert both.select("b").distinct().count() == 100_000


def test_within_hours_keeps_the_boundary(spark):
    now = 1706616000
    hours = spark.createDataFrame([((now - h * 3600) * 1000,) for h in range(10)], "timestamp_hour bigint")
    assert hours.where(within_hours(6, now)).count() == 7
    assert hours.where(within_hours(6)).count() == 0


def test_date_parts(spark):
    row = spark.range(1).select(*date_parts(date(2024, 2, 9))).first()
    assert row.asDict() == {"year": 2024, "month": 2, "day": 9}
    today = spark.range(1).select(*date_parts(), F.current_date().alias("d")).first()
    assert date(today.year, today.month, today.day) == today.d


def test_delimited_fields_give_null_for_bad_or_missing_parts(spark):
    schema = StructType.fromDDL("id bigint, at timestamp_ntz, name string, n int")
    lines = ["7;2024-01-02 03:04:05;a;5", "x;never;b;1.5", "8", "9;;;", ""]
    rows = spark.createDataFrame([(line,) for line in lines], "line string")
    parsed = [tuple(r) for r in rows.select(*delimited_fields("line", schema)).collect()]
    assert parsed[0][0] == 7 and parsed[0][1].hour == 3 and parsed[0][2:] == ("a", 5)
    assert parsed[1] == (None, None, "b", None)
    assert parsed[2] == (8, None, None, None)
    assert parsed[3] == (9, None, "", None)
    assert parsed[4] == (None, None, None, None)


def test_null_fields_keep_their_place(spark):
    schema = StructType.fromDDL("id bigint, a string, b string, n int")
    rows = spark.createDataFrame([(1, None, "b", 2), (None, "", None, None)], schema)
    lines = rows.select(delimited_line(rows.columns).alias("line"))
    assert [r.line for r in lines.collect()] == ["1;\\N;b;2", "\\N;;\\N;\\N"]
    parsed = lines.select(*delimited_fields("line", schema))
    assert [tuple(r) for r in parsed.collect()] == [tuple(r) for r in rows.collect()]


def test_tsv_of_an_event_with_nulls(spark):
    rows = spark.createDataFrame([(5, None, "a", "", "v", "p", None, 0)], ACTIVITY)
    assert rows.select(encode_tsv()).first()[0] == "5\t\\N\ta\t\tv\tp\t\\N"


def test_delimiter_is_no_pattern(spark):
    schema = StructType.fromDDL("a string, b int")
    rows = spark.createDataFrame([("x.y|3",)], "line string")
    assert tuple(rows.select(*delimited_fields("line", schema, "|")).first()) == ("x.y", 3)


def test_previous_page_only_from_inside(spark):
    rows = spark.createDataFrame([("Internal",), ("Google",), (None,)], "referrer string")
    pages = rows.select(previous_page("referrer", F.lit("Page-1")).alias("p")).collect()
    assert [r.p for r in pages] == ["Page-1", "", ""]


def test_classify_action(spark):
    actions = spark.range(1, 6).select(classify_action(F.col("id"), F.lit(4)).alias("a")).collect()
    assert [r.a for r in actions] == ["add_to_cart", "page_view", "page_view", "purchase", "add_to_cart"]


def test_wire_contracts():
    assert KAFKA_ROW.simpleString() == (
        "struct<key:binary,value:binary,topic:string,partition:int,offset:bigint,"
        "timestamp:timestamp,timestampType:int>"
    )
    assert CLICK_EVENT.names == [
        "eventTime", "referrer", "action", "prevPage", "visitor", "page", "product",
    ]
    assert all(field.nullable for s in (KAFKA_ROW, CLICK_EVENT, ACTIVITY) for field in s)



def test_hour_day(spark):
    hours = {0: "1970-01-01", -3_600_000: "1969-12-31", 86_400_000: "1970-01-02", 1_706_655_600_000: "2024-01-30", 10**18: "9999-12-31", -(10**18): "1600-01-01", None: None}
    frame = spark.createDataFrame([(h,) for h in hours], "h long")
    assert {r.h: r.d for r in frame.select("h", hour_day("h").cast("string").alias("d")).collect()} == hours
