"""What the physical plans must and must not hold at scale."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from clickmill.functions import decode_clicks, hour_day, within_hours
from clickmill.operators import (
    activity_by_product,
    apply_updates,
    estimate_visitors,
    last_write_per_key,
    latest_hours,
    merge,
    merge_in_place,
    missing_rows,
    not_in,
    rollup_by_product,
    serve_sketches,
    visitor_sketches,
    visitors_by_product,
)
from clickmill.plans.clicks import clicks, kafka_rows
from clickmill.plans.queries import QUERIES
from clickmill.schema import ACTIVITY, ACTIVITY_BY_PRODUCT, KEYS, VISITOR_SKETCHES
from clickmill.sources import create_keyed_table, landed, overwrite_days
from clickmill.streaming import DayTable

PLAIN = [n for n in QUERIES if "stream" not in n and n not in ("watermarked_hourly", "ingest_formats")]


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Clicks landed by day, and two aggregate tables made of them."""
    path = tmp_path_factory.mktemp("stored")
    rows = clicks(spark, sf_dir).select(ACTIVITY.names)
    for day in (1, 2):
        rows.write.parquet(f"{path}/landed/year=2024/month=2/day={day}")
    for name in ("batch", "speed"):
        activity_by_product(rows).write.parquet(f"{path}/{name}")
    return str(path)


@pytest.fixture
def activity(spark, stored):
    return landed(spark, f"{stored}/landed")


@pytest.fixture
def tables(spark, stored):
    # Statistics of small files would make every join a broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.read.parquet(f"{stored}/batch"), spark.read.parquet(f"{stored}/speed")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(text):
    return re.findall(r"Exchange (\w+)\((.*?), \d+\)", text)


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_no_cross_join_no_single_task(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for unwanted in ("Python", "InPandas", "NestedLoop", "Cartesian", "Exchange SinglePartition"):
        assert unwanted not in text


def test_counts_read_three_columns_and_shuffle_once(activity):
    text = plan(activity_by_product(activity))
    assert "ReadSchema: struct<action:string,product:string,timestamp_hour:bigint>" in text
    assert len(exchanges(text)) == 1 and "partial_sum" in text


def test_distinct_count_spreads_a_hot_key_by_visitor(activity):
    for frame in (visitors_by_product(activity), rollup_by_product(activity)):
        spread, by_key = sorted((keys for _, keys in exchanges(plan(frame))), key=len, reverse=True)
        assert spread.count("#") == 3 and by_key.count("#") == 2


def test_rows_are_ranked_before_the_shuffle(activity):
    for frame in (
        last_write_per_key(activity, ["eventtime", "visitor"]),
        latest_hours(activity_by_product(activity), 3),
    ):
        text = plan(frame)
        assert text.index("Final") < text.rindex("Exchange")
        assert re.search(r"WindowGroupLimit .*Partial", text)


def test_recent_hours_reach_the_scan(activity):
    assert "GreaterThanOrEqual(timestamp_hour" in plan(activity.where(within_hours(6, 1706616000)))
    assert "GreaterThanOrEqual(timestamp_hour" in plan(activity.where(within_hours(6)))


def test_ingest_dates_prune_partitions(spark, stored):
    one_day = landed(spark, f"{stored}/landed", since=date(2024, 2, 2))
    assert re.search(r"PartitionFilters: \[.*make_date", plan(one_day))
    assert [r.day for r in one_day.select("day").distinct().collect()] == [2]


def test_each_payload_is_parsed_once(spark, sf_dir):
    rows = decode_clicks(kafka_rows(clicks(spark, sf_dir)))
    assert plan(rows).count("from_json(") == 1
    assert plan(activity_by_product(rows)).count("from_json(") == 1


def test_decoding_needs_no_shuffle(spark, sf_dir):
    assert "Exchange" not in plan(decode_clicks(kafka_rows(clicks(spark, sf_dir))))


def test_speed_counts_decode_three_fields(spark, sf_dir):
    rows = kafka_rows(clicks(spark, sf_dir))
    text = plan(activity_by_product(decode_clicks(rows, columns=[*KEYS, "action"])))
    fields = re.search(r"from_json\((.*?), cast", text)[1]
    assert re.findall(r"StructField\((\w+)", fields) == ["eventTime", "action", "product"]


def test_merge_shuffles_once(tables):
    text = plan(merge(*tables))
    assert len(exchanges(text)) == 1 and "Join" not in text


def test_ordered_merge_still_shuffles_once(tables):
    text = plan(merge(*tables, ordered=True))
    assert [kind for kind, _ in exchanges(text)] == ["rangepartitioning"]
    assert "HashAggregate" in text and text.index("Sort") < text.index("HashAggregate")


def test_cutoff_reaches_both_scans(tables):
    text = plan(merge(*tables, cutoff_hour=5))
    assert "LessThan(timestamp_hour,5)" in text
    assert "GreaterThanOrEqual(timestamp_hour,5)" in text


def test_update_and_insert_join_on_equal_keys(tables):
    for frame in (apply_updates(*tables), missing_rows(*tables), not_in(*tables)):
        text = plan(frame)
        assert "SortMergeJoin" in text and "NestedLoop" not in text


def test_not_in_shuffles_whole_rows_by_two_columns(tables):
    """By the key, then by one column and a salt of the other; only rows with a NULL go by one column."""
    batch, speed = tables
    text = plan(not_in(speed, batch))
    keys = [re.sub(r"#\d+L?", "", k) for kind, k in exchanges(text) if kind == "hashpartitioning"]
    by_one = [k for k in keys if "," not in k]
    assert {"product, timestamp_hour", "product, _salt", "timestamp_hour, _salt"} <= set(keys)
    # Two sides for rows with a NULL, and one for each list of distinct values.
    assert len(by_one) <= 8 and "NestedLoop" not in text
    whole = [k for k in keys if "," in k]
    assert len(whole) >= 6


def test_the_second_delivery_is_not_planned_away(spark, sf_dir):
    text = plan(QUERIES["dedup_events"](spark, sf_dir))
    assert "Union" in text and text.count("FileScan") == 2


def test_recent_hours_skip_row_groups_of_closed_days(spark, sf_dir):
    frame = QUERIES["recent_hours"](spark, sf_dir)
    assert "GreaterThanOrEqual(timestamp_hour" in plan(frame)
    rows = clicks(spark, sf_dir).count()
    read = []

    def walk(node):
        if "FileScan" in node.nodeName() or "Scan" in node.nodeName():
            read.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    assert frame.count() > 0
    done = frame._jdf.queryExecution()
    done.toRdd().count()
    walk(done.executedPlan())
    assert 0 < sum(read) < rows / 2


def test_a_day_table_reads_only_the_days_asked_for(spark, tmp_path):
    table = DayTable(spark, f"t_{tmp_path.name}", str(tmp_path / "t"), ACTIVITY_BY_PRODUCT)
    day = 24 * 3_600_000
    table.upsert(spark.createDataFrame([("a", i * day, 1, 1, 1) for i in range(3)], ACTIVITY_BY_PRODUCT), 0)
    text = plan(table.read(since_hour=2 * day))
    assert "PartitionFilters: [isnotnull(hour_day" in text and "GreaterThanOrEqual(timestamp_hour,172800000)" in text
    assert "Exchange" not in plan(table.read())


@pytest.fixture
def in_buckets(spark, stored, tmp_path):
    """Tables by day and in equal buckets, as the speed layer and a recompute of new days keep them, never broadcast."""
    found = []
    for name in ("batch", "speed"):
        table = f"{name}_{tmp_path.name}"
        create_keyed_table(spark, table, ACTIVITY_BY_PRODUCT, str(tmp_path / name), 4, by_day=True)
        rows = spark.read.parquet(f"{stored}/{name}")
        overwrite_days(rows.withColumn("hour_day", hour_day("timestamp_hour")), table, 4)
        found.append(spark.table(table).drop("hour_day"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield found
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("join", [apply_updates, missing_rows, merge_in_place])
def test_tables_in_equal_buckets_are_joined_without_a_shuffle(in_buckets, join):
    text = plan(join(*in_buckets))
    assert "SortMergeJoin" in text and "Exchange" not in text and text.count("Bucketed: true") == 2


def test_merging_in_place_is_merging(in_buckets):
    batch, speed = in_buckets
    speed = speed.where("timestamp_hour % 7200000 = 0").unionByName(speed.where("product = 'Product-1'").limit(5).withColumn("product", F.lit("new")))
    found, expected = merge_in_place(batch, speed), merge(batch, speed)
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_sketches_are_united_in_one_shuffle(spark, sf_dir):
    rows = clicks(spark, sf_dir).select(ACTIVITY.names)
    sides = [spark.createDataFrame([], VISITOR_SKETCHES)] * 2
    text = plan(serve_sketches(*sides, cutoff_hour=5))
    assert len(exchanges(text)) == 1 and "visitors" in text
    assert "hll_union_agg" in text
    twice = estimate_visitors(serve_sketches(visitor_sketches(rows), visitor_sketches(rows)))
    once = estimate_visitors(visitor_sketches(rows))
    assert twice.exceptAll(once).count() == 0 and twice.count() == once.count()
