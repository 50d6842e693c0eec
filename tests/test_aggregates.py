import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickmill.operators import (
    activity_by_product,
    approx_visitors_by_product,
    distinct_keys,
    drop_duplicate_events,
    estimate_visitors,
    last_write_per_key,
    latest_hours,
    merge_sketches,
    rollup_by_product,
    split_malformed,
    visitor_sketches,
    visitors_by_product,
)
from clickmill.schema import COUNTS, KEYS

SMALL = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
CLICK = "product string, timestamp_hour bigint, action string, visitor string, eventtime bigint"
clicks_of = st.lists(
    st.tuples(
        st.sampled_from([None, "a", "b"]),
        st.sampled_from([None, 0, 3600000]),
        st.sampled_from([None, "purchase", "add_to_cart", "page_view", "signup"]),
        st.sampled_from([None, "v1", "v2", "v3"]),
        st.integers(0, 20),
    ),
    max_size=30,
)


def brute_force(clicks):
    groups = {}
    for product, hour, action, visitor, _ in clicks:
        counts, visitors = groups.setdefault((product, hour), ([0, 0, 0], set()))
        for i, counted in enumerate(["purchase", "add_to_cart", "page_view"]):
            counts[i] += action == counted
        visitors |= {visitor} - {None}
    return {key: (*counts, len(visitors)) for key, (counts, visitors) in groups.items()}


def as_dict(rows, width=2):
    return {tuple(r)[:width]: tuple(r)[width:] for r in rows.collect()}


@SMALL
@given(clicks=clicks_of)
def test_aggregates_match_brute_force(spark, clicks):
    rows = spark.createDataFrame(clicks, CLICK)
    expected = brute_force(clicks)
    assert as_dict(rollup_by_product(rows)) == expected
    assert as_dict(activity_by_product(rows)) == {k: v[:3] for k, v in expected.items()}
    assert as_dict(visitors_by_product(rows)) == {k: v[3:] for k, v in expected.items()}
    # Sketches are exact for a handful of visitors, and hold none where all are NULL.
    assert as_dict(approx_visitors_by_product(rows)) == {k: v[3:] for k, v in expected.items()}
    assert {(r.product, r.timestamp_hour) for r in distinct_keys(rows).collect()} == set(expected)


@SMALL
@given(clicks=clicks_of)
def test_last_write_matches_brute_force(spark, clicks):
    rows = spark.createDataFrame(clicks, CLICK).withColumn("n", F.lit(0))
    numbered = spark.createDataFrame([(*c, i) for i, c in enumerate(clicks)], CLICK + ", n int")
    expected = {}
    for i, (product, hour, _, _, time) in enumerate(clicks):
        expected[product, hour] = max(expected.get((product, hour), (-1, -1)), (time, i))
    found = last_write_per_key(numbered, ["eventtime", "n"]).collect()
    assert {(r.product, r.timestamp_hour): (r.eventtime, r.n) for r in found} == expected
    assert last_write_per_key(rows, ["eventtime"]).count() == len(expected)


def test_counts_never_exceed_the_group(spark, sf_dir):
    from clickmill.plans.clicks import clicks

    rows = clicks(spark, sf_dir)
    sizes = rows.groupBy(*KEYS).agg(F.count("*").alias("n"))
    joined = activity_by_product(rows).join(sizes, KEYS)
    assert joined.where(sum(F.col(c) for c in COUNTS) > F.col("n")).count() == 0


def test_latest_hours(spark):
    rows = spark.createDataFrame(
        [("a", h * 3600000) for h in range(5)] + [("b", 0)], "product string, timestamp_hour bigint"
    )
    kept = {tuple(r) for r in latest_hours(rows, 3).collect()}
    assert kept == {("a", 14400000), ("a", 10800000), ("a", 7200000), ("b", 0)}


def test_sketches_of_overlapping_sets_count_visitors_once(spark):
    def activity(start, end):
        return spark.range(start, end).select(
            F.lit("a").alias("product"), F.lit(0).cast("bigint").alias("timestamp_hour"),
            F.concat(F.lit("v"), "id").alias("visitor"),
        )

    merged = merge_sketches(*(visitor_sketches(activity(*r)) for r in ((0, 600), (400, 1000))))
    assert estimate_visitors(merged).first().unique_visitors == pytest.approx(1000, rel=0.06)


def test_split_malformed_loses_nothing(spark):
    rows = spark.createDataFrame(
        [("a", 0), (None, 0), ("a", None), (None, None)], "product string, timestamp_hour bigint"
    )
    accepted, rejected = split_malformed(rows)
    assert [tuple(r) for r in accepted.collect()] == [("a", 0)]
    assert rejected.count() == 3


def test_drop_duplicates_keeps_one_of_each(spark):
    rows = spark.range(300).select((F.col("id") % 3).alias("offset"), F.lit(0).alias("partition"))
    assert drop_duplicate_events(rows, ["offset", "partition"]).count() == 3
