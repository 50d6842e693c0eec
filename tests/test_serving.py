from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickmill.operators import activity_by_product, apply_updates, merge, missing_rows, not_in
from clickmill.plans.clicks import clicks
from clickmill.schema import ACTIVITY_BY_PRODUCT

SMALL = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
pairs = st.lists(
    st.tuples(st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 1, 2, 3])), max_size=6
)


def surely_differs(x, y):
    return x is not None and y is not None and x != y


def sql_not_in(rows, listed):
    return sorted(
        (r for r in rows if all(any(map(surely_differs, r, other)) for other in listed)), key=str
    )


@SMALL
@given(rows=pairs, listed=pairs)
@example(rows=[(None, 1), ("a", None), (None, None), ("a", 1)], listed=[])
@example(rows=[(None, 1), ("a", None), (None, None), ("a", 1)], listed=[(None, None)])
@example(rows=[("a", 1), ("b", 2), ("c", 3)], listed=[("a", None), (None, 2)])
@example(rows=[(None, 2), ("c", 2), ("c", None)], listed=[("a", 1), (None, 9)])
def test_not_in_follows_three_valued_logic(spark, rows, listed):
    schema = "product string, timestamp_hour bigint"
    kept = not_in(spark.createDataFrame(rows, schema), spark.createDataFrame(listed, schema))
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sql_not_in(rows, listed)


def test_anti_join_keeps_what_not_in_drops(spark):
    schema = "product string, timestamp_hour bigint"
    rows = spark.createDataFrame([("b", None), ("c", 2), (None, 3)], schema)
    listed = spark.createDataFrame([("a", 1), (None, 9)], schema)
    assert missing_rows(listed, rows).count() == 3
    assert {tuple(r) for r in not_in(rows, listed).collect()} == {("c", 2), (None, 3)}


def tables(spark):
    batch = [("a", 0, 1, 2, 3), ("a", 3600000, 1, 0, 0)]
    speed = [("a", 3600000, 5, 5, 5), ("b", 3600000, 0, 0, 1)]
    return (spark.createDataFrame(rows, ACTIVITY_BY_PRODUCT) for rows in (batch, speed))


def rows_of(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_update_then_insert_is_the_merge(spark):
    batch, speed = tables(spark)
    updated = apply_updates(batch, speed)
    assert rows_of(updated) == [("a", 0, 1, 2, 3), ("a", 3600000, 6, 5, 5)]
    assert rows_of(missing_rows(batch, speed)) == [("b", 3600000, 0, 0, 1)]
    assert rows_of(updated.unionByName(missing_rows(batch, speed))) == rows_of(merge(batch, speed))


def test_cutoff_counts_no_event_twice(spark):
    batch, speed = tables(spark)
    assert rows_of(merge(batch, speed, 3600000)) == [
        ("a", 0, 1, 2, 3), ("a", 3600000, 5, 5, 5), ("b", 3600000, 0, 0, 1),
    ]


def test_merge_of_any_split_equals_the_direct_aggregate(spark, sf_dir):
    rows = clicks(spark, sf_dir)
    direct = rows_of(activity_by_product(rows))
    for side in (F.col("visitor") < "Visitor-5", F.col("action") == "purchase"):
        merged = merge(activity_by_product(rows.where(side)), activity_by_product(rows.where(~side)))
        assert rows_of(merged) == direct
        parts = (activity_by_product(rows.where(s)) for s in (side, ~side))
        assert rows_of(merge(*parts, ordered=True)) == direct
