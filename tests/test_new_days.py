"""Recomputing by days of receipt."""

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clickmill.functions import date_parts
from clickmill.operators import activity_by_product, visitors_by_product
from clickmill.plans import jobs
from clickmill.plans.clicks import clicks
from clickmill.schema import ACTIVITY, BATCH_TABLES, INGEST_DATE
from clickmill.sources import close_day

FIRST = date(2024, 2, 1)


def day(i):
    return FIRST + timedelta(days=i)


@pytest.fixture
def place(spark, tmp_path):
    """Where clicks land, and a database of its own with its location."""
    name = f"days_{re.sub(r'[^a-z0-9]', '_', tmp_path.name.lower())}"
    yield f"{tmp_path}/landed", f"{tmp_path}/batch", name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def land(rows, i, path):
    rows.select(*ACTIVITY.names, *date_parts(day(i))).write.mode("append").partitionBy(*INGEST_DATE).parquet(path)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def tables(spark, database):
    return [rows_of(spark.table(f"{database}.{name}").drop("hour_day")) for name in BATCH_TABLES]


def expected(rows):
    keyed = rows.where("product is not null and timestamp_hour is not null")
    return [rows_of(activity_by_product(keyed)), rows_of(visitors_by_product(keyed))]


def test_runs_over_growing_input_equal_a_full_recompute(spark, sf_dir, place):
    landed, location, database = place
    rows = clicks(spark, sf_dir)
    # Unkeyed clicks, unknown visitors, and clicks that were received days late.
    rows = rows.withColumn("product", F.when(F.col("event_id") % 50 > 0, F.col("product"))).withColumn("visitor", F.when(F.col("event_id") % 7 > 0, F.col("visitor")))
    seen = None
    for i in range(3):
        part = rows.where(F.col("event_id") % 4 == i)
        land(part, i, landed)
        seen = part if seen is None else seen.unionByName(part)
        assert jobs.batch_new_days(spark, landed, location, day(i), database=database) == [day(i)]
        assert tables(spark, database) == expected(seen)
    assert jobs.batch_new_days(spark, landed, location, day(2), database=database) == []
    # A day that is not over waits.
    land(rows.where("event_id % 4 = 3"), 3, landed)
    assert jobs.batch_new_days(spark, landed, location, day(2), database=database) == []
    assert jobs.batch_new_days(spark, landed, location, day(9), database=database) == [day(3)]
    assert tables(spark, database) == expected(rows)


def test_only_new_days_and_touched_days_are_read(spark, sf_dir, place, monkeypatch):
    landed, location, database = place
    rows = clicks(spark, sf_dir)
    old = rows.where("eventtime < 1705276800000")
    for i, part in enumerate((old, rows.where("eventtime >= 1705276800000"))):
        land(part, i, landed)
    visits = jobs.visits_of_days(spark, landed, [day(1)])
    text = visits._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*make_date", text)
    received = visits.select("ingest_day", F.input_file_name()).distinct()
    assert {r["ingest_day"] for r in received.collect()} == {day(1)}
    jobs.batch_new_days(spark, landed, location, day(0), database=database)
    files = [set(spark.table(f"{database}.{name}").inputFiles()) for name in BATCH_TABLES]
    jobs.batch_new_days(spark, landed, location, day(1), database=database)
    for name, before in zip(BATCH_TABLES, files):
        spark.catalog.refreshTable(f"{database}.{name}")
        after = set(spark.table(f"{database}.{name}").inputFiles())
        # Days of the first half are as they were.
        assert before <= after and len(after) > len(before)
    assert tables(spark, database) == expected(rows)


@pytest.mark.parametrize("step", ["overwrite_days", "write_table", "delete"])
def test_a_run_that_stopped_is_made_good(spark, sf_dir, place, monkeypatch, step):
    landed, location, database = place
    rows = clicks(spark, sf_dir).where("event_id < 3000")
    land(rows.where("event_id % 2 = 0"), 0, landed)
    jobs.batch_new_days(spark, landed, location, day(0), database=database)
    land(rows.where("event_id % 2 = 1"), 1, landed)
    real, calls = getattr(jobs, step), []

    def once_more(*arguments, **options):
        calls.append(step)
        if len(calls) == (3 if step == "overwrite_days" else 1):
            raise RuntimeError("lost")
        return real(*arguments, **options)

    with monkeypatch.context() as patch:
        patch.setattr(jobs, step, once_more)
        with pytest.raises(RuntimeError, match="lost"):
            jobs.batch_new_days(spark, landed, location, day(1), database=database)
    # What fails after the days were noted as read leaves nothing to do.
    assert jobs.batch_new_days(spark, landed, location, day(1), database=database) == ([] if step == "delete" else [day(1)])
    assert tables(spark, database) == expected(rows)


def test_closed_days_are_found_and_read(spark, sf_dir, place):
    landed, location, database = place
    rows = clicks(spark, sf_dir)
    land(rows, 0, landed)
    close_day(spark, landed, f"{location}-closed", day(0), files=2)
    assert jobs.batch_new_days(spark, landed, location, day(0), f"{location}-closed", database=database) == [day(0)]
    assert tables(spark, database) == expected(rows)


def test_nothing_landed(spark, place):
    landed, location, database = place
    assert jobs.batch_new_days(spark, landed, location, day(0), database=database) == []
    assert tables(spark, database) == [[], []]


def test_tasks_do_not_depend_on_how_few_buckets_there_are(spark, sf_dir, place):
    landed, location, database = place
    land(clicks(spark, sf_dir), 0, landed)
    jobs.batch_new_days(spark, landed, location, day(0), database=database, buckets=1)
    visits = spark.table(f"{database}.{jobs.VISITS_TABLE}")
    for table in (visits, *(spark.table(f"{database}.{name}") for name in BATCH_TABLES)):
        files = [file.rsplit("/", 1) for file in table.inputFiles()]
        # One file for the one bucket of a day, written by several tasks.
        assert len({folder for folder, _ in files}) == len(files)
        assert len({name[:10] for _, name in files}) > 2
    days = [r[0] for r in visits.select("hour_day").distinct().collect()]
    assert "Bucketed: true" not in jobs.rollup_of_days(visits, days)._jdf.queryExecution().executedPlan().toString()
