from datetime import date

import pytest

from clickmill import __main__ as command
from clickmill.functions import date_parts
from clickmill.operators import activity_by_product, estimate_visitors, visitor_sketches
from clickmill.plans import speed_visitors
from clickmill.plans.clicks import clicks, deliver, kafka_stream
from clickmill.schema import ACTIVITY, ACTIVITY_BY_PRODUCT, INGEST_DATE, VISITORS_BY_PRODUCT
from clickmill.streaming import DayTable

DAY = date(2024, 2, 1)


@pytest.fixture
def run(spark, monkeypatch):
    def call(*arguments):
        monkeypatch.setattr("sys.argv", ["clickmill", *arguments])
        monkeypatch.setattr(command, "configure", lambda builder, *confs: builder)
        command.main()

    return call


def test_batch_and_serve(spark, sf_dir, run, tmp_path):
    rows = clicks(spark, sf_dir)
    rows.select(*ACTIVITY.names, *date_parts(DAY)).write.partitionBy(*INGEST_DATE).parquet(f"{tmp_path}/landed")
    run("close", "--landed", f"{tmp_path}/landed", "--closed", f"{tmp_path}/closed", "--day", "2024-02-01", "--files", "2")
    run("batch", "--landed", f"{tmp_path}/landed", "--location", f"{tmp_path}/out", "--database", "main_db",
        "--closed", f"{tmp_path}/closed", "--rejects", "--sketches", "--buckets", "4")
    for name, table in (("activity_by_product", activity_by_product), ("visitor_sketches", visitor_sketches)):
        found = table(rows)
        speed = DayTable(spark, f"main_db.stream_{name}", f"{tmp_path}/{name}", found.schema, buckets=4)
        speed.upsert(found, 0)
    serve = ["serve", "--database", "main_db", "--location", f"{tmp_path}/serving"]
    run(*serve, "--visitors", "--table", "serving_visitors")
    served = spark.table("main_db.serving_visitors").drop("visitors")
    # Every click is in both sketches and counts once.
    expected = estimate_visitors(visitor_sketches(rows))
    assert served.count() == expected.count() and served.exceptAll(expected).count() == 0
    # Both sides hold every click: as the batch job states its cutoff, none counts twice.
    for cutoff in ([], ["--cutoff-hour", "1705276800000"]):
        run(*serve, *cutoff)
        served = spark.table("main_db.serving_layer")
        assert served.exceptAll(activity_by_product(rows)).count() == 0
        assert served.count() == activity_by_product(rows).count()
    run(*serve, "--additive")
    total = spark.table("main_db.serving_layer").agg({"purchase_count": "sum"}).first()[0]
    assert total == 2 * rows.where("action = 'purchase'").count()
    with pytest.raises(SystemExit):
        run(*serve, "--additive", "--cutoff-hour", "5")
    spark.sql("DROP DATABASE main_db CASCADE")


@pytest.mark.parametrize(
    "job",
    [
        ["ingest", "--keep-payload", "--keep-position", "--files", "4"],
        ["speed", "activity", "--delay", "2 days"],
        ["speed", "visitors", "--delay", "2 days"],
        ["speed", "clicks", "--kafka-option", "kafka.security.protocol=SSL"],
    ],
)
def test_streams_read_kafka(run, tmp_path, job):
    with pytest.raises(Exception, match="kafka"):
        run(*job, "--servers", "h:1", "--topic", "clicks", "--path", f"{tmp_path}/t",
            "--checkpoint", f"{tmp_path}/c", "--every", "60 seconds", *(["--database", "main_db"] if job[0] == "speed" else []))


def test_visitors_take_a_delay_and_clicks_refuse_one(spark, sf_dir, run, monkeypatch, tmp_path):
    deliver(spark, sf_dir, f"{tmp_path}/topic")
    monkeypatch.setattr(command, "kafka_stream", lambda spark, *a, **b: kafka_stream(spark, f"{tmp_path}/topic"))
    options = ["--servers", "h:1", "--topic", "clicks", "--delay", "1 day", "--database", "main_db"]
    with pytest.raises(SystemExit):
        run("speed", "clicks", *options, "--path", f"{tmp_path}/k", "--checkpoint", f"{tmp_path}/kc")
    started = []

    def once(rows, table, checkpoint, trigger=None, **options):
        query = speed_visitors(rows, table, checkpoint, trigger={"availableNow": True}, **options)
        started.append(table)
        return query

    monkeypatch.setitem(command.SPEED, "visitors", (once, "stream_visitors_by_product", VISITORS_BY_PRODUCT, None))
    run("speed", "visitors", *options, "--path", f"{tmp_path}/t", "--checkpoint", f"{tmp_path}/c")
    assert started[0].read().count() == activity_by_product(clicks(spark, sf_dir)).count()
    spark.sql("DROP DATABASE main_db CASCADE")


def test_days_are_read_once(spark, sf_dir, run, tmp_path):
    rows = clicks(spark, sf_dir)
    rows.select(*ACTIVITY.names, *date_parts(DAY)).write.partitionBy(*INGEST_DATE).parquet(f"{tmp_path}/landed")
    for _ in range(2):
        run("days", "--landed", f"{tmp_path}/landed", "--database", "days_db", "--location", f"{tmp_path}/out", "--until", "2024-02-01")
    found = spark.table("days_db.batch_activity_by_product").drop("hour_day")
    assert found.exceptAll(activity_by_product(rows)).count() == 0
    assert spark.table("days_db.batch_consumed_days").count() == 1
    spark.sql("DROP DATABASE days_db CASCADE")


def test_kafka_options_need_a_value(run, tmp_path):
    with pytest.raises(SystemExit):
        run("ingest", "--servers", "h:1", "--topic", "c", "--path", "p", "--checkpoint", "c", "--kafka-option", "x")


def test_unknown_job(run):
    with pytest.raises(SystemExit):
        run("unknown")
