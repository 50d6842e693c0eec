"""The jobs: landing raw clicks, the speed layer, the batch recompute and the serving table.

Streaming jobs take any frame of Kafka rows (schema.KAFKA_ROW) and return the running query.
Clicks without a key are landed but appear in no keyed table.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from clickmill.functions import date_parts, decode_clicks, hour_day, within_hours
from clickmill.operators import (
    action_counts,
    activity_by_product,
    approx_visitors_by_product,
    counted,
    drop_duplicate_events,
    has_key,
    key_order,
    merge,
    rollup_by_product,
    serve_sketches,
    split_malformed,
    visitor_sketches,
)
from clickmill.schema import (
    ACTIVITY,
    BATCH_TABLES,
    COUNTS,
    EVENT_COLUMNS,
    INGEST_DATE,
    KAFKA_ROW,
    KEYS,
    TABLES,
    VISITS,
)
from clickmill.session import new_folder
from clickmill.sources import (
    create_database,
    create_keyed_table,
    landed,
    landed_days,
    overwrite_days,
    publish,
    state_counts,
    state_cutoff,
    write_table,
)
from clickmill.sources.catalog import BUCKETS, DAY
from clickmill.sources.folders import delete
from clickmill.streaming import (
    DayTable,
    StoreTable,
    start_files,
    start_upsert,
    watermarked_counts,
    watermarked_sketches,
    watermarked_visitors,
)

ACTIVITY_TABLE, VISITORS_TABLE = BATCH_TABLES
SKETCH_TABLE, REJECTED_TABLE = "batch_visitor_sketches", "batch_rejected"
VISITS_TABLE, CONSUMED_TABLE = "batch_visits", "batch_consumed_days"
#: The newest event of a key counts, and of events at one time the one whose columns are largest.
CLICK_ORDER = EVENT_COLUMNS
POSITION = StructType([f for f in KAFKA_ROW if f.name in ("topic", "partition", "offset")])
PAYLOAD = StructField("payload", StringType())


def ingest(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    ingest_date: date | Column | None = None,
    file_format: str = "parquet",
    trigger: dict | None = None,
    name: str = "landing",
    keep_payload: bool = False,
    keep_position: bool = False,
    files: int | None = None,
) -> StreamingQuery:
    """Land decoded clicks by the day they are received; no row is left out.

    keep_payload adds the column `payload` with the text of those that got no key, so that
    what could not be read can be looked into later. keep_position adds POSITION, where a
    click stood in Kafka, by which batch can tell repeated deliveries. `files` bounds the
    files of a micro-batch, by a shuffle.
    """
    year, month, day = date_parts(ingest_date)
    extra = []
    if keep_payload:
        extra.append(F.when(~has_key(), F.col("value").cast("string")).alias(PAYLOAD.name))
    if keep_position:
        extra += [F.col(f.name) for f in POSITION]
    keep = ("value",) * keep_payload + tuple(POSITION.names) * keep_position
    activity = counted(decode_clicks(rows, keep=keep)).select(*ACTIVITY.names, *extra, day, month, year)
    return start_files(activity, path, checkpoint, file_format, trigger=trigger, name=name, files=files)


def speed_activity(
    rows: DataFrame,
    table: DayTable | StoreTable,
    checkpoint: str,
    delay: str | None = None,
    **options,
) -> StreamingQuery:
    """Keep running counts per product and hour.

    Without a delay all hours stay open and their state is kept for good. With one, such as
    "2 days", clicks that much behind the newest are no longer counted, nor their hours kept.
    """
    if delay is None:
        counts = activity_by_product(counted(decode_clicks(rows, columns=[*KEYS, "action"])))
    else:
        activity = counted(decode_clicks(rows, columns=["eventtime", "product", "action"]), time="eventtime")
        counts = watermarked_counts(activity, delay)
    return start_upsert(counts, table, checkpoint, **options)


def speed_visitors(
    rows: DataFrame,
    table: DayTable | StoreTable,
    checkpoint: str,
    delay: str | None = None,
    **options,
) -> StreamingQuery:
    """Keep running approximate unique visitors per product and hour.

    Each open hour holds a sketch of up to 4 KB; a delay closes hours as in speed_activity.
    """
    if delay is None:
        visits = counted(decode_clicks(rows, columns=[*KEYS, "visitor"]))
        visitors = approx_visitors_by_product(visits)
    else:
        visits = counted(decode_clicks(rows, columns=["eventtime", "product", "visitor"]), time="eventtime")
        visitors = watermarked_visitors(visits, delay)
    return start_upsert(visitors, table, checkpoint, **options)


def speed_sketches(
    rows: DataFrame,
    table: DayTable | StoreTable,
    checkpoint: str,
    delay: str | None = None,
    **options,
) -> StreamingQuery:
    """Keep running sketches of the visitors per product and hour, which serve_visitors unites with the batch job's."""
    if delay is None:
        sketches = visitor_sketches(counted(decode_clicks(rows, columns=[*KEYS, "visitor"])))
    else:
        sketches = watermarked_sketches(counted(decode_clicks(rows, columns=["eventtime", "product", "visitor"]), time="eventtime"), delay)
    return start_upsert(sketches, table, checkpoint, **options)


def speed_clicks(
    rows: DataFrame, table: DayTable | StoreTable, checkpoint: str, **options
) -> StreamingQuery:
    """Keep the last click of each product and hour, by the table's order: see CLICK_ORDER."""
    if table.order is None:
        raise ValueError("the last click needs a table with an order, such as CLICK_ORDER")
    return start_upsert(counted(decode_clicks(rows)), table, checkpoint, mode="append", **options)


def batch(
    spark: SparkSession,
    landed_path: str,
    location: str,
    since: date | None = None,
    until: date | None = None,
    mode: str = "overwrite",
    closed: str | None = None,
    hours: int | None = None,
    now: int | None = None,
    once: bool = False,
    rejects: bool = False,
    sketches: bool = False,
    database: str = "default",
    buckets: int = BUCKETS,
) -> tuple[DataFrame, DataFrame]:
    """Recompute both batch tables from landed clicks: (activity, visitors).

    One pass over the clicks gives both aggregates. They are stored together, published as
    tables of the catalog database, in buckets of the key, and then removed. Readers of the former
    tables keep their files; with mode "errorifexists" the job refuses to begin if there are
    any.

    since and until bound the day of receipt, `hours` the age of the event's hour before `now`
    (epoch seconds, by default the current time). Days rewritten by close_day are read from
    `closed`. `once` drops repeated deliveries, for clicks landed with their position.
    `rejects` publishes the clicks without a key, with their payload if it was landed, and
    `sketches` a sketch of every key's visitors, from a second pass, for serve_visitors.

    The activity table states a cutoff for serve: its newest hour, which may still receive
    clicks; every hour before counts from here. It also states how many clicks were `received`
    and `rejected` for want of a key, counted in the pass that aggregates.
    """
    create_database(spark, database, location)
    if mode == "errorifexists" and any(spark.catalog.tableExists(f"{database}.{name}") for name in BATCH_TABLES):
        raise ValueError(f"{database} already holds batch tables")
    extra = StructType([*([PAYLOAD] if rejects else []), *(POSITION if once else [])])
    rows = landed(spark, landed_path, since, until, extra, closed)
    if hours is not None:
        rows = rows.where(within_hours(hours, now))
    if once:
        rows = drop_duplicate_events(rows, POSITION.names)
    accepted, rejected = split_malformed(rows)
    folder = new_folder(spark, "rollup")
    seen = Observation()
    both = write_table(rollup_by_product(split_malformed(counted(rows, seen))[0]), folder)
    cutoff = both.agg(F.max("timestamp_hour")).first()[0]
    for name in BATCH_TABLES:
        publish(both.select(TABLES[name].names), f"{database}.{name}", location, buckets)
    # Stated after the counts are in place: the hour before errs on the side of the speed layer.
    state_cutoff(spark, f"{database}.{ACTIVITY_TABLE}", cutoff)
    state_counts(spark, f"{database}.{ACTIVITY_TABLE}", seen.get)
    if sketches:
        publish(visitor_sketches(accepted), f"{database}.{SKETCH_TABLE}", location, buckets)
    if rejects:
        publish(rejected, f"{database}.{REJECTED_TABLE}", location)
    delete(spark, folder)
    return tuple(spark.table(f"{database}.{name}") for name in BATCH_TABLES)


def visits_of_days(
    spark: SparkSession,
    landed_path: str,
    days: list[date],
    closed: str | None = None,
    once: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """Counts per product, hour, visitor and day of receipt of the clicks of some days, of which alone files are read."""
    rows = landed(spark, landed_path, extra=POSITION if once else StructType(), closed=closed)
    received = F.make_date(*INGEST_DATE)
    rows = rows.where(received.isin(days)).withColumn("ingest_day", received)
    if once:
        rows = drop_duplicate_events(rows, POSITION.names)
    if seen is not None:
        rows = counted(rows, seen)
    visits = split_malformed(rows)[0].groupBy(*KEYS, "visitor", "ingest_day").agg(*action_counts())
    return visits.withColumn(DAY, hour_day("timestamp_hour"))


def rollup_of_days(visits: DataFrame, days: list[date]) -> DataFrame:
    """The counts and the exact unique visitors of each key in some days of events, from counts per visitor.

    They are dealt anew by key and visitor. Read where they lie, all of a bucket would be one task's,
    however many days and rows that is.
    """
    parts = visits.where(F.col(DAY).isin(days)).repartition(*KEYS, "visitor")
    sums = [F.sum(name).alias(name) for name in COUNTS]
    both = parts.groupBy(*KEYS).agg(*sums, F.countDistinct("visitor").alias("unique_visitors"))
    return both.withColumn(DAY, hour_day("timestamp_hour"))


def batch_new_days(
    spark: SparkSession,
    landed_path: str,
    location: str,
    until: date,
    closed: str | None = None,
    once: bool = False,
    database: str = "default",
    buckets: int = BUCKETS,
) -> list[date]:
    """Bring both batch tables up to date by the days of receipt that no run has read yet, up to `until`.

    These days must receive no more clicks. What they hold is kept as counts per product, hour
    and visitor, partitioned by the day of the event's hour and the day of receipt. Of the
    batch tables, here partitioned by the day of the hour, only the days that new clicks fall in are computed
    again, from these counts. So a run reads the new days' clicks and the counts of the event days they
    touch, and the result is that of a full recompute.

    Days count as read once all is written. A run that stopped anywhere is made good by the
    next, which replaces the same partitions. `once` drops repeated deliveries within these days.
    The activity table states how many clicks of this run's days were `received` and `rejected`. Returns
    the days read.
    """
    create_database(spark, database, location)
    visits, consumed = f"{database}.{VISITS_TABLE}", f"{database}.{CONSUMED_TABLE}"
    spread = [*KEYS, "visitor"]
    create_keyed_table(spark, visits, VISITS, f"{location}/{VISITS_TABLE}", buckets, True, "ingest_day", spread)
    for name in BATCH_TABLES:
        create_keyed_table(spark, f"{database}.{name}", TABLES[name], f"{location}/{name}", buckets, by_day=True)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {consumed} (day date) USING parquet LOCATION '{location}/{CONSUMED_TABLE}'")
    read = {r["day"] for r in spark.table(consumed).collect()}
    new = [day for day in landed_days(spark, landed_path, closed) if day <= until and day not in read]
    if not new:
        return []
    seen = Observation()
    overwrite_days(visits_of_days(spark, landed_path, new, closed, once, seen), visits, buckets, spread, "ingest_day")
    touched = spark.table(visits).where(F.col("ingest_day").isin(new)).select(DAY).distinct()
    folder = new_folder(spark, "rollup")
    both = write_table(rollup_of_days(spark.table(visits), [r[DAY] for r in touched.collect()]), folder)
    for name in BATCH_TABLES:
        overwrite_days(both, f"{database}.{name}", buckets)
    state_counts(spark, f"{database}.{ACTIVITY_TABLE}", seen.get)
    spark.createDataFrame([(day,) for day in new], "day date").coalesce(1).write.insertInto(consumed)
    delete(spark, folder)
    return new


def quarantine(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Store decoded Kafka rows apart, in one pass: (accepted, rejected).

    Both keep their position; a rejected one keeps the text of its payload as well.
    """
    keep = (*POSITION.names, "value")
    decoded = decode_clicks(rows, keep=keep).withColumn("accepted", has_key())
    payload = F.when(~F.col("accepted"), F.col("value").cast("string")).alias(PAYLOAD.name)
    columns = [*ACTIVITY.names, *POSITION.names]
    decoded.select(*columns, payload, "accepted").write.partitionBy("accepted").parquet(path)
    stored = rows.sparkSession.read.schema(StructType([*ACTIVITY, *POSITION, PAYLOAD]).add("accepted", "boolean")).parquet(path)
    return tuple(stored.where(F.col("accepted") == side).drop("accepted") for side in (True, False))


def serve(
    batch_table: DataFrame,
    speed_table: DataFrame,
    table: str,
    location: str,
    cutoff_hour: int | None = None,
    additive: bool = False,
) -> str:
    """Merge the batch and speed counts and publish them as the serving table.

    With a cutoff, such as the one batch states, hours before it count from the batch table
    and the others from the speed table. Only `additive` adds both up in every hour, which is
    right if no click is in both.
    """
    if (cutoff_hour is None) != additive:
        raise ValueError("give the hour at which speed counts take over, or say that the tables are additive")
    merged = merge(batch_table, speed_table, cutoff_hour, ordered=True)
    return publish(merged, table, location)


def serve_visitors(
    batch_sketches: DataFrame,
    speed_sketches: DataFrame,
    table: str,
    location: str,
    cutoff_hour: int | None = None,
    buckets: int = BUCKETS,
) -> str:
    """Unite the visitor sketches of both layers and publish them, each with its estimate, as a serving table.

    A visitor in both layers counts once, so no hour need be left to one of them; with a cutoff the
    speed layer's are read from that hour on only.
    """
    united = serve_sketches(batch_sketches, speed_sketches, cutoff_hour)
    estimate = F.hll_sketch_estimate("visitors").alias("unique_visitors")
    return publish(united.select(*KEYS, estimate, "visitors"), table, location, buckets)
