"""The registered queries. Each runs over the whole of its tables.

Where a query needs two event sets, clicks from search engines are the batch layer's and all
others the speed layer's: between them they hold every event, and many of their keys meet.
"""

from datetime import date, timedelta
from functools import partial, reduce
from hashlib import sha1

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickmill.functions import (
    date_parts,
    decode_clicks,
    delimited_fields,
    delimited_line,
    encode_json,
    encode_tsv,
    hour_bucket,
    within_hours,
)
from clickmill.operators import (
    activity_by_product,
    apply_updates,
    distinct_keys,
    drop_duplicate_events,
    estimate_visitors,
    in_key_order,
    last_write_per_key,
    latest_hours,
    merge,
    merge_sketches,
    missing_rows,
    not_in,
    visitor_sketches,
    visitors_by_product,
)
from clickmill.plans import jobs
from clickmill.plans.clicks import DELIVERIES, clicks, deliver, events, kafka_rows, kafka_stream, write_topic
from clickmill.schema import (
    ACTIVITY,
    ACTIVITY_BY_PRODUCT,
    BATCH_TABLES,
    INGEST_DATE,
    KEYS,
    VISITOR_SKETCHES,
    VISITORS_BY_PRODUCT,
)
from clickmill.session import new_folder
from clickmill.sources import (
    close_day,
    create_database,
    file_options,
    landed,
    publish,
    stated_counts,
    swap_table,
    text_lines,
    write_table,
)
from clickmill.sources.files import DAYS
from clickmill.streaming import DayTable, delivered, start_files, start_replace, watermarked_counts

INGEST_DAY = date(2024, 2, 1)
NOW = 1_706_616_000  # 2024-01-30 12:00 UTC, within the last hours of the events
CUTOFF_HOUR = 1_705_276_800_000  # 2024-01-15 00:00 UTC, the middle of the events
STANDARD_ERROR = 0.05  # of a sketch, at most
SEARCH_ENGINES = ["Google", "Bing", "Yahoo"]
FEW = 2  # buckets of a day, of which the given tables have few rows
RUN_ONCE = {"trigger": {"availableNow": True}}


def _own_name(folder: str) -> str:
    """The name of a table or database that lies in a folder of its own."""
    return f"own_{sha1(folder.encode()).hexdigest()[:16]}"


def _layers(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    searched = F.col("referrer").isin(SEARCH_ENGINES)
    return rows.where(searched), rows.where(~searched)


def _layer_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    batch, speed = _layers(clicks(spark, sf_dir))
    return activity_by_product(batch), activity_by_product(speed)


def _damaged(spark, sf_dir) -> DataFrame:
    """Kafka rows in which the payload of every error event lacks its opening brace."""
    rows = clicks(spark, sf_dir)
    payload = F.when(F.col("action") == "error", F.substring(encode_json(), 2, 1 << 30))
    return kafka_rows(rows, payload.otherwise(encode_json()))


# Decoding and encoding


def click_events(spark, sf_dir):
    return clicks(spark, sf_dir)


def parse_json(spark, sf_dir):
    rows = kafka_rows(clicks(spark, sf_dir))
    return decode_clicks(rows, keep=("partition", "offset"))


def encode_json_query(spark, sf_dir):
    return clicks(spark, sf_dir).select("event_id", encode_json().alias("value"))


def encode_tsv_query(spark, sf_dir):
    """The referrer of every eighth click is NULL."""
    rows = clicks(spark, sf_dir)
    rows = rows.withColumn("referrer", F.when(F.col("referrer") != "Other", F.col("referrer")))
    return rows.select("event_id", encode_tsv().alias("line"))


def delimited_parse(spark, sf_dir):
    """Join typed columns, some of them NULL, with semicolons, then read them back."""
    rows = events(spark, sf_dir)
    rows = rows.withColumn("event_type", F.when(F.col("event_type") != "error", F.col("event_type")))
    lines = rows.select(delimited_line(rows.columns).alias("line"))
    parsed = lines.select(*delimited_fields("line", rows.schema))
    return parsed.withColumn("ts", F.col("ts").cast("string"))


# Scalar steps


def hour_bucket_query(spark, sf_dir):
    return clicks(spark, sf_dir).select(
        "event_id", "eventtime", hour_bucket("eventtime").alias("timestamp_hour")
    )


def ingest_date_parts(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", *date_parts(F.col("ts")))


def recent_hours(spark, sf_dir):
    """Over landed clicks whose day was rewritten in the order of the hour."""
    folder = new_folder(spark, "recent")
    rows = clicks(spark, sf_dir).select(*ACTIVITY.names, *date_parts(INGEST_DAY))
    rows.write.partitionBy(*INGEST_DATE).parquet(f"{folder}/landed")
    close_day(spark, f"{folder}/landed", f"{folder}/closed", INGEST_DAY, files=4)
    stored = landed(spark, f"{folder}/landed", closed=f"{folder}/closed")
    return stored.where(within_hours(6, NOW)).drop(*INGEST_DATE)


# Aggregates


def activity_by_product_query(spark, sf_dir):
    return activity_by_product(clicks(spark, sf_dir))


def visitors_by_product_query(spark, sf_dir):
    return visitors_by_product(clicks(spark, sf_dir))


def activity_view(spark, sf_dir):
    """The same counts in SQL, over the clicks as a view."""
    clicks(spark, sf_dir).createOrReplaceTempView("activity")
    return spark.sql(
        """
        SELECT product, timestamp_hour,
          count_if(action = 'purchase') AS purchase_count,
          count_if(action = 'add_to_cart') AS add_to_cart_count,
          count_if(action = 'page_view') AS page_view_count
        FROM activity GROUP BY ALL
        """
    )


def null_key_group(spark, sf_dir):
    """Error events lose their product and gather under a NULL key."""
    product = F.when(F.col("action") != "error", F.col("product"))
    return activity_by_product(clicks(spark, sf_dir).withColumn("product", product))


def distinct_hour_product(spark, sf_dir):
    return distinct_keys(clicks(spark, sf_dir))


def last_write_per_key_query(spark, sf_dir):
    return last_write_per_key(clicks(spark, sf_dir), ["eventtime", "event_id"])


def latest_hours_query(spark, sf_dir):
    return latest_hours(activity_by_product(clicks(spark, sf_dir)), 3)


def _beside_exact(estimated, spark, sf_dir):
    """Exact unique visitors, and whether the estimate is within four standard errors, or one visitor, of them."""
    exact = visitors_by_product(clicks(spark, sf_dir))
    estimated = estimated.withColumnRenamed("unique_visitors", "estimate")
    away = F.abs(F.col("estimate") - F.col("unique_visitors"))
    close = away <= 1 + 4 * STANDARD_ERROR * F.col("unique_visitors")
    return exact.join(estimated, KEYS, "full").select(*KEYS, "unique_visitors", close.alias("close"))


def visitors_hll(spark, sf_dir):
    """Sketches of the two layers, merged, beside the exact counts."""
    batch, speed = _layers(clicks(spark, sf_dir))
    merged = merge_sketches(visitor_sketches(batch), visitor_sketches(speed))
    return _beside_exact(estimate_visitors(merged), spark, sf_dir)


# Serving


def serving_copy(spark, sf_dir):
    """Copy the batch table into a temporary one that then takes the serving table's name."""
    batch = activity_by_product(clicks(spark, sf_dir))
    folder = new_folder(spark, "serving-copy")
    batch_path = f"{folder}/batch"
    write_table(batch, batch_path)
    # Hyphens of the folder's unique id are no part of a table name.
    unique = folder[-12:]
    spark.sql(
        f"CREATE TABLE serving_temp_{unique} USING parquet LOCATION '{folder}/serving' "
        f"AS SELECT * FROM parquet.`{batch_path}`"
    )
    swap_table(spark, f"serving_temp_{unique}", f"serving_{unique}")
    return spark.table(f"serving_{unique}")


def serving_update(spark, sf_dir):
    return apply_updates(*_layer_tables(spark, sf_dir))


def serving_insert(spark, sf_dir):
    return missing_rows(*_layer_tables(spark, sf_dir))


def not_in_null_semantics(spark, sf_dir):
    """Keys of the speed layer that are NOT IN those of the batch layer, NULLs in both."""
    batch, speed = _layers(clicks(spark, sf_dir))
    batch = batch.withColumn("product", F.when(F.col("visitor") != "Visitor-7", F.col("product")))
    speed = speed.withColumn("product", F.when(F.col("action") != "error", F.col("product")))
    # Stored, as keyed tables are: the test reads both sides in several ways.
    folder = new_folder(spark, "not-in")
    return not_in(
        write_table(distinct_keys(speed), f"{folder}/speed"),
        write_table(distinct_keys(batch), f"{folder}/batch"),
    )


def serving_merge(spark, sf_dir):
    return merge(*_layer_tables(spark, sf_dir))


def serving_merge_cutoff(spark, sf_dir):
    """Batch covers every event and speed the later ones again; the cutoff counts each once."""
    rows = clicks(spark, sf_dir)
    recent = rows.where(F.col("timestamp_hour") >= CUTOFF_HOUR - 24 * 3_600_000)
    return merge(activity_by_product(rows), activity_by_product(recent), CUTOFF_HOUR)


def serve(spark, sf_dir):
    """The whole batch side: merge the layers and publish the serving table, twice over."""
    batch, speed = _layer_tables(spark, sf_dir)
    folder = new_folder(spark, "serve")
    table = f"serving_layer_{folder[-12:]}"
    publish(in_key_order(batch), table, folder)
    jobs.serve(spark.table(table), speed, table, folder, additive=True)
    return spark.table(table)


def serve_visitors(spark, sf_dir):
    """Sketches stored by the batch job and by a stream that saw the last half of its clicks as well, united."""
    rows = clicks(spark, sf_dir)
    batch_side, _ = _layers(rows)
    folder = new_folder(spark, "serve-visitors")
    landed_rows = batch_side.select(*ACTIVITY.names, *date_parts(INGEST_DAY))
    landed_rows.write.partitionBy(*INGEST_DATE).parquet(f"{folder}/landed")
    database = _own_name(folder)
    jobs.batch(spark, f"{folder}/landed", f"{folder}/batch", sketches=True, database=database)
    speed_side = rows.where((F.col("timestamp_hour") >= CUTOFF_HOUR) | ~F.col("referrer").isin(SEARCH_ENGINES))
    write_topic(kafka_rows(speed_side), f"{folder}/topic")
    speed = DayTable(spark, f"{database}.stream_visitor_sketches", f"{folder}/speed", VISITOR_SKETCHES, buckets=FEW)
    stream = kafka_stream(spark, f"{folder}/topic")
    jobs.speed_sketches(stream, speed, f"{folder}/checkpoint", **RUN_ONCE).awaitTermination()
    table = f"{database}.serving_visitors"
    jobs.serve_visitors(spark.table(f"{database}.{jobs.SKETCH_TABLE}"), speed.read(), table, f"{folder}/serving")
    return _beside_exact(spark.table(table).drop("visitors"), spark, sf_dir)


def serving_in_buckets(spark, sf_dir):
    """Update and insert over tables in equal buckets of the key, so that neither shuffles."""
    folder = new_folder(spark, "buckets")
    tables = []
    for name, rows in zip(("batch", "speed"), _layer_tables(spark, sf_dir)):
        table = f"{name}_{_own_name(folder)}"
        publish(rows, table, folder, buckets=8)
        tables.append(spark.table(table))
    return apply_updates(*tables).unionByName(missing_rows(*tables))


def batch_new_days(spark, sf_dir):
    """Clicks land on three days, each recomputed when it is over; events of one day are received on all of them."""
    folder = new_folder(spark, "new-days")
    rows = clicks(spark, sf_dir)
    for i in range(3):
        day = INGEST_DAY + timedelta(days=i)
        part = rows.where(F.col("event_id") % 3 == i).select(*ACTIVITY.names, *date_parts(day))
        part.write.mode("append").partitionBy(*INGEST_DATE).parquet(f"{folder}/landed")
        jobs.batch_new_days(spark, f"{folder}/landed", f"{folder}/batch", day, database=_own_name(folder), buckets=FEW)
    activity, visitors = (spark.table(f"{_own_name(folder)}.{name}").drop("hour_day") for name in BATCH_TABLES)
    return activity.join(visitors, KEYS)


def serving_insert_row(spark, sf_dir):
    """The table with one more row, of literal values."""
    folder = new_folder(spark, "insert")
    table = f"activity_{folder[-12:]}"
    publish(activity_by_product(clicks(spark, sf_dir)), table, folder)
    spark.sql(f"INSERT INTO {table} VALUES ('Product-0', 0, 1, 2, 3)")
    return spark.table(table)


# Streams of several micro-batches, run until all input is read


def _topic(spark, sf_dir, label):
    """A new folder, and the clicks as a stream of Kafka rows delivered there."""
    folder = new_folder(spark, label)
    deliver(spark, sf_dir, f"{folder}/topic")
    return folder, kafka_stream(spark, f"{folder}/topic")


def stream_ingest(spark, sf_dir):
    folder, rows = _topic(spark, sf_dir, "ingest")
    query = jobs.ingest(rows, f"{folder}/table", f"{folder}/checkpoint", INGEST_DAY, **RUN_ONCE)
    query.awaitTermination()
    return landed(spark, f"{folder}/table", since=INGEST_DAY, until=INGEST_DAY)


def stream_ingest_batch(spark, sf_dir):
    """Land the stream, every delivery twice, then recompute the batch tables from what was landed."""
    folder = new_folder(spark, "ingest-batch")
    for _ in range(2):
        deliver(spark, sf_dir, f"{folder}/topic")
    rows = kafka_stream(spark, f"{folder}/topic")
    options = {"keep_position": True, "files": 2, **RUN_ONCE}
    jobs.ingest(rows, f"{folder}/table", f"{folder}/checkpoint", INGEST_DAY, **options).awaitTermination()
    activity, visitors = jobs.batch(spark, f"{folder}/table", f"{folder}/batch", once=True, database=_own_name(folder))
    return activity.join(visitors, KEYS)


def ingest_formats(spark, sf_dir):
    """The same stream landed in each of the other formats and read back."""
    folder, rows = _topic(spark, sf_dir, "formats")
    found = []
    for name in ("orc", "json", "csv"):
        path = f"{folder}/{name}"
        jobs.ingest(rows, path, f"{path}-checkpoint", INGEST_DAY, name, **RUN_ONCE).awaitTermination()
        back = spark.read.format(name).options(**file_options(name)).schema(StructType([*ACTIVITY, *DAYS])).load(path)
        found.append(back.withColumn("format", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


def stream_activity(spark, sf_dir):
    """The stream stops after the first delivery and goes on from its checkpoint."""
    folder = new_folder(spark, "activity")
    table = DayTable(spark, _own_name(folder), f"{folder}/table", ACTIVITY_BY_PRODUCT, buckets=FEW)
    for first, until in ((0, 1), (1, DELIVERIES)):
        deliver(spark, sf_dir, f"{folder}/topic", first, until)
        rows = kafka_stream(spark, f"{folder}/topic")
        jobs.speed_activity(rows, table, f"{folder}/checkpoint", **RUN_ONCE).awaitTermination()
    # The catalog table itself, as any SQL reads it.
    spark.catalog.refreshTable(table.name)
    return spark.sql(f"SELECT product, timestamp_hour, purchase_count, add_to_cart_count, page_view_count FROM {table.name}")


def stream_visitors_approx(spark, sf_dir):
    """Hours are forgotten a day after they end; deliveries in order lose none by that."""
    folder, rows = _topic(spark, sf_dir, "visitors")
    table = DayTable(spark, _own_name(folder), f"{folder}/table", VISITORS_BY_PRODUCT, buckets=FEW)
    query = jobs.speed_visitors(rows, table, f"{folder}/checkpoint", delay="1 day", **RUN_ONCE)
    query.awaitTermination()
    return _beside_exact(table.read(), spark, sf_dir)


def stream_clicks(spark, sf_dir):
    folder, rows = _topic(spark, sf_dir, "clicks")
    table = DayTable(spark, _own_name(folder), f"{folder}/table", ACTIVITY, order=jobs.CLICK_ORDER, buckets=FEW)
    jobs.speed_clicks(rows, table, f"{folder}/checkpoint", **RUN_ONCE).awaitTermination()
    return table.read()


def stream_complete(spark, sf_dir):
    folder, rows = _topic(spark, sf_dir, "complete")
    counts = activity_by_product(decode_clicks(rows))
    query = start_replace(counts, f"{folder}/table", f"{folder}/checkpoint", **RUN_ONCE)
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/table/batch={query.lastProgress.batchId}")


def watermarked_hourly(spark, sf_dir):
    folder, rows = _topic(spark, sf_dir, "hourly")
    counts = watermarked_counts(decode_clicks(rows), "2 hours")
    query = start_files(
        counts, f"{folder}/table", f"{folder}/checkpoint", partition_by=[], **RUN_ONCE
    )
    query.awaitTermination()
    return spark.read.schema(ACTIVITY_BY_PRODUCT).parquet(f"{folder}/table")


# Tables and text


def batch_write_modes(spark, sf_dir):
    """The recompute runs again: the second write replaces the first."""
    visitors = visitors_by_product(clicks(spark, sf_dir))
    path = new_folder(spark, "modes")
    write_table(visitors, path, "errorifexists")
    return write_table(visitors, path, "overwrite")


def product_lines(spark, sf_dir):
    """Product lines through a text file; how often each is listed."""
    path = new_folder(spark, "products")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    part.select(F.concat_ws(",", "p_brand", "p_name")).write.text(path)
    return text_lines(spark, path, "product").groupBy("product").agg(F.count("*").alias("listed"))


# Delivery faults


def quarantine(spark, sf_dir):
    """Every delivered row, accepted or rejected, as the two sides were stored; times as text, as some are NULL."""
    accepted, rejected = jobs.quarantine(_damaged(spark, sf_dir), new_folder(spark, "quarantine"))
    sides = (accepted.withColumn("accepted", F.lit(True)), rejected.withColumn("accepted", F.lit(False)))
    times = {name: F.col(name).cast("string") for name in ("eventtime", "timestamp_hour")}
    return sides[0].unionByName(sides[1]).withColumns(times)


def delivery_counts(spark, sf_dir):
    """What each job says it received and rejected of the same deliveries, some of them damaged."""
    folder = new_folder(spark, "counts")
    write_topic(_damaged(spark, sf_dir), f"{folder}/topic")
    rows = kafka_stream(spark, f"{folder}/topic")
    found = []

    def run(job, start, *arguments, **options):
        query = start(rows, *arguments, f"{folder}/checkpoint-{job}", **options, **RUN_ONCE)
        query.awaitTermination()
        found.append((job, delivered(query)))

    run("ingest", partial(jobs.ingest, ingest_date=INGEST_DAY), f"{folder}/landed")
    database = _own_name(folder)
    create_database(spark, database, f"{folder}/speed")
    for job, start, schema, options in (
        ("activity", jobs.speed_activity, ACTIVITY_BY_PRODUCT, {}),
        ("visitors", jobs.speed_visitors, VISITORS_BY_PRODUCT, {"delay": "40 days"}),
        ("sketches", jobs.speed_sketches, VISITOR_SKETCHES, {}),
    ):
        run(job, start, DayTable(spark, f"{database}.{job}", f"{folder}/speed/{job}", schema, buckets=FEW), **options)
    jobs.batch(spark, f"{folder}/landed", f"{folder}/batch", database=database)
    found.append(("batch", stated_counts(spark, f"{database}.{BATCH_TABLES[0]}")))
    rows_of = [(job, counts["received"], counts["rejected"]) for job, counts in found]
    return spark.createDataFrame(rows_of, "job string, received long, rejected long")


def dedup_events(spark, sf_dir):
    """Every event delivered again a second later; the Kafka position tells the copies."""
    rows = kafka_rows(clicks(spark, sf_dir))
    again = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))
    once = drop_duplicate_events(rows.unionByName(again), ["offset", "partition", "topic"])
    return decode_clicks(once)


QUERIES = {
    "click_events": click_events,
    "parse_json": parse_json,
    "encode_json": encode_json_query,
    "encode_tsv": encode_tsv_query,
    "delimited_parse": delimited_parse,
    "hour_bucket": hour_bucket_query,
    "ingest_date_parts": ingest_date_parts,
    "recent_hours": recent_hours,
    "activity_by_product": activity_by_product_query,
    "visitors_by_product": visitors_by_product_query,
    "activity_view": activity_view,
    "null_key_group": null_key_group,
    "distinct_hour_product": distinct_hour_product,
    "last_write_per_key": last_write_per_key_query,
    "latest_hours": latest_hours_query,
    "visitors_hll": visitors_hll,
    "serving_copy": serving_copy,
    "serving_update": serving_update,
    "serving_insert": serving_insert,
    "not_in_null_semantics": not_in_null_semantics,
    "serving_merge": serving_merge,
    "serving_merge_cutoff": serving_merge_cutoff,
    "serve": serve,
    "serve_visitors": serve_visitors,
    "serving_in_buckets": serving_in_buckets,
    "batch_new_days": batch_new_days,
    "serving_insert_row": serving_insert_row,
    "stream_ingest": stream_ingest,
    "stream_ingest_batch": stream_ingest_batch,
    "ingest_formats": ingest_formats,
    "stream_activity": stream_activity,
    "stream_visitors_approx": stream_visitors_approx,
    "stream_clicks": stream_clicks,
    "stream_complete": stream_complete,
    "watermarked_hourly": watermarked_hourly,
    "batch_write_modes": batch_write_modes,
    "product_lines": product_lines,
    "quarantine": quarantine,
    "delivery_counts": delivery_counts,
    "dedup_events": dedup_events,
}
