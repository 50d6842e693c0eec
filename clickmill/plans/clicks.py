"""The click events the registered queries run on, derived from the whole `events` table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions import encode_json, hour_bucket, numbered, previous_page
from clickmill.schema import ACTIVITY, KAFKA_ROW
from clickmill.sources import event_stream

# The referrers.
REFERRERS = ["Google", "Bing", "Yahoo", "Twitter", "Facebook", "Other", "Direct", "Internal"]

DELIVERIES = 3  # micro-batches of a stream
FILE_ROWS = 100_000  # of a delivered file, at most: a micro-batch takes whole files, one task or more to read each

# Stating the types saves reading a footer before planning.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, "
    "event_type string, value double, props string"
)
# The zoneless times taken as UTC instants, whatever the session's time zone.
EVENTS_UTC = EVENTS.replace("timestamp_ntz", "timestamp")


def events(spark: SparkSession, sf_dir: str, schema: str = EVENTS) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/events.parquet")


def to_clicks(events: DataFrame) -> DataFrame:
    """event_id and the activity columns, from events read as EVENTS_UTC. Types without a counted action stay as they are."""
    event_type = F.col("event_type")
    product_number = F.get_json_object("props", "$.k").cast("long") % 10
    return (
        events.select(
            "event_id",
            F.unix_millis("ts").alias("eventtime"),
            F.get(F.array(*map(F.lit, REFERRERS)), F.col("event_id") % 8).alias("referrer"),
            F.when(event_type == "click", "add_to_cart")
            .when(event_type == "view", "page_view")
            .otherwise(event_type)
            .alias("action"),
            numbered("Visitor", "user_id").alias("visitor"),
            numbered("Page", F.col("event_id") % 16).alias("page"),
            numbered("Product", product_number).alias("product"),
        )
        .withColumn("prevpage", previous_page("referrer", numbered("Page", F.col("event_id") % 15)))
        .withColumn("timestamp_hour", hour_bucket("eventtime"))
        .select("event_id", *ACTIVITY.names)
    )


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_clicks(events(spark, sf_dir, EVENTS_UTC))


def kafka_rows(clicks: DataFrame, value=None) -> DataFrame:
    """The clicks as rows of an eight-way partitioned topic, in schema.KAFKA_ROW's layout."""
    value = encode_json() if value is None else value
    return clicks.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("clicks").alias("topic"),
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.expr("event_id DIV 8").alias("offset"),
        F.timestamp_millis("eventtime").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_topic(rows: DataFrame, topic: str) -> None:
    """Append Kafka rows to a folder, in files that grow in number with the rows, not in size."""
    rows.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(topic)


def deliver(spark: SparkSession, sf_dir: str, topic: str, first: int = 0, until: int = DELIVERIES) -> None:
    """Append deliveries of the clicks, as Kafka rows in the order of their time, to a folder.

    The time that the events span is cut in DELIVERIES equal parts.
    """
    rows = clicks(spark, sf_dir)
    start, end = rows.agg(F.min("eventtime"), F.max("eventtime")).first()
    step = (end - start) // DELIVERIES + 1
    for i in range(first, until):
        part = rows.where(F.col("eventtime").between(start + i * step, start + (i + 1) * step - 1))
        write_topic(kafka_rows(part), topic)


def kafka_stream(spark: SparkSession, topic: str) -> DataFrame:
    """Delivered Kafka rows as a stream that takes a DELIVERIES-th of their files, oldest first, at a time."""
    files = len(spark.read.schema(KAFKA_ROW).parquet(topic).inputFiles())
    return event_stream(spark, topic, KAFKA_ROW, maxFilesPerTrigger=-(-files // DELIVERIES))
