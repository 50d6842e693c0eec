"""Kafka input and output. The Kafka connector must be on Spark's class path."""

from pyspark.sql import Column, DataFrame, SparkSession

from clickmill.functions import encode_json


def kafka_options(
    servers: str, topic: str, starting_offsets: str = "latest", **options
) -> dict[str, str]:
    """Source options. "latest" skips what was sent before the first start of a checkpoint.

    Useful extras at scale: maxOffsetsPerTrigger bounds a micro-batch, and minPartitions or
    maxRecordsPerPartition splits a hot topic partition over several tasks.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **{key: str(value) for key, value in options.items()},
    }


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def kafka_sink_options(servers: str, topic: str, acks: str = "all", **options) -> dict[str, str]:
    """Sink options; further ones, such as kafka.security.protocol or kafka.compression.type, reach the client."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        **{key: str(value) for key, value in options.items()},
    }


def kafka_values(activity: DataFrame, value: Column | None = None) -> DataFrame:
    """The single `value` column the Kafka sink sends, without a key."""
    return activity.select((encode_json() if value is None else value).alias("value"))


def write_kafka(activity: DataFrame, servers: str, topic: str, **options) -> None:
    """Send a batch frame to a topic; for a stream see streaming.start_kafka."""
    sink = kafka_sink_options(servers, topic, **options)
    kafka_values(activity).write.format("kafka").options(**sink).save()
