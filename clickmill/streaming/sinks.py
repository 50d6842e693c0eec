"""Starting streaming queries. Each returns its StreamingQuery; the caller awaits it.

`trigger` holds the arguments of DataStreamWriter.trigger, for example
{"processingTime": "60 seconds"} or {"availableNow": True}; by default each micro-batch
starts when the one before has ended.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickmill.operators.aggregates import last_write_per_key
from clickmill.schema import INGEST_DATE
from clickmill.sources.files import file_options
from clickmill.sources.folders import check_owner, children, delete, exists, set_owner
from clickmill.sources.kafka import kafka_sink_options, kafka_values
from clickmill.streaming.day_table import DayTable
from clickmill.streaming.store_table import StoreTable


def _writer(
    stream: DataFrame,
    mode: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    writer = stream.writeStream.outputMode(mode)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer if name is None else writer.queryName(name)


def start_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    partition_by: list[str] = INGEST_DATE,
    trigger: dict | None = None,
    name: str | None = None,
    files: int | None = None,
) -> StreamingQuery:
    """Append to partitioned files (parquet, orc, json or csv), exactly once.

    Each task writes its own files; `files` bounds them per micro-batch, by a shuffle, and
    suits aggregates with many state partitions. The sink skips the micro-batches that its
    log already holds, by number, so only the checkpoint that filled a path may go on with it.
    """
    spark = stream.sparkSession
    check_owner(spark, path, checkpoint, filled=exists(spark, f"{path}/_spark_metadata"))
    if files is not None:
        stream = stream.repartition(files)
    writer = _writer(stream, "append", checkpoint, trigger, name)
    query = writer.partitionBy(*partition_by).format(file_format).options(**file_options(file_format)).start(path)
    set_owner(spark, path, query.id)
    return query


def start_upsert(
    stream: DataFrame,
    table: DayTable | StoreTable,
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into a keyed table.

    Aggregates in update mode send each key once. For plain rows the table's `order` tells
    which of a key's rows is kept.
    """
    table.check(checkpoint)

    def write(rows: DataFrame, batch_id: int) -> None:
        table.bind(checkpoint)
        if table.order is not None:
            rows = last_write_per_key(rows, table.order, table.keys)
        table.upsert(rows, batch_id)

    return _writer(stream, mode, checkpoint, trigger, name).foreachBatch(write).start()


def start_replace(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Complete mode to files: each micro-batch writes the whole result as `path/batch=n`.

    The result before stays for queries under way; older ones are deleted. Only the checkpoint that
    filled a path may go on with it.
    """
    spark = stream.sparkSession
    check_owner(spark, path, checkpoint, filled=any(name.startswith("batch=") for name in children(spark, path)))

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        spark = rows.sparkSession
        for old in children(spark, path):
            if old.startswith("batch=") and int(old.removeprefix("batch=")) < batch_id - 1:
                delete(spark, f"{path}/{old}")

    query = _writer(stream, "complete", checkpoint, trigger, name).foreachBatch(write).start()
    set_owner(spark, path, query.id)
    return query


def start_kafka(
    activity: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Send activity rows to a Kafka topic as JSON values; `options` are the client's."""
    writer = _writer(kafka_values(activity), "append", checkpoint, trigger)
    return writer.format("kafka").options(**kafka_sink_options(servers, topic, **options)).start()


def start_console(
    stream: DataFrame, mode: str = "complete", trigger: dict | None = None
) -> StreamingQuery:
    """Print results, for debugging: the driver holds all output of a micro-batch."""
    return _writer(stream, mode, trigger=trigger).format("console").start()


def start_memory(
    stream: DataFrame, name: str, mode: str = "complete", trigger: dict | None = None
) -> StreamingQuery:
    """Results as an in-memory table, for debugging: the driver holds all of it."""
    return _writer(stream, mode, trigger=trigger, name=name).format("memory").start()


class RowWriter:
    """Row-at-a-time writer with one connection per partition and micro-batch.

    `connect(partition_id, epoch_id)` runs on the executor and returns an object with
    close(); `write(connection, row)` is called for each row.
    """

    def __init__(self, connect: Callable, write: Callable):
        self.connect = connect
        self.write = write

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.connection = self.connect(partition_id, epoch_id)
        return True

    def process(self, row) -> None:
        self.write(self.connection, row)

    def close(self, error) -> None:
        self.connection.close()


def start_foreach(
    stream: DataFrame,
    writer: RowWriter,
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Send rows one by one, for stores without a Spark connector; rows pass through Python.

    A failed micro-batch is sent again, so the store's writes must be idempotent.
    """
    return _writer(stream, mode, checkpoint, trigger, name).foreach(writer).start()
