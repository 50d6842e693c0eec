"""A keyed catalog table fed by micro-batches, which rewrite only the days they touch."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickmill.functions import hour_day
from clickmill.operators.aggregates import last_write_per_key
from clickmill.schema import KEYS
from clickmill.sources.catalog import BUCKETS, DAY, create_keyed_table, overwrite_days
from clickmill.sources.folders import OWNER, check_owner, checkpoint_id, children, delete, exists, set_owner


class DayTable:
    """One row for each key, in Parquet partitioned by the day of the hour; any SQL reads it by its name.

    Of several rows of a key the one of the newest micro-batch counts; with `order`, the
    latest by those columns, so that where micro-batches are cut makes no difference.

    A micro-batch is merged with the rows of the days that its keys lie in. The result is
    stored below the table and then overwrites these days' partitions. A micro-batch that
    runs again finds what was stored and writes the same partitions from it, so it does not matter
    where its first run stopped. Its cost is that of the days it touches, whatever the table
    holds; a query under way on a day being rewritten may miss files and must be repeated.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        location: str,
        schema: StructType,
        keys: list[str] = KEYS,
        order: list[str] | None = None,
        buckets: int = BUCKETS,
    ):
        if "timestamp_hour" not in keys:
            raise ValueError("a table by day needs the hour in its key")
        self.spark = spark
        self.name = name
        self.location = location.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.order = order
        self.buckets = buckets
        self.owner = "none"
        create_keyed_table(spark, name, schema, self.location, buckets, by_day=True)

    def check(self, checkpoint: str) -> None:
        """Refuse a checkpoint other than the one whose micro-batches fill the table."""
        filled = exists(self.spark, f"{self.location}/{OWNER}") or not self.spark.sql(f"SHOW PARTITIONS {self.name}").isEmpty()
        check_owner(self.spark, self.location, checkpoint, filled)

    def bind(self, checkpoint: str) -> None:
        """From now on the table belongs to a checkpoint whose query has started."""
        if self.owner == "none":
            self.owner = checkpoint_id(self.spark, checkpoint)
            set_owner(self.spark, self.location, self.owner)

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Write the rows of a micro-batch; without an order each key must occur at most once in it.

        Rows with a NULL in their key are left out, as a keyed store would refuse them.
        """
        spark = rows.sparkSession
        stage, name = f"{self.location}/_stage", f"{self.owner}-{batch_id}"
        # What is stored of other micro-batches has been written: this one came after them.
        for old in children(spark, stage):
            if old != name:
                delete(spark, f"{stage}/{old}")
        path = f"{stage}/{name}"
        if exists(spark, f"{path}/kept/_SUCCESS"):
            # The stream's state moves on only if the rows are computed.
            rows.write.format("noop").mode("overwrite").save()
        else:
            self._store_merged(rows, path)
        merged = [f"{path}/kept"] if self.order else [f"{path}/changed", f"{path}/kept"]
        overwrite_days(self._stored(spark, *merged), self.name, self.buckets)

    def _stored(self, spark: SparkSession, *paths: str) -> DataFrame:
        return spark.read.schema(StructType([*self.schema.fields]).add(DAY, "date")).parquet(*paths)

    def _store_merged(self, rows: DataFrame, path: str) -> None:
        """Store the changed rows, and then those that are kept beside them; with an order, those that are kept of all."""
        spark = rows.sparkSession
        rows = rows.select(self.schema.names).dropna(subset=self.keys).withColumn(DAY, hour_day("timestamp_hour"))
        # Written first, as each further use of the rows would run the stream's state again, also if they were cached.
        rows.write.mode("overwrite").parquet(f"{path}/changed")
        changed = self._stored(spark, f"{path}/changed")
        days = changed.agg(F.collect_set(DAY)).first()[0]
        spark.catalog.refreshTable(self.name)
        current = spark.table(self.name).where(F.col(DAY).isin(days)).select(changed.columns)
        if self.order is None:
            kept = current.join(changed.select(self.keys), self.keys, "left_anti").select(changed.columns)
        else:
            kept = last_write_per_key(current.unionByName(changed), self.order, self.keys)
        # At most as many files as these days will have, however many tasks a shuffle has.
        kept.coalesce(max(1, self.buckets * len(days))).write.mode("overwrite").parquet(f"{path}/kept")

    def read(self, since_hour: int | None = None) -> DataFrame:
        """The rows, of the hours from `since_hour` on if it is given; other days are not read."""
        self.spark.catalog.refreshTable(self.name)
        rows = self.spark.table(self.name)
        if since_hour is not None:
            rows = rows.where((F.col(DAY) >= hour_day(F.lit(since_hour))) & (F.col("timestamp_hour") >= since_hour))
        return rows.select(self.schema.names)
