"""Catalog tables of the serving database."""

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickmill.schema import KEYS, TABLES
from clickmill.sources.folders import children, delete

BUCKETS = 8  # of a keyed table; all tables that are joined by key should have the same number
DAY = "hour_day"  # the partition column of tables by day


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")


def _column_list(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_keyed_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    location: str,
    buckets: int = BUCKETS,
    by_day: bool = False,
    also_by: str | None = None,
    bucket_by: list[str] = KEYS,
) -> None:
    """A Parquet table in buckets of the key, sorted by it, where it is absent.

    Tables of the same number of buckets are joined by key where they lie, without a shuffle.
    With by_day, DAY is a further column by which the table is partitioned (and `also_by`, a
    column of the schema), and overwriting replaces only the partitions that are written.
    Parquet enforces no key: it is recorded as a property for readers.
    """
    if spark.catalog.tableExists(table):
        return
    by = [DAY, *([also_by] if also_by else [])] if by_day else []
    schema = StructType([f for f in schema if f.name != also_by] + [f for f in schema if f.name == also_by])
    columns = _column_list(schema) + (f", `{DAY}` date" if by_day else "")
    cluster = ", ".join(bucket_by)
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        + (f"PARTITIONED BY ({', '.join(by)}) " if by else "")
        + f"CLUSTERED BY ({cluster}) SORTED BY ({cluster}) INTO {buckets} BUCKETS "
        f"LOCATION '{location}' TBLPROPERTIES ('primary_key' = '{','.join(KEYS)}')"
    )
    if by and children(spark, location):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def overwrite_days(rows: DataFrame, table: str, buckets: int = BUCKETS, by: list[str] = KEYS, also_by: str | None = None) -> None:
    """Replace the partitions of a table by day that the rows lie in; all others stay. A bucket of a partition is one file.

    Rows are dealt by partition and bucket, so there may be as many tasks as files, and what one of them sorts
    does not depend on how few buckets there are.
    """
    spark = rows.sparkSession
    columns = spark.table(table).columns
    partitions = [DAY, *([also_by] if also_by else [])]
    # As Spark numbers them.
    bucket = F.pmod(F.hash(*by), F.lit(buckets))
    tasks = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.select(columns).repartition(tasks, *partitions, bucket).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def create_tables(spark: SparkSession, database: str, location: str, buckets: int = BUCKETS) -> None:
    """The database and its tables, each where absent.

    Batch tables are pointed at each new version that the batch job writes; speed tables are
    partitioned by day, and the speed jobs rewrite the days they touch.
    """
    create_database(spark, database, location)
    for name, schema in TABLES.items():
        create_keyed_table(spark, f"{database}.{name}", schema, f"{location}/{name}", buckets, by_day=name.startswith("stream_"))


def point_at(spark: SparkSession, table: str, path: str) -> None:
    """Let a catalog table read the files of another folder."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary").select("tableName")


def list_columns(spark: SparkSession, database: str) -> DataFrame:
    """One row per table column, from the catalog alone."""
    rows = [
        (table.name, position, column.name, column.dataType)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary
        for position, column in enumerate(spark.catalog.listColumns(f"{database}.{table.name}"))
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string"
    )


def swap_table(spark: SparkSession, replacement: str, table: str) -> None:
    """Drop the table if it exists and give its name to the replacement."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {replacement} RENAME TO {table}")


def publish(rows: DataFrame, table: str, location: str, buckets: int | None = None) -> str:
    """Write the rows as a new version below `location` and point the table at it.

    Without buckets the rows are written as they are ordered; with them the files are
    buckets of the key, sorted by it. Readers see the former version or the new one, whole, and a
    query still running keeps its files: the version before stays, older ones are deleted.
    Returns the new version's path.
    """
    spark = rows.sparkSession
    stem = f"{table.split('.')[-1]}-"
    name = f"{stem}{uuid4().hex}"
    path = f"{location}/{name}"
    if buckets is None:
        rows.write.parquet(path)
    else:
        # Only a table can be written in buckets; dropping it leaves its files.
        scratch = f"{table}_{name[-32:]}"
        create_keyed_table(spark, scratch, rows.schema, path, buckets)
        rows.repartition(buckets, *KEYS).write.insertInto(scratch)
        spark.sql(f"DROP TABLE {scratch}")
    if spark.catalog.tableExists(table):
        before = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first().data_type
        point_at(spark, table, path)
        kept = {name, before.rstrip("/").split("/")[-1]}
        for old in children(spark, location):
            if re.fullmatch(rf"{re.escape(stem)}[0-9a-f]{{32}}", old) and old not in kept:
                delete(spark, f"{location}/{old}")
    elif buckets is not None:
        create_keyed_table(spark, table, rows.schema, path, buckets)
    else:
        spark.sql(f"CREATE TABLE {table} ({_column_list(rows.schema)}) USING parquet LOCATION '{path}'")
    return path


CUTOFF = "cutoff_hour"


def state_cutoff(spark: SparkSession, table: str, hour: int | None) -> None:
    """Note with a batch table from which hour on speed counts are to be taken."""
    if hour is not None:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{CUTOFF}' = '{hour}')")


def state_counts(spark: SparkSession, table: str, counts: dict[str, int]) -> None:
    """Note with a batch table how many rows it was made of, by kind."""
    pairs = ", ".join(f"'rows_{kind}' = '{n}'" for kind, n in counts.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def stated_counts(spark: SparkSession, table: str) -> dict[str, int]:
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"].removeprefix("rows_"): int(r["value"]) for r in properties if r["key"].startswith("rows_")}


def stated_cutoff(spark: SparkSession, table: str) -> int | None:
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return int(properties[CUTOFF]) if CUTOFF in properties else None
