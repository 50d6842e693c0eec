"""File tables: landed activity, aggregate tables, lines of text."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from clickmill.functions.codec import NULL_FIELD
from clickmill.schema import ACTIVITY, INGEST_DATE
from clickmill.sources.folders import children, write_note

DAYS = StructType([StructField(name, IntegerType()) for name in INGEST_DATE])


def landed(
    spark: SparkSession,
    path: str,
    since: date | None = None,
    until: date | None = None,
    extra: StructType = StructType(),
    closed: str | None = None,
) -> DataFrame:
    """Landed activity, optionally only what was ingested in [since, until].

    The range is tested on the partition columns and bounds the ingest date, not the time of
    the events. All folders are listed, but files of other days are not read. The schema is
    stated, so no file is opened to infer it; `extra` names columns that ingest was asked to
    land besides. Days that close_day has rewritten below `closed` are read from there.
    """
    schema = StructType([*ACTIVITY, *extra, *DAYS])
    rows = _read(spark, path, schema)
    done = closed_days(spark, closed) if closed else []
    if done:
        year, month, day = (F.col(name) for name in INGEST_DATE)
        is_done = F.make_date(year, month, day).isin(done)
        rows = rows.where(~is_done).unionByName(_read(spark, closed, schema).where(is_done))
    ingested = F.make_date(*INGEST_DATE)
    if since is not None:
        rows = rows.where(ingested >= F.lit(since))
    if until is not None:
        rows = rows.where(ingested <= F.lit(until))
    return rows


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(schema.names)


def _day_folder(path: str, day: date) -> str:
    return f"{path}/year={day.year}/month={day.month}/day={day.day}"


def closed_days(spark: SparkSession, closed: str) -> list[date]:
    """The days that close_day has finished."""
    return [date.fromisoformat(name.removeprefix("_closed-")) for name in children(spark, closed) if name.startswith("_closed-")]


def landed_days(spark: SparkSession, path: str, closed: str | None = None) -> list[date]:
    """The days of receipt that hold clicks, from the names of their folders."""
    days = set(closed_days(spark, closed)) if closed else set()

    def parts(folder: str, name: str) -> list[int]:
        return [int(child.removeprefix(f"{name}=")) for child in children(spark, folder) if child.startswith(f"{name}=")]

    for year in parts(path, "year"):
        for month in parts(f"{path}/year={year}", "month"):
            days |= {date(year, month, day) for day in parts(f"{path}/year={year}/month={month}", "day")}
    return sorted(days)


def close_day(
    spark: SparkSession, path: str, closed: str, day: date, files: int, extra: StructType = StructType()
) -> None:
    """Rewrite a day that receives no more clicks into a few files, in the order of their hour.

    A filter on hours then skips whole row groups, and a recompute opens few files. Rows are
    neither lost nor doubled if this stops midway: the day counts as closed only by a note
    written last, and running it again replaces what was written.
    """
    rows = landed(spark, path, day, day, extra).drop(*INGEST_DATE)
    ordered = rows.repartitionByRange(files, "timestamp_hour").sortWithinPartitions("timestamp_hour")
    ordered.write.mode("overwrite").parquet(_day_folder(closed, day))
    write_note(spark, f"{closed}/_closed-{day.isoformat()}", str(files))


def file_options(file_format: str) -> dict[str, str]:
    """How files of a format are written and read so that NULL and the empty text stay what they are.

    In csv NULL is NULL_FIELD, the empty text a pair of quotes, which is what Spark makes of it.
    """
    return {"nullValue": NULL_FIELD} if file_format == "csv" else {}


def event_stream(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """A parquet directory, or files matching a pattern, read as a stream from the beginning."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def text_lines(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """Each line as one opaque value: never split, so quoted commas stay as they are."""
    return spark.read.text(path).withColumnRenamed("value", name)


def write_table(rows: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a table and return it as read back.

    The default replaces the former content, which readers under way lose; a catalog table's
    publish keeps it for them. "errorifexists" refuses to.
    """
    rows.write.mode(mode).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
