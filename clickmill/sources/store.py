"""Outside stores, through whatever Spark connector is on the class path."""

from pyspark.sql import DataFrame


def write_store(rows: DataFrame, file_format: str, mode: str = "append", **options) -> None:
    """Write to a connector's table, named by its own options (database, table, address)."""
    rows.write.format(file_format).options(**options).mode(mode).save()
