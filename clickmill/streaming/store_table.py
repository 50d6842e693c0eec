"""A keyed table in an outside store that has a Spark connector."""

from pyspark.sql import DataFrame

from clickmill.schema import KEYS
from clickmill.sources.store import write_store


class StoreTable:
    """For stores in which appending a row replaces the one with the same key.

    `order` picks the last row of a key within a micro-batch; between them the store keeps the
    one that came last, unless it compares them itself, as by a write time.
    """

    def __init__(self, file_format: str, keys: list[str] = KEYS, order: list[str] | None = None, **options):
        self.file_format = file_format
        self.keys = list(keys)
        self.order = order
        self.options = options

    def check(self, checkpoint: str) -> None:
        """Nothing to check: the store does not tell which checkpoint filled it."""

    def bind(self, checkpoint: str) -> None:
        """Nothing to note, for the same reason."""

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """A replay sends the same rows again, which changes nothing."""
        write_store(rows.dropna(subset=self.keys), self.file_format, "append", **self.options)
