from clickmill.streaming.counts import DeliveryListener, delivered
from clickmill.streaming.day_table import DayTable
from clickmill.streaming.hourly import (
    watermarked_counts,
    watermarked_sketches,
    watermarked_visitors,
)
from clickmill.streaming.sinks import (
    RowWriter,
    start_console,
    start_files,
    start_foreach,
    start_kafka,
    start_memory,
    start_replace,
    start_upsert,
)
from clickmill.streaming.store_table import StoreTable

__all__ = [
    "DayTable",
    "DeliveryListener",
    "RowWriter",
    "StoreTable",
    "delivered",
    "start_console",
    "start_files",
    "start_foreach",
    "start_kafka",
    "start_memory",
    "start_replace",
    "start_upsert",
    "watermarked_counts",
    "watermarked_sketches",
    "watermarked_visitors",
]
