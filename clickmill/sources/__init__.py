from clickmill.sources.catalog import (
    create_database,
    create_keyed_table,
    create_tables,
    list_columns,
    list_databases,
    list_tables,
    overwrite_days,
    publish,
    state_counts,
    state_cutoff,
    stated_counts,
    stated_cutoff,
    swap_table,
)
from clickmill.sources.files import (
    close_day,
    closed_days,
    event_stream,
    file_options,
    landed,
    landed_days,
    text_lines,
    write_table,
)
from clickmill.sources.kafka import kafka_options, kafka_stream, kafka_values, write_kafka
from clickmill.sources.store import write_store

__all__ = [
    "close_day",
    "closed_days",
    "create_database",
    "create_keyed_table",
    "create_tables",
    "event_stream",
    "file_options",
    "kafka_options",
    "kafka_stream",
    "kafka_values",
    "landed",
    "landed_days",
    "list_columns",
    "list_databases",
    "list_tables",
    "overwrite_days",
    "publish",
    "state_counts",
    "state_cutoff",
    "stated_counts",
    "stated_cutoff",
    "swap_table",
    "text_lines",
    "write_kafka",
    "write_store",
    "write_table",
]
