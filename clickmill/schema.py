"""Column contracts shared by every job."""

from pyspark.sql.types import (
    BinaryType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _LONG, _INT = StringType(), LongType(), IntegerType()

# Wire formats, table layouts and names other systems rely on.
KAFKA_ROW = _struct(
    key=BinaryType(),
    value=BinaryType(),
    topic=_TEXT,
    partition=_INT,
    offset=_LONG,
    timestamp=TimestampType(),
    timestampType=_INT,
)
CLICK_EVENT = _struct(
    eventTime=_LONG,
    referrer=_TEXT,
    action=_TEXT,
    prevPage=_TEXT,
    visitor=_TEXT,
    page=_TEXT,
    product=_TEXT,
)
ACTIVITY = _struct(
    eventtime=_LONG,
    referrer=_TEXT,
    action=_TEXT,
    prevpage=_TEXT,
    visitor=_TEXT,
    page=_TEXT,
    product=_TEXT,
    timestamp_hour=_LONG,
)
ACTIVITY_BY_PRODUCT = _struct(
    product=_TEXT,
    timestamp_hour=_LONG,
    purchase_count=_LONG,
    add_to_cart_count=_LONG,
    page_view_count=_LONG,
)
VISITORS_BY_PRODUCT = _struct(
    product=_TEXT,
    timestamp_hour=_LONG,
    unique_visitors=_LONG,
)
TABLES = {
    "stream_click_events": ACTIVITY,
    "stream_activity_by_product": ACTIVITY_BY_PRODUCT,
    "stream_visitors_by_product": VISITORS_BY_PRODUCT,
    "batch_activity_by_product": ACTIVITY_BY_PRODUCT,
    "batch_visitors_by_product": VISITORS_BY_PRODUCT,
}
VISITOR_SKETCHES = _struct(product=_TEXT, timestamp_hour=_LONG, visitors=BinaryType())
VISITS = _struct(
    product=_TEXT,
    timestamp_hour=_LONG,
    visitor=_TEXT,
    purchase_count=_LONG,
    add_to_cart_count=_LONG,
    page_view_count=_LONG,
    ingest_day=DateType(),
)
BATCH_TABLES = [name for name in TABLES if name.startswith("batch_")]
KEYS = ["product", "timestamp_hour"]
INGEST_DATE = ["year", "month", "day"]
COUNTED_ACTIONS = {
    "purchase_count": "purchase",
    "add_to_cart_count": "add_to_cart",
    "page_view_count": "page_view",
}
MS_PER_HOUR = 3_600_000

COUNTS = list(COUNTED_ACTIONS)
EVENT_COLUMNS = [f.name for f in ACTIVITY if f.name != "timestamp_hour"]
