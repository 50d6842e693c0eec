from clickmill.functions.codec import (
    classify_action,
    decode_clicks,
    delimited_fields,
    delimited_line,
    encode_json,
    encode_tsv,
    numbered,
    previous_page,
)
from clickmill.functions.hours import (
    date_parts,
    hour_bucket,
    hour_bucket_literal,
    hour_day,
    within_hours,
)

__all__ = [
    "classify_action",
    "date_parts",
    "decode_clicks",
    "delimited_fields",
    "delimited_line",
    "encode_json",
    "encode_tsv",
    "hour_bucket",
    "hour_bucket_literal",
    "hour_day",
    "numbered",
    "previous_page",
    "within_hours",
]
