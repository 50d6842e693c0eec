from clickmill.operators.aggregates import (
    action_counts,
    activity_by_product,
    distinct_keys,
    in_key_order,
    key_order,
    last_write_per_key,
    latest_hours,
    rollup_by_product,
    visitors_by_product,
)
from clickmill.operators.quality import (
    DELIVERED,
    counted,
    drop_duplicate_events,
    has_key,
    split_malformed,
)
from clickmill.operators.serving import apply_updates, merge, merge_in_place, missing_rows, not_in
from clickmill.operators.sketches import (
    approx_visitors_by_product,
    estimate_visitors,
    merge_sketches,
    serve_sketches,
    visitor_sketches,
)

__all__ = [
    "DELIVERED",
    "action_counts",
    "activity_by_product",
    "apply_updates",
    "approx_visitors_by_product",
    "counted",
    "distinct_keys",
    "drop_duplicate_events",
    "estimate_visitors",
    "has_key",
    "in_key_order",
    "key_order",
    "last_write_per_key",
    "latest_hours",
    "merge",
    "merge_in_place",
    "merge_sketches",
    "missing_rows",
    "not_in",
    "rollup_by_product",
    "serve_sketches",
    "split_malformed",
    "visitor_sketches",
    "visitors_by_product",
]
