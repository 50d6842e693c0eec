from clickmill.plans.jobs import (
    CLICK_ORDER,
    batch,
    batch_new_days,
    ingest,
    quarantine,
    serve,
    serve_visitors,
    speed_activity,
    speed_clicks,
    speed_sketches,
    speed_visitors,
)

__all__ = [
    "CLICK_ORDER",
    "batch",
    "batch_new_days",
    "ingest",
    "quarantine",
    "serve",
    "serve_visitors",
    "speed_activity",
    "speed_clicks",
    "speed_sketches",
    "speed_visitors",
]
