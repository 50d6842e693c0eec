"""DuckDB SQL for the registered queries, over the same parquet tables."""

# The referrers in it are fixed values.
CLICKS = """
WITH clicks AS (
  SELECT
    event_id,
    epoch_us(ts) // 1000 AS eventtime,
    (['Google', 'Bing', 'Yahoo', 'Twitter', 'Facebook', 'Other', 'Direct', 'Internal'])
      [event_id % 8 + 1] AS referrer,
    CASE event_type WHEN 'click' THEN 'add_to_cart' WHEN 'view' THEN 'page_view'
      ELSE event_type END AS action,
    CASE WHEN event_id % 8 = 7 THEN 'Page-' || (event_id % 15) ELSE '' END AS prevpage,
    'Visitor-' || user_id AS visitor,
    'Page-' || (event_id % 16) AS page,
    'Product-' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) AS product,
    epoch_us(ts) // 3600000000 * 3600000 AS timestamp_hour
  FROM events
)
"""

COUNTS = """
  CAST(sum(CASE WHEN action = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count,
  CAST(sum(CASE WHEN action = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS add_to_cart_count,
  CAST(sum(CASE WHEN action = 'page_view' THEN 1 ELSE 0 END) AS BIGINT) AS page_view_count
"""

ACTIVITY = f"""
  SELECT product, timestamp_hour, {COUNTS} FROM clicks GROUP BY product, timestamp_hour
"""

VISITORS = """
  SELECT product, timestamp_hour, count(DISTINCT visitor) AS unique_visitors
  FROM clicks GROUP BY product, timestamp_hour
"""

BOTH = f"""{CLICKS}, activity AS ({ACTIVITY}), visitors AS ({VISITORS})
  SELECT * FROM activity JOIN visitors USING (product, timestamp_hour)
"""

VISITORS_CLOSE = """
  SELECT product, timestamp_hour, count(DISTINCT visitor) AS unique_visitors, true AS close
  FROM clicks GROUP BY product, timestamp_hour
"""

LAYERS = f"""{CLICKS},
batch AS (
  SELECT product, timestamp_hour, {COUNTS} FROM clicks
  WHERE referrer IN ('Google', 'Bing', 'Yahoo')
  GROUP BY product, timestamp_hour
),
speed AS (
  SELECT product, timestamp_hour, {COUNTS} FROM clicks
  WHERE referrer NOT IN ('Google', 'Bing', 'Yahoo')
  GROUP BY product, timestamp_hour
)
"""

LANDED_COLUMNS = """
  eventtime, referrer, action, prevpage, visitor, page, product, timestamp_hour
"""

JSON_TEXT = """
  CAST(json_object('eventTime', eventtime, 'referrer', referrer, 'action', action,
    'prevPage', prevpage, 'visitor', visitor, 'page', page, 'product', product) AS VARCHAR)
"""

LAST_CLICK = """
  SELECT * EXCLUDE (position) FROM (
    SELECT {columns}, row_number() OVER (
      PARTITION BY product, timestamp_hour ORDER BY {order}) AS position
    FROM clicks
  ) WHERE position = 1
"""

ORACLE_SQL = {
    "click_events": f"{CLICKS} SELECT * FROM clicks",
    "parse_json": f"""{CLICKS}
        SELECT {LANDED_COLUMNS}, CAST(event_id % 8 AS INTEGER) AS partition,
               event_id // 8 AS "offset" FROM clicks""",
    "encode_json": f"{CLICKS} SELECT event_id, {JSON_TEXT} AS value FROM clicks",
    "encode_tsv": f"""{CLICKS}
        SELECT event_id, eventtime || chr(9) || CASE referrer WHEN 'Other' THEN '\\N' ELSE referrer END
          || chr(9) || action || chr(9) || prevpage || chr(9) || visitor || chr(9) || page
          || chr(9) || product AS line FROM clicks""",
    "delimited_parse": """
        SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, value, props,
               CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events""",
    "hour_bucket": f"{CLICKS} SELECT event_id, eventtime, timestamp_hour FROM clicks",
    "ingest_date_parts": """
        SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day FROM events""",
    "recent_hours": f"""{CLICKS}
        SELECT {LANDED_COLUMNS} FROM clicks WHERE 1706616000 - timestamp_hour / 1000 <= 60 * 60 * 6""",
    "activity_by_product": CLICKS + ACTIVITY,
    "visitors_by_product": CLICKS + VISITORS,
    "activity_view": CLICKS + ACTIVITY,
    "null_key_group": f"""{CLICKS}
        SELECT CASE WHEN action <> 'error' THEN product END AS product, timestamp_hour, {COUNTS}
        FROM clicks GROUP BY 1, 2""",
    "distinct_hour_product": f"{CLICKS} SELECT DISTINCT timestamp_hour, product FROM clicks",
    "last_write_per_key": CLICKS
    + LAST_CLICK.format(columns="*", order="eventtime DESC, event_id DESC"),
    "latest_hours": f"""{CLICKS}, activity AS ({ACTIVITY})
        SELECT * EXCLUDE (position) FROM (
          SELECT *, row_number() OVER (PARTITION BY product ORDER BY timestamp_hour DESC) AS position
          FROM activity
        ) WHERE position <= 3""",
    "serving_copy": CLICKS + ACTIVITY,
    "serving_update": f"""{LAYERS}
        SELECT product, timestamp_hour,
          b.purchase_count + coalesce(s.purchase_count, 0) AS purchase_count,
          b.add_to_cart_count + coalesce(s.add_to_cart_count, 0) AS add_to_cart_count,
          b.page_view_count + coalesce(s.page_view_count, 0) AS page_view_count
        FROM batch b LEFT JOIN speed s USING (product, timestamp_hour)""",
    "serving_insert": f"""{LAYERS}
        SELECT * FROM speed
        WHERE (timestamp_hour, product) NOT IN (SELECT timestamp_hour, product FROM batch)""",
    "not_in_null_semantics": f"""{CLICKS},
        batch AS (
          SELECT DISTINCT timestamp_hour,
            CASE WHEN visitor <> 'Visitor-7' THEN product END AS product
          FROM clicks WHERE referrer IN ('Google', 'Bing', 'Yahoo')),
        speed AS (
          SELECT DISTINCT timestamp_hour,
            CASE WHEN action <> 'error' THEN product END AS product
          FROM clicks WHERE referrer NOT IN ('Google', 'Bing', 'Yahoo'))
        SELECT timestamp_hour, product FROM speed
        WHERE (timestamp_hour, product) NOT IN (SELECT timestamp_hour, product FROM batch)""",
    "serving_merge": CLICKS + ACTIVITY,
    "serving_merge_cutoff": CLICKS + ACTIVITY,
    "serve": CLICKS + ACTIVITY,
    "serve_visitors": CLICKS + VISITORS_CLOSE,
    "serving_in_buckets": CLICKS + ACTIVITY,
    "batch_new_days": BOTH,
    "serving_insert_row": CLICKS + ACTIVITY + " UNION ALL SELECT 'Product-0', 0, 1, 2, 3",
    "visitors_hll": CLICKS + VISITORS_CLOSE,
    "stream_visitors_approx": CLICKS + VISITORS_CLOSE,
    "ingest_formats": f"""{CLICKS}
        SELECT {LANDED_COLUMNS}, 2024 AS year, 2 AS month, 1 AS day, unnest(['orc', 'json', 'csv']) AS format
        FROM clicks""",
    "stream_ingest": f"""{CLICKS}
        SELECT {LANDED_COLUMNS}, 2024 AS year, 2 AS month, 1 AS day FROM clicks""",
    "stream_ingest_batch": BOTH,
    "stream_activity": CLICKS + ACTIVITY,
    "stream_clicks": CLICKS
    + LAST_CLICK.format(
        columns=LANDED_COLUMNS,
        order="eventtime DESC, referrer DESC, action DESC, prevpage DESC, visitor DESC, page DESC",
    ),
    "stream_complete": CLICKS + ACTIVITY,
    "watermarked_hourly": f"""{CLICKS}, activity AS ({ACTIVITY})
        SELECT * FROM activity
        WHERE timestamp_hour + 3600000 <= (SELECT max(eventtime) FROM clicks) - 7200000""",
    "batch_write_modes": CLICKS + VISITORS,
    "product_lines": """
        SELECT p_brand || ',' || p_name AS product, count(*) AS listed FROM part GROUP BY 1""",
    "quarantine": f"""{CLICKS}, delivered AS (
          SELECT *, action <> 'error' AS accepted, CAST(event_id % 8 AS INTEGER) AS partition,
                 event_id // 8 AS "offset", {JSON_TEXT} AS json FROM clicks)
        SELECT CASE WHEN accepted THEN CAST(eventtime AS VARCHAR) END AS eventtime,
          CASE WHEN accepted THEN referrer END AS referrer,
          CASE WHEN accepted THEN action END AS action,
          CASE WHEN accepted THEN prevpage END AS prevpage,
          CASE WHEN accepted THEN visitor END AS visitor,
          CASE WHEN accepted THEN page END AS page,
          CASE WHEN accepted THEN product END AS product,
          CASE WHEN accepted THEN CAST(timestamp_hour AS VARCHAR) END AS timestamp_hour,
          'clicks' AS topic, partition, "offset", accepted,
          CASE WHEN NOT accepted THEN substr(json, 2) END AS payload FROM delivered""",
    "delivery_counts": f"""{CLICKS}
        SELECT unnest(['ingest', 'activity', 'visitors', 'sketches', 'batch']) AS job, count(*) AS received,
          count(*) FILTER (action = 'error') AS rejected FROM clicks""",
    "dedup_events": f"{CLICKS} SELECT {LANDED_COLUMNS} FROM clicks",
}
