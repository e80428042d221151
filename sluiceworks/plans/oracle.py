"""The expected result of each acceptance query, as SQL over the same tables."""

from __future__ import annotations

_OFFSETS = """
    SELECT CAST(event_id AS VARCHAR) AS key,
           CAST(event_id % 3 AS INTEGER) AS "partition",
           event_id // 3 AS "offset"
    FROM events
"""

_VIEWS = """
    SELECT event_id AS imp_id, user_id AS imp_user, ts AS imp_ts
    FROM events WHERE event_type = 'view'
"""
_CLICKS = """
    SELECT event_id AS clk_id, user_id AS clk_user, ts AS clk_ts
    FROM events WHERE event_type = 'click'
"""

_ORDERS_IN_TWO = """
    SELECT *, CAST(CASE WHEN o_orderdate <= TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END AS BIGINT)
        AS "batchId"
    FROM orders
"""

_FIFTHS = """
    SELECT {columns}, CAST(CASE
        WHEN event_id <= top // 5 THEN 0
        WHEN event_id <= top * 2 // 5 THEN 1
        WHEN event_id <= top * 3 // 5 THEN 2
        WHEN event_id <= top * 4 // 5 THEN 3
        ELSE 4 END AS BIGINT) AS "batchId"
    FROM events, (SELECT max(event_id) AS top FROM events)
"""

_LATEST_DIGEST = """
    SELECT md5(CAST(event_id AS VARCHAR)) AS md5, event_id AS value,
           event_id % 100 AS {bucket}, ts AS "timestamp"
    FROM events
    QUALIFY row_number() OVER (PARTITION BY event_id % 100 ORDER BY event_id DESC) = 1
"""

# the newest third of the time axis comes first, so what of the rest is 18 days behind its end is late
_LATE = """
    SELECT events.*, ts < hi - INTERVAL 18 DAYS
                     AND epoch_us(ts) <= epoch_us(lo) + 2 * ((epoch_us(hi) - epoch_us(lo)) / 3) AS late
    FROM events, (SELECT min(ts) AS lo, max(ts) AS hi FROM events)
"""

_LATEST_EVENT = """
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
"""

ORACLE: dict[str, str] = {
    "rate_source": "SELECT event_id, event_type, value FROM events",
    "csv_feed": "SELECT * FROM events WHERE event_id % 10 <> 0",
    "csv_feed_rejected": "SELECT event_id FROM events WHERE event_id % 10 = 0",
    "csv_quoted": """
        SELECT *, props || ' says "' || event_type || '",' || chr(10) || 'then, "' || chr(10) || chr(10)
                  || '",' || user_id AS note
        FROM events WHERE event_id % 10 <> 0
    """,
    "csv_quoted_rejected": "SELECT event_id, 3 AS breaks FROM events WHERE event_id % 10 = 0",
    "table_stream_copy": "SELECT * FROM orders",
    "table_overwrite": "SELECT * FROM orders",
    "hash_projection": """
        SELECT md5(CAST(event_id AS VARCHAR)) AS md5, event_id AS value,
               event_id % 100 AS id, ts AS "timestamp"
        FROM events
    """,
    "filter_ieq": "SELECT * FROM events WHERE lower(event_type) = 'view'",
    "flag_ieq": "SELECT event_id, lower(event_type) = 'view' AS is_view FROM events",
    "timed_copy": "SELECT *, false AS ended FROM orders",
    "late_rows": """
        WITH ends AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
        marks AS (SELECT lo + (hi - lo) / 2 AS middle,
                         (hi - 18 * 86400000000::BIGINT) // 1000 * 1000 AS mark FROM ends)
        SELECT events.* FROM events, marks
        WHERE epoch_us(ts) > middle OR epoch_us(ts) > mark
    """,
    "late_kept": _LATE,
    "late_kept_counts": f"""
        SELECT date_trunc('day', ts) AS day, count(*) AS n FROM ({_LATE}) WHERE NOT late GROUP BY 1
    """,
    "topic_latest_restart": f"""
        SELECT * FROM ({_OFFSETS})
        WHERE "offset" * 3 + "partition" > (SELECT max(event_id) // 2 FROM events)
    """,
    "day_of_week": """
        SELECT o_orderkey, o_orderdate, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday
        FROM orders
    """,
    "envelope_roundtrip": "SELECT * FROM events",
    "envelope_value_only": """
        SELECT CAST(NULL AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS value FROM events
    """,
    "envelope_malformed": """
        SELECT CAST(event_id AS VARCHAR) AS key,
               CASE WHEN event_id % 7 <> 0 THEN event_id END AS event_id,
               CASE WHEN event_id % 7 <> 0 THEN ts END AS ts,
               CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
               CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
               CASE WHEN event_id % 7 <> 0 THEN value END AS value,
               CASE WHEN event_id % 7 <> 0 THEN props END AS props
        FROM events
    """,
    "topic_earliest": _OFFSETS,
    "topic_from_offsets": f"""
        SELECT * FROM ({_OFFSETS})
        WHERE "offset" >= CASE "partition" WHEN 0 THEN 1 WHEN 1 THEN 100 ELSE 0 END
    """,
    "topic_offset_range": f"""
        SELECT * FROM ({_OFFSETS})
        WHERE CASE "partition" WHEN 0 THEN "offset" BETWEEN 1 AND 199
                               WHEN 1 THEN "offset" >= 100
                               ELSE "offset" = 50 END
    """,
    "jdbc_roundtrip": "SELECT * FROM customer",
    "offset_bounds": "SELECT min(ts) AS lo, max(ts) AS hi FROM events",
    "incr_first_earliest": "SELECT * FROM events",
    "incr_first_latest": "SELECT * FROM events WHERE ts = (SELECT max(ts) FROM events)",
    "incr_first_specific": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15'",
    "incr_next": _ORDERS_IN_TWO,
    "incr_no_change": 'SELECT *, CAST(0 AS BIGINT) AS "batchId" FROM orders',
    "incr_restart": _ORDERS_IN_TWO,
    "incr_bounded": "SELECT * FROM orders",
    "incr_jdbc": _ORDERS_IN_TWO,
    "incr_late": """
        WITH ended AS (SELECT max(o_orderdate) AS last_day FROM orders
                       WHERE o_orderdate <= TIMESTAMP '1998-01-01' AND o_orderkey % 5 <> 0)
        SELECT orders.* FROM orders, ended
        WHERE o_orderkey % 5 <> 0 OR o_orderdate > last_day - INTERVAL 365 DAYS
    """,
    "incr_bounded_text": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS day, true AS bounded
        FROM orders WHERE o_orderkey % 50 <> 0
    """,
    "incr_bounded_times": "SELECT *, true AS several FROM orders",
    "incr_bounded_jdbc": "SELECT *, true AS several FROM orders",
    "stream_jdbc": "SELECT * FROM events",
    "join_inner_key": """
        SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "join_inner_kept": f"""
        SELECT * FROM ({_VIEWS}) JOIN ({_CLICKS})
        ON imp_user = clk_user
           AND clk_ts BETWEEN imp_ts - INTERVAL 2 DAY AND imp_ts + INTERVAL 2 DAY
    """,
    "join_inner_interval": f"""
        SELECT * FROM ({_VIEWS}) JOIN ({_CLICKS})
        ON imp_user = clk_user AND clk_ts BETWEEN imp_ts AND imp_ts + INTERVAL 6 HOUR
    """,
    # an unmatched row appears once the watermark has passed its last possible partner
    "join_left_outer_interval": f"""
        WITH v AS ({_VIEWS}), c AS ({_CLICKS}),
        w AS (SELECT date_trunc('milliseconds', least(
                (SELECT max(imp_ts) FROM v) - INTERVAL 20 MINUTE,
                (SELECT max(clk_ts) FROM c) - INTERVAL 30 MINUTE)) AS wm)
        SELECT imp_id, imp_user, imp_ts, clk_id, clk_user, clk_ts
        FROM v LEFT JOIN c
        ON imp_user = clk_user AND clk_ts BETWEEN imp_ts AND imp_ts + INTERVAL 6 HOUR, w
        WHERE clk_id IS NOT NULL OR imp_ts < wm - INTERVAL 6 HOUR
    """,
    "join_left_outer_table": """
        WITH l AS (SELECT o_orderkey AS l_key, o_custkey AS l_cust, o_orderdate AS l_ts
                   FROM orders WHERE o_orderstatus = 'O'),
        r AS (SELECT o_orderkey AS r_key, o_custkey AS r_cust, o_orderdate AS r_ts
              FROM orders WHERE o_orderstatus = 'F'),
        w AS (SELECT least((SELECT max(l_ts) FROM l), (SELECT max(r_ts) FROM r))
                     - INTERVAL 5 DAY AS wm)
        SELECT l_key, l_cust, l_ts, r_key, r_cust, r_ts
        FROM l LEFT JOIN r
        ON l_cust = r_cust AND l_ts BETWEEN r_ts AND r_ts + INTERVAL 90 DAY, w
        WHERE r_key IS NOT NULL OR l_ts < wm
    """,
    "join_batch_interval": f"""
        SELECT * FROM ({_VIEWS}) LEFT JOIN ({_CLICKS})
        ON imp_user = clk_user AND clk_ts BETWEEN imp_ts AND imp_ts + INTERVAL 6 HOUR
    """,
    "join_hot_both": """
        SELECT o_orderkey, o_key, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS sum_custkey
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey END AS o_key
              FROM orders)
        JOIN (SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 0 ELSE c_custkey END AS c_key
              FROM customer) ON o_key = c_key
        GROUP BY ALL
    """,
    "append_with_batch_id": _FIFTHS.format(columns="events.*"),
    "append_replay": _FIFTHS.format(columns="events.*"),
    "append_two_runs": 'SELECT *, CAST(0 AS BIGINT) AS "batchId" FROM events',
    "append_two_checkpoints": 'SELECT *, CAST(0 AS BIGINT) AS "batchId" FROM events',
    "append_jdbc": _FIFTHS.format(columns="events.*"),
    "foreach_insert": "SELECT * FROM events",
    "db_upsert_batch": _LATEST_DIGEST.format(bucket="hash"),
    "db_upsert_row": _LATEST_DIGEST.format(bucket="hash"),
    "db_insert_absent": """
        SELECT event_id, ts, user_id, CASE WHEN event_id % 3 <> 0 THEN value ELSE value + 1 END AS value
        FROM events
    """,
    "merge_upsert": _LATEST_EVENT,
    "merge_digests": _LATEST_DIGEST.format(bucket="id"),
    "merge_schema_evolution": f"""
        SELECT e.*, CASE WHEN event_id > (SELECT max(event_id) // 2 FROM events)
                         THEN value * 2 END AS doubled
        FROM ({_LATEST_EVENT}) e
    """,
    "merge_nested_evolution": """
        SELECT first::INTEGER AS first, event_id, json_extract(props, '$.k')::BIGINT AS k, event_type,
               CASE WHEN event_id > half THEN value END AS value, user_id,
               CASE WHEN event_id > half THEN ts END AS ts
        FROM events, (SELECT max(event_id) // 2 AS half FROM events), (SELECT unnest([0, 1]) AS first)
    """,
    "merge_absent_columns": """
        WITH cut AS (SELECT max(event_id) // 2 AS half FROM events),
        a AS (SELECT * FROM events, cut WHERE event_id <= half
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
        b AS (SELECT * FROM events, cut WHERE event_id > half
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
        SELECT coalesce(b.event_id, a.event_id) AS event_id, a.ts AS ts,
               coalesce(b.user_id, a.user_id) AS user_id, a.event_type AS event_type,
               CASE WHEN b.user_id IS NULL THEN a.value ELSE b.value END AS value,
               a.props AS props
        FROM a FULL JOIN b ON a.user_id = b.user_id
    """,
    "merge_two_runs": _LATEST_EVENT,
    "merge_orders": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN -o_totalprice
                               WHEN o_orderkey % 7 = 0 THEN o_totalprice * 2
                               ELSE o_totalprice END AS o_totalprice,
                          CASE WHEN o_orderkey % 3 = 0 THEN 'third' ELSE o_orderstatus END AS o_orderstatus)
        FROM orders
    """,
    # eight buckets, all of them in use
    "compact_table": f"SELECT *, true AS packed, CAST(8 AS INTEGER) AS files FROM ({_LATEST_EVENT})",
    "vacuum_table": f"SELECT *, true AS deleted, CAST(8 AS INTEGER) AS folders FROM ({_LATEST_EVENT})",
}
ORACLE["join_hot_interval"] = ORACLE["join_left_outer_interval"]
