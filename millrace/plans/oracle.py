"""The same queries as SQL over the test tables."""

from __future__ import annotations

from millrace.plans.views import EVENT_CUTS
from millrace.sources.customers import DOMAINS, WORDS

SENSOR = """
sensor AS (
  SELECT event_id,
         CASE WHEN event_id % 100 <> 0 THEN user_id END AS device_id,
         ts AS event_timestamp,
         value AS temperature_celsius,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS vibration_hz,
         event_type AS location
  FROM events
)"""

SUMMARY = (
    SENSOR
    + """,
summary AS (
  SELECT device_id, location,
         time_bucket(INTERVAL '30 seconds', event_timestamp) AS window_start,
         time_bucket(INTERVAL '30 seconds', event_timestamp) + INTERVAL '30 seconds' AS window_end,
         avg(temperature_celsius) AS avg_temp,
         max(temperature_celsius) AS max_temp,
         avg(vibration_hz) AS avg_vibration,
         count(*) AS reading_count
  FROM sensor
  WHERE device_id IS NOT NULL
  GROUP BY 1, 2, 3, 4
)"""
)

SUMMARY_COLUMNS = """device_id, location, window_start, window_end, round(avg_temp, 6) AS avg_temp,
  max_temp, round(avg_vibration, 6) AS avg_vibration, reading_count"""

SERVED = """
served AS (
  SELECT o_orderkey AS customer_id, o_orderpriority AS name, o_orderstatus AS email,
         CAST(o_custkey % 256 AS VARCHAR) AS ip_addr, CAST(o_custkey AS VARCHAR) AS phone,
         o_orderdate AS modified_ts
  FROM orders
)"""

# ISO text: six fraction digits, or none when they are zero.
ISO = """CASE WHEN microsecond(modified_ts) % 1000000 = 0
  THEN strftime(modified_ts, '%Y-%m-%dT%H:%M:%S')
  ELSE strftime(modified_ts, '%Y-%m-%dT%H:%M:%S.%f') END"""

TOKEN = f"""translate(base64(encode('{{"after":["' || {ISO} || '",' || customer_id || ']}}')), '+/', '-_')"""


def served(where: str = "TRUE", columns: str = "*") -> str:
    return f"WITH {SERVED} SELECT {columns} FROM served WHERE {where}"


def history(priority: str = "o_orderpriority") -> str:
    return f"""
changes AS (
  SELECT o_custkey AS customer_id, o_orderdate AS seq, o_orderkey AS tie,
         o_orderstatus, {priority} AS o_orderpriority
  FROM orders
),
last_per_seq AS (
  SELECT * FROM changes
  QUALIFY row_number() OVER (PARTITION BY customer_id, seq ORDER BY tie DESC) = 1
),
marked AS (
  SELECT *,
    row_number() OVER w = 1
    OR lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus
    OR lag(o_orderpriority) OVER w IS DISTINCT FROM o_orderpriority AS is_version
  FROM last_per_seq
  WINDOW w AS (PARTITION BY customer_id ORDER BY seq)
),
history AS (
  SELECT customer_id, o_orderstatus, o_orderpriority, seq AS "__START_AT",
         lead(seq) OVER (PARTITION BY customer_id ORDER BY seq) AS "__END_AT"
  FROM marked WHERE is_version
)"""


HISTORY = f"WITH {history()} SELECT * FROM history"


def _customer_details(seed: int = 42) -> str:
    def draw(number: int, size: int) -> str:
        return f"(('0x' || substr(digest, {number * 4 + 1}, 4))::INTEGER % {size})"

    def pick(number: int, choices: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{c}'" for c in choices)
        return f"([{listed}])[{draw(number, len(choices))} + 1]"

    def digits(number: int, size: int, width: int) -> str:
        return f"lpad(CAST({draw(number, size)} AS VARCHAR), {width}, '0')"

    name = " || ' ' || ".join(pick(i, WORDS) for i in (0, 1, 2))
    email = f"{pick(3, WORDS)} || '@' || {pick(4, WORDS)} || '.' || {pick(5, DOMAINS)}"
    address = " || '.' || ".join(draw(i, 256) for i in (6, 7, 8, 9))
    phone = f"{digits(10, 1000, 3)} || '-' || {digits(11, 1000, 3)} || '-' || {digits(12, 10000, 4)}"
    return f"""WITH drawn AS (
        SELECT c_custkey AS customer_id, sha256(c_custkey || '-{seed}') AS digest FROM customer)
      SELECT customer_id, {name} AS name, {email} AS email, {address} AS ip_addr, {phone} AS phone
      FROM drawn"""


AS_OF = "TIMESTAMP '2024-01-30 00:00:00' - INTERVAL '3' HOUR"
BEYOND = "(modified_ts, customer_id) < (TIMESTAMP '1998-10-03 00:00:00', 5000)"
NEWEST = "ORDER BY modified_ts DESC, customer_id DESC"
HOT = f"""WITH {SUMMARY} SELECT device_id, window_start, max_temp FROM summary
  WHERE max_temp >= 40.0 AND window_start >= {AS_OF}"""
INTERVALS = f"""{SUMMARY},
  hot AS (
    SELECT *, coalesce(window_start > lag(window_start) OVER d + INTERVAL '3 hours', TRUE) AS fires
    FROM summary WHERE max_temp >= 40.0 WINDOW d AS (PARTITION BY device_id, location ORDER BY window_start)),
  numbered AS (
    SELECT *, count(*) FILTER (fires) OVER (PARTITION BY device_id, location ORDER BY window_start) AS number FROM hot),
  intervals AS (
    SELECT device_id, location, min(window_start) AS fired_at, max(window_start) + INTERVAL '3 hours' AS cleared_at,
           max(max_temp) AS max_temp, count(*) AS hot_windows
    FROM numbered GROUP BY device_id, location, number)"""
SILVER = "device_id, event_timestamp, temperature_celsius, vibration_hz, location"

ORACLE: dict[str, str] = {
    "ingest_json": f"""WITH {SENSOR}
      SELECT event_id, CAST(device_id AS VARCHAR) AS device_id,
             strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
             temperature_celsius, vibration_hz, location
      FROM sensor""",
    "schema_evolution": f"""WITH {SENSOR}
      SELECT event_id, CAST(device_id AS VARCHAR) AS device_id,
             CASE WHEN event_timestamp < TIMESTAMP '2024-01-21'
                  THEN floor(temperature_celsius)
                  ELSE floor(temperature_celsius) + 0.5 END AS level,
             CASE WHEN event_timestamp >= TIMESTAMP '2024-01-11'
                  THEN round(temperature_celsius / 10, 6) END AS wetness
      FROM sensor""",
    "ingest_meta": """SELECT event_id, 'events.parquet' AS file_name, TRUE AS stamped FROM events""",
    "synthetic_customers": _customer_details(),
    "stream_silver": f"""WITH {SENSOR} SELECT {SILVER},
      CASE WHEN device_id IS NULL THEN 'quarantine' ELSE 'silver' END AS target FROM sensor""",
    "bad_times_quarantined": f"""WITH {SENSOR}, landed AS (
        SELECT *, device_id IS NOT NULL AND event_id % 7 <> 0 AS valid FROM sensor
        WHERE device_id IS NULL OR event_timestamp >= TIMESTAMP '2024-01-11')
      SELECT target, count(*) FILTER (WHERE target = 'bronze' OR valid = (target <> 'quarantine')) AS n
      FROM landed CROSS JOIN (VALUES ('bronze'), ('silver'), ('quarantine'), ('summary')) AS targets(target)
      GROUP BY target""",
    "pipeline_empty_batch": f"""WITH {SUMMARY.replace("WHERE device_id IS NOT NULL", """WHERE device_id IS NOT NULL
        AND event_id % 7 <> 0 AND event_timestamp >= TIMESTAMP '2024-01-11'""")}
      SELECT {SUMMARY_COLUMNS} FROM summary""",
    "incremental_equals_full": f"""WITH {SUMMARY}
      SELECT {SUMMARY_COLUMNS}, run FROM summary
      CROSS JOIN (VALUES ('incremental'), ('full')) AS runs(run)""",
    "silver_clean": f"WITH {SENSOR} SELECT {SILVER} FROM sensor",
    "parse_event_time": """SELECT event_id, ts AS naive, ts AS with_offset,
      CAST(NULL AS TIMESTAMP) AS malformed FROM events""",
    "api_projection": served(columns="customer_id, phone, modified_ts"),
    "api_filter_exact": served("name = '2-HIGH'"),
    "api_filter_id": served("customer_id = 1234"),
    "api_filter_ci": served("lower(email) = 'f'"),
    "api_filter_contains": served("contains(lower(name), 'not spec')"),
    "api_filter_time": served(
        "modified_ts >= TIMESTAMP '1996-01-01' AND modified_ts < TIMESTAMP '1998-07-01'"
    ),
    "api_filters_all": served(
        """lower(email) = 'p' AND name = '1-URGENT' AND contains(lower(name), 'urg')
           AND ip_addr = '7' AND modified_ts >= TIMESTAMP '1995-06-01'
           AND modified_ts < TIMESTAMP '2001-06-01'"""
    ),
    "param_query": served(
        "customer_id BETWEEN 100 AND 4000 AND phone LIKE '1%' ORDER BY customer_id LIMIT 70", "phone, customer_id"
    ),
    "dq_warn_counts": f"""WITH {SENSOR}
      SELECT 'valid_device_id' AS rule, count(device_id) AS passed,
             count(*) - count(device_id) AS failed FROM sensor
      UNION ALL
      SELECT 'warn_on_high_temp', count(*) FILTER (temperature_celsius < 40),
             count(*) - count(*) FILTER (temperature_celsius < 40) FROM sensor""",
    "dq_drop": f"WITH {SENSOR} SELECT * FROM sensor WHERE device_id IS NOT NULL",
    "dq_fail_passes": f"WITH {SENSOR} SELECT * FROM sensor",
    "dq_all_or_drop": f"""WITH {SENSOR} SELECT * FROM sensor
      WHERE device_id IS NOT NULL AND coalesce(temperature_celsius < 40, FALSE)""",
    "dq_quarantine": f"""WITH {SENSOR}
      SELECT *, concat_ws(',', CASE WHEN device_id IS NULL THEN 'valid_device_id' END,
        CASE WHEN NOT coalesce(temperature_celsius < 40, FALSE) THEN 'warn_on_high_temp' END)
        AS failed_rules
      FROM sensor WHERE device_id IS NULL OR NOT coalesce(temperature_celsius < 40, FALSE)""",
    "dq_split_counts": f"""WITH {SENSOR}
      SELECT CASE WHEN device_id IS NULL THEN 'quarantine' ELSE 'silver' END AS target,
             count(*) AS row_count FROM sensor GROUP BY 1""",
    "dq_metrics": f"""WITH {SENSOR},
      counts AS (
        SELECT count(*) AS n, count(*) FILTER (valid) AS kept, count(*) FILTER (NOT valid) AS dropped,
               count(*) FILTER (device_id IS NULL) AS no_device,
               count(*) FILTER (event_timestamp IS NULL) AS no_time,
               count(*) FILTER (valid AND coalesce(temperature_celsius < 40, FALSE)) AS cool
        FROM (SELECT *, device_id IS NOT NULL AND event_timestamp IS NOT NULL AS valid FROM sensor))
      SELECT 'bronze' AS table_name, 'rows_in' AS metric, n AS "value" FROM counts
      UNION ALL SELECT 'silver_drop', 'rows_in', n FROM counts
      UNION ALL SELECT 'silver_drop', 'rows_passed', kept FROM counts
      UNION ALL SELECT 'silver_drop', 'failed__valid_device_id', no_device FROM counts
      UNION ALL SELECT 'silver_drop', 'failed__valid_event_time', no_time FROM counts
      UNION ALL SELECT 'silver', 'rows_in', kept FROM counts
      UNION ALL SELECT 'silver', 'rows_passed', cool FROM counts
      UNION ALL SELECT 'silver', 'failed__warn_on_high_temp', kept - cool FROM counts
      UNION ALL SELECT 'quarantine', 'rows_in', dropped FROM counts
      UNION ALL SELECT 'summary', 'rows_in', kept FROM counts""",
    "device_summary": f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary",
    "location_mean": f"""WITH {SUMMARY}
      SELECT location, round(avg(avg_temp), 6) AS avg_temp FROM summary GROUP BY 1""",
    "location_mean_weighted": f"""WITH {SENSOR}
      SELECT location, round(avg(temperature_celsius), 6) AS avg_temp
      FROM sensor WHERE device_id IS NOT NULL GROUP BY 1""",
    "hot_devices": HOT,
    "hot_devices_pushdown": HOT,
    "alert_state": f"SELECT count(*) > 0 AS alert, count(*) AS hot_windows FROM ({HOT})",
    "alert_stream": f"""WITH {SUMMARY} SELECT device_id, location, window_start, max_temp
      FROM summary WHERE max_temp >= 40.0 AND window_start >= {AS_OF}""",
    "alert_intervals": f"""WITH {INTERVALS} SELECT * FROM intervals""",
    "alert_timeline": f"""WITH {INTERVALS}
      SELECT as_of, count(fired_at) > 0 AS alert, count(fired_at) AS devices
      FROM (VALUES ('2023-12-31 00:00:00'), ('2024-01-15 12:00:00'), ('2024-02-15 00:00:00')) AS times(as_of)
      LEFT JOIN intervals ON CAST(as_of AS TIMESTAMP) BETWEEN fired_at AND cleared_at GROUP BY as_of""",
    "customer_pipeline": f"""WITH {history("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END")}
      SELECT customer_id, o_orderstatus AS name, o_orderpriority AS email, "__START_AT" AS modified_ts
      FROM history WHERE "__END_AT" IS NULL""",
    "customer_metrics": f"""WITH {history("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END")},
      counts AS (SELECT count(*) AS n FROM orders),
      open_rows AS (SELECT count(*) AS n, count(o_orderpriority) AS kept FROM history WHERE "__END_AT" IS NULL)
      SELECT 'raw_customers' AS table_name, 'rows_in' AS metric, n AS "value" FROM counts
      UNION ALL SELECT 'customer_history', 'rows_in', n FROM counts
      UNION ALL SELECT 'customer_history', 'rows_passed', n FROM counts
      UNION ALL SELECT 'customer_history', 'failed__valid_customer', 0 FROM counts
      UNION ALL SELECT 'history', 'rows_in', n FROM counts
      UNION ALL SELECT 'history', 'dropped__no_key', 0 FROM counts
      UNION ALL SELECT 'current_customers', 'rows_in', n FROM open_rows
      UNION ALL SELECT 'current_customers', 'rows_passed', kept FROM open_rows
      UNION ALL SELECT 'current_customers', 'failed__valid_email', n - kept FROM open_rows""",
    "stream_summary_append": f"""WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary
      WHERE window_end <= (SELECT max(event_timestamp) FROM sensor WHERE device_id IS NOT NULL)
                          - INTERVAL '2 minutes'""",
    "unpacked_arrays": "SELECT event_id, value, props FROM events",
    "late_rows_accounted": f"""WITH {SENSOR},
      arriving AS (
        SELECT location, event_timestamp AS t,
               least(2, (event_timestamp >= TIMESTAMP '{EVENT_CUTS[0]}')::INT
                        + (event_timestamp >= TIMESTAMP '{EVENT_CUTS[1]}')::INT + (event_id % 50 = 7)::INT) AS arrival
        FROM sensor WHERE device_id IS NOT NULL AND event_timestamp IS NOT NULL),
      ends AS (SELECT arrival, max(t) AS last FROM arriving GROUP BY arrival),
      closing AS (
        SELECT n AS arrival, time_bucket(INTERVAL '30 seconds', max(last) - INTERVAL '2 minutes') AS closed
        FROM range(4) AS r(n) JOIN ends ON ends.arrival < n GROUP BY n),
      judged AS (
        SELECT location, CASE WHEN t < c.closed THEN 'late' WHEN t < f.closed THEN 'closed' ELSE 'open' END AS kind
        FROM arriving a LEFT JOIN closing c USING (arrival) JOIN closing f ON f.arrival = 3)
      SELECT location, kind, count(*) AS n FROM judged GROUP BY ALL""",
    "stream_summary_complete": f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary",
    "stream_summary_partials": f"WITH {SUMMARY} SELECT {SUMMARY_COLUMNS} FROM summary",
    "scd2_history": HISTORY,
    "scd2_current": f"""WITH {history()}
      SELECT customer_id, o_orderstatus, o_orderpriority, "__START_AT" AS modified_ts
      FROM history WHERE "__END_AT" IS NULL""",
    "scd2_null_update": f"""WITH {history("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END")}
      SELECT * FROM history""",
    "scd2_incremental": HISTORY,
    "scd2_out_of_order": HISTORY,
    "change_feed": """WITH
      old_rows AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-02-01'),
      new_rows AS (
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
                               THEN 'F' ELSE o_orderstatus END AS o_orderstatus)
        FROM orders
        WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01'))
      SELECT *, 'insert' AS _change_type FROM new_rows
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old_rows)
      UNION ALL SELECT *, 'delete' FROM old_rows
        WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new_rows)
      UNION ALL SELECT o.*, 'update_preimage' FROM old_rows o JOIN new_rows n USING (o_orderkey)
        WHERE o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
      UNION ALL SELECT n.*, 'update_postimage' FROM old_rows o JOIN new_rows n USING (o_orderkey)
        WHERE o.o_orderstatus IS DISTINCT FROM n.o_orderstatus""",
    "page_first": served(f"TRUE {NEWEST} LIMIT 50"),
    "page_after": served(f"{BEYOND} {NEWEST} LIMIT 200"),
    "page_at": f"""WITH {SERVED}
      SELECT * EXCLUDE (n), CAST(n // 70 + 1 AS INTEGER) AS page_no
      FROM (SELECT *, row_number() OVER ({NEWEST}) - 1 AS n FROM served)
      WHERE n // 70 + 1 IN (1, 9, 22)""",
    "all_pages": f"""WITH {SERVED}
      SELECT customer_id, modified_ts, n // 150 + 1 AS page_no, n % 150 + 1 AS row_in_page
      FROM (SELECT *, row_number() OVER ({NEWEST}) - 1 AS n FROM served)""",
    "page_projection": served(f"{BEYOND} {NEWEST} LIMIT 20", "name, phone"),
    "page_summary": f"""WITH {SERVED},
      hits AS (
        SELECT *, row_number() OVER ({NEWEST}) AS n FROM served
        WHERE lower(email) = 'p' AND contains(lower(name), 'urgent')
          AND modified_ts < TIMESTAMP '2001-01-01'),
      page AS (
        SELECT n, {TOKEN} AS token,
               '{{"customer_id":' || customer_id || ',"name":"' || name || '","modified_ts":"'
               || {ISO} || '"}}' AS item
        FROM hits WHERE n <= 6)
      SELECT CAST(count(*) FILTER (n <= 5) AS INTEGER) AS "count",
             '[' || string_agg(item, ',' ORDER BY n) FILTER (n <= 5) || ']' AS items,
             CASE WHEN count(*) > 5 THEN max(token) FILTER (n = 5) END AS next_cursor,
             count(*) > 5 AS has_more
      FROM page""",
    "keyset_after": served(BEYOND),
    "cursor_roundtrip": f"""WITH {SERVED}
      SELECT {TOKEN} AS "cursor", modified_ts, customer_id FROM served""",
    "export_pages": f"""WITH {SERVED},
      numbered AS (SELECT *, row_number() OVER ({NEWEST}) - 1 AS n FROM served)
      SELECT customer_id, modified_ts, n // 200 + 1 AS page_no, n % 200 + 1 AS row_in_page
      FROM numbered""",
    "items_json": f"""WITH {SERVED}
      SELECT '{{"customer_id":' || customer_id || ',"name":"' || name || '","email":"' || email
             || '","ip_addr":"' || ip_addr || '","phone":"' || phone || '","modified_ts":"'
             || {ISO} || '"}}' AS item
      FROM served""",
}
ORACLE["change_feed_digests"] = ORACLE["change_feed"]
