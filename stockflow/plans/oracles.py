"""SQL equivalents of the registered queries, written for DuckDB.

Each text is a chain of common table expressions over the given tables and a
final select; queries without an SQL equivalent (fitted models, isolation
forests) have none.
"""

from __future__ import annotations

from stockflow.fixed_values import (
    ANSWERS,
    DEFAULT_ANSWER,
    DRILL_CATEGORIES,
    DRILL_STORES,
    HEADLINE,
    NUMERICAL_CLOSING,
    PIPELINE_CLOSING,
)

TEXT_TIME = "'%Y-%m-%d %H:%M:%S'"
ISO_TIME = "'%Y-%m-%dT%H:%M:%SZ'"
ORACLES: dict[str, str] = {}


def chain(*steps: tuple[str, str], final: str) -> str:
    body = ",\n".join(f"{name} AS ({text.strip()})" for name, text in steps)
    return f"WITH {body}\n{final.strip()}"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


EVENTS = (
    "inv",
    f"""
    SELECT 'P' || user_id AS product_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity,
           value AS price,
           strftime(ts, {ISO_TIME}) AS event_timestamp,
           'S' || (user_id % 5) AS store_location,
           event_type AS category,
           ts
    FROM events
    """,
)

LINES = (
    "inv",
    f"""
    SELECT 'P' || p_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           p_retailprice AS price,
           strftime(l_shipdate, {ISO_TIME}) AS event_timestamp,
           n_name AS store_location,
           p_type AS category,
           l_shipdate AS ts,
           l_linestatus AS line_status
    FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    """,
)

HOURLY = (
    "hourly",
    """
    SELECT product_id, store_location, category,
           date_trunc('hour', ts) AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           avg(price) AS avg_price,
           sum(quantity * price) AS total_stock_value
    FROM inv WHERE ts IS NOT NULL
    GROUP BY 1, 2, 3, 4, 5
    """,
)

FLAT = (
    "flat",
    """
    SELECT product_id, store_location, category,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           avg(price) AS avg_price,
           sum(quantity * price) AS total_stock_value,
           min(event_timestamp) AS event_timestamp
    FROM inv GROUP BY 1, 2, 3
    """,
)

CATEGORY = (
    "cat",
    "SELECT category, sum(total_stock_value) AS stock_value_by_category FROM hourly GROUP BY 1",
)

METRICS = (
    "metrics",
    f"""
    SELECT product_id, store_location, category,
           strftime(window_start, {TEXT_TIME}) AS event_timestamp,
           coalesce(total_quantity, 0) AS total_quantity,
           coalesce(avg_price, 0) AS avg_price,
           coalesce(total_stock_value, 0) AS total_stock_value,
           CAST(NULL AS DOUBLE) AS moving_avg_stock_value,
           CAST(NULL AS DOUBLE) AS turnover_rate,
           coalesce(stock_value_by_category, 0) AS stock_value_by_category
    FROM hourly JOIN cat USING (category)
    """,
)

MOVING = """
    avg(total_stock_value) OVER (
        ORDER BY event_timestamp NULLS FIRST, store_location NULLS FIRST,
                 category NULLS FIRST, product_id NULLS FIRST
        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""
TURNOVER = "total_quantity / (total_quantity + stock_value_by_category + 1e-10)"

ORACLES["parse_events"] = chain(
    EVENTS,
    (
        "damaged",
        """
        SELECT * REPLACE (CASE WHEN quantity < 5 THEN NULL
                               WHEN quantity < 10 THEN strftime(ts, '%Y/%m/%d %H:%M')
                               ELSE event_timestamp END AS event_timestamp) FROM inv
        """,
    ),
    final=f"""
    SELECT product_id, quantity, price, coalesce(event_timestamp, '') AS event_timestamp,
           store_location, category,
           CASE WHEN quantity >= 10 THEN strftime(ts, {TEXT_TIME}) END AS ts
    FROM damaged
    """,
)

HOURLY_RESULT = f"""
    SELECT product_id, store_location, category,
           strftime(window_start, {TEXT_TIME}) AS window_start,
           strftime(window_end, {TEXT_TIME}) AS window_end,
           total_quantity, round(avg_price, 8) AS avg_price,
           round(total_stock_value, 2) AS total_stock_value
    FROM hourly
"""
ORACLES["hourly_metrics"] = chain(EVENTS, HOURLY, final=HOURLY_RESULT)
ORACLES["stream_hourly_metrics"] = ORACLES["hourly_metrics"]

ORACLES["flat_metrics"] = chain(
    EVENTS,
    FLAT,
    final="""
    SELECT product_id, store_location, category, total_quantity,
           round(avg_price, 8) AS avg_price,
           round(total_stock_value, 2) AS total_stock_value, event_timestamp
    FROM flat
    """,
)

ORACLES["flat_metrics_by_event"] = chain(
    EVENTS,
    FLAT,
    final="""
    SELECT f.product_id, f.store_location, f.category, f.total_quantity,
           round(f.avg_price, 8) AS avg_price,
           round(f.total_stock_value, 2) AS total_stock_value, i.event_timestamp
    FROM flat f LEFT JOIN inv i
      ON f.product_id = i.product_id AND f.store_location = i.store_location
     AND f.category = i.category
    """,
)

ORACLES["category_stock"] = chain(
    EVENTS,
    HOURLY,
    CATEGORY,
    final="""
    SELECT category, round(stock_value_by_category, 2) AS stock_value_by_category FROM cat
    """,
)

ORACLES["stock_metrics"] = chain(
    EVENTS,
    HOURLY,
    CATEGORY,
    METRICS,
    final="""
    SELECT * REPLACE (round(avg_price, 8) AS avg_price,
                      round(total_stock_value, 2) AS total_stock_value,
                      round(stock_value_by_category, 2) AS stock_value_by_category)
    FROM metrics
    """,
)

ORACLES["moving_average"] = chain(
    EVENTS,
    HOURLY,
    CATEGORY,
    METRICS,
    final=f"""
    SELECT product_id, store_location, category, event_timestamp,
           round({MOVING}, 4) AS moving_avg_stock_value
    FROM metrics
    """,
)

ORACLES["turnover_rate"] = chain(
    EVENTS,
    HOURLY,
    CATEGORY,
    METRICS,
    final=f"""
    SELECT product_id, store_location, category, event_timestamp,
           round({TURNOVER}, 12) AS turnover_rate
    FROM metrics
    """,
)

ORACLES["post_processed_metrics"] = chain(
    LINES,
    HOURLY,
    CATEGORY,
    METRICS,
    final=f"""
    SELECT product_id, store_location, category, event_timestamp, total_quantity,
           round(avg_price, 8) AS avg_price,
           round(total_stock_value, 2) AS total_stock_value,
           round({MOVING}, 4) AS moving_avg_stock_value,
           round({TURNOVER}, 12) AS turnover_rate,
           round(stock_value_by_category, 2) AS stock_value_by_category
    FROM metrics
    """,
)

INVENTORY_COLUMNS = "product_id, quantity, price, event_timestamp, store_location, category"

ORACLES["ingest_new_rows"] = chain(
    LINES,
    final=f"""
    SELECT {INVENTORY_COLUMNS} FROM inv i
    WHERE NOT EXISTS (
        SELECT 1 FROM inv s
        WHERE s.line_status = 'F'
          AND s.product_id IS NOT DISTINCT FROM i.product_id
          AND s.event_timestamp IS NOT DISTINCT FROM i.event_timestamp
          AND s.store_location IS NOT DISTINCT FROM i.store_location)
    """,
)

ORACLES["publish_json"] = chain(
    LINES,
    final="""
    SELECT '{"product_id":"' || product_id || '","quantity":' || quantity
           || ',"price":' || price || ',"event_timestamp":"' || event_timestamp
           || '","store_location":"' || store_location
           || '","category":"' || category || '"}' AS value
    FROM inv
    """,
)

ORACLES["next_batch_number"] = r"""
WITH ids AS (SELECT printf('P%03d-B%d', p_partkey, p_size) AS product_id FROM part)
SELECT CAST(coalesce(max(try_cast(nullif(regexp_extract(product_id, 'B(\d+)$', 1), '')
       AS BIGINT)), 0) + 1 AS BIGINT) AS next_batch
FROM ids
"""

SAMPLE = (
    "sampled",
    f"""
    SELECT {INVENTORY_COLUMNS} FROM (
        SELECT *,
               row_number() OVER (ORDER BY CAST('0x' || substr(md5(concat_ws('|', '42', product_id,
                   event_timestamp, store_location, category, CAST(quantity AS VARCHAR))), 1, 13)
                   AS BIGINT), {INVENTORY_COLUMNS}) AS place,
               count(*) OVER () AS n
        FROM inv)
    WHERE place <= greatest(1, CAST(floor(CAST(0.05 AS DOUBLE) * n) AS BIGINT))
    """,
)
OVERRIDDEN = (
    "overridden",
    """
    SELECT i.product_id,
           CAST(CASE WHEN k.product_id IS NULL THEN quantity ELSE 1000 END AS INTEGER) AS quantity,
           CAST(CASE WHEN k.product_id IS NULL THEN price ELSE 5000.0 END AS DOUBLE) AS price,
           i.event_timestamp, i.store_location, category
    FROM inv i LEFT JOIN (
        SELECT DISTINCT product_id, event_timestamp, store_location FROM sampled) k
      ON i.product_id = k.product_id AND i.event_timestamp = k.event_timestamp
     AND i.store_location = k.store_location
    """,
)
ORACLES["sample_exact"] = chain(LINES, SAMPLE, final="SELECT * FROM sampled")
ORACLES["apply_overrides"] = chain(LINES, SAMPLE, OVERRIDDEN, final="SELECT * FROM overridden")
ORACLES["overridden_rows"] = chain(
    LINES,
    SAMPLE,
    OVERRIDDEN,
    final="SELECT * FROM overridden WHERE quantity = 1000 AND price = 5000.0",
)

ORACLES["value_by_store"] = chain(
    LINES,
    HOURLY,
    final="""
    SELECT store_location, round(sum(total_stock_value), 1) AS total_stock_value
    FROM hourly WHERE store_location IS NOT NULL GROUP BY 1
    """,
)

ORACLES["turnover_over_time"] = chain(
    EVENTS,
    HOURLY,
    CATEGORY,
    METRICS,
    final=f"""
    SELECT event_timestamp, round({TURNOVER}, 12) AS turnover_rate
    FROM metrics ORDER BY event_timestamp NULLS LAST
    """,
)

_CELLS = ",\n".join(
    f"round(coalesce(sum(CASE WHEN store_location = 'S{i}' THEN total_stock_value END), 0), 2)"
    f" AS S{i}"
    for i in range(5)
)
ORACLES["stock_pivot"] = chain(
    EVENTS,
    HOURLY,
    final=f"SELECT category, {_CELLS} FROM hourly WHERE category IS NOT NULL GROUP BY 1",
)

ORACLES["quantity_price_points"] = chain(
    LINES,
    HOURLY,
    CATEGORY,
    METRICS,
    final="""
    SELECT total_quantity, round(avg_price, 8) AS avg_price, category,
           round(total_stock_value, 2) AS total_stock_value, store_location, event_timestamp
    FROM metrics
    """,
)

ORACLES["raw_preview"] = chain(
    EVENTS,
    final=f"""
    SELECT {INVENTORY_COLUMNS} FROM inv
    ORDER BY event_timestamp, product_id, store_location, category, quantity, price LIMIT 10
    """,
)

STORE_SERIES = (
    "store_series",
    """
    SELECT store_location, window_start AS t, CAST(sum(total_quantity) AS BIGINT) AS quantity
    FROM hourly WHERE store_location IS NOT NULL GROUP BY 1, 2
    """,
)
GLOBAL_SERIES = (
    "global_series",
    """
    SELECT window_start AS t, CAST(sum(total_quantity) AS BIGINT) AS quantity
    FROM hourly GROUP BY 1
    """,
)
ORACLES["store_series"] = chain(
    EVENTS,
    HOURLY,
    STORE_SERIES,
    final=f"""
    SELECT store_location, strftime(t, {TEXT_TIME}) AS event_timestamp, quantity FROM store_series
    """,
)
ORACLES["global_series"] = chain(
    EVENTS,
    HOURLY,
    GLOBAL_SERIES,
    final=f"SELECT strftime(t, {TEXT_TIME}) AS event_timestamp, quantity FROM global_series",
)
ORACLES["series_extent"] = chain(
    EVENTS,
    HOURLY,
    final=f"""
    SELECT count(DISTINCT window_start) AS unique_timestamps,
           strftime(min(window_start), {TEXT_TIME}) AS first_timestamp,
           strftime(max(window_start), {TEXT_TIME}) AS last_timestamp
    FROM hourly
    """,
)

ORACLES["holdout_split"] = chain(
    EVENTS,
    HOURLY,
    STORE_SERIES,
    (
        "placed",
        """
        SELECT *, row_number() OVER (PARTITION BY store_location ORDER BY t DESC) AS back,
               count(*) OVER (PARTITION BY store_location) AS n,
               lag(t) OVER (PARTITION BY store_location ORDER BY t) AS previous
        FROM store_series
        """,
    ),
    final=f"""
    SELECT store_location, max(n) AS n_points,
           strftime(max(t), {TEXT_TIME}) AS last_timestamp,
           max(CASE WHEN back = 1 THEN quantity END) AS actual_quantity,
           strftime(max(CASE WHEN back = 1 THEN previous END), {TEXT_TIME}) AS previous_timestamp,
           round(CASE WHEN max(n) < 3 THEN avg(quantity)
                      ELSE avg(CASE WHEN back > 1 THEN quantity END) END, 6) AS fallback_quantity
    FROM placed GROUP BY 1
    """,
)

ORACLES["forecast_horizon"] = chain(
    EVENTS,
    HOURLY,
    ("last", "SELECT max(window_start) AS t FROM hourly"),
    (
        "days",
        """
        SELECT t, CAST(step AS INTEGER) AS step, t + to_days(CAST(step AS INTEGER)) AS f
        FROM last, (SELECT unnest(generate_series(1, 7)) AS step)
        """,
    ),
    final=f"""
    SELECT strftime(t, {TEXT_TIME}) AS last_timestamp, step,
           strftime(f, {TEXT_TIME}) AS forecast_timestamp,
           CAST(day(f) AS INTEGER) AS day, CAST(month(f) AS INTEGER) AS month,
           CAST(year(f) AS INTEGER) AS year
    FROM days
    """,
)

STAND_IN = (
    "stand_in",
    f"""
    SELECT 'baseline' AS model_name, store_location, category,
           strftime(window_start, {TEXT_TIME}) AS forecast_timestamp,
           CAST(total_quantity AS DOUBLE) AS predicted_quantity,
           CAST(NULL AS BIGINT) AS actual_quantity,
           strftime(window_start, {TEXT_TIME}) AS event_timestamp
    FROM hourly
    """,
)
DAY_AHEAD = (
    "day_ahead",
    f"""
    SELECT 'day-ahead' AS model_name, a.store_location, a.category,
           strftime(a.t + INTERVAL 1 DAY, {TEXT_TIME}) AS forecast_timestamp,
           CAST(a.quantity AS DOUBLE) AS predicted_quantity,
           b.quantity AS actual_quantity,
           strftime(a.t, {TEXT_TIME}) AS event_timestamp
    FROM cells a LEFT JOIN cells b
      ON a.store_location = b.store_location AND a.category = b.category
     AND b.t = a.t + INTERVAL 1 DAY
    """,
)
CELLS = (
    "cells",
    """
    SELECT store_location, category, window_start AS t,
           CAST(sum(total_quantity) AS BIGINT) AS quantity
    FROM hourly GROUP BY 1, 2, 3
    """,
)
FORECASTS = (EVENTS, HOURLY, CELLS, STAND_IN, DAY_AHEAD)

ORACLES["attach_actuals"] = chain(*FORECASTS, final="SELECT * FROM day_ahead")
ORACLES["predicted_vs_actual"] = chain(
    *FORECASTS,
    final="""
    SELECT actual_quantity, predicted_quantity, category, store_location, forecast_timestamp
    FROM day_ahead WHERE actual_quantity IS NOT NULL
    """,
)
ORACLES["predicted_over_time"] = chain(
    *FORECASTS, final="SELECT forecast_timestamp, predicted_quantity FROM stand_in ORDER BY 1"
)


def _summary(column: str) -> str:
    quartiles = ", ".join(
        f"round(quantile_cont({column}, {share}), 6) AS p{int(share * 100)}"
        for share in (0.25, 0.5, 0.75)
    )
    return f"""
    SELECT '{column}' AS measure, count({column}) AS count, round(avg({column}), 6) AS mean,
           round(stddev_samp({column}), 6) AS std,
           round(CAST(min({column}) AS DOUBLE), 6) AS min, {quartiles},
           round(CAST(max({column}) AS DOUBLE), 6) AS max
    FROM day_ahead HAVING count({column}) > 0
    """


ORACLES["forecast_summary"] = chain(
    *FORECASTS,
    final=_summary("predicted_quantity") + " UNION ALL " + _summary("actual_quantity"),
)

ORACLES["decode_le_bytes"] = """
SELECT CAST(l_orderkey * 1000 + l_linenumber AS BIGINT) AS actual_quantity FROM lineitem
"""


def _flagged(name: str, source: str) -> tuple[str, str]:
    return (
        name,
        f"""
        SELECT *, (predicted_quantity - mean) / nullif(std, 0) AS z FROM (
            SELECT *,
                   avg(predicted_quantity) OVER w AS mean,
                   stddev_samp(predicted_quantity) OVER w AS std,
                   count(*) OVER w AS n
            FROM {source} WHERE store_location IS NOT NULL AND category IS NOT NULL
            WINDOW w AS (PARTITION BY store_location, category))
        WHERE n >= 2
        """,
    )


ZSCORE = (
    "zscore",
    """
    SELECT model_name, store_location, category, forecast_timestamp AS event_timestamp,
           'Pipeline Quantity Anomaly' AS anomaly_type, 'Z-Score' AS method,
           predicted_quantity, actual_quantity, round(z, 6) AS score,
           'Predicted Quantity: ' || CAST(predicted_quantity AS VARCHAR)
           || ', Z-Score: ' || printf('%.2f', round(z, 2)) AS description
    FROM stand_in_z WHERE round(abs(z), 9) > 1.5
    """,
)
NUMERICAL = (
    "numerical",
    """
    SELECT model_name, store_location, category, forecast_timestamp AS event_timestamp,
           'ML Quantity Anomaly' AS anomaly_type, 'Isolation Forest' AS method,
           predicted_quantity, actual_quantity, round(z, 6) AS score,
           'Predicted Quantity: ' || CAST(predicted_quantity AS VARCHAR)
           || ', Actual Quantity: ' || coalesce(CAST(actual_quantity AS VARCHAR), 'N/A')
               AS description
    FROM day_ahead_z WHERE round(abs(z), 9) > 1.5
    """,
)
ANOMALIES = (
    *FORECASTS,
    _flagged("stand_in_z", "stand_in"),
    _flagged("day_ahead_z", "day_ahead"),
    ZSCORE,
    NUMERICAL,
)

ORACLES["zscore_anomalies"] = chain(*ANOMALIES, final="SELECT * FROM zscore")
ORACLES["flagged_per_group"] = chain(
    *ANOMALIES,
    final="""
    SELECT store_location, category, max(n) AS group_size,
           CAST(coalesce(sum(CASE WHEN round(abs(z), 9) > 1.5 THEN 1 ELSE 0 END), 0) AS BIGINT)
               AS flagged
    FROM stand_in_z GROUP BY 1, 2
    """,
)
ORACLES["anomalies_by_store"] = chain(
    *ANOMALIES, final="SELECT store_location, count(*) AS count FROM zscore GROUP BY 1"
)
ORACLES["anomalies_by_category"] = chain(
    *ANOMALIES, final="SELECT category, count(*) AS count FROM zscore GROUP BY 1"
)


def _quoted(pattern: str) -> str:
    found = f"try_cast(nullif(regexp_extract(description, '{pattern}', 1), '') AS DOUBLE)"
    return f"coalesce(CAST({found} AS VARCHAR), 'N/A')"


_LINE = " || chr(10) || "
NOTES_NUMERICAL = (
    "notes_numerical",
    f"""
    SELECT 'numerical' AS type,
           {text(HEADLINE)} || chr(10) || 'Model: ' || model_name
           {_LINE}'Predicted Quantity: ' || {_quoted(r"Predicted Quantity: ([\d.]+)")}
           {_LINE}'Actual Quantity: ' || {_quoted(r"Actual Quantity: ([\d.]+|N/A)")}
           {_LINE}'Store Location: ' || store_location
           {_LINE}'Timestamp: ' || event_timestamp
           {_LINE}'Category: ' || category
           {_LINE}'Anomaly Type: ' || anomaly_type
           {_LINE}{text(NUMERICAL_CLOSING)} AS notification,
           store_location, event_timestamp, 'N/A' AS product_id, category
    FROM numerical
    """,
)
NOTES_PIPELINE = (
    "notes_pipeline",
    f"""
    SELECT 'pipeline' AS type,
           {text(HEADLINE)} || chr(10) || 'Description: ' || description
           {_LINE}'Store Location: ' || store_location
           {_LINE}'Timestamp: ' || event_timestamp
           {_LINE}'Category: ' || category
           {_LINE}'Method: ' || method
           {_LINE}{text(PIPELINE_CLOSING)} AS notification,
           store_location, event_timestamp, 'N/A' AS product_id, category
    FROM zscore
    """,
)
NOTES = (
    *ANOMALIES,
    NOTES_NUMERICAL,
    NOTES_PIPELINE,
    ("notes", "SELECT * FROM notes_pipeline UNION ALL SELECT * FROM notes_numerical"),
)
ORACLES["notifications_numerical"] = chain(*NOTES, final="SELECT * FROM notes_numerical")
ORACLES["notifications_zscore"] = chain(*NOTES, final="SELECT * FROM notes_pipeline")
ORACLES["notifications_all"] = chain(*NOTES, final="SELECT * FROM notes")

ORACLES["category_backfill"] = chain(
    *NOTES,
    (
        "old",
        """
        SELECT type, notification, store_location, event_timestamp, product_id FROM notes
        UNION ALL
        SELECT 'pipeline', text, 'none', role, 'N/A' FROM conversations
        """,
    ),
    final=r"""
    SELECT *, coalesce(nullif(regexp_extract(notification, 'Category: (.+?)\n', 1), ''), 'Unknown')
           AS category
    FROM old
    """,
)

ROLLUP = (
    "rollup",
    f"""
    SELECT 'store series' AS model_name, store_location, 'All' AS category,
           strftime(t, {TEXT_TIME}) AS forecast_timestamp,
           CAST(quantity AS DOUBLE) AS predicted_quantity,
           CAST(NULL AS BIGINT) AS actual_quantity,
           strftime(t, {TEXT_TIME}) AS event_timestamp
    FROM store_series
    UNION ALL
    SELECT 'global series', 'All', 'All', strftime(t, {TEXT_TIME}),
           CAST(quantity AS DOUBLE), CAST(NULL AS BIGINT), strftime(t, {TEXT_TIME})
    FROM global_series
    """,
)


def _marker(source: str, label: str) -> str:
    return f"""
    SELECT coalesce(max(coalesce(contains(store_location, 'All'), false)
                        OR coalesce(contains(category, 'All'), false)), false) AS has_all,
           '{label}' AS table_name
    FROM {source}
    """


ORACLES["rollup_marker_check"] = chain(
    *ANOMALIES,
    STORE_SERIES,
    GLOBAL_SERIES,
    ROLLUP,
    final=_marker("zscore", "zscore") + " UNION ALL " + _marker("rollup", "rollup"),
)


def _picked(kind: str, choices: list[str]) -> str:
    listed = ", ".join(text(c) for c in choices)
    key = f"'{kind}|' || concat_ws('|', model_name, store_location, forecast_timestamp)"
    spot = f"CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {len(choices)}"
    return f"list_extract([{listed}], CAST({spot} + 1 AS BIGINT))"


ORACLES["drill_down"] = chain(
    EVENTS,
    HOURLY,
    STORE_SERIES,
    GLOBAL_SERIES,
    ROLLUP,
    final=f"""
    SELECT model_name,
           CASE WHEN store_location = 'All' THEN {_picked("store", DRILL_STORES)}
                ELSE store_location END AS store_location,
           CASE WHEN category = 'All' THEN {_picked("category", DRILL_CATEGORIES)}
                ELSE category END AS category,
           forecast_timestamp, predicted_quantity, actual_quantity, event_timestamp,
           (store_location = 'All' OR category = 'All') AS was_replaced
    FROM rollup
    """,
)

ORACLES["detail_lookup"] = chain(
    *NOTES,
    (
        "details",
        """
        SELECT *, row_number() OVER (
            PARTITION BY type, store_location, category, event_timestamp
            ORDER BY model_name, description) AS place
        FROM (SELECT 'pipeline' AS type, * FROM zscore
              UNION ALL SELECT 'numerical' AS type, * FROM numerical)
        """,
    ),
    final="""
    SELECT n.type, n.notification, n.store_location, n.event_timestamp, n.product_id, n.category,
           d.model_name, d.anomaly_type, d.method, d.predicted_quantity, d.actual_quantity,
           d.score, d.description
    FROM notes n LEFT JOIN details d
      ON n.type = d.type AND n.store_location = d.store_location AND n.category = d.category
     AND n.event_timestamp = d.event_timestamp AND d.place = 1
    """,
)

_CASES = "\n".join(
    f"WHEN contains(lower(text), {text(keyword)}) THEN {text(answer)}" for keyword, answer in ANSWERS
)
ORACLES["route_questions"] = chain(
    *NOTES,
    (
        "questions",
        """
        SELECT text FROM conversations
        UNION ALL SELECT description FROM zscore
        UNION ALL SELECT notification FROM notes_pipeline
        """,
    ),
    final=f"SELECT text, CASE {_CASES} ELSE {text(DEFAULT_ANSWER)} END AS answer FROM questions",
)

ORACLES["stream_dedup"] = chain(
    LINES, final="SELECT DISTINCT product_id, event_timestamp, store_location FROM inv"
)

# The same rows by another way.
for _other, _name in {
    "ingest_indexed": "ingest_new_rows",
    "apply_overrides_stored": "apply_overrides",
    "attach_actuals_stored": "attach_actuals",
    "stream_dedup_by_state": "stream_dedup",
    "zscore_anomalies_by_batch": "zscore_anomalies",
    "decode_le_bytes_by_version": "decode_le_bytes",
}.items():
    ORACLES[_other] = ORACLES[_name]

ORACLES["forecast_summary_sketched"] = chain(
    *FORECASTS,
    final="""
    SELECT model_name, measure, count(v) AS count, min(v) AS min, max(v) AS max,
           true AS p25_within, true AS p50_within, true AS p75_within, true AS times_within
    FROM (SELECT model_name, 'predicted_quantity' AS measure,
                 CAST(predicted_quantity AS DOUBLE) AS v FROM day_ahead
          UNION ALL
          SELECT model_name, 'actual_quantity', CAST(actual_quantity AS DOUBLE) FROM day_ahead)
    GROUP BY 1, 2
    """,
)
