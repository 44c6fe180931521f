"""DuckDB SQL that computes each query independently, from the given tables only.

Shared steps are named here once and put in front of a query as common table expressions
when its text mentions them.
"""

from __future__ import annotations

import re

from slotwise.plans.fixtures import WEIGHTS

TIE = 1.3e-10



def half_up(x: str, digits: int) -> str:
    """Rounding that is part of an operator: half up on the shortest decimal form."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


STEPS = {
    "meter_raw": """
        SELECT event_id + c * 1000000000 AS seq, ts AS timestamp, printf('HH%04d', user_id) AS household_id,
               CASE WHEN event_id % 53 <> 0 THEN value / 10 + c END AS consumption_kwh,
               user_id % 5 = 0 AS is_real_data
        FROM events, (VALUES (0), (1)) AS copies(c) WHERE c = 0 OR event_id % 97 = 0""",
    "meter_hourly": """
        SELECT seq, CASE WHEN seq % 10 = 0 THEN timestamp ELSE date_trunc('hour', timestamp) END AS timestamp,
               household_id, consumption_kwh, CASE WHEN seq % 3 <> 0 THEN is_real_data END AS is_real_data
        FROM meter_raw""",
    "readings": """
        SELECT seq, timestamp, household_id,
               CASE WHEN consumption_kwh > 20 THEN 20 ELSE consumption_kwh END AS consumption_kwh, is_real_data
        FROM meter_raw
        QUALIFY row_number() OVER (PARTITION BY household_id, timestamp ORDER BY seq) = 1""",
    "weather_raw": """
        SELECT CAST(epoch(timestamp) AS BIGINT) // 3600 AS seq, timestamp,
               CASE WHEN NOT ((day(timestamp) % 4 = 0 AND hour(timestamp) BETWEEN 11 AND 15)
                              OR (day(timestamp) % 4 <> 0 AND hour(timestamp) = 20))
                    THEN -5 + v / 5 + hour(timestamp) END AS temperature_c,
               least(100.0, 40 + v / 2) AS humidity_pct, v / 20 AS wind_speed_ms
        FROM (SELECT date_trunc('hour', ts) AS timestamp, avg(value) AS v FROM events
              WHERE event_type = 'view' AND day(ts) NOT IN (3, 10, 17) GROUP BY 1)""",
    "weather_rows": "SELECT *, row_number() OVER (ORDER BY timestamp) AS i FROM weather_raw",
    "weather_known": "SELECT timestamp, temperature_c, i FROM weather_rows WHERE temperature_c IS NOT NULL",
    "weather": """
        SELECT w.timestamp,
               CASE WHEN w.temperature_c IS NOT NULL THEN w.temperature_c
                    WHEN p.i IS NULL OR w.i - p.i > 3 THEN NULL
                    WHEN n.i IS NULL THEN p.temperature_c
                    ELSE p.temperature_c + (n.temperature_c - p.temperature_c)
                         * (epoch_us(w.timestamp) - epoch_us(p.timestamp)) / (epoch_us(n.timestamp) - epoch_us(p.timestamp))
               END AS temperature_c, w.humidity_pct, w.wind_speed_ms
        FROM weather_rows w
        ASOF LEFT JOIN weather_known p ON w.i >= p.i
        ASOF LEFT JOIN weather_known n ON w.i <= n.i""",
    "calendar": """
        SELECT CAST(d AS DATE) AS date, CAST(isodow(d) - 1 AS BIGINT) AS day_of_week, isodow(d) >= 6 AS is_weekend,
               CAST(d AS DATE) IN (DATE '2024-01-01', DATE '2024-01-06') AS is_holiday, TRUE AS is_real_data
        FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS d FROM events)""",
    "grid": """
        SELECT g.household_id, g.timestamp, avg(r.consumption_kwh) AS consumption_kwh
        FROM (SELECT household_id, unnest(generate_series(
                         time_bucket(INTERVAL 6 HOUR, min(timestamp)), max(timestamp), INTERVAL 6 HOUR)) AS timestamp
              FROM readings GROUP BY household_id) g
        LEFT JOIN readings r ON r.household_id = g.household_id
             AND time_bucket(INTERVAL 6 HOUR, r.timestamp) = g.timestamp
        GROUP BY 1, 2""",
    "filled": """
        SELECT household_id, timestamp, last_value(consumption_kwh IGNORE NULLS) OVER
               (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS consumption_kwh
        FROM grid""",
    "merged": """
        SELECT f.*,
               CASE WHEN f.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.temperature_c END AS temperature_c,
               CASE WHEN f.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.humidity_pct END AS humidity_pct,
               CASE WHEN f.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.wind_speed_ms END AS wind_speed_ms,
               c.is_weekend, c.is_holiday
        FROM filled f ASOF LEFT JOIN weather w ON f.timestamp >= w.timestamp
        LEFT JOIN calendar c ON c.date = CAST(f.timestamp AS DATE)""",
    "features": """
        SELECT household_id, timestamp, consumption_kwh, temperature_c, humidity_pct, wind_speed_ms,
               CAST(coalesce(is_weekend, FALSE) AS BIGINT) AS is_weekend,
               CAST(coalesce(is_holiday, FALSE) AS BIGINT) AS is_holiday,
               hour(timestamp) AS hour, minute(timestamp) AS minute,
               isodow(timestamp) - 1 AS day_of_week,
               sin(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0) / 24) AS hour_sin,
               cos(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0) / 24) AS hour_cos,
               sin(2 * pi() * (isodow(timestamp) - 1) / 7) AS dow_sin,
               cos(2 * pi() * (isodow(timestamp) - 1) / 7) AS dow_cos,
               CASE WHEN temperature_c IS NOT NULL THEN greatest(18 - temperature_c, 0) END AS heating_degree,
               CASE WHEN temperature_c IS NOT NULL THEN greatest(temperature_c - 22, 0) END AS cooling_degree,
               lag(consumption_kwh, 1) OVER o AS lag_1, lag(consumption_kwh, 2) OVER o AS lag_2,
               lag(consumption_kwh, 4) OVER o AS lag_4, lag(consumption_kwh, 28) OVER o AS lag_28,
               CASE WHEN count(consumption_kwh) OVER d >= 1 THEN avg(consumption_kwh) OVER d END AS roll_mean_4,
               CASE WHEN count(consumption_kwh) OVER d >= 1 THEN stddev_samp(consumption_kwh) OVER d END AS roll_std_4,
               CASE WHEN count(consumption_kwh) OVER k >= 7 THEN avg(consumption_kwh) OVER k END AS roll_mean_28,
               CASE WHEN count(consumption_kwh) OVER k >= 7 THEN stddev_samp(consumption_kwh) OVER k END AS roll_std_28
        FROM merged
        WINDOW o AS (PARTITION BY household_id ORDER BY timestamp),
               d AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
               k AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
    "aligned": """
        SELECT g.household_id, g.timestamp, h.consumption_kwh, h.is_real_data
        FROM (SELECT household_id, timestamp
              FROM (SELECT DISTINCT household_id FROM meter_hourly),
                   (SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp FROM meter_hourly)) g
        LEFT JOIN (SELECT * FROM meter_hourly
                   QUALIFY row_number() OVER (PARTITION BY household_id, timestamp ORDER BY seq) = 1) h
             ON h.household_id = g.household_id AND h.timestamp = g.timestamp""",
    "cleaned": """
        SELECT household_id, timestamp,
               last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS consumption_kwh,
               coalesce(last_value(is_real_data IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        first_value(is_real_data IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                        FALSE) AS is_real_data,
               coalesce(v >= 20, FALSE) AS is_winsorised, v IS NULL AS was_missing
        FROM (SELECT *, CASE WHEN consumption_kwh > 20 THEN 20 ELSE consumption_kwh END AS v FROM aligned)
        WINDOW w AS (PARTITION BY household_id ORDER BY timestamp)""",
    "grid_half": """
        SELECT g.household_id, g.timestamp, avg(r.consumption_kwh) AS consumption_kwh, avg(r.raw_kwh) AS raw_kwh
        FROM (SELECT household_id, unnest(generate_series(
                         time_bucket(INTERVAL 30 MINUTE, min(timestamp)), max(timestamp), INTERVAL 30 MINUTE)) AS timestamp
              FROM readings GROUP BY household_id) g
        LEFT JOIN (SELECT *, CASE WHEN event_id % 53 <> 0 THEN value / 10 END AS raw_kwh
                   FROM readings JOIN events ON event_id = seq % 1000000000) r
             ON r.household_id = g.household_id AND time_bucket(INTERVAL 30 MINUTE, r.timestamp) = g.timestamp
        GROUP BY 1, 2""",
    "meter_half": """
        SELECT seq, household_id, consumption_kwh, CASE WHEN seq % 3 <> 0 THEN is_real_data END AS is_real_data,
               time_bucket(INTERVAL 30 MINUTE, timestamp)
               + CASE WHEN seq % 10 = 0 AND day(timestamp) > 1 THEN INTERVAL 7 MINUTE ELSE INTERVAL 0 MINUTE END AS timestamp
        FROM meter_raw""",
    "aligned_half": """
        SELECT g.household_id, g.timestamp, h.consumption_kwh, h.is_real_data
        FROM (SELECT household_id, timestamp
              FROM (SELECT DISTINCT household_id FROM meter_half),
                   (SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 30 MINUTE)) AS timestamp FROM meter_half)) g
        LEFT JOIN (SELECT * FROM meter_half
                   QUALIFY row_number() OVER (PARTITION BY household_id, timestamp ORDER BY seq) = 1) h
             ON h.household_id = g.household_id AND h.timestamp = g.timestamp""",
    "cleaned_half": """
        SELECT household_id, timestamp,
               last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS consumption_kwh,
               coalesce(last_value(is_real_data IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        first_value(is_real_data IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                        FALSE) AS is_real_meter_data,
               coalesce(v >= 20, FALSE) AS is_winsorised, v IS NULL AS was_missing
        FROM (SELECT *, CASE WHEN consumption_kwh > 20 THEN 20 ELSE consumption_kwh END AS v FROM aligned_half)
        WINDOW w AS (PARTITION BY household_id ORDER BY timestamp)""",
    "merged_half": """
        SELECT f.*,
               CASE WHEN f.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.temperature_c END AS temperature_c,
               CASE WHEN f.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.humidity_pct END AS humidity_pct,
               CASE WHEN f.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.wind_speed_ms END AS wind_speed_ms,
               c.is_weekend, c.is_holiday
        FROM cleaned_half f ASOF LEFT JOIN weather w ON f.timestamp >= w.timestamp
        LEFT JOIN calendar c ON c.date = CAST(f.timestamp AS DATE)""",
    "known": "SELECT * FROM features WHERE consumption_kwh IS NOT NULL",
    "times": """
        SELECT timestamp, row_number() OVER (ORDER BY timestamp) - 1 AS pos, count(*) OVER () AS n
        FROM (SELECT DISTINCT timestamp FROM known)""",
    "labelled": """
        SELECT k.*, CASE WHEN k.timestamp < (SELECT timestamp FROM times WHERE pos = CAST(floor(n * CAST(0.7 AS DOUBLE)) AS BIGINT)) THEN 'train'
                         WHEN k.timestamp < (SELECT timestamp FROM times WHERE pos = CAST(floor(n * CAST(0.85 AS DOUBLE)) AS BIGINT)) THEN 'val'
                         ELSE 'test' END AS split
        FROM known k""",
    "purged": """
        SELECT * FROM labelled
        QUALIFY split = 'test' OR row_number() OVER (PARTITION BY household_id, split ORDER BY timestamp DESC) > 28""",
    "predictions": """
        SELECT l_returnflag, l_quantity AS y, l_quantity * (1 - l_discount) + l_tax AS p FROM lineitem""",
    "drift_rows": """
        SELECT event_type AS feature, 'ref' AS side, value FROM events WHERE ts < TIMESTAMP '2024-01-21'
        UNION ALL
        SELECT event_type, 'cur', CASE WHEN event_type = 'error' THEN value * 1.5 ELSE value END
        FROM events WHERE ts >= TIMESTAMP '2024-01-21'""",
    "residual_rows": """
        SELECT 'residual' AS feature, CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 'ref' ELSE 'cur' END AS side,
               l_quantity * l_discount - l_tax + CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 0.3 END AS value
        FROM lineitem""",
    "versions": """
        SELECT n_name AS model_name, row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) AS version,
               CASE WHEN s_suppkey % 13 <> 0 THEN abs(s_acctbal) / 10000 END AS mae,
               CASE WHEN row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) = 1
                         AND n_nationkey = min(n_nationkey) OVER () THEN 'Production' ELSE 'None' END AS stage
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "latest": "SELECT * FROM versions QUALIFY version = max(version) OVER (PARTITION BY model_name)",
    "best": "SELECT model_name, version FROM latest WHERE mae IS NOT NULL ORDER BY mae, model_name, version LIMIT 1",
    "promoted": """
        SELECT v.model_name, v.version, v.mae,
               CASE WHEN b.version IS NOT NULL THEN 'Production' WHEN v.stage = 'Production' THEN 'Archived' ELSE v.stage END AS stage
        FROM versions v LEFT JOIN best b ON b.model_name = v.model_name AND b.version = v.version""",
    "model_x": "SELECT household_id, timestamp AS forecast_timestamp, "
        + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in WEIGHTS.coefficients) + " FROM features",
    "means": "SELECT " + ", ".join(f"avg({c}) AS {c}" for c in WEIGHTS.coefficients) + " FROM model_x",
    "phi": "SELECT x.household_id, x.forecast_timestamp, u.feature, u.phi, u.x FROM model_x x, means m, LATERAL (VALUES "
        + ", ".join(f"('{c}', (x.{c} - m.{c}) * CAST({w} AS DOUBLE), CAST(x.{c} AS DOUBLE))" for c, w in WEIGHTS.coefficients.items())
        + ") AS u(feature, phi, x)",
    "recent": """
        SELECT household_id, timestamp, consumption_kwh,
               row_number() OVER (PARTITION BY household_id ORDER BY timestamp DESC, seq DESC) AS back
        FROM readings WHERE consumption_kwh IS NOT NULL""",
    "requests": """
        SELECT r.household_id, r.forecast_timestamp,
               CASE WHEN r.forecast_timestamp - w.timestamp <= INTERVAL 7 HOUR THEN round(w.temperature_c + 1.3e-10, 1) END AS temperature_c
        FROM (SELECT household_id, max(timestamp) + INTERVAL 7 HOUR AS forecast_timestamp FROM recent GROUP BY 1) r
        ASOF LEFT JOIN weather_raw w ON r.forecast_timestamp >= w.timestamp""",
    "request_slots": """
        SELECT q.household_id, q.forecast_timestamp, q.temperature_c,
               date_diff('hour', time_bucket(INTERVAL 6 HOUR, h.timestamp), time_bucket(INTERVAL 6 HOUR, q.forecast_timestamp)) // 6 AS back,
               avg(h.consumption_kwh) AS v
        FROM requests q JOIN recent h ON h.household_id = q.household_id AND h.back <= 400 GROUP BY ALL""",
    "request_x": """
        SELECT household_id, forecast_timestamp,
               coalesce(max(v) FILTER (WHERE back = 1), 0) AS lag_1, coalesce(max(v) FILTER (WHERE back = 4), 0) AS lag_4,
               coalesce(avg(v) FILTER (WHERE back BETWEEN 1 AND 4), 0) AS roll_mean_4,
               coalesce(stddev_samp(v) FILTER (WHERE back BETWEEN 1 AND 4), 0) AS roll_std_4,
               sin(2 * pi() * (hour(forecast_timestamp) // 6 * 6) / 24) AS hour_sin,
               cos(2 * pi() * (hour(forecast_timestamp) // 6 * 6) / 24) AS hour_cos,
               CASE WHEN temperature_c IS NULL THEN 0 ELSE greatest(18 - temperature_c, 0) END AS heating_degree,
               CASE WHEN temperature_c IS NULL THEN 0 ELSE greatest(temperature_c - 22, 0) END AS cooling_degree,
               0.0 AS is_weekend, 0.0 AS humidity_pct
        FROM request_slots GROUP BY household_id, forecast_timestamp, temperature_c""",
    "forecasts": "SELECT household_id, forecast_timestamp, "
        + half_up(f"CAST({WEIGHTS.intercept} AS DOUBLE)" + "".join(
            f" + {c} * CAST({w} AS DOUBLE)" for c, w in WEIGHTS.coefficients.items()), 4)
        + " AS predicted_consumption_kwh FROM request_x",
    "recent_means": "SELECT household_id, avg(consumption_kwh) AS recent_mean_kwh FROM recent WHERE back <= 48 GROUP BY 1",
}

# Uploaded histories: the same features a day after the last reading, at ten degrees, of all readings that lie near enough.
STEPS["uploads"] = "SELECT household_id, max(timestamp) + INTERVAL 24 HOUR AS forecast_timestamp, CAST(10 AS DOUBLE) AS temperature_c FROM recent GROUP BY 1"
STEPS["upload_slots"] = STEPS["request_slots"].replace("FROM requests q", "FROM uploads q").replace(" AND h.back <= 400", "")
STEPS["upload_x"] = STEPS["request_x"].replace("FROM request_slots", "FROM upload_slots")
STEPS["upload_forecasts"] = STEPS["forecasts"].replace("FROM request_x", "FROM upload_x")


def with_steps(sql: str) -> str:
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b|,\s*{name}\s+\w\b", text):
                needed.add(name)
                visit(STEPS[name])

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({STEPS[n]})" for n in STEPS if n in needed)
    return f"WITH {ctes}\n{sql}"


def _prepend(sql: str) -> str:
    full = with_steps(sql)
    # A query with its own common table expressions joins the list of the shared ones.
    if full is not sql and sql.lstrip().startswith("WITH "):
        head = full[: len(full) - len(sql)].rstrip()
        return f"{head},\n{sql.lstrip()[5:]}"
    return full


def rd(column: str, digits: int = 8, name: str | None = None) -> str:
    """Rounded as the queries round: ties decided alike, negative zero made positive."""
    return f"{rnd(column, digits)} AS {name or column}"


def rnd(column: str, digits: int = 8) -> str:
    return f"(round({column} + {TIE}, {digits}) + 0.0)"


def rds(columns: str, digits: int = 8) -> str:
    return ", ".join(rd(c, digits) for c in columns.split())


WEATHER = "temperature_c humidity_pct wind_speed_ms"


def _distances(rows: str, measures: str) -> str:
    """Empirical distribution functions of both sides at every value."""
    return f"""
        SELECT {measures}
        FROM (SELECT *, sum(a) OVER o / sum(a) OVER w AS f, sum(b) OVER o / sum(b) OVER w AS g,
                     lead(value) OVER o - value AS width,
                     sum(a) OVER w AS na, sum(b) OVER w AS nb
              FROM (SELECT feature, value, CAST(count(*) FILTER (WHERE side = 'ref') AS DOUBLE) AS a,
                           CAST(count(*) FILTER (WHERE side = 'cur') AS DOUBLE) AS b
                    FROM {rows} GROUP BY 1, 2)
              WINDOW o AS (PARTITION BY feature ORDER BY value), w AS (PARTITION BY feature)) x
        JOIN (SELECT feature, stddev_pop(value) AS ref_std FROM {rows} WHERE side = 'ref' GROUP BY 1) s USING (feature)
        GROUP BY feature"""


KS_P = """CASE WHEN d2 < 0.04 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101),
    lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * d2))), 0.0), 1.0) END"""
WASSERSTEIN = "coalesce(sum(abs(f - g) * width), 0)"

QUERIES: dict[str, str] = {
    "scan_csv": "SELECT timestamp, household_id, consumption_kwh, is_real_data FROM meter_raw",
    "scan_archive": "SELECT event_id, ts AS timestamp, value FROM events WHERE value >= 0",
    "scan_resolve_columns": """SELECT ts AS timestamp, value / 10 AS consumption_kwh, event_id,
        CAST(ts AS DATE) AS date, value AS energy FROM events""",
    "scan_json_arrays": f"SELECT timestamp, {rds(WEATHER)} FROM weather_raw",
    "parse_lenient": """
        SELECT event_id, CASE WHEN event_id % 13 = 0 THEN ts - INTERVAL 1 HOUR ELSE ts END AS timestamp, value AS consumption_kwh
        FROM events WHERE event_id % 11 <> 0 AND event_id % 7 <> 0 AND event_id % 17 <> 0 AND value >= 0""",
    "filter_range": """SELECT event_id, ts AS timestamp, value FROM events
        WHERE ts >= TIMESTAMP '2024-01-05 06:30:00' AND ts < TIMESTAMP '2024-01-21'""",
    "calendar_dim": "SELECT * FROM calendar",
    "scan_fallback": """SELECT event_id, value, is_real_data, "case" FROM events,
        (VALUES ('lost', FALSE), ('found', TRUE), ('off', FALSE)) AS c("case", is_real_data)""",
    "union_populations": """SELECT seq, timestamp, CASE WHEN is_real_data THEN 'HH_REAL_000' ELSE household_id END AS household_id,
        consumption_kwh, is_real_data FROM meter_raw""",
    "time_index": """SELECT timestamp FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)),
        date_trunc('day', max(ts)) + INTERVAL 1 DAY - INTERVAL 30 MINUTE, INTERVAL 30 MINUTE)) AS timestamp FROM events)""",
    "features_read": f"SELECT household_id, timestamp, {rds('consumption_kwh lag_1 roll_mean_4')} FROM features",
    "features_manifest": """SELECT count(*) AS n_rows, CAST(22 AS BIGINT) AS n_features,
        'cooling_degree,day_of_week,dow_cos,dow_sin,heating_degree,hour,hour_cos,hour_sin,humidity_pct,is_holiday,is_weekend,'
        || 'lag_1,lag_2,lag_28,lag_4,minute,roll_mean_28,roll_mean_4,roll_std_28,roll_std_4,temperature_c,wind_speed_ms' AS names
        FROM features""",
    "manifest_verify": """SELECT * FROM (VALUES ('same', TRUE), ('file_lost', FALSE), ('file_changed', FALSE),
        ('no_manifest', FALSE)) AS t("case", verified)""",
    "dedupe_first": """SELECT seq, timestamp, household_id, consumption_kwh, is_real_data FROM meter_raw
        QUALIFY row_number() OVER (PARTITION BY household_id, timestamp ORDER BY seq) = 1""",
    "winsorise": """SELECT seq, CASE WHEN consumption_kwh > 20 THEN 20 ELSE consumption_kwh END AS consumption_kwh,
        coalesce(consumption_kwh >= 20, FALSE) AS is_winsorised FROM meter_raw""",
    "grid_align": "SELECT household_id, timestamp, consumption_kwh FROM aligned",
    "fill_provenance": "SELECT household_id, timestamp, is_real_data FROM cleaned",
    "ffill_limit": f"SELECT household_id, timestamp, {rd('consumption_kwh', 8)} FROM filled",
    "clean_meter": f"""SELECT household_id, timestamp, {rd('consumption_kwh')}, is_real_data, is_winsorised, was_missing
        FROM cleaned""",
    "cleaning_counters": """
        SELECT (SELECT count(*) FROM meter_hourly) AS rows_in,
               (SELECT count(*) FROM meter_hourly)
                 - (SELECT count(*) FROM (SELECT DISTINCT household_id, timestamp FROM meter_hourly)) AS duplicates_dropped,
               (SELECT count(*) FROM (SELECT consumption_kwh FROM meter_hourly
                  QUALIFY row_number() OVER (PARTITION BY household_id, timestamp ORDER BY seq) = 1)
                WHERE consumption_kwh > 20) AS spikes,
               count(*) FILTER (WHERE was_missing AND consumption_kwh IS NOT NULL) AS filled,
               count(*) FILTER (WHERE consumption_kwh IS NULL) AS remaining_nulls
        FROM cleaned""",
    "interpolate_time": f"SELECT timestamp, {rds(WEATHER)} FROM weather",
    "clean_weather": f"SELECT timestamp, {rds(WEATHER)} FROM weather",
    "resample_sum": f"""
        SELECT g.household_id, g.timestamp, {rnd('coalesce(sum(r.consumption_kwh), 0)')} AS consumption_kwh
        FROM grid g LEFT JOIN readings r ON r.household_id = g.household_id
             AND time_bucket(INTERVAL 6 HOUR, r.timestamp) = g.timestamp GROUP BY 1, 2""",
    "resample_mean_last": f"""
        SELECT g.household_id, g.timestamp, {rnd('avg(r.consumption_kwh)')} AS consumption_kwh,
               CAST(last(r.seq % 2 = 0 ORDER BY r.timestamp, r.seq) FILTER (WHERE r.seq % 3 <> 0) AS VARCHAR) AS is_real_data
        FROM grid g LEFT JOIN meter_raw r ON r.household_id = g.household_id
             AND time_bucket(INTERVAL 6 HOUR, r.timestamp) = g.timestamp GROUP BY 1, 2""",
    "asof_join": f"""
        SELECT seq, household_id, timestamp, {rds(WEATHER)}, weather_at
        FROM (SELECT r.seq, r.household_id, r.timestamp,
                     {', '.join(f"CASE WHEN r.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.{c} END AS {c}" for c in WEATHER.split())},
                     CASE WHEN r.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.timestamp END AS weather_at
              FROM readings r ASOF LEFT JOIN weather_raw w ON r.timestamp >= w.timestamp)""",
    "join_calendar": """SELECT m.seq, m.timestamp, c.is_weekend, c.is_holiday FROM meter_raw m
        LEFT JOIN calendar c ON c.date = CAST(m.timestamp AS DATE)""",
    "merge_sources": f"""SELECT household_id, timestamp, {rds('consumption_kwh ' + WEATHER)}, TRUE AS is_real_meter_data,
        is_weekend, is_holiday FROM merged""",
    "degree_features": f"""
        SELECT timestamp, {rd('temperature_c')},
               {rd('CASE WHEN temperature_c IS NOT NULL THEN greatest(18 - temperature_c, 0) END', 8, 'heating_degree')},
               {rd('CASE WHEN temperature_c IS NOT NULL THEN greatest(temperature_c - 22, 0) END', 8, 'cooling_degree')}
        FROM weather_raw""",
    "calendar_features": f"""
        SELECT f.household_id, f.timestamp, CASE WHEN day(f.timestamp) % 9 <> 0 THEN f.is_weekend ELSE 0 END AS is_weekend,
               CASE WHEN day(f.timestamp) % 9 <> 0 THEN f.is_holiday ELSE 0 END AS is_holiday,
               f.hour, f.minute, f.day_of_week, {rds('hour_sin hour_cos dow_sin dow_cos')} FROM features f""",
    "lag_features": f"""
        SELECT household_id, timestamp, {rd('consumption_kwh', 8)},
               {', '.join(rd(f"lag(consumption_kwh, {k}) OVER (PARTITION BY household_id ORDER BY timestamp)", 8, f"lag_{k}") for k in (1, 2, 4, 28))}
        FROM grid""",
    "rolling_mean": f"""
        SELECT household_id, timestamp,
               {', '.join(rd(f"CASE WHEN count(consumption_kwh) OVER w{w} >= {m} THEN avg(consumption_kwh) OVER w{w} END", 8, f"roll_mean_{w}") for w, m in ((4, 1), (28, 7)))}
        FROM grid
        WINDOW w4 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
               w28 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
    "rolling_std": f"""
        SELECT household_id, timestamp,
               {', '.join(rd(f"CASE WHEN count(consumption_kwh) OVER w{w} >= {m} THEN stddev_samp(consumption_kwh) OVER w{w} END", 8, f"roll_std_{w}") for w, m in ((4, 1), (28, 7)))}
        FROM grid
        WINDOW w4 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
               w28 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""",
    "lag_features_default": f"""
        SELECT household_id, timestamp, {rd('consumption_kwh', 8)},
               {', '.join(rd(f"lag(consumption_kwh, {k}) OVER (PARTITION BY household_id ORDER BY timestamp)", 8, f"lag_{k}") for k in (1, 2, 48, 336))}
        FROM grid_half""",
    "rolling_default": f"""
        SELECT household_id, timestamp,
               {', '.join(rd(f"CASE WHEN count(raw_kwh) OVER w{w} >= {w // 4} THEN {f}(raw_kwh) OVER w{w} END", 8, f"roll_{m}_{w}") for w in (48, 336) for m, f in (("mean", "avg"), ("std", "stddev_samp")))}
        FROM grid_half
        WINDOW w48 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING),
               w336 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 336 PRECEDING AND 1 PRECEDING)""",
    "pipeline_features": f"""
        SELECT household_id, timestamp, is_winsorised, was_missing, is_real_meter_data, {rds('consumption_kwh ' + WEATHER)},
               CAST(coalesce(is_weekend, FALSE) AS BIGINT) AS is_weekend, CAST(coalesce(is_holiday, FALSE) AS BIGINT) AS is_holiday,
               hour(timestamp) AS hour, minute(timestamp) AS minute, isodow(timestamp) - 1 AS day_of_week,
               {rd('sin(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0) / 24)', 8, 'hour_sin')},
               {rd('cos(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0) / 24)', 8, 'hour_cos')},
               {rd('sin(2 * pi() * (isodow(timestamp) - 1) / 7)', 8, 'dow_sin')}, {rd('cos(2 * pi() * (isodow(timestamp) - 1) / 7)', 8, 'dow_cos')},
               {rd('CASE WHEN temperature_c IS NOT NULL THEN greatest(18 - temperature_c, 0) END', 8, 'heating_degree')},
               {rd('CASE WHEN temperature_c IS NOT NULL THEN greatest(temperature_c - 22, 0) END', 8, 'cooling_degree')},
               {', '.join(rd(f"lag(consumption_kwh, {k}) OVER o", 8, f"lag_{k}") for k in (1, 2, 48, 336))},
               {', '.join(rd(f"CASE WHEN count(consumption_kwh) OVER w{w} >= {w // 4} THEN {f}(consumption_kwh) OVER w{w} END", 8, f"roll_{m}_{w}") for w in (48, 336) for m, f in (("mean", "avg"), ("std", "stddev_samp")))}
        FROM merged_half
        WINDOW o AS (PARTITION BY household_id ORDER BY timestamp),
               w48 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 48 PRECEDING AND 1 PRECEDING),
               w336 AS (PARTITION BY household_id ORDER BY timestamp ROWS BETWEEN 336 PRECEDING AND 1 PRECEDING)""",
    "build_features": f"""
        SELECT household_id, timestamp, is_weekend, is_holiday, hour, minute, day_of_week,
               {rds('consumption_kwh temperature_c humidity_pct wind_speed_ms hour_sin hour_cos dow_sin dow_cos '
                    'heating_degree cooling_degree lag_1 lag_2 lag_4 lag_28 roll_mean_4 roll_std_4 roll_mean_28 roll_std_28')}
        FROM features""",
    "feature_projection": "SELECT " + ", ".join(
        f"count({c}) AS {c}" for c in (
            "temperature_c humidity_pct wind_speed_ms is_weekend is_holiday hour minute day_of_week hour_sin hour_cos dow_sin"
            " dow_cos heating_degree cooling_degree lag_1 lag_2 lag_4 lag_28 roll_mean_4 roll_std_4 roll_mean_28 roll_std_28"
        ).split()) + " FROM features",
    "chrono_split": "SELECT household_id, timestamp, split FROM purged",
    "purge_tail": """
        SELECT household_id, split, count(*) AS n, max(timestamp) AS last
        FROM (SELECT * FROM labelled QUALIFY split = 'test'
              OR row_number() OVER (PARTITION BY household_id, split ORDER BY timestamp DESC) > 7) GROUP BY 1, 2""",
    "median_impute": "SELECT household_id, timestamp, split, " + ", ".join(
        rd(f"coalesce({c}, (SELECT median({c}) FROM labelled WHERE split = 'train'))", 8, c)
        for c in ("lag_1", "lag_4", "roll_mean_4", "temperature_c")) + " FROM labelled",
    "baseline_predict": f"""
        SELECT p.household_id, p.timestamp, p.split,
               {rd("coalesce(p.lag_28, p.lag_4, m.mean, (SELECT avg(mean) FROM (SELECT avg(consumption_kwh) AS mean FROM purged WHERE split = 'train' GROUP BY household_id)))", 8, 'prediction')}
        FROM purged p LEFT JOIN (SELECT household_id, avg(consumption_kwh) AS mean FROM purged WHERE split = 'train' GROUP BY 1) m
             ON m.household_id = p.household_id
        WHERE p.split <> 'train'""",
    "error_metrics": f"""
        SELECT l_returnflag, {rd('avg(abs(y - p))', 8, 'mae')}, {rd('sqrt(avg((y - p) * (y - p)))', 8, 'rmse')},
               {rd('avg(abs(y - p) / greatest(abs(y), 0.001)) * 100', 8, 'mape')}, count(*) AS n_samples
        FROM predictions GROUP BY 1""",
    "relative_improvement": f"""
        SELECT l_returnflag, {rd('(avg(abs(y - 25)) - avg(abs(y - p))) / avg(abs(y - 25)) * 100', 8, 'improvement_pct')},
               CAST(0.0 AS DOUBLE) AS against_zero FROM predictions GROUP BY 1""",
    "provenance_share": f"SELECT {rd('avg(CAST(is_real_data AS DOUBLE))', 8, 'share_real')}, count(*) AS n FROM meter_raw",
    "gap_count": """
        SELECT household_id, count(*) FILTER (WHERE d > INTERVAL 30 MINUTE) AS n_gaps
        FROM (SELECT household_id, timestamp - lag(timestamp) OVER (PARTITION BY household_id ORDER BY timestamp) AS d FROM meter_raw)
        GROUP BY 1""",
    "drift_usable_columns": """
        SELECT * FROM (
            SELECT 'v' AS feature, count(value) FILTER (WHERE ts < TIMESTAMP '2024-01-21') AS n_ref,
                   count(value) FILTER (WHERE ts >= TIMESTAMP '2024-01-21') AS n_cur FROM events
            UNION ALL
            SELECT 'mixed', count(*) FILTER (WHERE event_id % 3 <> 0 AND ts < TIMESTAMP '2024-01-21'),
                   count(*) FILTER (WHERE event_id % 3 <> 0 AND ts >= TIMESTAMP '2024-01-21') FROM events)""",
    "drift_ks": f"""
        SELECT feature, n_ref, n_cur, {rd('ks_d')}, {rd(KS_P, 8, 'ks_p')}
        FROM (SELECT *, ks_d * ks_d * (n_ref * n_cur / (n_ref + n_cur)) AS d2 FROM ({_distances(
            'drift_rows', 'feature, CAST(any_value(na) AS BIGINT) AS n_ref, CAST(any_value(nb) AS BIGINT) AS n_cur, max(abs(f - g)) AS ks_d')}))""",
    "drift_wasserstein": _distances(
        "drift_rows", f"feature, {rd(WASSERSTEIN, 8, 'wasserstein')}, {rd(WASSERSTEIN + ' / greatest(any_value(ref_std), 0.001)', 8, 'normalised')}"),
    "retrain_decision": """
        WITH sev AS (SELECT count(*) FILTER (WHERE x > 0.3) AS c, count(*) FILTER (WHERE x > 0.15 AND x <= 0.3) AS w
                     FROM (SELECT avg(CAST(value > 100 AS DOUBLE)) AS x FROM events GROUP BY user_id)),
             err AS (SELECT avg(abs(e)) AS live, avg(abs(e) * CASE WHEN l_returnflag = 'A' THEN 0.5 ELSE 0.9 END) AS train
                     FROM (SELECT l_returnflag, l_quantity - (l_quantity * (1 - l_discount) + l_tax) AS e FROM lineitem)),
             age AS (SELECT date_diff('day', min(ts), max(ts)) AS days FROM events),
             t AS (SELECT *, (live - train) / train * 100 AS loss FROM sev, err, age)
        SELECT (c > 0 OR w > 3 OR loss > 15 OR days >= 30) AS should_retrain,
               array_to_string(list_filter([
                   CASE WHEN c > 0 THEN c || ' feature(s) show CRITICAL drift' END,
                   CASE WHEN w > 3 THEN w || ' feature(s) show WARNING-level drift (threshold 3)' END,
                   CASE WHEN loss > 15 THEN 'live MAE is ' || printf('%.1f', loss) || '% worse than at training time (threshold 15%)' END,
                   CASE WHEN days >= 30 THEN days || ' days since last training run (cadence: 30)' END],
                   lambda s: s IS NOT NULL), '; ') AS reasons,
               CASE WHEN c > 0 OR loss > 15 THEN 'URGENT' WHEN w > 3 OR days >= 30 THEN 'SCHEDULED' ELSE 'NONE' END AS urgency
        FROM t""",
    "reference_sample": f"""
        SELECT household_id, timestamp, {rds('temperature_c lag_1 roll_mean_4')} FROM features
        WHERE temperature_c IS NOT NULL AND lag_1 IS NOT NULL AND roll_mean_4 IS NOT NULL
        ORDER BY md5(household_id || '|' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '#42') LIMIT 500""",
    "local_attribution": f"""
        SELECT household_id, forecast_timestamp, row_number() OVER o AS rank, feature, {rd('phi', 6, 'contribution')}, {rd('x', 6, 'feature_value')}
        FROM phi WINDOW o AS (PARTITION BY household_id, forecast_timestamp ORDER BY abs(phi) DESC, feature)
        QUALIFY row_number() OVER o <= 8""",
    "global_importance": f"""SELECT feature, {rd('avg(abs(phi))', 8, 'mean_abs_contribution')} FROM phi GROUP BY 1
        ORDER BY avg(abs(phi)) DESC, feature LIMIT 10""",
    "linreg_fit": f"""SELECT count(*) AS n, {rd('regr_slope(l_extendedprice, l_quantity)', 3, 'slope')},
        {rd('regr_intercept(l_extendedprice, l_quantity)', 3, 'intercept')} FROM lineitem""",
    "score_requests": "SELECT household_id, forecast_timestamp, predicted_consumption_kwh + 0.0 AS predicted_consumption_kwh FROM forecasts",
    "explain_requests": f"SELECT household_id, forecast_timestamp, row_number() OVER o AS rank, feature, {rd('phi', 6, 'contribution')}, {rd('x', 6, 'feature_value')} FROM ("
        "SELECT x.household_id, x.forecast_timestamp, u.feature, u.phi, u.x FROM request_x x, means m, LATERAL (VALUES "
        + ", ".join(f"('{c}', (x.{c} - m.{c}) * CAST({w} AS DOUBLE), CAST(x.{c} AS DOUBLE))" for c, w in WEIGHTS.coefficients.items())
        + ") AS u(feature, phi, x)) WINDOW o AS (PARTITION BY household_id, forecast_timestamp ORDER BY abs(phi) DESC, feature) QUALIFY row_number() OVER o <= 8",
    "recommendations": f"""
        WITH x AS (SELECT q.household_id, q.forecast_timestamp, CAST(hour(q.forecast_timestamp) AS BIGINT) AS hour,
                          coalesce(greatest(18 - q.temperature_c, 0) + CASE WHEN q.temperature_c IS NULL THEN NULL ELSE 0 END, 0) AS hd,
                          f.predicted_consumption_kwh AS p, m.recent_mean_kwh AS m
                   FROM requests q JOIN forecasts f USING (household_id, forecast_timestamp) JOIN recent_means m USING (household_id)),
             fired AS (
                 SELECT *, 1 AS rule, 'Shift flexible loads out of the evening peak' AS title, p * 0.15 AS saving FROM x
                 WHERE hour BETWEEN 17 AND 20 AND p > 0.85
                 UNION ALL SELECT *, 2, 'Cold snap — check heating schedule efficiency', hd * 0.05 FROM x WHERE hd > 8
                 UNION ALL SELECT *, 3, 'Consumption forecast well above your recent average', p - m FROM x WHERE p > m * 1.5 AND m > 0),
             all_rows AS (
                 SELECT * FROM fired
                 UNION ALL SELECT *, 4, 'No action needed', 0.0 FROM x ANTI JOIN fired USING (household_id, forecast_timestamp))
        SELECT household_id, forecast_timestamp, hour, {rnd('hd', 3)} AS heating_degree,
               row_number() OVER (PARTITION BY household_id, forecast_timestamp ORDER BY rule) - 1 AS position,
               title, {half_up('saving', 3)} AS estimated_saving_kwh
        FROM all_rows""",
    "recent_mean": f"SELECT household_id, {rd('recent_mean_kwh')} FROM recent_means",
    "best_run": f"SELECT model_name, version, {rd('mae')}, stage FROM versions WHERE mae IS NOT NULL ORDER BY versions.mae, model_name, version LIMIT 1",
    "champion": f"SELECT v.model_name, v.version, {rd('v.mae', 8, 'mae')}, v.stage FROM versions v JOIN best b ON b.model_name = v.model_name AND b.version = v.version",
    "promote": f"SELECT model_name, version, {rd('mae')}, stage FROM promoted",
    "production_row": f"SELECT model_name, version, {rd('mae')}, stage FROM promoted WHERE stage = 'Production'",
    "stream_tumbling": f"""
        SELECT household_id, time_bucket(INTERVAL 6 HOUR, timestamp) AS timestamp,
               {rnd('avg(consumption_kwh)')} AS consumption_kwh, count(*) AS n_readings
        FROM meter_raw GROUP BY 1, 2""",
    "stream_enrich": f"""
        SELECT seq, household_id, timestamp, {rds('consumption_kwh ' + WEATHER)}, is_real_weather,
               CAST(45.65 AS DOUBLE) AS source_latitude, CAST(13.78 AS DOUBLE) AS source_longitude
        FROM (SELECT r.seq, r.household_id, r.timestamp, r.consumption_kwh,
                     {', '.join(f"CASE WHEN r.timestamp - w.timestamp <= INTERVAL 1 HOUR THEN w.{c} END AS {c}" for c in WEATHER.split())},
                     coalesce(r.timestamp - w.timestamp <= INTERVAL 1 HOUR, FALSE) AS is_real_weather
              FROM meter_raw r ASOF LEFT JOIN weather_raw w ON r.timestamp >= w.timestamp)""",
    "recent_buffer": """SELECT seq, household_id, timestamp, consumption_kwh FROM meter_raw
        QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY timestamp DESC, seq DESC) <= 20""",
    "stream_session_stats": f"""
        SELECT household_id, count(*) AS n_readings, min(timestamp) AS started_at, {rd('avg(consumption_kwh)', 8, 'mean_value')},
               max(timestamp) AS latest_at, {rd('last(consumption_kwh ORDER BY timestamp, seq)', 8, 'latest_value')}
        FROM meter_raw GROUP BY 1""",
    "min_sample_gate": """
        SELECT household_id, count(*) AS n_readings, count(*) >= 2 AS can_plot, count(*) >= 5 AS can_forecast,
               count(*) >= 30 AS can_check_drift
        FROM meter_raw GROUP BY 1""",
    "location_mix": """
        SELECT count(*) FILTER (WHERE event_id % 4 <> 0) AS n_here, count(*) AS n_total,
               count(*) FILTER (WHERE event_id % 4 <> 0) BETWEEN 1 AND count(*) - 1 AS is_mixed FROM events""",
    "to_local_time": "SELECT event_id, timezone('Europe/Rome', timezone('UTC', ts)) AS local_time FROM events",
    "drift_status": """
        WITH log AS (SELECT ['consumption_kwh', 'temperature_c', 'heating_degree', 'lag_1', 'lag_48'][user_id % 5 + 1] AS feature, ts
                     FROM events WHERE event_type = 'error'),
             tail AS (SELECT feature, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS stamp FROM log ORDER BY ts DESC, feature LIMIT 10)
        SELECT (SELECT count(*) FROM events) AS n_updates, (SELECT count(*) FROM log) AS n_drift_events_total,
               (SELECT string_agg(feature, ',' ORDER BY feature) FROM (SELECT DISTINCT feature FROM log)) AS features,
               (SELECT string_agg(feature || '@' || stamp, '|' ORDER BY stamp, feature) FROM tail) AS recent,
               CAST(0.002 AS DOUBLE) AS delta""",
}
QUERIES["asof_join_merge"] = QUERIES["asof_join"]
QUERIES["stream_features"] = QUERIES["build_features"]
QUERIES["stream_pairing"] = QUERIES["stream_enrich"]
QUERIES["state_buffer"] = QUERIES["recent_buffer"]
# Slots before the mark are fed once each, if the feature has a value.
QUERIES["stream_monitor"] = """
    WITH mark AS (SELECT time_bucket(INTERVAL 6 HOUR, max(timestamp) - INTERVAL 1 HOUR) AS mark FROM meter_raw)
    SELECT household_id, feature, count(*) AS n_updates, max(timestamp) AS last_fed
    FROM (SELECT household_id, timestamp, unnest(['consumption_kwh', 'temperature_c', 'heating_degree', 'lag_1', 'lag_4']) AS feature,
                 unnest([consumption_kwh, temperature_c, heating_degree, lag_1, lag_4]) AS value FROM features), mark
    WHERE value IS NOT NULL AND timestamp < mark GROUP BY 1, 2"""
QUERIES["champion_of"] = f"""
    SELECT model_name, version, {rd('mae')}, stage
    FROM (SELECT * FROM versions WHERE model_name IN ('FRANCE', 'GERMANY', 'JAPAN', 'BRAZIL')
          QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC) = 1) few
    WHERE mae IS NOT NULL ORDER BY few.mae, model_name, version LIMIT 1"""
QUERIES["leafwise_split"] = f"""
    WITH bins AS (SELECT CAST(l_quantity AS DOUBLE) AS x, count(*) AS n, sum(CAST(l_extendedprice AS DOUBLE)) AS g FROM lineitem GROUP BY 1),
         cuts AS (SELECT x, sum(n) OVER (ORDER BY x) AS nl, sum(g) OVER (ORDER BY x) AS gl FROM bins),
         whole AS (SELECT sum(n) AS n, sum(g) AS g FROM bins)
    SELECT x AS cut, CAST(nl AS BIGINT) AS n_left, {rd('gl / nl', 4, 'left_value')}, {rd('(g - gl) / (n - nl)', 4, 'right_value')}
    FROM cuts, whole WHERE nl >= 20 AND n - nl >= 20 ORDER BY gl * gl / nl + (g - gl) * (g - gl) / (n - nl) DESC LIMIT 1"""
QUERIES["merge_counters"] = "SELECT count(*) AS n_rows, count(*) FILTER (WHERE temperature_c IS NULL) AS n_unmatched_weather FROM merged"
QUERIES["clean_calendar"] = "SELECT CAST(date AS VARCHAR) AS date, day_of_week, is_weekend, is_holiday FROM calendar"
QUERIES["feature_names"] = "SELECT feature, n_known FROM (UNPIVOT (" + QUERIES["feature_projection"] + ") ON COLUMNS(*) INTO NAME feature VALUE n_known)"
QUERIES["table_round_trip"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", CAST(CAST(timestamp AS DATE) AS VARCHAR) AS day, count(*) AS n_rows, count(consumption_kwh) AS n_known, {rd('sum(consumption_kwh)', 6, 'total')} FROM {step} GROUP BY 2"
    for name, step in (("raw", "meter_raw"), ("cleaned", "cleaned"))
)
QUERIES["history_forecast"] = """
    SELECT f.household_id, f.forecast_timestamp, predicted_consumption_kwh + 0.0 AS predicted_consumption_kwh, n_readings
    FROM upload_forecasts f JOIN (
        SELECT u.household_id, count(*) AS n_readings FROM uploads u JOIN recent r ON r.household_id = u.household_id
             AND (r.back <= 48 OR date_diff('hour', time_bucket(INTERVAL 6 HOUR, r.timestamp), time_bucket(INTERVAL 6 HOUR, u.forecast_timestamp)) // 6 <= 28)
        GROUP BY 1) USING (household_id)"""
QUERIES["tree_request_attribution"] = f"SELECT household_id, forecast_timestamp, TRUE AS adds_up FROM ({QUERIES['score_requests']})"
QUERIES["train_runs"] = """
    SELECT * FROM (VALUES (1, 'linear_regression', 'FINISHED', NULL, TRUE), (2, 'random_forest', 'FINISHED', NULL, TRUE),
                          (3, 'no_family', 'FAILED', 'no such family', NULL)) AS runs(run_id, model_name, status, error, has_metrics)"""

# One row per expectation; the counts are recomputed here, the thresholds are restated.
_CHECKS = {
    "smart_meter": """
        WITH t AS (SELECT count(*) AS n, count(consumption_kwh) AS k, count(*) FILTER (WHERE consumption_kwh NOT BETWEEN 0 AND 25) AS bad FROM meter_raw),
             u AS (SELECT coalesce(sum(c) FILTER (WHERE c > 1), 0) AS dup, sum(c) AS total
                   FROM (SELECT count(*) AS c FROM meter_raw GROUP BY timestamp, household_id)),
             g AS (SELECT count(*) FILTER (WHERE d > INTERVAL 30 MINUTE) AS gaps
                   FROM (SELECT timestamp - lag(timestamp) OVER (PARTITION BY household_id ORDER BY timestamp) AS d FROM meter_raw))
        SELECT 'smart_meter' AS suite, e.* FROM t, u, g, LATERAL (VALUES
            ('expect_column_to_exist', 'timestamp', 'CRITICAL', TRUE, 'True', ''),
            ('expect_column_to_exist', 'household_id', 'CRITICAL', TRUE, 'True', ''),
            ('expect_column_to_exist', 'consumption_kwh', 'CRITICAL', TRUE, 'True', ''),
            ('expect_column_values_to_not_be_null', 'consumption_kwh', 'WARN', k / n >= 0.99, CAST(n - k AS VARCHAR), ''),
            ('expect_column_values_to_be_between', 'consumption_kwh', 'CRITICAL', (k - bad) / k >= 0.9999, CAST(bad AS VARCHAR), ''),
            ('expect_compound_columns_to_be_unique', 'timestamp,household_id', 'CRITICAL', (total - dup) / total >= 0.999, CAST(dup AS VARCHAR), ''),
            ('expect_timestamps_regular', 'timestamp', 'WARN', gaps = 0, 'n_gaps=' || gaps, 'expected_freq=30min')
        ) AS e(expectation, "column", severity, success, observed, details)""",
    "weather": """
        WITH t AS (SELECT count(*) AS n, count(temperature_c) AS k, count(*) FILTER (WHERE temperature_c NOT BETWEEN -25 AND 45) AS bt,
                          count(*) FILTER (WHERE humidity_pct NOT BETWEEN 0 AND 100) AS bh,
                          count(*) FILTER (WHERE wind_speed_ms NOT BETWEEN 0 AND 60) AS bw FROM weather_raw)
        SELECT 'weather' AS suite, e.* FROM t, LATERAL (VALUES
            ('expect_column_to_exist', 'timestamp', 'CRITICAL', TRUE, 'True', ''),
            ('expect_column_values_to_be_between', 'temperature_c', 'CRITICAL', bt = 0, CAST(bt AS VARCHAR), ''),
            ('expect_column_values_to_be_between', 'humidity_pct', 'CRITICAL', bh = 0, CAST(bh AS VARCHAR), ''),
            ('expect_column_values_to_be_between', 'wind_speed_ms', 'CRITICAL', bw = 0, CAST(bw AS VARCHAR), ''),
            ('expect_column_values_to_not_be_null', 'temperature_c', 'WARN', n = k, CAST(n - k AS VARCHAR), '')
        ) AS e(expectation, "column", severity, success, observed, details)""",
    "calendar": """
        WITH u AS (SELECT coalesce(sum(c) FILTER (WHERE c > 1), 0) AS dup FROM (SELECT count(*) AS c FROM calendar GROUP BY date))
        SELECT 'calendar' AS suite, e.* FROM u, LATERAL (VALUES
            ('expect_column_to_exist', 'date', 'CRITICAL', TRUE, 'True', ''),
            ('expect_column_to_exist', 'is_weekend', 'CRITICAL', TRUE, 'True', ''),
            ('expect_column_to_exist', 'is_holiday', 'CRITICAL', TRUE, 'True', ''),
            ('expect_column_values_to_be_unique', 'date', 'CRITICAL', dup = 0, CAST(dup AS VARCHAR), '')
        ) AS e(expectation, "column", severity, success, observed, details)""",
}
QUERIES["validate_meter"] = _CHECKS["smart_meter"]
QUERIES["validate_weather"] = _CHECKS["weather"]
QUERIES["validate_calendar"] = _CHECKS["calendar"]
QUERIES["validation_summary"] = (
    "SELECT suite, count(*) AS n_expectations, count(*) FILTER (WHERE NOT success AND severity = 'CRITICAL') AS n_critical_failures,"
    " count(*) FILTER (WHERE NOT success AND severity = 'WARN') AS n_warn_failures FROM ("
    + " UNION ALL ".join(f"SELECT * FROM ({_prepend(c)})" for c in _CHECKS.values()) + ") GROUP BY 1"
)

# The detector as a recursion over each household's rows: a step takes the next row or, after every 32nd value, tests
# the window and drops its oldest bucket, once per step, until no split differs. Buckets are lists of (size, sum, squares).
_SPLIT = "list_sum(list_transform(buckets[1:k], lambda z: z.n))"
_PART = "list_sum(list_transform(buckets[1:k], lambda z: z.s))"
_CONFIDENCE = "ln(2 * ln(greatest(width, 2)) / delta)"
_HARMONIC = f"(1.0 / nullif({_SPLIT} - 4, 0) + 1.0 / nullif(width - {_SPLIT} - 4, 0))"
_DIFFERS = f"""len(list_filter(range(1, len(buckets) + 1), lambda k: {_SPLIT} >= 5 AND width - {_SPLIT} >= 5
    AND abs({_PART} / {_SPLIT} - (total - {_PART}) / nullif(width - {_SPLIT}, 0))
        > sqrt(greatest(2 * {_HARMONIC} * greatest(spread, 0) / nullif(width, 0) * {_CONFIDENCE}, 0)) + 2.0 / 3 * {_CONFIDENCE} * {_HARMONIC})) > 0"""
_MERGED = """list_reduce(
    list_concat([list_append(buckets, {'n': 1::BIGINT, 's': value, 'q': 0.0::DOUBLE})],
                list_transform([1, 2, 4, 8, 16, 32, 64, 128, 256, 512], lambda z: [{'n': z::BIGINT, 's': 0.0::DOUBLE, 'q': 0.0::DOUBLE}])),
    lambda acc, m: CASE WHEN len(list_filter(acc, lambda z: z.n = m[1].n)) <= 5 THEN acc ELSE list_concat(
        list_append(acc[1:list_position(list_transform(acc, lambda z: z.n), m[1].n) - 1],
            {'n': 2 * m[1].n,
             's': acc[list_position(list_transform(acc, lambda z: z.n), m[1].n)].s + acc[list_position(list_transform(acc, lambda z: z.n), m[1].n) + 1].s,
             'q': acc[list_position(list_transform(acc, lambda z: z.n), m[1].n)].q + acc[list_position(list_transform(acc, lambda z: z.n), m[1].n) + 1].q
                  + pow((acc[list_position(list_transform(acc, lambda z: z.n), m[1].n)].s - acc[list_position(list_transform(acc, lambda z: z.n), m[1].n) + 1].s) / m[1].n, 2) * m[1].n / 2}),
        acc[list_position(list_transform(acc, lambda z: z.n), m[1].n) + 2:]) END)"""


def _detector(rows: str, result: str) -> str:
    """``rows``: household_id, timestamp, seq, op, value. ``result`` selects from ``walk`` (a row a step) and ``inputs``."""
    return f"""SELECT * FROM (WITH RECURSIVE
    inputs AS (SELECT household_id, timestamp, op, CAST(value AS DOUBLE) AS value,
                      row_number() OVER (PARTITION BY household_id ORDER BY timestamp, seq) AS i FROM ({rows})),
    walk AS (
        SELECT household_id, 0::BIGINT AS i, NULL::TIMESTAMP AS seen_at, 0.002::DOUBLE AS delta, 0::BIGINT AS ticks, 0::BIGINT AS updates,
               0::BIGINT AS width, 0.0::DOUBLE AS total, 0.0::DOUBLE AS spread, []::STRUCT(n BIGINT, s DOUBLE, q DOUBLE)[] AS buckets,
               FALSE AS checking, FALSE AS found, FALSE AS drifted FROM (SELECT DISTINCT household_id FROM inputs)
        UNION ALL
        SELECT household_id, coalesce(x_i, i), coalesce(x_seen, seen_at), CASE WHEN op = 'delta' THEN value ELSE delta END,
               CASE WHEN op = 'value' THEN ticks + 1 WHEN op IS NULL THEN ticks ELSE 0 END, updates + (coalesce(op, '') = 'value')::BIGINT,
               CASE WHEN op = 'value' THEN width + 1 WHEN op IS NOT NULL THEN 0 WHEN differs THEN width - buckets[1].n ELSE width END,
               CASE WHEN op = 'value' THEN total + value WHEN op IS NOT NULL THEN 0 WHEN differs THEN total - buckets[1].s ELSE total END,
               CASE WHEN op = 'value' THEN spread + coalesce(pow(value - total / nullif(width, 0), 2) * width / (width + 1), 0)
                    WHEN op IS NOT NULL THEN 0
                    WHEN differs THEN spread - buckets[1].q - pow(buckets[1].s / buckets[1].n - (total - buckets[1].s) / (width - buckets[1].n), 2)
                                      * buckets[1].n * (width - buckets[1].n) / width ELSE spread END,
               CASE WHEN op = 'value' THEN {_MERGED} WHEN op IS NOT NULL THEN buckets[1:0] WHEN differs THEN buckets[2:] ELSE buckets END,
               CASE WHEN op = 'value' THEN (ticks + 1) % 32 = 0 AND width + 1 > 10 WHEN op IS NOT NULL THEN FALSE ELSE differs END,
               op IS NULL AND differs, op IS NULL AND NOT differs AND found
        FROM (SELECT w.*, x.op, x.value, x.i AS x_i, x.timestamp AS x_seen, CASE WHEN w.checking THEN {_DIFFERS} ELSE FALSE END AS differs
              FROM walk w LEFT JOIN inputs x ON x.household_id = w.household_id AND x.i = w.i + 1 AND NOT w.checking
              WHERE w.checking OR x.i IS NOT NULL)),
    last AS (SELECT * FROM walk WHERE i > 0 AND NOT checking QUALIFY row_number() OVER (PARTITION BY household_id ORDER BY i DESC, drifted DESC, found) = 1)
    {result})"""


_SHIFTED = """SELECT household_id, timestamp, seq, 'value' AS op, CASE WHEN timestamp >= TIMESTAMP '2024-01-16' THEN consumption_kwh * 4 ELSE consumption_kwh END AS value
    FROM readings WHERE consumption_kwh IS NOT NULL"""
_ROW = "household_id, 'consumption_kwh' AS feature, seen_at AS timestamp, {} AS kind, updates AS n_updates, width, delta"
_WINDOWS = "SELECT household_id, 'consumption_kwh' AS feature, width, updates AS n_updates, delta FROM last"
QUERIES["adwin_events"] = _detector(_SHIFTED, f"SELECT {_ROW.format(chr(39) + 'drift' + chr(39))} FROM walk WHERE drifted UNION ALL SELECT {_ROW.format(chr(39) + 'state' + chr(39))} FROM last")
QUERIES["adwin_stream"] = _detector(
    "SELECT household_id, timestamp, seq, 'value' AS op, consumption_kwh AS value FROM meter_raw WHERE consumption_kwh IS NOT NULL", _WINDOWS)
QUERIES["adwin_reset"] = _detector(
    f"{_SHIFTED} UNION ALL SELECT DISTINCT household_id, TIMESTAMP '2024-01-29', -2, 'reset', NULL FROM readings"
    " UNION ALL SELECT DISTINCT household_id, TIMESTAMP '2024-01-10', -1, 'delta', 0.05 FROM readings", _WINDOWS)

_ATTEMPTS = (("meter_raw", 0), ("readings", 1), ("meter_raw", 1))
QUERIES["gated_publish"] = " UNION ALL ".join(
    f"SELECT {i} AS version, 'smart_meter' AS suite, (SELECT count(*) FROM {rows}) AS n_rows,"
    " count(*) FILTER (WHERE NOT success AND severity = 'CRITICAL') = 0 AS published, count(*) AS n_expectations,"
    " count(*) FILTER (WHERE NOT success AND severity = 'CRITICAL') AS n_critical_failures,"
    " count(*) FILTER (WHERE NOT success AND severity = 'WARN') AS n_warn_failures,"
    f" {readable} * (SELECT count(*) FROM readings) AS readable_rows FROM ({_CHECKS['smart_meter'].replace('meter_raw', rows)})"
    for i, (rows, readable) in enumerate(_ATTEMPTS, 1)
)

# Views, clicks and errors are tested, all others measured.
_DRIFT = f"""
    SELECT feature,
           CASE WHEN feature IN ('view', 'click', 'error') THEN {KS_P} < 0.05 ELSE w >= 0.1 END AS drift_detected,
           CASE WHEN feature IN ('view', 'click', 'error') THEN {KS_P} ELSE w END AS score,
           CASE WHEN feature IN ('view', 'click', 'error') THEN 'ks' ELSE 'wasserstein' END AS stattest
    FROM (SELECT *, ks_d * ks_d * (n_ref * n_cur / (n_ref + n_cur)) AS d2 FROM ({{}}))"""
_MEASURES = (
    "feature, any_value(na) AS n_ref, any_value(nb) AS n_cur, max(abs(f - g)) AS ks_d, "
    f"{WASSERSTEIN} / greatest(any_value(ref_std), 0.001) AS w"
)
_FEATURES = _DRIFT.format(_distances("drift_rows", _MEASURES))
QUERIES["feature_drift"] = (
    f"SELECT feature, drift_detected, {rnd('score')} AS drift_score, stattest,"
    f" CASE WHEN drift_detected THEN 'CRITICAL' ELSE 'OK' END AS severity FROM ({_FEATURES})"
)
QUERIES["dataset_drift"] = (
    "SELECT avg(CAST(drift_detected AS DOUBLE)) >= 0.5 AS dataset_drift, count(*) FILTER (WHERE drift_detected) AS n_drifted_columns,"
    f" {rnd('avg(CAST(drift_detected AS DOUBLE))')} AS share_drifted_columns FROM ({_FEATURES})"
)
QUERIES["residual_drift"] = QUERIES["feature_drift"].replace("drift_rows", "residual_rows")


ORACLES = {name: _prepend(sql) for name, sql in QUERIES.items()}
