"""DuckDB SQL for the geographic queries, written apart from the DataFrame code."""

from __future__ import annotations

from gridwatch.sources.fixtures import duck

CONF = "CASE WHEN lower(trim(confidence)) IN ('high', 'h') THEN 100.0 WHEN lower(trim(confidence)) IN ('nominal', 'n', 'medium') THEN 50.0 WHEN lower(trim(confidence)) IN ('low', 'l') THEN 0.0 WHEN regexp_full_match(lower(trim(confidence)), '[0-9]+(\\.[0-9]+)?') THEN CAST(trim(confidence) AS DOUBLE) END"

FIRES = f"""f0 AS (SELECT *, CAST({CONF} AS DOUBLE) AS confidence_score FROM fires_raw),
fires AS (SELECT * FROM f0 WHERE confidence_score >= 30
  QUALIFY row_number() OVER (PARTITION BY firms_source, latitude, longitude, acq_date, acq_time, satellite, instrument ORDER BY event_id) = 1)"""
DAILY = "daily AS (SELECT station_id, latitude, longitude, date, max(temp) AS temperature_2m_max, min(rhum) AS relative_humidity_2m_min, max(wspd) AS wind_speed_10m_max, sum(prcp) AS precipitation_sum FROM hourly_obs GROUP BY ALL)"


def cell(lat: str = "latitude", lon: str = "longitude") -> str:
    i, j = f"CAST(floor({lat} / 0.5) AS INT)", f"CAST(floor({lon} / 0.5) AS INT)"
    return f"{i} AS grid_lat_index, {j} AS grid_lon_index, {i} || '_' || {j} AS grid_id, {i} * CAST(0.5 AS DOUBLE) AS grid_lat, {j} * CAST(0.5 AS DOUBLE) AS grid_lon"


KEY = "grid_id, grid_lat_index, grid_lon_index, grid_lat, grid_lon"
WEATHER = f"""wc AS (SELECT *, {cell()} FROM daily),
weather AS (SELECT {KEY}, date, avg(temperature_2m_max) AS temperature_2m_max, avg(relative_humidity_2m_min) AS relative_humidity_2m_min, avg(wind_speed_10m_max) AS wind_speed_10m_max,
  avg(precipitation_sum) AS precipitation_sum, CAST(0 AS DOUBLE) AS station_distance_km, count(DISTINCT station_id) AS weather_points_count FROM wc GROUP BY ALL)"""
FIRE_CELLS = f"""fc AS (SELECT *, acq_date AS date, {cell()} FROM fires),
fire_days AS (SELECT {KEY}, date, CAST(count(*) AS INT) AS fire_count, avg(confidence_score) AS avg_fire_confidence, avg(frp) AS avg_frp, max(frp) AS max_frp FROM fc GROUP BY ALL)"""
NDVI = f"""n0 AS (SELECT *, CASE WHEN raw > -3000 THEN raw END AS v FROM ndvi_pixels),
n1 AS (SELECT *, CASE WHEN max(v) OVER (PARTITION BY composite_date) > 2 OR min(v) OVER (PARTITION BY composite_date) < -1 THEN v * 0.0001 ELSE v END AS u FROM n0),
n2 AS (SELECT *, {cell('y', 'x')} FROM n1 WHERE u BETWEEN -0.2 AND 1.0),
ndvi AS (SELECT {KEY}, composite_date, avg(u) AS mean_ndvi, count(*) AS ndvi_pixel_count FROM n2 GROUP BY ALL)"""
NDVI30 = "nd AS (SELECT w.grid_id, w.date, avg(mean_ndvi) AS mean_ndvi_30days FROM (SELECT DISTINCT grid_id, date FROM weather) w LEFT JOIN ndvi n ON n.grid_id = w.grid_id AND n.composite_date BETWEEN w.date - 29 AND w.date GROUP BY ALL)"
FEATURES = f"""{NDVI30},
j AS (SELECT w.*, coalesce(fire_count, 0) AS fire_count, coalesce(avg_fire_confidence, 0) AS avg_fire_confidence, coalesce(avg_frp, 0) AS avg_frp, coalesce(max_frp, 0) AS max_frp, mean_ndvi_30days
  FROM weather w LEFT JOIN (SELECT grid_id, date, fire_count, avg_fire_confidence, avg_frp, max_frp FROM fire_days) f USING (grid_id, date) LEFT JOIN nd USING (grid_id, date)
  WHERE date BETWEEN (SELECT min(date) FROM fire_days) AND (SELECT max(date) FROM fire_days)),
k AS (SELECT *, CASE WHEN precipitation_sum = 0 THEN 1 ELSE 0 END AS dry, sum(CASE WHEN precipitation_sum = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY grid_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS wet,
  sum(coalesce(precipitation_sum, 0)) OVER (PARTITION BY grid_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS precipitation_sum_7days FROM j),
features AS (SELECT {KEY}, date, temperature_2m_max, relative_humidity_2m_min, wind_speed_10m_max, precipitation_sum, precipitation_sum_7days,
  CAST(sum(dry) OVER (PARTITION BY grid_id, wet ORDER BY date ROWS UNBOUNDED PRECEDING) AS INT) AS dry_days_count, mean_ndvi_30days, station_distance_km, weather_points_count, fire_count, avg_fire_confidence, avg_frp, max_frp,
  CASE WHEN fire_count > 0 THEN 1 ELSE 0 END AS fire_occurred, CASE WHEN fire_count > 5 THEN 2 WHEN fire_count > 0 THEN 1 ELSE 0 END AS risk_level FROM k)"""
ALL = f"{duck('fires_raw', 'hourly_obs', 'ndvi_pixels', 'edges', 'stations', 'subscribers')},\n{FIRES},\n{DAILY},\n{WEATHER},\n{FIRE_CELLS},\n{NDVI},\n{FEATURES}"
PRED = """pred AS (SELECT grid_id, date, grid_lat + 0.25 AS latitude, grid_lon + 0.25 AS longitude, fire_count / (fire_count + 1.0::DOUBLE) AS risk_score,
  CASE WHEN fire_count / (fire_count + 1.0::DOUBLE) >= 0.6 THEN 2 WHEN fire_count / (fire_count + 1.0::DOUBLE) >= 0.33 THEN 1 ELSE 0 END AS risk_level FROM features),
al AS (SELECT 'FORECAST|' || grid_id || '|' || CAST(date AS STRING) AS alert_id, latitude, longitude, risk_level AS rank FROM pred WHERE risk_level > 0),
matches AS (SELECT alert_id, id AS subscriber_id FROM al JOIN subscribers s ON s.status = 'active' AND s.min_severity_rank <= al.rank
  AND (bbox_min_lon IS NULL OR (latitude BETWEEN bbox_min_lat AND bbox_max_lat AND longitude BETWEEN bbox_min_lon AND bbox_max_lon)))"""
INSIDE = """x AS (SELECT DISTINCT latitude, longitude FROM fires_raw),
par AS (SELECT latitude, longitude, poly, ring, count(*) % 2 AS odd FROM x JOIN edges ON (y1 > latitude) <> (y2 > latitude) AND longitude < (x2 - x1) * (latitude - y1) / (y2 - y1) + x1 GROUP BY ALL),
ins AS (SELECT DISTINCT latitude, longitude FROM (SELECT latitude, longitude, poly FROM par GROUP BY ALL HAVING max(CASE WHEN ring = 0 THEN odd ELSE 0 END) = 1 AND max(CASE WHEN ring > 0 THEN odd ELSE 0 END) = 0))"""


R = "round({0}, 6) + 0.0 AS {0}"
FEATURE_DOUBLES = ["temperature_2m_max", "relative_humidity_2m_min", "wind_speed_10m_max", "precipitation_sum", "precipitation_sum_7days", "mean_ndvi_30days", "station_distance_km", "avg_fire_confidence", "avg_frp", "max_frp", "grid_lat", "grid_lon"]
rep = lambda names: "* REPLACE (" + ", ".join(R.format(n) for n in names) + ")"
PROFILED = ["precipitation_sum", "temperature_2m_max", "mean_ndvi_30days", "fire_count", "avg_frp"]
RULES = {
    "duplicate_keys": "count(*) - count(DISTINCT grid_id || ' ' || CAST(date AS STRING))", "label_without_fires": "count(*) FILTER (fire_occurred = 1 AND fire_count = 0)",
    "fires_without_label": "count(*) FILTER (fire_occurred = 0 AND fire_count > 0)", "negative_precipitation": "count(*) FILTER (precipitation_sum < 0)",
    "negative_dry_days": "count(*) FILTER (dry_days_count < 0)", "negative_fire_count": "count(*) FILTER (fire_count < 0)",
}
W = "OVER (PARTITION BY grid_id ORDER BY date ROWS BETWEEN {} PRECEDING AND 1 PRECEDING)"
LAG = "lag({}, {}) OVER (PARTITION BY grid_id ORDER BY date)"
T, H, WIND, RAIN, NV = "temperature_2m_max", "relative_humidity_2m_min", "wind_speed_10m_max", "precipitation_sum", "mean_ndvi_30days"
ADVANCED = {f"{n}_{k}": LAG.format(c, k) for n, c, ks in (("precip_lag", RAIN, (1, 3, 7)), ("temp_lag", T, (1, 3, 7)), ("humidity_lag", H, (1,)), ("wind_lag", WIND, (1,)), ("ndvi_lag", NV, (1,))) for k in ks}
ADVANCED |= {f"temp_{n}d_avg": f"avg({T}) {W.format(n)}" for n in (7, 30)} | {f"temp_{n}d_std": f"stddev_samp({T}) {W.format(n)}" for n in (7, 30)} | {f"humidity_{n}d_avg": f"avg({H}) {W.format(n)}" for n in (7, 30)}
ADVANCED |= {"wind_7d_avg": f"avg({WIND}) {W.format(7)}", "ndvi_30d_avg": f"avg({NV}) {W.format(30)}", "ndvi_30d_min": f"min({NV}) {W.format(30)}"} | {f"precip_{n}d_sum": f"sum({RAIN}) {W.format(n)}" for n in (14, 30)}
ADVANCED |= {f"dry_days_{n}d": f"sum(CASE WHEN {RAIN} < 1.0 THEN 1.0::DOUBLE ELSE 0 END) {W.format(n)}" for n in (14, 30)}
ADVANCED |= {"month": "month(date)::DOUBLE", "dayofyear": "dayofyear(date)::DOUBLE", "month_sin": "sin(2 * pi() * month(date) / 12)", "month_cos": "cos(2 * pi() * month(date) / 12)", "dayofyear_sin": "sin(2 * pi() * dayofyear(date) / 366)",
             "dayofyear_cos": "cos(2 * pi() * dayofyear(date) / 366)", "heat_dryness_index": f"{T} * (100 - {H})", "wind_dryness_index": f"{WIND} * (100 - {H})", "lat_band": "floor(grid_lat / 5)::DOUBLE", "lon_band": "floor(grid_lon / 5)::DOUBLE"}
SCORES = duck("scores")
CURVE = f"""{SCORES}, t AS (SELECT CAST(unnest([0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8]) AS DOUBLE) AS threshold),
c AS (SELECT threshold, count(*) FILTER (label = 1 AND probability >= threshold) AS tp, count(*) FILTER (label = 0 AND probability >= threshold) AS fp, count(*) FILTER (label = 0 AND probability < threshold) AS tn, count(*) FILTER (label = 1 AND probability < threshold) AS fn FROM scores, t GROUP BY 1),
m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS "precision", coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, (tp + tn) / (tp + tn + fp + fn) AS accuracy FROM c),
curve AS (SELECT *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) AS f1 FROM m)"""

ORACLE_SQL = {
    "fire_cell_days": f"{ALL} SELECT {rep(['avg_fire_confidence', 'avg_frp', 'max_frp', 'grid_lat', 'grid_lon'])}, CASE WHEN fire_count > 0 THEN 1 ELSE 0 END AS fire_occurred, CASE WHEN fire_count > 5 THEN 2 WHEN fire_count > 0 THEN 1 ELSE 0 END AS risk_level FROM fire_days",
    "confidence_scores": f"{duck('fires_raw')} SELECT confidence, count(*) AS n, CAST({CONF} AS DOUBLE) AS score, CAST(CASE lower(trim(confidence)) WHEN 'l' THEN 30 WHEN 'n' THEN 60 WHEN 'h' THEN 90 ELSE CASE WHEN regexp_full_match(trim(confidence), '[0-9]+(\\.[0-9]+)?') THEN CAST(trim(confidence) AS DOUBLE) END END AS DOUBLE) AS dashboard_score FROM fires_raw GROUP BY confidence",
    "fires_dedup": f"{ALL} SELECT event_id, firms_source, latitude, longitude, acq_date, acq_time, confidence_score, round(frp, 6) + 0.0 AS frp FROM fires",
    "acquired": f"{duck('fires_raw')} SELECT DISTINCT event_id, acq_date, acq_time, acq_date + to_minutes(CAST(acq_time // 100 * 60 + acq_time % 100 AS INT)) AS acquired_at FROM fires_raw",
    "box_filter": f"{ALL} SELECT event_id, latitude, longitude, round(frp, 6) + 0.0 AS frp FROM fires WHERE longitude BETWEEN 104 AND 108 AND latitude BETWEEN 10 AND 18",
    "region_counts": f"{ALL} SELECT region, count(*) AS n FROM fires JOIN (VALUES ('Vietnam', 8.0, 24.5, 102.0, 110.8), ('SE Asia', -5.0, 28.0, 90.0, 125.0), ('All area', -15.0, 35.0, 85.0, 130.0)) r(region, lat_min, lat_max, lon_min, lon_max) "
    "ON latitude BETWEEN lat_min AND lat_max AND longitude BETWEEN lon_min AND lon_max GROUP BY region",
    "recent_fires": f"{ALL} SELECT event_id, acquired_at FROM fires WHERE acquired_at >= (SELECT max(acquired_at) FROM fires) - INTERVAL 24 HOUR",
    "station_days": f"{ALL} SELECT {rep(['temperature_2m_max', 'relative_humidity_2m_min', 'wind_speed_10m_max', 'precipitation_sum'])} FROM daily",
    "weather_cell_days": f"{ALL} SELECT {rep(['temperature_2m_max', 'relative_humidity_2m_min', 'wind_speed_10m_max', 'precipitation_sum'])} FROM weather",
    "ndvi_grid": f"{ALL} SELECT {rep(['mean_ndvi'])} FROM ndvi",
    "ndvi_window": f"{ALL} SELECT {rep(['mean_ndvi_30days'])} FROM nd",
    "feature_table": f"{ALL} SELECT {rep(FEATURE_DOUBLES)} FROM features",
    "advanced_features": f"{ALL}, a AS (SELECT grid_id, date, {NV}, " + ", ".join(f"{e} AS {n}" for n, e in ADVANCED.items()) + " FROM features) SELECT grid_id, date, "
    + ", ".join(f"round({n}, 4) + 0.0 AS {n}" for n in ADVANCED) + f", round(coalesce({NV}, 0) * coalesce(dry_days_30d, 0), 4) + 0.0 AS vegetation_dryness_index FROM a",
    "unmatched_fires": f"{ALL} SELECT count(*) AS unmatched FROM fc WHERE NOT EXISTS (SELECT 1 FROM weather w WHERE w.grid_id = fc.grid_id AND w.date = fc.date)",
    "coverage_bounds": f"{ALL}, u AS (SELECT CASE WHEN event_id % 2 = 0 THEN acq_date - 3 ELSE acq_date END AS a, acq_date + CAST(event_id % 3 AS INT) AS b FROM fires UNION ALL SELECT date, date FROM fire_days UNION ALL SELECT composite_date, composite_date + 15 FROM ndvi_pixels) SELECT min(a) AS first_date, max(b) AS last_date FROM u",
    "column_profile": ALL + " " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, round(CAST(min({c}) AS DOUBLE), 6) + 0.0 AS min, round(CAST(max({c}) AS DOUBLE), 6) + 0.0 AS max FROM features" for c in PROFILED),
    "risk_value_counts": f"{ALL} SELECT risk_level, count(*) AS n FROM features GROUP BY 1",
    "integrity_rules": ALL + " " + " UNION ALL ".join(f"SELECT '{k}' AS rule, {v} AS issues, CASE WHEN {v} = 0 THEN 'PASS' ELSE 'WARN' END AS status FROM features" for k, v in RULES.items()),
    "duplicate_audit": f"{duck('fires_raw')} SELECT count(*) - count(DISTINCT (firms_source, latitude, longitude, acq_date, acq_time, satellite, instrument)) AS duplicates FROM fires_raw",
    "date_split": f"{ALL} SELECT CASE WHEN date <= DATE '2024-01-20' THEN 'train' WHEN date <= DATE '2024-01-25' THEN 'validation' ELSE 'test' END AS split, count(*) AS n, CAST(sum(fire_occurred) AS BIGINT) AS positives FROM features GROUP BY 1",
    "heatmap": f"{ALL}, {INSIDE} SELECT grid_id, (grid_lat_index + 0.5) * 0.5::DOUBLE AS lat, (grid_lon_index + 0.5) * 0.5::DOUBLE AS lon, count(*) AS n FROM fc JOIN ins USING (latitude, longitude) GROUP BY grid_id, grid_lat_index, grid_lon_index ORDER BY n DESC, grid_id LIMIT 100",
    "points_in_boundary": f"{ALL}, {INSIDE} SELECT latitude, longitude, count(*) AS n FROM fires_raw JOIN ins USING (latitude, longitude) GROUP BY 1, 2",
    "point_cells": f"{ALL} SELECT grid_id, grid_lat, grid_lon, count(*) AS n FROM fc WHERE grid_lat_index BETWEEN 18 AND 45 AND grid_lon_index BETWEEN 206 AND 219 GROUP BY ALL",
    "boundary_cells": f"""{ALL}, box AS (SELECT i || '_' || j AS grid_id, CAST(i AS DOUBLE) / 2 AS y0, CAST(j AS DOUBLE) / 2 AS x0 FROM range(18, 46) a(i), range(206, 220) b(j)),
turn AS (SELECT grid_id, x0, y0, poly, ring, least(x1, x2) <= x0 + 0.5 AND greatest(x1, x2) >= x0 AND least(y1, y2) <= y0 + 0.5 AND greatest(y1, y2) >= y0 AS near,
  (x2 - x1) * (y0 - y1) - (y2 - y1) * (x0 - x1) AS c, (x2 - x1) * 0.5 AS up, (y2 - y1) * -0.5 AS rt,
  (y1 > y0) <> (y2 > y0) AND x0 < (x2 - x1) * (y0 - y1) / nullif(y2 - y1, 0) + x1 AS crossed FROM box, edges),
ring AS (SELECT grid_id, x0, y0, poly, ring, bool_or(near AND least(c, c + up, c + rt, c + up + rt) <= 0 AND greatest(c, c + up, c + rt, c + up + rt) >= 0) AS met, count(*) FILTER (crossed) % 2 = 1 AS odd FROM turn GROUP BY ALL),
poly AS (SELECT grid_id, x0, y0, poly, bool_or(met) OR (bool_or(odd AND ring = 0) AND NOT bool_or(odd AND ring > 0)) AS ok FROM ring GROUP BY ALL),
fired AS (SELECT grid_id, count(*) AS n FROM fc GROUP BY 1)
SELECT grid_id, y0 AS grid_lat, x0 AS grid_lon, 0.0::DOUBLE AS station_distance_km, 1.0::DOUBLE AS weather_points_count, 0.0::DOUBLE AS mean_ndvi_30days, coalesce(any_value(n), 0) AS fires FROM poly LEFT JOIN fired USING (grid_id) WHERE ok GROUP BY 1, 2, 3""",
    # The area under each edge, cut off at the cell's sides, summed around the ring.
    "clipped_boundary": f"""{ALL}, box AS (SELECT i || '_' || j AS grid_id, CAST(i AS DOUBLE) / 2 AS y0, CAST(j AS DOUBLE) / 2 AS x0 FROM range(17, 47) a(i), range(205, 221) b(j)),
cut AS (SELECT *, greatest(least(x1, x2), x0) AS a, least(greatest(x1, x2), x0 + 0.5) AS b, (y2 - y1) / (x2 - x1) AS m FROM box, edges WHERE x1 <> x2),
ends AS (SELECT *, y1 + m * (a - x1) - y0 AS ya, y1 + m * (b - x1) - y0 AS yb FROM cut WHERE a < b),
area AS (SELECT *, sign(x2 - x1) * CASE WHEN m = 0 THEN (b - a) * least(greatest(ya, 0), 0.5)
  ELSE ((CASE WHEN yb < 0 THEN 0 WHEN yb < 0.5 THEN yb * yb / 2 ELSE 0.125 + (yb - 0.5) / 2 END) - (CASE WHEN ya < 0 THEN 0 WHEN ya < 0.5 THEN ya * ya / 2 ELSE 0.125 + (ya - 0.5) / 2 END)) / m END AS part FROM ends),
fired AS (SELECT grid_id, count(*) AS n FROM fc GROUP BY 1),
rings AS (SELECT grid_id, poly, ring, abs(sum(part)) * CASE WHEN ring = 0 THEN 1 ELSE -1 END AS area FROM area GROUP BY 1, 2, 3)
SELECT grid_id, round(sum(area), 6) AS area, coalesce(any_value(n), 0) AS fires FROM rings LEFT JOIN fired USING (grid_id) GROUP BY 1 HAVING sum(area) > 1e-9""",
    "composite_dates": f"""{duck('raster_names')} SELECT CASE WHEN o.file_name LIKE '%doy%' THEN CAST(make_date(CAST(substr(file_name, 9, 4) AS INT), 1, 1) + CAST(substr(file_name, 13, 3) AS INT) - 1 AS DATE)
  WHEN o.file_name LIKE '%_20%' THEN CAST(try_strptime(substr(file_name, 6, 8), '%Y%m%d') AS DATE) END AS composite_date, count(*) AS n FROM raster_names o GROUP BY 1""",
    "safe_names": "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g') AS file_name FROM pages",
    "size_texts": """WITH b AS (SELECT o_custkey, CAST(sum(o_orderkey * o_orderkey) AS BIGINT) AS bytes FROM orders GROUP BY 1)
SELECT o_custkey, bytes, CASE WHEN bytes < 1024 THEN format('{:.1f} B', bytes / 1) WHEN bytes < 1048576 THEN format('{:.1f} KB', bytes / 1024) WHEN bytes < 1073741824 THEN format('{:.1f} MB', bytes / 1048576) ELSE format('{:.1f} GB', bytes / 1073741824) END AS size_text FROM b""",
    "nearest_station": f"""{ALL}, p AS (SELECT DISTINCT CAST(latitude * 64 AS INT) || '_' || CAST(longitude * 64 AS INT) AS point_id, latitude, longitude FROM fires_raw),
km AS (SELECT point_id, s.id, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians(s.latitude - p.latitude) / 2), 2) + cos(radians(p.latitude)) * cos(radians(s.latitude)) * pow(sin(radians(s.longitude - p.longitude) / 2), 2))), 3) AS d FROM p, stations s)
SELECT point_id, arg_min(id, [d, id]) AS station_id, round(min(d), 2) AS distance_km FROM km GROUP BY 1""",
    "dense_calendar": f"{duck('hourly_obs')}, t AS (SELECT station_id, date, sum(prcp) AS rain FROM hourly_obs WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY 1, 2) "
    "SELECT s.station_id, CAST(30 AS BIGINT) AS days, count(rain) AS known, round(sum(rain), 6) + 0.0 AS rain FROM (SELECT DISTINCT station_id FROM hourly_obs) s LEFT JOIN t USING (station_id) GROUP BY 1",
    "monthly_trend": f"{ALL} SELECT CAST(date_trunc('month', acq_date) AS DATE) AS month, count(*) AS points, round(sum(frp), 6) + 0.0 AS frp_total, round(sum(frp) / count(*), 6) + 0.0 AS frp_avg FROM fires GROUP BY 1",
    "annual_rollup": f"{ALL} SELECT CAST(year(acq_date) AS INT) AS year, CAST(month(acq_date) AS INT) AS month, count(*) AS points FROM fires GROUP BY ROLLUP (year(acq_date), month(acq_date))",
    "risk_by_day": f"{ALL} SELECT date, risk_level, count(*) AS n FROM features GROUP BY GROUPING SETS ((date, risk_level), (risk_level))",
    "zscore_anomalies": f"""{ALL}, h AS (SELECT grid_id, avg(fire_count) AS mean, coalesce(stddev_samp(fire_count), 0) AS std, count(*) AS days FROM features WHERE date < (SELECT max(date) FROM features) GROUP BY 1),
z AS (SELECT f.grid_id, f.date, fire_count, coalesce(mean, 0) AS mean, coalesce(std, 0) AS std, coalesce(days, 0) AS days FROM features f LEFT JOIN h USING (grid_id) WHERE f.date = (SELECT max(date) FROM features))
SELECT grid_id, date, fire_count, round(mean, 6) + 0.0 AS mean, round(std, 6) + 0.0 AS std, days, round(CASE WHEN std > 0 THEN (fire_count - mean) / std ELSE 0 END, 6) + 0.0 AS z_score, round(mean + std, 6) + 0.0 AS threshold, fire_count > 0 AND fire_count > mean + std AS is_anomaly FROM z""",
    "latest_cells": f"{ALL} SELECT grid_id, round(arg_max(precipitation_sum, date), 6) + 0.0 AS precipitation, max(date) AS date FROM features WHERE precipitation_sum IS NOT NULL GROUP BY 1",
    "top_predictions": f"{ALL}, {PRED} SELECT grid_id, date, latitude, longitude, round(risk_score, 6) + 0.0 AS risk_score, risk_level, CASE risk_level WHEN 2 THEN 'high' WHEN 1 THEN 'medium' END AS risk_label FROM pred p WHERE risk_level >= 1 ORDER BY p.risk_level DESC, p.risk_score DESC, grid_id, date LIMIT 20",
    "alert_matches": f"{ALL}, {PRED} SELECT * FROM matches",
    "undelivered_alerts": f"{ALL}, {PRED} SELECT subscriber_id, count(*) AS n FROM matches WHERE NOT (subscriber_id % 3 = 0 AND subscriber_id % 2 = 0) GROUP BY 1",
    "subscriber_top": f"{ALL}, {PRED} SELECT s.id AS subscriber_id, CAST(row_number() OVER w AS INT) AS n, grid_id, date, risk_level, round(risk_score, 6) + 0.0 AS risk_score FROM subscribers s JOIN pred ON risk_level >= s.min_severity_rank "
    "AND (s.bbox_min_lon IS NULL OR (latitude BETWEEN s.bbox_min_lat AND s.bbox_max_lat AND longitude BETWEEN s.bbox_min_lon AND s.bbox_max_lon)) WINDOW w AS (PARTITION BY s.id ORDER BY risk_level DESC, pred.risk_score DESC, date DESC, grid_id) QUALIFY n <= 5",
    "subscriber_upsert": f"{duck('subscribers')} SELECT id, channel, address, CASE WHEN id % 7 = 0 THEN 0 ELSE min_severity_rank END AS min_severity_rank, CASE WHEN id % 7 = 0 THEN NULL ELSE bbox_min_lon END AS bbox_min_lon, "
    "CASE WHEN id % 7 = 0 THEN 'active' ELSE status END AS status, CASE WHEN id % 7 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' END AS updated_at FROM subscribers "
    "UNION ALL SELECT (SELECT max(id) FROM subscribers) + row_number() OVER (ORDER BY s_name), 'email', s_name, 1, 100.0, 'active', NULL FROM supplier",
    "hot_zones": f"{ALL} SELECT grid_id || '|' || strftime(CAST(acquired_at AS DATE), '%Y-%m-%dT%H:%M:%S') || '|' || strftime(CAST(acquired_at AS DATE) + 1, '%Y-%m-%dT%H:%M:%S') AS alert_id, grid_id, count(*) AS fire_count, CAST(acquired_at AS DATE) AS day, 'high' AS severity FROM fc GROUP BY grid_id, CAST(acquired_at AS DATE) HAVING count(*) > 1",
    "class_weights": f"{SCORES} SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1, round(count(*) / (2 * count(*) FILTER (label = 0)), 6) AS weight0, round(count(*) / (2 * count(*) FILTER (label = 1)), 6) AS weight1 FROM scores",
    "threshold_curve": f'{CURVE} SELECT threshold, tp, fp, tn, fn, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(specificity, 6) AS specificity, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1 FROM curve',
    "best_threshold": f"{CURVE} SELECT threshold, round(f1, 6) AS f1, round(recall, 6) AS recall, fp FROM curve c ORDER BY c.f1 DESC, c.recall DESC, fp LIMIT 1",
    "top_fraction": f"{SCORES}, k AS (SELECT greatest(1, CAST(round_even(count(*) * 0.1, 0) AS BIGINT)) AS k, count(*) FILTER (label = 1) AS p FROM scores), r AS (SELECT label, row_number() OVER (ORDER BY probability DESC, event_id) AS n FROM scores) SELECT any_value(k) AS k, count(*) FILTER (label = 1 AND n <= k) AS hits, round(count(*) FILTER (label = 1 AND n <= k) / any_value(k), 6) AS \"precision\", round(count(*) FILTER (label = 1 AND n <= k) / any_value(p), 6) AS recall FROM r, k",
    "calibration_bins": f"{SCORES} SELECT CAST(least(9, floor(probability * 10)) AS INT) AS bin, count(*) AS n, round(avg(probability), 6) AS mean_predicted, round(avg(label), 6) AS actual_rate FROM scores GROUP BY 1",
    "auc_roc": f"{SCORES}, v AS (SELECT probability, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM scores GROUP BY 1), w AS (SELECT *, sum(q) OVER (ORDER BY probability) - q AS below FROM v) SELECT round(CAST(sum(p * (below + q / 2)) AS DOUBLE) / CAST(sum(p) * sum(q) AS DOUBLE), 6) AS auc FROM w",
}

DB = """pl AS (SELECT latitude, longitude, min(event_id) AS pid, count(*) AS n FROM fires GROUP BY ALL),
pr AS (SELECT a.pid AS a, b.pid AS b, b.n FROM pl a JOIN pl b ON (a.latitude - b.latitude) ** 2 + (a.longitude - b.longitude) ** 2 <= 0.25 AND b.latitude BETWEEN a.latitude - 0.5 AND a.latitude + 0.5),
co AS (SELECT a AS pid FROM pr GROUP BY a HAVING sum(n) >= 20),
ed AS (SELECT a, b FROM pr WHERE a IN (SELECT pid FROM co) AND b IN (SELECT pid FROM co)),
rc(a, b) AS (SELECT a, b FROM ed UNION SELECT rc.a, ed.b FROM rc JOIN ed ON rc.b = ed.a),
cc AS (SELECT a AS pid, min(b) AS cluster_id FROM rc GROUP BY 1),
cl AS (SELECT pl.pid, coalesce(own.cluster_id, min(cc.cluster_id)) AS cluster_id FROM pl LEFT JOIN cc own USING (pid) LEFT JOIN pr ON pr.a = pl.pid LEFT JOIN cc ON cc.pid = pr.b GROUP BY pl.pid, own.cluster_id),
db AS (SELECT fires.*, coalesce(cluster_id, -1) AS cluster_id FROM fires JOIN pl USING (latitude, longitude) LEFT JOIN cl USING (pid))"""
RALL = ALL.replace("WITH ", "WITH RECURSIVE ", 1)
PR = f"""{SCORES}, v AS (SELECT probability, count(*) FILTER (label = 1) AS p, count(*) AS n FROM scores GROUP BY 1),
w AS (SELECT p, sum(p) OVER o AS tp, sum(n) OVER o AS k, sum(p) OVER o - p AS tp0, sum(n) OVER o - n AS k0 FROM v WINDOW o AS (ORDER BY probability DESC))"""
FORECAST_COLUMNS = ["precip_lag_1", "temp_7d_avg", "temp_30d_std", "dry_days_30d", "heat_dryness_index"]

ORACLE_SQL |= {
    "forecast_rows": f"{ALL}, a AS (SELECT grid_id, date, precipitation_sum_7days, dry_days_count, " + ", ".join(f"{ADVANCED[n]} AS {n}" for n in FORECAST_COLUMNS) + " FROM features) SELECT grid_id, date, dry_days_count, "
    + ", ".join(f"round({n}, 4) + 0.0 AS {n}" for n in ["precipitation_sum_7days", *FORECAST_COLUMNS]) + " FROM a WHERE date BETWEEN DATE '2024-01-21' AND DATE '2024-01-25'",
    "missing_days": f"{ALL} SELECT date FROM (SELECT CAST(DATE '2024-01-25' + CAST(unnest(range(12)) AS INT) AS DATE) AS date) WHERE date NOT IN (SELECT date FROM weather)",
    "latest_ndvi": f"{ALL}, l AS (SELECT grid_id, arg_max(mean_ndvi, composite_date) AS v FROM ndvi WHERE mean_ndvi IS NOT NULL GROUP BY 1) SELECT grid_id, round(coalesce(v, 0), 6) + 0.0 AS mean_ndvi_30days FROM (SELECT DISTINCT grid_id FROM features) LEFT JOIN l USING (grid_id)",
    "request_answers": f"{ALL}, {PRED}, q AS (SELECT id, CAST(8 + id % 15 AS DOUBLE) AS lat, CAST(102 + id % 8 AS DOUBLE) AS lon, DATE '2024-01-01' + CAST(id % 45 AS INT) AS d FROM subscribers), "
    "t AS (SELECT q.*, CASE WHEN d IN (SELECT date FROM pred) THEN d ELSE (SELECT max(date) FROM pred) END AS day FROM q) SELECT id AS request_id, date, grid_id, latitude, longitude, round(risk_score, 6) + 0.0 AS risk_score, risk_level FROM t JOIN pred ON date = day "
    "QUALIFY row_number() OVER (PARTITION BY id ORDER BY (latitude - lat) ** 2 + (longitude - lon) ** 2, grid_id) = 1",
    "risk_kpis": f"{ALL}, {PRED} SELECT count(DISTINCT grid_id) AS cells, round(avg(risk_score), 6) + 0.0 AS mean_score, count(*) FILTER (risk_level = 2) AS high, max(date) AS latest FROM pred",
    "day_risks": f"{ALL}, {PRED} SELECT grid_id, date, latitude, longitude, round(risk_score, 6) + 0.0 AS risk_score, risk_level FROM pred WHERE date = DATE '2024-01-15' AND longitude BETWEEN 102 AND 110 AND latitude BETWEEN 13 AND 19",
    "newest_fires": f"{ALL} SELECT event_id, acq_date, acq_time FROM fires ORDER BY acq_date DESC, acq_time DESC, event_id DESC LIMIT 1500",
    "peak_month": f"{ALL}, m AS (SELECT CAST(date_trunc('month', acq_date) AS DATE) AS month, count(*) AS points FROM fires GROUP BY 1) SELECT CAST(sum(points) AS BIGINT) AS total, (SELECT month FROM m ORDER BY points DESC, month LIMIT 1) AS peak_month, round(avg(points), 6) + 0.0 AS monthly_mean FROM m",
    "cluster_facts": f"{RALL}, {DB} SELECT cluster_id, count(*) AS point_count, round(avg(confidence_score), 6) + 0.0 AS mean_confidence_score, round(max(frp), 6) + 0.0 AS max_frp, min(acquired_at) AS start_time, max(acquired_at) AS end_time FROM db WHERE cluster_id >= 0 GROUP BY 1",
    "clustering_counts": f"{RALL}, {DB} SELECT count(*) AS points, count(*) FILTER (cluster_id >= 0) AS clustered, count(*) FILTER (cluster_id < 0) AS noise, count(DISTINCT cluster_id) FILTER (cluster_id >= 0) AS clusters FROM db",
    "dbscan_points": f"{RALL}, {DB} SELECT cluster_id, count(*) AS points, min(event_id) AS first_id FROM db GROUP BY 1",
    "cell_stations": f"{ALL} SELECT grid_id, round(avg(station_distance_km), 6) + 0.0 AS avg_station_distance_km, round(avg(weather_points_count), 6) + 0.0 AS avg_weather_points FROM features GROUP BY 1",
    "delivery_counts": f"{ALL}, {PRED}, g AS (SELECT alert_id, channel, CASE WHEN subscriber_id % 5 = 0 THEN 'failed' WHEN subscriber_id % 7 = 0 THEN 'skipped' ELSE 'sent' END AS status FROM matches JOIN subscribers ON id = subscriber_id) "
    "SELECT alert_id, count(*) FILTER (status = 'sent' AND channel = 'telegram') AS telegram, count(*) FILTER (status = 'sent' AND channel = 'email') AS email, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed FROM g GROUP BY 1",
    "subscriber_changes": f"{duck('subscribers')} SELECT id, CASE WHEN id % 10 = 0 THEN 2 ELSE min_severity_rank END AS min_severity_rank, CASE WHEN id % 15 = 0 THEN 'inactive' ELSE status END AS status, id % 5 = 0 AS changed FROM subscribers",
    "boxes": f"{duck('subscribers')} SELECT id, CAST(CAST(bbox_min_lon AS INT) AS DOUBLE) AS min_lon, CAST(CAST(bbox_max_lat AS INT) AS DOUBLE) AS max_lat, bbox_min_lon IS NOT NULL AND id % 3 <> 0 AND bbox_min_lon < bbox_max_lon AND bbox_min_lat < bbox_max_lat AS valid FROM subscribers",
    "normal_alerts": f"{ALL}, {PRED} SELECT 'FORECAST|' || grid_id || '|' || CAST(date AS STRING) AS alert_id, 'FORECAST_RISK' AS alert_type, CASE risk_level WHEN 2 THEN 'high' ELSE 'medium' END AS severity_label, risk_level AS severity_rank, grid_id, round(risk_score, 6) + 0.0 AS risk_score, latitude, longitude, "
    "'https://www.openstreetmap.org/?mlat=' || latitude || '&mlon=' || longitude || '#map=10/' || latitude || '/' || longitude AS map_link FROM pred WHERE risk_level > 0",
    "top_scores": f"{ALL}, {PRED} SELECT grid_id, date, risk_level, round(risk_score, 6) + 0.0 AS risk_score FROM pred p ORDER BY p.risk_score DESC, p.risk_level DESC, grid_id, date LIMIT 10",
    "severity_rejects": "WITH s AS (SELECT ['Low', ' 2 ', 'medium', 'severe', NULL][CAST(1 + o_orderkey % 5 AS INT)] AS severity FROM orders) SELECT severity, CASE severity WHEN 'Low' THEN 0 WHEN 'medium' THEN 1 WHEN ' 2 ' THEN 2 END AS severity_rank, coalesce(severity = 'severe', false) AS rejected, count(*) AS n FROM s GROUP BY 1, 2, 3",
    "alert_messages": f"{ALL}, {PRED} SELECT day(date) % 5 = 0 OR day(date) % 7 = 0 AS rejected, count(*) AS n, CAST(sum(CASE WHEN day(date) % 5 <> 0 THEN risk_level END) AS BIGINT) AS levels FROM pred GROUP BY 1",
    "alert_texts": f"{ALL}, {PRED}, m AS (SELECT *, day(date) % 3 = 0 AS zone, CAST(date AS STRING) AS d, CASE risk_level WHEN 2 THEN 'HIGH' ELSE 'MEDIUM' END AS w, CASE WHEN day(date) % 2 = 0 THEN printf('%.4f, %.4f', latitude, longitude) END AS place FROM pred WHERE risk_level > 0), n AS (SELECT *, CASE WHEN zone THEN 'ZONE|' ELSE 'FORECAST|' END || grid_id || '|' || d AS alert_id FROM m) "
    "SELECT alert_id, 'Wildfire alert (' || w || '): grid ' || grid_id AS subject, concat_ws(chr(10), CASE WHEN zone THEN 'Wildfire alert: ' || w || ' severity hot zone' ELSE 'Wildfire forecast: ' || w || ' risk on ' || d END, '', 'Grid: ' || grid_id, 'Location: ' || place, CASE WHEN NOT zone THEN 'Forecast date: ' || d END, "
    "CASE WHEN NOT zone THEN 'Risk score: ' || printf('%.2f', risk_score) END, CASE WHEN zone THEN 'Fire count: 6 (threshold 5)' END, CASE WHEN zone THEN 'Window: ' || d || ' -> ' || d END, 'Alert ID: ' || alert_id, '', 'You receive this because you subscribed to wildfire alerts. Reply STOP or use the unsubscribe command on the Telegram bot to opt out.') AS body, "
    "concat_ws(chr(10), CASE WHEN zone THEN '🔥 <b>Wildfire Alert: ' ELSE '🛰️ <b>Wildfire Forecast: ' END || w || '</b>', '', '📍 Grid: <code>' || grid_id || '</code>', '🧭 ' || place, CASE WHEN NOT zone THEN '📅 Forecast date: ' || d END, CASE WHEN NOT zone THEN '📈 Risk score: ' || printf('%.2f', risk_score) END, "
    "CASE WHEN zone THEN '🔥 Fires: 6 (>5 / ' || d || ' → ' || d || ')' END, '🆔 <code>' || alert_id || '</code>') AS caption, "
    "concat_ws(chr(10), CASE WHEN zone THEN '🔥 <b>Wildfire Alert: ' ELSE '🛰️ <b>Wildfire Forecast: ' END || w || '</b>', '', '📍 Grid: <code>' || grid_id || '</code>', '🧭 Location: ' || place, CASE WHEN NOT zone THEN '📅 Forecast date: ' || d END, CASE WHEN NOT zone THEN '📈 Risk score: ' || printf('%.2f', risk_score) END, "
    "CASE WHEN zone THEN '🔥 Fire count: 6 (threshold: 5)' END, CASE WHEN zone THEN '🕐 Window: ' || d || ' → ' || d END, '🆔 Alert ID: <code>' || alert_id || '</code>', '', '', 'Reply /status for the latest 5 alerts in your region, /unsubscribe to stop.', '') AS chat FROM n",
    "risk_cards": f"{ALL}, {PRED} SELECT grid_id AS \"Cell\", date AS \"Date\", CASE risk_level WHEN 2 THEN 'High' WHEN 1 THEN 'Medium' END AS \"Risk\", round(risk_score, 3) AS \"Score\" FROM pred WHERE risk_level >= 1 ORDER BY risk_level DESC, risk_score DESC, grid_id, date LIMIT 20",
    "point_weather": f"{ALL} SELECT id AS point_id, station_id, count(*) AS days, round(max(temperature_2m_max), 6) + 0.0 AS hottest FROM subscribers JOIN daily ON station_id = 1 + id % 10 GROUP BY 1, 2",
    "auc_pr": f"{PR} SELECT round(CAST(sum(p * (coalesce(tp0 / nullif(k0, 0), tp / k) + tp / k) / 2) / sum(p) AS DOUBLE), 6) AS auc_pr FROM w",
    "csv_detections": f"{duck('fires_raw')} SELECT 'VIIRS_NOAA20_NRT' AS firms_source, confidence, min(min(acq_date)) OVER () AS query_start, max(max(acq_date)) OVER () AS query_end, count(*) AS n, CAST(sum(acq_time) AS BIGINT) AS times, max(latitude) AS north FROM fires_raw GROUP BY confidence",
    "json_events": f"{duck('fires_raw')} SELECT 'VIIRS_NOAA20_NRT' AS firms_source, least(DATE '2024-01-18', min(acq_date)) AS query_start, greatest(DATE '2024-01-20', max(acq_date)) AS query_end, count(*) AS event_count, "
    "TIMESTAMP '2024-01-20 06:00:00' AS fetched_at_utc, 'scheduled_2024-01-20T06_00' AS run_id FROM fires_raw",
    "resumed_parts": f"{duck('fires_raw')} SELECT firms_source, acq_date, count(*) AS n FROM fires_raw GROUP BY 1, 2",
    "geojson_risks": f"{ALL}, {PRED} SELECT grid_id, date, round(risk_score, 6) + 0.0 AS risk_score, risk_level FROM pred",
    "new_subscribers": f"{duck('subscribers')} SELECT 'email' AS channel, s_name AS address, (SELECT max(id) FROM subscribers) + row_number() OVER (ORDER BY s_name) AS id, 'active' AS status, TIMESTAMP '2024-02-01 00:00:00' AS created_at FROM supplier",
    "order_days": "SELECT count(*) AS rows, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders",
}

#: Clusters of the last 24 hours, with three points to a core.
RECENT = DB.replace("FROM fires GROUP BY ALL", "FROM late GROUP BY ALL").replace("sum(n) >= 20", "sum(n) >= 3").replace("SELECT fires.*", "SELECT late.*").replace("FROM fires JOIN pl", "FROM late JOIN pl")
ORACLE_SQL |= {
    "recent_clusters": f"{RALL}, late AS (SELECT * FROM fires WHERE acquired_at >= (SELECT max(acquired_at) FROM fires) - INTERVAL 24 HOUR), {RECENT} "
    "SELECT cluster_id, count(*) AS point_count, round(avg(confidence_score), 6) + 0.0 AS mean_confidence_score, round(max(frp), 6) + 0.0 AS max_frp, min(acquired_at) AS start_time, max(acquired_at) AS end_time FROM db WHERE cluster_id >= 0 GROUP BY 1",
}
ORACLE_SQL["stored_day_risks"] = ORACLE_SQL["day_risks"]

#: A hull's edges have all other places on their left; its ring is walked from the least place on.
HULLS = f"""{RALL}, {DB}, s AS (SELECT DISTINCT cluster_id, longitude AS x, latitude AS y FROM db WHERE cluster_id >= 0),
g AS (SELECT cluster_id, x, y, dense_rank() OVER (PARTITION BY cluster_id ORDER BY x, y) AS n FROM s),
t AS (SELECT a.cluster_id, a.n AS a, b.n AS b, (b.x - a.x) * (p.y - a.y) - (b.y - a.y) * (p.x - a.x) AS side, p.x BETWEEN least(a.x, b.x) AND greatest(a.x, b.x) AND p.y BETWEEN least(a.y, b.y) AND greatest(a.y, b.y) AS between_
      FROM g a JOIN g b ON a.cluster_id = b.cluster_id AND a.n <> b.n JOIN g p ON p.cluster_id = a.cluster_id),
e AS (SELECT cluster_id, a, b FROM t GROUP BY ALL HAVING bool_and(side > 0 OR (side = 0 AND between_))),
walk(cluster_id, pos, step) AS (SELECT DISTINCT cluster_id, CAST(1 AS BIGINT), 1 FROM e UNION ALL SELECT e.cluster_id, e.b, step + 1 FROM walk JOIN e ON e.cluster_id = walk.cluster_id AND e.a = walk.pos WHERE e.b <> 1),
r AS (SELECT walk.cluster_id, CAST(count(*) AS INT) AS ring_size, min(x) AS min_lon, min(y) AS min_lat, max(x) AS max_lon, max(y) AS max_lat, list_concat(flatten(list([x, y] ORDER BY step)), first([x, y] ORDER BY step)) AS ring
      FROM walk JOIN g ON g.cluster_id = walk.cluster_id AND g.n = walk.pos GROUP BY walk.cluster_id HAVING count(*) > 2)
SELECT * FROM r UNION ALL SELECT cluster_id, 4, x0, y0, x1, y1, [x0, y0, x1, y0, x1, y1, x0, y1, x0, y0]
FROM (SELECT cluster_id, min(x) - 0.25 AS x0, min(y) - 0.25 AS y0, max(x) + 0.25 AS x1, max(y) + 0.25 AS y1 FROM g WHERE cluster_id NOT IN (SELECT cluster_id FROM r) GROUP BY 1)"""


def _model(name: str, k: int | None) -> str:
    """A model's row: its threshold from even events, its measures on odd ones."""
    p = "probability" if k is None else f"CAST((event_id * {k}) % 1024 AS DOUBLE) / 1024"
    area = lambda part: f"""(SELECT CAST(sum(p * (below + q / 2)) AS DOUBLE) / CAST(sum(p) * sum(q) AS DOUBLE) FROM (SELECT p, q, sum(q) OVER (ORDER BY probability) - q AS below FROM {name}_v WHERE part = {part}))"""
    precise = lambda part: f"""(SELECT CAST(sum(p * (coalesce(tp0 / nullif(k0, 0), tp / k) + tp / k) / 2) / sum(p) AS DOUBLE) FROM (SELECT p, sum(p) OVER o AS tp, sum(p + q) OVER o AS k, sum(p) OVER o - p AS tp0, sum(p + q) OVER o - p - q AS k0 FROM {name}_v WHERE part = {part} WINDOW o AS (ORDER BY probability DESC)))"""
    return f"""{name}_s AS (SELECT event_id, event_id % 2 AS part, label, {p} AS probability FROM scores),
{name}_v AS (SELECT part, probability, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM {name}_s GROUP BY 1, 2),
{name}_c AS (SELECT part, threshold, count(*) FILTER (label = 1 AND probability >= threshold) AS tp, count(*) FILTER (label = 0 AND probability >= threshold) AS fp, count(*) FILTER (label = 0 AND probability < threshold) AS tn, count(*) FILTER (label = 1 AND probability < threshold) AS fn FROM {name}_s, t GROUP BY 1, 2),
{name}_m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0) AS rc FROM {name}_c),
{name}_f AS (SELECT *, coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) AS f FROM {name}_m),
{name}_k AS (SELECT greatest(1, CAST(round_even(count(*) * 0.1, 0) AS BIGINT)) AS k, count(*) FILTER (label = 1) AS all_p FROM {name}_s WHERE part = 1),
{name}_t AS (SELECT k, all_p, count(*) FILTER (label = 1 AND n <= k) AS hits FROM (SELECT label, row_number() OVER (ORDER BY probability DESC, event_id) AS n FROM {name}_s WHERE part = 1), {name}_k GROUP BY 1, 2),
{name}_r AS (SELECT '{name}' AS model, {area(0)} AS validation_auc_roc, {precise(0)} AS validation_auc_pr, {area(1)} AS auc_roc, {precise(1)} AS auc_pr, pr AS "precision", rc AS recall, f AS f1, (tp + tn) / (tp + tn + fp + fn) AS accuracy,
  coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, hits / k AS precision_at_k, coalesce(hits / nullif(all_p, 0), 0) AS recall_at_k, k, threshold AS optimal_threshold, tp AS true_positive, fp AS false_positive, tn AS true_negative, fn AS false_negative
  FROM {name}_f, {name}_t WHERE part = 1 AND threshold = (SELECT threshold FROM {name}_f WHERE part = 0 ORDER BY f DESC, rc DESC, fp LIMIT 1))"""


ROUNDED = ["validation_auc_roc", "validation_auc_pr", "auc_roc", "auc_pr", "precision", "recall", "f1", "accuracy", "specificity", "precision_at_k", "recall_at_k", "optimal_threshold"]
PAYLOAD = """'{"grid_id":"' || grid_id || '","date":"' || CAST(date AS STRING) || '","risk_level":' || risk_level || ',"shown":' || CASE WHEN risk_level > 0 THEN CAST(risk_level AS STRING) ELSE 'null' END || '}'"""
ORACLE_SQL |= {
    "cluster_hulls": HULLS,
    "model_comparison": f"""{SCORES}, t AS (SELECT CAST(unnest([0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8]) AS DOUBLE) AS threshold),
{_model('baseline', None)}, {_model('forest', 104729)}, {_model('boosted', 1299709)},
a AS (SELECT * FROM baseline_r UNION ALL SELECT * FROM forest_r UNION ALL SELECT * FROM boosted_r),
u AS (SELECT a.*, CASE model WHEN 'forest' THEN auc_roc - (SELECT auc_roc FROM baseline_r) WHEN 'boosted' THEN auc_roc - (SELECT auc_roc FROM forest_r) END AS up FROM a)
SELECT model, """ + ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in ROUNDED) + """, k, true_positive, false_positive, true_negative, false_negative,
  round(up, 6) + 0.0 AS uplift, up >= CASE model WHEN 'forest' THEN 0.03 ELSE 0 END AS target_met, model = (SELECT model FROM a ORDER BY validation_auc_roc DESC, model DESC LIMIT 1) AS is_best FROM u""",
    "recent_detections": f"{duck('fires_raw')} SELECT DISTINCT event_id, acquired_at FROM fires_raw WHERE acquired_at >= TIMESTAMP '2024-01-19 06:00:00'",
    "sniffed_texts": """WITH s AS (SELECT CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN '' WHEN 1 THEN ' 12 ' WHEN 2 THEN '-3.5' WHEN 3 THEN 'n/a' WHEN 4 THEN CAST(o_totalprice AS STRING) WHEN 5 THEN '007' ELSE '1e3' END AS v FROM orders),
k AS (SELECT v, CASE WHEN v = '' THEN NULL WHEN regexp_full_match(trim(v), '[+-]?[0-9]+') THEN 'int' WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN 'float' ELSE 'string' END AS kind FROM s)
SELECT kind, count(*) AS n, CAST(sum(CASE WHEN kind = 'int' THEN try_cast(v AS BIGINT) END) AS BIGINT) AS ints, max(CASE WHEN kind = 'float' THEN try_cast(v AS DOUBLE) END) AS most, min(CASE WHEN kind = 'string' THEN v END) AS least FROM k GROUP BY kind""",
    "strict_times": """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN TIMESTAMP '2024-03-01 09:30:00' WHEN 1 THEN TIMESTAMP '2024-03-01 00:07:00' WHEN 4 THEN TIMESTAMP '2024-03-01 00:00:00' END END AS at FROM orders""",
    "active_fire_kpis": f"{ALL} SELECT count(*) AS active_fires, round(avg(frp), 6) + 0.0 AS mean_frp FROM fires WHERE acq_date = DATE '2024-01-15' AND longitude BETWEEN 102 AND 110 AND latitude BETWEEN 13 AND 19 AND confidence_score >= 50",
    "anomaly_flags": f"{ALL}, h AS (SELECT grid_id, avg(fire_count) AS mean, coalesce(stddev_samp(fire_count), 0) AS std FROM features WHERE date < (SELECT max(date) FROM features) GROUP BY 1) "
    "SELECT fire_count > 0 AND fire_count > coalesce(mean, 0) + coalesce(std, 0) AS is_anomaly, count(*) AS grid_days FROM features LEFT JOIN h USING (grid_id) WHERE date = (SELECT max(date) FROM features) GROUP BY 1",
    "weather_summary": f"{ALL}, d AS (SELECT * FROM features WHERE date = DATE '2024-01-15') " + " UNION ALL ".join(f"SELECT '{c}' AS measure, round(avg({c}), 6) + 0.0 AS mean FROM d" for c in ("temperature_2m_max", "relative_humidity_2m_min", "wind_speed_10m_max", "precipitation_sum")),
    "served_count": f"{ALL}, {PRED} SELECT count(*) AS cached_predictions FROM pred",
    "dates_known": f"{ALL}, {PRED} SELECT date FROM pred UNION SELECT acq_date FROM fires",
    "listed_alerts": f"{ALL}, {PRED} SELECT grid_id, date, latitude, longitude, round(risk_score, 6) + 0.0 AS risk_score, risk_level FROM pred p WHERE risk_level >= 1 AND date IN (DATE '2024-01-03', DATE '2024-01-15') ORDER BY p.risk_level DESC, p.risk_score DESC, grid_id, date LIMIT 20",
    "prediction_payloads": f"{ALL}, {PRED} SELECT grid_id, date, CAST(length({PAYLOAD}) AS INT) AS size, risk_level, CASE WHEN risk_level > 0 THEN CAST(risk_level AS STRING) END AS shown FROM pred",
    "prediction_upsert": f"{ALL}, {PRED} SELECT grid_id, date, round(CASE WHEN date >= DATE '2024-01-15' THEN risk_score / 2 ELSE risk_score END, 6) + 0.0 AS risk_score, CASE WHEN date >= DATE '2024-01-15' THEN 0 ELSE risk_level END AS risk_level FROM pred",
    "stored_profile": f"{ALL} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", count(*) FILTER ({c} IS NULL) AS nulls, round(min({c}), 6) + 0.0 AS low, round(max({c}), 6) + 0.0 AS high, round(avg({c}), 6) + 0.0 AS mean FROM fires" for c in ("latitude", "frp", "confidence_score")),
    "stored_trend": ORACLE_SQL["monthly_trend"],
    "topic_sample": f"""{ALL}, {PRED}, m AS (SELECT 'alerts' AS topic, CAST(day(date) % 3 AS INT) AS "partition", row_number() OVER (PARTITION BY day(date) % 3 ORDER BY date, grid_id) AS "offset", grid_id AS key, day(date) % 2 = 0 AS alert, * FROM pred WHERE risk_level > 0)
SELECT topic, "partition", "offset", key, CASE WHEN alert THEN grid_id || '|' || CAST(date AS STRING) END AS alert_id, CASE WHEN alert THEN grid_id END AS grid_id, CAST(NULL AS BIGINT) AS fire_count, CASE WHEN alert THEN 'high' END AS severity,
  CASE WHEN NOT alert THEN CAST(date AS STRING) END AS acq_date, CAST(NULL AS STRING) AS acq_time, CASE WHEN NOT alert THEN round(latitude, 6) + 0.0 END AS latitude, CASE WHEN NOT alert THEN round(longitude, 6) + 0.0 END AS longitude, CAST(NULL AS STRING) AS confidence
FROM m ORDER BY topic, m."partition", m."offset" LIMIT 25""",
}
