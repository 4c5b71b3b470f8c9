"""DuckDB SQL for every registered query (the correctness oracle).

Each entry is a self-contained statement over the driver's views; shared
derivations are common table expressions assembled from the pieces below.
The SQL is an independent statement of the semantics, not generated from
the Spark plans.
"""

from __future__ import annotations

READINGS = """readings AS (
  WITH e AS (
    SELECT event_id, event_type, user_id, value,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
           (epoch_us(ts) - 1704067200000000) // 3600 AS us
    FROM events),
  t AS (
    SELECT *, make_timestamp(1704067200000000 + us) AS event_time,
           CASE event_type WHEN 'click' THEN 'imu' WHEN 'view' THEN 'gnss' WHEN 'purchase' THEN 'rain'
                WHEN 'signup' THEN 'groundwater' ELSE 'unknown' END AS sensor_type,
           'cluster_0' || CAST(user_id % 3 + 1 AS VARCHAR) AS cluster_id
    FROM e)
  SELECT event_id, us, event_time, sensor_type, cluster_id, user_id, value AS raw_value,
         sensor_type || '_01_' || cluster_id AS sensor_id,
         CASE WHEN sensor_type = 'imu' THEN value / 1000::DOUBLE END AS vx,
         CASE WHEN sensor_type = 'imu' THEN k / 1000::DOUBLE END AS vy,
         CASE WHEN sensor_type = 'imu' THEN (k - 50) / 500::DOUBLE END AS acc_x,
         CASE WHEN sensor_type = 'imu' THEN (value - 50) / 1000::DOUBLE END AS acc_y,
         CASE WHEN sensor_type = 'imu' THEN (k - 50) / 1000::DOUBLE - 9.81::DOUBLE END AS acc_z,
         CASE WHEN sensor_type = 'imu' THEN value / 200::DOUBLE END AS acc_rms,
         CASE WHEN sensor_type = 'rain' THEN value END AS intensity,
         CASE WHEN sensor_type = 'groundwater' THEN 2.4::DOUBLE + k / 500::DOUBLE END AS water_level,
         CASE WHEN sensor_type = 'groundwater' THEN 9.81::DOUBLE * (2.4::DOUBLE + k / 500::DOUBLE) + (value - 50) / 100::DOUBLE END AS pore_pressure,
         CASE WHEN sensor_type = 'gnss' THEN 21.0285::DOUBLE + (value - 50) / 10000000::DOUBLE END AS latitude,
         CASE WHEN sensor_type = 'gnss' THEN 105.8542::DOUBLE + (k - 50) / 10000000::DOUBLE END AS longitude
  FROM t)"""

# Feature rows of the monitoring job, plus a numeric (time, id) order key.
FEATURES = """features AS (
  SELECT event_id, event_time, sensor_id, cluster_id, sensor_type,
         CASE WHEN sensor_type = 'imu' THEN sqrt(vx * vx + vy * vy) END AS imu_velocity,
         acc_rms, intensity AS rain, pore_pressure AS pressure,
         round(radians(latitude) * 6378137.0, 3) AS gnss_x,
         round((radians(longitude) - radians(105.0)) * 6378137.0 * cos(radians(latitude)) + 500000.0, 3) AS gnss_y,
         epoch_us(event_time)::HUGEINT * CAST('10000000000000000000' AS HUGEINT) + event_id AS okey
  FROM readings)"""

RESAMPLED = """resampled AS (
  SELECT date_trunc('second', event_time) AS window_start,
         date_trunc('second', event_time) + INTERVAL 1 SECOND AS window_end,
         cluster_id,
         avg(imu_velocity) AS avg_velocity,
         max(acc_rms) AS max_vibration,
         arg_max(gnss_x, okey) FILTER (WHERE gnss_x IS NOT NULL) AS last_gnss_x,
         arg_max(gnss_y, okey) FILTER (WHERE gnss_y IS NOT NULL) AS last_gnss_y,
         max(rain) AS rain_intensity,
         max(pressure) AS pore_pressure,
         count(imu_velocity) > 0 AS has_imu
  FROM features GROUP BY ALL)"""

ALERTS = """alerts AS (
  SELECT *, CASE WHEN inv_velocity < 10.0::DOUBLE THEN 3
                 WHEN rain_intensity > 50.0::DOUBLE THEN 2
                 WHEN max_vibration > 0.5::DOUBLE THEN 2 ELSE 1 END AS alert_level
  FROM (SELECT *, CASE WHEN avg_velocity > 0.00001::DOUBLE THEN 1.0::DOUBLE / avg_velocity
                       ELSE 1000.0::DOUBLE END AS inv_velocity
        FROM resampled))"""


def exact_mean(v: str) -> str:
    """Half-up mean to 6 digits over DECIMAL(18,9) values, in integer arithmetic."""
    s = f"CAST(sum(CAST({v} AS DECIMAL(18,9))) * 1000000000 AS HUGEINT)"
    d = f"(count({v}) * 1000)"
    return (f"(CASE WHEN count({v}) = 0 THEN NULL WHEN {s} >= 0 THEN CAST((2 * {s} + {d}) // (2 * {d}) AS DOUBLE) / 1e6 "
            f"ELSE -CAST((2 * (-{s}) + {d}) // (2 * {d}) AS DOUBLE) / 1e6 END)")


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["alerts_by_cluster"] = with_ctes(READINGS, FEATURES, RESAMPLED, ALERTS, body="""
SELECT window_start, window_end, cluster_id,
       round(avg_velocity, 6) AS avg_velocity, max_vibration, last_gnss_x, last_gnss_y,
       rain_intensity, pore_pressure, round(inv_velocity, 4) AS inv_velocity, alert_level,
       CASE alert_level WHEN 3 THEN 'DANGER: LANDSLIDE IMMINENT'
                        WHEN 2 THEN 'WARNING: HIGH RISK CONDITIONS' ELSE 'NORMAL' END AS alert_message,
       has_imu
FROM alerts""")

ORACLE["alerts_global"] = with_ctes(READINGS, FEATURES, body="""
SELECT time,
       CASE WHEN inv < 10.0::DOUBLE THEN 'DANGER: LANDSLIDE IMMINENT'
            WHEN rain_intensity > 50.0::DOUBLE THEN 'WARNING: HEAVY RAIN' ELSE 'NORMAL' END AS alert_level,
       round(inv, 4) AS inv_velocity, round(avg_velocity, 6) AS avg_velocity, last_gnss_x, rain_intensity
FROM (SELECT *, CASE WHEN avg_velocity > 0.00001::DOUBLE THEN 1.0::DOUBLE / avg_velocity ELSE 1000.0::DOUBLE END AS inv
      FROM (SELECT date_trunc('second', event_time) AS time, avg(imu_velocity) AS avg_velocity,
                   arg_max(gnss_x, okey) FILTER (WHERE gnss_x IS NOT NULL) AS last_gnss_x,
                   max(rain) AS rain_intensity
            FROM features GROUP BY 1))""")

ORACLE["resample_hopping"] = with_ctes(READINGS, FEATURES, body="""
SELECT ws AS window_start, ws + INTERVAL 10 SECOND AS window_end, cluster_id, count(*) AS n,
       round(avg(imu_velocity), 6) AS avg_velocity, max(rain) AS rain_intensity
FROM (SELECT *, unnest([b, b - INTERVAL 5 SECOND]) AS ws
      FROM (SELECT *, make_timestamp((epoch_us(event_time) // 5000000) * 5000000) AS b FROM features))
GROUP BY ALL""")

ORACLE["env_summary_10s"] = with_ctes(READINGS, body=f"""
SELECT b AS window_start, b + INTERVAL 10 SECOND AS window_end, {exact_mean('acc_z')} AS avg_acc_z,
       max(intensity) AS max_rain, max(water_level) AS max_water_level,
       arg_max(longitude, epoch_us(event_time)::HUGEINT * CAST('10000000000000000000' AS HUGEINT) + event_id)
         FILTER (WHERE longitude IS NOT NULL) AS last_gnss
FROM (SELECT *, make_timestamp((epoch_us(event_time) // 10000000) * 10000000) AS b FROM readings)
GROUP BY 1""")

ORACLE["json_roundtrip"] = with_ctes(READINGS, FEATURES, body="""
SELECT event_id, event_time, sensor_id, cluster_id, sensor_type, imu_velocity, acc_rms, rain, pressure,
       CASE WHEN sensor_type = 'gnss' THEN gnss_x END AS gnss_x,
       CASE WHEN sensor_type = 'gnss' THEN gnss_y END AS gnss_y
FROM features""")

ORACLE["rejected_counts"] = with_ctes(READINGS, body="""
SELECT reason, count(*) AS n
FROM (SELECT CASE WHEN sensor_type <> 'unknown' THEN 'ok'
                  WHEN raw_value < 50 THEN 'missing_time'
                  WHEN raw_value < 75 THEN 'missing_type' ELSE 'unparseable' END AS reason
      FROM readings)
GROUP BY 1""")

ORACLE["cluster_from_sensor_id"] = with_ctes(READINGS, body="""
SELECT event_id, sensor_id, cluster_strict,
       coalesce(nullif(cluster_strict, ''), 'unknown') AS cluster_id
FROM (SELECT event_id, sensor_id, regexp_extract(sensor_id, '(cluster_\\d+)', 1) AS cluster_strict
      FROM (SELECT event_id,
                   CASE user_id % 4
                     WHEN 0 THEN sensor_id
                     WHEN 1 THEN sensor_type || '_' || cluster_id || '_' || lpad(CAST(user_id AS VARCHAR), 4, '0')
                     WHEN 2 THEN sensor_type || '_01_cluster_' || chr(CAST(65 + user_id % 3 AS INTEGER))
                     ELSE sensor_type || '_01_site_north' END AS sensor_id
            FROM readings))""")

ORACLE["topic_parts"] = with_ctes(READINGS, body="""
SELECT event_id, 'sensors/' || cluster_id || '/' || sensor_type AS mqtt_topic,
       cluster_id AS topic_cluster, sensor_type AS topic_type
FROM readings""")

ORACLE["speed"] = with_ctes(READINGS, body="""
SELECT event_id, sensor_id, sqrt(vx * vx + vy * vy) AS speed FROM readings WHERE sensor_type = 'imu'""")

ORACLE["rms_tilt"] = with_ctes(READINGS, body="""
SELECT event_id,
       round(sqrt((acc_x * acc_x + acc_y * acc_y + acc_z * acc_z) / 3.0::DOUBLE), 6) AS acc_rms_vector,
       round(degrees(atan2(acc_y, acc_z)), 6) AS roll,
       round(degrees(atan2(-acc_x, sqrt(acc_y * acc_y + acc_z * acc_z))), 6) AS pitch,
       acc_x - 0.0::DOUBLE AS dyn_x, acc_y - 0.0::DOUBLE AS dyn_y, acc_z - (-9.81::DOUBLE) AS dyn_z,
       round(sqrt(((acc_x - 0.0::DOUBLE) * (acc_x - 0.0::DOUBLE) + (acc_y - 0.0::DOUBLE) * (acc_y - 0.0::DOUBLE)
                   + (acc_z + 9.81::DOUBLE) * (acc_z + 9.81::DOUBLE)) / 3.0::DOUBLE), 6) AS dyn_rms
FROM readings WHERE sensor_type = 'imu'""")

ORACLE["pressure_residual"] = with_ctes(READINGS, body="""
SELECT event_id, sensor_type,
       CASE WHEN sensor_type = 'groundwater' THEN 1000.0::DOUBLE * 9.81::DOUBLE * water_level / 1000.0::DOUBLE END AS hydrostatic,
       CASE WHEN sensor_type = 'groundwater'
            THEN pore_pressure - 1000.0::DOUBLE * 9.81::DOUBLE * water_level / 1000.0::DOUBLE END AS residual,
       CASE WHEN sensor_type = 'rain' THEN greatest(0.0::DOUBLE, intensity) END AS rain_clamped
FROM readings WHERE sensor_type IN ('groundwater', 'rain')""")

ORACLE["planar_xy"] = with_ctes(READINGS, body="""
SELECT event_id, sensor_id, round(radians(latitude) * 6378137.0, 3) AS x,
       round((radians(longitude) - radians(105.0)) * 6378137.0 * cos(radians(latitude)) + 500000.0, 3) AS y
FROM readings WHERE sensor_type = 'gnss'""")

HOST_METRICS = """host_metrics AS (
  SELECT event_id AS sample_id, event_time AS ts, 'cpu_seconds_total' AS metric,
         'host_' || CAST(user_id % 5 AS VARCHAR) AS instance,
         CASE WHEN vy < 0.05 THEN 'idle' ELSE 'user' END AS mode,
         CAST(SUM(CAST(raw_value AS DECIMAL(18,2))) OVER (
           PARTITION BY user_id % 5, CASE WHEN vy < 0.05 THEN 'idle' ELSE 'user' END,
                        CAST(FLOOR(us / 120000000) AS BIGINT)
           ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value
  FROM readings WHERE sensor_type = 'imu'
  UNION ALL
  SELECT event_id, event_time, 'memory_total', 'host_' || CAST(user_id % 5 AS VARCHAR), '', CAST(1000 AS DOUBLE)
  FROM readings WHERE sensor_type = 'gnss'
  UNION ALL
  SELECT event_id, event_time, 'memory_available', 'host_' || CAST(user_id % 5 AS VARCHAR), '', raw_value
  FROM readings WHERE sensor_type = 'gnss')"""

POINTS = """points AS (
  SELECT window_start AS time, coalesce(nullif(cluster_id, ''), 'unknown') AS cluster_id,
         inv_velocity, avg_velocity, max_vibration, rain_intensity, pore_pressure,
         last_gnss_x AS gnss_x, last_gnss_y AS gnss_y, CAST(alert_level AS DOUBLE) AS alert_level
  FROM alerts)"""

_FIELDS = "inv_velocity, avg_velocity, max_vibration, rain_intensity, pore_pressure, gnss_x, gnss_y, alert_level"
LONG = f"""long AS (UNPIVOT points ON {_FIELDS} INTO NAME field VALUE value)"""
LONG_ALL = f"""long_all AS (FROM points UNPIVOT INCLUDE NULLS (value FOR field IN ({_FIELDS})))"""

PT = (READINGS, FEATURES, RESAMPLED, ALERTS, POINTS)

RAIN_DT = """rain AS (
  SELECT event_id, sensor_id, event_time, intensity,
         make_timestamp((epoch_us(event_time) // 60000000) * 60000000) AS period,
         coalesce(epoch_us(event_time) - lag(epoch_us(event_time)) OVER (PARTITION BY sensor_id ORDER BY event_time, event_id), 0) / 1e6 AS dt,
         coalesce(epoch_us(event_time) - lag(epoch_us(event_time)) OVER (
           PARTITION BY sensor_id, make_timestamp((epoch_us(event_time) // 60000000) * 60000000)
           ORDER BY event_time, event_id), 0) / 1e6 AS dt_reset
  FROM readings WHERE sensor_type = 'rain')"""

ORACLE["rain_accumulation"] = with_ctes(READINGS, RAIN_DT, body="""
SELECT event_id, sensor_id, event_time, dt,
       round(sum(intensity / 3600.0::DOUBLE * dt) OVER (PARTITION BY sensor_id ORDER BY event_time, event_id
                                                     ROWS UNBOUNDED PRECEDING), 6) AS accumulated
FROM rain""")

ORACLE["rain_accumulation_reset"] = with_ctes(READINGS, RAIN_DT, body="""
SELECT event_id, sensor_id, period, dt_reset AS dt,
       round(sum(intensity / 3600.0::DOUBLE * dt_reset) OVER (PARTITION BY sensor_id, period ORDER BY event_time, event_id
                                                           ROWS UNBOUNDED PRECEDING), 6) AS accumulated
FROM rain""")

ORACLE["integrated_motion"] = "WITH RECURSIVE " + ",\n".join([READINGS, """imu0 AS (
  SELECT event_id, sensor_id, event_time,
         acc_x - 0.0::DOUBLE AS ax, acc_y - 0.0::DOUBLE AS ay, acc_z - (-9.81::DOUBLE) AS az,
         coalesce(epoch_us(event_time) - lag(epoch_us(event_time)) OVER (PARTITION BY sensor_id ORDER BY event_time, event_id), 0) / 1e6 AS dt,
         row_number() OVER (PARTITION BY sensor_id ORDER BY event_time, event_id) AS rn
  FROM readings WHERE sensor_type = 'imu')""", """rec AS (
  SELECT sensor_id, rn, event_id, dt,
         0.95::DOUBLE * (0.0::DOUBLE + ax * dt) AS vx, 0.95::DOUBLE * (0.0::DOUBLE + ay * dt) AS vy,
         0.95::DOUBLE * (0.0::DOUBLE + az * dt) AS vz
  FROM imu0 WHERE rn = 1
  UNION ALL
  SELECT i.sensor_id, i.rn, i.event_id, i.dt,
         0.95::DOUBLE * (r.vx + i.ax * i.dt), 0.95::DOUBLE * (r.vy + i.ay * i.dt), 0.95::DOUBLE * (r.vz + i.az * i.dt)
  FROM rec r JOIN imu0 i ON i.sensor_id = r.sensor_id AND i.rn = r.rn + 1)"""]) + """
SELECT event_id, sensor_id, dt, round(vx, 6) AS vel_x, round(vy, 6) AS vel_y, round(vz, 6) AS vel_z,
       round(sum(vx * dt) OVER w, 6) AS disp_x, round(sum(vy * dt) OVER w, 6) AS disp_y,
       round(sum(vz * dt) OVER w, 6) AS disp_z
FROM rec WINDOW w AS (PARTITION BY sensor_id ORDER BY rn ROWS UNBOUNDED PRECEDING)"""

ORACLE["gnss_displacement"] = with_ctes(READINGS, """g AS (
  SELECT event_id, sensor_id, event_time,
         round(radians(latitude) * 6378137.0, 3) AS x,
         round((radians(longitude) - radians(105.0)) * 6378137.0 * cos(radians(latitude)) + 500000.0, 3) AS y,
         epoch_us(event_time)::HUGEINT * CAST('10000000000000000000' AS HUGEINT) + event_id AS okey
  FROM readings WHERE sensor_type = 'gnss')""", """b AS (
  SELECT sensor_id, arg_min(x, okey) AS x0, arg_min(y, okey) AS y0 FROM g GROUP BY 1)""", """p AS (
  SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM g
  WINDOW w AS (PARTITION BY sensor_id ORDER BY event_time, event_id))""", body="""
SELECT event_id, p.sensor_id, x, y, x - x0 AS dx, y - y0 AS dy,
       sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) AS displacement,
       sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS step
FROM p JOIN b USING (sensor_id)""")

ORACLE["gnss_forward_fill"] = with_ctes(READINGS, FEATURES, RESAMPLED, body="""
SELECT window_start, cluster_id, last_gnss_x, last_gnss_y,
       last_value(last_gnss_x IGNORE NULLS) OVER w AS last_gnss_x_filled,
       last_value(last_gnss_y IGNORE NULLS) OVER w AS last_gnss_y_filled
FROM resampled
WINDOW w AS (PARTITION BY cluster_id ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

ORACLE["time_to_failure"] = with_ctes(READINGS, FEATURES, RESAMPLED, ALERTS, """a AS (
  SELECT window_start, cluster_id, inv_velocity, (epoch_us(window_start) - 1704067200000000) / 1e6 AS x
  FROM alerts)""", """f AS (
  SELECT *, regr_slope(inv_velocity, x) OVER w AS slope, regr_avgx(inv_velocity, x) OVER w AS mx,
         regr_avgy(inv_velocity, x) OVER w AS my
  FROM a WINDOW w AS (PARTITION BY cluster_id ORDER BY window_start
                      RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW))""", body="""
SELECT window_start, cluster_id, round(inv_velocity, 4) AS inv_velocity, round(slope, 6) + 0.0::DOUBLE AS slope,
       round(CASE WHEN slope < -1e-9 THEN -(my + slope * (x - mx)) / slope END, 3) AS ttf_seconds
FROM f""")

ORACLE["points_long"] = with_ctes(*PT, LONG, body="""
SELECT time, cluster_id, field, round(value, 6) AS value FROM long""")

ORACLE["latest_alert"] = with_ctes(*PT, LONG, body="""
SELECT cluster_id, max(time) AS time, arg_max(value, time) AS value
FROM long
WHERE field = 'alert_level'
  AND time >= (SELECT max(time) FROM points) - INTERVAL 5 MINUTE AND time <= (SELECT max(time) FROM points)
GROUP BY 1""")

_DASH = "('inv_velocity', 'avg_velocity', 'rain_intensity', 'pore_pressure', 'max_vibration')"

ORACLE["agg_window_mean"] = with_ctes(*PT, LONG, body=f"""
SELECT date_trunc('second', time) + INTERVAL 1 SECOND AS time, cluster_id, field, {exact_mean('value')} AS value
FROM long WHERE field IN {_DASH} GROUP BY 1, 2, 3""")

ORACLE["agg_window_mean_10s"] = with_ctes(*PT, LONG, body=f"""
SELECT make_timestamp((epoch_us(time) // 10000000) * 10000000) + INTERVAL 10 SECOND AS time, cluster_id, field,
       {exact_mean('value')} AS value
FROM long WHERE field IN {_DASH} GROUP BY 1, 2, 3""")

ORACLE["tag_values"] = with_ctes(*PT, body="""
SELECT DISTINCT cluster_id FROM points WHERE time >= (SELECT max(time) FROM points) - INTERVAL 30 DAY""")

ORACLE["panel_stats"] = with_ctes(*PT, LONG, LONG_ALL, f"""s AS (
  SELECT cluster_id, field, (array_agg(value ORDER BY time DESC))[1] AS last,
         arg_max(value, time) FILTER (WHERE value IS NOT NULL) AS last_not_null,
         {exact_mean('value')} AS mean, min(value) AS min, max(value) AS max, count(value) AS n
  FROM long_all GROUP BY 1, 2)""", """q AS (
  SELECT *, lag(value) OVER w AS p1, lag(value, 2) OVER w AS p2,
         max(time) OVER (PARTITION BY cluster_id, field) AS t_end
  FROM long WINDOW w AS (PARTITION BY cluster_id, field ORDER BY time))""", """d AS (
  SELECT cluster_id, field,
         sum(CASE WHEN p1 IS NULL THEN 0.0::DOUBLE
                  WHEN value >= p1 THEN (CASE WHEN p2 IS NULL OR p1 >= p2 THEN value - p1 ELSE value END)
                  WHEN time = t_end THEN value ELSE 0.0::DOUBLE END) AS delta
  FROM q GROUP BY 1, 2)""", body="""
SELECT s.cluster_id, s.field, round(last, 6) AS last, round(last_not_null, 6) AS last_not_null,
       mean, round(min, 6) AS min, round(max, 6) AS max, n, round(delta, 6) AS delta
FROM s LEFT JOIN d USING (cluster_id, field)""")

ORACLE["head_per_series"] = with_ctes(*PT, LONG, body="""
SELECT time, cluster_id, field, round(value, 6) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY field, cluster_id ORDER BY time) AS rn FROM long)
WHERE rn <= 10""")

ORACLE["threshold_bands"] = with_ctes(*PT, body="""
SELECT time, cluster_id,
       CASE WHEN rain_intensity IS NULL THEN NULL WHEN rain_intensity >= 50 THEN 'red'
            WHEN rain_intensity >= 30 THEN 'yellow' ELSE 'green' END AS rain_band,
       CASE WHEN max_vibration IS NULL THEN NULL WHEN max_vibration >= 0.5 THEN 'red'
            WHEN max_vibration >= 0.3 THEN 'yellow' ELSE 'green' END AS vibration_band,
       CASE WHEN inv_velocity IS NULL THEN NULL WHEN inv_velocity >= 10 THEN 'red' ELSE 'green' END AS inv_band,
       CASE WHEN alert_level IS NULL THEN NULL WHEN alert_level >= 3 THEN 'red'
            WHEN alert_level >= 2 THEN 'yellow' ELSE 'green' END AS alert_band,
       CASE WHEN alert_level IS NULL THEN 'N/A' WHEN alert_level = 1 THEN 'NORMAL' WHEN alert_level = 2 THEN 'WARNING'
            WHEN alert_level = 3 THEN 'DANGER' ELSE CAST(CAST(alert_level AS INTEGER) AS VARCHAR) END AS alert_text
FROM points""")

RATE = """rate AS (
  SELECT sample_id, ts, metric, instance, mode,
         CASE WHEN span > 0 THEN inc / span END AS rate
  FROM (SELECT *, sum(step) OVER w - arg_min(step, okey) OVER w AS inc,
               (epoch_us(ts) - min(epoch_us(ts)) OVER w) / 1e6 AS span
        FROM (SELECT *, CASE WHEN prev IS NULL THEN 0.0::DOUBLE WHEN value < prev THEN value ELSE value - prev END AS step
              FROM (SELECT *, lag(value) OVER (PARTITION BY metric, instance, mode ORDER BY ts, sample_id) AS prev,
                           epoch_us(ts)::HUGEINT * CAST('10000000000000000000' AS HUGEINT) + sample_id AS okey
                    FROM host_metrics WHERE metric = 'cpu_seconds_total'))
        WINDOW w AS (PARTITION BY metric, instance, mode ORDER BY ts
                     RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW)))"""

ORACLE["counter_rate"] = with_ctes(READINGS, HOST_METRICS, RATE, body="""
SELECT sample_id, ts, instance, mode, round(rate, 6) AS rate FROM rate""")

ORACLE["busy_pct"] = with_ctes(READINGS, HOST_METRICS, RATE, body="""
SELECT ts, instance, round(100.0::DOUBLE - avg(rate) * 100.0::DOUBLE, 6) AS busy_pct
FROM rate WHERE mode = 'idle' GROUP BY 1, 2""")

ORACLE["series_count"] = with_ctes(READINGS, HOST_METRICS, """cpu AS (
  SELECT * FROM host_metrics WHERE metric = 'cpu_seconds_total' AND mode = 'idle')""", body="""
SELECT max(ts) AS as_of, count(*) AS n
FROM (SELECT metric, instance, mode, max(ts) AS ts FROM cpu
      WHERE ts >= (SELECT max(ts) FROM cpu) - INTERVAL 5 MINUTE GROUP BY 1, 2, 3)""")

ORACLE["instant_select"] = with_ctes(READINGS, HOST_METRICS, """mem AS (
  SELECT * FROM host_metrics WHERE metric = 'memory_total')""", body="""
SELECT metric, instance, mode, max(ts) AS ts, arg_max(value, ts) AS value
FROM mem WHERE ts >= (SELECT max(ts) FROM mem) - INTERVAL 5 MINUTE GROUP BY 1, 2, 3""")

PIVOT_MEM = """mem AS (
  SELECT ts, instance, max(CASE WHEN metric = 'memory_total' THEN value END) AS t,
         max(CASE WHEN metric = 'memory_available' THEN value END) AS a
  FROM host_metrics WHERE metric IN ('memory_total', 'memory_available') GROUP BY 1, 2)"""

ORACLE["metric_difference"] = with_ctes(READINGS, HOST_METRICS, PIVOT_MEM, body="""
SELECT ts, instance, t - a AS value FROM mem WHERE t IS NOT NULL AND a IS NOT NULL""")

ORACLE["metric_ratio"] = with_ctes(READINGS, HOST_METRICS, PIVOT_MEM, body="""
SELECT ts, instance, CASE WHEN t = 0 THEN NULL ELSE (t - a) / t END AS value
FROM mem WHERE t IS NOT NULL AND a IS NOT NULL""")

ORACLE["stream_alerts_append"] = with_ctes(READINGS, FEATURES, RESAMPLED, ALERTS, body="""
SELECT window_start, window_end, cluster_id,
       round(avg_velocity, 6) AS avg_velocity, max_vibration, last_gnss_x, last_gnss_y,
       rain_intensity, pore_pressure, round(inv_velocity, 4) AS inv_velocity, alert_level,
       CASE alert_level WHEN 3 THEN 'DANGER: LANDSLIDE IMMINENT'
                        WHEN 2 THEN 'WARNING: HIGH RISK CONDITIONS' ELSE 'NORMAL' END AS alert_message
FROM alerts
WHERE window_end <= date_trunc('millisecond', (SELECT max(event_time) FROM readings)) - INTERVAL 10 SECOND""")

ORACLE["stream_alerts_upsert"] = with_ctes(*PT, body="""
SELECT time, cluster_id, round(inv_velocity, 4) AS inv_velocity, round(avg_velocity, 6) AS avg_velocity,
       max_vibration, rain_intensity, pore_pressure, gnss_x, gnss_y, alert_level
FROM points""")

ORACLE["stream_alert_log"] = with_ctes(*PT, body="""
SELECT time, cluster_id, CAST(alert_level AS INTEGER) AS alert_level,
       CASE WHEN alert_level = 3 THEN 'DANGER: LANDSLIDE IMMINENT' ELSE 'WARNING: HIGH RISK CONDITIONS' END AS alert_message
FROM points WHERE alert_level > 1""")

ORACLE["stream_gnss_forward_fill"] = with_ctes(READINGS, FEATURES, RESAMPLED, body="""
SELECT window_start, cluster_id, last_gnss_x, last_gnss_y,
       last_value(last_gnss_x IGNORE NULLS) OVER w AS last_gnss_x_filled,
       last_value(last_gnss_y IGNORE NULLS) OVER w AS last_gnss_y_filled
FROM resampled
WHERE window_end <= date_trunc('millisecond', (SELECT max(event_time) FROM readings)) - INTERVAL 10 SECOND
WINDOW w AS (PARTITION BY cluster_id ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

ORACLE["stream_points_two_runs"] = ORACLE["stream_alerts_upsert"]

ORACLE["cluster_points"] = with_ctes(*PT, LONG, body="""
SELECT time, cluster_id, field, round(value, 6) AS value FROM long
WHERE field IN ('rain_intensity', 'pore_pressure') AND cluster_id = 'cluster_01' AND value IS NOT NULL""")

ORACLE["memory_grid"] = with_ctes(READINGS, HOST_METRICS, """mem AS (
  SELECT * FROM host_metrics WHERE metric = 'memory_available' AND mode <> 'idle')""", """grid AS (
  SELECT make_timestamp(i * 15000000) AS t FROM (
    SELECT unnest(range(CAST(floor(min(epoch_us(ts)) / 15000000.0) AS BIGINT), CAST(ceil(max(epoch_us(ts)) / 15000000.0) AS BIGINT) + 1)) AS i
    FROM mem))""", """seen AS (
  SELECT g.t, m.instance, m.value, row_number() OVER (PARTITION BY g.t, m.instance, m.mode ORDER BY m.ts DESC, m.sample_id DESC) AS rn
  FROM grid g JOIN mem m ON m.ts <= g.t AND m.ts >= g.t - INTERVAL 5 MINUTE)""", body="""
SELECT t AS ts, 'memory_available' AS metric, round(avg(value), 6) AS value FROM seen WHERE rn = 1 GROUP BY t""")


def _passed(sensor: str) -> str:
    """Rows behind the watermark (10 s below the sensor type's newest reading, whole milliseconds)."""
    return (f"event_time <= date_trunc('millisecond', (SELECT max(event_time) FROM readings WHERE sensor_type = '{sensor}'))"
            " - INTERVAL 10 SECOND")


ORACLE["stream_rain_accumulation"] = with_ctes(READINGS, RAIN_DT, body=f"""
SELECT event_id, sensor_id, event_time, dt, accumulated FROM (
  SELECT event_id, sensor_id, event_time, dt,
         round(sum(intensity / 3600.0::DOUBLE * dt) OVER (PARTITION BY sensor_id ORDER BY event_time, event_id
                                                       ROWS UNBOUNDED PRECEDING), 6) AS accumulated
  FROM rain) WHERE {_passed('rain')}""")

ORACLE["stream_integrated_motion"] = f"""SELECT m.* FROM ({ORACLE["integrated_motion"]}) m
JOIN (WITH {READINGS} SELECT event_id FROM readings WHERE {_passed('imu')}) p USING (event_id)"""

_CLOSED = "date_trunc('millisecond', (SELECT max(event_time) FROM readings)) - INTERVAL 10 SECOND"
ORACLE["stream_time_to_failure"] = f"""SELECT t.* FROM ({ORACLE["time_to_failure"]}) t
WHERE t.window_start + INTERVAL 1 SECOND <= (WITH {READINGS} SELECT {_CLOSED})"""

ORACLE["stream_quarantine"] = ORACLE["rejected_counts"]
ORACLE["stream_late_points"] = ORACLE["stream_alerts_upsert"]

_BURST = "make_timestamp(1704067500000000 + epoch_us({t}) % 1000000)"
ORACLE["trend_in_burst"] = with_ctes(READINGS, f"""b AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'cluster_01' ELSE cluster_id END AS cluster_id,
         CASE WHEN event_id % 3 = 0 THEN {_BURST.format(t='event_time')} ELSE event_time END AS t,
         1.0::DOUBLE / (sqrt(vx * vx + vy * vy) + 0.01::DOUBLE) AS y
  FROM readings WHERE sensor_type = 'imu')""", """f AS (
  SELECT event_id, cluster_id, (epoch_us(t) - 1704067200000000) / 1e6 AS x,
         regr_slope(y, (epoch_us(t) - 1704067200000000) / 1e6) OVER w AS slope,
         regr_avgx(y, (epoch_us(t) - 1704067200000000) / 1e6) OVER w AS mx, avg(y) OVER w AS my
  FROM b WINDOW w AS (PARTITION BY cluster_id ORDER BY t RANGE BETWEEN INTERVAL 60 SECOND PRECEDING AND CURRENT ROW))""", body="""
SELECT event_id, cluster_id, round(slope, 6) AS slope,
       round(CASE WHEN slope < -1e-9 THEN -(my + slope * (x - mx)) / slope END, 3) AS ttf_seconds
FROM f""")

ORACLE["rate_in_burst"] = with_ctes(READINGS, HOST_METRICS.replace("host_metrics AS", "calm AS"), f"""host_metrics AS (
  SELECT sample_id, CASE WHEN sample_id % 3 = 0 THEN {_BURST.format(t='ts')} ELSE ts END AS ts, metric, instance, mode, value
  FROM calm)""", RATE, body="""
SELECT sample_id, ts, instance, mode, round(rate, 6) AS rate FROM rate""")

ORACLE["schema_drift"] = with_ctes(READINGS, body="""
SELECT path, type, count(*) AS n, min(event_time) AS first_seen FROM (
  SELECT 'value.battery' AS path, 'OBJECT' AS type, event_time FROM readings WHERE sensor_type <> 'unknown' AND event_id % 7 = 0
  UNION ALL SELECT 'firmware', 'STRING', event_time FROM readings WHERE sensor_type <> 'unknown' AND event_id % 11 = 0
  UNION ALL SELECT 'value.intensity', 'STRING', event_time FROM readings WHERE sensor_type = 'rain' AND event_id % 13 = 0 AND intensity IS NOT NULL)
GROUP BY 1, 2""")

ORACLE["rollup_panel_stats"] = ORACLE["panel_stats"]
ORACLE["rollup_window_mean_10s"] = ORACLE["agg_window_mean_10s"]
ORACLE["stream_rollup_panels"] = ORACLE["panel_stats"]
ORACLE["stream_newest_view"] = ORACLE["latest_alert"]
ORACLE["stream_tag_view"] = ORACLE["tag_values"]

_NOISE = "CASE WHEN (us // 60000000) % 2 = 0 THEN 0.02::DOUBLE ELSE 1.0::DOUBLE END"
_MOUNT = "CASE cluster_id WHEN 'cluster_01' THEN {}::DOUBLE WHEN 'cluster_02' THEN {}::DOUBLE ELSE {}::DOUBLE END"
ORACLE["resting_vectors"] = with_ctes(READINGS, f"""mounted AS (
  SELECT us, sensor_id, us // 10000000 AS w,
         {_MOUNT.format('0.0', '0.0', '-2.5')} + {_NOISE} * acc_x AS ax, {_MOUNT.format('0.0', '1.7', '0.3')} + {_NOISE} * acc_y AS ay,
         {_MOUNT.format('-9.81', '-9.66', '-9.48')} + {_NOISE} * (acc_z + 9.81::DOUBLE) AS az
  FROM readings WHERE sensor_type = 'imu')""", """cells AS (
  SELECT sensor_id, w, count(*) AS n, max(ax) - min(ax) + (max(ay) - min(ay)) + (max(az) - min(az)) AS spread
  FROM mounted GROUP BY 1, 2 HAVING count(*) >= 5)""", """still AS (
  SELECT c.sensor_id, w, n FROM cells c JOIN (SELECT sensor_id, quantile_disc(spread, 0.25) AS q FROM cells GROUP BY 1) USING (sensor_id)
  WHERE spread <= q * 3.0::DOUBLE)""", """base AS (
  SELECT m.sensor_id, count(DISTINCT m.w) AS windows, count(*) AS n, quantile_disc(ax, 0.5) AS bx, quantile_disc(ay, 0.5) AS by_, quantile_disc(az, 0.5) AS bz
  FROM mounted m JOIN still s ON s.sensor_id = m.sensor_id AND s.w = m.w GROUP BY 1)""", body=f"""
SELECT b.sensor_id, any_value(windows) AS windows, any_value(n) AS n, any_value(round(bx, 9)) AS base_acc_x, any_value(round(by_, 9)) AS base_acc_y,
       any_value(round(bz, 9)) AS base_acc_z,
       {exact_mean('sqrt(((ax - bx) * (ax - bx) + (ay - by_) * (ay - by_) + (az - bz) * (az - bz)) / 3.0::DOUBLE)').replace("* 1000)", "* 10000)").replace("/ 1e6", "/ 1e5")} AS rest_rms
FROM base b JOIN mounted m ON m.sensor_id = b.sensor_id AND (us // 60000000) % 2 = 0 GROUP BY 1""")


def _published(x: str, digits: int) -> str:
    """A value as published: half-up over the digits it prints with."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


ORACLE["packet_rounding"] = with_ctes(READINGS, body=f"""
SELECT event_id, {_published('vx', 4)} AS vx, {_published('vy', 4)} AS vy, {_published('acc_x', 4)} AS acc_x, {_published('acc_y', 4)} AS acc_y,
       {_published('acc_z', 4)} AS acc_z, {_published('acc_rms', 4)} AS acc_rms,
       {_published('degrees(atan2(acc_y, acc_z))', 2)} AS roll, {_published('degrees(atan2(-acc_x, sqrt(acc_y * acc_y + acc_z * acc_z)))', 2)} AS pitch,
       {_published('intensity', 2)} AS intensity, {_published('water_level', 3)} AS water_level, {_published('pore_pressure', 2)} AS pore_pressure,
       {_published('latitude', 8)} AS latitude, {_published('longitude', 8)} AS longitude,
       round(radians(latitude) * 6378137.0, 3) AS x,
       round((radians(longitude) - radians(105.0)) * 6378137.0 * cos(radians(latitude)) + 500000.0, 3) AS y
FROM readings WHERE sensor_type <> 'unknown'""")

ORACLE["core_output_decimals"] = with_ctes(READINGS, FEATURES, body="""
SELECT time, CASE WHEN inv < 10.0::DOUBLE THEN 'DANGER: LANDSLIDE IMMINENT'
                  WHEN rain_intensity > 50.0::DOUBLE THEN 'WARNING: HEAVY RAIN' ELSE 'NORMAL' END AS alert_level,
       CAST(CAST(inv AS DECIMAL(10,2)) AS DOUBLE) AS inv_velocity, CAST(CAST(avg_velocity AS DECIMAL(10,5)) AS DOUBLE) AS avg_velocity,
       CAST(CAST(CAST(last_gnss_x AS DECIMAL(18,6)) AS DECIMAL(10,2)) AS DOUBLE) AS last_gnss_x, rain_intensity
FROM (SELECT *, CASE WHEN avg_velocity > 0.00001::DOUBLE THEN 1.0::DOUBLE / avg_velocity ELSE 1000.0::DOUBLE END AS inv
      FROM (SELECT date_trunc('second', event_time) AS time, avg(imu_velocity) AS avg_velocity,
                   arg_max(gnss_x, okey) FILTER (WHERE gnss_x IS NOT NULL) AS last_gnss_x, max(rain) AS rain_intensity
            FROM features GROUP BY 1))""")

ORACLE["points_zero_filled"] = with_ctes(*PT, body="""
SELECT time, cluster_id, round(inv_velocity, 4) AS inv_velocity, round(coalesce(avg_velocity, 0), 6) AS avg_velocity,
       coalesce(max_vibration, 0) AS max_vibration, coalesce(rain_intensity, 0) AS rain_intensity, coalesce(pore_pressure, 0) AS pore_pressure,
       coalesce(gnss_x, 0) AS gnss_x, coalesce(gnss_y, 0) AS gnss_y, alert_level
FROM points""")

ORACLE["stream_fill_in_order"] = ORACLE["stream_gnss_forward_fill"]

ORACLE["stream_open_windows"] = with_ctes(READINGS, FEATURES, RESAMPLED, body=f"""
SELECT window_start, cluster_id FROM resampled WHERE window_end > {_CLOSED}""")

ORACLE["stream_deduplicated"] = f"""
SELECT window_start, cluster_id, avg_velocity, max_vibration, rain_intensity, pore_pressure, alert_level FROM ({ORACLE["stream_alerts_append"]})"""

ORACLE["stream_audit"] = with_ctes(*PT, body="""
SELECT count(*) AS points, count(*) FILTER (WHERE alert_level > 1) AS alerts FROM points""")
