"""SQL (DuckDB dialect) with the expected result of each query in ``queries``."""

from trafficlake.plans.queries import HARD

_RAW = """traffic_raw AS (
  SELECT event_id, user_id % 20 + 1 AS sensor_id,
         strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         CASE user_id % 4 WHEN 0 THEN 'Centre-Ville' WHEN 1 THEN 'Zone-Industrielle'
                          WHEN 2 THEN 'Quartier-Résidentiel' ELSE 'Périphérie' END AS zone,
         CASE event_id % 4 WHEN 0 THEN 'autoroute' WHEN 1 THEN 'avenue'
                           WHEN 2 THEN 'rue' ELSE 'boulevard' END AS road_type,
         CAST(CASE WHEN event_id % 97 = 0 THEN NULL ELSE 10 + (event_id * 37) % 341 END AS DOUBLE) AS vehicle_count,
         CAST((event_id * 7919) % 100 - 5 AS DOUBLE) AS average_speed,
         CAST(CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 100
              ELSE (event_id * 10472 + user_id * 31) % 112 - 6 END AS DOUBLE) AS occupancy_rate,
         CASE WHEN event_id % 211 = 0 THEN 'accident' END AS event
  FROM events)"""


_RAW_HARD = """traffic_raw AS (
  SELECT event_id, CASE WHEN event_id % 71 = 0 THEN NULL ELSE user_id % 20 + 1 END AS sensor_id,
         CASE WHEN event_id % 83 = 0 THEN 'noon'
              WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30'
              WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-08:00'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS "timestamp",
         CASE WHEN user_id % 10 = 9 THEN NULL ELSE 'Zone Nord ' || user_id % 10 END AS zone,
         CASE event_id % 4 WHEN 0 THEN 'autoroute' WHEN 1 THEN 'avenue'
                           WHEN 2 THEN 'rue' ELSE 'boulevard' END AS road_type,
         CAST(CASE WHEN event_id % 97 = 0 THEN NULL ELSE 10 + (event_id * 37) % 341 END AS DOUBLE) AS vehicle_count,
         ((event_id * 7919) % 200 - 10) / 2.0::DOUBLE AS average_speed,
         CASE WHEN event_id % 89 = 0 THEN NULL
              ELSE ((event_id * 10472 + user_id * 31) % 224 - 12) / 2.0::DOUBLE END AS occupancy_rate,
         CASE WHEN event_id % 211 = 0 THEN 'accident' END AS event
  FROM events)"""

_EVENT = 'sensor_id, "timestamp", zone, road_type, vehicle_count, average_speed, occupancy_rate, event'

_CONGESTION = """CASE WHEN occupancy_rate IS NULL OR average_speed IS NULL THEN 'Inconnu'
              WHEN occupancy_rate >= 85 OR average_speed <= 20 THEN 'Bloqué'
              WHEN occupancy_rate >= 70 OR average_speed <= 30 THEN 'Dense'
              WHEN occupancy_rate >= 40 OR average_speed <= 50 THEN 'Modéré'
              ELSE 'Fluide' END AS congestion_status"""

_INSTANT = """CAST(TRY_CAST("timestamp" AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP)"""
_PARSED = f"{_INSTANT} AS timestamp_parsed"

_DEDUP = f"""{_RAW},
kept AS (SELECT {_EVENT} FROM traffic_raw WHERE average_speed >= 0 AND occupancy_rate BETWEEN 0 AND 100),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sensor_id, "timestamp"
             ORDER BY zone NULLS FIRST, road_type NULLS FIRST, vehicle_count NULLS FIRST,
                      average_speed NULLS FIRST, occupancy_rate NULLS FIRST, event NULLS FIRST) AS rn FROM kept),
traffic_dedup AS (SELECT {_EVENT} FROM ranked WHERE rn = 1)"""

_CLEAN = f"""{_DEDUP},
traffic_clean AS (SELECT *, {_PARSED}, {_CONGESTION} FROM traffic_dedup)"""

_KPIS = f"""{_CLEAN},
kpi_road_type AS (SELECT road_type, CAST(sum(average_speed) AS DOUBLE) / count(average_speed) AS avg_speed, count(*) AS total_events
                  FROM traffic_clean GROUP BY road_type),
kpi_zone AS (SELECT zone, CAST(sum(occupancy_rate) AS DOUBLE) / count(occupancy_rate) AS avg_occupancy, CAST(sum(average_speed) AS DOUBLE) / count(average_speed) AS avg_speed,
                    count(*) AS total_events FROM traffic_clean GROUP BY zone),
kpi_hourly AS (SELECT CAST(hour(timestamp_parsed) AS INTEGER) AS hour, count(vehicle_count) AS total_vehicles_counted,
                      CAST(sum(vehicle_count) AS DOUBLE) / count(vehicle_count) AS avg_vehicles_per_sensor FROM traffic_clean GROUP BY 1),
kpi_congestion AS (SELECT congestion_status, count(*) AS count FROM traffic_clean GROUP BY 1)"""

_METRICS = f"""{_KPIS},
requested AS (SELECT * FROM (VALUES (0, 'traffic.trends'), (1, 'traffic.zones'), (2, 'traffic.none'),
                (3, 'traffic.congestion'), (4, 'traffic.speed'), (5, 'traffic.zones')) r(request_pos, target)),
points AS (
  SELECT 'traffic.zones' AS target, row_number() OVER (ORDER BY zone NULLS FIRST) - 1 AS pos,
         CAST(total_events AS DOUBLE) AS value, coalesce(zone, 'Inconnu') AS label FROM kpi_zone
  UNION ALL
  SELECT 'traffic.congestion', row_number() OVER (ORDER BY avg_occupancy DESC, zone NULLS FIRST) - 1,
         round_even(avg_occupancy, 2), coalesce(zone, 'Inconnu') FROM kpi_zone QUALIFY row_number() OVER (ORDER BY avg_occupancy DESC, zone NULLS FIRST) <= 5
  UNION ALL
  SELECT 'traffic.speed', row_number() OVER (ORDER BY avg_speed DESC, road_type) - 1,
         round_even(avg_speed, 2), road_type FROM kpi_road_type
  UNION ALL
  SELECT 'traffic.trends', row_number() OVER (ORDER BY hour NULLS FIRST) - 1,
         CAST(total_vehicles_counted AS DOUBLE), CAST(hour AS VARCHAR) FROM kpi_hourly),
series AS (SELECT CAST(request_pos AS INTEGER) AS request_pos, target, CAST(pos AS INTEGER) AS pos, value, label
           FROM requested JOIN points USING (target))"""

_PROFILE = f"""{_CLEAN},
slotted AS (SELECT *, CASE WHEN hour(timestamp_parsed) IN (7, 8, 17, 18) THEN 'peak'
                           WHEN hour(timestamp_parsed) BETWEEN 10 AND 16 THEN 'normal' ELSE 'night' END AS slot
            FROM traffic_clean),
bounds AS (SELECT slot, CAST(v0 AS BIGINT) AS vehicle_min, CAST(v1 AS BIGINT) AS vehicle_max,
                  CAST(s0 AS BIGINT) AS speed_min, CAST(s1 AS BIGINT) AS speed_max,
                  CAST(o0 AS BIGINT) AS occupancy_min, CAST(o1 AS BIGINT) AS occupancy_max
           FROM (VALUES ('peak', 150, 350, 15, 30, 70, 100), ('normal', 80, 150, 40, 60, 30, 70),
                        ('night', 10, 40, 70, 80, 5, 30)) b(slot, v0, v1, s0, s1, o0, o1)),
profiled AS (SELECT * FROM slotted JOIN bounds USING (slot))"""

# Numbers of broken messages; the rest carry the event.
_BROKEN = """CASE event_id % 50
    WHEN 0 THEN '{"sensor_id":' || event_id
    WHEN 10 THEN '{"sensor_id":' || event_id || ',"vehicle_count":"x"}'
    WHEN 20 THEN '{"sensor_id":' || event_id || ',"zone":"Centre-Ville"}'
    WHEN 30 THEN '{"timestamp":"day ' || event_id || '","zone":"Centre-Ville"}'
    WHEN 40 THEN '{"timestamp":"2024-01-01T00:00:00+00:00","sensor_id":' || event_id || '}' END"""

_KEYS = f"""strftime({_INSTANT}, '%Y') AS year, strftime({_INSTANT}, '%m') AS month,
         strftime({_INSTANT}, '%d') AS day, replace(zone, ' ', '_') AS zone_key"""

_SAMPLE = f"""WITH {_CLEAN}
SELECT sensor_id, "timestamp", zone, road_type, vehicle_count, average_speed, occupancy_rate, congestion_status
FROM traffic_clean ORDER BY "timestamp", sensor_id LIMIT 1000"""

ORACLES = {
    "clean_events": f"""WITH {_RAW}
SELECT {_EVENT} FROM traffic_raw WHERE average_speed >= 0 AND occupancy_rate BETWEEN 0 AND 100""",
    "dedup_events": f"WITH {_DEDUP} SELECT * FROM traffic_dedup",
    "congestion_status": f"WITH {_RAW} SELECT {_EVENT}, {_CONGESTION} FROM traffic_raw",
    "parsed_timestamp": f'WITH {_RAW} SELECT sensor_id, "timestamp", {_PARSED} FROM traffic_raw',
    "sample_events": _SAMPLE,
    "quality_report": f"""WITH {_DEDUP}
SELECT (SELECT count(*) FROM traffic_raw) AS rows_read, CAST(0 AS BIGINT) AS rows_unreadable, (SELECT count(*) FROM kept) AS rows_in_range,
       (SELECT count(*) FROM traffic_dedup) AS rows_unique""",
    "traffic_profile": f"""WITH {_PROFILE}
SELECT *, vehicle_count BETWEEN vehicle_min AND vehicle_max AND average_speed BETWEEN speed_min AND speed_max
          AND occupancy_rate BETWEEN occupancy_min AND occupancy_max AS in_profile
FROM profiled""",
    "incident_flag": f"""WITH {_PROFILE}
SELECT {_EVENT}, timestamp_parsed, congestion_status,
       (occupancy_rate = 100 AND average_speed <= greatest(1, speed_max // 4)) OR coalesce(event = 'accident', false)
         AS incident
FROM profiled""",
    "partition_keys": f"WITH {_RAW} SELECT {_EVENT}, {_KEYS} FROM traffic_raw",
    "kpi_road_type": f"WITH {_KPIS} SELECT * FROM kpi_road_type",
    "kpi_zone": f"WITH {_KPIS} SELECT * FROM kpi_zone",
    "kpi_hourly": f"WITH {_KPIS} SELECT * FROM kpi_hourly",
    "kpi_hourly_volume": f"""WITH {_CLEAN}
SELECT CAST(hour(timestamp_parsed) AS INTEGER) AS hour, CAST(sum(vehicle_count) AS DOUBLE) AS total_vehicles
FROM traffic_clean GROUP BY 1""",
    "kpi_congestion": f"WITH {_KPIS} SELECT * FROM kpi_congestion",
    "kpi_all": f"""WITH {_CLEAN},
timed AS (SELECT *, CAST(hour(timestamp_parsed) AS INTEGER) AS hour FROM traffic_clean)
SELECT road_type, zone, hour, congestion_status,
       CASE WHEN grouping(road_type) = 0 THEN 'kpi_road_type' WHEN grouping(zone) = 0 THEN 'kpi_zone'
            WHEN grouping(hour) = 0 THEN 'kpi_hourly' ELSE 'kpi_congestion' END AS kpi,
       CAST(sum(average_speed) AS DOUBLE) / count(average_speed) AS avg_speed, CAST(sum(occupancy_rate) AS DOUBLE) / count(occupancy_rate) AS avg_occupancy,
       CAST(sum(vehicle_count) AS DOUBLE) / count(vehicle_count) AS avg_vehicles_per_sensor, count(vehicle_count) AS total_vehicles_counted,
       count(*) AS total_events
FROM timed GROUP BY GROUPING SETS ((road_type), (zone), (hour), (congestion_status))""",
    "view_zones": f"""WITH {_KPIS}
SELECT coalesce(zone, 'Inconnu') AS zone, round_even(avg_occupancy, 2) AS avg_occupancy, round_even(avg_speed, 2) AS avg_speed, total_events
FROM kpi_zone""",
    "view_congestion_top5": f"""WITH {_KPIS}
SELECT coalesce(zone, 'Inconnu') AS zone, round_even(avg_occupancy, 2) AS avg_occupancy, round_even(avg_speed, 2) AS avg_speed, total_events
FROM (SELECT * FROM kpi_zone ORDER BY avg_occupancy DESC, zone NULLS FIRST LIMIT 5)""",
    "view_speed": f"""WITH {_KPIS}
SELECT road_type, round_even(avg_speed, 2) AS avg_speed, total_events FROM kpi_road_type""",
    "view_trends": f"""WITH {_KPIS}
SELECT hour, total_vehicles_counted AS total_vehicles,
       round_even(avg_vehicles_per_sensor, 2) AS avg_vehicles_per_sensor FROM kpi_hourly""",
    "metric_catalogue": f"""WITH {_METRICS} SELECT target, count(*) AS n_points FROM points GROUP BY target""",
    "metric_series": f"WITH {_METRICS} SELECT * FROM series",
    "metric_datapoints": f"""WITH {_METRICS}
SELECT request_pos, target, CAST(count(*) AS INTEGER) AS n_points,
       string_agg(label || '=' || CAST(CAST(value AS DECIMAL(20, 2)) AS VARCHAR), ';' ORDER BY pos) AS points
FROM series GROUP BY request_pos, target""",
    "raw_jsonl_scan": f"WITH {_RAW} SELECT {_EVENT} FROM traffic_raw",
    "raw_day_range": f"""WITH {_RAW}
SELECT {_EVENT}, {_KEYS} FROM traffic_raw WHERE substr("timestamp", 1, 10) BETWEEN '2024-01-10' AND '2024-01-16'""",
    "decode_events": f"""WITH {_RAW}
SELECT {_EVENT} FROM traffic_raw WHERE event_id % 50 NOT IN (0, 10, 20, 30, 40)
UNION ALL
SELECT event_id, NULL, 'Centre-Ville', NULL, NULL, NULL, NULL, NULL FROM traffic_raw WHERE event_id % 50 = 20
UNION ALL
SELECT NULL, 'day ' || event_id, 'Centre-Ville', NULL, NULL, NULL, NULL, NULL
FROM traffic_raw WHERE event_id % 50 = 30
UNION ALL
SELECT event_id, '2024-01-01T00:00:00+00:00', NULL, NULL, NULL, NULL, NULL, NULL
FROM traffic_raw WHERE event_id % 50 = 40""",
    "quarantine": f"""SELECT {_BROKEN} AS value,
       CASE event_id % 50 WHEN 0 THEN 'undecodable' WHEN 10 THEN 'undecodable' WHEN 20 THEN 'missing timestamp'
                          WHEN 30 THEN 'bad timestamp' ELSE 'missing zone' END AS reason
FROM events WHERE event_id % 50 IN (0, 10, 20, 30, 40)""",
    "encode_decode_roundtrip": f"WITH {_RAW} SELECT {_EVENT} FROM traffic_raw",
    "stream_ingest": f"""WITH {_RAW}
SELECT {_EVENT}, {_KEYS} FROM traffic_raw WHERE event_id % 50 NOT IN (0, 10, 20, 30, 40)""",
    "stream_dedup": f"""WITH {_RAW}
SELECT DISTINCT sensor_id, "timestamp" FROM traffic_raw WHERE event_id % 50 NOT IN (0, 10, 20, 30, 40)""",
    "kpi_road_roundtrip": f"WITH {_KPIS} SELECT * FROM kpi_road_type",
    "kpi_zone_roundtrip": f"WITH {_KPIS} SELECT * FROM kpi_zone",
    "sample_csv_roundtrip": _SAMPLE,
    "batch_job": f"""WITH {_KPIS}
SELECT 'kpi_road_type' AS kpi, road_type AS label, total_events AS n, avg_speed AS mean FROM kpi_road_type
UNION ALL SELECT 'kpi_zone', zone, total_events, avg_occupancy FROM kpi_zone
UNION ALL SELECT 'kpi_hourly', CAST(hour AS VARCHAR), total_vehicles_counted, avg_vehicles_per_sensor FROM kpi_hourly
UNION ALL SELECT 'kpi_congestion', congestion_status, count, NULL FROM kpi_congestion""",
    "validate_outputs": """SELECT folder, (SELECT count(*) FROM events) > 0 AS has_files, 'OK' AS status
FROM (VALUES ('kpi_road_type'), ('kpi_zone'), ('kpi_hourly'), ('kpi_congestion')) f(folder)""",
    "retention_expired": f"""WITH {_RAW}
SELECT {_EVENT}, {_KEYS} FROM traffic_raw WHERE substr("timestamp", 1, 10) < '2024-01-24'""",
}

ORACLES["batch_job_incremental"] = ORACLES["batch_job"]

# The harder events: the same SQL over the other mapping.
ORACLES |= {f"{name}_hard": ORACLES[name].replace(_RAW, _RAW_HARD) for name in HARD}

ORACLES |= {
    "quality_mixed": f"""WITH {_RAW_HARD},
lines AS (SELECT * FROM traffic_raw WHERE event_id % 50 NOT IN (1, 2)),
kept AS (SELECT * FROM lines WHERE average_speed >= 0 AND occupancy_rate BETWEEN 0 AND 100)
SELECT (SELECT count(*) FROM events) AS rows_read,
       (SELECT count(*) FROM events WHERE event_id % 50 = 1 OR (event_id % 50 = 2 AND user_id % 10 <> 9)) AS rows_unreadable,
       (SELECT count(*) FROM kept) + (SELECT count(*) FROM traffic_raw WHERE event_id % 50 = 2 AND zone IS NULL
          AND average_speed >= 0 AND occupancy_rate BETWEEN 0 AND 100) AS rows_in_range,
       (SELECT count(*) FROM (SELECT DISTINCT sensor_id, "timestamp" FROM (SELECT * FROM kept UNION ALL
          SELECT * FROM traffic_raw WHERE event_id % 50 = 2 AND zone IS NULL
          AND average_speed >= 0 AND occupancy_rate BETWEEN 0 AND 100))) AS rows_unique""",
    "archive_bytes": f"""WITH {_RAW}
SELECT CASE event_id % 3 WHEN 0 THEN '{{"sensor_id":' || event_id || ',"lane":3,"average_speed":40.50}}'
         WHEN 1 THEN '{{broken ' || event_id ELSE '  é ' || event_id END AS value, {_KEYS}
FROM traffic_raw WHERE substr("timestamp", 1, 10) < '2024-01-24'""",
    "stream_ingest_extra": f"""WITH {_RAW}
SELECT CAST(event_id % 50 AS BIGINT) AS lane, {_KEYS} FROM traffic_raw WHERE event_id % 10 = 0""",
    "batch_job_days": ORACLES["kpi_zone"].replace(
        "FROM events)", "FROM events WHERE CAST(ts AS DATE) BETWEEN '2024-01-10' AND '2024-01-16')"
    ),
    "incremental_quality": f"""WITH {_RAW_HARD},
lines AS (SELECT * FROM traffic_raw WHERE event_id % 50 <> 1),
kept AS (SELECT * FROM lines WHERE average_speed >= 0 AND occupancy_rate BETWEEN 0 AND 100)
SELECT (SELECT count(*) FROM events) AS rows_read, (SELECT count(*) FROM events WHERE event_id % 50 = 1) AS rows_unreadable,
       (SELECT count(*) FROM kept) AS rows_in_range,
       (SELECT count(*) FROM (SELECT DISTINCT sensor_id, "timestamp" FROM kept)) AS rows_unique""",
    "kpi_versions": f"""WITH {_KPIS},
half AS (SELECT * FROM (WITH {_KPIS.replace("FROM events)", "FROM events WHERE event_id % 2 = 0)")} SELECT * FROM kpi_zone))
SELECT *, 1 AS version FROM half UNION ALL SELECT *, 2 FROM kpi_zone""",
    "kpi_damaged_files": f"""WITH {_KPIS}
SELECT zone, CAST(1 AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_damaged FROM kpi_zone
UNION ALL SELECT 'Broken', NULL, 2""",
    "raw_extra_fields": f"""WITH {_RAW}
SELECT {_EVENT}, CAST(CASE event_id % 10 WHEN 0 THEN 2 ELSE 0 END AS INTEGER) AS n_extra,
       CASE event_id % 10 WHEN 0 THEN event_id END AS lane, CASE event_id % 10 WHEN 0 THEN 'gris' END AS sky,
       CAST(CASE event_id % 10 WHEN 0 THEN 2.5 END AS DOUBLE) AS wind FROM traffic_raw WHERE event_id % 10 NOT IN (1, 2)
UNION ALL
SELECT NULL, NULL, '7', NULL, NULL, 40.5, NULL, NULL, 1, NULL, NULL, NULL FROM traffic_raw WHERE event_id % 10 = 1
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM traffic_raw WHERE event_id % 10 = 2""",
    "stream_ingest_quarantine": f"""WITH {_RAW}
SELECT sensor_id, "timestamp", {_KEYS}, NULL::VARCHAR AS value, NULL::VARCHAR AS reason
FROM traffic_raw WHERE event_id % 50 NOT IN (0, 10, 20, 30, 40)
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, {_BROKEN},
       CASE event_id % 50 WHEN 0 THEN 'undecodable' WHEN 10 THEN 'undecodable' WHEN 20 THEN 'missing timestamp'
                          WHEN 30 THEN 'bad timestamp' ELSE 'missing zone' END
FROM events WHERE event_id % 50 IN (0, 10, 20, 30, 40)""",
    "stream_dedup_late": f"""WITH {_RAW},
keys AS (SELECT DISTINCT sensor_id, "timestamp", {_INSTANT} AS instant, CAST(substr("timestamp", 15, 2) AS INTEGER) % 7 = 0 AS held
         FROM traffic_raw)
SELECT sensor_id, "timestamp", held AND instant <= (SELECT max(instant) FROM keys WHERE NOT held) - INTERVAL 1 HOUR AS late FROM keys""",
}
