"""The supplied ``events`` table in the traffic schema (see FIXTURES.md)."""

from pyspark.sql import DataFrame, SparkSession

from trafficlake.schema import EVENT_SCHEMA

_TRAFFIC_COLUMNS = {
    "sensor_id": "user_id % 20 + 1",
    "timestamp": r"date_format(date_trunc('minute', ts), 'yyyy-MM-dd\'T\'HH:mm:ss.SSSSSS') || '+00:00'",
    "zone": """CASE user_id % 4 WHEN 0 THEN 'Centre-Ville' WHEN 1 THEN 'Zone-Industrielle'
                                WHEN 2 THEN 'Quartier-Résidentiel' ELSE 'Périphérie' END""",
    "road_type": """CASE event_id % 4 WHEN 0 THEN 'autoroute' WHEN 1 THEN 'avenue'
                                      WHEN 2 THEN 'rue' ELSE 'boulevard' END""",
    "vehicle_count": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE 10 + (event_id * 37) % 341 END",
    "average_speed": "(event_id * 7919) % 100 - 5",
    "occupancy_rate": """CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 100
                              ELSE (event_id * 10472 + user_id * 31) % 112 - 6 END""",
    "event": "CASE WHEN event_id % 211 = 0 THEN 'accident' END",
}

# The same events as harder input: offsets that move events across midnight, times that cannot be read, nine
# zones with spaces and a missing one, missing sensors, readings with halves.
_HARD_COLUMNS = _TRAFFIC_COLUMNS | {
    "sensor_id": "CASE WHEN event_id % 71 = 0 THEN NULL ELSE user_id % 20 + 1 END",
    "timestamp": r"""CASE WHEN event_id % 83 = 0 THEN 'noon'
        WHEN event_id % 3 = 0 THEN date_format(ts, 'yyyy-MM-dd\'T\'HH:mm:ss') || '+05:30'
        WHEN event_id % 3 = 1 THEN date_format(ts, 'yyyy-MM-dd\'T\'HH:mm:ss') || '-08:00'
        ELSE date_format(ts, 'yyyy-MM-dd\'T\'HH:mm:ss') || '+00:00' END""",
    "zone": "CASE WHEN user_id % 10 = 9 THEN NULL ELSE concat('Zone Nord ', user_id % 10) END",
    "vehicle_count": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE 10 + (event_id * 37) % 341 END",
    "average_speed": "((event_id * 7919) % 200 - 10) / 2",
    "occupancy_rate": "CASE WHEN event_id % 89 = 0 THEN NULL ELSE ((event_id * 10472 + user_id * 31) % 224 - 12) / 2 END",
}


def traffic_hard(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """All rows of ``events`` as harder traffic events."""
    return _mapped(spark.read.parquet(f"{sf_dir}/events.parquet"), _HARD_COLUMNS, extra)


def traffic_from_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """All rows of ``events`` as traffic events; ``extra`` columns of the table are added."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return _mapped(events, _TRAFFIC_COLUMNS, extra)


def _mapped(events: DataFrame, columns: dict[str, str], extra: tuple[str, ...]) -> DataFrame:
    typed = {f.name: f"CAST({columns[f.name]} AS {f.dataType.simpleString()})" for f in EVENT_SCHEMA}
    return events.selectExpr(*extra, *[f"{sql} AS `{name}`" for name, sql in typed.items()])
