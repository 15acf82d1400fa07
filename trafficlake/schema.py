"""Column layouts and the fixed values every module shares."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Labels, limits and names that results and stored files carry.
# ---------------------------------------------------------------------------
# Readings may have decimals. A decimal type keeps sums exact, in whatever order rows come.
READING = T.DecimalType(18, 6)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("road_type", T.StringType()),
        T.StructField("vehicle_count", READING),
        T.StructField("average_speed", READING),
        T.StructField("occupancy_rate", READING),
        T.StructField("event", T.StringType()),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.names
READINGS = ["vehicle_count", "average_speed", "occupancy_rate"]
EVENT_KEY = ["sensor_id", "timestamp"]
EVENT_PAYLOAD = [c for c in EVENT_COLUMNS if c not in EVENT_KEY]

# Directory levels of the raw lake. Declared as strings, otherwise "01" is read back as 1.
PARTITION_KEYS = ["year", "month", "day", "zone_key"]
PARTITION_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in PARTITION_KEYS])
RAW_LAKE_SCHEMA = T.StructType(EVENT_SCHEMA.fields + PARTITION_SCHEMA.fields)

KPI_SCHEMAS = {
    "kpi_road_type": T.StructType(
        [
            T.StructField("road_type", T.StringType()),
            T.StructField("avg_speed", T.DoubleType()),
            T.StructField("total_events", T.LongType()),
        ]
    ),
    "kpi_zone": T.StructType(
        [
            T.StructField("avg_occupancy", T.DoubleType()),
            T.StructField("avg_speed", T.DoubleType()),
            T.StructField("total_events", T.LongType()),
            T.StructField("zone", T.StringType()),
        ]
    ),
    "kpi_hourly": T.StructType(
        [
            T.StructField("hour", T.IntegerType()),
            T.StructField("total_vehicles_counted", T.LongType()),
            T.StructField("avg_vehicles_per_sensor", T.DoubleType()),
        ]
    ),
    "kpi_congestion": T.StructType(
        [
            T.StructField("congestion_status", T.StringType()),
            T.StructField("count", T.LongType()),
        ]
    ),
}
KPI_NAMES = list(KPI_SCHEMAS)
# Directory levels of the KPI tables that have any.
KPI_PARTITIONING = {"kpi_zone": ["zone"]}

# Congestion label, occupancy (%) from which it applies, speed (km/h) up to which it applies.
CONGESTION_BANDS = [
    ("Bloqué", 85, 20),
    ("Dense", 70, 30),
    ("Modéré", 40, 50),
]
CONGESTION_FREE = "Fluide"
UNKNOWN_LABEL = "Inconnu"

# Readings expected by time of day (UTC): (min, max) of vehicles, speed and occupancy.
PROFILE_BOUNDS = {
    "peak": {"vehicle": (150, 350), "speed": (15, 30), "occupancy": (70, 100)},
    "normal": {"vehicle": (80, 150), "speed": (40, 60), "occupancy": (30, 70)},
    "night": {"vehicle": (10, 40), "speed": (70, 80), "occupancy": (5, 30)},
}
# Hours of each slot; every other hour, 9 and 19 included, is night.
PROFILE_HOURS = {"peak": [7, 8, 17, 18], "normal": [10, 11, 12, 13, 14, 15, 16]}

INCIDENT_TAG = "accident"
INCIDENT_OCCUPANCY = 100
INCIDENT_SPEED_DIVISOR = 4

METRICS = ["traffic.zones", "traffic.congestion", "traffic.speed", "traffic.trends"]
TOP_CONGESTED_ZONES = 5
SAMPLE_ROWS = 1000
SAMPLE_COLUMNS = [
    "sensor_id",
    "timestamp",
    "zone",
    "road_type",
    "vehicle_count",
    "average_speed",
    "occupancy_rate",
    "congestion_status",
]
RETENTION_DAYS = 7
TOPIC_NAME = "traffic-events"
BATCH_MIN_MESSAGES = 50
BATCH_MAX_DELAY = "30s"
