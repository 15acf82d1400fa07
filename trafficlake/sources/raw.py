import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficlake.paths import exists, folders
from trafficlake.schema import EVENT_COLUMNS, EVENT_SCHEMA, PARTITION_KEYS, RAW_LAKE_SCHEMA

_CORRUPT = "_corrupt_record"
#: Name of the lake's folder for events whose date cannot be read, and what Spark calls it.
UNDATED = "undated"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def read_raw(spark: SparkSession, *paths: str, extra: bool = False) -> DataFrame:
    """JSON Lines events at any depth below the paths; declared schema, no inference pass.

    A path may be a directory or a glob (``root/*/*/*/*/*.jsonl``; a narrower one such as
    ``root/year=2024/month=01/*`` lists less). Only payload columns come back: directory names
    are not read, so a lake with ``zone=...`` directories keeps the zone as the event spells it.

    With ``extra`` lines are parsed as VARIANT, once, and a column ``extra`` maps the names of all other fields
    to their values; ``try_variant_get(extra['lane'], '$', 'int')`` takes one. It is NULL for a line that is no JSON
    object, or has one name twice.
    """
    if extra:
        return _events_with_extra(spark, *paths)
    return _events(spark, *paths).select(*EVENT_COLUMNS)


def _events_with_extra(spark: SparkSession, *paths: str) -> DataFrame:
    reader = spark.read.option("singleVariantColumn", "message").option("recursiveFileLookup", True)
    fields = F.try_variant_get("message", "$", "map<string,variant>")
    rows = reader.json(list(paths)).select(fields.alias("fields"))
    unknown = F.map_filter("fields", lambda name, _: ~name.isin(*EVENT_COLUMNS))
    return rows.select(*[_field(f).alias(f.name) for f in EVENT_SCHEMA], unknown.alias("extra"))


def _field(field: T.StructField) -> Column:
    """A known field as the typed reader has it: text of whatever is there, numbers from numbers only, whole ones from
    whole ones."""
    found = F.col("fields").getItem(field.name)
    value = F.try_variant_get(found, "$", field.dataType.simpleString())
    if field.dataType == T.StringType():
        return value
    kinds = "^BIGINT" if field.dataType == T.LongType() else "^(BIGINT|DECIMAL|DOUBLE)"
    return F.when(F.schema_of_variant(found).rlike(kinds), value)


def read_raw_checked(spark: SparkSession, *paths: str) -> DataFrame:
    """``read_raw`` with ``unreadable``: lines that are no JSON, or have a field of another type. What can be
    read of them stays in the other columns."""
    return _events(spark, *paths).select(*EVENT_COLUMNS, _unreadable())


def _unreadable() -> Column:
    """Spark checks the types of the fields it is asked for only; the second part, never true for numbers,
    asks for all that can have a wrong one."""
    asked = [F.isnan(F.col(f.name).cast("double")) for f in EVENT_SCHEMA if f.dataType != T.StringType()]
    return (F.col(_CORRUPT).isNotNull() | F.coalesce(reduce(Column.__or__, asked), F.lit(False))).alias("unreadable")


def _events(spark: SparkSession, *paths: str) -> DataFrame:
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT)
    return reader.option("recursiveFileLookup", True).json(list(paths))


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """All events of a raw lake with its directory keys as text."""
    return spark.read.schema(RAW_LAKE_SCHEMA).json(root).select(*EVENT_COLUMNS, *PARTITION_KEYS)


def lake_days(spark: SparkSession, root: str) -> dict[str, str]:
    """The lake's days (``yyyy-MM-dd``) with their folders, found by listing folders down to the day only; the folder for
    unreadable dates goes by ``UNDATED``."""
    found = {}
    for folder in folders(spark, f"{root.rstrip('/')}/year=*/month=*/day=*"):
        day = "-".join(part.partition("=")[2] for part in folder.rstrip("/").split("/")[-3:])
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
            found[day] = folder
        elif day == "-".join([_NO_VALUE] * 3):
            found[UNDATED] = folder
    return found


def day_folders(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> list[str]:
    """Folders of the lake's days from ``start`` to ``end`` (``yyyy-MM-dd``, inclusive, NULL: open). The folder for
    unreadable dates belongs to no range."""
    days = lake_days(spark, root)
    days.pop(UNDATED, None)
    return [folder for day, folder in sorted(days.items()) if (start or day) <= day <= (end or day)]


def read_day_folders(spark: SparkSession, root: str, days: list[str]) -> DataFrame:
    """Events of some day folders, with ``unreadable`` as in ``read_raw_checked`` and the day as in ``lake_days``."""
    schema = T.StructType([*RAW_LAKE_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT).option("basePath", root)
    day = F.coalesce(F.concat("year", F.lit("-"), "month", F.lit("-"), "day"), F.lit(UNDATED))
    return reader.json(days).select(day.alias("day"), *EVENT_COLUMNS, _unreadable())


def read_raw_days(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None, checked: bool = False
) -> DataFrame:
    """Events of the days ``start`` to ``end`` (``yyyy-MM-dd``, inclusive, NULL: open) with directory keys.

    Files of other days are neither opened nor listed. A stream's lake is read by the stream's file log,
    where the condition on the keys leaves other days' files unopened. ``checked`` adds ``unreadable`` as in
    ``read_raw_checked``.
    """
    schema = T.StructType([*RAW_LAKE_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT)
    columns = [*EVENT_COLUMNS, *PARTITION_KEYS]
    columns += [_unreadable()] if checked else []
    if exists(spark, f"{root.rstrip('/')}/_spark_metadata"):
        day = F.concat_ws("-", "year", "month", "day")
        return reader.json(root).where(day.between(start or "0000", end or "9999")).select(*columns)
    days = day_folders(spark, root, start, end)
    if not days:
        return spark.createDataFrame([], schema).select(*columns)
    return reader.option("basePath", root).json(days).select(*columns)
