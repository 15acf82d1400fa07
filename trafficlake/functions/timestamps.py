"""Time expressions that do not depend on the session time zone once the text has an offset."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_timestamp(text: Column) -> Column:
    """Instant of an ISO-8601 text, NULL if it cannot be read (never an error)."""
    return F.try_to_timestamp(text)


def dated_timestamp(text: Column) -> Column:
    """``parsed_timestamp`` of texts that begin with a full date. Spark reads a time alone as one of today,
    and a year or a month as its first day; here they are NULL."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), parsed_timestamp(text))


def utc_day(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))


def utc_hour(instant: Column) -> Column:
    return F.pmod(F.floor(F.unix_seconds(instant) / 3600), F.lit(24)).cast("int")
