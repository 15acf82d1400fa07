"""Checks of written KPI tables and retention of the raw lake."""

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trafficlake.paths import exists, overlap
from trafficlake.schema import KPI_NAMES, PARTITION_KEYS, RETENTION_DAYS
from trafficlake.sources.raw import day_folders
from trafficlake.versions import current


def _parquet_files(spark: SparkSession, folder: str) -> DataFrame | None:
    """Paths of the Parquet files at any depth; only the listing is read, no content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        return reader.option("pathGlobFilter", "*.parquet").load(folder).select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def validate_outputs(spark: SparkSession, base: str) -> DataFrame:
    """Parquet files per expected KPI folder, of the current version if versions are published; status is OK if every
    folder has some."""
    base = current(spark, base)
    expected = F.explode(F.array(*[F.lit(name) for name in KPI_NAMES]))
    counts = spark.range(1).select(expected.alias("folder"), F.lit(0).cast("bigint").alias("n_files"))
    for name in KPI_NAMES:
        files = _parquet_files(spark, f"{base}/{name}")
        if files is not None:
            counts = counts.unionByName(
                files.agg(F.count(F.lit(1)).alias("n_files")).withColumn("folder", F.lit(name))
            )
    counts = counts.groupBy("folder").agg(F.sum("n_files").alias("n_files"))
    # The window spans the few expected folders.
    fewest = F.min("n_files").over(Window.partitionBy())
    return counts.withColumn("status", F.when(fewest > 0, "OK").otherwise("PARTIAL"))


def _cutoff(as_of: datetime.date, keep_days: int) -> str:
    return (as_of - datetime.timedelta(days=keep_days)).isoformat()


def retention_split(
    df: DataFrame, as_of: datetime.date, keep_days: int = RETENTION_DAYS
) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows older than ``keep_days``, by directory keys.

    Of a lake that is read whole, files of the other side stay unopened but are listed. Rows in the
    directory for unreadable dates are kept.
    """
    day = F.concat(F.col("year"), F.lit("-"), F.col("month"), F.lit("-"), F.col("day"))
    expired = day < _cutoff(as_of, keep_days)
    return df.where(F.coalesce(~expired, F.lit(True))), df.where(expired)


def day_lines(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """``value``, each line of the lake's days ``start`` to ``end`` as it stands, and the directory keys. Only
    those days are listed, except in a stream's lake, which is read by its file log."""
    schema = f"value string, {', '.join(f'{k} string' for k in PARTITION_KEYS)}"
    reader = spark.read.format("text").schema(schema)
    if exists(spark, f"{root.rstrip('/')}/_spark_metadata"):
        day = F.concat_ws("-", "year", "month", "day")
        return reader.load(root).where(F.col("year").isNotNull() & day.between(start or "0000", end or "9999"))
    days = day_folders(spark, root, start, end)
    if not days:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", root).load(days)


def expired_lines(
    spark: SparkSession, root: str, as_of: datetime.date, keep_days: int = RETENTION_DAYS
) -> DataFrame:
    """The lines of days older than ``keep_days``."""
    last = datetime.date.fromisoformat(_cutoff(as_of, keep_days)) - datetime.timedelta(days=1)
    return day_lines(spark, root, end=last.isoformat())


def compact_days(
    spark: SparkSession, root: str, out: str, start: str | None = None, end: str | None = None, mode: str = "error"
) -> None:
    """Copy closed days of a lake, as a stream leaves them in many small files, to another root in files of the
    advisory size; lines stay as they are. The source is never deleted."""
    if overlap(spark, root, out):
        raise ValueError(f"the copy ({out}) and the lake ({root}) overlap")
    lines = day_lines(spark, root, start, end).hint("rebalance", *[F.col(k) for k in PARTITION_KEYS])
    lines.write.mode(mode).partitionBy(*PARTITION_KEYS).text(out)


def archive(
    spark: SparkSession,
    root: str,
    archive_root: str,
    as_of: datetime.date,
    keep_days: int = RETENTION_DAYS,
    mode: str = "error",
) -> str:
    """Copy the lines of expired days, in their directories, below a folder named by the date.

    Lines are copied as text, so fields the library does not know and lines it cannot read are kept as they
    are. Rows already lie by directory, so nothing is shuffled. The source is never deleted, and an archive
    that exists is not replaced unless ``mode`` says so.
    """
    path = f"{archive_root.rstrip('/')}/{as_of:%Y%m%d}"
    if overlap(spark, root, path):
        raise ValueError(f"the archive ({path}) and the lake ({root}) overlap")
    expired_lines(spark, root, as_of, keep_days).write.mode(mode).partitionBy(*PARTITION_KEYS).text(path)
    return path
