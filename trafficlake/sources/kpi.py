from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from trafficlake.paths import exists, has_files
from trafficlake.schema import KPI_SCHEMAS
from trafficlake.versions import current


def read_kpi(spark: SparkSession, base: str, name: str, ignore_corrupt: bool = False) -> DataFrame:
    """A written KPI table, directory values restored as columns.

    ``ignore_corrupt`` skips unreadable files instead of failing; ``check_files`` names them. A folder that is missing, or holds no
    Parquet file, is an error: a job that wrote nothing must not look like a road without traffic. Where versions
    are published (``trafficlake.versions``), the current one is read.
    """
    base = current(spark, base)
    if exists(spark, f"{base}/{name}") and not has_files(spark, f"{base}/{name}", ".parquet"):
        raise FileNotFoundError(f"no Parquet file in {base}/{name}")
    reader = spark.read.schema(KPI_SCHEMAS[name]).option("ignoreCorruptFiles", ignore_corrupt)
    return reader.parquet(f"{base}/{name}").select(*KPI_SCHEMAS[name].names)


def check_files(spark: SparkSession, base: str, name: str) -> DataFrame:
    """(path, n_rows, error) of each Parquet file of a KPI table: the rows it holds, or why it cannot be read.

    Files are read and decoded in tasks, each as a whole; they hold aggregates, a few rows each. Files without a single
    byte are not listed: Spark's readers skip them too.
    """
    folder = f"{current(spark, base)}/{name}"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_rows_or_error(content.as_buffer()) for content in batch.column("content")]
            rows, errors = pa.array([r for r, _ in found], pa.int64()), pa.array([e for _, e in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("path"), rows, errors], ["path", "n_rows", "error"])

    return reader.load(folder).select("path", "content").mapInArrow(checked, "path string, n_rows bigint, error string")


def _rows_or_error(content: pa.Buffer) -> tuple[int | None, str | None]:
    try:
        file = pq.ParquetFile(pa.BufferReader(content))
        return sum(len(batch) for batch in file.iter_batches()), None
    except (pa.ArrowException, OSError) as error:
        return None, str(error) or type(error).__name__
