from pyspark.sql import DataFrame


def write_kpi(df: DataFrame, base: str, name: str, partition_by: list[str] | None = None) -> None:
    """Replace the KPI table ``name``; ``partition_by`` columns move into directory names."""
    df.write.mode("overwrite").parquet(f"{base}/{name}", partitionBy=partition_by or [])


def write_sample(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
