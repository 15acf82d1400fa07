"""From raw documents to packed training sequences: the operators of trafficlake.llm in a row."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trafficlake.llm.common import passing_tables
from trafficlake.llm.exact_dedup import drop_exact_duplicates
from trafficlake.llm.language_id import fit, keep_identified
from trafficlake.llm.mixing import mix
from trafficlake.llm.near_dedup import drop_near_duplicates
from trafficlake.llm.packing import pack
from trafficlake.paths import remove
from trafficlake.session import scratch_dir, workers_find_package


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in none of the languages, go."""
    return keep_identified(docs, fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, at their source's rate."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in training sequences."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Language identification and packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result is written; once it stands, what the stage had written on its way
    and its input go. The last stage is computed when its rows are read, so its input stays."""
    workers_find_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        with passing_tables(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(result.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
