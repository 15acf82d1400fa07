"""Small helpers the operators share."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.paths import remove
from trafficlake.session import scratch_dir

#: Characters that count as white space in the contracts, as a Java and Python character class.
SPACE = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"

#: A side of a join is broadcast up to this many short rows; beyond it the join is shuffled.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders written by ``staged`` within each open ``passing_tables``, the innermost last.
_passing: list[list[str]] = []


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again, so that a lost executor costs no
    second computation and everything read from it agrees. Within ``passing_tables`` it is removed at the end."""
    path = scratch_dir(df.sparkSession, label)
    if _passing:
        _passing[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Removes, at the end and also after a failure, what ``staged`` wrote meanwhile. Results that are read from
    such tables must have been written elsewhere by then."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            remove(spark, path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it what is no column of ``df``, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def small_side(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows, else unchanged."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def text_key() -> Column:
    """With doc_id, tells rows apart even where ids repeat or are missing."""
    return F.xxhash64("text")


def held_out(parts: int, part: int) -> Column:
    """crc32 of doc_id as text leaves ``part`` modulo ``parts``; a missing doc_id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(True))


def hash_order(seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def without(docs: DataFrame, dropped: DataFrame, kept: DataFrame) -> DataFrame:
    """``docs`` without the rows in ``dropped``; both lists hold (doc_id, key) as ``text_key`` gives it.

    A pair in both lists stands for rows that agree in id and text, of which one stays. All columns of
    ``docs`` are kept; none of the lists' columns are added.
    """
    key, other_id, other_key = (free_name(docs, name) for name in ("own_key", "listed_id", "listed_key"))
    keyed = docs.withColumn(key, text_key())

    def listed(df: DataFrame) -> DataFrame:
        return small_side(df.select(F.col("doc_id").alias(other_id), F.col("key").alias(other_key)).distinct())

    def joined(rows: DataFrame, df: DataFrame, how: str) -> DataFrame:
        ids = rows["doc_id"].eqNullSafe(df[other_id]) & (rows[key] == df[other_key])
        return rows.join(df, ids, how)

    both = kept.select("doc_id", "key").alias("a").join(
        dropped.select("doc_id", "key").distinct().alias("b"),
        F.expr("a.doc_id <=> b.doc_id and a.key = b.key"),
        "left_semi",
    )
    rest = joined(keyed, listed(dropped), "left_anti")
    if not both.isEmpty():
        again = joined(keyed, listed(both), "left_semi").dropDuplicates(["doc_id", key])
        rest = rest.unionByName(again)
    return rest.select(*[rest[c] for c in docs.columns])
