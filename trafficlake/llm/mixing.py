"""Mixing sources to target weights: repetition rates per source, whole copies plus one Bernoulli copy."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficlake.llm.common import SPACE, small_side, staged

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is at most so many times its size.
MOST = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size), one row per source.

    A source's target is the smaller of ``most`` times its size and level times its weight, where one
    level makes the targets add up to all sizes: this is what giving the excess of capped sources to the
    others by weight, again and again, ends at. In order of size over weight the capped sources come
    first, and the level that follows from capping the first k is largest at the right k. Sources without
    words get 0. The windows see one row per source.
    """
    ranked = Window.orderBy(F.isnull("source"), "source")
    weight = F.lit(list(weights))[(F.row_number().over(ranked) - 1) % len(weights)]
    by_need = Window.orderBy(F.col("source_size") / F.col("w"), F.isnull("source"), "source")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))
    )
    rows = sizes.withColumn("w", weight.cast("bigint")).withColumn("level", level)
    rows = rows.withColumn("level", F.max("level").over(every))
    target = F.least(F.col("level") * F.col("w"), (most * F.col("source_size")).cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return rows.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def _uniform(seed: str) -> Column:
    """A number in [0, 1) that depends on the seed and the document alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def copies(rates: DataFrame, rows: DataFrame, seed: str = SEED) -> DataFrame:
    """``rows`` (with doc_id and source) and source_size, target and copies: floor(rate), and one more with
    the fraction's probability."""
    rates = small_side(rates.withColumnRenamed("source", "rate_source"))
    rate = F.col("rate")
    more = (_uniform(seed) < rate - F.floor(rate)).cast("bigint")
    joined = rows.join(rates, rows["source"].eqNullSafe(rates["rate_source"]))
    return joined.withColumn("copies", F.floor(rate).cast("bigint") + more).drop("rate", "rate_source")


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, copies,
    taken.

    A null text has size 0; a null source is a source of its own, last in order. Rows with equal doc_id are
    drawn alike, so a repeated row is repeated as often each time. No rows give no rows.
    """
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", word_count(F.col("text")).alias("size"))
    sized = staged(sized, "mix-sizes")
    rates = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-rates")
    return copies(rates, sized, seed).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns kept."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    rates = staged(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-rates")
    wide = docs.select("doc_id", "source", F.struct(*docs.columns).alias("__row"))
    taken = copies(rates, wide, seed).where("copies > 0")
    return taken.select("__row", F.explode(F.sequence(F.lit(1), "copies"))).select("__row.*")
