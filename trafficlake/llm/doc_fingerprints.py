"""Fingerprints of documents and of their edited texts, from prefix polynomial hashes.

Each document meets the next one in descending order of doc_id with a single shuffle of the texts: ids are
dealt to ranges, the texts sorted within, and the document at the head of each range goes to the range
before it as well. There are as many ranges as the texts' bytes ask for; an id that fills several, and the rows
without one, are dealt to them by a hash of the text, which is also their order.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.prefix_hash import PrefixHash, likeness

#: Bytes of text in a range, about, until there are ``MAX_RANGES``; each is one task's texts, read one by one.
RANGE_BYTES = 64 << 20
MAX_RANGES = 1 << 16
#: Bits of the hash that deals rows with one id to ranges.
_DEALT_BITS = 24


def _listed(values: list) -> Column:
    """A constant array, however long, from one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _range_of(bounds: list[int], nameless: int) -> Column:
    """How many of the sorted ``bounds``, one less than a power of two, are below doc_id. Rows with an id that is several
    bounds go to as many ranges, and those without one to ``nameless`` ranges below 0, in order of their tie."""
    known = _listed(bounds)
    steps = [(len(bounds) + 1) >> i for i in range(1, len(bounds).bit_length() + 1)]
    times = Counter(bounds)

    def onward(at: Column, step: Column) -> Column:
        return F.when(F.get(known, at + step - 1) < F.col("doc_id"), at + step).otherwise(at)

    def dealt(ranges: Column) -> Column:
        return F.shiftright(F.shiftright("tie", 63 - _DEALT_BITS) * ranges, _DEALT_BITS).cast("int")

    place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), onward) if bounds else F.lit(0)
    if len(times) < len(bounds):
        own = F.when(F.get(known, place) == F.col("doc_id"), F.get(_listed([times[b] for b in bounds]), place))
        place = place + dealt(F.coalesce(own, F.lit(1)))
    return F.when(F.col("doc_id").isNull(), dealt(F.lit(nameless)) - nameless).otherwise(place)


def _in_order(docs: DataFrame) -> DataFrame:
    """(place, guest, doc_id, text), partitioned by place, one a range, and sorted so that each document is followed by
    the next one; a guest is the head of the following range."""
    spark = docs.sparkSession
    rows = docs.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1))
    sizes = docs.agg(
        F.count("*").alias("rows"), F.count("doc_id").alias("named"), F.sum(F.octet_length("text")).alias("bytes")
    ).first()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MAX_RANGES, max(least, -(-(sizes["bytes"] or 0) // RANGE_BYTES)))
    ranges = 1 << max(0, wanted - 1).bit_length()
    nameless = max(1, ranges * (sizes["rows"] - sizes["named"]) // max(1, sizes["rows"]))
    bounds = []
    if ranges > 1 and sizes["named"]:
        shares = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
        bounds = list(docs.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0])
    rows = rows.withColumn("range", _range_of(bounds, nameless))
    heads = rows.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("head")).collect()  # a row for each range
    heads = sorted(heads, key=lambda r: -r["range"])
    hosts = [(r["range"], i, *r["head"], (i - 1) % len(heads)) for i, r in enumerate(heads)]
    hosts = spark.createDataFrame(hosts, "range int, place int, head bigint, head_tie bigint, host int")
    rows = rows.join(F.broadcast(hosts), "range")
    seats = F.array(F.struct("place", F.lit(False).alias("guest")))
    guests = F.array(F.struct(F.col("host").alias("place"), F.lit(True).alias("guest")))
    first = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("tie") == F.col("head_tie"))
    seats = F.when(first, F.concat(seats, guests)).otherwise(seats)
    seated = rows.select(F.explode(seats).alias("seat"), "doc_id", "tie", "text").select("seat.*", "doc_id", "tie", "text")
    dealt = seated.repartitionById(max(1, len(heads)), F.col("place"))
    ordered = dealt.sortWithinPartitions("place", "guest", F.col("doc_id").desc_nulls_last(), F.desc("tie"), "text")
    return ordered.drop("tie")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = None
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    names += ["near_edited", "near_next", "shared_edited", "shared_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]
    for batch in batches:
        out = []
        for place, guest, doc_id, value in zip(*(c.to_pylist() for c in batch.columns)):
            if guest and (before is None or before[0] != place):
                continue  # a further row with the head's doc_id and text
            hashed = PrefixHash(value)
            now = (place, doc_id, value, hashed, hashed.fingerprint())
            if before is not None and before[0] == place:
                _, own_id, text, mine, own = before
                half = len(text) // 2
                edited = text[: len(text) - half] + value[:half]
                changed = mine.edited(len(text) - half, hashed, half)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                other = changed.fingerprint()
                near = likeness(own, other), likeness(own, now[4])
                shared = mine.shared(changed), mine.shared(hashed)
                out.append((own_id, len(text), digest, own, other, *near, *shared))
            before = None if guest else now
        columns = zip(*out) if out else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, shared_edited, shared_next.

    The next document is the one with the next smaller doc_id, missing ids last, rows with equal ids in order
    of a hash of their texts, and after the last comes the first; a lone document is its own next. The edited text has
    the next text's beginning in place of its own second half. near_edited and near_next are what the document's
    fingerprint tells of its likeness to the edited and the next one's (``likeness``); shared_edited and
    shared_next are the shares of the longer text found in common in the texts themselves, by longest common
    extensions, shifted or not. A null text counts as empty. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, shared_edited double, shared_next double"
    )
    return _in_order(rows).mapInArrow(_compared, schema)
