"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits link at ``DISTANCE`` = 2 or fewer differing bits. Cut into two halves, one half of
a linked pair differs by at most one bit, so with that bit left out the two halves are equal: the index
holds every half with each bit left out once, 64 variants of a fingerprint, and an equality grouping finds
the candidates. A bucket of two is verified by the distance of its pair. A bucket of more is verified
without forming pairs: two fingerprints differ by at most two bits exactly if some third word differs from
both by at most one bit, so its members are grouped by the 65 words around each. No group there has more
than 65 members, whatever the size of the bucket.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.common import small_side, staged, without
from trafficlake.llm.components import connected

WORDS = 3
SEED = 42
DISTANCE = 2


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The SimHash of a UTF-8 text: bit b is set if over half of the shingles' hashes have it."""
    # bytes.lower and bytes.split know ASCII only, which is what the contract asks for.
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(tokens) - words + 1].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())])
    octets = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(octets), 1 << 14):
        counts += np.unpackbits(octets[i : i + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(octets)).tobytes(), "big")


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        prints = [_signed(fingerprint(x.as_py())) for x in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "key", "print"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, key, print) for each row of ``docs``, over whole texts. No words give 0."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("key"), text.alias("text"))
    return rows.mapInArrow(_prints, "doc_id bigint, key bigint, print bigint")


def _variants(prints: DataFrame) -> DataFrame:
    """(variant, print): each half with each of its bits left out, marked by half and bit."""
    bit = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")
    # The half that holds the bit, without it, and the bit's number above: 38 bits.
    half = F.expr("if(bit < 32, print & 4294967295, shiftrightunsigned(print, 32))")
    variant = F.expr("(half & ~shiftleft(1L, bit % 32)) | shiftleft(cast(bit as bigint), 32)")
    return prints.select("print", bit).withColumn("half", half).select(variant.alias("variant"), "print")


def links(prints: DataFrame) -> DataFrame:
    """(a, b), enough pairs at distance two or less to join every such pair's ends, from distinct ``print``s."""
    variants = _variants(prints)
    buckets = variants.groupBy("variant").agg(
        F.count("*").alias("n"), F.min("print").alias("a"), F.max("print").alias("b")
    )
    buckets = staged(buckets.where("n > 1"), "simhash-buckets")
    pairs = buckets.where("n = 2").select("a", "b").where(F.expr(f"bit_count(a ^ b) <= {DISTANCE}"))
    crowded = small_side(buckets.where("n > 2").select("variant"))
    members = variants.join(crowded, "variant", "left_semi").select("print").distinct()
    around = F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")
    word = F.expr("if(bit < 0, print, print ^ shiftleft(1L, greatest(bit, 0)))")
    balls = staged(members, "simhash-members").select("print", around).select(word.alias("word"), "print")
    least = balls.groupBy("word").agg(F.min("print").alias("a"), F.max("print").alias("z"))
    least = least.where("a <> z").select("word", "a")
    stars = balls.join(least, "word").where("print <> a").select("a", F.col("print").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, key, fingerprint
    (16 hexadecimal digits), component_id, kept.

    Texts with equal fingerprints, and with fingerprints at most two bits apart, are linked; a component is
    everything reachable. component_id is its smallest doc_id, null if none has one. Texts without words
    (null, empty, white space) have fingerprint 0 and are linked like any other. ``kept`` marks the rows
    with the smallest (doc_id, hash of the text), missing ids last; rows that agree in both are all marked.
    """
    rows = staged(fingerprints(docs), "simhash-prints")
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key")).alias("first")
    known = staged(rows.groupBy("print").agg(first), "simhash-distinct")
    labels = connected(links(known.select("print")))
    roots = known.join(labels, known["print"] == labels["node"], "left")
    roots = roots.select("print", "first", F.coalesce("label", "print").alias("root"))
    best = roots.groupBy(F.col("root").alias("best_root")).agg(F.min("first").alias("best"))
    roots = roots.join(best, F.col("root") == F.col("best_root")).select(F.col("print").alias("known"), "best")
    out = rows.join(roots, rows["print"] == roots["known"])
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
        F.expr("best.doc_id <=> doc_id and best.key = key").alias("kept"),
        "key",
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, all columns kept."""
    rows = staged(near_duplicates(docs).select("doc_id", "key", "kept"), "simhash-decisions")
    kept = rows.where("kept")
    again = kept.groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key")
    return without(docs, rows.where("not kept").select("doc_id", "key").unionByName(again), kept)
