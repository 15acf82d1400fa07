"""Stupid-backoff scores of documents under the corpus's own n-gram counts.

Count tables are partitioned by n-gram hash, joined to the documents' n-grams and summed per document. The
rows of these tables travel packed: documents are dealt to chunks, a chunk sends each bucket of the hash
space one message with its different n-grams and their counts (sorted hashes, Golomb coded), the bucket
adds up the counts of all chunks and answers each message with the totals in the message's order, and the
answers join the chunk's documents again. An n-gram that every document has is one number a message.

Messages from every chunk to every bucket grow with the square of the input. Where they would be short, chunks
form families of about the root of their number: they send to ranges of their family, which add up first, send one
message a bucket for the whole family, and hand the answers on. Messages then grow with the power 1.5.

A document is scored by what the others hold: its own occurrences are taken off every count first.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from trafficlake.llm import golomb
from trafficlake.llm.common import small_side, staged

ORDER = 3
ALPHA = 0.4
#: The count that stands for a word no other document has.
UNSEEN = 0.5

#: Bytes of text in a chunk, and different n-grams of all chunks in a bucket, about.
CHUNK_BYTES = 6_000_000
BUCKET_BYTES = 3_500_000
#: Groups that a task reads, so that the number of tasks follows the input.
GROUPS_PER_TASK = 1
#: N-grams in a message, about; where they would be fewer, chunks send by families.
LEAST_MESSAGE = 200
#: What a row costs beside its text. Copies of one row that are more than this part of a chunk count as one row.
ROW_BYTES = 64
COPIES_PART = 8
#: Hashes have so many bits beyond those that number the n-grams: two of them collide once in 2^24 n-grams.
SPARE_BITS = 24

_ALL = np.uint64(0)  # stands for "any word"; its count is the number of words


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """The words of some texts and the hashes of their n-grams, by the place where the n-gram ends."""

    def __init__(self, texts: list[bytes | None], order: int, bits: int):
        numbers: dict[bytes, int] = {}
        words = [list(map(lambda w: numbers.setdefault(w, len(numbers)), (t or b"").lower().split())) for t in texts]
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.fromiter((i for w in words for i in w), np.int64, int(self.lengths.sum()))
        del words
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))[ids]
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.ends = [np.flatnonzero(place >= n) for n in range(order)]
        self.grams, gram = [], np.zeros(len(ids), np.uint64)
        for n in range(order):
            before = np.concatenate([gram[:1] * np.uint64(0), gram[:-1]]) if n else gram
            gram = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + hashes + np.uint64(n + 1))
            # 0 is taken.
            self.grams.append(np.maximum(gram[self.ends[n]] >> np.uint64(64 - bits), np.uint64(1)))
        self.place = place

    def counted(self, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different n-grams in order, after the number of words, if text i occurs ``copies[i]`` times."""
        joined = np.concatenate(self.grams)
        if (copies == 1).all():
            values, counts = np.unique(joined, return_counts=True)
        else:
            values, number = np.unique(joined, return_inverse=True)
            counts = np.zeros(len(values), np.int64)
            np.add.at(counts, number, copies[np.concatenate([self.doc[e] for e in self.ends])])
        words = int((self.lengths * copies).sum())
        return np.concatenate([[_ALL], values]).astype(np.uint64), np.concatenate([[words], counts]).astype(np.uint64)

    def scores(self, totals: np.ndarray, alpha: float) -> np.ndarray:
        """The sum of log scores of each text; ``totals`` are in the order of ``counted``."""
        every = int(totals[0]) - self.lengths[self.doc]
        joined = np.concatenate(self.grams)
        _, number = np.unique(joined, return_inverse=True)
        owner = np.concatenate([self.doc[e] for e in self.ends])
        _, pair, own = np.unique(owner * (len(totals) + 1) + number, return_inverse=True, return_counts=True)
        left = totals[1:].astype(np.int64)[number] - own[pair]
        counts, at = [], 0
        for ends in self.ends:
            count = np.zeros(len(self.doc), np.int64)
            count[ends] = left[at : at + len(ends)]
            counts.append(count)
            at += len(ends)
        result = np.log(np.where(counts[0] > 0, counts[0], UNSEEN) / np.maximum(every, 1))
        backed = np.minimum(self.place, len(counts) - 1)  # steps down from the longest n-gram there is
        result += backed * math.log(alpha)
        for n in range(1, len(counts)):
            # Never more often than its first words, whatever its hash may share with another n-gram.
            counts[n][1:] = np.minimum(counts[n][1:], counts[n - 1][:-1])
            seen = np.flatnonzero(counts[n] > 0)
            result[seen] = np.log(counts[n][seen] / counts[n - 1][seen - 1]) + (backed[seen] - n) * math.log(alpha)
        return np.bincount(self.doc, weights=result, minlength=len(self.lengths))


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<u8").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u8")


class Space:
    """The hash space of ``bits`` bits, in parts by its first ``width`` bits."""

    def __init__(self, bits: int, width: int):
        self.width, self.rest = width, bits - width

    def messages(self, sender: int, grams: np.ndarray, counts: np.ndarray) -> pa.Table:
        """(sender, bucket, grams, counts) for each part that has some of the sorted ``grams``."""
        buckets = (grams >> np.uint64(self.rest)).astype(np.int64)
        starts = np.flatnonzero(np.diff(buckets, prepend=-1))
        out = []
        for start, end in zip(starts, [*starts[1:], len(grams)]):
            bucket = int(buckets[start])
            out.append((sender, bucket, golomb.encode(grams[start:end], bucket << self.rest), _packed(counts[start:end])))
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], ["sender", "bucket", "grams", "counts"])

    def added(self, group: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Different n-grams of one part's messages, their sums, and for each message where its n-grams are."""
        base = group["bucket"][0].as_py() << self.rest
        lists = [golomb.decode(x, base) for x in group["grams"].to_pylist()]
        known, number = np.unique(np.concatenate(lists), return_inverse=True)
        counts = np.concatenate([_unpacked(x) for x in group["counts"].to_pylist()])
        sums = np.zeros(len(known), np.uint64)
        np.add.at(sums, number, counts)
        return known, sums, np.split(number, np.cumsum([len(x) for x in lists])[:-1])


def _answers(group: pa.Table, totals: np.ndarray, places: list[np.ndarray]) -> pa.Table:
    packed = pa.array([_packed(totals[p]) for p in places], pa.binary())
    return group.select(["sender", "bucket"]).append_column("totals", packed)


def _in_order(answers: pa.Table) -> np.ndarray:
    return np.concatenate([_unpacked(answers["totals"][int(i)].as_py()) for i in np.argsort(answers["bucket"].to_numpy())])


def _key() -> Column:
    return F.unhex(F.md5("text"))


def _repeated(rows: DataFrame) -> DataFrame:
    """(listed_id, listed_key) of rows whose copies are a large part of a chunk."""
    size = F.col("copies") * (F.col("bytes") + ROW_BYTES)
    thin = rows.groupBy("doc_id", _key().alias("key")).agg(F.count("*").alias("copies"), F.max(F.octet_length("text")).alias("bytes"))
    many = thin.where((F.col("copies") > 1) & (size > CHUNK_BYTES // COPIES_PART))
    return staged(many.select(F.col("doc_id").alias("listed_id"), F.col("key").alias("listed_key")), "lm-repeated")


def _listed(rows: DataFrame, listed: DataFrame, how: str) -> DataFrame:
    keyed = rows.withColumn("key", _key())
    return keyed.join(small_side(listed), keyed["doc_id"].eqNullSafe(listed["listed_id"]) & (keyed["key"] == listed["listed_key"]), how)


def score_documents(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_words, score (the sum
    of natural logarithms) and mean_score (null without words).

    Words are what white space (ASCII) separates, in lower case (A-Z only). The score of a word is the count
    of the longest n-gram ending there that another document has, over the count of its first words, times
    ``alpha`` for each word that the n-gram is shorter than ``order``, or than the text so far; single words
    stand over the number of words elsewhere. Every row is a document of its own, repeated rows too; where rows
    repeat so often that they would fill a chunk, they are counted as often as they occur, scored once, and
    each returned. Null and empty texts have score 0. No rows give no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    chunks = max(1, -(-total // CHUNK_BYTES))
    # Every message and every answer is a row, and words are of about six bytes, with `order` n-grams each.
    fold = max(1, total // BUCKET_BYTES).bit_length() - 1
    grams = total // 6 * order
    bits = min(64, max(32, grams.bit_length() + SPARE_BITS))
    families = LEAST_MESSAGE * chunks << fold > grams and chunks > 1
    # A range of a family holds as much as a bucket: a chunk has nearly twice as many n-grams.
    family_fold = chunks.bit_length() // 2
    space = Space(bits, fold)
    near = Space(bits, min(fold, family_fold + 1)) if families else space
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def grouped(df: DataFrame, by: str, groups: int) -> GroupedData:
        """Groups dealt evenly to tasks."""
        tasks = max(usual, -(-groups // GROUPS_PER_TASK))
        task = F.pmod(by, F.lit(tasks)).cast("int")
        return df.withColumn("task", task).repartitionById(tasks, "task").groupBy("task", by)

    repeated = _repeated(rows)
    repeats = not repeated.isEmpty()
    if repeats:
        once = _listed(rows, repeated, "left_semi").groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
        rest = _listed(rows, repeated, "left_anti").select("doc_id", "text", F.lit(1).cast("bigint").alias("copies"))
        counted = rest.unionByName(once)
    else:
        counted = rows.withColumn("copies", F.lit(1).cast("bigint"))
    dealt = counted.withColumn("sender", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def messages(group: pa.Table) -> pa.Table:
        chunk = Chunk(group["text"].cast(pa.binary()).to_pylist(), order, bits)
        return near.messages(group["sender"][0].as_py(), *chunk.counted(group["copies"].to_numpy()))

    def totals(group: pa.Table) -> pa.Table:
        _, sums, places = space.added(group)
        return _answers(group, sums, places)

    def family_messages(group: pa.Table) -> pa.Table:
        known, sums, _ = near.added(group)
        return space.messages(group["sender"][0].as_py() >> family_fold, known, sums)

    def handed_on(group: pa.Table, answers: pa.Table) -> pa.Table:
        _, _, places = near.added(group)
        return _answers(group, _in_order(answers), places)

    def scores(group: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(group["text"].cast(pa.binary()).to_pylist(), order, bits)
        copies = group["copies"].to_numpy()
        keys = [hashlib.md5(t.as_py().encode()).digest() if n > 1 else None for t, n in zip(group["text"], copies)]
        return pa.table(
            {
                "doc_id": group["doc_id"],
                "n_words": pa.array(chunk.lengths, pa.int64()),
                "score": pa.array(chunk.scores(_in_order(answers), alpha), pa.float64()),
                "key": pa.array(keys, pa.binary()),
            }
        )

    message, answer = "sender bigint, bucket bigint, grams binary, counts binary", "sender bigint, bucket bigint, totals binary"
    sent = grouped(dealt, "sender", chunks).applyInArrow(messages, message)
    if families:
        cells = ((chunks >> family_fold) + 1) << near.width
        to_family = sent.withColumn("cell", F.shiftleft(F.shiftright("sender", family_fold), near.width) + F.col("bucket"))
        sent = grouped(to_family, "cell", cells).applyInArrow(family_messages, message)
    back = grouped(sent, "bucket", 1 << fold).applyInArrow(totals, answer)
    if families:
        part = F.shiftright("bucket", fold - near.width)
        from_buckets = back.withColumn("cell", F.shiftleft("sender", near.width) + part)
        both = grouped(to_family, "cell", cells).cogroup(grouped(from_buckets, "cell", cells))
        back = both.applyInArrow(handed_on, answer)
    both = grouped(dealt, "sender", chunks).cogroup(grouped(back, "sender", chunks))
    scored = both.applyInArrow(scores, "doc_id bigint, n_words bigint, score double, key binary")
    if repeats:
        scored = staged(scored, "lm-scores")
        of_copies = scored.where("key is not null").select(
            F.col("doc_id").alias("listed_id"), F.col("key").alias("listed_key"), "n_words", "score"
        )
        copies = _listed(rows.select("doc_id", "text"), of_copies, "inner")
        scored = scored.where("key is null").drop("key").unionByName(copies.select("doc_id", "n_words", "score"))
    mean = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))
    return scored.select("doc_id", "n_words", "score", mean.alias("mean_score"))
