"""Exact deduplication by a Golomb-coded fingerprint exchange.

Every input partition (a sender) takes a 64-bit fingerprint of each normalised text, sorts them and sends
each owner - a range of the fingerprint space - one compressed message with the distinct ones. The owner
finds fingerprints that occur more than once and answers each message with a bitmap. Only the rows so
marked are suspects: their texts alone are shuffled and compared byte by byte.

A group of copies that holds a third of all rows adds one fingerprint to a sender's message, and one text
to each map task's part of the byte comparison.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm import golomb
from trafficlake.llm.common import SPACE, SPACE_BYTES, small_side, staged, without

#: Fingerprints an owner receives, about.
ROWS_PER_OWNER = 250_000
MAX_OWNERS = 1 << 14
#: Rows, about, after which a task sends what it has.
ROWS_PER_SENDER = 200_000

_MESSAGES = (
    "sender bigint, owner int, payload binary, repeated binary, "
    "doc_id array<bigint>, key array<bigint>, n_chars array<bigint>, sha array<binary>, rank array<int>"
)


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def _send(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Messages of this task, as of one sender for each ``ROWS_PER_SENDER`` rows."""
    task, part = TaskContext.get().partitionId(), 0
    ids, keys, chars, shas = [], [], [], []
    for batch in batches:
        ids += batch.column(0).to_pylist()
        chars += pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
        for at in range(len(batch)):
            octets = batch.column(1)[at].as_buffer()
            octets = None if octets is None else octets.to_pybytes()
            # Spark's xxhash64 of a null is its seed.
            keys.append(42 if octets is None else _signed(xxhash.xxh64_intdigest(octets, 42)))
            shas.append(hashlib.sha256((octets or b"").translate(None, SPACE_BYTES)).digest())
        if len(ids) >= ROWS_PER_SENDER:
            yield from _messages(task << 32 | part, ids, keys, chars, shas, bits)
            part += 1
            ids, keys, chars, shas = [], [], [], []
    if ids:
        yield from _messages(task << 32 | part, ids, keys, chars, shas, bits)


def _messages(sender: int, ids: list, keys: list, chars: list, shas: list, bits: int) -> Iterator[pa.RecordBatch]:
    prints = np.frombuffer(b"".join(s[:8] for s in shas), ">u8").astype(np.uint64)
    order = np.argsort(prints, kind="stable")
    prints = prints[order]
    owners = (prints >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(prints), np.int64)
    starts = np.flatnonzero(np.diff(owners, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(prints)]):
        owner, rows = int(owners[start]), order[start:end]
        distinct, rank, count = np.unique(prints[start:end], return_inverse=True, return_counts=True)
        yield pa.RecordBatch.from_pydict(
            {
                "sender": pa.array([sender], pa.int64()),
                "owner": pa.array([owner], pa.int32()),
                "payload": pa.array([golomb.encode(distinct, owner << (64 - bits))], pa.binary()),
                "repeated": pa.array([np.packbits(count > 1, bitorder="little").tobytes()], pa.binary()),
                "doc_id": pa.array([[ids[i] for i in rows]], pa.list_(pa.int64())),
                "key": pa.array([[keys[i] for i in rows]], pa.list_(pa.int64())),
                "n_chars": pa.array([[chars[i] for i in rows]], pa.list_(pa.int64())),
                "sha": pa.array([[shas[i] for i in rows]], pa.list_(pa.binary())),
                "rank": pa.array([rank.astype(np.int32)], pa.list_(pa.int32())),
            }
        )


def _answer(messages: pa.Table, bits: int) -> pa.Table:
    """For each message to one owner, a bitmap of the fingerprints that more than one row has."""
    owner = messages["owner"][0].as_py()
    lists = [golomb.decode(x, owner << (64 - bits)) for x in messages["payload"].to_pylist()]
    known, count = np.unique(np.concatenate(lists), return_counts=True)
    local = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(values), bitorder="little").astype(bool)
        for x, values in zip(messages["repeated"].to_pylist(), lists)
    ]
    twice = count > 1
    for values, flags in zip(lists, local):
        twice[np.searchsorted(known, values[flags])] = True
    maps = [np.packbits(twice[np.searchsorted(known, x)], bitorder="little").tobytes() for x in lists]
    return pa.table({"sender": messages["sender"], "owner": messages["owner"], "bitmap": pa.array(maps, pa.binary())})


def _marked(docs: DataFrame) -> DataFrame:
    """One short row per document, with ``suspect`` from the owners' bitmaps."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = min(MAX_OWNERS, max(16, rows.count() // ROWS_PER_OWNER)).bit_length() - 1
    messages = staged(rows.mapInArrow(partial(_send, bits=bits), _MESSAGES), "dedup-messages")

    def answer(received: pa.Table) -> pa.Table:
        return _answer(received, bits)

    coded = messages.select("sender", "owner", "payload", "repeated")
    answers = coded.groupBy("owner").applyInArrow(answer, "sender bigint, owner int, bitmap binary")
    each = messages.drop("payload", "repeated").join(answers, ["sender", "owner"])
    each = each.select("sender", "owner", "bitmap", F.posexplode(F.arrays_zip("doc_id", "key", "n_chars", "sha", "rank")))
    octet = F.expr("cast(conv(hex(substring(bitmap, col.rank div 8 + 1, 1)), 16, 10) as int)")
    thin = each.withColumn("octet", octet).select(
        "sender", "owner", "pos", "col.*", F.expr("getbit(octet, cast(col.rank % 8 as int)) = 1").alias("suspect")
    )
    return staged(thin.drop("rank"), "dedup-rows")


def _verified(docs: DataFrame, suspects: DataFrame) -> DataFrame:
    """(sha, variants): of the suspects' texts, how many different ones a digest stands for."""
    ids = small_side(suspects.select(F.col("doc_id").alias("id")).distinct())
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = rows.join(ids, rows["doc_id"].eqNullSafe(ids["id"]), "left_semi")
    norm = F.regexp_replace(F.coalesce("text", F.lit("")), f"[{SPACE}]+", "").alias("norm")
    texts = texts.select(norm).select(F.unhex(F.sha2("norm", 256)).alias("sha"), "norm")
    return texts.groupBy("sha", "norm").count().groupBy("sha").agg(F.count("*").alias("variants"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, key, keep_id,
    group_size, kept, text_sha256.

    Texts are equal when they are identical without the characters ``[\\x20\\x09-\\x0D]``; a null text
    counts as empty, and all empty texts are equal. The longest original stays, then the smallest doc_id
    (a missing one comes last), then the smallest hash of the text; of rows that agree in all of these
    exactly one. A group whose rows have no doc_id has a null keep_id. An empty table gives no rows.
    """
    thin = _marked(docs)
    suspects = thin.where("suspect")
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.isnull("doc_id").alias("none"), "doc_id", "key", "sender", "owner", "pos"))
    groups = suspects.groupBy("sha").agg(best.alias("best"), F.count("*").alias("size"))
    checked = F.when(F.col("variants") == 1, F.col("size")).otherwise(
        F.raise_error(F.lit("different texts have the same SHA-256 digest")).cast("bigint")
    )
    groups = groups.join(_verified(docs, suspects), "sha").select("sha", "best", checked.alias("size"))
    groups = groups.withColumnRenamed("sha", "group_sha")
    met = suspects.join(groups, suspects["sha"] == groups["group_sha"])
    stays = F.expr("best.sender = sender and best.owner = owner and best.pos = pos")
    found = met.select("doc_id", F.col("best.doc_id").alias("keep_id"), "size", stays.alias("kept"), "sha", "key")
    # Rows that are no suspects meet no shuffle any more.
    alone = thin.where("not suspect")
    alone = alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("size"), F.lit(True).alias("kept"), "sha", "key")
    out = alone.unionByName(found).withColumnRenamed("size", "group_size")
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"), "key")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    rows = staged(exact_duplicates(docs).select("doc_id", "key", "kept"), "dedup-decisions")
    return without(docs, rows.where("not kept"), rows.where("kept"))
