"""Packing documents into sequences by linear grouping.

Documents become token ids, longer ones are cut into pieces. Pieces are dealt to groups of about
``GROUP_PIECES`` by a hash of their place; each group is packed by one task, and the last open sequence of a group is all
that the dealing can cost. Within a group: sizes of large pieces are rounded up to the largest in their
class, classes having equally many pieces; configurations of these few sizes are chosen, each the fullest
that holds the largest size left, and used as often as the pieces allow; the actual pieces take the places
of the rounded ones; small pieces then go where they leave least room.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.common import staged
from trafficlake.llm.tokens import VOCABULARY, encode

CAPACITY = 1024
END_ID = 2
GROUP_PIECES = 1 << 17
#: Classes of large pieces in a group, so there are at most so many sizes to make configurations of. With 256 a full group
#: takes about 0.1 % more sequences than with every length its own size.
CLASSES = 256
#: Pieces up to this share of the capacity are small.
SMALL_SHARE = 1 / 8
#: Rows of an Arrow batch that are Python strings at a time.
_ROWS = 500


def _cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: the first one takes what is over."""
    first = n % capacity or capacity
    return [first] + [capacity] * ((n - first) // capacity)


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID, ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each row of ``docs`` (doc_id, text), and with ``ids``
    the ids themselves as an array. A null or empty text is the end id alone."""
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, _ROWS) for whole in batches for i in range(0, whole.num_rows, _ROWS)):
            owner, piece, start, length, crc, lists = [], [], [], [], [], []
            for doc_id, coded in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist(), vocabulary)):
                coded += end
                at = 0
                for i, n in enumerate(_cut(len(coded) // 4, capacity)):
                    part = coded[4 * at : 4 * (at + n)]
                    owner.append(doc_id)
                    piece.append(i)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if ids:
                        lists.append(np.frombuffer(part, "<u4").astype(np.int32))
                    at += n
            columns = {
                "doc_id": pa.array(owner, pa.int64()),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if ids:
                columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * ids
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, schema)


def _fullest(counts: dict[int, int], largest: int, capacity: int) -> dict[int, int]:
    """The configuration with ``largest`` that fills the capacity best with the sizes in ``counts``."""
    room = capacity - largest
    mask, steps, limit = 1, [], (1 << (room + 1)) - 1
    for size in sorted((s for s in counts if s <= room), reverse=True):
        for _ in range(min(counts[size] - (size == largest), room // size)):
            steps.append((size, mask))
            mask |= (mask << size) & limit
            if mask >> room:
                break
        if mask >> room:
            break
    fill = mask.bit_length() - 1
    used = {largest: 1}
    for size, before in reversed(steps):
        if not before >> fill & 1:
            used[size] = used.get(size, 0) + 1
            fill -= size
    return used


def plan(lengths: np.ndarray, capacity: int = CAPACITY, classes: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """For each length its sequence, from 0, and its offset there."""
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    full = np.flatnonzero(lengths >= capacity)
    sequence[full] = np.arange(len(full))
    opened = len(full)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] < capacity]
    large = order[lengths[order] > capacity * SMALL_SHARE]
    small = order[len(large) :]

    waiting: dict[int, list[int]] = {}
    step = max(1, -(-len(large) // classes))
    for i in range(0, len(large), step):
        waiting.setdefault(int(lengths[large[i]]), []).extend(large[i : i + step].tolist())
    counts = {size: len(items) for size, items in waiting.items()}
    filled: list[int] = []  # of the sequences after the full ones
    while counts:
        used = _fullest(counts, max(counts), capacity)
        times = min(counts[size] // m for size, m in used.items())
        for _ in range(times):
            at = 0
            for size, m in used.items():
                for _ in range(m):
                    item = waiting[size].pop()
                    sequence[item], offset[item] = opened + len(filled), at
                    at += int(lengths[item])
            filled.append(at)
        for size, m in used.items():
            counts[size] -= times * m
            if not counts[size]:
                del counts[size]

    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i, at in enumerate(filled):
        by_room[capacity - at].append(i)
        rooms |= 1 << (capacity - at)
    for item in small.tolist():
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            i = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            i, room = len(filled), capacity
            filled.append(0)
        sequence[item], offset[item] = opened + i, filled[i]
        filled[i] += size
        by_room[room - size].append(i)
        rooms |= 1 << (room - size)
    return sequence, offset


def pack(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID, ids: bool = False
) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset: pieces of a sequence lie one after the other from
    0, at most ``capacity`` ids in all.

    Every row is packed, repeated ones as often as they occur; null and empty texts are the end id alone, a
    null doc_id stays null. No rows give no rows. Which documents share a sequence depends on where they lie.
    """
    numbered = pieces(docs, capacity, vocabulary, end_id, ids).withColumn("row", F.monotonically_increasing_id())
    rows = staged(numbered, "pack-pieces")
    groups = -(-rows.count() // GROUP_PIECES)
    # Rows are dealt by their place in the written table, so that even identical ones spread.
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(max(1, groups)))).drop("row")

    def packed(part: pa.Table) -> pa.Table:
        keys = [part["doc_id"], part["piece"], part["ids_crc32"]]
        order = pc.sort_indices(pa.table(keys, ["a", "b", "c"]), [(x, "ascending") for x in "abc"])
        part = part.take(order)
        sequence, offset = plan(part["length"].to_numpy(), capacity)
        first = part["group"][0].as_py() << 40
        part = part.drop_columns(["group"])
        part = part.append_column("sequence_id", pa.array(sequence + first))
        return part.append_column("offset", pa.array(offset))

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" * ids + ", sequence_id bigint, offset bigint"
    return dealt.groupBy("group").applyInArrow(packed, schema)
