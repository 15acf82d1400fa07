"""Ranked lexical search: accumulators of short lists as one iterator among the long lists.

Documents are dealt to shards of about a megabyte of text, in the order they are read, and each shard's inverted
index is one row of a written table: no postings are shuffled. Sizes of the corpus and document frequencies are
sums over that table. Spark carries a row's terms and postings as packed bytes and few rows at a time; a task of a
search unpacks one row after the other, takes the postings of its own terms only, and joins those of several shards.

Within joined shards a query is answered in two steps. Short lists are added up term at a time into accumulators,
sorted by document. These then count as one list, bounded by the largest sum, beside the long lists with the
bound of each. All are read document at a time, a range of documents after the other: lists whose bounds
together stay below the k-th best score so far bring no candidates and are only looked up for candidates of the
others, largest bound first, while a candidate can still get there. A task carries its best k on from shards to
shards, and tasks send k rows a query.
"""

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlake.session import scratch_dir, session_settings

#: Bytes of text in a shard, about.
SHARD_BYTES = 1_000_000
#: Shards in a row group of the written table and in a batch that a task gets.
SHARDS_TOGETHER = 8
#: Shards are joined for a search until they have so many documents and postings of its terms.
JOINED = 1_000_000
#: Documents that Spark reads and hands to a task at once.
DOCS_TOGETHER = 256
#: A list is short if it has at most one in so many of the shard's documents.
SHORT_SHARE = 16
#: Documents looked at together.
RANGE = 1024
#: Queries are answered in blocks of about so many terms, which every task holds.
BLOCK_TERMS = 200_000
BEST = 10

# Fixed values of the score.
_WEIGHT = 1000
_SCALE = 1_000_000_000
_TF = 1000
_LENGTH = 8
_LEVEL, _SHARE = 10, 90

_INDEX = "docs array<bigint>, lengths array<bigint>, terms binary, postings binary"
_HITS = "item_id bigint, doc_id bigint, score bigint"
_NO_ID = np.iinfo(np.int64).max

#: Bytes of terms, A-Z lower-cased; all others become spaces. Every byte of a character beyond ASCII is a term's.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _words(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different terms of some texts, and for each occurrence its term's number and its text's."""
    folded = pa.array([(t or b"").translate(_FOLD) for t in texts], pa.large_binary()).cast(pa.large_string())
    lists = pc.ascii_split_whitespace(folded)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten().dictionary_encode()
    numbers, terms = words.indices.to_numpy(), words.dictionary
    empty = pc.index(terms, pa.scalar("", pa.large_string())).as_py()  # what stands before, behind and between spaces
    if empty >= 0:
        there = numbers != empty
        numbers, owner = numbers[there], owner[there]
        numbers = numbers - (numbers > empty)
        terms = pa.concat_arrays([terms.slice(0, empty), terms.slice(empty + 1)])
    return terms, numbers.astype(np.int64), owner


def _packed(columns: dict[str, pa.Array | np.ndarray]) -> pa.Array:
    """Columns as one compressed value, which is nothing but bytes to Spark."""
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return pa.array([sink.getvalue().to_pybytes()], pa.binary())


def _unpacked(value: pa.BinaryScalar) -> pa.RecordBatch:
    with pa.ipc.open_stream(value.as_buffer()) as stream:
        return stream.read_next_batch()


def _shard(ids: list[int | None], texts: list[bytes | None]) -> Iterator[pa.RecordBatch]:
    """The inverted index of some documents as one row, none if they have no term."""
    terms, numbers, owner = _words(texts)
    if not len(terms):
        return
    posting, tf = np.unique(numbers * len(texts) + owner, return_counts=True)
    term, place = np.divmod(posting, len(texts))
    columns = {
        "docs": pa.array([ids], pa.list_(pa.int64())),
        "lengths": pa.array([np.bincount(owner, minlength=len(texts))], pa.list_(pa.int64())),
        "terms": _packed({"term": terms, "df": np.bincount(term, minlength=len(terms)).astype(np.uint32)}),
        "postings": _packed({"place": place.astype(np.uint32), "tf": tf.astype(np.uint32)}),
    }
    yield pa.RecordBatch.from_pydict(columns)


def _sharded(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[pa.RecordBatch]:
    ids, texts, size = [], [], 0
    for batch in batches:
        octets = batch.column(1).cast(pa.binary())
        for i in range(len(batch)):
            text = octets[i].as_py()
            ids.append(batch.column(0)[i].as_py())
            texts.append(text)
            size += len(text or b"") + 8  # texts may be empty, ids take 8 bytes
            if size >= shard_bytes:
                yield from _shard(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield from _shard(ids, texts)


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The inverted index of every whole text of ``docs`` (doc_id, text; other columns are ignored), written below
    ``spark.checkpoint.dir``: one row a shard.

    Terms are the longest runs of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased.
    Documents without a term, null texts among them, have no postings. A text longer than a shard is a shard of
    its own. Rows that repeat, or have the same id or none, are documents of their own.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    path = scratch_dir(docs.sparkSession, "search-index")
    shards = rows.mapInArrow(lambda batches: _sharded(batches, shard_bytes), _INDEX)
    few = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(DOCS_TOGETHER),
        "spark.sql.parquet.columnarReaderBatchSize": str(DOCS_TOGETHER),
    }
    with session_settings(docs.sparkSession, few):
        shards.write.options(compression="zstd", **{"parquet.block.row.count.limit": SHARDS_TOGETHER}).parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


class _Best:
    """The k best documents of one query so far: highest score, then smallest id, those without id last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.nameless = np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """What a document must score at least to matter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        nameless = np.concatenate([self.nameless, nameless])
        order = np.lexsort((ids, nameless, -scores))[: self.k]
        order = order[scores[order] > 0]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]


class _List:
    """Postings of one term under its weight: documents in order, and what each adds to a score."""

    def __init__(self, shard: "_Shard", term: int, weight: int):
        start, end, most, shortest = (x[term : term + 1] for x in shard.lists)
        self.docs, self.tfs = shard.places[start[0] : end[0]], shard.tfs[start[0] : end[0]]
        self.weight, self.m = weight, shard.m
        self.bound = int(self._scored(most, shortest)[0])

    def _scored(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        tf = tf.astype(np.int64)
        return self.weight * (_SCALE * tf // (_TF * tf + _LENGTH * m))

    def impacts(self, at: np.ndarray | slice) -> np.ndarray:
        return self._scored(self.tfs[at], self.m[self.docs[at]])


class _Accumulators:
    """Short lists added up: a list with one entry a document, bounded by the largest sum."""

    def __init__(self, lists: list[_List]):
        docs = np.concatenate([x.docs for x in lists])
        order = np.argsort(docs, kind="stable")
        docs = docs[order]
        starts = np.flatnonzero(np.diff(docs, prepend=-1))
        self.docs = docs[starts]
        self.sums = np.add.reduceat(np.concatenate([x.impacts(slice(None)) for x in lists])[order], starts)
        self.bound = int(self.sums.max())

    def impacts(self, at: np.ndarray | slice) -> np.ndarray:
        return self.sums[at]


def _held(wanted: pa.Array, terms: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the wanted terms that a shard has, and their places among its own."""
    places = pc.index_in(wanted, value_set=terms["term"].cast(wanted.type))
    there = places.is_valid().to_numpy(zero_copy_only=False)
    return np.flatnonzero(there), places.drop_null().to_numpy().astype(np.int64)


class _Shard:
    """Documents of a shard, or of several joined, and the postings of the terms that are wanted, by term."""

    def __init__(self, batch: pa.RecordBatch, row: int, wanted: pa.Array, n_docs: int, n_terms: int):
        ids = batch["docs"][row].values
        self.nameless = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, _NO_ID).to_numpy(zero_copy_only=False)
        self.m = self._levels(batch["lengths"][row].values.to_numpy(zero_copy_only=False), n_docs, n_terms)
        terms, postings = _unpacked(batch["terms"][row]), _unpacked(batch["postings"][row])
        df = terms["df"].to_numpy().astype(np.int64)
        held, at = _held(wanted, terms)
        n = df[at]
        picked = np.repeat((np.cumsum(df) - df)[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        self.n_wanted = len(wanted)
        self.terms = np.repeat(held, n)
        self.places = postings["place"].to_numpy()[picked].astype(np.int64)
        self.tfs = postings["tf"].to_numpy()[picked]

    @classmethod
    def joined(cls, shards: list["_Shard"]) -> "_Shard":
        """The documents of shards one after the other, as one shard."""
        if len(shards) == 1:
            return shards[0]
        whole = cls.__new__(cls)
        whole.n_wanted = shards[0].n_wanted
        for name in ("nameless", "ids", "m", "terms", "tfs"):
            setattr(whole, name, np.concatenate([getattr(x, name) for x in shards]))
        first = np.cumsum([0, *(len(x.ids) for x in shards[:-1])])
        whole.places = np.concatenate([x.places + n for x, n in zip(shards, first)])
        order = np.argsort(whole.terms, kind="stable")
        whole.terms, whole.places, whole.tfs = whole.terms[order], whole.places[order], whole.tfs[order]
        return whole

    @cached_property
    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By term, where its postings start and end, the most occurrences in one document and the shortest document."""
        df = np.bincount(self.terms, minlength=self.n_wanted)
        ends = np.cumsum(df)
        starts, held = ends - df, np.flatnonzero(df)
        most, shortest = np.zeros(len(df), np.int64), np.zeros(len(df), np.int64)
        if len(held):
            most[held] = np.maximum.reduceat(self.tfs, starts[held])
            shortest[held] = np.minimum.reduceat(self.m[self.places], starts[held])
        return starts, ends, most, shortest

    @staticmethod
    def _levels(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
        """A document's length against the mean, in whole hundredths."""
        if int(lengths.max()) * _SHARE * n_docs >= 1 << 63:
            lengths = lengths.astype(object)
        return (_LEVEL + _SHARE * lengths * n_docs // n_terms).astype(np.int64)

    def answer(self, terms: list[tuple[int, int]], best: _Best) -> None:
        """Add what this shard has for a query: numbers of its terms among the wanted, with their weights."""
        starts, ends = self.lists[:2]
        lists = [_List(self, t, weight) for t, weight in terms if weight > 0 and starts[t] < ends[t]]
        if not lists:
            return
        short = [x for x in lists if len(x.docs) * SHORT_SHARE <= len(self.ids)]
        rest = [x for x in lists if len(x.docs) * SHORT_SHARE > len(self.ids)]
        floor = best.floor
        if short:
            sums = _Accumulators(short)
            floor = max(floor, self._start(sums, rest, best.k))
            rest.append(sums)
        rest.sort(key=lambda x: x.bound)
        bounds = np.cumsum([x.bound for x in rest])
        for low in range(0, len(self.ids), RANGE):
            free = int(np.searchsorted(bounds, floor))  # so many lists cannot bring a document up to the floor
            if free == len(rest):
                return
            docs, scores = self._range(rest, free, low, floor)
            if len(docs):
                best.add(scores, self.ids[docs], self.nameless[docs])
                floor = max(floor, best.floor)

    def _start(self, sums: _Accumulators, rest: list, k: int) -> int:
        """The k-th best whole score of the k documents with the largest sums: a floor to begin with."""
        if len(sums.docs) < k:
            return 1
        top = np.sort(np.argpartition(-sums.sums, k - 1)[:k])
        docs, scores = _looked_up(sums.docs[top], sums.sums[top], rest, 1)
        return max(1, int(scores.min())) if len(docs) == k else 1

    def _range(self, lists: list, free: int, low: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` on, of one range, that reach the floor, with their scores."""
        spans = []
        for x in lists[free:]:
            start, end = np.searchsorted(x.docs, (low, low + RANGE))
            if start < end:
                spans.append((x, slice(start, end)))
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs = np.unique(np.concatenate([x.docs[at] for x, at in spans]))
        scores = np.zeros(len(docs), np.int64)
        for x, at in spans:
            scores[np.searchsorted(docs, x.docs[at])] += x.impacts(at)
        return _looked_up(docs, scores, lists[:free], floor)


def _looked_up(docs: np.ndarray, scores: np.ndarray, lists: list, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores completed from lists, largest bound first; documents that cannot reach the floor go on the way."""
    open_ = sum(x.bound for x in lists)
    for x in sorted(lists, key=lambda x: -x.bound):
        able = scores + open_ >= floor
        docs, scores = docs[able], scores[able]
        if not len(docs):
            return docs, scores
        at = np.searchsorted(x.docs, docs)
        at[at == len(x.docs)] = 0
        hit = x.docs[at] == docs
        scores[hit] += x.impacts(at[hit])
        open_ -= x.bound
    able = scores >= floor
    return docs[able], scores[able]


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, terms): the different terms of each item of ``queries`` (item_id, text); rows with the same item_id
    (or none) are one item, and items without a term have no row."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, numbers, owner = _words(batch.column(1).cast(pa.binary()).to_pylist())
            owned = [batch.column(0).take(pa.array(owner)), terms.take(pa.array(numbers)).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(owned, ["item_id", "term"])

    rows = queries.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    terms = rows.mapInArrow(split, "item_id bigint, term string").distinct()
    return terms.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))


def _blocks(items: Iterator, most: int) -> Iterator[list[tuple[int | None, list[str]]]]:
    block, size = [], 0
    for row in items:
        block.append((row["item_id"], row["terms"]))
        size += len(row["terms"])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def _joined(batches: Iterator[pa.RecordBatch], wanted: pa.Array, n_docs: int, n_terms: int, most: int) -> Iterator[_Shard]:
    """A task's shards, joined until they have ``most`` documents and wanted postings."""
    shards, size = [], 0
    for batch in batches:
        for row in range(len(batch)):
            shards.append(_Shard(batch, row, wanted, n_docs, n_terms))
            size += len(shards[-1].ids) + len(shards[-1].places)
            if size >= most:
                yield _Shard.joined(shards)
                shards, size = [], 0
    if shards:
        yield _Shard.joined(shards)


def _frequencies(index: DataFrame, wanted: list[str]) -> dict[str, int]:
    """In how many documents each of a block's terms is. The block bounds what a task holds and sends."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, df = pa.array(wanted, pa.string()), np.zeros(len(wanted), np.int64)
        for batch in batches:
            for value in batch.column(0):
                terms = _unpacked(value)
                held, at = _held(asked, terms)
                df[held] += terms["df"].to_numpy()[at]
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "df"])

    counts = index.select("terms").mapInArrow(counted, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    return {wanted[r["term"]]: r["df"] for r in counts.collect()}


def _answers(index: DataFrame, block: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): for each task and item of the block its best ``k`` documents."""
    wanted = sorted({t for _, terms in block for t in terms})
    df = _frequencies(index, wanted)
    number = {t: i for i, t in enumerate(wanted)}
    weight = {t: math.floor(_WEIGHT * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    items = [[(number[t], weight[t]) for t in terms if t in weight] for _, terms in block]
    names = [item_id for item_id, _ in block]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in items]
        for shard in _joined(batches, pa.array(wanted, pa.string()), n_docs, n_terms, JOINED):
            for item, found in zip(items, best):
                shard.answer(item, found)
        for name, found in zip(names, best):
            if len(found.scores):
                ids = pa.array(found.ids, pa.int64(), mask=found.nameless)
                owner = pa.array([name] * len(ids), pa.int64())
                yield pa.RecordBatch.from_arrays([owner, ids, pa.array(found.scores)], ["item_id", "doc_id", "score"])

    return index.mapInArrow(searched, _HITS)


def search(index: DataFrame, queries: DataFrame, k: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` highest-scoring documents of an index of ``build_index``, with
    a score above 0; equal scores by doc_id, documents without one last. ``queries`` as in ``query_terms``.

    N documents have a term, L is the number of all their terms, df of them hold a term, tf times one of n
    terms. A term weighs ``w = floor(1000 ln((2N + 2) / (2df + 1)))`` and adds
    ``w * (10^9 tf div (1000 tf + 8 m))`` with ``m = 10 + 90 n N div L``. Items that no document answers, and all
    items of an empty index, have no rows.

    Queries are answered in blocks, each against all shards; the driver holds one block's terms and
    frequencies.
    """
    spark = index.sparkSession
    sizes = index.select(
        F.expr("cast(aggregate(lengths, 0L, (n, x) -> n + if(x > 0, 1L, 0L)) as decimal(38, 0))").alias("docs"),
        F.expr("cast(aggregate(lengths, 0L, (n, x) -> n + x) as decimal(38, 0))").alias("terms"),
    ).agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    path = scratch_dir(spark, "search-hits")
    spark.createDataFrame([], _HITS).write.parquet(path)
    if sizes["docs"]:
        for block in _blocks(query_terms(queries).toLocalIterator(), block_terms):
            with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(SHARDS_TOGETHER)}):
                answers = _answers(index, block, int(sizes["docs"]), int(sizes["terms"]), k)
                answers.write.mode("append").parquet(path)
    hits = spark.read.schema(_HITS).parquet(path)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
