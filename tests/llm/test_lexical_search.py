"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from trafficlake.llm.lexical_search import build_index, query_terms, search
from trafficlake.paths import folders

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """{item_id: [(rank, doc_id, score)]} by scoring every document."""
    counted = [(i, Counter(terms(text))) for i, text in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    found = {}
    for item, wanted in asked.items():
        scores = []
        for i, c, n in counted:
            m = 10 + 90 * n * n_docs // n_terms
            score = 0
            for t in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        best = sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k]
        if best:
            found[item] = [(r, i, -s) for r, (s, _, i) in enumerate(best, 1)]
    return found


def answered(spark, docs, items, k=10, shard_bytes=16_000_000, **limits):
    index = build_index(spark.createDataFrame(docs, DOCS).repartition(3), shard_bytes)
    rows = search(index, spark.createDataFrame(items, ITEMS), k, **limits).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        found.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return found


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("shard_bytes", [200, 16_000_000])
def test_random_texts(spark, seed, shard_bytes):
    """Words of Zipf frequencies, so that lists are short and long, with copies, ties and terms beyond ASCII."""
    rng = random.Random(seed)
    words = [f"w{i}" if i % 3 else f"É{i}ß" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randint(1, 40))) for _ in range(250)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i % 7]) for i in range(150)]
    items = [(i, "; ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(20)]
    assert answered(spark, docs, items, shard_bytes=shard_bytes) == plain(docs, items)


def test_third_of_the_rows_alike_and_small_blocks_of_queries(spark):
    docs = [(i, "same text for all") for i in range(300)] + [(1000 + i, f"other word{i % 9} text {i}") for i in range(600)]
    items = [(i, f"text word{i} same") for i in range(9)]
    assert answered(spark, docs, items, block_terms=4) == plain(docs, items)


def test_edges(spark):
    """Null and empty texts, rows without id, repeated ids and rows, separators only, terms nobody has, items that
    repeat or have no id, and a very long text."""
    docs = [(1, None), (2, ""), (3, " .,;\x00\x7f "), (None, "red blue"), (4, "red"), (4, "red"), (4, "RED blue"), (None, "red blue")]
    docs += [(9, "red " + "filler " * 100_000), (-5, "blue-red"), (7, "naïve red")]
    items = [(1, "red blue"), (2, None), (3, ""), (4, "nobody"), (5, "red"), (5, "blue"), (None, "BLUE red"), (6, "naïve")]
    for shard_bytes in (1, 1000, 16_000_000):
        assert answered(spark, docs, items, shard_bytes=shard_bytes) == plain(docs, items)


def test_empty_tables(spark):
    assert answered(spark, [], [(1, "a")]) == {}
    assert answered(spark, [(1, "a")], []) == {}
    assert answered(spark, [(1, None), (2, "-")], [(1, "a")]) == {}


def test_other_columns_do_not_matter(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id int, text string, item_id string, score bigint")
    items = spark.createDataFrame([(1, "a", 7, "y")], "item_id int, text string, doc_id int, rank string")
    hits = search(build_index(docs), items)
    assert hits.columns == ["item_id", "rank", "doc_id", "score"]
    assert [tuple(r)[:3] for r in hits.collect()] == [(1, 1, 1)]


def test_items_are_united_by_id(spark):
    rows = query_terms(spark.createDataFrame([(1, "b a"), (1, "c A"), (2, "..")], ITEMS)).collect()
    assert [tuple(r) for r in rows] == [(1, ["a", "b", "c"])]


def test_long_lists_are_skipped(spark, monkeypatch):
    """With short lists that decide, few postings of a long list are scored."""
    from trafficlake.llm import lexical_search as ls

    rng = random.Random(5)
    docs = [(i, "common " * rng.randint(1, 3) + ("rare " * 3 if i % 200 == 0 else "")) for i in range(20_000)]
    rows = spark.createDataFrame(docs, DOCS).coalesce(1)
    batch = build_index(rows).toArrow().to_batches()[0]
    scored = []
    impacts = ls._List.impacts

    def counting(self, at):
        out = impacts(self, at)
        scored.append(len(out))
        return out

    monkeypatch.setattr(ls._List, "impacts", counting)
    n_terms = sum(len(terms(t)) for _, t in docs)
    shard = ls._Shard(batch, 0, ls.pa.array(["common", "rare"]), len(docs), n_terms)
    best = ls._Best(10)
    shard.answer([(0, 1), (1, 5000)], best)
    assert len(best.scores) == 10 and sum(scored) < 1000


def test_index_files_hold_one_row_a_shard(spark):
    index = build_index(spark.createDataFrame([(i, "word " * 30) for i in range(100)], DOCS).coalesce(1), 1000)
    assert index.count() > 5
    assert index.selectExpr("explode(docs) as d").distinct().count() == 100
    assert not folders(spark, f"{index.inputFiles()[0].rpartition('/')[0]}/_temporary")


def test_a_row_and_a_row_group_of_the_index_stay_small(spark):
    """A row holds about a megabyte of text and a row group, which Spark reads at once, few rows, however much a task reads."""
    rng = random.Random(3)
    docs = [(i, " ".join(f"t{rng.getrandbits(44):011x}" for _ in range(1000))) for i in range(1200)]
    index = build_index(spark.createDataFrame(docs, DOCS).coalesce(1))
    files = [pq.read_metadata(f.removeprefix("file://")) for f in index.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) >= 15 and max(g.num_rows for g in groups) <= 8
    assert max(g.total_byte_size for g in groups) < 16_000_000
    assert index.selectExpr("max(size(docs))").first()[0] <= 1_013_000 // 13_000 + 1
    assert index.selectExpr("explode(docs) as d").distinct().count() == 1200


def test_tasks_get_few_documents_at_once(spark):
    """The words are the rows of the batches that a task gets while the index is built; settings are as before then."""
    from trafficlake.llm import lexical_search as ls

    def counted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f"{len(batch)}"] * len(batch))], ["doc_id", "text"])

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    index = build_index(spark.range(2000, numPartitions=1).mapInArrow(counted, DOCS))
    found = {t for r in index.collect() for t in ls._unpacked(pa.scalar(bytes(r["terms"]), pa.binary()))["term"].to_pylist()}
    assert found == {"256", "208"} and spark.conf.get(setting) == before


@pytest.mark.parametrize("most", [1, 900, 1_000_000])
def test_joined_shards_answer_like_the_whole(spark, most):
    from trafficlake.llm import lexical_search as ls

    rng = random.Random(8)
    words = [f"w{i}" for i in range(50)]
    weights = [1 / (i + 1) for i in range(50)]
    docs = [(i if i % 40 else None, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(600)]
    wanted = sorted({"nobody", *rng.sample(words, 30)})
    batches = build_index(spark.createDataFrame(docs, DOCS).coalesce(1), 2000).toArrow().to_batches()
    counted = [Counter(terms(t)) for _, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(c.total() for c in counted)
    df = Counter(t for c in counted for t in c)
    shards = list(ls._joined(iter(batches), pa.array(wanted), n_docs, n_terms, most))
    assert (len(shards) == 1) == (most == 1_000_000)
    assert sum(len(x.ids) for x in shards) == 600
    asked = [(0, wanted), (1, wanted[:4]), (2, ["nobody"])]
    answers = {}
    for item, of in asked:
        best = ls._Best(10)
        weighed = [(wanted.index(t), math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) for t in of]
        for shard in shards:
            shard.answer(weighed, best)
        ids = [None if nameless else int(i) for i, nameless in zip(best.ids, best.nameless)]
        if ids:
            answers[item] = [(r, i, int(s)) for r, (i, s) in enumerate(zip(ids, best.scores), 1)]
    assert answers == plain(docs, [(item, " ".join(of)) for item, of in asked])
