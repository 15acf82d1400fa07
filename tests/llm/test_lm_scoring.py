"""Stupid-backoff scores against a plain restatement, over both ways of exchanging counts and with repeated rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trafficlake.llm import lm_scoring
from trafficlake.llm.lm_scoring import score_documents

SCHEMA = "doc_id bigint, text string"


def grams(words):
    return Counter(tuple(words[max(0, i + 1 - n) : i + 1]) for i in range(len(words)) for n in (1, 2, 3) if i + 1 >= n)


def plain(rows):
    """Sorted (doc_id, n_words, score) of all rows."""
    texts = [[w for w in re.split(r"[ \t\n\x0b\x0c\r]+", (text or "").lower()) if w] for _, text in rows]
    every = Counter()
    for words in texts:
        every.update(grams(words))
    n_words = sum(map(len, texts))
    out = []
    for (doc_id, _), words in zip(rows, texts):
        own, score = grams(words), 0.0
        left = {g: every[g] - n for g, n in own.items()}
        for i in range(len(words)):
            longest = min(i + 1, 3)
            for n in range(longest, 0, -1):
                gram = tuple(words[i + 1 - n : i + 1])
                if left[gram] > 0 or n == 1:
                    below = left[gram[:-1]] if n > 1 else max(1, n_words - len(words))
                    score += (longest - n) * math.log(0.4) + math.log((left[gram] or 0.5) / below)
                    break
        out.append((-1 if doc_id is None else doc_id, len(words), score))
    return sorted(out)


def scored(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["score"]) for r in score_documents(df).collect())


def same(found, wanted):
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in wanted], abs=1e-6)


def some_texts(n, seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(2_000)]
    return [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(60)))) for i in range(n)] + [(None, None), (n, "")]


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", 3_000)
    monkeypatch.setattr(lm_scoring, "BUCKET_BYTES", 1_500)
    monkeypatch.setattr(lm_scoring, "LEAST_MESSAGE", 0)


def folds(monkeypatch):
    """What the hash space is divided into, by each part of an exchange, from now on."""
    made, plain_space = [], lm_scoring.Space

    def space(bits, width):
        made.append(width)
        return plain_space(bits, width)

    monkeypatch.setattr(lm_scoring, "Space", space)
    return made


def test_chunks_to_buckets(spark, small_chunks, monkeypatch):
    made, rows = folds(monkeypatch), some_texts(400)
    same(scored(spark.createDataFrame(rows, SCHEMA)), plain(rows))
    assert len(made) == 1 and made[0] > 3


def test_families_of_chunks(spark, small_chunks, monkeypatch):
    monkeypatch.setattr(lm_scoring, "LEAST_MESSAGE", 1_000_000)
    made, rows = folds(monkeypatch), some_texts(400)
    same(scored(spark.createDataFrame(rows, SCHEMA)), plain(rows))
    assert len(made) == 2 and 0 < made[1] < made[0]


@pytest.mark.parametrize("least", [0, 1_000_000])
def test_third_of_the_rows_alike(spark, small_chunks, monkeypatch, least):
    """Copies of one row, with and without an id, and of the empty text, are scored once and all returned."""
    monkeypatch.setattr(lm_scoring, "LEAST_MESSAGE", least)
    rows = some_texts(300) + [(7, "the same w1 w2 text")] * 150 + [(None, "w3 w1 w1")] * 60 + [(9, "")] * 40 + [(None, None)] * 40
    monkeypatch.setattr(lm_scoring, "ROW_BYTES", 20)
    same(scored(spark.createDataFrame(rows, SCHEMA).repartition(5)), plain(rows))
    listed = lm_scoring._repeated(spark.createDataFrame(rows, SCHEMA).fillna("", ["text"])).collect()
    assert len(listed) == 4


def test_a_shared_hash_gives_no_infinite_score():
    """An n-gram whose hash another one has seems to occur elsewhere though its first words don't."""
    chunk = lm_scoring.Chunk([b"new words here"], 3, 48)
    grams, totals = chunk.counted(np.array([1]))
    seen = totals.copy()
    seen[0] += 100
    unseen = chunk.scores(seen, 0.4)
    for i in (chunk.grams[1][0], chunk.grams[2][0]):
        shared = seen.copy()
        shared[np.searchsorted(grams, i)] += 1
        assert chunk.scores(shared, 0.4) == pytest.approx(unseen)


def test_messages_grow_with_the_power_of_one_and_a_half():
    """The formula of the docstring, from the sizes that the operator works with."""

    def messages(total):
        chunks = total // lm_scoring.CHUNK_BYTES
        fold = (total // lm_scoring.BUCKET_BYTES).bit_length() - 1
        if lm_scoring.LEAST_MESSAGE * chunks << fold <= total // 6 * 3:
            return chunks << fold
        family = chunks.bit_length() // 2
        return (chunks << family + 1) + ((chunks >> family) << fold)

    one, hundred = messages(10**12), messages(10**14)
    assert hundred / one <= 1.1 * 100**1.5 and one < 5e8
