"""Token counts of prefixes against the library."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from trafficlake.llm.common import table
from trafficlake.llm.token_counts import PrefixCounter, count_tokens, longest_prefix, prefix_counts, tokens_of_prefix, truncated
from trafficlake.llm.tokens import VOCABULARY, vocabulary_path
from tests.llm.test_queries import SF_DIR

DOCS = "doc_id bigint, text string"
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "'", "'re", "'ve", "'s", "é", "ñ", "1", "23", "!", "...", "<|endoftext|>"]
PARTS += ["<|end", "中", "文", "😀", " The", "-----", "\r\n", "\x1c", "\x85", "　", "e", "r", "՘", "\U00010940", "Ᲊ", "́"]


@pytest.fixture(scope="module")
def library():
    coder = Tokenizer.from_file(vocabulary_path(VOCABULARY))
    return lambda text: len(coder.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(vocabulary_path(VOCABULARY))


@pytest.mark.parametrize("seed", range(4))
def test_every_prefix_of_random_texts(library, counter, seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14)))
        assert np.cumsum(counter.steps(text)).tolist() == [library(text[: i + 1]) for i in range(len(text))], text


def test_every_prefix_of_words(library, counter):
    """Runs of one character and of few, whose merges reach far."""
    rng = random.Random(1)
    for alphabet in ("-", "=", " ", "a", "ab", "abc", "\n", "0", "é", "ÃÂ"):
        text = "".join(rng.choice(alphabet) for _ in range(140))
        assert np.cumsum(counter.steps(text)).tolist() == [library(text[: i + 1]) for i in range(len(text))]


def test_every_character(library, counter):
    """Characters of all kinds beside a letter, digits, marks and white space; unassigned ones too."""
    for start in range(0, 0x30000, 0x2000):
        chars = [chr(i) for i in range(start, start + 0x2000, 17) if not 0xD800 <= i < 0xE000]
        text = "".join(f"a{c}1{c}!{c} {c}{c}\n" for c in chars)
        assert int(counter.steps(text).sum()) == library(text)


def test_whole_table(spark, library):
    docs = table(spark, SF_DIR, "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = count_tokens(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]]
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), library(text))
        assert len(prefix_counts(row["prefixes"])) == len(text) + 1


def test_long_texts(library, counter, monkeypatch):
    from trafficlake.llm import token_counts

    text = " ".join(f"word{i}  é\n\n next" for i in range(20_000)) + "x" * 5000
    assert int(counter.steps(text).sum()) == library(text)
    monkeypatch.setattr(token_counts, "_SLICE", 1000)
    assert counter.steps(text).tolist() == PrefixCounter(vocabulary_path(VOCABULARY)).steps(text).tolist()
    assert int(counter.steps(text).sum()) == library(text)


def test_edges(spark, library):
    texts = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "x" * 300_000), (5, "\n" * 50_000), (6, "<|endoftext|>" * 3)]
    rows = count_tokens(spark.createDataFrame(texts, DOCS).coalesce(1)).collect()
    assert [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows] == [(i, len(t or ""), library(t or "")) for i, t in texts]
    assert count_tokens(spark.createDataFrame([], DOCS)).collect() == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([("x", 7, "a b", 5)], "n_tokens string, doc_id int, text string, prefixes int")
    row = count_tokens(docs).first()
    assert (row["doc_id"], row["n_tokens"]) == (7, 2)


def test_steps_beyond_a_byte(monkeypatch):
    counter = PrefixCounter(vocabulary_path(VOCABULARY))
    monkeypatch.setattr(counter, "_word", lambda word: [0, 300, 1] if word == "ab" else [0, *range(1, len(word) + 1)])
    from trafficlake.llm.token_counts import _stored

    steps = counter.steps("x ab")
    assert steps.tolist() == [1, 1, 1, 1] and prefix_counts(_stored(steps)).tolist() == [0, 1, 2, 3, 4]
    steps = counter.steps("ab")
    assert prefix_counts(_stored(steps)).tolist() == [0, 300, 1]


def test_questions_without_encoding(spark, library):
    texts = {1: "The quick brown fox doesn't jump", 2: "hello hello hello", 3: "", 4: "中文 text   with  spaces\n\nand lines"}
    docs = spark.createDataFrame(list(texts.items()) + [(None, "x"), (5, None)], DOCS)
    counts = count_tokens(docs).cache()
    for budget in (0, 1, 3, 100):
        asked = counts.select("doc_id", longest_prefix(F.col("prefixes"), F.lit(budget)).alias("n")).where("doc_id < 5")
        for row in asked.collect():
            text = texts[row["doc_id"]]
            assert row["n"] == max(i for i in range(len(text) + 1) if library(text[:i]) <= budget)
        for row in truncated(docs, counts, budget).collect():
            text = texts[row["doc_id"]]
            assert text.startswith(row["text"]) and row["n_tokens"] == library(row["text"]) <= budget
    at = counts.select("doc_id", tokens_of_prefix(F.col("prefixes"), F.lit(7)).alias("n")).where("doc_id < 5")
    assert {r["doc_id"]: r["n"] for r in at.collect()} == {i: library(t[:7]) for i, t in texts.items()}
    none = counts.select(tokens_of_prefix(F.col("prefixes"), F.lit(None).cast("bigint")).alias("n"))
    assert {r["n"] for r in none.collect()} == {None}


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        PrefixCounter(vocabulary_path("word_bpe_49k.json"))
