"""Exact token counts of every prefix of a text under a byte-level BPE vocabulary.

A text's words are tokenized apart. Within a word the tokens of a prefix end with the one token that matches its
end and agrees with the last token of the prefix before it, so a table over the prefixes gives each one's last
token and its number of tokens, one more than that of the prefix before. Two tokens agree if merging their bytes
gives them back; a row of tokens in which all neighbours agree is what merging the whole gives. The
counts of a word are kept as steps from prefix to prefix, so a text's counts are the steps of its words in a row.

The steps are stored with the document: how many tokens a prefix has, and which prefix is the longest within a
budget, is then read off without the vocabulary.
"""

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trafficlake.llm.tokens import VOCABULARY, vocabulary_path
from trafficlake.llm.tokens import _WORDS as WORD_PATTERN
from trafficlake.llm.tokens import _byte_characters as byte_characters

LIMIT = 1024

_WORDS = regex.compile(WORD_PATTERN)
#: Of these words a prefix is not one word but two: the quote and a letter.
_TWO_LETTERS = ("'re", "'ve", "'ll")
#: Classes of characters, and one of each, which makes one word with others of its class.
_CLASSES = [(regex.compile(r"\p{L}"), "a"), (regex.compile(r"\p{N}"), "1"), (regex.compile(r"[^\s\p{L}\p{N}]"), "!")]
#: Several white spaces before a word.
_RUN = regex.compile(r"(?<!\s)\s{2,}+(?=\S)")

#: A long text is taken in slices of about so many characters, cut between words.
_SLICE = 1_000_000
_CUT = regex.compile(r"\S(?= )")
_KEPT_WORDS = 100_000
_LONG_WORD = 64
_KEPT_PAIRS = 300_000
_ONE, _FOUR = b"\x01", b"\x04"


class PrefixCounter:
    """Counts tokens of all prefixes of texts as a byte-level BPE vocabulary of the ``tokenizers`` library has them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, words = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not spec["normalizer"] and not any(
            model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        )
        if not plain or words.get("type") != "ByteLevel" or words.get("add_prefix_space") or not words.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path} has added tokens that take in their surroundings")
        # The longest of the added tokens that begin at a place is taken.
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, names))) if names else None
        self._library = Tokenizer.from_file(path).pre_tokenizer
        byte_of = byte_characters()
        self._spelled = {i: bytes(map(byte_of.__getitem__, t)) for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        number = {octets: i for i, octets in self._spelled.items()}
        self._bytes = [number[bytes([b])] for b in range(256)]
        self._merges = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (model["vocab"][x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            self._merges[left, right] = (rank, number[self._spelled[left] + self._spelled[right]])
        self._matches = ahocorasick.Automaton()
        for i, octets in self._spelled.items():
            self._matches.add_word(octets.decode("latin-1"), (i, len(octets)))
        self._matches.make_automaton()
        self._agreeing: dict[tuple[int, int], bool] = {}
        self._known = set(map(chr, range(128)))
        self._strange: set[str] = set()
        self._steps: dict[str, bytes | tuple[int, ...]] = {}
        self._older: dict[str, bytes | tuple[int, ...]] = {}

    def _merged(self, octets: bytes) -> list[int]:
        """Tokens of some bytes by their merges, in order of rank, from the left."""
        ids = [self._bytes[b] for b in octets]
        while len(ids) > 1:
            best = min((self._merges.get(pair, (len(self._merges), 0)) for pair in zip(ids, ids[1:])))
            if best[0] == len(self._merges):
                break
            out, i = [], 0
            while i < len(ids):
                if i + 1 < len(ids) and self._merges.get((ids[i], ids[i + 1])) == best:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _agree(self, left: int, right: int) -> bool:
        """Whether two tokens stay apart; with -1 on the left, whether a token is what its bytes merge to."""
        if len(self._agreeing) >= _KEPT_PAIRS:
            self._agreeing.clear()
        ids = [right] if left < 0 else [left, right]
        found = self._agreeing[left, right] = self._merged(b"".join(self._spelled[i] for i in ids)) == ids
        return found

    def _of_bytes(self, octets: bytes) -> list[int]:
        """Number of tokens of each prefix of a word, the empty one first."""
        counts, last = [0] * (len(octets) + 1), [-1] * (len(octets) + 1)
        agreeing = self._agreeing
        for end, (token, n) in self._matches.iter(octets.decode("latin-1")):
            if not counts[end + 1]:
                before = end + 1 - n
                agree = agreeing.get((last[before], token))
                if agree or (agree is None and self._agree(last[before], token)):
                    last[end + 1], counts[end + 1] = token, counts[before] + 1
        return counts

    def _word(self, word: str) -> list[int]:
        """Number of tokens of each prefix of a word, by characters, the empty one first."""
        octets = word.encode()
        counts = self._of_bytes(octets)
        if word in _TWO_LETTERS:
            counts[2] = counts[1] + self._of_bytes(octets[1:2])[1]
        if len(octets) == len(word):
            return counts
        # A character ends where none of its later bytes follow.
        return [c for c, after in zip(counts, octets + b" ") if after & 0xC0 != 0x80]

    def _steps_of(self, word: str) -> bytes | tuple[int, ...]:
        counts = self._word(word)
        steps = [b - a for a, b in zip(counts, counts[1:])]
        if min(steps) < -128 or max(steps) > 127:
            return tuple(steps)
        return bytes([x & 0xFF for x in steps])

    def _misread(self, char: str) -> bool:
        """Whether the library has a character in another class than the pattern, as letters of a later Unicode version."""
        return any(
            bool(own.match(char)) != (len(self._library.pre_tokenize_str(other + char)) == 1) for own, other in _CLASSES
        )

    def _split(self, text: str) -> list[str]:
        """The text's words: by pattern, or by the library itself if the two see a character differently."""
        new = set(text).difference(self._known)
        self._strange.update(filter(self._misread, new))
        self._known |= new
        if self._strange and not self._strange.isdisjoint(text):
            return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        return _WORDS.findall(text)

    def _plain(self, text: str) -> np.ndarray:
        """Steps of a text without added tokens, of bounded length."""
        words = self._split(text)
        if len(self._steps) > _KEPT_WORDS:
            self._steps, self._older = {}, self._steps
        known, older, passing = self._steps, self._older, []
        for word in set(words).difference(known):
            found = older.get(word)
            known[word] = self._steps_of(word) if found is None else found
            if len(word) > _LONG_WORD:
                passing.append(word)
        parts = list(map(known.__getitem__, words))
        for word in passing:
            del known[word]
        try:
            steps = np.frombuffer(b"".join(parts), np.int8)
        except TypeError:  # a word with steps beyond a byte
            steps = np.concatenate([np.frombuffer(x, np.int8) if isinstance(x, bytes) else np.array(x) for x in parts])
        return self._meeting(text, steps)

    def _meeting(self, text: str, steps: np.ndarray) -> np.ndarray:
        """The last of several white spaces begins the next word. Until the next character comes, it is part of the word
        before."""
        places = [(m.group(), m.end() - 1) for m in _RUN.finditer(text)]
        if places:
            steps = steps.astype(np.int32)
        for run, at in places:
            counts = self._word(run)
            gap = counts[-1] - counts[-2] - int(steps[at])
            steps[at] += gap
            steps[at + 1] -= gap
        return steps

    def _long(self, text: str) -> np.ndarray:
        parts, start = [], 0
        while len(text) - start > _SLICE:
            cut = _CUT.search(text, start + _SLICE)
            if cut is None:
                break
            parts.append(self._plain(text[start : cut.end()]))
            start = cut.end()
        parts.append(self._plain(text[start:]))
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def steps(self, text: str) -> np.ndarray:
        """For each character how many tokens more, or fewer, the prefix that ends with it has."""
        parts, start = [], 0
        for added in self._added.finditer(text) if self._added else ():
            # Until its last character an added token is ordinary text.
            part = self._long(text[start : added.end()]).astype(np.int32)
            whole = int(part[: added.start() - start].sum()) + 1
            part[-1] = whole - int(part[:-1].sum())
            parts.append(part)
            start = added.end()
        if not parts:
            return self._long(text)
        return np.concatenate([*parts, self._long(text[start:])])


@lru_cache(maxsize=1)
def _counter(vocabulary: str) -> PrefixCounter:
    return PrefixCounter(vocabulary_path(vocabulary))


def _stored(steps: np.ndarray) -> bytes:
    if steps.dtype == np.int8 or not len(steps) or (steps.min() >= -128 and steps.max() <= 127):
        return _ONE + steps.astype(np.int8).tobytes()
    return _FOUR + steps.astype("<i4").tobytes()


def prefix_counts(prefixes: bytes) -> np.ndarray:
    """Number of tokens of every prefix of a text, from the empty one to the whole, out of its stored steps."""
    steps = np.frombuffer(prefixes, np.int8 if prefixes[:1] == _ONE else "<i4", offset=1)
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, prefixes) for each row of ``docs`` (doc_id, text; other columns are ignored).

    ``prefixes`` holds the number of tokens of every prefix (see ``prefix_counts``, ``tokens_of_prefix`` and
    ``longest_prefix``), a byte a character. Counts are those of the ``tokenizers`` library for the prefix as a
    text of its own, without tokens of a template; the vocabulary's special strings count as one token. A null
    text counts as empty: no bytes, no tokens. Rows that repeat are counted each; an empty table gives no
    rows. Long texts are split between words, so that memory follows a text's length.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1).cast(pa.binary())), 0).cast(pa.int64())
            stored, totals = [], []
            for i in range(len(batch)):
                steps = counter.steps(batch.column(1)[i].as_py() or "")
                stored.append(_stored(steps))
                totals.append(int(steps.sum(dtype=np.int64)))
            columns = [batch.column(0), sizes, pa.array(totals, pa.int64()), pa.array(stored, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "prefixes"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(counted, "doc_id bigint, n_bytes bigint, n_tokens bigint, prefixes binary")


def _answers(ask, prefixes: pd.Series, asked: pd.Series) -> pd.Series:
    known = prefixes.notna() & asked.notna()
    return pd.Series([ask(p, int(n)) if k else None for p, n, k in zip(prefixes, asked, known)], dtype="Int64")


def _tokens(prefixes: bytes, n_chars: int) -> int:
    counts = prefix_counts(prefixes)
    return int(counts[min(max(n_chars, 0), len(counts) - 1)])


def _longest(prefixes: bytes, budget: int) -> int:
    within = np.flatnonzero(prefix_counts(prefixes) <= budget)
    return int(within[-1]) if len(within) else 0


def tokens_of_prefix(prefixes: Column, n_chars: Column) -> Column:
    """Tokens of the first ``n_chars`` characters of a text, of all of it if it is shorter; null if either is null."""
    return F.pandas_udf(lambda p, n: _answers(_tokens, p, n), "bigint")(prefixes, n_chars)


def longest_prefix(prefixes: Column, budget: Column) -> Column:
    """The most characters of a text's beginning that make at most ``budget`` tokens; null if either is null. A longer
    prefix can have fewer tokens, so the last one within the budget counts."""
    return F.pandas_udf(lambda p, n: _answers(_longest, p, n), "bigint")(prefixes, budget)


def truncated(docs: DataFrame, counts: DataFrame, budget: int) -> DataFrame:
    """(doc_id, text, n_tokens): the longest beginning of each text within ``budget`` tokens, from stored counts of the
    same rows, without encoding. Rows meet by doc_id, which must tell them apart; rows without one, and null
    texts, are left out."""
    fits = counts.select("doc_id", longest_prefix(F.col("prefixes"), F.lit(budget)).alias("fit"), "prefixes")
    fits = fits.select("doc_id", "fit", tokens_of_prefix(F.col("prefixes"), F.col("fit")).alias("n_tokens"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.where(F.col("text").isNotNull()).join(fits, "doc_id")
    return joined.select("doc_id", F.expr("substring(text, 1, cast(fit as int))").alias("text"), "n_tokens")
