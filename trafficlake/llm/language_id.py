"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (n = 1..3, a blended spectrum) present in both,
over the geometric mean of the numbers in each; n-grams count once however often they occur, and only those
of the landmark texts count. Nyström features on the landmarks feed one ridge regression per language
against the rest. A batch of texts is scored as one matrix product: presence of n-grams times weights.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trafficlake.llm.common import free_name, hash_order, held_out, small_side

#: The model is fitted on at most so many documents of each language, the first of them landmarks.
TRAIN_PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 40
ORDERS = (1, 2, 3)
RIDGE = 1e-3
UNDETERMINED = "und"
#: Below this evidence the pipeline takes a document for none of the languages.
LEAST_EVIDENCE = 1.0
#: What few n-grams say is unsure: this over the square root of their number is added to the evidence.
SLACK = 1.5
#: Stands for the lead over the second language where there is only one.
LONE_LEAD = 0.3

_LETTER = re.compile(r"[^\W\d_]")
_BATCH = 256
#: Letters told apart; rarer ones share a code. Code 0 is everything that is no letter.
_LETTERS = 254
#: Where the numbers of each order's n-grams begin.
_OFFSETS = {1: 0, 2: 1 << 16, 3: 1 << 24}


def bounded_sample(rows: DataFrame, label: str, most: int, seed: str) -> DataFrame:
    """At most ``most`` rows for each value of ``label``, the first by a hash of doc_id.

    Counts of each label thin the rows before they are ranked, so a label with a third of all rows sends
    about twice ``most`` of them to the task that ranks it.
    """
    n, other, place = (free_name(rows, name) for name in ("n_rows", "counted_label", "place"))
    counts = rows.groupBy(label).agg(F.count("*").alias(n)).withColumnRenamed(label, other)
    share = F.least(F.lit(1.0), F.lit(2.0 * most + 50) / F.col(n))
    draw = F.conv(F.substring(hash_order(seed), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)
    thinned = rows.join(small_side(counts), F.col(label) == F.col(other)).where(draw < share)
    rank = F.row_number().over(Window.partitionBy(label).orderBy(hash_order(seed), F.xxhash64("text")))
    return thinned.withColumn(place, rank).where(F.col(place) <= most).select(*rows.columns)


class Alphabet:
    """Maps texts to letter codes, and those to numbers of n-grams."""

    def __init__(self, texts: list[str]):
        points, counts = np.unique(np.concatenate([self.points(t) for t in texts]), return_counts=True)
        letters = [int(points[i]) for i in np.argsort(-counts, kind="stable") if chr(points[i]).isalpha()]
        self.letters = letters[:_LETTERS]
        self._table: np.ndarray | None = None

    @staticmethod
    def points(text: str) -> np.ndarray:
        return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)

    def codes(self, text: str) -> np.ndarray:
        if self._table is None:
            self._table = np.zeros(0x110000, np.uint32)
            self._table[np.fromiter((i for i in range(0x30000) if chr(i).isalpha()), np.int64)] = 255
            self._table[self.letters] = np.arange(1, len(self.letters) + 1)
        return self._table[self.points(text)]

    def grams(self, text: str) -> np.ndarray:
        """Numbers of the n-grams of each order, offset so that orders differ."""
        codes = self.codes(text)
        parts, gram = [], codes
        for n in range(1, max(ORDERS) + 1):
            if n > 1:
                gram = (gram[:-1] << np.uint32(8)) | codes[n - 1 :]
            if n in ORDERS and len(gram):
                parts.append(gram + np.uint32(_OFFSETS[n]))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def __getstate__(self):
        return {"letters": self.letters, "_table": None}


class _Slots:
    """Where an n-gram stands among the known ones; a page of 256 numbers for each beginning that occurs, and one page
    for all others."""

    def __init__(self, known: np.ndarray):
        self.none = len(known)
        first = known >> np.uint32(8)
        used = np.unique(first)
        self._page = np.zeros(((2 << 24) >> 8) + 1, np.int32)
        self._page[used] = np.arange(1, len(used) + 1) << 8
        self._slot = np.full((len(used) + 1) << 8, self.none, np.int32)
        self._slot[self._page[first] + (known & np.uint32(255)).astype(np.int32)] = np.arange(len(known))

    def __getitem__(self, grams: np.ndarray) -> np.ndarray:
        return self._slot[self._page[grams >> np.uint32(8)] + (grams & np.uint32(255)).astype(np.int32)]


class Model:
    """One weight for each n-gram and language, from Nyström features and ridge regressions."""

    def __init__(self, texts: list[str], labels: list[str], landmarks: list[int]):
        self.languages = sorted(set(labels))
        self.alphabet = Alphabet(texts)
        self.known = np.unique(np.concatenate([self.alphabet.grams(texts[i]) for i in landmarks]))
        self.slots = _Slots(self.known)
        chosen, found = set(landmarks), []
        for i, text in enumerate(texts):
            slots, longest = self.found(text)
            found.append((np.unique(slots), longest if i in chosen else longest[:0]))
        presence = self.presence(found)
        norms = np.sqrt(np.maximum(presence.sum(axis=1), 1))
        marks = presence[landmarks] / norms[landmarks, None]
        kernel = (presence @ marks.T) / norms[:, None]
        values, vectors = np.linalg.eigh(kernel[landmarks].astype(np.float64))
        keep = values > 1e-6 * values[-1]
        root = vectors[:, keep] / np.sqrt(values[keep])
        features = np.column_stack([kernel @ root, np.ones(len(texts))])
        wanted = np.where(np.array(labels)[:, None] == np.array(self.languages), 1.0, -1.0)
        ridge = RIDGE * len(texts) * np.eye(features.shape[1])
        ridge[-1, -1] = 1e-9
        weights = np.linalg.solve(features.T @ features + ridge, features.T @ wanted)
        # A score is linear in the presence of n-grams over the text's norm, so the landmarks fold in.
        self.weights = (marks.T @ (root @ weights[:-1])).astype(np.float32)
        self.bias = weights[-1].astype(np.float32)
        # The share of a landmark's longest n-grams that other landmarks have: what a text of a learned language shows.
        shared = np.append(presence[landmarks].sum(axis=0) > 1, False)
        shares = [shared[slots].mean() for i in landmarks if len(slots := found[i][1])]
        self.usual = float(np.median(shares)) if shares else 0.0

    def found(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Slots of a text's n-grams, one a place, and those of its longest n-grams that have a letter."""
        grams = self.alphabet.grams(text)
        slots = self.slots[grams]
        return slots, slots[grams > _OFFSETS[max(ORDERS)]]

    def presence(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row for each text, 1 for each known n-gram that it has anywhere."""
        rows = np.zeros((len(found), len(self.known) + 1), np.float32)
        for row, (slots, _) in zip(rows, found):
            row[slots] = 1
        return rows[:, :-1]

    def scores(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        presence = self.presence(found)
        norms = np.sqrt(np.maximum(presence.sum(axis=1), 1))
        return (presence @ self.weights) / norms[:, None] + self.bias

    def evidence(self, found: list[tuple[np.ndarray, np.ndarray]], margins: np.ndarray) -> np.ndarray:
        """How much speaks for the best language of each text: the share of its longest n-grams that the landmarks
        know, over the usual share, its lead over the second language, and the slack of short texts.

        The scores of a text add up to 1, whatever it is, so the best one alone says little. If a text has no
        such n-gram, or the landmarks none in common, there is nothing to go by, and the evidence is infinite.
        """
        ranked = np.sort(margins, axis=1)
        lead = (ranked[:, -1] - ranked[:, -2]) / 2 if len(self.languages) > 1 else np.full(len(found), LONE_LEAD)
        evidence = np.full(len(found), np.inf)
        for i, (_, slots) in enumerate(found):
            if len(slots) and self.usual:
                share = np.count_nonzero(slots != self.slots.none) / len(slots)
                evidence[i] = share / self.usual + lead[i] + SLACK / np.sqrt(len(slots))
        return evidence


def fit(docs: DataFrame, most: int = TRAIN_PER_LANGUAGE, landmarks: int = LANDMARKS_PER_LANGUAGE) -> Model | None:
    """A model of the ``lang`` of documents that are not held out, None if there are none with letters.

    The sample on the driver is at most ``most`` whole texts for each language.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(3, 1))
    sample = [(r["text"], r["lang"], r["doc_id"]) for r in bounded_sample(rows, "lang", most, "lang-1").collect()]
    sample = sorted((lang, doc_id, text) for text, lang, doc_id in sample if _LETTER.search(text))
    if not sample:
        return None
    languages = [lang for lang, _, _ in sample]
    picked, seen = [], {}
    for i, lang in enumerate(languages):
        seen[lang] = seen.get(lang, 0) + 1
        if seen[lang] <= landmarks:
            picked.append(i)
    return Model([text for _, _, text in sample], languages, picked)


def _able(texts: list[str | None], model: Model | None) -> list[int]:
    return [i for i, t in enumerate(texts) if model is not None and t and _LETTER.search(t)]


def _predictions(texts: list[str | None], model: Model | None) -> tuple[list[str], np.ndarray]:
    names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if able := _able(texts, model):
        margins = model.scores([model.found(texts[i]) for i in able])
        scores[able] = np.clip((margins.max(axis=1) + 1) / 2, 0, 1)
        for i, best in zip(able, margins.argmax(axis=1)):
            names[i] = model.languages[best]
    return names, scores


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of the batches: of so many texts at a time there are Python strings and presence rows."""
    for batch in batches:
        for at in range(0, len(batch), _BATCH):
            yield batch.slice(at, _BATCH)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs`` (doc_id, text; other columns are ignored).

    A null text, or one without a letter, is ``und`` with score 0; so is every text if there is no model.
    score is the best language's regression value, where -1 (the rest) is 0 and 1 (the language) is 1. Equal
    texts have equal predictions. Documents without doc_id count as held out.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            names, scores = _predictions(part.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out(3, 1).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(scored, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identified(texts: list[str | None], model: Model | None, least: float = LEAST_EVIDENCE) -> list[bool]:
    """Whether each text has a letter and at least ``least`` evidence for one of the model's languages."""
    keep = [False] * len(texts)
    if able := _able(texts, model):
        found = [model.found(texts[i]) for i in able]
        for i, evidence in zip(able, model.evidence(found, model.scores(found))):
            keep[i] = bool(evidence >= least)
    return keep


def keep_identified(docs: DataFrame, model: Model | None, least: float = LEAST_EVIDENCE) -> DataFrame:
    """``docs`` without the rows predicted ``und`` or with less evidence than ``least``; all columns kept.

    Whole rows pass through the tasks that score them, so no join is needed.
    """
    at = docs.columns.index("text")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            yield part.filter(pa.array(identified(part.column(at).to_pylist(), model, least), pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
