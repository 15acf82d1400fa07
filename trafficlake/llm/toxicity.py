"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon is mined from labelled training texts: words, and beginnings of words, that toxic documents have
far more often. Every text then becomes a short vector - lexicon densities, how near hits are to the second
person, capitals, punctuation, obfuscation - on which the trees are grown. A part of the training rows that
the trees don't see calibrates their output.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.llm.common import hash_order, held_out, small_side, staged

#: Labelled rows of each class at most that the lexicon is mined from, and that the trees are grown on.
LEXICON_ROWS = 4_000
TREE_ROWS = 20_000
LEXICON_TERMS = 600
#: A term is in the lexicon if so many toxic sample texts have it, and so many times as often as others.
MIN_TEXTS, MIN_RATIO = 3, 10.0
PREFIXES = (4, 5, 6)
NEAR_WORDS = 5
TREES, DEPTH, STEP = 20, 4, 0.3
#: One training row in so many calibrates.
CALIBRATION_PART = 4

# Words of the second person in four languages, and characters that stand for letters.
_SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine deinen deiner ihr euch euer sie tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
_LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")

_SPELLED = re.compile(r"(?<![^\W_])(?:[^\W\d_][\s.\-_*]){2,}[^\W\d_](?![^\W_])")
_NO_LETTER = re.compile(r"[\W\d_]+")
_CACHED = 200_000

FEATURES = (
    "hit_rate",
    "hits",
    "hit_kinds",
    "hit_weight",
    "hidden_rate",
    "hidden_hits",
    "near_rate",
    "person_rate",
    "capital_rate",
    "shout_rate",
    "bang_rate",
    "punctuation_rate",
    "odd_word_rate",
    "length",
)


def _plain(word: str) -> str:
    return _NO_LETTER.sub("", word.lower())


def _revealed(word: str) -> str:
    """The word with look-alike characters as letters and without marks between letters."""
    return _plain(word.translate(_LOOKALIKES))


def terms(text: str) -> set[str]:
    """Words of a text, as ``=word``, and their beginnings."""
    found = set()
    for word in set(map(_plain, text.split())):
        found.add(f"={word}")
        found.update(word[:n] for n in PREFIXES if len(word) >= n)
    found.discard("=")
    return found


class Lexicon:
    """Weighted terms, looked up word by word with a cache."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self._known: dict[str, tuple[float, str]] = {}

    def _find(self, word: str) -> tuple[float, str]:
        best = max([f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)], key=lambda t: self.weights.get(t, 0.0))
        return self.weights.get(best, 0.0), best

    def hit(self, word: str) -> tuple[int, float, str]:
        """Kind of word (1 hit, 2 hit only when revealed, 4 second person, 8 shouted, 16 letters mixed with
        other marks; added up), the hit's weight and its term."""
        known = self._known.get(word)
        if known is None:
            plain = _plain(word)
            weight, term = self._find(plain)
            kind = 1 if weight else 0
            inner = word.strip(".,;:!?()[]{}\"'»«…-—*%$#&")
            odd = bool(plain) and bool(_NO_LETTER.search(inner.replace("'", "")))
            if not weight and odd:
                weight, term = self._find(_revealed(inner))
                kind = 2 if weight else 0
            kind += 4 * (plain in _SECOND_PERSON) + 8 * (len(inner) > 2 and inner.isupper()) + 16 * odd
            known = (kind, weight, term)
            if len(self._known) >= _CACHED:
                self._known.clear()
            self._known[word] = known
        return known

    def __getstate__(self):
        return {"weights": self.weights, "_known": {}}

    def features(self, text: str) -> list[float]:
        words = text.split()
        spelled = [x for x in map(_plain, _SPELLED.findall(text)) if self._find(x)[0]]
        found = list(map(self.hit, words))
        kinds = np.fromiter((f[0] for f in found), np.int64, len(found))
        hits = np.flatnonzero(kinds & 3)
        person = np.flatnonzero(kinds & 4)
        far = np.searchsorted(person, hits + NEAR_WORDS + 1) - np.searchsorted(person, hits - NEAR_WORDS)
        hidden = int(np.count_nonzero(kinds & 2)) + len(spelled)
        octets = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=128)
        n, chars = max(1, len(words)), max(1, len(text))
        marks = octets[33:48].sum() + octets[58:65].sum() + octets[91:97].sum() + octets[123:127].sum()
        return [
            len(hits) / n,
            float(np.log1p(len(hits) + len(spelled))),
            float(np.log1p(len({found[i][2] for i in hits}))),
            float(np.log1p(sum(found[i][1] for i in hits))),
            hidden / n,
            float(np.log1p(hidden)),
            int(np.count_nonzero(far)) / n,
            len(person) / n,
            octets[65:91].sum() / chars,
            int(np.count_nonzero(kinds & 8)) / n,
            octets[33] / n,
            marks / chars,
            int(np.count_nonzero(kinds & 16)) / n,
            float(np.log1p(len(words))),
        ]


def _draw(labels: DataFrame, most: int, seed: str) -> DataFrame:
    """About ``most`` rows of each class at most, by a hash of doc_id."""
    counts = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    toxic, other = (min(1.0, most / max(1, counts.get(kind, 0))) for kind in (1, 0))
    share = F.when(F.col("toxic") == 1, toxic).otherwise(other)
    draw = F.conv(F.substring(hash_order(seed), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)
    return labels.where(draw < share)


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic 0 or 1) of documents that are not held out; of several labels the largest counts."""
    rows = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("toxic").isNotNull() & ~held_out(5, 0))
    return rows.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def mine_lexicon(docs: DataFrame, labels: DataFrame, rows: int = LEXICON_ROWS, most: int = LEXICON_TERMS) -> Lexicon:
    """The terms that set toxic training texts apart, from a bounded sample's whole texts."""
    sample = small_side(_draw(labels, rows, "lexicon-1").withColumnRenamed("doc_id", "id"))
    texts = docs.join(sample, F.col("doc_id") == F.col("id")).select("text", "toxic").where("text is not null")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                counts[toxic].update([*terms(text), ""])
        for toxic in (0, 1):
            n = len(counts[toxic])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(counts[toxic].keys(), pa.string()),
                    pa.array(counts[toxic].values() if toxic else [0] * n, pa.int64()),
                    pa.array([0] * n if toxic else counts[toxic].values(), pa.int64()),
                ],
                ["term", "toxic", "other"],
            )

    counts = texts.mapInArrow(counted, "term string, toxic bigint, other bigint")
    counts = staged(counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "toxicity-terms")
    total = counts.where("term = ''").first()
    if total is None:
        return Lexicon({})
    ratio = (F.col("toxic") + 0.5) / (total["toxic"] + 1) / ((F.col("other") + 0.5) / (total["other"] + 1))
    best = counts.where("term <> ''").withColumn("ratio", ratio).where((F.col("toxic") >= MIN_TEXTS) & (F.col("ratio") >= MIN_RATIO))
    best = best.orderBy((F.col("toxic") * F.log("ratio")).desc(), "term").limit(most)
    return Lexicon({r["term"]: float(np.log(r["ratio"])) for r in best.collect()})


def featured(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, held_out, one column for each of ``FEATURES``) of every row; a null text counts as empty."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [lexicon.features(x.as_py() or "") for x in batch.column(2)]
            columns = np.array(rows, np.float64).reshape(-1, len(FEATURES)).T
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *map(pa.array, columns)], ["doc_id", "held_out", *FEATURES])

    rows = docs.select("doc_id", held_out(5, 0).alias("held_out"), "text")
    return rows.mapInArrow(vectors, "doc_id bigint, held_out boolean, " + ", ".join(f"{f} double" for f in FEATURES))


def _raw(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def _grown(rows: DataFrame, labels: DataFrame) -> tuple[GBTClassificationModel, IsotonicRegressionModel] | None:
    """Trees and calibration from a bounded draw of labelled rows; None unless both classes occur."""
    drawn = small_side(_draw(labels, TREE_ROWS, "trees-1").withColumnRenamed("doc_id", "id"))
    train = rows.join(drawn, F.col("doc_id") == F.col("id")).withColumn("label", F.col("toxic").cast("double"))
    part = F.pmod(F.conv(F.substring(hash_order("parts-1"), 1, 8), 16, 10).cast("bigint"), F.lit(CALIBRATION_PART)) == 0
    train = staged(train.select("doc_id", *FEATURES, "label", part.alias("calibrates")), "toxicity-train")
    if train.where("not calibrates").select("label").distinct().count() < 2:
        return None
    train = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train)
    grower = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=5, seed=7)
    trees = grower.fit(train.where("not calibrates").select("features", "label").coalesce(4))
    rest = _raw(train.where("calibrates"), trees)
    if rest.isEmpty():
        rest = _raw(train, trees)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(rest)
    return trees, calibration


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text), learned from ``labels``
    (doc_id, toxic); other columns are ignored.

    Labels of held-out documents, of missing documents and null labels teach nothing; without labels of both
    kinds every score is 0. A null text is scored as empty; equal texts have equal scores. A row without
    doc_id is held out. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = staged(training_labels(labels), "toxicity-labels")
    vectors = staged(featured(rows, mine_lexicon(rows, known)), "toxicity-features")
    model = _grown(vectors, known)
    if model is None:
        return vectors.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    trees, calibration = model
    raw = _raw(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(vectors), trees)
    # Calibration has plateaus; a thousandth of the raw score keeps the trees' order on them.
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("prediction") + 0.001 * F.col("raw")))
    scored = calibration.transform(raw).select("doc_id", "held_out", score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
