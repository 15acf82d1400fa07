"""Features of the toxicity scores restated word by word, and edge rows through a fitted model."""

import math
import random
import re

import pytest

from trafficlake.llm.toxicity import FEATURES, Lexicon, featured, score_toxicity

WEIGHTS = {"=zorb": 2.0, "grump": 3.5, "=you": 1.25, "bleak": 2.75}
PERSON = {"you", "your", "du", "tu", "vous", "usted"}
WORDS = ["zorb", "zorbs", "GRUMPY", "gr.ump", "bl3aky", "you", "Your", "du", "hello", "WORLD!", "a-b", "x1", "!!", "9", "don't", "z0rb,", "été"]
MARKS = set(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def letters(word):
    return "".join(c for c in word.lower() if c.isalpha())


def found_in(word):
    """The heaviest term that a word of letters is or begins with, the whole word first."""
    best = (0.0, None)
    for term in ["=" + word, word[:4], word[:5], word[:6]]:
        if (term[:1] == "=" or len(term) in (4, 5, 6)) and WEIGHTS.get(term, 0) > best[0]:
            best = (WEIGHTS[term], term)
    return best


def restated(text):
    words, hits, hidden, shouted, odd = text.split(), {}, 0, 0, 0
    person = [i for i, w in enumerate(words) if letters(w) in PERSON]
    for i, word in enumerate(words):
        inner = word.strip(".,;:!?()[]{}\"'»«…-—*%$#&")
        mixed = letters(word) != "" and any(not c.isalpha() for c in inner.replace("'", ""))
        shouted += len(inner) > 2 and inner.isupper()
        odd += mixed
        weight, term = found_in(letters(word))
        if not weight and mixed:
            swapped = "".join(dict(zip("013457@$!|", "oieastasil")).get(c, c) for c in inner)
            weight, term = found_in(letters(swapped))
            hidden += weight > 0
        if weight:
            hits[i] = (weight, term)
    spelled = re.findall(r"(?<![^\W_])(?:[^\W\d_][\s.\-_*]){2,}[^\W\d_](?![^\W_])", text)
    spelled = sum(found_in(letters(s))[0] > 0 for s in spelled)
    near = sum(any(abs(i - p) <= 5 for p in person) for i in hits)
    n, chars = max(1, len(words)), max(1, len(text))
    return {
        "hit_rate": len(hits) / n,
        "hits": math.log1p(len(hits) + spelled),
        "hit_kinds": math.log1p(len({t for _, t in hits.values()})),
        "hit_weight": math.log1p(sum(w for w, _ in hits.values())),
        "hidden_rate": (hidden + spelled) / n,
        "hidden_hits": math.log1p(hidden + spelled),
        "near_rate": near / n,
        "person_rate": len(person) / n,
        "capital_rate": sum("A" <= c <= "Z" for c in text) / chars,
        "shout_rate": shouted / n,
        "bang_rate": text.count("!") / n,
        "punctuation_rate": sum(c in MARKS for c in text) / chars,
        "odd_word_rate": odd / n,
        "length": math.log1p(len(words)),
    }


def test_features_of_random_texts(spark):
    draw = random.Random(5)
    texts = [" ".join(draw.choices(WORDS, k=draw.randrange(40))) for _ in range(300)]
    texts += ["", "z o r b", "say z.o.r.b now, you", "Z-O-R-B!!", "   ", "you " * 7 + "zorb"]
    docs = spark.createDataFrame([*enumerate(texts), (len(texts), None)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in featured(docs, Lexicon(WEIGHTS)).collect()}
    assert len(rows) == len(texts) + 1
    for i, text in enumerate([*texts, ""]):
        wanted = restated(text)
        assert [rows[i][f] for f in FEATURES] == pytest.approx([wanted[f] for f in FEATURES], abs=1e-12), text


def test_edge_rows_through_a_fitted_model(spark):
    toxic = [(i, f"plain words number {i} " + ("you zorbly thing" if i % 4 == 0 else "and more of them")) for i in range(400)]
    edges = [(None, None), (None, "zorbly"), (900, None), (901, ""), (902, " \t\n"), (903, "zorbly you " * 50_000), (904, "same"), (904, "same")]
    docs = spark.createDataFrame(toxic + edges, "doc_id bigint, text string").selectExpr("*", "'x' as raw", "1 as label", "true as features")
    labels = spark.createDataFrame(
        [(i, int(i % 4 == 0)) for i, _ in toxic] + [(None, 1), (901, None), (5_000, 1), (0, 0)], "doc_id bigint, toxic int"
    )
    rows = score_toxicity(docs, labels).collect()
    assert len(rows) == len(toxic) + len(edges)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[900][0]["score"] == by_id[901][0]["score"] < 0.5
    assert by_id[903][0]["predicted"] == 1 and len({r["score"] for r in by_id[904]}) == 1
    assert all(r["held_out"] for r in by_id[None])
