"""Cases in which an operator once did less than its whole job."""

import base64
import difflib
import hashlib
import itertools
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import exact_groups, one_scratch_folder
from trafficlake.llm import common, doc_fingerprints, packing
from trafficlake.llm.common import passing_tables, staged, table
from trafficlake.llm.doc_fingerprints import fingerprints
from trafficlake.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from trafficlake.llm.html_text import main_text
from trafficlake.llm.language_id import Model, fit, identified, keep_identified
from trafficlake.llm.near_dedup import drop_near_duplicates
from trafficlake.llm.prefix_hash import PrefixHash, likeness

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def speaker():
    """A model of the supplied documents: every text of the first 150 of each language, 40 of them landmarks."""
    rows = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    rows = sorted((r["lang"], r["doc_id"], r["text"]) for r in rows if r["lang"] and r["text"])
    rank, texts, labels, landmarks = {}, [], [], []
    for lang, _, text in rows:
        rank[lang] = rank.get(lang, 0) + 1
        if rank[lang] <= 150:
            if rank[lang] <= 40:
                landmarks.append(len(texts))
            texts.append(text)
            labels.append(lang)
    return Model(texts, labels, landmarks)


UNLEARNED = [
    "Badania wykazały, że zwierzęta domowe mogą poprawić zdrowie osób starszych mieszkających samotnie w miastach.",
    "Tutkimus on osoittanut, että lemmikkieläimet voivat parantaa yksin asuvien iäkkäiden ihmisten terveyttä.",
    "Araştırmalar evcil hayvanların büyük şehirlerde yalnız yaşayan yaşlı insanların sağlığını iyileştirdi.",
    "Исследования показали, что домашние животные могут улучшить здоровье пожилых людей.",
    "Η έρευνα έδειξε ότι τα κατοικίδια ζώα μπορούν να βελτιώσουν την υγεία.",
    "研究表明，宠物可以改善独自生活在大城市的老年人的健康状况。",
]
CLEAN = [
    "Research has shown that pets can improve the health of older people who live alone in the large cities.",
    "Die Forschung hat gezeigt, dass Haustiere die Gesundheit älterer Menschen verbessern können.",
    "La recherche a montré que les animaux de compagnie peuvent améliorer la santé des personnes âgées.",
    "La investigación ha demostrado que las mascotas pueden mejorar la salud de las personas mayores.",
    "This.",
    "on the other hand",
    "x",
]


def test_language_rejects_what_it_never_learned(speaker):
    rng = random.Random(1)
    letters = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)) for n in (20, 50, 500)]
    coded = [base64.b64encode(rng.randbytes(n)).decode() for n in (60, 200, 5000)]
    assert identified(UNLEARNED + letters + coded, speaker) == [False] * 12
    assert identified(CLEAN + ["", None, "12 !"], speaker) == [True] * len(CLEAN) + [False] * 3


STORY = [f"Paragraph {i} of the story has a good many words, enough of them to look like the text of an article does." for i in range(8)]
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in STORY)
LINKS = "<ul>" + "".join(f'<li><a href="/{i}">Source number {i}</a></li>' for i in range(5)) + "</ul>"
SOURCES = [f"Source number {i}" for i in range(5)]


@pytest.mark.parametrize("name", ["cards", "trending", "widget"])
def test_html_story_outside_the_marked_articles(name):
    teasers = f'<div class="{name}">' + "<article><h3>Card</h3><p>A few words on another story.</p></article>" * 4 + "</div>"
    page = f"<html><body><nav>Menu</nav><div>{PARAGRAPHS}</div>{teasers}<footer>Foot</footer></body></html>"
    assert main_text(page) == "\n".join(STORY)


def test_html_article_keeps_out_what_is_less_dense():
    page = f"<body><div>Free delivery on all orders over fifty.</div><article>{PARAGRAPHS}</article><div>All rights reserved.</div></body>"
    assert main_text(page) == "\n".join(STORY)
    assert main_text("<body><div>All rights reserved by the owner.</div><article><p>Short.</p></article></body>") == "Short."


@pytest.mark.parametrize(
    "opening, closing",
    [
        ('<div class="content-sidebar-wrap"><main>', "</main></div>"),
        ('<article class="post comments-open">', "</article>"),
        ('<div class="elementor-widget-container">', "</div>"),
        ('<div class="content-sidebar-wrap"><div id="related">', "</div></div>"),
        ('<div class="post comments-closed">', "</div>"),
    ],
)
def test_html_class_words_only_reduce(opening, closing):
    assert main_text(f"<body>{opening}{PARAGRAPHS}{closing}</body>") == "\n".join(STORY)


def test_html_class_words_still_count():
    extra = '<div class="sidebar"><p>A few words beside the story.</p></div><div id="commentList">' + PARAGRAPHS + "</div>"
    for name in ("div", "article"):
        page = f"<body><{name}>{PARAGRAPHS}{extra}</{name}>{extra}</body>"
        assert main_text(page) == "\n".join(STORY)


@pytest.mark.parametrize("name", ["article", "div"])
def test_html_list_of_links_in_mid_article(name):
    page = f"<body><nav>{LINKS}</nav><{name}>{PARAGRAPHS}{LINKS}{PARAGRAPHS}</{name}><footer>{LINKS}</footer></body>"
    assert main_text(page) == "\n".join(STORY + SOURCES + STORY)


def test_html_list_of_links_at_the_end():
    assert main_text(f"<body><article>{PARAGRAPHS}{LINKS}</article>{LINKS}</body>") == "\n".join(STORY + SOURCES)


def _edited_copies():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(500)]
    text = " ".join(rng.choices(words, k=2000))
    pieces = [text[i : i + 1000] for i in range(0, len(text), 1000)]
    other = " ".join("".join(rng.choices("qrstuvwxyz", k=5)) for _ in range(2000))
    return text, "One line more.\n" + text + "\nAnd one at the end.", " inserted ".join(pieces), "x" + "".join(p[5:] for p in pieces), other


def test_fingerprints_see_shifted_text():
    text, *copies, other = _edited_copies()
    whole = PrefixHash(text)
    for copy in copies:
        assert 0.95 < whole.shared(PrefixHash(copy)) < 1 and 0.95 < PrefixHash(copy).shared(whole) < 1
        assert 0.7 < likeness(whole.fingerprint(), PrefixHash(copy).fingerprint()) < 1
    assert whole.shared(PrefixHash(other)) < 0.01 and likeness(whole.fingerprint(), PrefixHash(other).fingerprint()) < 0.01
    assert whole.shared(PrefixHash(text + text)) == pytest.approx(0.5) and whole.shared(PrefixHash("")) == 0
    assert PrefixHash("").shared(PrefixHash("")) == whole.shared(PrefixHash(text)) == 1
    assert PrefixHash("ab").shared(PrefixHash("xab")) == pytest.approx(2 / 3)


def test_fingerprint_query_sees_shifted_text(spark):
    text, *copies, other = _edited_copies()
    rows = [(9, other), (8, text), (7, copies[0]), (6, text), (5, copies[1])]
    found = {r["doc_id"]: r for r in fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(0.95 < found[i]["shared_next"] < 1 for i in (8, 7, 6)) and found[9]["shared_next"] < 0.01
    assert all(0.7 < found[i]["near_next"] < 1 for i in (8, 7, 6)) and found[9]["near_next"] < 0.01


FRAMED_STORY = [f"Paragraph {i} of the story goes on for long enough to be told from what a page has besides, word after word." for i in range(6)]
FRAMED_SEARCH = '<form action="/find"><label>Search this site</label><input name="q"><button>Go</button></form>'
FRAMED_NOTICE = '<div role="dialog"><p>We use cookies to keep you signed in.</p><button>Accept</button></div>'


@pytest.mark.parametrize("story", ["<article>{}</article>", "<div>{}</div>", "<main><h1>Title</h1>{}</main>"])
@pytest.mark.parametrize("frame", ['<form method="post" action="./page.aspx">{}</form>', '<div role="dialog">{}</div>', "<dialog open>{}</dialog>", '<div role="form">{}</div>'])
def test_a_frame_does_not_swallow_the_article(frame, story):
    """Pages that are one form, or a dialog, as some servers write them; a real search form and a notice still go."""
    text = "".join(f"<p>{x}</p>" for x in FRAMED_STORY)
    rest = "<nav><a href=1>Home</a> <a href=2>News</a></nav>" + FRAMED_SEARCH * ("form" not in frame) + FRAMED_NOTICE * ("dialog" not in frame)
    page = f"<html><body>{frame.format(rest + story.format(text) + '<footer>Imprint</footer>')}</body></html>"
    expected = ["Title"] * ("h1" in story) + FRAMED_STORY
    assert main_text(page) == "\n".join(expected)


def test_forms_beside_the_story_go():
    text = "".join(f"<p>{x}</p>" for x in FRAMED_STORY)
    contact = "<form><p><label>Your name</label><input></p><p><label>Your message</label><textarea>" + "x" * 200 + "</textarea></p><p>Send</p></form>"
    page = f"<html><body>{FRAMED_SEARCH}<div>{text}</div>{contact}{FRAMED_NOTICE}</body></html>"
    assert main_text(page) == "\n".join(FRAMED_STORY)


def test_likeness_follows_the_returned_fingerprints(spark):
    """near_* are what a user gets from the two fingerprints, and on average close to the plain share in common."""
    docs = table(spark, SF_DIR, "documents")
    rows = fingerprints(docs).collect()
    prints = {r["doc_id"]: r["fingerprint"] for r in rows}
    order = sorted(prints, reverse=True)
    following = dict(zip(order, [*order[1:], order[0]]))
    assert all(r["near_edited"] == likeness(r["fingerprint"], r["edited_fingerprint"]) for r in rows)
    assert all(r["near_next"] == likeness(r["fingerprint"], prints[following[r["doc_id"]]]) for r in rows)
    assert np.mean([abs(r["near_edited"] - r["shared_edited"]) for r in rows]) < 0.05
    assert np.mean([abs(r["near_next"] - r["shared_next"]) for r in rows]) < 0.05


def _plain_share(a, b, least):
    """The share of the longer text in matching blocks of at least ``least`` characters, found one after the other."""
    found, todo = 0, [(0, len(a), 0, len(b))]
    matcher = difflib.SequenceMatcher(None, a, b, autojunk=False)
    while todo:
        i0, i1, j0, j1 = todo.pop()
        block = matcher.find_longest_match(i0, i1, j0, j1)
        if block.size >= least:
            found += block.size
            todo += [(i0, block.a, j0, block.b), (block.a + block.size, i1, block.b + block.size, j1)]
    return found / max(len(a), len(b), 1)


def test_shares_against_plain_matching(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF_DIR, "documents").collect()}
    rows = {r["doc_id"]: r for r in fingerprints(table(spark, SF_DIR, "documents")).collect()}
    order = sorted(texts, reverse=True)
    short = [(a, b) for a, b in zip(order, order[1:]) if 0 < len(texts[a]) < 700 and 0 < len(texts[b]) < 700][:120]
    assert len(short) > 30
    gaps = []
    for a, b in short:
        half = len(texts[a]) // 2
        edited = texts[a][: len(texts[a]) - half] + texts[b][:half]
        gaps.append(abs(rows[a]["near_edited"] - _plain_share(texts[a], edited, 32)))
    assert np.mean(gaps) < 0.1


def test_few_sizes_after_grouping():
    """Large pieces are rounded up within equal-cardinality classes: no more sizes than classes, few more sequences."""
    lengths = np.random.default_rng(1).integers(1, 1024, size=60_000)
    sizes = []
    plain = packing._fullest

    def fullest(counts, largest, capacity):
        sizes.append(set(counts))
        return plain(counts, largest, capacity)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(packing, "_fullest", fullest)
        sequence, offset = packing.plan(lengths)
    assert len(sizes[0]) <= packing.CLASSES < len(set(lengths[lengths > 128].tolist()))
    used = np.bincount(sequence, weights=lengths)
    assert used.max() <= 1024 and len(used) <= 1.005 * np.ceil(lengths.sum() / 1024)
    assert (offset + lengths <= 1024).all()


def test_identical_rows_are_dealt_to_several_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    rows = spark.createDataFrame([(1, "the same text")] * 400, "doc_id bigint, text string")
    out = packing.pack(rows).collect()
    assert len(out) == 400 and len({r["sequence_id"] >> 40 for r in out}) > 4


def test_columns_named_like_helpers_stay(spark):
    """Operators that keep all columns of the documents keep those with names that helpers could have."""
    names = ["__key", "own_key", "_own_key", "__id", "__k", "listed_id", "LISTED_KEY", "__row", "__label", "place", "n_rows", "size", "sha", "sender"]
    rows = [(i, f"text {'same' if i < 3 else i} de la casa", "en", *[f"{n}{i}" for n in names]) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    docs = docs.drop("listed_id").withColumn("listed_id", F.lit("x"))
    for kept in (drop_exact_duplicates(docs), drop_near_duplicates(docs), keep_identified(docs, fit(docs))):
        assert kept.columns == docs.columns
        for row in kept.collect():
            assert all(row[n] == f"{n}{row['doc_id']}" for n in names if n != "listed_id") and row["listed_id"] == "x"


def test_rows_that_are_no_suspects_are_not_joined_again(spark, plan):
    docs = spark.createDataFrame([(i, f"text {i % 50}") for i in range(60)], "doc_id bigint, text string")
    text = plan(exact_duplicates(docs))
    after = text[text.index("Union") :].splitlines()[1:]
    indent = after[0].index(":")
    # The first branch of the union, from the written rows on.
    alone = "\n".join(itertools.takewhile(lambda line: line[indent : indent + 1] == ":", after))
    assert "Exchange" not in alone and "Join" not in alone and "Scan parquet" in alone


def test_senders_of_many_rows_send_in_parts(spark, monkeypatch):
    from trafficlake.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "ROWS_PER_SENDER", 7)
    texts = {i: f"text {i % 23}  " + " " * (i % 3) for i in range(100)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1)
    found = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_duplicates(docs).collect()}
    assert found == exact_groups(texts)


def test_passing_tables_are_removed(spark, tmp_path, monkeypatch):
    left = one_scratch_folder(monkeypatch, tmp_path / "scratch", common)
    staged(spark.range(3), "kept")
    with pytest.raises(RuntimeError):
        with passing_tables(spark):
            assert staged(spark.range(3), "outer").count() == 3
            with passing_tables(spark):
                staged(spark.range(3), "inner")
                assert left() == ["inner", "kept", "outer"]
            assert left() == ["kept", "outer"]
            raise RuntimeError
    assert left() == ["kept"]


def _plain_language_scores(texts, labels, landmarks, asked):
    """Kernel ridge regression on landmarks, from sets of n-grams and the kernel matrix alone."""
    letters = {c for t in texts for c in t.lower() if c.isalpha()}

    def grams(text):
        codes = "".join(c if c in letters else "?" if c.isalpha() else " " for c in text.lower())
        return {codes[i : i + n] for n in (1, 2, 3) for i in range(len(codes) - n + 1)}

    known = set().union(*(grams(texts[i]) for i in landmarks))
    sets = [grams(t) & known for t in [*texts, *asked]]
    marks = [sets[i] for i in landmarks]
    kernel = np.array([[len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1)) for b in marks] for a in sets])
    values, vectors = np.linalg.eigh(kernel[landmarks])
    keep = values > 1e-6 * values[-1]
    features = np.column_stack([kernel @ (vectors[:, keep] / np.sqrt(values[keep])), np.ones(len(sets))])
    x, rest = features[: len(texts)], features[len(texts) :]
    languages = sorted(set(labels))
    scores = []
    for language in languages:
        y = np.array([1.0 if x == language else -1.0 for x in labels])
        # The penalty as further rows of a least-squares problem.
        penalty = np.diag([np.sqrt(1e-3 * len(texts))] * (x.shape[1] - 1) + [np.sqrt(1e-9)])
        weights = np.linalg.lstsq(np.vstack([x, penalty]), np.append(y, np.zeros(x.shape[1])), rcond=None)[0]
        scores.append(rest @ weights)
    return languages, np.array(scores).T


def test_language_scores_against_kernel_ridge_from_sets():
    rows = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    rows = [(r["text"][:600], r["lang"]) for r in rows if r["lang"] and r["text"]]
    texts, labels = zip(*rows[:160])
    landmarks = list(range(0, 160, 8))
    asked = [t for t, _ in rows[200:260]] + UNLEARNED
    model = Model(list(texts), list(labels), landmarks)
    languages, expected = _plain_language_scores(texts, labels, landmarks, asked)
    assert model.languages == languages
    assert model.scores([model.found(t) for t in asked]) == pytest.approx(expected, abs=2e-3)


def test_texts_put_together_from_two_beginnings():
    """Arrays, spans and fingerprint of an edited text follow from those of the two texts."""
    rng = random.Random(4)
    text, other = ("".join(rng.choices("abcd \U0001f600\n", k=k)) for k in (900, 700))
    for a, b in [(text, other), (text, ""), ("", other), ("", ""), (text[:31], other[:40]), ("x", "y"), (text, text)]:
        for keep, take in [(len(a) - len(a) // 2, len(a) // 2), (0, 5), (len(a), 40), (3, 2000)]:
            made, plain = PrefixHash(a).edited(keep, PrefixHash(b), take), PrefixHash(a[:keep] + b[:take])
            assert made.fingerprint() == plain.fingerprint() and made.n == plain.n
            assert np.array_equal(made.spans(), plain.spans()) and made.shared(plain) == 1
            assert all(map(np.array_equal, made.prefix, plain.prefix))


def _ranges(spark, rows):
    """The rows in the order they are compared in, by place."""
    places = {}
    for r in doc_fingerprints._in_order(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        places.setdefault(r["place"], []).append((r["guest"], r["doc_id"], r["text"]))
    return places


def test_one_id_does_not_fill_a_range(spark):
    """Rows with one id, or none, go to several ranges, and each row still meets exactly one next row, in a ring."""
    rows = [(None, f"nameless {i}") for i in range(400)] + [(7, f"seven {i}") for i in range(400)]
    rows += [(i, f"text {i}") for i in range(1000, 1400)] + [(7, "seven 3"), (None, "nameless 5")]
    places = _ranges(spark, rows)
    assert max(len(x) for x in places.values()) < len(rows) / 4
    assert sum(len({x[1] for x in p} & {7}) for p in places.values()) > 1
    own = [x[1:] for place in sorted(places) for x in places[place] if not x[0]]
    assert sorted(own, key=str) == sorted(rows, key=str)
    assert [i for i, _ in own] == sorted((i for i, _ in own), key=lambda i: -1 if i is None else i, reverse=True)
    order = sorted(places)
    for place, following in zip(order, [*order[1:], order[0]]):
        first = next(x[1:] for x in places[following] if not x[0])
        assert {x[1:] for x in places[place] if x[0]} == {first}
    found = fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in rows)
    following = dict(zip(own, [*own[1:], own[0]]))
    edited = {hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for (_, t), (_, n) in following.items()}
    assert edited <= {r["edited_sha256"] for r in found}


def test_ranges_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(doc_fingerprints, "RANGE_BYTES", 1000)
    assert 32 <= len(_ranges(spark, [(i, "x" * 100) for i in range(640)])) <= 64
