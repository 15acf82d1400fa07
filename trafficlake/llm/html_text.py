"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block of the page. A line weighs as much as the text in it that is
neither a link nor inside an element that cannot be article text (menu, footer, form, comments and the like).
Weights are summed over a sliding window of lines; where the sum surges above a threshold the main text
begins, where it dives to it the text ends, and the lines between are kept.

Markup only discounts the sums: lines whose element has a class or id of page furniture count less, and so do
lines outside the article or main elements of a page that has any. Lines are of one kind if their discounts
agree. The kind with the highest sum sets the threshold; a kind that is discounted more must be denser than
that kind usually is. Article elements that hold text are kept from end to end.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from statistics import median
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines on each side that a window takes in.
REACH = 1
#: The threshold: this share of the highest sum, and characters at most.
THRESHOLD_SHARE, THRESHOLD_CHARS = 1 / 8, 60
#: What a line outside all marked articles, and one in an element named as furniture, counts.
OUTSIDE_SHARE, NAMED_SHARE = 1 / 2, 1 / 5
#: Beside a denser story outside, a marked article is kept if it has so much of the story's text.
TEASER_SHARE = 1 / 4

# Elements of HTML by their place in a page, and words that name page furniture.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
)
#: Divisions of a page.
_BOXES = frozenset("article body div main section td".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEAD = frozenset("base link meta noscript script style template title".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_NEVER = frozenset(
    "aside audio button canvas datalist fieldset footer head iframe map menu nav noembed noframes noscript "
    "object option script search select style svg template textarea title video".split()
)
_NEVER_ROLES = frozenset(
    "alert banner complementary contentinfo menu menubar navigation search toolbar".split()
)
#: Elements and roles that hold a page's controls and notices, but may as well hold the whole page.
_HOLDERS = frozenset("dialog form".split())
_HOLDER_ROLES = frozenset("alertdialog dialog form".split())
#: A class or id made of the first words, with or without the second, names a container of comments.
_COMMENT_WORDS = frozenset("comment comments commentlist commentary discussion disqus reply replies respond".split())
_COMMENT_PARTS = frozenset(
    "area article block body box children container content form inner item list page post reader section site text thread "
    "user wrap wrapper".split()
)
#: A class or id with one of these tells of a state, or of what else the page has.
_STATE_WORDS = frozenset("closed count disabled enabled has no off on open with without".split())
_OFTEN_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs consent cookie cookies "
    "copyright dropdown footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notification overlay pager pagination paywall popular popup promo promoted promotion recommendations recommended register "
    "related search share sharing sidebar signin signup social sponsor sponsored subscribe subscription toolbar topbar trending widget widgets".split()
)
_ARTICLE_WORDS = frozenset("article content entry post story title".split())
#: An element of the first kind ends an open one of itself, up to the elements of the second.
_SELF_ENDING = {
    "li": {"ul", "ol", "menu", "dir"},
    "dt": {"dl"},
    "dd": {"dl"},
    "tr": {"table", "thead", "tbody", "tfoot"},
    "td": {"tr", "table"},
    "th": {"tr", "table"},
    "option": {"select", "datalist"},
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

#: How surely text is no article's; of a silent element, one in the midst of a line, there is no text at all.
_SOFT, _HARD, _SILENT = 1, 2, 3


class Line(NamedTuple):
    text: str
    #: Characters outside links, -1 in an element that is never article text.
    weight: int
    #: In an element with a class or id of page furniture.
    named: bool
    #: The marked article or main element it is in, 0 outside.
    region: int
    #: The innermost division it is in.
    box: int
    #: In a form or dialog.
    held: bool


#: What ``_furniture`` says of a form or dialog; it counts as ``_SOFT``, or not at all where it is the page's frame.
_HOLDER = -1


def _furniture(name: str, attributes: str, in_article: bool) -> int:
    """How surely an element holds no article text: 0, ``_SOFT`` (dense text, or a marked article inside,
    overrules), ``_HOLDER`` or ``_HARD``."""
    if name in _NEVER:
        return _HARD
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    if name not in ("html", "body"):
        if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
            return _HARD
        if re.search(r"display\s*:\s*none", found.get("style", ""), re.I) or found.get("role", "").lower() in _NEVER_ROLES:
            return _HARD
        names = f"{found.get('class', '')} {found.get('id', '')}".split()
        parts = [set(filter(None, _WORD.split(_CAMEL.sub(" ", x).lower()))) for x in names]
        parts = [x for x in parts if not x & _STATE_WORDS]
        if any(x & _COMMENT_WORDS and x <= _COMMENT_WORDS | _COMMENT_PARTS for x in parts):
            return _HARD
        if name in ("main", "article"):
            return 0
        if name in _HOLDERS or found.get("role", "").lower() in _HOLDER_ROLES:
            return _HOLDER
        words = set().union(*parts)
        often = words & _OFTEN_WORDS
        if often and not (often <= {"header", "banner"} and (in_article or words & _ARTICLE_WORDS)):
            return _SOFT
    return _SOFT if name == "header" and not in_article else 0


def _lines(page: str, framed: bool = False) -> tuple[list[Line], set[int]]:
    """The page's lines, and those of its regions that are article elements. ``framed``: forms and dialogs that are in
    no other are what the page is in, and say nothing of their text."""
    lines: list[Line] = []
    stack: list[tuple[str, int, int, int, int, bool]] = []  # name, strength within, links, region, box, held
    buffer: list[str] = []
    state = (0, 0, 0, 0, False)  # strength, links, region, box, held
    link_chars, opened = 0, 0
    articles: set[int] = set()

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                weight = -1 if state[0] >= _HARD else max(0, len(text) - link_chars)
                lines.append(Line(text, weight, state[0] == _SOFT, *state[2:]))
            buffer.clear()
            link_chars = 0

    def close(depth: int) -> None:
        nonlocal state
        del stack[depth:]
        state = stack[-1][1:] if stack else (0, 0, 0, 0, False)

    def said(raw: str) -> None:
        nonlocal link_chars
        if state[0] == _SILENT:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if text:
            buffer.append(text)
            if state[1]:
                link_chars += len(text)

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        if token is None:
            said(page[at:])
            break
        if token.start() > at:
            said(page[at : token.start()])
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            if token[0].startswith("<![CDATA["):
                said(html.escape(token[0][9:].removesuffix("]]>")))
            continue
        if token[1] or token[4]:
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] != name:
                # The end of an inline element reaches no further than its block.
                depth = -1 if name not in _BLOCKS and stack[depth][0] in _BLOCKS else depth - 1
            if name in _BLOCKS:
                flush()
            if depth >= 0:
                close(depth)
            continue
        attributes = token[3] or token[6] or ""
        if name == "br":
            buffer.append("\n")
            continue
        if name in _BLOCKS:
            flush()
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] not in _BLOCKS:
                depth -= 1
            if depth >= 0 and stack[depth][0] == "p":
                close(depth)
            if name in _SELF_ENDING:
                kinds = {"td", "th"} if name in ("td", "th") else {"dt", "dd"} if name in ("dt", "dd") else {name}
                depth = len(stack) - 1
                while depth >= 0 and stack[depth][0] not in kinds | _SELF_ENDING[name]:
                    depth -= 1
                if depth >= 0 and stack[depth][0] in kinds:
                    close(depth)
            if name == "body":
                close(0)
        if stack and stack[-1][0] == "head" and name not in _HEAD:
            close(len(stack) - 1)
        if name in _RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if name in _VOID or attributes.endswith("/") and name in ("svg", "path"):
            continue
        strength, links, region, box, held = state
        own = _furniture(name, attributes, bool(region))
        if own == _HOLDER:
            own = 0 if framed and not held else _SOFT
            held = True
        if own == _HARD and name not in _BLOCKS and strength < _HARD:
            own = _SILENT
        opened += 1
        if name in ("article", "main") and not own and strength < _HARD:
            strength = 0
            if region not in articles:  # what an article has inside is its own
                region = opened
            if name == "article":
                articles.add(region)
        if name in _BOXES:
            box = opened
        stack.append((name, max(strength, own), links + (name == "a"), region, box, held))
        state = stack[-1][1:]
    flush()
    return lines, articles


def _dense(lines: list[Line], reach: int) -> list[bool]:
    """Whether each line's discounted window sum is above its threshold."""
    marked = any(line.region and line.weight >= 0 for line in lines)
    kinds = [(line.named, marked and not line.region) for line in lines]
    sums = []
    for i, line in enumerate(lines):
        near = range(max(0, i - reach), min(len(lines), i + reach + 1))
        total = sum(max(0, lines[j].weight) for j in near if kinds[j] == kinds[i] and lines[j].region == line.region)
        sums.append(total * (NAMED_SHARE if line.named else 1) * (OUTSIDE_SHARE if kinds[i][1] else 1))
    peaks: dict[tuple[bool, bool], float] = {}
    for kind, total, line in zip(kinds, sums, lines):
        if line.weight > 0 and (total > THRESHOLD_CHARS or not kind[1]):
            peaks[kind] = max(peaks.get(kind, 0), total)
    if not peaks:
        return [False] * len(lines)
    best = max(sorted(peaks), key=peaks.__getitem__)
    threshold = min(THRESHOLD_CHARS, peaks[best] * THRESHOLD_SHARE)
    usual = median(t for k, t, line in zip(kinds, sums, lines) if k == best and line.weight > 0 and t > threshold)
    story = sum(line.weight for k, t, line in zip(kinds, sums, lines) if k == best and line.weight > 0 and t > threshold)
    held: dict[int, int] = {}
    for line in lines:
        held[line.region] = held.get(line.region, 0) + max(0, line.weight)
    dense = []
    for kind, total, line in zip(kinds, sums, lines):
        least = threshold
        if kind[0] > best[0] or kind[1] > best[1]:
            least = max(usual, THRESHOLD_CHARS if kind[1] else 0)
        elif best[1] and line.region and held[line.region] < story * TEASER_SHARE:
            least = usual
        dense.append(total > least)
    return dense


def main_text(page: str | None, reach: int = REACH) -> str:
    """The blocks of the page's main text, joined by line feeds; empty if there are none."""
    if not page:
        return ""
    lines, articles = _lines(page)
    running = [line for line in lines if line.weight >= THRESHOLD_CHARS]
    held = sum(line.weight for line in running if line.held)
    if held and not articles and held > sum(line.weight for line in running if not line.held):
        lines, articles = _lines(page, framed=True)
    dense = _dense(lines, reach)
    core = [line.weight > 0 and own for line, own in zip(lines, dense)]
    inside = list(core)
    # Surge and dive mark where the sums cross the threshold. From there short lines are still text, past
    # furniture in between too, until lines of nothing but links come.
    for order in (range(len(core)), reversed(range(len(core)))):
        near, start = False, None
        for i in order:
            line = lines[i]
            if core[i]:
                near, start = True, line
            elif near and line.weight >= 0 and line.named <= start.named and line.region == start.region:
                near = line.weight > 0 or dense[i]
                inside[i] = inside[i] or near
    # Between two such places of one division every line is text, links too, and so it is in an article element.
    last: dict[tuple[int, int, bool], int] = {}
    for i, line in enumerate(lines):
        if core[i]:
            spot = (line.region, line.box, line.named)
            for j in range(last.get(spot, i) + 1, i):
                inside[j] = inside[j] or (lines[j].weight >= 0 and lines[j].named <= line.named and lines[j].region == line.region)
            last[spot] = i
    held = {line.region for line, own in zip(lines, core) if own} & articles
    kept = [x.text for x, own in zip(lines, inside) if own or (x.region in held and x.weight >= 0 and not x.named)]
    marked = [x for x in lines if x.region and x.weight >= 0]
    if marked and not any(core):  # an article of links only
        kept = [x.text for x in marked if not x.named]
    return "\n".join(kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html; other columns are ignored).

    A null or empty page, and one without main text, has the empty text and 0 characters; a null page_id or
    url stays null. Broken markup is read as browsers do in the common cases: open paragraphs, list items
    and table cells end with the next one, and unclosed comments, scripts and styles reach to the end.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(extracted, "page_id bigint, url string, text string, n_chars bigint")
