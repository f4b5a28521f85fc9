"""Main text of web pages: the contiguous region of the highest score.

A page is a sequence of words and tags. Words score positive, tags negative, with weights
learned from labelled pages, those whose markup names the article; one linear scan finds
the best-scoring stretch. Elements whose words are learned, or known by name, to stand
outside articles count little against a stretch, and their words are never part of it.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.llm.tables import set_aside, without

# Element names by the role HTML gives them, and words that sites use in
# class and id names for what is not the article.
ARTICLE = frozenset({"article", "main"})
NEVER = frozenset(
    "head title script style noscript template nav footer aside form menu dialog iframe "
    "object svg math canvas audio video select option textarea button datalist".split()
)
PAGE_HEADER = "header"
FORM = "form"
RAW = frozenset({"script", "style", "textarea", "title"})
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_BLOCK = "p"
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments cookie cookies disqus footer masthead menu modal nav navbar navigation "
    "newsletter notice popup promo promoted recommended related respond share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Elements that hold the page: names on them tell of the page, not of what they are.
WHOLE = frozenset({"html", "body", "main"})
# ``has-sidebar`` and ``comments-open`` are states of what bears the name.
STATE_BEFORE = frozenset("has no not with without".split())
STATE_AFTER = frozenset("closed disabled enabled open".split())

TAG = re.compile(
    r"""<(?:!--|(?P<other>[!?])|(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)
    (?:(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(?P<broken>[^>]*+)>))""",
    re.VERBOSE,
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PART = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
UNFINISHED = re.compile(r"<(?:[A-Za-z/!?][^<>]*)?\Z")


@dataclass
class Weights:
    """What the labelled pages teach: ``word``, tags by key, and keys that stand outside."""

    word: float = 1.0
    tags: dict[str, float] = field(default_factory=dict)
    outside: frozenset[str] = frozenset()

    #: A tag that the labelled pages do not have; words of elements outside the article.
    unknown: float = -0.3
    outer_word: float = -0.3
    #: The most that an element outside the article costs, however long it is.
    outer_box: float = -2.0


@dataclass
class Token:
    """Text with its words, or a tag with its key. ``outer``: the number from 1 on of the
    outermost element around it that stands outside, whose first tag counts as in it, 0
    for none; ``inner``: in the element that is labelled the article."""

    text: str | None
    key: str
    words: int
    outer: int
    inner: bool
    apart: bool = False


def keys_of(name: str, attributes: str) -> list[str]:
    """``name`` and ``name.part`` for each class, id or role of the tag."""
    keys = [name]
    if "=" in attributes:
        for m in NAMES.finditer(attributes):
            value = m[1] or m[2] or m[3] or ""
            keys += [f"{name}.{part.lower()}" for part in value.split()]
    return keys


def _names_outside(name: str) -> bool:
    """Whether a class, id or role says that what bears it is not the article."""
    parts = [p.lower() for p in PART.split(name)]
    for i, part in enumerate(parts):
        if part in OUTSIDE_NAMES:
            if STATE_BEFORE.isdisjoint(parts[:i]) and STATE_AFTER.isdisjoint(parts[i + 1 :]):
                return True
    return False


def _hinted(keys: list[str], attributes: str, known: frozenset[str]) -> bool:
    """Whether a name of the tag is learned, or known, to stand outside articles."""
    if len(keys) == 1:
        return False
    if not known.isdisjoint(keys[1:]):
        return True
    values = (m[1] or m[2] or m[3] or "" for m in NAMES.finditer(attributes))
    return any(_names_outside(part) for value in values for part in value.split())


@dataclass
class Element:
    """An element from its first to its last token. ``never``: outside by its own name;
    ``hint``: outside by a class, id or role, unless it holds the article."""

    name: str
    first: int
    never: bool
    hint: bool
    last: int = 0


def _exempt(elements: list[Element], page: list[Token]) -> None:
    """Take the hints off elements that hold the article, or three quarters of the words without one.

    The article is the ``article`` or ``main`` with most words, if it has a tenth of the
    page's. Words of elements that are outside by their own name do not count, but for
    forms: some sites put a form around the whole page, which then is none of the forms
    that stand outside. An article inside another one (a reader's comment) keeps its hints.
    """
    if not any(e.hint or e.name == FORM for e in elements):
        return
    depth = [0] * (len(page) + 1)
    for e in elements:
        if e.never and e.name != FORM:
            depth[e.first] += 1
            depth[e.last] -= 1
    sums, never = [0], 0
    for t, change in zip(page, depth):
        never += change
        sums.append(sums[-1] + (0 if never else t.words))
    articles = [e for e in elements if e.name in ARTICLE]
    chief = max(articles, key=lambda e: sums[e.last] - sums[e.first], default=None)
    if chief is not None and 10 * (sums[chief.last] - sums[chief.first]) < max(1, sums[-1]):
        chief = None
    end = 0  # of the articles so far
    for e in elements:
        if e.name in ARTICLE:
            if e.first >= end:
                e.hint = False
            end = max(end, e.last)
        if chief is not None:
            holds = e.first <= chief.first and chief.last <= e.last
        else:
            holds = 4 * (sums[e.last] - sums[e.first]) > 3 * sums[-1]
        if holds:
            e.hint = False
            e.never &= e.name != FORM


def tokens(html: str, known: frozenset[str] = frozenset()) -> list[Token]:
    """The page as tags and stretches of text.

    Elements that are never closed end where an enclosing element ends, paragraphs also
    where the next block begins. A comment or script without an end takes the rest.
    """
    page: list[Token] = []
    elements: list[Element] = []
    stack: list[Element] = []
    open_ = Counter()
    inner = 0
    at = 0

    def text(a: int, b: int) -> None:
        words = unescape(html[a:b])
        page.append(Token(words, "", len(words.split()), 0, inner > 0))

    def pop_to(name: str) -> None:
        nonlocal inner
        while stack:
            top = stack.pop()
            top.last = len(page)
            open_[top.name] -= 1
            inner -= top.name in ARTICLE
            if top.name == name:
                return

    end = len(html)
    while at < end:
        m = TAG.search(html, at)
        if m is None:
            tail = UNFINISHED.search(html, at)
            stop = tail.start() if tail else end
            if stop > at:
                text(at, stop)
            break
        if m.start() > at:
            text(at, m.start())
        at = m.end()
        if m["name"] is None:  # comment, declaration or instruction
            mark = ">" if m["other"] else "-->"
            found = html.find(mark, at)
            at = end if found < 0 else found + len(mark)
            continue
        name = m["name"].lower()
        if m["close"]:
            page.append(Token(None, f"/{name}", 0, 0, inner > 0, name not in INLINE))
            if open_[name]:
                pop_to(name)
            continue
        attributes = m["attributes"] if m["attributes"] is not None else m["broken"]
        keys = keys_of(name, attributes)
        if name not in INLINE and open_[CLOSED_BY_BLOCK] and stack[-1].name in INLINE | {CLOSED_BY_BLOCK}:
            pop_to(CLOSED_BY_BLOCK)
        page.append(Token(None, keys[-1], 0, 0, inner > 0, name not in INLINE))
        if name in VOID or attributes.endswith("/"):
            continue
        never = name in NEVER or (name == PAGE_HEADER and not inner)
        hint = name not in WHOLE and _hinted(keys, attributes, known)
        stack.append(Element(name, len(page), never, hint))
        elements.append(stack[-1])
        open_[name] += 1
        inner += name in ARTICLE
        if name in RAW:
            close = re.compile(rf"</{name}\b", re.IGNORECASE).search(html, at)
            at = close.start() if close else end
    for e in stack:
        e.last = len(page)
    _exempt(elements, page)
    end = box = 0
    for e in elements:
        if (e.never or e.hint) and e.first >= end:
            box += 1
            for t in page[e.first - 1 : e.last]:
                t.outer = box
            end = e.last
    return page


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last + 1 of the stretch with the highest positive sum, the first one."""
    best, span = 0.0, (0, 0)
    total, first = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, first = 0.0, i
        total += score
        if total > best:
            best, span = total, (first, i + 1)
    return span


def main_text(html: str, weights: Weights) -> str:
    """The words of the best region; blocks are divided by one space."""
    page = tokens(html, weights.outside)
    scores = []
    box, spent = 0, 0.0
    for t in page:
        if t.outer:
            if t.outer != box:
                box, spent = t.outer, 0.0
            # A box in a labelled article costs nothing, any other one no more than a bound.
            cost = 0.0 if t.inner else max(t.words * weights.outer_word, weights.outer_box - spent)
            spent += cost
            scores.append(cost)
        elif t.text is not None:
            scores.append(t.words * weights.word)
        else:
            scores.append(weights.tags.get(t.key, weights.unknown))
    first, last = best_region(scores)
    parts = []
    for t in page[first:last]:
        if t.text is not None:
            if not t.outer:
                parts.append(t.text)
        elif t.apart:
            parts.append(" ")
    return " ".join("".join(parts).split())


def count_labels(html: str) -> dict[str, list[int]]:
    """Tags and words by key inside and outside the labelled article, if there is one.

    ``tag key`` counts tags outside elements known to stand outside; ``words key`` the
    words below elements of a key.
    """
    found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    page = tokens(html)
    if not any(t.inner for t in page):
        return {}
    for t in page:
        if t.outer:
            continue
        if t.text is None:
            found[f"tag {t.key}"][0 if t.inner else 1] += 1
        else:
            found["word"][0 if t.inner else 1] += t.words
    for key, inner, words in _words_below(page):
        found[f"words {key}"][0 if inner else 1] += words
    return found


def _words_below(page: list[Token]) -> Iterator[tuple[str, bool, int]]:
    """Key, whether inside the article, and words of each named innermost element."""
    key = None
    for t in page:
        if t.text is None:
            if not t.key.startswith("/"):
                key = t.key
            elif key is not None and t.key[1:] == key.partition(".")[0]:
                key = None
        elif key and t.words:
            yield key, t.inner, t.words


def weights_from(counts: dict[str, tuple[int, int]], least_words: int = 50, share: float = 0.01) -> Weights:
    """Log-odds of each tag inside against outside, never positive, and the word's.

    Named elements (and header-like ones) whose words are seen often and almost never in
    an article stand outside. Without labelled pages the defaults hold.
    """
    inside = sum(v[0] for k, v in counts.items() if not k.startswith("words "))
    beyond = sum(v[1] for k, v in counts.items() if not k.startswith("words "))
    out = Weights()
    if not inside:
        return out
    w_in, w_out = counts.get("word", (0, 0))
    odds = math.log((w_in + 1) / (inside + 2)) - math.log((w_out + 1) / (beyond + 2))
    out.word = min(2.0, max(0.5, odds))
    for key, (a, b) in counts.items():
        if key.startswith("tag "):
            odds = math.log((a + 0.5) / (inside + 1)) - math.log((b + 0.5) / (beyond + 1))
            out.tags[key[4:]] = min(-0.05, max(-2.0, odds))
    out.outside = frozenset(
        key[6:]
        for key, (a, b) in counts.items()
        if key.startswith("words ") and "." in key and b >= least_words and a <= share * b
    )
    return out


def learn_weights(pages: DataFrame, sample: int = 2000) -> Weights:
    """Weights from at most ``sample`` labelled pages, those of the least id hashes."""
    labelled = F.lower("html").rlike("<(article|main)[\\s>]")
    ids = pages.where(labelled).select("page_id").where("page_id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    some = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0])
        for batch in batches:
            for html in batch.column("html").to_pylist():
                for key, (a, b) in count_labels(html or "").items():
                    sums[key][0] += a
                    sums[key][1] += b
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.string()),
                pa.array([v[0] for v in sums.values()], pa.int64()),
                pa.array([v[1] for v in sums.values()], pa.int64()),
            ],
            names=["key", "a", "b"],
        )

    rows = some.mapInArrow(count, "key string, a long, b long").groupBy("key").agg(F.sum("a"), F.sum("b"))
    return weights_from({k: (a, b) for k, a, b in rows.collect()})


def main_texts(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``, for every row.

    Character references are decoded, white space becomes single spaces. A null or empty
    page, or one without words outside menus and the like, has an empty text. Repeated
    rows are treated alike; a ``text`` column of ``pages`` is replaced.
    """
    pages, back = set_aside(without(pages, "text"), "page_id", "html")
    if weights is None:
        weights = learn_weights(pages)
    sent = weights

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html or "", sent) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "text"]
            )

    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType())])
    return pages.mapInArrow(extract, schema).select(*back.values(), "text")
