"""Page extraction, quote linking, revisits and the as-of join."""

import random

import pytest
from pyspark.sql import functions as F

from merchlens.llm import chat_quotes, html_extract, warc_revisit
from merchlens.llm.asof import latest_before
from merchlens.llm.html_extract import Weights, main_text

SITE = """<!DOCTYPE html><html><head><title>Title of the page</title><style>p{{}}</style>
<script>if (a < b) document.write("<p>no</p>")</script></head><body>
<header><a href="/">Home of the site</a></header><nav><ul><li><a>One</a></li><li><a>Two</a></li></ul></nav>
<div class="ad">Buy this very good thing now, it is on sale today.</div>
<article><h1>Head &amp; line</h1><p>First <b>bold</b> word,&nbsp;then
  more.</p><form><p>Your name</p><input></form><p>Second paragraph of {n} words<br>and a break.
<div class="comments"><p>A reader says something quite long here about it.</p></div></article>
<aside>Related matters of the side</aside><footer>&copy; all rights are kept</footer></body></html>"""
TEXT = "Head & line First bold word, then more. Second paragraph of {n} words and a break."


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://h/{k}", SITE.format(n=k)) for k in range(40)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "plain words only"), (None, "u", SITE.format(n=1))]
    return spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string")


def test_main_text_of_pages(pages):
    found = html_extract.main_texts(pages.withColumn("text", F.lit(3)).withColumn("key", F.lit("x")))
    rows = found.collect()
    assert len(rows) == 45 and set(found.columns) == {"page_id", "url", "html", "key", "text"}
    got = {r["page_id"]: r["text"] for r in rows}
    assert all(got[k] == TEXT.format(n=k) for k in range(40)) and got[None] == TEXT.format(n=1)
    assert (got[100], got[101], got[102]) == ("", "", "plain words only")


def test_no_pages(pages):
    assert html_extract.main_texts(pages.where("false")).count() == 0
    assert html_extract.learn_weights(pages.where("false")) == Weights()


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<p>one<p>two", "one two"),
        ("<p>a < b and 3 > 2</p>", "a < b and 3 > 2"),
        ("<p>in<b>ner</b> text</p>", "inner text"),
        ("<ul><li>a few words</li><li>and more of them</li></ul>", "a few words and more of them"),
        ("<p>start <!-- <p>no</p> --> end", "start end"),
        ("<p>start <!-- never closed", "start"),
        ("<p>words <script>var x = '</p>'", "words"),
        ("<p>cut off <a href='x", "cut off"),
        ("<nav>only a menu</nav>", ""),
        ('<div id="sidebar">no</div><p class="x">yes indeed</p>', "yes indeed"),
        ("<table><tr><td>cell one</td><td>cell two</td></tr></table>", "cell one cell two"),
        ("<p>&lt;b&gt; &#233;&eacute; &bogus;</p>", "<b> éé &bogus;"),
        ('<p title="a>b">quoted</p>', "quoted"),
        ("<p title='open>text</p>", "text"),
    ],
)
def test_markup(html, want):
    assert main_text(html, Weights()) == want


BODY = "The article itself has quite a few words to read here."


@pytest.mark.parametrize(
    "html",
    [
        '<html class="has-sidebar no-ads"><body class="single has-sidebar">{}</body></html>',
        '<body class="right-sidebar">{}</body>',
        '<body><div id="page-with-menu">{}</div></body>',
        '<div class="right-sidebar"><main class="share-enabled">{}</main></div>',
        '<article class="post comments-open">{}</article>',
        '<main class="related">{}</main>',
        '<div class="social">{}</div><div>few other</div>',
        '<div id="layout-menu"><article>{}</article></div><div class="topMenu">one two three</div>',
        '<div class="mainNav">one two three</div><section class="noSidebar">{}</section>',
        '<article>{}<div class="comments"><article class="comment">a reader says</article></div></article>',
    ],
)
def test_names_of_what_holds_the_article(html):
    page = html.replace("{}", f"<p>{BODY}</p>")
    assert main_text(page, Weights()).startswith(BODY)
    for word in ("one", "reader"):
        assert word not in main_text(page, Weights())


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>", "<body class='has-sidebar'>{}</body>"])
@pytest.mark.parametrize("box", ["aside", "form", "noscript", "select", "div class='comments'", "div class='promo'"])
def test_long_boxes_cut_nothing_off(wrap, box):
    lead, rest = " ".join(["lead"] * 40), " ".join(["rest"] * 200)
    long = f"<{box}>" + "<p>side words</p>" * 200 + f"</{box.split()[0]}>"
    weights = Weights(word=0.5)
    for a, b in ((lead, rest), (rest, lead)):
        page = wrap.format(f"<p>{a}</p>{long}<p>{b}</p>")
        assert main_text(page, weights) == f"{a} {b}"


@pytest.mark.parametrize("inside", ["<div>{}</div>", "<main>{}</main>", "<div><article>{}</article></div>"])
def test_form_around_the_page(inside):
    body = "<p>" + " ".join(f"w{k}" for k in range(300)) + "</p>"
    small = "<form class='newsletter'><p>Your mail address here</p></form><nav>Menu one two</nav>"
    page = f"<body><form id='f'>{small}{inside.format(body)}<select><option>one</option></select></form></body>"
    assert main_text(page, Weights()) == " ".join(f"w{k}" for k in range(300))


def test_pages_in_named_wrappers_are_learned_from():
    assert html_extract.count_labels(f'<body class="no-sidebar"><article><p>{BODY}</p></article>')["word"] == [11, 0]


def test_long_page_is_scanned_once():
    html = "<nav>" + "<b>" * 50_000 + "</nav>" + "<p>word " * 50_000 + "</i>" * 50_000
    assert main_text(html, Weights()) == " ".join(["word"] * 50_000)


def test_best_region():
    assert html_extract.best_region([1, -2, 3, -1, 2, -9, 3]) == (2, 5)
    assert html_extract.best_region([-1.0, 0.0]) == (0, 0)
    rng = random.Random(4)
    for _ in range(100):
        scores = [rng.choice([-2.0, -1.0, 1.0, 2.0]) for _ in range(rng.randrange(12))]
        a, b = html_extract.best_region(scores)
        best = max([0.0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
        assert sum(scores[a:b]) == best


# ---------------------------------------------------------------- quotes

CHAT = [
    (1, 0, "user", "How do I sort a list?\nIt has numbers."),
    (1, 1, "assistant", "Use sorted.\nIt returns a new list."),
    (1, 2, "user", "> How do I sort a list?\nIn place, I mean."),
    (1, 3, "assistant", ">> how do  I *sort* a list?\n> In place, I mean.\nThen call sort.\n\n"),
    (1, 4, "user", "> Use sorted.\n> It returns a new list.\n> In place, I mean.\nThanks for both."),
    (1, 5, "user", "> nobody wrote this\nok"),
    (2, 7, "user", "> How do I sort a list?\nOther conversation."),
    (2, 7, "user", "> How do I sort a list?\nOther conversation."),
    (3, 0, None, None),
    (None, 0, "user", "> x\ny"),
    (4, None, "user", "z"),
]


def test_links(spark):
    rows = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    linked = chat_quotes.linked_messages(rows.withColumn("level", F.lit(9)))
    got = {(r["conv_id"], r["turn"]): (r["body"], r["n_quoted"], r["n_matched"], r["reply_to"]) for r in linked.collect()}
    assert linked.count() == 10
    assert got[1, 0] == ("How do I sort a list?\nIt has numbers.", 0, 0, None)
    assert got[1, 1][3] == 0
    assert got[1, 2] == ("In place, I mean.", 1, 1, 0)
    assert got[1, 3] == ("Then call sort.", 2, 2, 2)
    assert got[1, 4] == ("Thanks for both.", 3, 3, 1)
    assert got[1, 5] == ("ok", 1, 0, 4)
    assert got[2, 7] == ("Other conversation.", 1, 0, None)
    assert got[3, 0] == ("", 0, 0, None)
    whole = chat_quotes.conversations(rows, part=4).where("conv_id = 1").orderBy("part").collect()
    assert [[m["turn"] for m in r["messages"]] for r in whole] == [[0, 1, 4, 5], [2, 3]]
    assert [m["depth"] for r in whole for m in r["messages"]] == [0, 1, 2, 3, 1, 2]
    assert chat_quotes.linked_messages(rows.where("false")).count() == 0


def test_quotes_wrapped_anew(spark):
    text = "A long line that a mail program\nmay wrap anew."
    rows = [
        (1, 0, "user", text + "\n\nAnother paragraph"),
        (1, 1, "assistant", "Between"),
        (1, 2, "user", "> A long line\n> that a mail program may\n> wrap *anew*.\nYes"),
        (1, 3, "user", "> " + text.replace("\n", " ") + "\n>\n> Another paragraph\nYes"),
        (1, 4, "user", "May wrap anew."),
        (1, 5, "user", "> " + text.replace("\n", "\n> ") + "\n\nYes"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["body"], r["n_quoted"], r["n_matched"], r["reply_to"]) for r in chat_quotes.linked_messages(df).collect()}
    assert got[2] == ("Yes", 3, 3, 0)
    assert got[3] == ("Yes", 2, 2, 0)
    assert got[5] == ("Yes", 2, 2, 0)


def reply_order(messages):
    """{(conversation, turn, message): (depth, position)} by a walk from each root."""
    below = {}
    for m in messages:
        below.setdefault((m["conv_id"], m["reply_to"], m["reply_message"]), []).append(m)

    def in_order(key):
        return sorted(below.get(key, []), key=lambda m: (m["turn"], m["message"]), reverse=True)

    out = {}
    for conv in {m["conv_id"] for m in messages}:
        position = 0
        stack = [(m, 0) for m in in_order((conv, None, None))]
        while stack:
            m, depth = stack.pop()
            key = (conv, m["turn"], m["message"])
            out[key] = (depth, position)
            position += 1
            stack += [(a, depth + 1) for a in in_order(key)]
    return out


LINKED = "conv_id long, turn long, message long, role string, body string, reply_to long, reply_message long"


def test_reply_order(spark):
    rng = random.Random(4)
    rows = []
    for conv, n in ((1, 300), (2, 1), (3, 90), (4, 40)):
        for turn in range(n):
            to = None
            if turn and conv == 3:  # one chain
                to = turn - 1
            elif turn and conv == 4:  # all answer the first
                to = 0
            elif turn and rng.random() < 0.97:
                to = rng.randrange(max(0, turn - 30), turn)
            rows.append((conv, turn, 10 * turn + conv, "user", "x", to, None if to is None else 10 * to + conv))
    rows += [(1, 7, 5, "user", "same turn", 3, 31), (1, 9, 2, "user", "below it", 7, 5)]
    df = spark.createDataFrame(rows, LINKED).repartition(4)
    got = chat_quotes.placed(df)
    assert got.columns == [*df.columns, "depth", "position"]
    found = {(r["conv_id"], r["turn"], r["message"]): (r["depth"], r["position"]) for r in got.collect()}
    assert len(found) == len(rows) and found == reply_order([r.asDict() for r in df.collect()])
    odd = spark.createDataFrame([(None, 1, 3, "user", "x", None, None), (1, None, 4, "user", "y", None, None)], LINKED)
    assert {(r["depth"], r["position"]) for r in chat_quotes.placed(odd).collect()} == {(0, None)}
    assert chat_quotes.placed(df.where("false")).count() == 0
    assert chat_quotes.conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_attributions_and_made_quotes(spark):
    rows = [
        (1, 0, "user", "First words\nof two lines"),
        (1, 1, "assistant", "Answer"),
        (1, 2, "user", "On Monday, Ann wrote:\n> First words of two lines\nI agree: yes.\nShe wrote:\nthat"),
        (1, 3, "assistant", None),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r for r in chat_quotes.linked_messages(df).collect()}
    assert got[2]["body"] == "I agree: yes.\nShe wrote:\nthat" and got[2]["reply_to"] == 0
    quoting = {r["turn"]: r["text"] for r in chat_quotes.with_quotes(df).collect()}
    assert quoting[2].startswith("> First words\n> of two lines\nOn Monday") and quoting[3] is None
    assert {t: quoting[t] for t in (0, 1)} == {r[1]: r[3] for r in rows[:2]}


# ---------------------------------------------------------------- revisits


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://User@Example.COM:443/a/?b=2&a=1&utm_source=x#top", "http://example.com/a?a=1&b=2"),
        ("http://h", "http://h"),
        ("http://h:8080/x/?", "http://h:8080/x"),
        ("h.org/Path?ref=1", "http://h.org/Path"),
        (None, None),
    ],
)
def test_canonical(spark, url, want):
    row = spark.createDataFrame([(url,)], "u string").select(warc_revisit.canonical_url(F.col("u")).alias("c"))
    assert row.first()["c"] == want


def test_revisits(spark):
    def record(i, at, kind, url="http://h/a", **headers):
        return (i, url, at, kind, {k.replace("_", "-"): v for k, v in headers.items()} or None)

    rows = [
        record(1, 10, "response", etag='"x"', content_type="text/html", date="d1"),
        record(2, 20, "revisit", etag='W/"x"', date="d2", content_type="bad"),
        record(3, 30, "response", etag='"y"'),
        record(4, 40, "revisit", etag='"x"'),
        record(5, 5, "revisit", etag='"x"'),
        record(6, 30, "revisit", etag='"x"'),
        record(7, 50, "revisit", last_modified="m"),
        record(8, 1, "response", url="http://h/b", last_modified="m", etag='"q"'),
        record(9, 2, "revisit", url="HTTP://H/b/#x", last_modified="m"),
        record(10, 3, "revisit", url="http://h/b"),
        record(11, 9, "revisit", url=None, etag='"x"'),
        record(12, None, "revisit", etag='"x"'),
        record(13, 9, "request"),
    ]
    schema = "record_id long, url string, at long, kind string, headers map<string,string>"
    records = spark.createDataFrame(rows, schema)
    got = {r["record_id"]: r for r in warc_revisit.resolve_revisits(records).collect()}
    assert {i: (r["outcome"], r["refers_to"]) for i, r in got.items()} == {
        2: ("resolved", 1),
        4: ("changed", None),
        5: ("missing", None),
        6: ("resolved", 1),
        7: ("unchecked", None),
        9: ("resolved", 8),
        10: ("unchecked", None),
        11: ("missing", None),
        12: ("missing", None),
    }
    assert got[2]["headers"] == {"etag": 'W/"x"', "content-type": "text/html", "date": "d2"}
    assert got[4]["headers"] is None
    assert warc_revisit.resolve_revisits(records.where("false")).count() == 0


def test_revisits_of_ties_and_repeated_records(spark):
    url, long = "http://h/a", "http://h/" + "p" * 100_000
    rows = [
        (1, url, 10, "response", {"etag": '"x"'}),
        (2, url, 10, "response", {"etag": '"y"'}),
        (3, url, 20, "revisit", {"etag": '"y"'}),
        (4, url, 10, "revisit", {"etag": '"x"'}),
        (5, long, 1, "response", {"etag": "e"}),
        (6, long, 2, "revisit", {"etag": "e"}),
        (None, "", 3, "revisit", None),
    ]
    schema = "record_id long, url string, at long, kind string, headers map<string,string>"
    found = warc_revisit.resolve_revisits(spark.createDataFrame(rows + rows, schema)).collect()
    got = sorted((r["record_id"] or 0, r["outcome"], r["refers_to"] or 0) for r in found)
    want = [(0, "missing", 0), (3, "resolved", 2), (4, "missing", 0), (6, "resolved", 5)]
    assert got == sorted(want + want)


def test_latest_before(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        at = rng.choice([None, *range(60)])
        rows.append((i, key, at, (at, i) if rng.random() < 0.4 else None))
    df = spark.createDataFrame(rows, "id long, k string, at long, found struct<at:bigint,id:bigint>").repartition(4)
    got = {r["id"]: r["found"] and tuple(r["found"]) for r in latest_before(df, ["k"], "at", "found", 8).collect()}
    for i, key, at, _ in rows:
        offers = [f for _, k, t, f in rows if f and k == key and None not in (key, at, t) and t < at]
        assert got[i] == max(offers, default=None)
