import math
import random
import re
import time
from html import unescape

import pytest

from siltstone.llm.html_density import chosen, extract, main_text, parse, weigh
from siltstone.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
LONG = "A sentence of the article that says something of some length, and then goes on for a while."


def simple(html):
    """The article element of the test pages, cut by its tags."""
    found = re.search(r"<article>(.*?)</article>", html or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    lines = (" ".join(unescape(re.sub(r"<(?:/?b|br)>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_test_pages_equal_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op10_html_text"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == simple(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}<p>Ed.</article><footer>c</footer>", f"T\n{LONG}\nEd."),
        (f"<div id=menu><a>x</a></div><div class='content'><p>{LONG}</p><p>{LONG}</p><p>Short.</p></div><div class=sidebar>{LONG}</div>", f"{LONG}\n{LONG}\nShort."),
        (f"<main><header><h1>T</h1></header><p>{LONG}</p><aside>{LONG}</aside><section id=comments><p>{LONG}{LONG}</section></main>", f"T\n{LONG}"),
        (f"<header>Top</header><main><p>{LONG}</p><form>{LONG}<input></form><div class='cookie-notice'>{LONG}</div></main>", LONG),
        (f"<article><p>{LONG} <a href=x>link</a>, &amp; &eacute;&#8364;&copy &lt;b&gt; a\n\t b<br>c</p></article>", f"{LONG} link, & é€© <b> a b c"),
        (f"<article><script>if (a<b) '</p>'</script><style>p>b{{}}</style><!-- <p>no --><p>{LONG}", LONG),
        (f"<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><p>{LONG}</article>", f"one\ntwo\na\nb\nc\n{LONG}"),
        (f"<article><div class='ad'>{LONG}</div><p>a < b, 1<2 <3</p><p hidden>x</p><P STYLE='display: none'>y</P></article>", "a < b, 1<2 <3"),
        ("plain text, no tags", "plain text, no tags"),
        ("<script>only()", ""), ("<", "<"), ("</div></p>x", "x"), ("<p title='a>b'>x", "x"), ('<p title="open>x', "x"),
        (f"<article><svg><path d=x></svg><p>{LONG}<p></p><p> </p></article>", LONG),
        (None, ""), ("", ""),
    ],
)
def test_pages(html, want):
    assert main_text(html) == want


def test_densest_subtree_without_marks():
    links = "".join(f"<li><a href={i}>A link text of some length {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div><p>{LONG}</p><p>{LONG}</p></div></div><div><a>x</a> <a>y</a></div></body>"
    assert main_text(page) == f"{LONG}\n{LONG}"
    root = parse(page)
    weigh(root)
    assert root.link_tags == 32 and root.chars > 0


FIVE = [f"Paragraph {i}. {LONG}" for i in range(5)]
PARAGRAPHS = "".join(f"<p>{x}</p>" for x in FIVE)
LINKS = "".join(f"<li><a href={i}>A link text of some length {i}</a></li>" for i in range(30))


@pytest.mark.parametrize(
    "html, want",
    [
        # A landmark inside the densest node does not take its place, wherever it stands.
        (f"<div class=content>{PARAGRAPHS}<article class=teaser><p>Short</p></article></div>", [*FIVE, "Short"]),
        (f"<div class=content><article class=teaser><p>Short</p></article>{PARAGRAPHS}</div>", ["Short", *FIVE]),
        # A landmark around the densest node does not bring its link lists in, and keeps titles and text.
        (f"<article><div><ul>{LINKS}</ul></div><h1>Oslo</h1><div>{PARAGRAPHS}</div><p>{LONG}</p></article>", ["Oslo", *FIVE, LONG]),
        # No landmark at all: thresholds decide.
        (f"<body><div><ul>{LINKS}</ul></div><div><div>{PARAGRAPHS}</div><div><p>{LONG * 9}</p></div></div><div><ul>{LINKS}</ul></div></body>", [*FIVE, LONG * 9]),
    ],
)
def test_landmarks_only_weigh(html, want):
    assert main_text(html).split("\n") == want


LINES = [f"Line {i}. {LONG}" for i in range(110)]
BR = "<br>".join(LINES)
SMALL = "<div><p>A small paragraph 1.</p><p>A small paragraph 2.</p></div>"


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<body>{BR}{SMALL}</body>", [" ".join(LINES), "A small paragraph 1.", "A small paragraph 2."]),
        (f"<body><div>{BR}{SMALL}</div></body>", [" ".join(LINES), "A small paragraph 1.", "A small paragraph 2."]),
        (f"<body><div>{BR}</div>{SMALL}</body>", [" ".join(LINES), "A small paragraph 1.", "A small paragraph 2."]),
        # Bare text with inline elements and links in it, and bare text between blocks.
        (f"<body>{BR.replace('Line', '<b>Line</b>').replace('of some', '<a href=x>of</a> some')}{SMALL}</body>", [" ".join(LINES), "A small paragraph 1.", "A small paragraph 2."]),
        (f"<div>{LINES[0]}<h2>Two</h2>{LINES[1]} <i>{LINES[2]}</i><hr><span>{LINES[3]}</span></div>", [LINES[0], "Two", f"{LINES[1]} {LINES[2]}", LINES[3]]),
        # Beside the path.
        (f"<body>{LONG * 9}<div>{PARAGRAPHS}{PARAGRAPHS}{PARAGRAPHS}{PARAGRAPHS * 4}</div>Menu <a href=x>A link</a></body>", [LONG * 9, *FIVE * 7]),
    ],
)
def test_bare_text_counts(html, want):
    assert main_text(html).split("\n") == want


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<article class='post has-sidebar'>{PARAGRAPHS}</article>", FIVE),
        (f"<div id=content class='with-sidebar'>{PARAGRAPHS}</div><div class=sidebar>{LONG}</div>", FIVE),
        (f"<div class='page has-header'>{PARAGRAPHS}</div><div class=widget><a href=x>{LONG * 20}</a></div>", FIVE),
        (f"<main class=footer-below>{PARAGRAPHS}</main><div class=related>{LONG}</div>", FIVE),
        (f"<div class='row no-banner'><main>{PARAGRAPHS}</main></div><div class=rest><p>{LONG * 9}</p></div>", [*FIVE, LONG * 9]),
        # A word on each of many parts that are the page only together.
        ("".join(f"<div class='elementor-widget-text'><p>{x}</p></div>" for x in FIVE) + f"<div class=ad>{LONG}</div>", FIVE),
        (f"<div class=comments><p>{LONG}</p></div><div class=related><p>{LONG}</p></div>", [LONG, LONG]),
        # The word still counts on what is the lesser part.
        (f"<div>{PARAGRAPHS}<div class='related widget'><article><p>{LONG}</p></article></div></div>", FIVE),
        (f"<div class=ad>{LONG * 9}</div><article>{PARAGRAPHS}</article>", FIVE),
        (f"<div>{PARAGRAPHS}<select>{'<option>Some choice' * 99}</select></div>", FIVE),
    ],
)
def test_a_word_of_class_or_id_takes_no_main_text(html, want):
    assert main_text(html).split("\n") == want


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 5000 + LONG) == LONG
    assert main_text("<p" * 3000 + LONG) != ""
    assert len(main_text(f"<article><p>{'word ' * 300_000}</article>")) == 1_499_999


@pytest.mark.parametrize(
    "html, want",
    [
        *(
            (f"<body>{head}<div><ul>{LINKS}</ul></div><{tag}><article>{PARAGRAPHS}<select><option>no</select></article></{tag.split()[0]}></body>", FIVE)
            for head in ("", "<nav><a href=x>Home</a></nav>")
            for tag in ("form id=aspnetForm", "menu", "div aria-hidden=true", "div role=dialog", "header", "aside", "div style='display:none'")
        ),
        (f"<form><div>{PARAGRAPHS}</div><button>Send</button><input></form><footer>c</footer>", FIVE),
        # Wrappers in wrappers.
        (f"<form><div role=dialog><header><article>{PARAGRAPHS}</article></header></div><aside>{LONG}</aside></form>", FIVE),
        # A landmark outside keeps them shut, whatever their size; and so does the lesser part of the text.
        (f"<article><p>{LONG}</p></article><form>{LONG * 9}</form><dialog>{LONG * 9}</dialog>", [LONG]),
        (f"<div>{PARAGRAPHS}</div><aside><article><p>{LONG}</p></article></aside>", FIVE),
        # A head without end.
        (f"<head><title>no</title><link rel=x><body><div>{PARAGRAPHS}</div>", FIVE),
        (f"<head><meta x><div>{PARAGRAPHS}</div>", FIVE),
    ],
)
def test_no_wrapper_takes_the_article(html, want):
    assert main_text(html).split("\n") == want


SIX = [f"Paragraph {i}. {LONG} {LONG}" for i in range(6)]
BODY = "".join(f"<p>{x}</p>" for x in SIX)


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<div><h1>Title</h1><p>Lead.</p><div class=body>{BODY}</div><p>The end.</p></div>", ["Title", "Lead.", *SIX, "The end."]),
        (f"<body><div><ul>{LINKS}</ul></div><div><h1>Title</h1><p>Lead.</p><div class=body>{BODY}</div><p>The end.</p></div></body>", ["Title", "Lead.", *SIX, "The end."]),
        (f"<body><h1>Title</h1><div><div>{BODY}</div></div><div><ul>{LINKS}</ul></div></body>", ["Title", *SIX]),
        # Lists of links beside it still go.
        (f"<div><ul>{LINKS}</ul><div class=body>{BODY}</div><p>The end.</p></div>", [*SIX, "The end."]),
        # Two articles of nearly one size, and one of links.
        (f"<article>{BODY}</article><article>{BODY.replace('while', 'bit')}</article><article><ul>{LINKS}</ul></article>", [*SIX, *(x.replace("while", "bit") for x in SIX)]),
        (f"<article>{BODY}</article><article class=comment>{BODY.replace('while', 'bit')}</article><article><p>Teaser</p></article>", SIX),
    ],
)
def test_titles_leads_tails_and_siblings(html, want):
    assert main_text(html).split("\n") == want


def brute_density(node, page):
    """Composite text density by walking every subtree anew."""
    def nodes(n):
        return [n] + [x for c in n.children if not isinstance(c, str) and not c.dropped for x in nodes(c)]

    def chars(n):
        return sum(len("".join(c.split())) for x in nodes(n) for c in x.children if isinstance(c, str))

    inner = nodes(node)
    links = [x for x in inner if x.tag == "a"]
    outer = [x for x in links if not any(y is not x and x in nodes(y) for y in links)]
    total, link_chars = chars(node), sum(map(chars, outer))
    whole, page_links = chars(page), sum(chars(x) for x in nodes(page) if x.tag == "a")
    leaf = not any(x.structure for x in inner[1:])
    tags = 1 if leaf else max(1, sum(x.tag != "#run" for x in inner[1:]))
    if not total:
        return 0.0
    base = math.log(total / max(1, total - link_chars) * link_chars + page_links / max(1, whole) * total + math.e)
    ratio = total / max(1, link_chars) * tags / max(1, min(len(links), tags))
    return total / tags * math.log(max(1.0, ratio)) / math.log(max(base, math.e))


def test_densities_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        parts = [rng.choice(["<div>", "<p>", "</div>", "</p>", "<ul>", "<li>", "</ul>", "<a href=x>link</a>", "<b>bold</b>", "some words ", LONG, "<nav>no</nav>", "<br>"]) for _ in range(rng.randint(1, 40))]
        root = parse("".join(parts))
        order = weigh(root)
        for node in order:
            assert node.density == pytest.approx(brute_density(node, root))
            inner = [c for c in node.children if not isinstance(c, str) and not c.dropped]
            holds = any(c.structure for c in inner)
            if node.structure or node is root:
                assert node.total == pytest.approx(sum(c.density for c in inner) if holds else node.density)
        assert "".join(main_text("".join(parts)).split()) in "".join("".join(parts).split()) or chosen(root)


@pytest.mark.parametrize(
    "html",
    [
        "<div>" * 200_000, "<b></i>" * 200_000, "<p><table><td>" + "<div>" * 200_000, "<p" * 200_000, "<header>" * 200_000,
        "<form>" * 100_000, "<ul><li>" * 100_000, "<table><tr><td>" * 60_000, "<a href=x>" * 100_000, "<div class=ad>" * 100_000, "<" * 200_000,
        "<!--" * 100_000, "<a '" * 100_000,
    ],
)
def test_open_elements_take_linear_time(html):
    start = time.process_time()
    main_text(html + LONG)
    assert time.process_time() - start < 20


def test_rows_nulls_repeats_and_clashing_columns(spark):
    kind = "page_id long, url string, html string, text int, n_chars string"
    rows = [(1, "u", "<p>a", 1, "x"), (1, "u", "<p>a", 1, "x"), (None, None, None, None, None), (2, "v", "<p>\U0001f600", 1, None)]
    got = [tuple(r) for r in extract(spark.createDataFrame(rows, kind)).collect()]
    assert sorted(got, key=str) == sorted([(1, "u", "a", 1)] * 2 + [(None, None, "", 0), (2, "v", "\U0001f600", 1)], key=str)
    assert extract(spark.createDataFrame([], kind)).count() == 0
