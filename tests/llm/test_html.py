"""Main text: exact articles of the test pages, odd markup, and the scan against all regions."""

import html
import itertools
import random
import re

import pytest

from tidemark.llm import html_segment as h


def test_articles_of_the_test_pages(tables):
    pages = {r.page_id: r for r in tables("pages").collect()}
    rows = h.articles(tables("pages")).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r.page_id].html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain words < 5 &amp; more", "plain words < 5 & more"),
        ("<p>a&nbsp; b<p>c<b>d</b>e", "a b cde"),
        ("<nav>menu</nav><p>text of the page<footer>foot", "text of the page"),
        ("<div class='ad'>buy<article><p>never lost", "never lost"),
        ("<article>one <aside>side</aside>two<div class='comments'>me too</div></article>", "one two"),
        ("<script>var x='<p>no</p>'</script><p>yes", "yes"),
        ("<p>kept<!-- <p>not", "kept"),
        ("<p>kept<a href='x", "kept"),
        ("<p title='a>b'>quoted</p>", "quoted"),
        ("<main><h1>T</h1><form>name</form><p>x &lt;y&gt; &#233;</main>", "T x <y> é"),
    ],
)
def test_odd_markup(page, text):
    assert h.extract(page, {}) == text


def test_region_has_the_largest_sum():
    rng = random.Random(4)
    names = ["p", "div", "section", "li", "b"]
    w = {("tag", n): -rng.random() * 3 for n in names} | {("tag", "/" + n): -rng.random() * 3 for n in names}
    w |= {("word", n): rng.random() * 2 for n in names}
    for _ in range(300):
        page = "".join(rng.choice([f"<{rng.choice(names)}>", f"</{rng.choice(names)}>", "word ", "two words "]) for _ in range(14))
        found = list(h.parts(page))
        value = [len(t.split()) * w.get((k, n), 1.0) if k == "word" else w.get((k, n), -h.DEFAULT_TAG) if k == "tag" else 0.0 for k, n, _, t in found]
        best = max((sum(value[a:b]) for a, b in itertools.combinations(range(len(value) + 1), 2)), default=0.0)
        words = h.extract(page, w)
        assert bool(words) == (best > 1e-12)
        got = max(
            (sum(value[a:b]) for a, b in itertools.combinations(range(len(value) + 1), 2)
             if " ".join("".join(t if k == "word" else " " if k == "break" else "" for k, _, _, t in found[a:b]).split()) == words),
            default=0.0,
        )
        assert got == pytest.approx(max(best, 0.0))


@pytest.mark.parametrize("unit", ["<", "<a ", "<p>", "<a x='", "</p>", "<!--", "<script>", "<div><p>x", "&amp"])
def test_long_uniform_pages_take_linear_time(unit):
    h.extract(unit * (120_000 // len(unit)), {})


def test_awkward_rows(spark):
    rows = [(1, None, None, 3), (None, "u", "", 4), (2, "v", "<p>x</p>", 5), (2, "v", "<p>x</p>", 5)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = h.articles(frame).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "", 0), (2, "x", 1), (2, "x", 1)]
    assert h.articles(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>T</title><body><div><p>text", "text"),
        ("<head><title>T</title><meta charset=x><div>text</div>", "text"),
        ("<head><title>T</title>text", "text"),
        ("<head><title>T</title><link rel=x><script>no</script></head><p>text", "text"),
        ("<article class='post no-sidebar'>text</article>", "text"),
        ("<article class='sidebar'>text</article>", "text"),
        ("<div class='content has-sidebar'><p>text</div>", "text"),
        ("<div class='widget'><p>the whole page</div>", "the whole page"),
        ("<form><div>the whole page</div></form>", "the whole page"),
        ("<main><h1>T</h1><form><p>the whole page</p></form></main>", "T the whole page"),
        ("<article><h2 id='related-work'>Related work</h2>one<p id='notice-period'>two</p><p class='notice'>three</p></article>", "Related work one two three"),
        ("<article><h2 class='related'>Related</h2>one<div class='x related'>links</div></article>", "Related one"),
        ("<header>site</header><article><header>by A</header>one</article>", "by A one"),
    ],
)
def test_lists_of_names_lose_no_article(page, text):
    assert h.extract(page, {}) == text


def test_tags_of_menus_are_counted(spark):
    menu = "<ul>" + "<li><a href='/x'>one</a></li>" * 30 + "</ul>"
    rows = [(i, "u", f"<nav>{menu}</nav><article><h1>T</h1><p>a few words</article>") for i in range(20)]
    rows.append((99, "u", f"<div class='mn'>{menu}</div><div><div>the first part</div><div>the second part</div></div>"))
    got = {r.page_id: r.text for r in h.articles(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == "T a few words" and got[99] == "the first part the second part"


@pytest.mark.parametrize("unit", ["<form>", "<form><p>", "<head>", "<head><p>", "<article><form>x"])
def test_long_uniform_forms_and_heads_take_linear_time(unit):
    h.extract(unit * (120_000 // len(unit)), {})
