"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. Words score positive and tags negative;
one linear scan finds the contiguous region with the largest sum, and its text blocks are
the article. A fixed list is left out of the sum and of the text, wherever it stands:

* ``NOISE``: what is not shown as text or controls the page, ``head`` up to the first element or text of the body,
  and ``header`` outside of an article;
* elements with a whole class, id or role word in ``NAMED``, but never ``UNNAMED`` (the page, articles, headings, paragraphs);
  on a page that has no other text these words do not count;
* ``form`` inside an article, unless it holds headings, paragraphs or an article. Other forms are plain boxes.

The weights come from labelled pages: those whose own markup names the article
(``article`` or ``main``). Over all of them, tags and words are counted inside and outside
of it, by element; a tag weighs the log ratio of outside to inside, a word the log
ratio of inside to outside for the element that holds it. Tags in menus and other left-out
elements are counted too, as outside, so that links and lists weigh what they weigh in a menu that no list names;
only words there are not, since they would speak against the plain box around them.
Keys are known element names only, so the counts that reach the driver are few, whatever the pages.

Character references are decoded, white space within a block becomes one space, blocks are
joined by one space in page order. Defined results: null and empty html, and pages
without words in the region, give an empty text; an unclosed comment or tag ends the page;
ties go to the earlier region; repeated rows repeat their result; without labelled pages
words weigh 1 and tags a fixed small penalty; an empty table gives no rows. Only ``page_id``, ``url`` and ``html`` are
read.
"""

from __future__ import annotations

import html as html_module
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow

# HTML element names by the part they play here.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp".split())
BOXES = frozenset("article main section div body td li ul ol dl table blockquote figure details center".split())
NOISE = frozenset("nav aside footer button select dialog menu head object canvas video audio map".split()) | RAW
OTHER = frozenset("p h1 h2 h3 h4 h5 h6 pre hr br address header hgroup tr th tbody thead tfoot dt dd figcaption summary html form".split())
NAMES = INLINE | VOID | BOXES | NOISE | OTHER
#: Elements that may stand in an open ``head``; any other ends it.
HEAD = frozenset("html head base link meta title style script noscript template".split())
#: Elements that show that a form holds text.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 article main".split())
#: Elements to which ``NAMED`` does not apply.
UNNAMED = frozenset("html body hgroup".split()) | PROSE
#: Whole words of class, id and role.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertisements advertising ad-slot ad-banner sponsor sponsors sponsored promo promos promotion "
    "banner sidebar side-bar menu nav navbar nav-bar navigation breadcrumb breadcrumbs footer site-footer page-footer cookie cookies "
    "cookie-banner cookie-notice cookie-consent consent comment comments comments-area comment-list comment-form disqus disqus_thread respond "
    "share sharing share-buttons social social-share social-links related related-posts related-articles recommended recommendations "
    "newsletter subscribe signup popup modal widget pager pagination masthead toolbar".split()
)
_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_ATTRIBUTES = re.compile(r"""(?:[^"'>]|"[^"]*"|'[^']*')*+>""")
_LABEL = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: Limits of the weights; ``DEFAULT_TAG`` is for tags that no labelled page has.
WORD, LEAST_TAG, MOST_TAG, DEFAULT_TAG = 6.0, 0.05, 12.0, 0.2


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", raw) and ("open" or "close", name, attributes), in page order; comments and declarations are dropped."""
    at, n = 0, len(page)
    while at < n:
        i = page.find("<", at)
        if i < 0:
            yield "text", "", page[at:]
            return
        if i > at:
            yield "text", "", page[at:i]
        m = _TAG.match(page, i)
        if m:
            rest = _ATTRIBUTES.match(page, m.end())
            end = rest.end() if rest else page.find(">", m.end()) + 1
            if end <= 0:
                return
            name, attributes = m[2].lower(), page[m.end() : end - 1]
            yield "close" if m[1] else "open", name, attributes
            at = end
            if not m[1] and name in RAW and not attributes.endswith("/"):
                close = re.compile(f"</{name}(?![A-Za-z0-9:-])", re.I).search(page, at)
                if close is None:
                    return
                at = close.start()
        elif page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            if end < 0:
                return
            at = end + 3
        elif page.startswith(("<!", "<?", "</"), i):
            end = page.find(">", i)
            if end < 0:
                return
            at = end + 1
        else:
            yield "text", "", "<"
            at = i + 1


def _is_named(name: str, attributes: str) -> bool:
    if name in UNNAMED or "=" not in attributes:
        return False
    return any(word in NAMED for m in _LABEL.finditer(attributes) for word in next(filter(None, m.groups()), "").lower().split())


def _forms_with_text(found: list[tuple[str, str, str]]) -> set[int]:
    """Positions of the forms that hold one of ``PROSE``."""
    out, prose = set(), False
    for i in range(len(found) - 1, -1, -1):
        kind, name, _ = found[i]
        if name == "form":
            if kind == "open" and prose:
                out.add(i)
            elif kind == "close":
                prose = False
        elif kind == "open" and name in PROSE:
            prose = True
    return out


def parts(page: str, named: bool = True) -> Iterator[tuple[str, str, bool, str]]:
    """(kind, key, in the labelled article, text) of what counts: words with their box, tags with their name, breaks between blocks.

    Tags that are left out have the kind "side". Without ``named``, words of class, id and role leave nothing out.
    """
    found = list(tokens(page))
    with_text = _forms_with_text(found)
    stack: list[tuple[str, bool, str]] = []  # open elements, whether they begin a part that is left out, their box
    names: Counter = Counter()  # of the open elements
    out = 0  # open elements that are left out
    inside = 0  # open article or main elements

    def close(depth: int) -> None:
        nonlocal out, inside
        for n, noise, _ in stack[depth:]:
            names[n] -= 1
            if n in ("article", "main") and not out:
                inside -= 1
            out -= noise
        del stack[depth:]
        inside = max(0, inside)

    for i, (kind, name, value) in enumerate(found):
        if names["head"] and (kind == "open" and name not in HEAD or kind == "text" and stack[-1][0] == "head" and value.strip()):
            close(next(d for d, x in enumerate(stack) if x[0] == "head"))
        if kind == "text":
            if not out:
                yield "word", stack[-1][2] if stack else "none", inside > 0, value
            continue
        key = name if name in NAMES else "unknown"
        block = name not in INLINE
        if kind == "open":
            noise = (
                name in NOISE
                or (name == "header" and not inside)
                or (name == "form" and inside > 0 and i not in with_text)
                or (named and _is_named(name, value))
            )
            if name in ("article", "main") and out:
                # an element left open before the article must not swallow it
                if not names["article"] and not names["main"]:
                    stack, out = [(n, False, box) for n, _, box in stack], 0
            yield ("side", key, False, "") if out or noise else ("tag", key, inside > 0, "")
            if block:
                yield "break", "", inside > 0, ""
            if name not in VOID and not value.endswith("/"):
                stack.append((name, noise, name if name in BOXES else stack[-1][2] if stack else "none"))
                names[name] += 1
                out += noise
                inside += name in ("article", "main") and not out
        else:
            if not names[name]:
                if block:
                    yield "break", "", inside > 0, ""
                continue
            depth = next(d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name)
            noise = stack[depth][1]
            close(depth)
            yield ("side", "/" + key, False, "") if noise or out else ("tag", "/" + key, inside > 0, "")
            if block:
                yield "break", "", inside > 0, ""


Weights = dict[tuple[str, str], float]


def weights(counts: dict[tuple[str, str], tuple[int, int]]) -> Weights:
    """From counts inside and outside of labelled articles."""
    out = {}
    for (kind, key), (within, without) in counts.items():
        ratio = math.log((within + 1) / (without + 1))
        out[kind, key] = min(WORD, max(0.0, ratio)) if kind == "word" else -min(MOST_TAG, max(LEAST_TAG, -ratio))
    return out


def extract(page: str, w: Weights) -> str:
    """The text of the best region."""
    return _best(page, w, True) or _best(page, w, False)


def _best(page: str, w: Weights, named: bool) -> str:
    found = list(parts(page, named))
    best = score = 0.0
    start, span = 0, (0, 0)
    for i, (kind, key, _, text) in enumerate(found):
        if kind == "word":
            n = len(text.split())
            score += n * w.get((kind, key), 1.0)
        elif kind == "tag":
            score += w.get((kind, key), -DEFAULT_TAG)
        if score > best:
            best, span = score, (start, i + 1)
        elif score <= 0:
            score, start = 0.0, i + 1
    pieces = [html_module.unescape(text) if kind == "word" else " " if kind == "break" else "" for kind, _, _, text in found[span[0] : span[1]]]
    return " ".join("".join(pieces).split())


def learn(pages: DataFrame) -> Weights:
    """Count words and tags of all labelled pages."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                if page:
                    own = [(kind, key, inside, len(text.split()) if kind == "word" else 1) for kind, key, inside, text in parts(page)]
                    if any(inside for _, _, inside, _ in own):
                        for kind, key, inside, n in own:
                            if kind != "break":
                                counts["tag" if kind == "side" else kind, key, inside] += n
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in zip(*((k, name, i, n) for (k, name, i), n in counts.items()))], names=["kind", "key", "inside", "n"]
            )

    rows = map_arrow(pages.select("html"), task, "kind string, key string, inside boolean, n bigint")
    total = rows.groupBy("kind", "key").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"), F.sum(F.when(~F.col("inside"), F.col("n")).otherwise(0)).alias("o")
    )
    return weights({(r["kind"], r["key"]): (r["i"], r["o"]) for r in total.collect()})


def articles(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    w = learn(pages)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                texts = [extract(page, w) if page else "" for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id").cast(pa.int64()), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return map_arrow(pages.select("page_id", "url", "html"), task, "page_id bigint, url string, text string, n_chars bigint")
