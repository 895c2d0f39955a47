"""Main text of web pages by block rules in two passes.

A page becomes blocks: runs of text between block-level tags, with white space
folded, references decoded, and the share of the text inside links.  Containers
that are page furniture (menus, footers, forms, adverts, comments; by tag, role
or a whole class or id) or hidden are ruled out before any text is judged; the
page itself, articles and headings never by class or id.

First pass, each block on its own: outside of articles many links make it bad,
headings apart; enough text with enough stop words makes it good; a short block,
or one with few stop words, is undecided.  Inside an article links say nothing
(headings and reference lists are often links), as its furniture is gone.
Second pass: an undecided block takes the label of the nearest decided block of
its scope, the good one when both are as near.  A scope is an article (or main)
element, or what lies outside of them; where a scope has no good block, its
undecided blocks are good.  When a page has an article with text, what lies
outside is not the article.

Rows are independent: one scan, no shuffle, memory by page; a page is read once,
whatever its tags' depth.  Defined results:
null, empty or text-free pages give an empty text.  Broken markup (open tags,
cut pages, stray ends) is read as far as it goes.  Nothing is capped.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.names import quoted

MIN_GOOD = 70            # characters from which a block is judged by stop words
MIN_STOP_DENSITY = 0.1   # stop words per word of a good block
MAX_LINK_DENSITY = 0.5   # share of characters inside links

STOP_WORDS = frozenset(
    # English, French, German, Spanish function words
    "the of and to in is was with on for that this it be at by from are a an or as not have has had but "
    "they you he she we his her its their which were been "
    "le la les de des du un une et est que qui dans pour sur pas par avec au aux ce se en il elle ne plus "
    "der die das und ist ein eine den dem des mit von zu im auf für nicht sich als auch es an er sie aus "
    "el los las del y que en un una por con para su se lo como más al es son fue".split())

# names of containers that hold no article text
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsored sponsor promo promotion cookie cookies "
    "consent gdpr notice notices alert menu menus nav navbar navigation breadcrumb breadcrumbs sidebar aside "
    "footer masthead comment comments commentlist disqus reply replies respond share sharing social related "
    "recommended newsletter subscribe subscription popup modal overlay login signup widget widgets pagination "
    "pager search toolbar topbar skip".split())
OUTSIDE_ONLY = frozenset(["header"])         # fine inside an article
# words that may stand beside a name of furniture in a class or id (sidebar-left, cookie-box)
BESIDE = frozenset(
    "area bar block body bottom box btn button buttons center col column container content desktop entry fixed "
    "form global group holder icon icons inner item items js left link links list main mobile module mw page pane "
    "panel post posts primary right row secondary section site slot sticky top unit wp wrap wrapper".split())
# names that rule out a paragraph, or a section by its id (which generators make from the heading)
SURE = frozenset("ad ads advert adverts advertisement sponsored comments respond disqus breadcrumbs navbar "
                 "sidebar masthead".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
NEVER_BY_NAME = frozenset(["html", "body", "article", "main", *HEADINGS])
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
BAD_TAGS = frozenset("head nav footer aside form button select option dialog menu iframe object noscript "
                     "template svg canvas audio video".split())
RAW_TAGS = "script|style|textarea|title|noscript|template|xmp|iframe"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("html body head title address article aside blockquote center dd details dialog div dl dt "
                   "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr legend li main menu nav "
                   "ol option p pre section summary table tbody td tfoot th thead tr ul".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW_TAGS})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named(names: str, furniture: frozenset[str]) -> bool:
    """Is a whole class or id furniture: its words, or all but those of BESIDE?"""
    for name in names.split():
        words = {w.lower() for w in NAME.findall(name) if len(w) > 1}
        if words & furniture and words <= furniture | BESIDE:
            return True
    return False


def _is_furniture(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in BAD_TAGS or (tag in OUTSIDE_ONLY and not in_article):
        return True
    if not attrs:
        return False
    given: dict[str, str] = {}
    for key, value in ATTR.findall(attrs):
        given.setdefault(key.lower(), value.strip("\"'"))       # the first of a name counts
    if ("hidden" in given or given.get("role", "").lower() in BAD_ROLES
            or given.get("aria-hidden", "").lower() == "true" or HIDDEN.search(given.get("style", ""))):
        return True
    if tag in NEVER_BY_NAME:
        return False
    names = FURNITURE if in_article else FURNITURE | OUTSIDE_ONLY
    return (_named(given.get("class", ""), SURE if tag == "p" else names)
            or _named(given.get("id", ""), SURE if tag in ("p", "section") else names))


class _Block:
    __slots__ = ("parts", "linked", "scope", "furniture", "heading")

    def __init__(self, scope: int, furniture: bool, heading: bool = False):
        self.parts: list[str] = []
        self.linked = 0
        self.scope, self.furniture, self.heading = scope, furniture, heading


def blocks(page: str) -> list[tuple[str, float, int, bool]]:
    """``(text, link density, scope, furniture)`` of the page's blocks in
    order; scope 0 is outside of any article.  A heading's links do not count."""
    out: list[_Block] = []
    stack: list[tuple[str, bool, int]] = []      # tag, furniture, scope
    open_at: dict[str, list[int]] = {}           # places of the open tags of each name
    open_blocks: list[int] = []                  # places of the open block-level tags
    links = scopes = 0
    block = _Block(0, False)

    def here() -> tuple[bool, int]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def new_block() -> None:
        nonlocal block
        if block.parts:
            out.append(block)
        furniture, scope = here()
        block = _Block(scope, furniture, any(open_at.get(h) for h in HEADINGS))

    def close(depth: int) -> None:
        """Drops the stack from this place on; every tag is dropped once."""
        nonlocal links
        while len(stack) > depth:
            tag = stack.pop()[0]
            open_at[tag].pop()
            if tag in BLOCKS:
                open_blocks.pop()
            links -= tag == "a"

    def text(raw: str) -> None:
        if raw:
            block.parts.append(raw)
            if links:
                block.linked += len("".join(raw.split()))

    at = 0
    for m in TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if open_at.get(tag):
                close(open_at[tag][-1])
            if tag in BLOCKS:
                new_block()
            continue
        if tag == "br":
            text("\n")
            continue
        if tag in VOID:
            if tag == "hr":
                new_block()
            continue
        if tag in BLOCKS and open_blocks and stack[open_blocks[-1]][0] == "p":
            close(open_blocks[-1])      # a block ends an open paragraph, and what is open inside it
        furniture, scope = here()
        furniture = furniture or _is_furniture(tag, m["attrs"], scope > 0)
        if tag in ("article", "main") and not furniture and not scope:
            scopes += 1
            scope = scopes
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            open_blocks.append(len(stack))
        stack.append((tag, furniture, scope))
        links += tag == "a"
        if tag in BLOCKS:
            new_block()
        elif furniture and not block.furniture:      # an inline container of furniture
            new_block()
    text(page[at:])
    new_block()

    found = []
    for b in out:
        t = " ".join(html.unescape("".join(b.parts)).split())
        if t:
            density = 0.0 if b.heading else min(1.0, b.linked / max(1, len(t.replace(" ", ""))))
            found.append((t, density, b.scope, b.furniture))
    return found


def _first_pass(text: str, link_density: float, scope: int, furniture: bool) -> bool | None:
    if furniture or (not scope and link_density > MAX_LINK_DENSITY):
        return False
    if len(text) < MIN_GOOD:
        return None
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words)
    return True if stops >= MIN_STOP_DENSITY * len(words) else None


def _inherit(labels: list[bool | None]) -> list[bool]:
    """Undecided labels take the nearest decided one, good at equal distance;
    they are good where no label is."""
    if True not in labels:
        return [label is None for label in labels]
    left: list = []
    for seq in (labels, labels[::-1]):
        near, gap, side = None, 0, []
        for label in seq:
            near, gap = (label, 0) if label is not None else (near, gap + 1)
            side.append((gap, near))
        left.append(side)
    out = []
    for label, (g1, a), (g2, b) in zip(labels, left[0], left[1][::-1]):
        if label is None:
            options = sorted((g, not v) for g, v in ((g1, a), (g2, b)) if v is not None)
            label = not options[0][1]
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    article = any(scope and not bad for _, _, scope, bad in found)
    good = [False] * len(found)
    for scope in {b[2] for b in found}:
        if article and not scope:
            continue
        # furniture neither stays nor speaks for its neighbours inside an article
        mine = [i for i, b in enumerate(found) if b[2] == scope and not (scope and b[3])]
        labels = _inherit([_first_pass(*found[i]) for i in mine])
        for i, label in zip(mine, labels):
            good[i] = label
    return "\n".join(b[0] for b, g in zip(found, good) if g)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` of every page."""
    rows = pages.select(pages[quoted(id_col)].alias("_id"), pages[quoted(url_col)].alias("_url"),
                        pages[quoted(html_col)].alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(x.as_py()) for x in part.column("_html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["_id", "_url", "text", "n_chars"])
    kind = {c: rows.schema[c].dataType.simpleString() for c in ("_id", "_url")}
    out = rows.mapInArrow(run, f"_id {kind['_id']}, _url {kind['_url']}, text string, n_chars long")
    return out.withColumnsRenamed({"_id": id_col, "_url": url_col})


def op6_html_extraction(spark, d):
    return extract(spark.read.parquet(f"{d}/pages.parquet"))


QUERIES = {"op6_html_extraction": op6_html_extraction}
ORACLE: dict[str, str] = {}
