"""Main text of web pages by two-pass block rules.

Pass one cuts the page into blocks and judges each alone by where it stands, its link density, length and
stop-word density: good, bad, or undecided. Pass two lets undecided blocks (short ones, headings, lines without
common words) inherit the label of the nearest decided neighbours. Pages are judged one by one in the task that
reads them: no shuffle, and one page in memory at a time.

* Scripts, styles, comments of the markup, hidden parts, and the head never make blocks.
* Blocks inside menus, headers and footers of the page, sidebars, forms, adverts, notices and reader
  comments are bad, told by element, or by a whole name in ``class``, ``id`` or ``role`` (``comments``, ``sidebar-left``),
  however much text that is. A name of which only a part says so (``share-price``, ``has-sidebar``) leaves its blocks
  undecided, unless the page has no other good block. No name puts away ``article`` or ``main``.
* A page marks its content if an ``article`` or ``main`` has the form of one: a long block and a heading that is no link, or
  two long blocks. Blocks outside are bad then, and inside only link lists are; undecided blocks look for
  neighbours inside. A content element without any decided block is good.
* Elsewhere: many links bad; short undecided; long with common words good. Long with few common words (code, lists of names)
  is good between good blocks only. On a page with few common words throughout, which is in a language without a list, long
  is good. Short copyright lines at the end are bad.

Defined results
---------------
* Null or empty html gives an empty text. Broken markup is read as far as it goes: an open tag at the end
  is dropped, open elements end with the page. Of scripts and styles nothing is read; other skipped elements that
  are never closed end at the next block, and self-closing ones at once.
* One row per page row, repeated ids included; only the named columns are read. An empty table gives no row.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent words of English, French, Spanish and German.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which".split()
    + "le la les de des du et en un une est que qui dans pour pas au sur par ce il ne se avec son plus ou sont".split()
    + "el los las del que y un una por con no su para es al lo como más pero sus este o porque esta entre".split()
    + "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat".split())

RAW = "script|style|noscript|template|svg|iframe|object|canvas|title|textarea|select|audio|video|math"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+>?"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?P<end>>?)"
    r"|<[!?/][^>]*+>?|[^<]++|<", re.S | re.I)
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
# Elements that nest and are closed explicitly; others end with the block.
NESTED = frozenset(
    "address article aside blockquote body button details dialog div dl fieldset figure footer form header main menu nav ol "
    "section span table ul head".split())
# Elements without markup inside; open ones reach to the end of the page.
PLAIN = frozenset(("script", "style"))
SKIPPED = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<plain>script|style)\b(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+>?.*?(?:</(?P=plain)\s*+>|\Z)"
    rf"|<(?P<close>/?)(?P<raw>{RAW})\b(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+>?", re.S | re.I)
BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BREAKS))})\b", re.I)
CONTENT = frozenset(("article", "main"))
AWAY = frozenset("nav aside footer form button menu dialog fieldset head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
AWAY_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs pagination footer "
    "masthead social share sharing related recommended comment comments respond replies disqus widget login signup skip".split())
# Names of attributes; a quote opens a string only right behind the equals sign.
ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
PIECE = re.compile(r"[a-z]+")
# Words that say where something stands or that it is a part, not what it is.
PLACE_WORDS = frozenset(
    "area bar block body bottom box col column container content foot group head header inner item items left link links list main "
    "outer page panel post primary region right row secondary section site thread title top wrap wrapper".split())
WORD = re.compile(r"\w+")

MAX_LINK_DENSITY = 0.3
SHORT_CHARS = 70
STOP_LOW, STOP_HIGH = 0.15, 0.25
# A copyright line: up to this long, among the last blocks of the page.
COPYRIGHT_CHARS, LAST_BLOCKS = 210, 3


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    away: bool
    content: int  # number of the content element it stands in, 0 outside
    doubted: bool = False  # a part of a class or id around it speaks against it
    low: bool = False  # long, with few common words
    label: str = ""


def _speaks(name: str) -> tuple[bool, bool]:
    """Whether a class, id or role as a whole says that something is no content, and whether a part of it does."""
    pieces = PIECE.findall(name)
    known = AWAY_WORDS.intersection(pieces)
    return bool(known) and all(p in known or p in PLACE_WORDS for p in pieces), bool(known)


def _is_away(tag: str, attrs: str, in_content: bool) -> tuple[bool, bool]:
    """Whether an element is hidden or no content, and whether a part of its class or id makes that doubtful."""
    if tag in AWAY or (tag == "header" and not in_content):
        return True, False
    doubted = False
    for name, value in ATTRIBUTE.findall(attrs) if attrs else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True, False
        if name in ("class", "id", "role") and tag not in ("body", "html", *CONTENT):
            for one in value.split():
                whole, part = _speaks(one)
                if whole:
                    return True, False
                doubted = doubted or part
    return False, doubted


def _skips(page: str) -> dict[int, int]:
    """Where each skipped element of ``page`` ends, by where it starts."""
    ends: dict[int, int] = {}
    open_: dict[str, list[re.Match]] = {}
    for token in SKIPPED.finditer(page):
        if token["plain"]:
            ends[token.start()] = token.end()
        elif token["raw"]:
            tag, same = token["raw"].lower(), open_.setdefault(token["raw"].lower(), [])
            if token["close"]:
                if same:
                    ends[same.pop().start()] = token.end()
            elif token[0].endswith("/>"):
                ends[token.start()] = token.end()
            elif tag not in PLAIN:
                same.append(token)
    block = before = len(page)
    for token in sorted((t for same in open_.values() for t in same), key=re.Match.start, reverse=True):
        found = BLOCK_TAG.search(page, token.end(), before)
        block, before = found.start() if found else block, token.start()
        ends[token.start()] = block
    return ends


def _tokens(page: str) -> Iterator[re.Match]:
    """Tokens outside of skipped elements."""
    at, ends = 0, _skips(page)
    while at < len(page):
        token = TOKEN.match(page, at)
        at = token.end()
        if token["raw"]:
            at = max(at, ends.get(token.start(), at))
        else:
            yield token


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, with where they stand."""
    out: list[Block] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, int, bool]] = []  # tag, away, content number, doubted
    links, link_chars, heading, contents, breaks = 0, 0, False, 0, 0

    def close():
        nonlocal link_chars
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                away, content, doubted = stack[-1][1:] if stack else (False, 0, False)
                out.append(Block(text, link_chars, heading, away, content, doubted))
            pieces.clear()
        link_chars = 0

    for token in _tokens(page):
        tag = token["tag"]
        if tag is None:
            text = token[0]
            if text[0] != "<" or len(text) == 1:
                text = entities.unescape(text) if "&" in text else text
                pieces.append(text)
                if links:
                    link_chars += len(text.strip())
                if not text.isspace():
                    breaks = 0
            continue
        tag, closing = tag.lower(), bool(token["close"])
        if not token["end"]:
            continue
        if tag == "br":
            pieces.append(" ")
            breaks += 1
            if breaks > 1:
                close()
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else 1
            continue
        if tag in BREAKS:
            close()
            links, breaks = 0, 0
        if tag in HEADINGS:
            heading = not closing
        elif tag in BREAKS:
            heading = False
        if tag in NESTED:
            if closing:
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at][0] == tag:
                        if tag not in BREAKS and any(s[1] or s[3] for s in stack[at:]):
                            close()
                        del stack[at:]
                        break
            elif not token["attrs"].endswith("/"):
                above_away, content, above_doubted = stack[-1][1:] if stack else (False, 0, False)
                away, doubted = _is_away(tag, token["attrs"], bool(content))
                if (away or doubted) and not above_away:
                    close()
                away = above_away or away
                if tag in CONTENT and not away and not content:
                    contents += 1
                    content = contents
                stack.append((tag, away, content, above_doubted or doubted))
        elif tag == "p" and not closing and token["attrs"] and any(_is_away(tag, token["attrs"], False)):
            above_away, content, above_doubted = stack[-1][1:] if stack else (False, 0, False)
            away, doubted = _is_away(tag, token["attrs"], False)
            stack.append(("p", above_away or away, content, above_doubted or doubted))
        if tag in ("p", *BREAKS) and stack and stack[-1][0] == "p" and not (tag == "p" and not closing and token["attrs"]):
            stack.pop()
    close()
    return out


def _density(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _long(block: Block) -> bool:
    n = len(block.text)
    return not block.away and not block.heading and n >= SHORT_CHARS and block.link_chars <= MAX_LINK_DENSITY * n


def judge(block: Block, marked: bool, listed: bool = True, last: bool = True) -> str:
    """Pass one: good, bad or undecided.

    ``marked``: the page marks its content; ``listed``: its language has stop words; ``last``: the block stands at its end.
    """
    n = len(block.text)
    if block.away or (marked and not block.content):
        return "bad"
    if block.link_chars > MAX_LINK_DENSITY * n:
        return "bad"
    if not marked and last and n <= COPYRIGHT_CHARS and ("©" in block.text or "copyright" in block.text.lower()):
        return "bad"
    if n < SHORT_CHARS or block.heading:
        return "undecided"
    density = _density(block.text)
    if density >= STOP_HIGH or not (listed or marked):
        return "good"
    block.low = density < STOP_LOW and not marked
    return "undecided"


def inherit(found: list[Block], marked: bool) -> None:
    """Pass two: undecided blocks take the label of the nearest decided ones on both sides.

    Where the sides differ, or one is missing, marked content stays good; elsewhere headings are good and other
    blocks bad. Long blocks with few common words are good only between good ones. Inside a content element only blocks of
    that element count.
    """
    undecided = [i for i, b in enumerate(found) if b.label == "undecided"]
    if not undecided:
        return
    labels = [b.label for b in found]
    before, after = [None] * len(found), [None] * len(found)
    for order, seen in ((range(len(found)), before), (range(len(found) - 1, -1, -1), after)):
        last, content = None, None
        for i in order:
            if found[i].away:
                continue
            if found[i].content != content:
                last, content = None, found[i].content
            seen[i] = last
            if labels[i] != "undecided":
                last = labels[i]
    for i in undecided:
        near = {before[i], after[i]} - {None}
        if found[i].low:
            found[i].label = "good" if before[i] == after[i] == "good" else "bad"
        elif not near:
            found[i].label = "good"  # nothing around it speaks against it
        elif len(near) == 1 and not (marked and None in (before[i], after[i])):
            found[i].label = near.pop()
        else:
            found[i].label = "good" if marked or found[i].heading else "bad"


def _marks(found: list[Block]) -> bool:
    """Whether some content element has the form of an article."""
    long_: dict[int, int] = {}
    headed = set()
    for b in found:
        if b.content and not b.away:
            long_[b.content] = long_.get(b.content, 0) + _long(b)
            if b.heading and b.link_chars <= MAX_LINK_DENSITY * len(b.text):
                headed.add(b.content)
    return any(n > 1 or (n and content in headed) for content, n in long_.items())


def extract(page: str | None) -> str:
    """Main text of one page: good blocks joined by line ends."""
    if not page:
        return ""
    found = blocks(page)
    marked = _marks(found)
    listed = marked or _density(" ".join(b.text for b in found if _long(b))) >= STOP_LOW
    for k, b in enumerate(found):
        b.label = judge(b, marked, listed, k >= len(found) - LAST_BLOCKS)
    if any(b.label == "good" and not b.doubted for b in found):
        for b in found:
            if b.label == "good" and b.doubted:
                b.label = "undecided"
    inherit(found, marked)
    return "\n".join(b.text for b in found if b.label == "good")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
