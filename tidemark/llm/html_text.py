"""Main text of web pages: flat blocks, classified by a decision tree.

A page is cut into flat blocks of text at block-level tags. A block is described by its word
count and link density, those of its neighbours, and the elements it stands in: page furniture
by tag, page furniture by the names in class, id and role, an article or main element, a
heading. A name counts as a whole, cut at hyphens, underscores and capitals: a word for furniture
(weakly, if it is a topic as well), a compound of such words with words for boxes and lists, or
one that ends in the comments of someone; `related-work` and `closing-comments` say nothing. A
weak name for answers counts fully where a page repeats it. A decision tree over these numbers,
trained on the small labelled table below, tells main text from the rest; the blocks it accepts
are joined in page order by line feeds.

Scripts, styles, the head, form controls and hidden elements have no text. Character
references are decoded, then white space inside a block becomes one space. Broken markup is
read as browsers do where it matters: paragraphs may stay open, end tags without a start are
ignored, an unclosed comment, script, style, title or textarea takes the rest of the page; no
other element does.

Defined cases: null html counts as empty; a page without main text has an empty string, and a
page of a few words outside any article or main element counts as one without;
repeated rows and null ids or urls are ordinary rows; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.tasks import map_batches

#: Elements and attribute words by meaning.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea".split())
#: Dropped as far as their end tag; without one only the tag itself is.
DROPPED_TAGS = frozenset("noscript iframe xmp template svg select annotation annotation-xml".split())
SILENT_TAGS = frozenset("head button datalist audio video canvas".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline captcha comment comments commentlist "
    "consent contentinfo cookie cookies copyright dialog disqus footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice overlay pager pagination popup privacy promo promotion rail related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
#: Those that are topics of articles as well, and names that are both.
WEAK_WORDS = frozenset(
    "banner byline consent cookie cookies copyright dialog header login menu modal navigation notice overlay pagination "
    "privacy promotion rail related replies reply respond search share sharing skip social sponsor subscription teaser "
    "cookie-policy privacy-policy search-results social-media".split()
)
CONTENT_WORDS = frozenset("article content entry main post story".split())
#: Words that make a compound with those of furniture or content: share-buttons, main-menu, ad-slot.
BOX_WORDS = frozenset(
    "area articles bar block body bottom c div el js l o thread u wp box btn button buttons col column container desktop form group holder icon icons inner item "
    "items left link links list mobile outer page panel posts primary right row secondary section site slot stories text title top "
    "unit wrap wrapper".split()
)
FURNITURE_COMPOUNDS = frozenset(
    "also-like back-to-top log-in sign-up skip-to-content skip-to-main skip-to-main-content you-may-also-like you-might-also-like".split()
)
#: Before `comments`: words that make them part of the text, or of the state of a page.
EDITORIAL_WORDS = frozenset(
    "additional author authors brief closing concluding critical editor editorial editors final first further general has "
    "introductory last no opening show some with without".split()
)
#: Before `comment`: whose it is.
READER_WORDS = frozenset("article blog community customer facebook guest member post public reader single story user viewer visitor".split())
#: First and last words of notices, whatever stands between them.
NOTICE_WORDS = frozenset("ad advert advertisement consent cookie cookies gdpr newsletter promo sponsored".split())
NOTICE_BOXES = frozenset("banner bar box button container message modal notice overlay panel popup slot wrap wrapper".split())
#: Weak names that are reader comments where a page repeats them.
ANSWER_WORDS = frozenset("reaction reply respond response".split())

_TAG = re.compile(
    r"""<(?:!--(?P<comment>)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))|[!?/][^>]*+(?:>|\Z))"""
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_CAPITAL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_CLASSES = re.compile(r"""\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW_TAGS | DROPPED_TAGS}
#: Start tags that end an element left open: its own (but svg and template nest) and, in svg and select, those of blocks.
_BLOCK_START = "|".join(sorted(BLOCK_TAGS - {"option", "hr", "legend"}, key=len, reverse=True))
_CUT = {name: re.compile(rf"<(?:{name})(?=[\s/>])", re.I) for name in DROPPED_TAGS - {"svg", "select", "template"}}
_CUT |= {"svg": re.compile(rf"<(?:{_BLOCK_START}|foreignobject)(?=[\s/>])", re.I), "select": re.compile(rf"<(?:{_BLOCK_START}|select)(?=[\s/>])", re.I)}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    furniture: bool
    #: 2 for a name of furniture, 1 for one that is a topic as well.
    hinted: int
    content: bool
    heading: bool


def _words_of(name: str) -> list[str]:
    return _WORDS.findall(_CAPITAL.sub("-", name).lower())


def _repeated(page: str) -> frozenset[str]:
    """Class names for answers that a page uses again and again."""
    seen = Counter()
    for m in _CLASSES.finditer(page):
        for name in (m[1] or m[2] or m[3] or "").split():
            words = _words_of(name)
            if ANSWER_WORDS.intersection(words):
                seen["-".join(words)] += 1
    return frozenset(name for name, n in seen.items() if n > 1)


def _is_comment(name: str) -> bool:
    """Whether a name is that of one reader's comment, as article elements in lists of comments have it."""
    words = _words_of(name)
    return "comment" in words and all(w in BOX_WORDS or w in READER_WORDS or w in FURNITURE_WORDS for w in words)


@functools.lru_cache(50_000)
def _hint(name: str, repeated: frozenset[str] = frozenset()) -> int:
    """How far a whole class, id or role names furniture: 0, 1 or 2."""
    words = _words_of(name)
    name = "-".join(words)
    if name in repeated:
        return 2
    if name in WEAK_WORDS:
        return 1
    if name in FURNITURE_WORDS or name in FURNITURE_COMPOUNDS:
        return 2
    said = FURNITURE_WORDS.intersection(words)
    if said == {"header"} and CONTENT_WORDS.intersection(words):
        return 0
    if not said:
        return 0
    if all(w in FURNITURE_WORDS or w in BOX_WORDS or w in CONTENT_WORDS for w in words):
        return 2
    if words[-1] == "comments" and not EDITORIAL_WORDS.intersection(words):
        return 2
    if words[-1] == "comment" and READER_WORDS.issuperset(words[:-1]):
        return 2
    return 2 if words[0] in NOTICE_WORDS and words[-1] in NOTICE_BOXES else 0


def _marks(name: str, rest: str, repeated: frozenset[str]) -> tuple[bool, bool, int, bool]:
    """(silent, furniture by tag, furniture by attribute names, content) of an element."""
    attributes = {}
    if len(rest) > 1:
        for m in _ATTRIBUTE.finditer(rest):
            attributes.setdefault(m[1].lower(), next((g for g in m.groups()[1:] if g is not None), ""))
    silent = name in SILENT_TAGS or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
    silent = silent or bool(_HIDDEN.search(attributes.get("style", "").lower()))
    names = " ".join(attributes.get(a, "") for a in ("class", "id", "role"))
    if name in ("html", "body") or name in CONTENT_TAGS:
        comment = name == "article" and any(_is_comment(n) for n in names.split())
        return silent, False, 2 if comment else 0, name in CONTENT_TAGS and not comment
    hinted = max((_hint(n, repeated) for n in names.split()), default=0)
    return silent, name in FURNITURE_TAGS, hinted, hinted < 2 and bool(CONTENT_WORDS.intersection(_words_of(names)))


def _end_of(name: str, page: str, at: int, closes: dict[str, tuple[int, int]]) -> int:
    """Where the dropped element that starts before `at` ends; `at` if it is left open.

    `closes` holds the next end tag of each name, so that a page is searched once.
    """
    if name not in closes or closes[name][0] < at:
        close = _CLOSE[name].search(page, at)
        closes[name] = close.span() if close else (len(page) + 1, at)
    start, end = closes[name]
    if start > len(page):
        return at
    cut = _CUT[name].search(page, at, start) if name in _CUT else None
    return end if cut is None or cut[0].lower() == "<foreignobject" else at


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page."""
    found: list[Block] = []
    # open elements: name, silent, furniture, hinted, content, all with what they stand in
    stack: list[tuple[str, bool, bool, int, bool]] = [("", False, False, 0, False)]
    plain: list[str] = []
    linked: list[str] = []
    closes: dict[str, tuple[int, int]] = {}
    in_link, heading, at, n = False, False, 0, len(page)
    repeated = _repeated(page)

    def close_block() -> None:
        text = " ".join(html.unescape("".join(plain)).split())
        if text:
            links = len(html.unescape(" ".join(linked)).split())
            words = len(text.split())
            found.append(Block(text, words, min(words, links), *stack[-1][2:5], heading))
        plain.clear()
        linked.clear()

    while at < n:
        m = _TAG.search(page, at)
        text = page[at : m.start() if m else n]
        if text and not stack[-1][1]:
            plain.append(text)
            if in_link:
                linked.append(text)
        if m is None:
            break
        at = m.end()
        if m["comment"] is not None:
            end = page.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        if m["name"] is None:
            continue
        name, ends = m["name"].lower(), bool(m["end"])
        if name in RAW_TAGS:
            if not ends and not m["rest"].endswith("/>"):
                close = _CLOSE[name].search(page, at)
                at = close.end() if close else n
            plain.append(" ")
            continue
        if name in DROPPED_TAGS:
            if not ends and not m["rest"].endswith("/>"):
                at = _end_of(name, page, at, closes)
            plain.append(" ")
            continue
        if name in ("option", "optgroup") and not ends:
            # the choices of a select left open
            end = page.find("<", at)
            at = n if end < 0 else end
            continue
        if name == "a":
            in_link = not ends
            continue
        if name not in BLOCK_TAGS and name not in SILENT_TAGS:
            marks = _marks(name, m["rest"], repeated) if not ends and name not in VOID_TAGS and len(m["rest"]) > 6 else None
            if name in ("br", "img", "wbr", "input"):
                plain.append(" ")
            elif marks and (marks[0] or marks[2] == 2):
                # an inline element that hides its text or is marked as furniture
                close_block()
                _, silent, furniture, hinted, content = stack[-1]
                stack.append((name, silent or marks[0], furniture, max(hinted, marks[2]), content and marks[2] < 2))
            elif ends and any(e[0] == name for e in stack[1:]):
                close_block()
                while stack[-1][0] != name:
                    stack.pop()
                stack.pop()
            continue
        close_block()
        if ends:
            # a link left open ends with the block it stands in
            heading = in_link = False
            if name != "p" and any(e[0] == name for e in stack[1:]):
                while stack[-1][0] != name:
                    stack.pop()
                stack.pop()
            elif name == "p" and stack[-1][0] == "p":
                stack.pop()
            continue
        heading = name in HEADING_TAGS
        while stack[-1][0] == "p" or (name == "li" and stack[-1][0] == "li"):
            stack.pop()
        if name in VOID_TAGS or m["rest"].endswith("/>"):
            continue
        silent, furniture, hinted, content = _marks(name, m["rest"], repeated)
        _, s, f, h, c = stack[-1]
        if name == "header" and not c:
            furniture = True
        stack.append((name, s or silent, f or furniture, max(h, hinted), (c or content) and not furniture and hinted < 2))
    close_block()
    return found


#: What the tree sees of a block.
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "furniture", "hinted", "content", "heading")

#: Labelled blocks, a row each: the numbers of FEATURES, then 1 for main text.
LABELLED = """
 60 0.00  40 0.00  55 0.00 0 0 1 0 1
  9 0.00   0 0.00  30 0.00 0 0 1 1 1
  1 0.00  12 1.00   2 0.00 0 0 1 1 1
  2 0.00   1 0.00   0 0.00 0 0 1 0 1
  1 0.00   1 0.00   8 0.00 0 0 1 0 1
  4 0.00  70 0.00  60 0.00 0 0 1 1 1
 12 0.50  30 0.00  44 0.00 0 0 1 0 1
  5 1.00  25 0.00  31 0.00 0 0 1 0 1
  3 0.00   3 0.00   3 0.00 0 0 1 0 1
 25 0.00   9 0.00   8 0.00 0 0 1 0 1
200 0.02 150 0.00   6 0.00 0 0 1 0 1
  2 1.00  20 0.10   0 0.00 0 0 1 0 1
  1 1.00   1 1.00   1 1.00 1 0 0 0 0
  2 1.00   0 0.00   1 1.00 1 0 0 0 0
  1 1.00   1 1.00   9 0.00 1 0 0 0 0
  9 0.00   1 0.00   8 0.00 1 0 0 0 0
 30 0.00  20 0.00   0 0.00 1 0 0 0 0
 45 0.00  50 0.00  30 0.00 1 0 0 0 0
  4 0.00  90 0.00   0 0.00 1 0 0 1 0
 80 0.00  60 0.00  70 0.00 1 0 0 0 0
  6 0.30  80 0.00   5 1.00 1 0 1 0 0
  8 0.00   2 1.00   9 0.00 0 2 0 0 0
 40 0.00   2 1.00  12 0.00 0 2 0 0 0
 25 0.00  60 0.00  25 0.00 0 2 0 0 0
 90 0.00  70 0.00  60 0.00 0 2 0 0 0
  3 0.00  80 0.00  20 0.00 0 2 0 1 0
 12 0.00  12 0.00  12 0.00 0 2 1 0 0
 35 0.00  50 0.00  40 0.00 0 2 1 0 0
  2 1.00   2 1.00   2 1.00 0 2 0 0 0
 20 0.00  30 0.00   5 0.50 1 2 0 0 0
 70 0.00  50 0.00   1 1.00 0 0 1 0 1
 30 0.00   2 1.00   2 1.00 0 0 1 0 1
  3 0.00   2 1.00   2 1.00 0 0 1 1 1
  4 0.00  40 0.00   1 1.00 0 0 1 0 1
  2 1.00  30 0.00   3 1.00 0 0 1 0 1
 60 0.00  44 0.00   2 1.00 0 0 0 0 1
 25 0.00   3 1.00   4 1.00 0 0 0 0 1
 33 0.05   2 1.00   1 1.00 0 0 0 0 1
  9 0.00  14 0.00  20 0.00 0 2 1 0 0
 70 0.00  30 0.00   2 0.00 0 2 1 0 0
 40 0.00  60 0.00   2 1.00 0 2 1 0 0
 10 0.00  80 0.00   0 0.00 1 0 1 0 0
 30 0.00  80 0.00   2 0.00 1 0 0 0 0
  5 1.00   2 0.00  40 0.00 0 0 0 0 0
 14 0.80  60 0.00  20 0.00 0 0 0 0 0
 50 0.00  45 0.00  60 0.00 0 0 0 0 1
 24 0.00  15 0.00  30 0.00 0 0 0 0 1
 20 0.00  20 0.00  20 0.00 0 0 0 0 1
 17 0.00   9 0.00  18 0.00 0 0 0 0 1
 35 0.00  10 0.00  40 0.00 0 0 0 0 1
 28 0.10  30 0.00  26 0.00 0 0 0 0 1
 22 0.00   8 0.00  33 0.00 0 0 0 0 1
 18 0.00  40 0.00  35 0.00 0 0 0 0 1
 12 0.00  50 0.00  45 0.00 0 0 0 0 1
  8 0.00  30 0.00  60 0.00 0 0 0 1 1
  5 0.00   2 1.00  70 0.00 0 0 0 1 1
 16 0.00  25 0.00   3 0.00 0 0 0 0 1
150 0.00   6 0.00   4 0.00 0 0 0 0 1
  3 1.00   2 1.00   4 1.00 0 0 0 0 0
  4 1.00   3 1.00   2 1.00 0 0 0 0 0
  2 1.00   2 1.00  30 0.00 0 0 0 0 0
  6 0.80   5 1.00   3 1.00 0 0 0 0 0
 15 0.90  10 1.00  12 1.00 0 0 0 0 0
 30 0.70  20 0.90  25 0.80 0 0 0 0 0
 12 0.60   4 1.00   3 1.00 0 0 0 0 0
  3 0.00   2 1.00   2 1.00 0 0 0 0 0
  4 0.00   3 0.00   2 0.50 0 0 0 0 0
  2 0.00   1 0.00   3 0.00 0 0 0 0 0
  6 0.00   4 0.00   5 1.00 0 0 0 0 0
  5 0.00  60 0.00   2 1.00 0 0 0 0 0
  4 0.00  90 0.00   0 0.00 0 0 0 0 0
  2 0.00   3 1.00   2 1.00 0 0 0 1 0
  3 0.00   4 0.00   5 1.00 0 0 0 1 0
 30 0.80  40 0.00  30 0.00 0 0 1 0 1
 60 0.50   2 1.00   2 1.00 0 0 1 0 1
 25 1.00   3 1.00   3 1.00 0 0 1 0 1
100 0.60   0 0.00   0 0.00 0 0 1 0 1
 20 0.45  25 0.80  60 0.00 0 0 1 0 1
 16 0.90  12 1.00   5 1.00 0 0 1 0 1
 20 0.00   2 1.00   4 1.00 0 0 0 0 1
 18 0.10   6 0.90  30 0.00 0 0 0 0 1
 30 0.20  12 0.60   8 0.00 0 0 0 0 1
 17 0.00  30 0.80   0 0.00 0 0 0 0 1
 40 0.00   2 1.00  12 0.00 0 0 0 0 1
 30 0.00   3 1.00  40 0.00 0 0 0 0 1
 60 0.05   8 1.00  60 0.00 0 0 1 0 1
 35 0.00   1 1.00  20 0.00 0 0 1 0 1
 20 0.45  25 0.10  30 0.00 0 0 0 0 0
 40 0.60  30 0.00  20 0.00 0 0 0 0 0
 18 1.00   2 1.00   2 1.00 0 0 0 0 0
 90 0.50  50 0.00  45 0.00 0 0 0 0 0
 25 0.80  60 0.00  60 0.00 0 0 0 0 0
 60 1.00   0 0.00   3 1.00 0 0 0 0 0
 16 0.45   8 0.00   9 0.00 0 0 0 0 0
 22 0.35  20 0.10  20 0.00 0 0 0 0 1
 10 0.00  20 0.00  10 0.00 0 0 0 0 0
 14 0.10  30 0.00  25 0.00 0 0 0 0 0
 15 0.00  40 0.00   5 0.50 0 0 0 0 0
 13 0.00   2 1.00  20 0.00 0 0 0 0 0
  9 0.00  60 0.00  40 0.00 0 0 0 0 0
 11 0.20  12 0.00  35 0.00 0 0 0 0 0
  6 1.00  30 0.00  60 0.00 0 0 0 1 1
  4 1.00   3 1.00  70 0.00 0 0 0 1 1
 12 0.80  40 0.00 100 0.00 0 0 0 1 1
  9 0.50   5 0.00  50 0.00 0 0 0 0 1
 60 0.00  40 0.00  50 0.00 0 1 1 0 1
 21 0.00  20 0.00  20 0.00 0 1 1 0 1
 30 0.00   1 0.00  40 0.00 0 1 1 0 1
 45 0.10   2 0.00   2 1.00 0 1 1 0 1
  9 0.00  30 0.00   8 0.00 0 1 1 0 1
 21 0.00  21 0.00   0 0.00 0 1 1 0 1
 40 0.00  25 0.00   2 1.00 0 1 1 0 1
  2 0.00  30 0.00  40 0.00 0 1 1 1 1
  1 0.00  60 0.00  25 0.00 0 1 1 1 1
  2 0.00  40 0.00   1 1.00 0 1 1 0 0
  3 1.00   2 0.00   3 1.00 0 1 1 0 0
  3 1.00  20 0.00   3 1.00 0 1 1 0 0
  3 1.00   3 1.00   0 0.00 0 1 1 0 0
 12 0.80  30 0.00   9 1.00 0 1 1 0 0
  3 0.00   2 1.00   2 1.00 0 1 1 0 0
 60 0.00  50 0.00  40 0.00 0 1 0 0 1
 35 0.00  40 0.00  30 0.00 0 1 0 0 1
  8 0.00   2 1.00   9 0.00 0 1 0 0 0
 12 0.00  12 0.00  12 0.00 0 1 0 0 0
 40 0.00   2 1.00  12 0.00 0 1 0 0 0
  4 1.00   2 0.00   4 1.00 0 1 0 0 0
  3 0.00  80 0.00  20 0.00 0 1 0 1 0
"""
# the same main text inside furniture, by tag and by name, is none
_MAIN = [line.rsplit(maxsplit=5) for line in LABELLED.strip().splitlines() if line.endswith(" 1")]
LABELLED += "".join(f"{size} 1 0 {content} {heading} 0\n{size} 0 2 {content} {heading} 0\n" for size, _, _, content, heading, _ in _MAIN)


class Tree:
    """A decision tree by Gini impurity over numbers, with thresholds between neighbours."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 8):
        self.root = self._grow(rows, labels, depth)

    def _grow(self, rows: np.ndarray, labels: np.ndarray, depth: int):
        share = float(labels.mean())
        if depth == 0 or share in (0.0, 1.0):
            return share >= 0.5
        best = None
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for cut in (values[1:] + values[:-1]) / 2:
                low = rows[:, feature] < cut
                impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (labels[low], labels[~low]))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, feature, float(cut), low)
        if best is None:
            return share >= 0.5
        _, feature, cut, low = best
        return feature, cut, self._grow(rows[low], labels[low], depth - 1), self._grow(rows[~low], labels[~low], depth - 1)

    def accepts(self, row) -> bool:
        node = self.root
        while not isinstance(node, bool):
            node = node[2] if row[node[0]] < node[1] else node[3]
        return node


def train() -> Tree:
    table = np.array([[float(x) for x in line.split()] for line in LABELLED.strip().splitlines()])
    return Tree(table[:, :-1], table[:, -1])


def _described(found: list[Block]) -> list[tuple]:
    flat = [(0.0, 0.0)] + [(b.words, b.link_words / b.words) for b in found] + [(0.0, 0.0)]
    return [
        (*flat[i + 1], *flat[i], *flat[i + 2], b.furniture, b.hinted, b.content, b.heading) for i, b in enumerate(found)
    ]


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, row in zip(found, _described(found)) if tree.accepts(row))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages` (page_id, url, html)."""
    tree = train()

    def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", tree) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return map_batches(rows, text_batches, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
