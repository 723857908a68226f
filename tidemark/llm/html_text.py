"""Operator 6. Main text of HTML pages by tag-path ratios.

A page is read once into text blocks (the text between two block-level
boundaries) with their root-to-leaf tag paths. Per path, text length outside
links and punctuation are added up and divided by the number of blocks; along
the page these ratios are smoothed with a small Gaussian, averaged again per
path and fused (geometric mean). Paths over SPREAD standard deviations of the
fused ratios, and always the best one, hold the content nodes.

Scripts, controls, hidden parts, menus, asides and footers (by tag or role) hold no
article text. Everything else competes by score, names only weigh:

* a form around most of the text is looked through, any other is left out;
* article and main elements are the scope if they hold at least half of the prose of
  the page; of several articles those with a third of the prose of the best stay;
* a class or id word for menus, sidebars, notices, adverts, comments and the like lowers
  the score of the element's blocks (OUTER, inside article or main INNER), unless the
  element is a wrapper: it holds half of the prose, and the title or all prose but
  little. A name alone drops nothing that scores like content inside the scope.

Blocks that reach the threshold are the text. Others stay only as neighbours, and only
unnamed: headings inside an article or main, or over text that stays, in the smallest
element that holds all content nodes; lists, quotes, code and tables inside an
article or main; these and paragraphs between the first and last content block. A header
inside an article keeps its headings and sentences. Blocks that are mostly links stay
between content blocks or, on a content path, inside an article or main; closing
references there stay if they read like entries (marks and five words); elsewhere
neighbours that are mostly links go.

Text is unescaped after the markup is split off, white space in a block becomes
one space, blocks are joined by a line feed in page order; nothing is capped.
Edge cases: null and empty pages have an empty text; a page without markup is
one block; unclosed elements are closed where HTML implies it, an unclosed
comment, script or style runs to the end of the page; a "<" that starts no tag
is text; repeated pages are read row by row; null ids and urls are passed on.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

SPREAD, LINKS = 0.5, 0.5
#: What a name leaves of a block's score outside and inside an article or main.
OUTER, INNER = 0.05, 0.35
#: A wrapper holds this share of the prose; without the title, at most REST of it lies outside. An article competes from RIVAL of the best on.
MOST, REST, RIVAL = 0.5, 0.1, 1 / 3
KERNEL = (0.25, 0.5, 0.25)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var nobr center-inline math mi mn mo ms mtext mrow mfrac msup msub "
                   "msqrt msubsup".split())
#: Parts of a paragraph that do not end it; the text of those that are not SAYING is no part of a sentence.
PARTS = frozenset("button label select textarea svg iframe object canvas audio video template noscript".split())
SAYING = frozenset(("button", "label"))
#: Start tags that end a paragraph whatever is open in it.
BLOCKS = frozenset("p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th section article main header footer nav aside blockquote "
                   "pre figure figcaption form hr body html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset("head title nav footer aside button label legend select option optgroup datalist textarea noscript template iframe svg "
                  "object canvas audio video menu dialog script style".split())
ROLES = frozenset("navigation banner complementary contentinfo search alertdialog dialog menu menubar toolbar "
                  "tablist".split())
NOTES = frozenset(("alert", "status", "note"))
WORDS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors "
                  "promo promos promotion promoted banner banners sidebar sidebars rail menu menus nav navbar navigation "
                  "breadcrumb breadcrumbs crumbs footer foot masthead topbar comment comments commentlist disqus reply replies "
                  "respond discussion notice notices cookie cookies consent gdpr popup modal overlay lightbox newsletter "
                  "subscribe subscription signup signin login register share sharing social related recommended recommendations "
                  "widget widgets pagination pager toolbar skip alert alerts copyright search searchbox form poll "
                  "topnav sidenav subnav adbox adbanner usercomments feedback disclaimer announcement announcements "
                  "notification notifications".split())
#: Names of reader comments: these weigh as much inside an article as outside.
SAID = frozenset("comment comments commentlist disqus respond usercomments".split())
#: Elements whose text belongs to the content it stands in, however short.
TEXTS = frozenset("li dt dd blockquote pre table figcaption".split())
MAIN = frozenset(("article", "main"))
HEADS = frozenset(("header", "head", "heading-bar"))
#: Start tags that close an open element of the second kind (HTML's implied end tags).
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody", "thead"),
           "option": ("option",), "body": ("head",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
          "th": ("tr", "table"), "tbody": ("table",), "tfoot": ("table",)}
P_KEEPS = frozenset(("table", "td", "th", "button", "object", "caption", "html", "body"))

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<(script|style)\b[^>]*+>(?:.*?</\1\s*>|.*)|<(/?)([a-z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+>|[^>]*+>)"
    r"|<[!?/][^>]*+>", re.S | re.I)
RAW_END = re.compile(r"</(?:script|style)\s*>$", re.I)
ATTRIBUTE = re.compile(r"([a-z-]+)\s*+(?:=\s*+(\"[^\"]*\"|'[^']*'|[^\s>]*))?", re.I)
SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")


#: Element number of a part of a paragraph.
PART = -1


class Block:
    """Text between two block-level boundaries: its characters in links and its innermost element."""
    __slots__ = ("text", "links", "element")

    def __init__(self, text: str, links: int, element: int):
        self.text, self.links, self.element = text, links, element


class Tree:
    """Elements in page order (a parent has a smaller number): parent, tag, why left out, tag path, innermost block tag."""

    def __init__(self):
        self.parent, self.tag, self.why, self.path, self.block = [-1], [""], [""], [0], [""]
        self.paths: dict[tuple[int, str], int] = {}

    def add(self, parent: int, tag: str, why: str) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.why.append(why)
        inline = tag in INLINE  # paths are those of block-level tags
        self.path.append(self.path[parent] if inline else self.paths.setdefault((self.path[parent], tag), len(self.paths) + 1))
        self.block.append(self.block[parent] if inline else tag)
        return len(self.tag) - 1

    def upward(self, own: dict[int, int]) -> list[int]:
        """Sums over each element and all that lies in it."""
        total = [0] * len(self.tag)
        for n, v in own.items():
            total[n] = v
        for n in range(len(total) - 1, 0, -1):
            total[self.parent[n]] += total[n]
        return total

    def downward(self, own: list[bool]) -> list[bool]:
        """Whether an element or one around it is marked."""
        for n in range(1, len(own)):
            own[n] = own[n] or own[self.parent[n]]
        return own


def left_out(tag: str, attributes: str) -> str:
    """'' or how an element counts: 'tag' (never article text), 'form', 'head' (a header), 'word' or 'said' (named like boilerplate or comments)."""
    if tag in NEVER:
        return "tag"
    if tag in ("form", "fieldset"):
        return "form"
    if tag == "header":
        return "head"
    if not attributes or tag in ("html", "body", "main"):
        return ""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or role in ROLES or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return "tag"
    if role == "form":
        return "form"
    if tag in INLINE or tag in HEADINGS or tag == "pre":  # ids made of titles; parts of a sentence
        return ""
    words = {w.lower() for k in ("class", "id") for w in SPLIT.findall(found.get(k, ""))}
    if words & SAID:
        return "said"
    return "word" if words & WORDS or role in NOTES else "head" if words & HEADS else ""


def read_blocks(page: str) -> tuple[list[Block], Tree]:
    """Text blocks in page order and the elements; the time is in proportion to the page."""
    blocks: list[Block] = []
    tree = Tree()
    stack: list[tuple[str, int]] = [("", 0)]
    open_tags: dict[str, int] = defaultdict(int)
    parts: list[str] = []
    links = 0
    unsaid: set[str] = set()  # parts of the open paragraph whose text is no sentence

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(text, links, next(n for _, n in reversed(stack) if n != PART)))
        parts.clear()
        links = 0

    def pop_to(depth: int) -> None:
        if any(t not in INLINE and not (t in PARTS and n == PART) for t, n in stack[depth:]):
            flush()
        for t, _ in stack[depth:]:
            open_tags[t] -= 1
        del stack[depth:]

    def innermost(tags: tuple[str, ...], stops: frozenset | tuple[str, ...]) -> int:
        """Depth of the innermost open element of ``tags`` inside the innermost of ``stops`` (0: none)."""
        if any(open_tags[t] for t in tags):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in tags:
                    return depth
                if stack[depth][0] in stops:
                    break
        return 0

    def add(text: str) -> None:
        nonlocal links
        if unsaid and any(open_tags[t] for t in unsaid):
            return
        text = html.unescape(text)
        parts.append(text)
        if open_tags["a"]:
            links += len(" ".join(text.split()))

    at, last = 0, page.rfind(">") + 1  # no tag can end beyond
    for m in TOKEN.finditer(page, 0, last):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if not m[3]:
            if at == last and (not RAW_END.search(m[0]) if m[1] else m[0].startswith("<!--") and not m[0].endswith("-->")):
                at = len(page)  # an unclosed script, style or comment runs to the end
            continue
        tag = m[3].lower()
        if unsaid and tag not in BLOCKS and tag not in unsaid and any(open_tags[t] for t in unsaid):
            continue  # inside a list of options, a drawing
        if m[2]:  # end tag
            if depth := innermost((tag,), ()):
                pop_to(depth)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in PARTS and open_tags["p"]:  # inside a sentence
            if not m[4].endswith("/>"):
                stack.append((tag, PART))
                open_tags[tag] += 1
                if tag not in SAYING:
                    unsaid.add(tag)
            continue
        if tag not in INLINE:
            if depth := innermost(("p",), P_KEEPS):  # a block closes an open paragraph
                pop_to(depth)
            while tag in IMPLIED and (depth := innermost(IMPLIED[tag], SCOPES.get(tag, ()))):
                pop_to(depth)
            flush()
        if m[4].endswith("/>") and tag in ("svg", "path", "use"):
            continue
        why = left_out(tag, m[4][:-1].strip())
        around = next(n for _, n in reversed(stack) if n != PART)
        stack.append((tag, tree.add(around, tag, why)))
        open_tags[tag] += 1
    if at < len(page):
        add(page[at:].partition("<!--")[0])
    flush()
    return blocks, tree


def path_scores(blocks: list[Block], path: list[int]) -> dict[int, float]:
    """Fused, smoothed text and punctuation ratio of every tag path (``path``: of each block)."""
    nodes: dict[int, int] = defaultdict(int)
    text: dict[int, float] = defaultdict(float)
    marks: dict[int, float] = defaultdict(float)
    for b, p in zip(blocks, path):
        nodes[p] += 1
        text[p] += max(0, len(b.text) - b.links)
        marks[p] += len(PUNCTUATION.findall(b.text))
    smooth_mean = []
    for total in (text, marks):
        s = [total[p] / nodes[p] for p in path]
        padded = [s[0], *s, s[-1]]
        mean: dict[int, float] = defaultdict(float)
        for i, p in enumerate(path):
            mean[p] += sum(w * v for w, v in zip(KERNEL, padded[i:i + 3])) / nodes[p]
        smooth_mean.append(mean)
    # one more mark than counted, so that texts without punctuation are judged by length
    return {p: math.sqrt(smooth_mean[0][p] * (smooth_mean[1][p] + 1)) if text[p] else 0.0 for p in nodes}


def _selected(blocks: list[Block], tree: Tree, weight: list[float]) -> list[bool]:
    """Whether the score of each block's path reaches the threshold of the page's paths.

    A named block counts by its own text if that scores less than its path, lowered by its name."""
    path = [tree.path[b.element] for b in blocks]
    scores = path_scores(blocks, path)
    values = list(scores.values())
    mean = sum(values) / len(values)
    own = [scores[p] if w == 1 else w * min(scores[p], math.sqrt(max(0, len(b.text) - b.links) * (len(PUNCTUATION.findall(b.text)) + 1)))
           for b, p, w in zip(blocks, path, weight)]
    least = max(min(max(own), SPREAD * math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))), 1e-9)
    return [s >= least for s in own]


def _sentence(text: str) -> bool:
    return bool(PUNCTUATION.search(text)) and text.count(" ") >= 4


def _prose(b: Block) -> int:
    """Characters of a block that reads like text: not mostly links, with a mark or many words."""
    return len(b.text) if b.links <= LINKS * len(b.text) and (PUNCTUATION.search(b.text) or b.text.count(" ") >= 9) else 0


def _sums(tree: Tree, blocks: list[Block], values: list[float]) -> list[float]:
    own: dict[int, float] = defaultdict(float)
    for b, v in zip(blocks, values):
        own[b.element] += v
    return tree.upward(own)


def _weights(tree: Tree, blocks: list[Block], in_main: list[bool]) -> list[float]:
    """What the names of the elements around it leave of each block's score."""
    tags = range(len(tree.tag))
    prose = [float(_prose(b)) for b in blocks]
    held = _sums(tree, blocks, prose)
    titled = _sums(tree, blocks, [float(tree.block[b.element] == "h1" or in_main[b.element]) for b in blocks])
    headed = tree.downward([w == "head" for w in tree.why])
    free = held[0] - sum(p for p, b in zip(prose, blocks) if headed[b.element])  # page headers are no rival of a wrapper

    def wrapper(n: int) -> bool:
        if not held[n] or held[n] < MOST * held[0]:
            return False
        return bool(titled[n]) or tree.why[n] != "said" and free - held[n] <= REST * held[0]

    named = [w in ("word", "said") and not wrapper(n) for n, w in enumerate(tree.why)]
    outer = tree.downward([n_ and (not in_main[n] or tree.why[n] == "said" or tree.tag[n] == "article") for n, n_ in zip(tags, named)])
    inner = tree.downward(list(named))
    return [OUTER if outer[b.element] else INNER if inner[b.element] else 1.0 for b in blocks]


def _scope(tree: Tree, blocks: list[Block], weight: list[float], in_main: list[bool]) -> list[bool]:
    """Whether each block lies in the articles (or main) that hold most of the prose; all blocks if none do."""
    tags = range(len(tree.tag))
    mass = [_prose(b) * w for b, w in zip(blocks, weight)]
    held = _sums(tree, blocks, mass)
    within = tree.downward([t == "article" for t in tree.tag])
    tops = [n for n in tags if tree.tag[n] == "article" and not within[tree.parent[n]]]
    best = max((held[n] for n in tops), default=0.0)
    lost = tree.downward([n in set(tops) and held[n] < RIVAL * best for n in tags])
    inside = [in_main[b.element] and not lost[b.element] for b in blocks]
    total = sum(mass)
    if not any(inside) or sum(m for m, i in zip(mass, inside) if i) < MOST * total:
        return [True] * len(blocks)
    return inside


def main_text(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    blocks, tree = read_blocks(page)
    tags = range(len(tree.tag))
    never = tree.downward([w == "tag" for w in tree.why])
    blocks = [b for b in blocks if not never[b.element]]
    text = _sums(tree, blocks, [float(len(b.text)) for b in blocks])
    form = tree.downward([w == "form" and 2 * text[n] < text[0] for n, w in enumerate(tree.why)])
    in_main = tree.downward([t in MAIN for t in tree.tag])
    in_head = tree.downward([w == "head" for w in tree.why])

    def out(b: Block) -> bool:
        n = b.element  # a header inside an article keeps its headings and sentences
        return form[n] or in_head[n] and not (in_main[n] and (tree.block[n] in HEADINGS or _sentence(b.text)))

    left = [b for b in blocks if not out(b)] or [b for b in blocks if not form[b.element]]
    weight = _weights(tree, left, in_main)
    scope = _scope(tree, left, weight, in_main)
    left, weight = [b for b, s in zip(left, scope) if s], [w for w, s in zip(weight, scope) if s]
    if not left:
        return ""
    content = _selected(left, tree, weight)
    linked = [b.links > LINKS * len(b.text) for b in left]
    sure = [i for i, c in enumerate(content) if c and not linked[i]] or [i for i, c in enumerate(content) if c]
    if not sure:
        return ""
    found: dict[int, int] = defaultdict(int)
    for i in sure:
        found[left[i].element] += len(left[i].text)
    total = tree.upward(found)
    # the smallest element that holds all content nodes (numbers grow inwards)
    region = max((n for n in tags if total[n] >= total[0] and tree.tag[n] not in INLINE
                  and tree.tag[n] not in HEADINGS and tree.tag[n] not in ("p", "li")), default=0)
    within = tree.downward([n == region for n in tags])
    texts = tree.downward([t in TEXTS for t in tree.tag])
    kept, follows = [False] * len(left), None  # the block after, if it stays
    for i in range(len(left) - 1, -1, -1):  # backwards: a heading stays with what it stands over
        n = left[i].element
        between, main, named = sure[0] < i < sure[-1], in_main[n], weight[i] < 1
        if tree.block[n] in HEADINGS:
            over = follows is not None and (not named or weight[follows] < 1)
            kept[i] = content[i] and not named or main and not named or within[n] and over
            follows = i if kept[i] else None
            continue
        if content[i]:
            kept[i] = main or between or not linked[i] or i in (sure[0], sure[-1])
        elif in_head[n]:
            kept[i] = main and not named
        elif not named and (within[n] or main):
            entry = main and texts[n] and (not linked[i] or _sentence(left[i].text))
            kept[i] = (main if linked[i] else True) and between and (texts[n] or tree.block[n] == "p") or entry
        follows = i if kept[i] else None
    return "\n".join(b.text for b, k in zip(left, kept) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(p) for p in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page; one pass, no shuffle."""
    prepare(pages.sparkSession)
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
