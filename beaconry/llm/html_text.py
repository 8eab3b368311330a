"""Main text of a web page by tag-path ratios.

The page is cut into blocks of text, each with its root-to-leaf path of tags and classes. Per path the
length of text, its punctuation and the text inside links are added up over the page; a list (ul, ol, dl) counts
as one block of its path, so short entries are judged by the whole list. The ratios of a path - length per
block and punctuation per block, both less what is linked - make its own value; that is smoothed
over the blocks next to it in page order and in the same element, fused with the path's own (geometric mean), and a path is content if its mean
fused value reaches a share of the page's typical one. Marks only weigh: the value counts
`BONUS` times inside <article> or <main>, and `MARKED` times where a tag, role or whole class name says that
something else stands there (menus, footers, forms and so on). A heading goes with the block it heads.

Reading is lenient: unclosed and wrongly nested tags are common, so a closing tag closes the nearest
open tag of its name, and tags that HTML lets stay open are closed by what cannot be inside them. It is
one pass: nothing behind the last `>` is a tag, the ends of raw elements are looked up once per name.

Defined cases: null or empty html has no text; a page that is plain text is one block; scripts, styles
and comments are no text; white space is what Unicode says it is; repeated rows are pages of their own;
broken and very long pages take time in proportion to their length; only the columns in `keep` are carried
along, so others may have any name, and null ids and urls are fine; an empty table gives none.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp", "noframes")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var wbr".split())
#: Never part of an article.
APART = frozenset("nav footer aside form button select option dialog menu head object canvas audio video fieldset".split())
ROOTS = frozenset("article main".split())
CLOSED_BY = {"p": frozenset("p div article section aside nav footer header ul ol dl table pre blockquote form h1 h2 h3 h4 h5 h6 hr main figure".split()),
             "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
             "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar alertdialog".split())
#: Words of classes and ids that name what is not the article, and words that may stand beside them.
OTHER = frozenset("ad ads advert adverts advertisement advertising adbox banner promo promos promotion sponsor sponsors sponsored nav navbar navigation "
                  "menu menus breadcrumb breadcrumbs crumbs sidebar sidebars aside footer header masthead comment comments commentlist disqus replies reply "
                  "respond cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe signup login share sharing "
                  "social related recommended recommendations widget widgets pagination pager toolbar search tags disclaimer copyright legal hidden".split())
BESIDE = frozenset("top bottom left right main site page global primary secondary list item items box wrap wrapper container inner outer section area block "
                   "bar row col column links link form buttons button icons panel group holder unit slot zone".split())
_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])|\d+")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|"
                    r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_MARK = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_STOP = re.compile(r"[.,;:!?。，、…¿¡]")
SMOOTH, SHARE, FLOOR, BONUS, MARKED = 0.5, 0.22, 0.5, 3.0, 0.01
LISTS = frozenset("ul ol dl".split())
_LABEL = 80    # characters of a class that tell paths apart
DEEPEST = 100  # tags of a path that tell blocks apart


class Block:
    __slots__ = ("path", "text", "linked", "weight", "unit", "heading")

    def __init__(self, path, text, linked, weight, unit, heading):
        self.path, self.text, self.linked, self.weight, self.unit, self.heading = path, text, linked, weight, unit, heading


def names_other(value: str) -> bool:
    """Whether a whole class name or id says that no article is here: all of its words do, or go with one that does."""
    for name in value.split():
        words = [w.lower() for w in _PARTS.split(name) if w]
        if any(w in OTHER for w in words) and all(w in OTHER or w in BESIDE for w in words):
            return True
    return False


def _marks(attributes: str) -> tuple[str, bool]:
    """Class of a tag for its path, and whether the tag says it is not content."""
    names, other = "", False
    for m in _MARK.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind == "role":
            other |= value.lower() in ROLES
        elif kind == "hidden":
            other = True
        elif kind == "aria-hidden":
            other |= value.lower() == "true"
        else:
            other |= names_other(value)
            if kind == "class":
                names = ("." + ".".join(value.split()))[:_LABEL]
    return names, other


class _Places:
    """Where a pattern begins in a page, looked up once and then by search."""

    def __init__(self, page: str):
        self.page, self.known = page, {}

    def after(self, pattern: str, at: int) -> int:
        """First place at or behind `at`; the page's length if there is none."""
        if pattern not in self.known:
            self.known[pattern] = [m.start() for m in re.finditer(pattern, self.page, re.I)]
        places = self.known[pattern]
        i = bisect_left(places, at)
        return places[i] if i < len(places) else len(self.page)


def _behind_raw(places: _Places, at: int, name: str, closed: bool) -> int:
    """Place behind a raw element whose opening tag ends at `at`; an unclosed one ends before the next tag."""
    page = places.page
    over = places.after(rf"</{name}\b", at)
    end = page.find(">", over) + 1 if over < len(page) else 0
    if closed and (name == "svg" or not end or places.after(rf"<{name}\b", at) < over):
        return at
    return end or places.after(r"</?[a-zA-Z]", at)


def blocks(page: str) -> list[Block]:
    """Blocks of text of a page, in order."""
    stack: list[tuple[str, str, float, bool, int]] = []   # name, path, weight, inside an article, list it belongs to (0: none)
    solid: list[int] = []                                 # places in the stack of what is not inline
    opened: Counter[str] = Counter()
    out: list[Block] = []
    pieces: list[str] = []
    places = _Places(page)
    linked = lists = at = 0

    def flush():
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            name, path, _, _, unit = stack[solid[-1]] if solid else ("", "", 1.0, False, 0)
            weight = stack[-1][2] * (BONUS if stack[-1][3] else 1.0) if stack else 1.0
            out.append(Block(path, text, min(linked, len(text)), weight, unit or -len(out) - 1, name in _HEADINGS))
        pieces.clear()
        linked = 0

    def say(raw):
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if opened["a"]:
                linked += len(text.strip())

    def close(index):
        if solid and solid[-1] >= index:
            flush()
        while solid and solid[-1] >= index:
            solid.pop()
        opened.subtract(s[0] for s in stack[index:])
        del stack[index:]

    last = page.rfind(">")
    while at < len(page):
        m = _TOKEN.search(page, at) if at <= last else None
        if not m:
            hidden = min(p if p >= 0 else len(page) for p in (page.find("<!--", at), page.find("<![CDATA[", at)))
            say(page[at:hidden])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if opened[name] > 0:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            elif name in ("p", "br"):
                flush()
            continue
        name = m[2] or m[4]
        if not name:
            continue
        name = name.lower()
        attributes = m[3] if m[2] else m[5]
        if name in RAW:
            at = _behind_raw(places, at, name, attributes.rstrip().endswith("/"))
            flush()
            continue
        if name not in INLINE:
            if name == "br":
                pieces.append(" ")
                continue
            while solid and name in CLOSED_BY.get(stack[solid[-1]][0], ()):
                close(solid[-1])
            flush()
        if name in VOID or attributes.endswith("/") and name not in ("p", "div", "span", "a"):
            continue
        label, other = _marks(attributes) if attributes.strip() else ("", False)
        _, path, weight, rooted, unit = stack[-1] if stack else ("", "", 1.0, False, 0)
        rooted = rooted or name in ROOTS
        if other and name not in ("html", "body") or name in APART or name == "header" and not rooted:
            weight = MARKED
        listed = unit > 0
        if not listed and name in LISTS:
            lists += 1
            unit = lists
        if name not in INLINE:
            solid.append(len(stack))
            if not listed and len(stack) < DEEPEST:   # inside a list all blocks have the path of the list
                path = f"{path}/{name}{label}"
        opened[name] += 1
        stack.append((name, path, weight, rooted, unit))
    flush()
    return out


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _same_element(a: str, b: str) -> bool:
    """Whether two paths end in siblings, or one in the other's parent."""
    up, other = a.rpartition("/")[0], b.rpartition("/")[0]
    return up == other or up == b or other == a


def content_paths(parts: list[Block]) -> set[tuple[str, float]]:
    """Paths (with their weight) whose fused, smoothed ratios reach the page's threshold."""
    sums: dict[tuple, list] = {}
    for b in parts:
        s = sums.setdefault((b.path, b.weight), [set(), 0.0, 0.0, 0.0])
        s[0].add(b.unit)
        s[1] += len(b.text)
        s[2] += len(_STOP.findall(b.text))
        s[3] += b.linked
    own = {}
    for key, (units, chars, stops, linked) in sums.items():
        free = 1 - linked / chars
        own[key] = np.sqrt(chars / len(units) * free * (1 + stops / len(units) * free))
    # Neighbours in page order smooth the value where they stand in the same element; a list is one of them.
    first = [i for i, b in enumerate(parts) if not i or b.unit != parts[i - 1].unit]
    rows = np.array([own[parts[i].path, parts[i].weight] for i in first])
    beside = np.array([_same_element(parts[i].path, parts[j].path) for i, j in zip(first, first[1:])] or [], float)
    before, after = np.concatenate([[0.0], beside]), np.concatenate([beside, [0.0]])
    near = before * np.roll(rows, 1) + after * np.roll(rows, -1)
    count = before + after
    smooth = np.where(count > 0, (1 - SMOOTH) * rows + SMOOTH * near / np.maximum(count, 1), rows)
    of = np.cumsum([0] + [int(b.unit != a.unit) for a, b in zip(parts, parts[1:])])
    fused = np.sqrt(rows * smooth)[of] * np.array([b.weight for b in parts])
    free = np.array([(len(b.text) - b.linked) * b.weight for b in parts])
    if not free.sum():
        return set()
    least = max(FLOOR, SHARE * float((fused * free).sum() / free.sum()))
    total: dict[tuple, list[float]] = {}
    for b, f in zip(parts, fused):
        t = total.setdefault((b.path, b.weight), [0.0, 0])
        t[0] += float(f)
        t[1] += 1
    return {key for key, (value, n) in total.items() if value / n >= least}


def main_text(page: str | None, ratios: bool = True) -> str:
    """Text of the content blocks, one a line. Without `ratios` the marks alone decide (to see what the ratios do)."""
    parts = blocks(page or "")
    paths = content_paths(parts) if parts and ratios else {(b.path, b.weight) for b in parts if b.weight >= 1}
    kept, follows = [], None
    for b in reversed(parts):
        keep = (b.path, b.weight) in paths
        if b.heading:   # it goes with what it heads, unless that is marked otherwise or it is a link
            keep = keep if follows is None else follows[0] and b.weight >= follows[1] and b.linked < len(b.text)
        else:
            follows = (keep, b.weight)
        if keep:
            kept.append(b.text)
    return "\n".join(reversed(kept))


def extract(pages: DataFrame, html_col: str = "html", keep: tuple = ("page_id", "url")) -> DataFrame:
    """`keep` columns, text and n_chars of every page."""
    def work(batches):
        for batch in batches:
            last = batch.num_columns - 1
            texts = [main_text(p) for p in batch.column(last).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"])

    return arrow_map(pages.select(*keep, html_col), work, pages.select(*keep).schema.add("text", "string").add("n_chars", "long"))
