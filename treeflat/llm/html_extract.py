"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with the path of the block-level elements from the root down to it (names and classes).  Per
path the text length and the punctuation of its blocks are added up and divided by their number.  Both ratios are
smoothed along the page, fused (geometric mean), and averaged per path; paths whose score reaches ``SHARE`` of the page's
text-weighted mean are content.  The deepest element that holds ``CORE`` of the content is the article; what it
holds is taken, headings and short paragraphs included.  Where that is the whole body, only content paths and the headings right
before them are taken.

What HTML itself marks as something else never counts: navigation, footers, scripts, hidden elements, and headers outside an article.
Forms and elements whose class, id or role names an advert, notice, menu, comment and so on (``BOILERPLATE``) do not count either, unless
they hold most of the page's text (``MOST``) and its article: a name such as ``content-sidebar-wrap`` then names the layout, and the element is read as any other.

Defined results: null and empty pages, and pages without text, give the empty text.  Tags that are never closed, quotes that never
end and comments that never end are read as browsers read them; drawings, media and objects that are never closed are read as ordinary elements.
Formulas are text; their annotations (the same formula in another notation) are not.  Work is row by row; nothing is shuffled, capped or cut.
A page costs time and memory in proportion to its length, however deep its elements lie: paths are numbers, and sums go up the tree once.
"""

from __future__ import annotations

from collections import defaultdict
import html
import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from treeflat.llm.common import ship

ship(__name__)

#: A path is content from this share of the page's mean score on.
SHARE = 0.25
#: The article is the deepest element with this share of the content's text.
CORE = 0.8
#: A form or named element with more than this share of the page's text may be the layout around the article.
MOST = 0.5
#: Without any article, main element or first heading on the page, remarks need this share.
REMARKS_MOST = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg object audio video canvas".split())
#: Read as ordinary elements where their end tag is missing.
MEDIA = frozenset("svg object audio video canvas".split())
MATH = frozenset(
    """math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle
    msub msubsup msup mtable mtd mtext mtr munder munderover none semantics annotation annotation-xml""".split()
)
INLINE = MATH | MEDIA | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED = frozenset("nav footer aside button select option dialog menu head annotation annotation-xml".split())
FORMS = frozenset("form fieldset".split())
BOILERPLATE = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion cookie cookies consent gdpr
    notice notices notification alert banner popup modal overlay newsletter subscribe subscription signup paywall sidebar side aside widget widgets
    related recommended recommendations share sharing social comment comments commentlist disqus respond reply replies discussion feedback
    menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer foot masthead copyright toolbar login search skip hidden""".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
REMARKS = frozenset("comment comments commentlist reply replies discussion respond".split())
_CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_SCOPE = frozenset("ul ol dl table html body article section main div".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<!--(?:.*?)(?:--!?>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_MARKS = re.compile(r"[.,;:!?…。、，；：！？]")


def _attributes(text: str) -> tuple[str, bool, bool, bool]:
    """(class as a path suffix, whether the names are boilerplate, whether they name remarks, whether it is hidden)."""
    if not text or text.isspace():
        return "", False, False, False
    names, suffix, boiler, hidden = set(), "", False, False
    for m in _ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            names.update(x.lower() for x in _NAME.findall(value))
            if name == "class":
                suffix = "." + ".".join(value.split())
        elif name == "role":
            boiler |= value.strip().lower() in ROLES
        elif name == "style":
            hidden |= bool(_HIDDEN.search(value))
        else:
            hidden |= name == "hidden" or value.strip().lower() == "true"
    return suffix, boiler or not names.isdisjoint(BOILERPLATE), not names.isdisjoint(REMARKS), hidden


class Page(NamedTuple):
    """The elements of a page by number in page order (0 stands for the page itself), and its visible blocks."""

    parent: list[int]  # the block-level element around it
    depth: list[int]
    tag: list[str]
    last: list[int]  # the largest number inside an element
    blocks: list[tuple[int, int, bool, str, int]]  # path, innermost element, whether it is a heading, text, characters inside links


def blocks(page: str) -> Page:
    """The elements and visible blocks of a page."""
    found, named, text, core = _read(page, frozenset())
    spared = set()
    for number, remarks, own_text, own_core in named:
        if own_text > MOST * text and (own_core or (not core and (not remarks or own_text > REMARKS_MOST * text))):
            spared.add(number)
    return _read(page, spared)[0] if spared else found


def _read(page: str, spared: frozenset | set) -> tuple[Page, list, int, int]:
    """The blocks; (number, whether it names remarks, characters, characters in articles and first headings) of every form and element
    named as boilerplate; the page's characters and those in articles and first headings.  Elements in ``spared`` are read."""
    out = Page([0], [-1], [""], [0], [])
    named: list[tuple[int, bool, int, int]] = []
    # name, number, whether it is skipped, whether it is a block, whether it never counts, whether it is an article, the counts before it where it is named
    stack: list[tuple] = []
    places: dict[str, list[int]] = defaultdict(list)  # where on the stack a name is open
    scopes: list[int] = []  # where elements of ``_SCOPE`` are
    endless: set[str] = set()  # names without a further end tag
    owners = [0]  # blocks on the stack
    trail = [0]  # their paths: numbers, as found in ``paths`` by the path around them and the own label
    paths: dict[tuple[int, str], int] = {}
    parts: list[str] = []
    linked = at = skipped = links = never = cores = total = core = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.blocks.append((trail[-1], owners[-1], out.tag[owners[-1]] in HEADINGS, text, linked))
        linked = 0

    def pop() -> None:
        nonlocal skipped, links, never, cores
        name, number, skip, block, hard, article, before = stack.pop()
        places[name].pop()
        if name in _SCOPE:
            scopes.pop()
        out.last[number] = len(out.tag) - 1
        skipped -= skip
        never -= hard
        cores -= article
        if before is not None:
            named.append((number, before[0], total - before[1], core - before[2]))
        links -= name == "a"
        if block:
            owners.pop()
            trail.pop()

    def close(names: frozenset | set, scoped: bool = False) -> None:
        """Pop through the innermost open element of ``names``; if ``scoped``, elements of ``_SCOPE`` shield what is above them."""
        depth = max((places[n][-1] for n in names if places.get(n)), default=-1)
        if depth < 0 or (scoped and scopes and depth < scopes[-1]):
            return
        if any(stack[k][3] for k in range(depth, len(stack))):
            flush()
        while len(stack) > depth:
            pop()

    def word(text: str) -> None:
        nonlocal linked, total, core
        if not never:
            n = sum(map(len, text.split()))
            total += n
            core += n if cores else 0
        if not skipped:
            parts.append(text)
            if links:
                linked += len(text)

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            word(page[at:])
            break
        if lt > at:
            word(page[at:lt])
        m = _TAG.match(page, lt)
        if m is None:  # a bare "<"
            word("<")
            at = lt + 1
            continue
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name == "p" or name not in INLINE:
                flush()
            close({name})
            continue
        attributes = m[3] if m[2] else m[6]
        if name in RAW:
            if name == "svg" and attributes.rstrip().endswith("/"):
                continue
            end = None if name in endless else re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            if end or name not in MEDIA:
                at = end.end() if end else len(page)
                continue
            endless.add(name)
        if name in MATH and attributes.rstrip().endswith("/"):
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name in ("br", "wbr"):
                word(" " if name == "br" else "")
            continue
        suffix, boiler, remarks, hidden = _attributes(attributes)
        block = name not in INLINE
        if block:
            flush()
            close({"p"}, True)
            if name in _CLOSES:
                close(set(_CLOSES[name].split()), True)
            if name in HEADINGS:
                close(HEADINGS, True)
        inside = places.get("article") or places.get("main")
        hard = hidden or name in SKIPPED or (name == "header" and not inside)
        if name in ("article", "main"):
            soft = remarks
        else:
            soft = name in FORMS or (boiler and name not in ("html", "body"))
        number = len(out.tag)
        skip = hard or (soft and number not in spared)
        article = name == "h1" or (name in ("article", "main") and not remarks)
        out.parent.append(owners[-1])
        out.depth.append(out.depth[owners[-1]] + 1)
        out.tag.append(name)
        out.last.append(number)
        places[name].append(len(stack))
        if name in _SCOPE:
            scopes.append(len(stack))
        stack.append((name, number, skip, block, hard, article, (remarks, total, core) if soft and not hard else None))
        skipped += skip
        never += hard
        cores += article
        links += name == "a"
        if block:
            owners.append(number)
            trail.append(paths.setdefault((trail[-1], name + suffix), len(paths) + 1))
    flush()
    while stack:
        pop()
    return out, named, total, core


def _path_scores(found: list) -> dict[int, float]:
    """Per path, the mean over its blocks of the smoothed and fused ratios."""
    chars, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, _, _, text, linked in found:
        chars[path] += max(0, len(text) - linked)
        marks[path] += len(_MARKS.findall(text))
        count[path] += 1
    by_text = [chars[b[0]] / count[b[0]] for b in found]
    by_mark = [marks[b[0]] / count[b[0]] for b in found]
    total = defaultdict(float)
    for k, b in enumerate(found):
        near = [(0.5, k), (0.25, max(k - 1, 0)), (0.25, min(k + 1, len(found) - 1))]
        t, m = (sum(w * ratio[i] for w, i in near) for ratio in (by_text, by_mark))
        total[b[0]] += math.sqrt(t * (1.0 + m))
    return {path: total[path] / count[path] for path in count}


def main_text(page: str | None) -> str:
    """The article's blocks, joined by a blank line."""
    parent, depth, tag, last, found = blocks(page or "")
    if not found:
        return ""
    scores = _path_scores(found)
    size = sum(len(b[3]) for b in found)
    threshold = SHARE * sum(scores[b[0]] * len(b[3]) for b in found) / size
    content = [scores[b[0]] >= threshold for b in found]
    inside = [0] * len(tag)
    for b, chosen in zip(found, content):
        if chosen:
            inside[b[1]] += len(b[3])
    for element in range(len(tag) - 1, 0, -1):  # what lies inside an element has a larger number
        inside[parent[element]] += inside[element]
    whole = inside[0]
    best = max((element for element in range(1, len(tag)) if 0 < inside[element] >= CORE * whole), key=lambda e: (depth[e], e), default=0)
    # a single paragraph is no article: go up to the element around it
    while depth[best] > 0 and (tag[best] in HEADINGS or tag[best] in ("p", "li", "td", "th", "tr", "dd", "dt", "blockquote", "pre")):
        best = parent[best]
    taken = []
    if best and tag[best] not in ("html", "body"):
        taken = [b[3] for b in found if best <= b[1] <= last[best]]
    if not taken:
        taken = [b[3] for k, b in enumerate(found) if content[k] or (b[2] and any(content[k + 1 : k + 2]))]
    return "\n\n".join(taken)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html)."""

    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
