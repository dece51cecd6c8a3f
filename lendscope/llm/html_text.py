"""Main text of web pages by scoring the tree of elements."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendscope.llm.tables import columns

# Names of elements, and words in class, id and role, that tell what an element is for.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul br".split())
PARAGRAPH = frozenset("p pre td blockquote li dd figcaption div section article main".split())
NOT_TEXT = RAW | frozenset(
    "head nav footer header aside form button select menu dialog noscript template object embed applet canvas svg math audio video map "
    "datalist fieldset".split())
NOT_TEXT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist tooltip status log".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising advertorial sponsor sponsors sponsored promo promos promotion promoted "
    "banner banners cookie cookies consent gdpr ccpa notice notices notification notifications alert alerts popup popover modal overlay "
    "lightbox paywall sidebar sidebars rail aside menu menus nav navi navbar navigation breadcrumb breadcrumbs pagination pager footer foot colophon "
    "masthead topbar toolbar comment comments commentlist disqus respond replies reply discussion share sharing social addthis related recommended "
    "recommendations newsletter subscribe subscription signup login register search searchbox widget widgets skip tags taboola outbrain "
    "copyright legal disclaimer".split())
HEADER_WORDS = frozenset("header head".split())
# Words that say where such a part stands or how it is built. A name with any other word (market-share, search-history) is the article's own.
FRAME_WORDS = frozenset(
    "area bar body bottom box block btn button buttons card cards center col column container content cta dialog fixed float form global group "
    "holder icon icons inline inner item items js layout left level line link links list lists main message module more new outer page panel pane "
    "placeholder policy post posts primary right row secondary section site slot small sticky sub tab text thread title tools top unit ui user "
    "view wrap wrapper zone".split())
KEPT_TAGS = frozenset("html body article main".split())
CLOSES = {  # a start tag ends an open element of these names, unless one of the others lies between
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th caption", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot tr td th caption", "table"),
    "tfoot": ("tbody thead tfoot tr td th", "table"), "thead": ("caption", "table"), "option": ("option", "select datalist")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
P_STAYS_OPEN_IN = frozenset("table button object applet marquee caption td th html".split())
ENDS_P = BLOCK - frozenset("br td th tr tbody thead tfoot caption option body html legend summary".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'](?=[^>\"']*>))*+)(?:>|\Z)"
    r"|<(?:/?[a-zA-Z][^>]*+)\Z", re.S)
_HINTS = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/]|\Z))", re.I)
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_COMMA = re.compile("[,،、，]")

SHORTEST = 25  # a shorter paragraph gives no points
POINTS_LENGTH = 100  # a point for so many characters of a paragraph
SIBLING_SHARE = 0.2  # of the points of an article: an element beside it that has so many is part of it
SIBLING_POINTS = 10.0
MENU_DENSITY = 0.6


class Page:
    """Elements in page order, each with the number of its parent, and runs of text with their elements."""

    def __init__(self, source: str):
        self.tag, self.parent, self.dropped, self.runs = ["html"], [-1], [False], []
        self._read(source)

    def _unwanted(self, tag: str, rest: str, in_article: bool) -> bool:
        if tag in NOT_TEXT and not (tag == "header" and in_article):
            return True
        for name, *values in _HINTS.findall(rest) if rest else ():
            value = html.unescape("".join(values))
            name = name.lower()
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN_STYLE.search(value):
                return True
            if name == "role" and value.lower() in NOT_TEXT_ROLES:
                return True
            if name in ("class", "id") and tag not in KEPT_TAGS:
                unwanted = NOT_TEXT_WORDS if in_article or tag in ("h1", "h2") else NOT_TEXT_WORDS | HEADER_WORDS
                for one in value.split():
                    words = {w.lower() for w in _WORD.findall(one)}
                    if words & unwanted and words <= unwanted | FRAME_WORDS | HEADER_WORDS:
                        return True
        return tag == "article" and bool({"comment", "comments", "reply"} & {w.lower() for w in _WORD.findall(rest)})

    def _read(self, source: str) -> None:
        stack, at = [0], 0
        opened = Counter()  # open elements by name: a search of the stack for one that is not there is never begun

        def pop_through(depth: int) -> None:
            opened.subtract(self.tag[i] for i in stack[depth:])
            del stack[depth:]

        def text(value: str) -> None:
            if value:
                self.runs.append((stack[-1], html.unescape(value)))

        while True:
            start = source.find("<", at)
            if start < 0:
                text(source[at:])
                return
            found = _TOKEN.match(source, start)
            if not found:
                text(source[at:start + 1])
                at = start + 1
                continue
            text(source[at:start])
            at = found.end()
            if found["data"]:
                self.runs.append((stack[-1], found["data"]))
            if not found["tag"]:
                continue
            tag = found["tag"].lower()
            if found["end"]:
                if tag == "br":
                    self.runs.append((stack[-1], " "))
                for depth in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                    if self.tag[stack[depth]] == tag:
                        pop_through(depth)
                        break
                continue
            if tag in ("html", "body"):
                continue
            if tag in ENDS_P and opened["p"]:
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] == "p":
                        pop_through(depth)
                        break
                    if self.tag[stack[depth]] in P_STAYS_OPEN_IN:
                        break
            if tag in CLOSES:
                ends, within = CLOSES[tag]
                for depth in range(len(stack) - 1, 0, -1) if any(opened[e] for e in ends) else ():
                    if self.tag[stack[depth]] in within:
                        break
                    if self.tag[stack[depth]] in ends:
                        pop_through(depth)
                        if tag not in ("tr", "tbody", "tfoot"):
                            break
            if tag in ("br", "hr"):
                self.runs.append((stack[-1], "\n" if tag == "br" else None))
            if tag in RAW:
                close = _RAW_END[tag].search(source, at)
                at = close.end() if close else len(source)
            elif tag not in VOID:
                parent = stack[-1]
                self.tag.append(tag)
                self.parent.append(parent)
                self.dropped.append(self.dropped[parent] or self._unwanted(tag, found["rest"] or "", opened["article"] > 0))
                stack.append(len(self.tag) - 1)
                opened[tag] += 1


def main_text(source: str | None) -> str:
    """The article of a page: blocks in page order, joined by one space, white space in each made one space."""
    if not source:
        return ""
    page = Page(source)
    n = len(page.tag)
    tag, parent = page.tag, page.parent
    # The block that holds each run, and the link that it lies in.
    block, in_link, in_article = list(range(n)), [False] * n, [False] * n
    for i in range(1, n):
        in_article[i] = tag[i] in ("article", "main") or in_article[parent[i]]
        if tag[i] not in BLOCK:
            block[i] = block[parent[i]]
        in_link[i] = tag[i] == "a" or in_link[parent[i]]
    own = [[] for _ in range(n)]
    length, linked, links = [0] * n, [0] * n, [0] * n
    for at, run in page.runs:
        if run and not page.dropped[at]:
            own[block[at]].append(run)
            size = len(" ".join(run.split()))
            length[at] += size
            linked[at] += size if in_link[at] else 0
    for i in range(n - 1, 0, -1):
        links[i] += tag[i] == "a"
        length[parent[i]] += length[i]
        linked[parent[i]] += linked[i]
        links[parent[i]] += links[i]

    def density(i: int) -> float:
        return linked[i] / length[i] if length[i] else 0.0

    # Lists and boxes that are mostly links are menus, but for those in what says it is the article.
    gone = list(page.dropped)
    for i in range(1, n):
        gone[i] = gone[i] or gone[parent[i]] or (
            not in_article[i] and tag[i] in ("ul", "ol", "dl", "div", "section", "table") and links[i] > 1 and density(i) > MENU_DENSITY)
    points: dict[int, float] = {}
    for i in range(n):
        if gone[i] or tag[i] not in PARAGRAPH or not own[i]:
            continue
        words = " ".join("".join(own[i]).split())
        if len(words) < SHORTEST:
            continue
        score = 1 + len(_COMMA.findall(words)) + len(words) / POINTS_LENGTH
        above, level = (i if tag[i] not in ("p", "li", "dd", "td", "pre", "blockquote", "figcaption") else parent[i]), 0
        while above >= 0:
            points[above] = points.get(above, 0.0) + score / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above, level = parent[above], level + 1
            if level > 6:
                break
    points = {i: p * (1 - density(i)) for i, p in points.items()}
    if points:
        best = max(points, key=lambda i: (points[i], -i))
        at = best
        while at > 0:  # an element that says it is the article knows better
            if tag[at] in ("article", "main"):
                best = at
                break
            at = parent[at]
        chosen = {best}
        beside = [i for i in range(1, n) if best > 0 and parent[i] == parent[best] and not gone[i] and i != best]
        if tag[best] == "article":  # its like beside it, and its title if that stands before it
            least = max(SIBLING_POINTS, points.get(best, 0.0) * SIBLING_SHARE)
            chosen |= {i for i in beside if points.get(i, 0.0) >= least}
            titled = any(tag[i] == "h1" and in_article[i] and not gone[i] for i in range(n))
            chosen |= {i for i in beside if tag[i] == "h1" and i < best and not titled}
        elif tag[best] != "main":  # nothing says what the article is: all beside the best that is not mostly links
            chosen |= {i for i in beside if density(i) <= MENU_DENSITY}
    else:  # nothing long enough: what calls itself the article, else all that is no menu or frame
        chosen = {i for i in range(n) if tag[i] in ("article", "main") and not gone[i]} or {0}
    inside = [False] * n
    for i in range(n):
        inside[i] = not gone[i] and (i in chosen or i > 0 and inside[parent[i]])
    blocks, current, last = [], [], -1
    for at, run in page.runs:
        if not inside[at]:
            continue
        if block[at] != last or run is None:
            blocks.append("".join(current))
            current, last = [], block[at]
        if run:
            current.append(run)
    blocks.append("".join(current))
    return " ".join(b for b in (" ".join(block_text.split()) for block_text in blocks) if b)


def extract_text(pages: DataFrame, source: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` with ``text`` and ``n_chars``; columns of those names are replaced.

    The whole html is read into a tree as browsers do (open paragraphs, unclosed tags and comments, and a page that breaks
    off are fine). Menus, page headers and footers, asides, forms, scripts, hidden elements, adverts, notices and reader
    comments go by element, role, and names in class and id that consist of such words. Each paragraph of 25 characters or more gives
    its parent a point, one per comma and one per 100 characters; the grandparent gets half, and farther
    ancestors less. Points are discounted by the share of the text that lies in links. The best element, or the
    article or main element around it, is kept; of its siblings all that are not mostly links, or beside an article those that score
    a fifth of it and a title before it. Link lists outside article and main are menus, those inside are references.
    A null or empty page, and one without any text, gives an empty text of 0 code points. Rows do not depend on each other.
    """
    carried = [c for c in pages.columns if c not in ("text", "n_chars")]
    base = pages.select(*columns(carried))
    plain = base.toDF(*[f"c{i}" for i in range(len(carried))])
    at = carried.index(source)
    schema = T.StructType([*plain.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(x.as_py()) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 names=[*part.schema.names, "text", "n_chars"])

    return plain.mapInArrow(extract, schema).toDF(*carried, "text", "n_chars")
