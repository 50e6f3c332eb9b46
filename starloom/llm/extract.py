"""HTML extraction by line-block distribution.

Markup is stripped to lines, one a block: block elements end a line, inline ones and ``<br>`` do not. Elements that never hold
article text (scripts, styles, menus, forms, footers, ...) and elements with a class, id or role whose whole name is that of such a part (adverts,
notices, sidebars, comments, ...) are stripped with all they hold, whatever its size. Ids count for containers outside the marked article only, and no shown
element goes that holds the article, or, where no article is marked, that wraps all of the page's unlinked text. Each line's weight is the length of its text; where the page marks its
article (``<article>``, ``<main>``, role main), lines outside it weigh nothing; elsewhere link text does not count.

The weights are summed over windows of ``WINDOW`` lines. Text starts at the first surge point, where the sum climbs from zero to over the threshold, and ends at
the last dive point, where the sum falls to zero for good. Lines between are kept, in page order, but for those between an inner dive and the next
line with weight: ``WINDOW`` lines or more that are links alone, a list of links. A shorter run of such lines is kept as paragraphs of the text.
The threshold is taken from the page: a ``SHARE``-th of its largest sum, ``THRESHOLD`` at most. A page that marks its article has the
threshold 0 and no text outside the mark: it is cut by its marks, so that even the shortest paragraph there stays. Marks without text do not count.

Defined results: NULL and empty pages give the empty text. Broken, unclosed or nested markup never fails. Elements end as HTML says: at
their end tag or their parent's; paragraphs, list items, table parts, options and the head also where the next start tag (or,
for the head, text) implies it. What is in scripts, styles and other raw text is never read as tags. A stripped element is stripped up to its end so found.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import free_name, read

WINDOW = 3
THRESHOLD = 86
SHARE = 20

_START = re.compile(r"<!--|<!\[CDATA\[|<[!?]|</?[A-Za-z]")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/<>]*+)")
_QUOTED = re.compile(r"(?:[^<>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+")  # a quote opens after '=' alone
_PLAIN = re.compile(r"[^<>]*+")
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
_DROP = frozenset("head script style title noscript template iframe svg math object canvas audio video nav header footer aside form "
                  "button select textarea menu dialog noembed noframes xmp".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_HIDDEN = frozenset("head script style title noscript template iframe svg math object canvas audio video button select textarea noembed "
                    "noframes xmp".split())  # never shown as text of the page
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TABLE = frozenset("table caption tbody thead tfoot tr td th".split())
_LISTS = frozenset("ul ol menu".split())
_SCOPE = frozenset("table td th caption template object html".split())  # end tags and implied ends do not reach beyond these
_ENDS_P = _BLOCK - frozenset("body html legend tbody td tfoot th thead tr".split())
# A start tag ends the nearest open one of the first set, and all in it, if none of the second set is nearer.
_ENDS = {"li": ({"li"}, _BLOCK - {"li", "address", "div", "p"} | _SCOPE), "tr": ({"tr", "caption"}, {"table"}),
         "button": ({"button"}, _SCOPE), "option": ({"option"}, {"select", "datalist", "optgroup"}),
         "optgroup": ({"optgroup"}, {"select"}),
         **dict.fromkeys(("dt", "dd"), ({"dt", "dd"}, _BLOCK - {"dt", "dd", "address", "div", "p"} | _SCOPE)),
         **dict.fromkeys(("td", "th"), ({"td", "th"}, {"tr", "table"})),
         **dict.fromkeys(("tbody", "thead", "tfoot"), ({"tbody", "thead", "tfoot", "caption"}, {"table"}))}
_ATTR = re.compile(r"(?<![^\s=\"'/])([^\s=\"'/]++)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
# Whole names of classes, roles and ids; '_' counts as '-'.
_NOT_TEXT = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menus "
                      "breadcrumb breadcrumbs sidebar aside footer notice notices cookie cookies consent gdpr popup modal alert comment comments "
                      "disqus reply replies respond form newsletter subscribe subscription signup login search share sharing social related "
                      "recommended pagination pager toolbar complementary contentinfo dialog "
                      "ad-banner ad-container ad-slot ad-unit ad-wrapper cookie-banner cookie-bar cookie-consent cookie-notice comment-form "
                      "comment-list comments-area disqus-thread login-form main-menu main-nav nav-links nav-menu newsletter-signup page-footer "
                      "promo-box related-articles related-links related-posts search-box search-form share-buttons share-links site-footer "
                      "site-nav social-links social-media social-share sponsored-content widget-area".split())
_OUTSIDE = frozenset("header masthead topbar page-header site-header".split())
_ID_MARKS = frozenset("div ul ol menu table td".split())  # elsewhere ids are link targets: headings, sections, items
_PART = frozenset("nav header footer aside form menu dialog".split())  # of _DROP: shown, so they may hold the article


def _names(tag: str, attributes: str) -> tuple[set[str], set[str], bool]:
    """Names of class and role, those of the id, and whether the role is main."""
    found: dict[str, set[str]] = {}
    for name, a, b, c in _ATTR.findall(attributes):
        if (name := name.lower()) in ("class", "id", "role"):
            found.setdefault(name, set((a or b or c).lower().replace("_", "-").split()))
    role = found.get("role", set())
    return found.get("class", set()) | role, found.get("id", set()) if tag in _ID_MARKS else set(), "main" in role


class _Element:
    __slots__ = ("tag", "at", "end", "before", "after", "names", "ids", "main", "code")

    def __init__(self, tag: str, attributes: str, at: int, before: int, code: bool):
        self.tag, self.at, self.before, self.code = tag, at, before, code  # before, after: unlinked characters up to there
        self.end, self.after = at + 1, before
        self.names, self.ids, self.main = _names(tag, attributes) if "=" in attributes else (set(), set(), False)
        self.main |= tag in ("article", "main")


class _Tokens:
    """The page's tags and what stands between, each place looked at a bounded number of times.

    A tag ends at the first '>' outside a quoted value. Where a '<' outside quotes or the page's end comes first, the quotes up to there are
    not trusted: tags that start before it end at the next '>' whatever is quoted, or are text if a '<' comes first.
    """

    def __init__(self, page: str):
        self.page, self.plain_until = page, 0

    def after(self, mark: str, at: int) -> int:
        found = self.page.find(mark, at)
        return found + len(mark) if found >= 0 else len(self.page)

    def next(self, at: int):
        """End, closing mark, tag, attributes of the next token and the text before it ('' for the tag of what is none)."""
        page, begin = self.page, at
        while m := _START.search(page, at):
            start, found = m.start(), m[0]
            if found in ("<!--", "<![CDATA["):
                return self.after("-->" if found == "<!--" else "]]>", m.end()), "", "", "", page[begin:start]
            if found in ("<!", "<?"):
                return self.after(">", m.end()), "", "", "", page[begin:start]
            tag = _TAG.match(page, start)
            end = _PLAIN.match(page, tag.end()).end()
            if start >= self.plain_until:
                quoted = _QUOTED.match(page, tag.end()).end()
                if quoted < len(page) and page[quoted] == ">":
                    end = quoted
                else:
                    self.plain_until = quoted
            if end == len(page):
                return end, "", "", "", page[begin:start]
            if page[end] == ">":
                return end + 1, tag[1], tag[2].lower(), page[tag.end():end], page[begin:start]
            at = end  # a '<' before any '>': text
        return len(page), "", "", "", page[begin:]


def _parse(page: str) -> tuple[list, int]:
    """The page in order: texts (text, in a link), None where a line ends, and elements that know where they end; its unlinked characters."""
    out: list = []
    stack: list[_Element] = []
    number: Counter = Counter()  # open elements of each tag
    link = hidden = unlinked = 0

    def close(first: int, last: int | None = None):
        nonlocal link, hidden
        for e in stack[first:last]:
            e.end, e.after = len(out), unlinked
            number[e.tag] -= 1
            link -= e.tag == "a"
            hidden -= e.tag in _HIDDEN
            if e.tag in _BLOCK:
                out.append(None)
        del stack[first:last]

    def nearest(tags, until) -> int:
        if not any(number[t] > 0 for t in tags):
            return -1
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in until:
                return -1
        return -1

    at, size, tokens = 0, len(page), _Tokens(page)
    while at < size:
        at, closing, tag, attributes, text = tokens.next(at)
        if text:
            if stack and stack[-1].tag == "head" and not text.isspace():
                close(len(stack) - 1)
            out.append((text, link > 0))
            if not link and not hidden:
                unlinked += len(text.strip())
        if not tag:
            continue
        if closing:
            if tag in _BLOCK:
                out.append(None)
            if tag in ("html", "body"):
                continue
            tags = _HEADINGS if tag in _HEADINGS else (tag,)
            i = nearest(tags, ("table",) if tag in _TABLE else _SCOPE | _LISTS if tag == "li" else _SCOPE)
            if i >= 0:  # an inline element ends alone where blocks opened in it go on
                close(i, i + 1 if tag not in _BLOCK and any(e.tag in _BLOCK for e in stack[i:]) else None)
            continue
        if stack and stack[-1].tag == "head" and tag not in _IN_HEAD:
            close(len(stack) - 1)
        if tag == "body" and (i := nearest(("head",), ())) >= 0:
            close(i)
        if tag in _ENDS_P and (i := nearest(("p",), _SCOPE | {"button"})) >= 0:
            close(i)
        if tag in _ENDS:
            tags, until = _ENDS[tag]
            if (i := nearest(tags, until)) >= 0:
                close(i)
        elif tag == "a" and (i := nearest(("a",), _SCOPE)) >= 0:
            close(i, i + 1)
        elif tag in _HEADINGS and stack and stack[-1].tag in _HEADINGS:
            close(len(stack) - 1)
        if tag in _BLOCK:
            out.append(None)
        elif tag == "br":
            out.append((" ", False))
        if tag in _VOID or attributes.endswith("/"):
            continue
        if tag in _RAW:  # holds no tags: up to its own end tag
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = tokens.after(">", end.end()) if end else size
            continue
        element = _Element(tag, attributes, len(out), unlinked, number["pre"] + number["code"] > 0)
        out.append(element)
        stack.append(element)
        number[tag] += 1
        link += tag == "a"
        hidden += tag in _HIDDEN
    close(0)
    return out, unlinked


def _stripped(e: _Element, inside: bool, article: _Element | None) -> bool:
    """Whether an element goes with all it holds. What holds the article stays."""
    if e.tag in _DROP and not (e.tag == "header" and inside):
        if e.tag not in _PART:
            return True
    else:
        names = e.names if inside else e.names | e.ids
        if e.main or e.code or e.tag in ("html", "body") or not (names & _NOT_TEXT or not inside and names & _OUTSIDE):
            return False
    return not (article and e.at < article.at < e.end)


def _wrappers(given: list, total: int) -> set[int]:
    """On a page that marks no article: the outermost parts that go, if together they hold all its unlinked text (a form around the whole
    page). These stay, and what they hold is looked at again."""
    spared: set[int] = set()
    while True:
        outermost, i = [], 0
        while i < len(given):
            x = given[i]
            if isinstance(x, _Element) and x.at not in spared and _stripped(x, False, None):
                outermost.append(x)
                i = max(i + 1, x.end)
            else:
                i += 1
        shown = [x for x in outermost if x.tag not in _HIDDEN and x.after > x.before]
        if not total or not shown or sum(x.after - x.before for x in shown) < total:
            return spared
        spared |= {x.at for x in shown}


def lines(page: str) -> tuple[list[tuple[str, int, bool]], bool]:
    """Lines of the page: (text, characters of link text, inside the marked article); whether the page marks one."""
    given, total = _parse(page)
    # The article: of the elements that mark one, that of most text. Others in a stripped element (comments, teasers) go with it.
    article = max((x for x in given if isinstance(x, _Element) and x.main), key=lambda x: x.after - x.before, default=None)
    spared = set() if article else _wrappers(given, total)
    out: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked, within = 0, False

    def flush():
        nonlocal linked, within
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append((text, linked, within))
        parts.clear()
        linked, within = 0, False

    i = until = 0  # until: the end of the marked article
    while i < len(given):
        x = given[i]
        if x is None:
            flush()
        elif isinstance(x, tuple):
            parts.append(x[0])
            linked += len(x[0]) * x[1]
            within |= i < until
        elif x.at not in spared and _stripped(x, i < until, article):
            if x.tag not in _BLOCK:
                parts.append(" ")
            i = x.end
            continue
        elif x.main:
            until = max(until, x.end)
        i += 1
    flush()
    return out, any(inside for _, _, inside in out)


def main_text(page: str | None, window: int = WINDOW, threshold: int = THRESHOLD) -> str:
    """The text between surge and dive points of the page's line-block distribution."""
    found, marked = lines(page) if page else ([], False)
    if not found:
        return ""
    weight = np.array([(len(t) if inside else 0) if marked else max(0, len(t) - linked) for t, linked, inside in found])
    sums = np.convolve(weight, np.ones(window, np.int64))[window - 1:]  # of the window that starts at each line
    limit = 0 if marked else min(threshold, sums.max() / SHARE)
    heavy = np.flatnonzero(weight)
    surges = np.flatnonzero(sums[heavy] > limit)
    if not len(surges):
        return ""
    first = surges[0]
    while first and heavy[first] - heavy[first - 1] <= window:  # to the foot of the climb: the sum was never zero from there on
        first -= 1
    heavy, kept = heavy[first:], []
    for a, b in zip(heavy, [*heavy[1:], heavy[-1]]):
        kept.append(found[a][0])
        if not marked and b - a <= window:  # fewer than a window of lines that are links alone: no dive between
            kept += [t for t, _, _ in found[a + 1:b]]
    return "\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, str]:
    """``pages`` with a string column more, the main text, and that column's name."""
    name = free_name(pages, "main_text")

    @F.arrow_udf(T.StringType())
    def texts(column: pa.Array) -> pa.Array:
        return pa.array([main_text(x) for x in column.to_pylist()], pa.string())
    return pages.withColumn(name, texts.asNondeterministic()(F.col(html_col))), name


def op3_extract(spark, sf_dir):
    found, t = extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col(t).alias("text"), F.char_length(t).cast("long").alias("n_chars"))
