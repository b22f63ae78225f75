"""Main text of web pages: parser events, text-to-tag ratios, smoothing and clustering.

The standard library's parser reports a page's tags and texts one after the other. They are
gathered into lines, one for each run of text between block-level tags, with the number of
tags seen meanwhile. The ratio of text to tags is smoothed over neighbouring lines with a
Gaussian kernel, and a threshold between two clusters of smoothed ratios marks content
lines. The content region is the element that holds the content lines: the page's ``main``
or else ``article`` where these hold most of their text, otherwise the deepest element that
holds them all, with the headings beside it. All lines of the region are returned, short ones too, except those inside
furniture: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
hidden elements and reader comments, known by tag, role, class or id. A class, an id or a
form proves little, since wrappers of whole pages bear such names too: these marks count only
on elements that hold neither most of the page's weight nor its article or main, and inside an
article not where they would take most of it. Where they
leave no article, main or content line, they do not count at all. Cards of other texts beside or after
the article, and what follows a heading that announces such texts, are left out too.

Every page is worked on inside its own row; nothing is shuffled and a page of n characters
takes time in proportion to n.

Defined results: null and empty html give an empty text; a page of which nothing is content
gives an empty text; repeated rows give repeated results; an empty table gives no rows;
other columns stay, clashing ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tempspan.llm.tables import given_columns

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "iframe legend li main menu nav noscript ol optgroup option p pre search section select "
    "summary table tbody td textarea template tfoot th thead title tr ul script style svg object "
    "canvas video audio math".split()
)
#: Elements whose text is never the article's.
FURNITURE = frozenset(
    "aside button canvas dialog footer frameset head iframe math menu nav noscript object "
    "script search select style svg template textarea title audio video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog menu menubar navigation "
    "search tablist toolbar".split()
)
#: Words in a class or id that name furniture.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs "
    "captcha comment comments commentlist consent cookie cookies copyright disclaimer disqus "
    "donate feedback footer gdpr hidden login masthead menu modal nav navbar navigation navbox newsletter "
    "notice notification outbrain pager pagination paywall popup promo promoted promotion "
    "recommended register related replies respond responses search share sharing shoutbox sidebar "
    "signup skyscraper social sponsor sponsored subscribe subscription taboola tags toc toolbar "
    "topbar widget widgets".split()
)
#: Those of HINTS that name lists of other texts, which may be longer than the article.
LIST_HINTS = frozenset(
    "comment comments commentlist disqus feedback outbrain promoted recommended related replies respond "
    "responses sponsored taboola".split()
)
#: These name furniture only outside the article.
OUTER_HINTS = frozenset("header headers bottom top".split())
#: A new one ends an open one of the same group, up to the nearest container.
ENDS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = frozenset("article aside body div dl footer form header main nav ol section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text: inside an article a part of their class or id says nothing.
TEXTUAL = HEADINGS | frozenset("blockquote dd dt figcaption figure li p pre td th".split())
#: These may close themselves, as other elements may not.
FOREIGN = frozenset("math svg".split())
#: Headings that announce other texts.
MORE = re.compile(
    r"\W*(read (next|more|also)|up next|what to read next|keep reading|more (from|in|on|like|stories|news|articles)\b.*"
    r"|related( (articles|stories|posts|content|reading|links|news))?|(you (may|might) )(also )?(like|enjoy).*"
    r"|recommended( (for you|reading|articles|stories))?|(most|also) (popular|read)|trending( now)?|latest( (news|stories))?"
    r"|mehr zum thema|lesen sie auch|weiterlesen|das könnte sie auch interessieren"
    r"|(à )?lire aussi|sur le même sujet|lea también|te puede interesar|artículos relacionados)\W*",
    re.IGNORECASE,
)
#: A card weighs less than this share of the article.
CARD_SHARE = 0.34
ENDS_PARAGRAPH = BLOCK - frozenset("button option optgroup script style svg template iframe".split())


#: How an element is marked as furniture: not, by a name or as a form, as a list of other
#: texts by a name, or beyond doubt.
PLAIN, NAMED, LISTED, SURE = range(4)


@dataclass
class Line:
    text: str
    n_tags: int
    n_linked: int
    inside: int


@dataclass
class Element:
    tag: str
    number: int
    in_article: bool


@dataclass
class Found:
    """A page's lines, and of its elements (0 is the page) the tag, the parent and the mark."""

    lines: list[Line] = field(default_factory=list)
    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])
    marks: list[int] = field(default_factory=lambda: [PLAIN])


def _mark(tag: str, attributes: list[tuple[str, str | None]], in_article: bool) -> int:
    if tag in FURNITURE or (tag == "header" and not in_article):
        return SURE
    if tag in ("html", "body"):
        return PLAIN
    given = dict(attributes)
    style = (given.get("style") or "").replace(" ", "").lower()
    if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style:
        return SURE
    role = (given.get("role") or "").lower()
    if role in ROLES:
        return SURE
    named = f"{given.get('class') or ''} {given.get('id') or ''}"
    words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()))
    if in_article and tag in TEXTUAL:
        words &= set(named.lower().split())
    if tag in ("article", "main"):
        words &= {"comment", "comments", "sponsored", "ad", "advert", "related"}
    if words & LIST_HINTS:
        return LISTED
    named = words & HINTS or (not in_article and words & OUTER_HINTS)
    return NAMED if named or tag == "form" or role == "form" else PLAIN


class Events(HTMLParser):
    """Gathers the parser's events into lines of text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found = Found()
        self.open: list[Element] = []
        self.text: list[str] = []
        self.n_tags = self.n_linked = 0
        self.n_open: Counter[str] = Counter()
        self.in_link = False

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            inside = self.open[-1].number if self.open else 0
            self.found.lines.append(Line(text, max(self.n_tags, 1), self.n_linked, inside))
            self.n_tags = 0
        self.n_linked = 0
        self.text.clear()

    def close_at(self, depth: int) -> None:
        self.end_line()
        self.n_open.subtract(e.tag for e in self.open[depth:])
        del self.open[depth:]

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.n_tags += 1
        if tag in VOID:
            if tag == "hr":
                self.end_line()
            elif tag in ("br", "wbr", "img"):
                self.text.append(" " if tag == "br" else "")
            return
        if tag == "a":
            self.in_link = True
        if tag not in BLOCK:
            return
        self.end_line()
        if tag == "body":
            self.close_tag("head")
        ended = ENDS.get(tag, set()) | ({"p"} if tag in ENDS_PARAGRAPH else set())
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag in ended:
                self.close_at(depth)
                break
            if self.open[depth].tag in CONTAINERS:
                break
        above = self.open[-1] if self.open else None
        in_article = bool(above and above.in_article)
        self.found.marks.append(_mark(tag, attributes, in_article))
        in_article = in_article or tag in ("article", "main")
        number = len(self.found.tags)
        self.found.tags.append(tag)
        self.found.parents.append(above.number if above else 0)
        self.open.append(Element(tag, number, in_article))
        self.n_open[tag] += 1

    def close_tag(self, tag: str) -> None:
        if not self.n_open[tag]:
            return
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                self.close_at(depth)
                return

    def handle_endtag(self, tag: str) -> None:
        self.n_tags += 1
        if tag == "a":
            self.in_link = False
        if tag in BLOCK and tag not in VOID:
            self.end_line()
            self.close_tag(tag)

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)
        if tag in FOREIGN:
            self.close_tag(tag)

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.in_link:
            self.n_linked += len(data.strip())


def closed(html: str) -> str:
    """The page without comments and tags that never end, which cost the parser n * n."""
    last = html.rfind("-->") + 1
    html = html[:last] + html[last:].replace("<!--", " ")
    last = html.rfind(">") + 1
    open_tag = re.search("<[a-zA-Z/!?]", html[last:])
    return html[: last + open_tag.start()] if open_tag else html


def parse(html: str) -> Found:
    events = Events()
    events.feed(closed(html))
    events.close()
    events.end_line()
    return events.found


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Ratios under a normalised Gaussian kernel of three sigmas to either side."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def threshold(values: np.ndarray) -> float:
    """The border between two clusters of values (means of two, repeated until fixed)."""
    border = float(values.mean())
    for _ in range(100):
        low, high = values[values < border], values[values >= border]
        if not len(low) or not len(high):
            return border
        moved = (float(low.mean()) + float(high.mean())) / 2
        if abs(moved - border) < 1e-9:
            return border
        border = moved
    return border


def marked_lines(lines: list[Line], sigma: float) -> np.ndarray:
    ratios = smoothed(np.array([len(x.text) / x.n_tags for x in lines], float), sigma)
    return ratios >= threshold(ratios)


def summed(values: list[float], parents: list[int]) -> list[float]:
    """The values of elements, each with those of all elements inside it."""
    total = list(values)
    for number in range(len(total) - 1, 0, -1):  # a parent has a smaller number
        total[parents[number]] += total[number]
    return total


def inherited(values: list[int], parents: list[int]) -> list[int]:
    """The greatest value of an element and those around it."""
    greatest = list(values)
    for number in range(1, len(greatest)):
        greatest[number] = max(greatest[number], greatest[parents[number]])
    return greatest


def weighed(found: Found, marked: np.ndarray, left: list[bool]) -> list[float]:
    """What elements weigh: their lines' text, a quarter of it where a line is not marked as
    content, and nothing of lines directly inside elements that are not ``left``."""
    weight = [0.0] * len(found.tags)
    for line, is_content in zip(found.lines, marked):
        if left[line.inside]:
            weight[line.inside] += len(line.text) * (1 if is_content else 0.25)
    return summed(weight, found.parents)


def settled_marks(found: Found, marked: np.ndarray) -> list[int]:
    """The marks of elements with those around them, after names that prove nothing are gone.

    A name or form does not count on an element that holds main or the longest article or, on
    a page without article and main outside of marks, most of the weight. A list of other
    texts may have articles of its own and be longer than the article; it must hold main, or
    with most of the weight the only main heading or nearly all.
    """
    tags, parents = found.tags, found.parents
    marks, around = list(found.marks), inherited(found.marks, parents)
    if NAMED not in marks and LISTED not in marks:
        return around
    weight = weighed(found, marked, [m != SURE for m in around])

    def held(tag: str, numbers: set[int]) -> list[float]:
        return summed([float(tags[n] == tag and n in numbers) for n in range(len(tags))], parents)

    seen = {n for n, m in enumerate(around) if m != SURE and weight[n]}
    articles = [n for n in seen if tags[n] == "article" and around[n] <= NAMED and marks[n] == PLAIN]
    longest = set() if not articles else {max(articles, key=lambda n: weight[n])}
    free = any(tags[n] in ("article", "main") and around[n] == PLAIN for n in seen)
    mains, longest, headings = held("main", seen), held("article", longest), held("h1", seen)
    for n, mark in enumerate(found.marks):
        most = not free and 2 * weight[n] > weight[0]
        if mark == NAMED and (mains[n] or longest[n] or most):
            marks[n] = PLAIN
        elif mark == LISTED and (
            (mains[n] and tags[n] != "main")
            or (most and headings[n] == headings[0] and (headings[n] or weight[n] >= 0.9 * weight[0]))
        ):
            marks[n] = PLAIN
    # Names that together take most of an article prove nothing there.
    nearest = [0] * len(tags)
    for n in range(1, len(tags)):
        nearest[n] = n if tags[n] in ("article", "main") and around[n] != SURE else nearest[parents[n]]
    settled = inherited(marks, parents)
    named = [0.0] * len(tags)
    for n, mark in enumerate(marks):
        if mark == NAMED and settled[parents[n]] == PLAIN and nearest[n] != n:
            named[nearest[n]] += weight[n]
    for n, mark in enumerate(marks):
        if mark == NAMED and nearest[n] and nearest[n] != n and 2 * named[nearest[n]] > weight[nearest[n]]:
            marks[n] = PLAIN
    return inherited(marks, parents)


def content_lines(found: Found, sigma: float, share: float) -> list[Line]:
    """The lines of the content region, in page order.

    An element weighs the text of its lines, lines that are not marked as content a quarter
    and furniture nothing. Articles and mains with at least ``share`` of a page's weight are
    the region, main before the articles in it; a single article without a main heading has
    those before it. Otherwise the region is the deepest element with all marked lines, or,
    if that has no main heading, the nearest one around it with a heading before it. Outside
    of articles, and of a main without any, lines that are mostly links and not marked are
    left out.
    """
    tags, parents = found.tags, found.parents
    marked = marked_lines(found.lines, sigma)
    marks = settled_marks(found, marked)
    for counted in (NAMED, LISTED, SURE):  # the least mark that makes furniture
        plain = [m < counted for m in marks]
        weight = weighed(found, marked, plain)
        settled = any(w and p and t in ("article", "main") for w, p, t in zip(weight, plain, tags))
        if settled or any(c and plain[x.inside] for x, c in zip(found.lines, marked)):
            break
    region, whole = set(), set()
    for tag in ("main", "article"):
        own = {n for n, name in enumerate(tags) if name == tag and weight[n]}
        inside = inherited([n in own for n in range(len(tags))], parents)
        outer = {n for n in own if not inside[parents[n]]}
        if outer and sum(weight[n] for n in outer) >= share * weight[0]:
            region = outer
            break
    linked = {x.inside for x in found.lines if 2 * x.n_linked > len(x.text)}
    headings = [n for n, tag in enumerate(tags) if tag in HEADINGS and plain[n] and weight[n] and n not in linked]
    main_headings = [n for n in headings if tags[n] == "h1"]
    if region:
        articles = {n for n, tag in enumerate(tags) if tag == "article" and weight[n]}
        within = inherited([n in region for n in range(len(tags))], parents)
        whole = {n for n in articles if within[n]} or region
        if len(region) == 1 and tag == "article" and not any(within[n] for n in main_headings):
            (only,) = region
            region |= {n for n in main_headings if n < only and parents[n] == parents[only]}
    else:
        region = {holding_all(found, marked, plain, headings)}
    within = inherited([n in region for n in range(len(tags))], parents)
    whole = inherited([n in whole for n in range(len(tags))], parents)
    card = inherited(cards(found, weight), parents)
    chosen = [
        x
        for x, is_content in zip(found.lines, marked)
        if plain[x.inside] and within[x.inside] and not card[x.inside]
        and (is_content or whole[x.inside] or 2 * x.n_linked <= len(x.text))
    ]
    return without_more(chosen, found)


def cards(found: Found, weight: list[float]) -> list[bool]:
    """Articles beside the heaviest one that tease other texts: much lighter, and after it or
    with a link."""
    tags, parents = found.tags, found.parents
    articles = [n for n, tag in enumerate(tags) if tag == "article" and weight[n]]
    result = [False] * len(tags)
    if len(articles) < 2:
        return result
    story = max(articles, key=lambda n: weight[n])
    around = {story, *_above(story, parents)}
    inside = inherited([n == story for n in range(len(tags))], parents)
    links = [0] * len(tags)
    for line in found.lines:
        links[line.inside] += line.n_linked > 0
    links = summed(links, parents)
    for n in articles:
        beside = n not in around and not inside[n]
        result[n] = beside and weight[n] < CARD_SHARE * weight[story] and (n > story or links[n] > 0)
    return result


def without_more(lines: list[Line], found: Found) -> list[Line]:
    """The lines without what follows a heading that announces other texts, in the element
    around it and up to the next heading of its rank there, if more text comes before it."""
    tags, parents = found.tags, found.parents
    gone: set[int] = set()
    for i, line in enumerate(lines):
        tag = tags[line.inside]
        if i in gone or tag not in HEADINGS or tag == "h1" or not MORE.fullmatch(line.text):
            continue
        around, j = parents[line.inside], i + 1
        while j < len(lines) and around in (lines[j].inside, *_above(lines[j].inside, parents)):
            other = lines[j].inside
            if parents[other] == around and tags[other] in HEADINGS and tags[other] <= tag:
                break
            j += 1
        before = sum(len(x.text) for k, x in enumerate(lines[:i]) if k not in gone)
        if before > sum(len(x.text) for x in lines[i + 1 : j]):
            gone.update(range(i, j))
    return [x for i, x in enumerate(lines) if i not in gone]


def holding_all(found: Found, marked: np.ndarray, plain: list[bool], headings: list[int]) -> int:
    """The deepest container of all marked lines that are no furniture, or one around it.

    If it has no main heading, it is the nearest one around it with a main heading or, as a
    child, another heading before it. Headings that are links do not count.
    """
    tags, parents = found.tags, found.parents
    holds = [0] * len(tags)
    for line, is_content in zip(found.lines, marked):
        holds[line.inside] += is_content and plain[line.inside]
    holds = summed(holds, parents)
    least = max((n for n, x in enumerate(holds) if x == holds[0] and tags[n] in CONTAINERS), default=0)
    first = {n for n in headings if tags[n] == "h1"}
    if summed([n in first for n in range(len(tags))], parents)[least]:
        return least
    beside = summed([n in first and n < least for n in range(len(tags))], parents)
    for n in headings:
        beside[parents[n]] += n < least
    return next((n for n in _above(least, parents) if beside[n]), least)


def _above(number: int, parents: list[int]) -> Iterator[int]:
    while number:
        number = parents[number]
        yield number


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.5) -> str:
    """The article of a page: blocks in page order, joined by an empty line."""
    if not html:
        return ""
    found = parse(html)
    return "\n\n".join(x.text for x in content_lines(found, sigma, share)) if found.lines else ""


def with_main_text(pages: DataFrame, html: str = "html", sigma: float = 1.0) -> DataFrame:
    """Add ``text`` and ``n_chars`` (its code points) to every page."""
    added = {"text": T.StringType(), "n_chars": T.LongType()}
    kept = [f for f in pages.schema.fields if f.name not in added]
    schema = T.StructType([*kept, *(T.StructField(k, v) for k, v in added.items())])
    names = [f.name for f in kept]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), sigma) for x in batch.column(at)]
            made = [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, *added])

    given, at = given_columns(pages, names, html)
    return given.mapInArrow(extract, schema)
