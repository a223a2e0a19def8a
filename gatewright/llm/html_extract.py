"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block element and an empty one for
each further block tag between two texts.  Scripts, styles and the like leave
nothing, and menus, headers, footers, sidebars, notices, adverts, forms, comment
sections (by element, role, or whole class or id) and hidden elements leave empty
lines; a header inside an article element is its headline and stays.  An element
that holds most of the page's text outside links is none of these, unless an
article element stands outside all such elements and has a fair share of its
text, or any if it is a header, footer or the like by element.  Where article
elements hold the page's largest text, the lines outside them count as empty,
and empty lines inside them in a row as one.

A line weighs its characters, without those of links unless it stands in an
article element.  The weights of WINDOW consecutive lines are summed.  Text
begins where the sum rises from nothing and ends where it dives to nothing; such
a stretch surges if the sum reaches SURGE (or the page's highest sum, if that is
less) in it.  The main text is all from the stretch before the first surge to
the one behind the last, so that a short stretch between or next to surging ones
stays, and those further off go, as what stands in a dive does.

Scale: a map over rows without a shuffle; each page is handled alone, in time
and memory in proportion to its length, also where its markup is broken.

Cases: null or empty html, or a page without text, gives an empty string;
unclosed or stray tags end with their parent; a tag without end is text, and
from the first one on a tag ends at the next >, quoted or not; a comment without
end goes to the end of the page; numbers beyond Unicode in character references
give U+FFFD; rows that repeat give equal results; columns that are not named in
`keep` are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SURGE = 3, 80
#: A named element of most text stays unless an article beside it has this share of its text.
FAIR_SHARE = 0.25
_NAME, _UNQUOTED = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)"), re.compile(r"[^>\"']*")
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in "script style noscript template textarea select svg math iframe object title canvas audio video".split()}
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img input".split())
_VOID = set("area base br col embed hr img input link meta source track wbr param".split())
_DROP = set("nav header footer aside form menu button dialog fieldset".split())
_FURNITURE = set("nav header footer aside menu button".split())
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_ROLES = set("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar".split())
#: A class or id names boilerplate if it has such a word and no words but these and _BESIDE ("cookie-notice", not "has-sidebar").
_BOILER = re.compile(
    r"ads?|advert\w*|adsbygoogle|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscri\w*|signup|login|nav|navbar|navigation|menus?|breadcrumbs?|header|masthead|footer|sidebars?|aside|widgets?|related|recommend\w*|share|sharing|social|comments?|commentlist|disqus|respond|replies|reply|pagination|pager|toolbar|skip|copyright",
    re.I,
)
_BESIDE = set("site page global main primary secondary top bottom left right upper lower list links link item items bar box area block section group buttons button icons form thread title text posts articles stories to and us my the".split())
_HEADINGS = {"header", "masthead"}
_ARTICLE = {"article", "main"}
_BARRIERS = _ARTICLE | {"body", "html"}
_HUGE = re.compile(r"&#[xX]?[0-9a-fA-F]{1000,};?")


def names_boilerplate(name: str, in_article: bool = False) -> bool:
    words = [w.lower() for w in re.split(r"[_-]+", name) if w and not w.isdigit()]
    found = [bool(_BOILER.fullmatch(w)) and not (in_article and w in _HEADINGS) for w in words]
    return any(found) and all(f or w in _BESIDE for f, w in zip(found, words, strict=True))


def is_boilerplate(tag: str, attrs: str, in_article: bool = False) -> bool:
    """Whether an element is boilerplate by its tag, role, hidden state, class or id."""
    if tag in _DROP and not (in_article and tag in _HEADINGS):
        return True
    if not attrs or tag in _BARRIERS:
        return False
    has: dict[str, str] = {}
    for name, *value in _ATTR.findall(attrs):
        has.setdefault(name.lower(), "".join(value))
    if "hidden" in has or has.get("aria-hidden", "").strip().lower() == "true" or _ROLES.intersection(has.get("role", "").lower().split()):
        return True
    return any(names_boilerplate(x, in_article) for x in [*has.get("class", "").split(), *has.get("id", "").split()])


def tags_of(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """start, end, lower-case name (empty for what is dropped whole), whether it closes, attributes of each piece of markup; start to end leaves no text."""
    last, quoted, strict, at = html.rfind(">"), {q: html.rfind(q) for q in "\"'"}, True, 0
    no_cdata = False
    while (start := html.find("<", at)) >= 0 and start < last:
        at = start + 1
        if html.startswith("!--", at):
            end = html.find("-->", at + 3)
            at = end + 3 if end >= 0 else len(html)
            yield start, at, "", False, ""
            continue
        if html.startswith("![CDATA[", at) and not no_cdata:
            end = html.find("]]>", at)
            no_cdata = end < 0
            if end >= 0:
                at = end + 3
                yield start, at, "", False, ""
                continue
        if html.startswith(("!", "?"), at):
            at = html.find(">", at) + 1
            yield start, at, "", False, ""
            continue
        name = _NAME.match(html, at)
        if not name:
            continue
        end = name.end()
        while strict:  # to the next > outside quotes
            end = _UNQUOTED.match(html, end).end()
            if end == len(html):
                strict = False
            elif html[end] == ">":
                break
            elif end < quoted[html[end]]:
                end = html.find(html[end], end + 1) + 1
            else:
                end += 1
        if not strict:
            end = html.find(">", name.end())
        tag, closes, attrs, at = name[1].lower(), html[start + 1] == "/", html[name.end() : end], end + 1
        raw = None if closes else _RAW.get(tag)
        if raw:
            stop = raw.search(html, at)
            at, tag = (stop.end() if stop else len(html)), ""
        yield start, at, tag, closes, attrs


def lines_of(html: str) -> list[tuple[str, int, int]]:
    """(text, characters within links, number of the article element it lies in or 0) of each line; boilerplate leaves empty lines."""
    lines: list[tuple[list[tuple[str, int, bool]], int]] = []
    stack: list[tuple[str, int, int]] = []  # tag, boilerplate element, article
    opened: dict[str, list[int]] = {}  # where the stack has each tag
    blocks: list[int] = []  # and what is not inline
    barriers: list[int] = []
    parts: list[tuple[str, int, bool]] = []  # text, the innermost boilerplate element it lies in or 0, whether in a link
    parent, size, furniture = [0], [0], [False]  # of boilerplate elements; the size leaves out links
    clear: dict[int, int] = {}  # text of article elements outside boilerplate
    articles = links = 0
    boiler, article = 0, 0

    def close() -> None:
        nonlocal parts
        lines.append((parts, article))
        parts = []

    def add(text: str) -> None:
        if text:
            parts.append((text, boiler, bool(links)))
            if not links:
                size[boiler] += len(text.strip())
                if article and not boiler:
                    clear[article] = clear.get(article, 0) + len(text.strip())

    def cut(k: int) -> None:
        while len(stack) > k:
            tag = stack.pop()[0]
            opened[tag].pop()
            for places in (blocks, barriers):
                if places and places[-1] == len(stack):
                    places.pop()

    at = 0
    for start, end, tag, closes, attrs in tags_of(html):
        add(html[at:start])
        at = end
        if not tag:
            continue
        if tag == "a":
            links = 0 if closes else 1
        inline = tag in _INLINE
        if not inline:
            close()
        if tag in _VOID:
            continue
        if closes:
            places = opened.get(tag)
            if places and (inline or not barriers or barriers[-1] <= places[-1]):
                cut(places[-1])
        else:
            if tag == "p" and blocks and stack[blocks[-1]][0] == "p":
                cut(blocks[-1])
            if tag in _ARTICLE:
                articles += 1
            within, around = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
            if is_boilerplate(tag, attrs, bool(around)):
                parent.append(within)
                size.append(0)
                furniture.append(tag in _FURNITURE)
                within = len(parent) - 1
            opened.setdefault(tag, []).append(len(stack))
            if not inline:
                blocks.append(len(stack))
            if tag in _BARRIERS:
                barriers.append(len(stack))
            stack.append((tag, within, articles if tag in _ARTICLE else around))
        boiler, article = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
    add(html[at:])
    close()
    for k in range(len(parent) - 1, 0, -1):
        size[parent[k]] += size[k]
    drop = [False]
    best = max(clear.values(), default=0)
    for k in range(1, len(parent)):  # what holds most of the page's text is no boilerplate, whatever its name, unless an article stands beside it
        drop.append(drop[parent[k]] or 2 * size[k] <= size[0] or best >= (1 if furniture[k] else FAIR_SHARE * size[k]))
    out = []
    for line, number in lines:
        kept = [(t, a) for t, k, a in line if not drop[k]]
        text = _HUGE.sub("\ufffd", "".join(t for t, _ in kept))
        out.append((" ".join(unescape(text).split()), sum(len(t.strip()) for t, a in kept if a), number))
    return out


def stretches(weights: list[int], window: int) -> list[tuple[int, int, int]]:
    """first, end and highest sum of each stretch between a rise of the window sums from nothing and their dive to nothing."""
    sums, total, n = [], sum(weights[:window]), len(weights)
    for i in range(n):  # of the lines i .. i+window-1
        sums.append(total)
        total += (weights[i + window] if i + window < n else 0) - weights[i]
    out, i = [], 0
    while i < n:
        j = i
        while j < n and sums[j]:
            j += 1
        if j > i:
            first = next(k for k in range(i, j) if weights[k])
            out.append((first, j, max(sums[i:j])))
        i = j + 1
    return out


def main_text(html: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    lines = lines_of(html or "")
    inside: dict[int, int] = {}
    for text, _, number in lines:
        if number and text:
            inside[number] = inside.get(number, 0) + len(text)
    weights = [0 if number else max(len(text) - links, 0) for text, links, number in lines]
    if inside and max(inside.values()) >= max((sum(weights[a:z]) for a, z, _ in stretches(weights, window)), default=0):
        held: list[str] = []
        for text, _, number in lines:
            text = text if number else ""
            if text or (held and held[-1]):
                held.append(text)
        texts, weights = held, [len(t) for t in held]
    else:
        texts, weights = [x[0] for x in lines], [len(text) if number else max(len(text) - links, 0) for text, links, number in lines]
    found = stretches(weights, window)
    high = min(surge, max((s for _, _, s in found), default=0))
    surging = [k for k, (_, _, s) in enumerate(found) if s >= high]
    main = found[max(surging[0] - 1, 0) : surging[-1] + 2] if surging else []
    return "\n".join(t for a, z, _ in main for t in texts[a:z] if t)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep` and text of each row."""
    from pyspark.sql.types import StringType, StructField, StructType

    pages = pages.select(*keep, F.col(html).alias("html__"))
    schema = StructType([*[pages.schema[c] for c in keep], StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column("html__")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])

    return pages.mapInArrow(run, schema)
