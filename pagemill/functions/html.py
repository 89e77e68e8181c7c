"""Main-content text of an HTML page.

One left-to-right pass collects the visible text nodes in a list and notes, for
every element that matters (content candidates and paragraphs), the slice of
that list it covers. An element's text is then a join over a slice; no tree is
built. Element nesting follows the HTML living standard where it affects text:
implied end tags, void elements, raw-text elements, scope of end tags.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from pagemill.constants import (
    CONTENT_SELECTORS,
    DROPPED_TAGS,
    FALLBACK_SHARE,
    MIN_TEXT_LENGTH,
)
from pagemill.session import give_back

EXTRACT_TYPE = StructType(
    [
        StructField("text", StringType()),
        StructField("route", StringType()),
        StructField("n_segments", IntegerType()),
    ]
)

# Groups: 1 name of an end tag; 2 and 3 name and attributes of a start tag.
# Possessive quantifiers and "or end of input" keep the scan linear on any input.
_TOKEN = re.compile(
    r"""<(?:
        !--(?:-?>|.*?(?:--!?>|\Z))
      | /([a-z][^\s/>]*+)[^>]*+(?:>|\Z)
      | ([a-z][^\s/>]*+)
        ((?:[\s/]++
          | [^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|(?!["'])[^\s>]++)?+)?+
        )*+)(?:>|\Z)
      | [!?/][^>]*+(?:>|\Z)
    )""",
    re.IGNORECASE | re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(
    r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s>]++))?+)?+"""
)
_ATTRIBUTE_HINT = re.compile(r"content|main|-body|&")

_RAW_TEXT_END = {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*+(?:>|\Z)", re.IGNORECASE)
    for name in ("script", "style", "textarea", "iframe", "noscript", "title")
}

# Element classes of the HTML living standard (only what moves text around).
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_NO_TEXT = frozenset("rt rp template".split())
_FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
_TABLE_PARTS = frozenset("table caption colgroup tbody thead tfoot tr td th".split())
_CLOSES_P = frozenset(
    """address article aside blockquote center details dialog dir div dl dd dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li
    main menu nav ol p pre search section summary table ul""".split()
)
_BLOCK = _CLOSES_P | _TABLE_PARTS | DROPPED_TAGS | frozenset("template marquee".split())
_SCOPE_END = frozenset("table td th caption object applet template marquee button".split())
_CELL_SCOPE_END = frozenset("table td th caption object applet template marquee".split())
_TABLE_SCOPE_END = frozenset(("table", "template"))
_P = frozenset(("p",))
# start tag -> (open elements it ends, elements that stop the search)
_IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"} | _SCOPE_END),
    "dt": ({"dt", "dd"}, {"dl"} | _SCOPE_END),
    "dd": ({"dt", "dd"}, {"dl"} | _SCOPE_END),
    "rt": ({"rt", "rp"}, {"ruby"} | _BLOCK),
    "rp": ({"rt", "rp"}, {"ruby"} | _BLOCK),
    "td": ({"td", "th"}, {"tr", "table", "template"}),
    "th": ({"td", "th"}, {"tr", "table", "template"}),
    "tr": ({"tr", "td", "th"}, _TABLE_SCOPE_END),
    "tbody": (_TABLE_PARTS - {"table"}, _TABLE_SCOPE_END),
    "thead": (_TABLE_PARTS - {"table"}, _TABLE_SCOPE_END),
    "tfoot": (_TABLE_PARTS - {"table"}, _TABLE_SCOPE_END),
}
# A Spark string has less than 2^31 bytes, so a text of up to 2^29 characters always fits. Nested
# candidates repeat their text; a page that would exceed this has the route "error".
_MAX_TEXT_CHARS = 1 << 29

# What a start tag can do, as bits, so that the scan looks a name up only once.
_RAW, _ENDS_P, _ENDS_OTHERS, _DOCUMENT, _EMPTY, _HIDES, _PARAGRAPH = (1 << i for i in range(7))
_TRAITS = defaultdict(int)
for _names, _bit in (
    (_RAW_TEXT_END, _RAW),
    (_CLOSES_P, _ENDS_P),
    (_IMPLIED_END, _ENDS_OTHERS),
    (("html", "body"), _DOCUMENT),
    (_VOID | {"head"}, _EMPTY),
    (DROPPED_TAGS | _NO_TEXT, _HIDES),
    (("p",), _PARAGRAPH),
    (("a", "b", "em", "i", "label", "small", "span", "strong"), 0),
):
    for _name in _names:
        _TRAITS[_name] |= _bit
_TRAITS = dict(_TRAITS)

_SELECTOR_OF = {(kind, value): i for i, (kind, value, _) in enumerate(CONTENT_SELECTORS)}
_CONTENT_TAGS = {value: i for (kind, value), i in _SELECTOR_OF.items() if kind == "tag"}


def _selectors(name: str, attrs: str) -> list[int]:
    """Positions of the content selectors an element matches."""
    hits = [_CONTENT_TAGS[name]] if name in _CONTENT_TAGS else []
    if attrs and _ATTRIBUTE_HINT.search(attrs):
        seen = set()
        for key, *values in _ATTRIBUTE.findall(attrs):
            key = key.lower()
            if key in seen:
                continue
            seen.add(key)
            if key in ("class", "id", "role"):
                value = unescape("".join(values))
                for token in set(value.split()) if key == "class" else (value,):
                    if (key, token) in _SELECTOR_OF:
                        hits.append(_SELECTOR_OF[(key, token)])
    return hits


def _text(raw: str) -> str:
    return (unescape(raw) if "&" in raw else raw).strip()


def scan_page(html: str) -> tuple[list[str], list[list], list[list], int | None]:
    """Text nodes, slices per selector, slices of paragraphs, start of the body."""
    texts: list[str] = []
    found: list[list] = [[] for _ in CONTENT_SELECTORS]
    paragraphs: list[list] = []
    body = None
    # open elements; a formatting element that ended below others leaves an empty place
    stack: list[tuple[str | None, list | None, bool]] = []
    places: dict[str, list[int]] = defaultdict(list)  # where in the stack each name is open
    to_the_end: list[list] = []  # slices of <html> and <body>: their end tags move nothing
    hidden = 0

    def drop_empty() -> None:
        while stack and stack[-1][0] is None:
            stack.pop()

    def nearest(names) -> int:
        """Place of the innermost open element among `names`, or -1."""
        return max((places[n][-1] for n in names if n in places and places[n]), default=-1)

    def end_from(index: int) -> None:
        nonlocal hidden
        for name, span, hides in stack[index:]:
            if span:
                span[1] = len(texts)
            hidden -= hides
            if name is not None:
                places[name].pop()
        del stack[index:]
        drop_empty()

    def lookup(names, stops) -> int:
        """Lowest open element among `names` above the nearest of `stops`, or -1."""
        if nearest(names) < 0:
            return -1
        stop = nearest(stops - names)
        above = (places[n] for n in names if n in places)
        return min((p[i] for p in above if (i := bisect_right(p, stop)) < len(p)), default=-1)

    pos, size = 0, len(html)
    search, traits_of = _TOKEN.search, _TRAITS.get
    while True:
        token = search(html, pos)
        before, (stop, after) = pos, token.span() if token else (size, size)
        if stop > before and not hidden:
            text = _text(html[before:stop])
            if text:
                texts.append(text)
        if token is None:
            break
        pos = after
        kind = token.lastindex

        if kind == 3:
            name, attrs = token.group(2, 3)
            traits = traits_of(name)
            if traits is None:
                name = name.lower()
                traits = traits_of(name, 0)
            closed = attrs and attrs[-1] == "/"
            if traits & _RAW and not closed:
                end = _RAW_TEXT_END[name].search(html, pos)
                if name == "title" and not hidden:
                    text = _text(html[pos : end.start() if end else size])
                    if text:
                        texts.append(text)
                pos = end.end() if end else size
                continue
            if traits & _ENDS_P and places["p"]:
                open_p = lookup(_P, _SCOPE_END)
                if open_p >= 0:
                    end_from(open_p)
            if traits & _ENDS_OTHERS:
                ended = lookup(*_IMPLIED_END[name])
                if ended >= 0:
                    end_from(ended)
            if traits & _DOCUMENT:
                if not hidden and (body is None if name == "body" else not texts):
                    if name == "body":
                        body = len(texts)
                    for i in _selectors(name, attrs):
                        to_the_end.append([len(texts), None])
                        found[i].append(to_the_end[-1])
                continue
            if closed or traits & _EMPTY:
                continue
            hides = traits & _HIDES != 0
            hidden += hides
            span = None
            if not hidden:
                hits = _selectors(name, attrs)
                if hits or traits & _PARAGRAPH:
                    span = [len(texts), None]
                    for i in hits:
                        found[i].append(span)
                    if traits & _PARAGRAPH:
                        paragraphs.append(span)
            places[name].append(len(stack))
            stack.append((name, span, hides))

        elif kind == 1:
            name = token.group(1)
            if not (stack and stack[-1][0] == name):
                name = name.lower()
            if stack and stack[-1][0] == name:
                _, span, hides = stack.pop()
                if span:
                    span[1] = len(texts)
                hidden -= hides
                places[name].pop()
                drop_empty()
                continue
            if not places[name]:
                continue
            if name in _TABLE_PARTS:
                stops = _TABLE_SCOPE_END
            elif name in _BLOCK or name in _FORMATTING or name in _NO_TEXT:
                stops = _CELL_SCOPE_END
            else:
                stops = _BLOCK
            index = places[name][-1]
            if index < nearest(stops):
                continue
            if name in _FORMATTING and nearest(_BLOCK) > index:
                span = stack[index][1]
                stack[index] = (None, None, False)
                places[name].pop()
                if span:
                    span[1] = len(texts)
            else:
                end_from(index)

    end_from(0)
    for span in to_the_end:
        span[1] = len(texts)
    return texts, found, paragraphs, body


def page_text(html: str, min_len: int = MIN_TEXT_LENGTH) -> tuple[str, str, int]:
    """(text on one line, route taken, number of segments)."""
    texts, found, paragraphs, body = scan_page(html)
    slices, route = [], "none"
    for (_, _, label), spans in zip(CONTENT_SELECTORS, found):
        slices = [s for s in spans if s[1] > s[0]]
        if slices:
            route = label
            break
    if not slices:
        slices = [s for s in paragraphs if s[1] > s[0]]
        route = "p" if slices else "none"

    # lengths of the joined slices, from running totals
    ends = [0]
    for text in texts:
        ends.append(ends[-1] + len(text) + 1)
    chars = sum(ends[b] - ends[a] - 1 for a, b in slices)
    if chars < FALLBACK_SHARE * min_len or not slices:
        start = body or 0
        if len(texts) > start:
            route = f"{route}+body" if slices else "body"
            slices.append([start, len(texts)])
    if sum(ends[b] - ends[a] for a, b in slices) > _MAX_TEXT_CHARS:
        raise ValueError("page text too large")
    joined = " ".join(" ".join(texts[a:b]) for a, b in slices)
    return " ".join(joined.split()), route, len(slices)


def decode_page(raw: bytes | str) -> str:
    if isinstance(raw, str):
        return raw
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def text_extractor(min_len: int = MIN_TEXT_LENGTH):
    """Column function: page (BINARY or STRING) -> EXTRACT_TYPE.

    Marked nondeterministic so that a filter on the result cannot be pushed
    below the projection, where it would parse every page a second time.
    """

    @F.arrow_udf(EXTRACT_TYPE)
    def extract(pages: pa.Array) -> pa.Array:
        rows = []
        for page in pages:
            raw = page.as_py()
            if raw is None:
                rows.append((None, None, None))
                continue
            try:
                rows.append(page_text(decode_page(raw), min_len))
            except Exception:  # one bad page must not end the job; the caller fails its file
                rows.append((None, "error", 0))
        text, route, count = zip(*rows) if rows else ((), (), ())
        del rows
        give_back()
        return pa.StructArray.from_arrays(
            [pa.array(text, pa.string()), pa.array(route, pa.string()), pa.array(count, pa.int32())],
            names=["text", "route", "n_segments"],
        )

    return extract.asNondeterministic()
