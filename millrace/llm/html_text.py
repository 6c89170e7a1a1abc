"""Main text of web pages, by differencing each page with its nearest neighbours by URL.

A page is cut into lines of text, one per block. Every page is paired with the
pages before and after it in the order of URL paths within its host, their
lines are aligned by longest common subsequence, and lines that a neighbour
shares are marked for deletion. A neighbour that shares nearly all lines is a
copy and says nothing.

Markup then checks the marks. Lines inside an article or main element are text
and stay, as articles may quote one another; lines inside menus, headers,
footers, sidebars, notices, adverts, forms and comments go, as these may be
drawn anew for each page. All lines of a page that has no article or main
element are open, and the marks decide.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.neighbours import ordered_neighbours
from millrace.llm.store import written
from millrace.session import BROADCAST_BYTES

TEXT, OPEN, DROP = 0, 1, 2
_COPY_SHARE = 0.8

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<!--|<[!?/][^>]*+>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z]+")

# Elements and names by their meaning in HTML.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "xmp", "annotation", "annotation-xml"}
# Where one of these has no end, it ends at the next block.
_RAW_TO_BLOCK = {"noscript", "svg", "object", "annotation", "annotation-xml"}
_BLOCK = re.compile(r"</?(?:p|div|article|main|section|header|footer|nav|aside|h[1-6]|[uod]l|li|table|blockquote|pre|form|body)\b", re.I)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp",
    "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
    "math", "mfrac", "mi", "mn", "mo", "mover", "mrow", "mroot", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "munderover", "semantics",
}
_MAIN = {"article", "main"}
_MAIN_ROLES = {"main", "article"}
_APART = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "fieldset", "datalist"}
_APART_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent",
    "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "paywall", "popup", "promo", "promotion", "related", "respond", "search", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe",
}
# Elements whose end may be left out do not hold others.
_OPTIONAL_END = {"p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot", "colgroup", "html", "body"}


def page_lines(page: str) -> list[tuple[str, int]]:
    """The lines of text of a page, in order, with TEXT, OPEN or DROP."""
    out: list[tuple[str, bool, bool, bool]] = []  # text, in main, apart, apart by more than names around the main element
    parts: list[str] = []
    stack: list[tuple[str, int, int, int]] = []  # element, main depth, apart depth, of it by more than names around main
    main = apart = inner = 0
    seen_main = seen_wrapped = False
    endless: set[str] = set()  # raw elements that have no end from here on
    at, n = 0, len(page)

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, main > 0, apart > 0, inner > 0))
            parts.clear()

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            parts.append(page[at:])
            break
        if lt > at:
            parts.append(page[at:lt])
        found = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not found:
            parts.append("<")
            at = lt + 1
            continue
        if found.lastindex is None:
            if found[0] == "<!--":
                end = page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            else:
                at = found.end()
            continue
        at = found.end()
        name = found[2].lower()
        if name not in _INLINE:
            close()
        if found[1]:
            if name in _OPTIONAL_END or name in _INLINE:
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    main -= sum(x[1] for x in stack[k:])
                    apart -= sum(x[2] for x in stack[k:])
                    inner -= sum(x[3] for x in stack[k:])
                    del stack[k:]
                    break
            continue
        if name in _VOID:
            continue
        if name in _RAW and not found[3].endswith("/"):
            end = None if name in endless else re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            if not end:
                endless.add(name)
                block = _BLOCK.search(page, at) if name in _RAW_TO_BLOCK else None
                at = block.start() if block else n
                continue
            stop = page.find(">", end.end())
            at = n if stop < 0 else stop + 1
            continue
        names, roles, hidden = set(), set(), False
        for m in _ATTRIBUTE.finditer(found[3]) if found[3] else ():
            value = (m[2] or m[3] or m[4] or "").lower()
            kind = m[1].lower()
            if kind == "hidden":
                hidden = True
            elif kind == "aria-hidden":
                hidden |= value == "true"
            elif kind == "role":
                roles.add(value)
            else:
                # 'sidebar' and 'sidebar-left', but not 'has-sidebar'
                names.update(next(filter(None, _SPLIT.split(token)), "") for token in value.split())
        is_main = name in _MAIN or bool(roles & _MAIN_ROLES)
        named = bool((names | roles) & _APART_NAMES)
        # a header or footer inside an article may hold its headline; only page-wide ones go by their element
        by_element = hidden or name in _APART and not (name == "header" and main > 0)
        is_apart = named or by_element
        # names around the outermost main element, or on it, may be those of the whole page
        is_inner = by_element and name != "form" or is_apart and main > 0
        if name in _INLINE or name in _OPTIONAL_END:
            if not is_apart or name in _OPTIONAL_END:
                continue
            close()
        if name in ("html", "body"):
            continue
        seen_main |= is_main and not is_apart and not apart
        seen_wrapped |= is_main and not is_inner and not inner
        main += is_main
        apart += is_apart
        inner += is_inner
        stack.append((name, int(is_main), int(is_apart), int(is_inner)))
    close()
    if seen_main:
        return [(t, TEXT if inside and not away else DROP) for t, inside, away, _ in out]
    # the only main elements are in containers with such names: they are the text if they hold more than what is open
    if seen_wrapped and sum(len(t) for t, inside, _, far in out if inside and not far) > sum(len(t) for t, _, away, _ in out if not away):
        return [(t, TEXT if inside and not far else DROP) for t, inside, _, far in out]
    return [(t, DROP if away else OPEN) for t, _, away, _ in out]


def common_lines(a: list, b: list) -> list[int]:
    """Positions in a of a longest common subsequence with b."""
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < min(hi_a, hi_b) and a[lo] == b[lo]:
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    where = defaultdict(list)
    for j in range(hi_b - 1, lo - 1, -1):
        where[b[j]].append(j)
    ends: list[int] = []  # least end in b of a common subsequence of each length
    links: list = []
    for i in range(lo, hi_a):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    middle, link = [], links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(lo), *reversed(middle), *range(hi_a, len(a))]


def _address(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "", url or ""
    return parts.netloc.lower(), parts.path


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its host, path, the hashes of its lines, and the positions of open ones."""
    for batch in batches:
        hosts, paths, hashes, open_ = [], [], [], []
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html"), strict=True):
            host, path = _address(url)
            lines = page_lines(page.as_py() or "")
            hosts.append(host)
            paths.append(path)
            hashes.append([hash_line(t) for t, _ in lines])
            open_.append([k for k, (_, z) in enumerate(lines) if z == OPEN])
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(hashes, pa.list_(pa.int64())), pa.array(open_, ints)],
            names=["key", "host", "path", "lines", "open"],
        )


def hash_line(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page the positions of lines that a neighbour, unless it is a copy, has in common, and those of them that are open."""
    for batch in batches:
        out, checked = [], []
        for own, open_, left, right in zip(*(batch.column(c).to_pylist() for c in ("lines", "open", "lines_before", "lines_after")), strict=True):
            shared: set[int] = set()
            for other in (left, right):
                if other:
                    both = common_lines(own, other)
                    if len(both) < _COPY_SHARE * max(len(own), len(other)):
                        shared.update(both)
            out.append(sorted(shared))
            checked.append(sorted(shared.intersection(open_)))
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, ints), pa.array(checked, ints)], names=["key", "shared", "gone"])


def _texts(with_gone: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            gone_of = batch.column("gone").to_pylist() if with_gone else [None] * batch.num_rows
            for page, gone in zip(batch.column("html"), gone_of, strict=True):
                drop = set(gone or ())
                lines = page_lines(page.as_py() or "")
                texts.append(" ".join(t for k, (t, z) in enumerate(lines) if z == TEXT or z == OPEN and k not in drop))
            chars = pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), chars], names=["page_id", "url", "text", "n_chars"]
            )

    return run


def shared_lines(pages: DataFrame) -> DataFrame:
    """(key, shared, gone) of every distinct key of (key, url, html).

    `shared` has the positions of lines that a nearest page by URL shares,
    `gone` those that go for it: markup does not say what they are.
    """
    survey = written(pages.mapInArrow(_survey, "key long, host string, path string, lines array<long>, open array<int>"), "html-survey")
    beside = ordered_neighbours(survey.select("host", "path", "key"), ["host", "path", "key"], "html-order")
    near = [F.when(F.col(f"{c}.host") == F.col("k.host"), F.col(f"{c}.key")).alias(c) for c in ("before", "after")]
    beside = beside.select(F.col("k.key").alias("page"), *near)
    lines = survey.select("key", "lines", "open").dropDuplicates(["key"])
    own = lines.join(beside, F.col("key") == F.col("page"))
    for c in ("before", "after"):
        other = lines.select(F.col("key").alias(f"{c}_key"), F.col("lines").alias(f"lines_{c}"))
        own = own.join(other, F.col(c) == F.col(f"{c}_key"), "left")
    gone = own.select("key", "lines", "open", "lines_before", "lines_after").mapInArrow(_shared, "key long, shared array<int>, gone array<int>")
    return written(gone, "html-shared")


def extract_text(pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars.

    Blocks are joined by one space; character references are decoded. A null or
    empty page has an empty text; one with a null or broken URL belongs to the
    host with no name. Repeated rows and pages with equal URLs each keep a row;
    equal rows get equal texts. Other columns are not read, and an empty table
    gives an empty result.
    """
    kind = pages.schema[id_column].dataType.simpleString()
    pages = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    pages = pages.withColumn("key", F.xxhash64("page_id", "url", "html"))
    gone = shared_lines(pages.select("key", "url", "html")).select(F.col("key").alias("of"), "gone").filter(F.size("gone") > 0)
    size = gone.agg(F.sum(F.size("gone") * 4 + 48)).first()[0]
    result = f"page_id {kind}, url string, text string, n_chars long"
    if size is None:
        out = pages.mapInArrow(_texts(False), result)
    else:  # pages themselves do not move unless very many lose lines
        gone = F.broadcast(gone) if size <= BROADCAST_BYTES else gone
        out = pages.join(gone, F.col("key") == F.col("of"), "left").drop("of", "key").mapInArrow(_texts(True), result)
    return out.withColumnRenamed("page_id", id_column).withColumnRenamed("url", url_column)
