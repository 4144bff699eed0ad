"""Main text of web pages by comparing each page with its nearest neighbour by URL on the same host.

A page is read as text lines in page order, all of them, menus and notices too. Every page's lines are aligned with those
of its neighbour by longest common subsequence: what they share is taken for the template, the rest for the text. Markup
then checks that: of the lines a page has for itself, those in navigation, headers, footers, notices, adverts, forms and
comments go, and of shared lines, those inside an article or main element come back, as articles quote each other.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcurate.llm.common import in_ranges, shuffle_partitions
from clipcurate.llm.url_templates import host_of, path_of

#: A page of which the neighbour has more than this share of the undecided text is a copy, not a template: all of it stays.
COPY_SHARE = 0.8

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

_INLINE = frozenset(
    "a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_NEVER_TEXT = frozenset(
    "script style noscript template head title svg math canvas iframe object audio video map textarea select button".split()
)
_FURNITURE = frozenset("nav aside footer form dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
_FURNITURE_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar nav navbar
    navigation menu breadcrumb breadcrumbs masthead footer cookie cookies consent notice gdpr popup modal overlay newsletter
    subscribe subscription signup login share sharing social related recommended comment comments respond reply replies
    disqus pagination pager toolbar widget""".split()
)


def _dropped(name: str, attributes: str, in_main: bool) -> bool:
    if name in _NEVER_TEXT or name in _FURNITURE or (name == "header" and not in_main):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True
        if key in ("class", "id"):
            parts = {p.lower() for p in _NAME_PART.findall(value)}
            if parts & _FURNITURE_NAMES or ("header" in parts and not in_main):
                return True
    return False


def lines_of(page: str) -> list[tuple[bool, str]]:
    """(inside an article or main element, text) of the lines of a page that markup does not rule out.

    Character references are decoded, white space becomes one space, and empty lines go. An element that is ruled
    out ends at its own end tag; without one, only its start tag is skipped.
    """
    return [(inside, text) for furniture, inside, text in marked_lines(page) if not furniture]


def marked_lines(page: str) -> list[tuple[bool, bool, str]]:
    """(ruled out by markup, inside an article or main element, text) of all lines of a page but scripts, styles and the like."""
    lower = page.lower() if page.isascii() else re.sub("[A-Z]", lambda m: m.group().lower(), page)
    lines: list[tuple[bool, bool, str]] = []
    parts: list[str] = []
    main = at = until = 0

    def close(furniture: bool) -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((furniture, main > 0, text))
        parts.clear()

    while True:
        if until and at >= until:
            close(True)
            until = 0
        out = at < until
        stop = until if out else len(page)
        found = _MARKUP.search(page, at, stop)
        if found is None:
            parts.append(page[at:stop])
            if not out:
                close(False)
                return lines
            at = until
            continue
        parts.append(page[at : found.start()])
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name or name in _INLINE and found.group(1):
            continue
        if found.group(1):
            close(out)
            if name in ("article", "main") and not out:
                main = max(0, main - 1)
            continue
        opens = name not in _VOID and not found.group(3).rstrip().endswith("/")
        if opens and (name in _NEVER_TEXT if out else _dropped(name, found.group(3), main > 0)):
            if name not in _INLINE:
                close(out)
            end = _end_of(lower, name, at)
            if out or name in _NEVER_TEXT or name in _INLINE:
                at = at if end < 0 else min(end, stop)
            else:
                until = end
            continue
        if name not in _INLINE:
            close(out)
            if name in ("article", "main") and not out:
                main += 1


def _end_of(lower: str, name: str, at: int) -> int:
    """Where the element whose start tag ends at `at` is over, or -1 if it is not closed."""
    if name in _NEVER_TEXT:
        end = lower.find(f"</{name}", at)
        return -1 if end < 0 else (lower.find(">", end) + 1 or len(lower))
    depth = 1
    for found in re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])[^>]*>").finditer(lower, at):
        depth += -1 if found.group(1) else 1
        if depth == 0:
            return found.end()
    return -1


def common_lines(left: list[str], right: list[str]) -> set[int]:
    """Numbers of the left lines in a longest common subsequence. One big integer holds a row of the table.

    A zero bit of a row is a place where the length grows, so the length up to a column is the number of zero bits.
    """
    places: dict[str, int] = {}
    for j, line in enumerate(right):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(right)) - 1
    rows = [full]
    for line in left:
        hit = rows[-1] & places.get(line, 0)
        rows.append(((rows[-1] + hit) | (rows[-1] - hit)) & full)
    shared: set[int] = set()
    i, j = len(left), len(right)
    length = (rows[i] ^ full).bit_count()
    while length:
        above = ((rows[i - 1] ^ full) & ((1 << j) - 1)).bit_count()
        if above == length:
            i -= 1
        elif rows[i] >> (j - 1) & 1:
            j -= 1
        else:
            shared.add(i - 1)
            i, j, length = i - 1, j - 1, length - 1
    return shared


def main_text(lines: list[tuple[bool, bool, str]], neighbour: list[tuple[bool, bool, str]] | None) -> str:
    """The lines that the neighbour does not have, checked against the markup of `marked_lines`, joined by one space.

    Lines of a page's own that markup rules out go, and so do those outside its article or main element, if it has one.
    Shared lines come back inside such an element, and in a copy: where they are more than `COPY_SHARE` of the text.
    """
    shared = common_lines([t for *_, t in lines], [t for *_, t in neighbour]) if neighbour else set()
    own = [i for i, (furniture, *_) in enumerate(lines) if i not in shared and not furniture]
    if any(inside and not furniture for furniture, inside, _ in lines):
        back = [i for i in shared if lines[i][1] and not lines[i][0]]
        kept = [i for i in own if lines[i][1]] + back
    else:
        back = [i for i in shared if not lines[i][0]]
        size, of = (sum(len(lines[i][2]) for i in chosen) for chosen in (back, own + back))
        kept = own + back if size > COPY_SHARE * of else own
    return " ".join(lines[i][2] for i in sorted(kept))


def extract(pages: DataFrame) -> DataFrame:
    """Add `main_text` to a table with `page_id`, `url` and `html`.

    Pages are ordered by (host, path, page_id); of the page before and the page after on the same host, the nearest
    is the one with the longer common beginning of the path, and the one after if both are equal. A page alone on
    its host has none, and its markup alone decides. Pages without `://` in the URL share the empty
    host. A null page has an empty text. Repeated rows of one page id are neighbours of each other and, being copies,
    keep their lines. Other columns than `html` are passed on; a column `main_text` is replaced.
    """
    columns = [c for c in pages.columns if c not in ("html", "main_text", "_url", "_host", "_path")]
    url = F.col("_url")
    keyed = (
        pages.select(*columns, "html")
        .withColumn("_url", F.coalesce("url", F.lit("")))
        .withColumns({"_host": host_of(url), "_path": path_of(url)})
        .drop("_url")
    )
    ranges = in_ranges(keyed, ["_host", "_path", "page_id"], shuffle_partitions(pages.sparkSession))
    schema = T.StructType([*[pages.schema[c] for c in columns], T.StructField("main_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = held = None
        for batch in batches:
            hosts, paths = batch.column("_host").to_pylist(), batch.column("_path").to_pylist()
            copies, htmls = batch.column("_copy").to_pylist(), batch.column("html").to_pylist()
            out, rows = [], []
            for i in range(batch.num_rows):
                row = (hosts[i], paths[i], copies[i], marked_lines(htmls[i] or ""), batch.slice(i, 1).select(columns))
                if held is not None:
                    if held[2] == 0:
                        rows.append(held[4])
                        out.append(_text_of(held, before, row if row[2] != 2 else None))
                    before = held
                held = row
            if rows:
                yield _with_text(rows, out)
        if held is not None and held[2] == 0:
            yield _with_text([held[4]], [_text_of(held, before, None)])

    return ranges.mapInArrow(run, schema)


def _text_of(row: tuple, before: tuple | None, after: tuple | None) -> str:
    nearest, reach = None, -1
    for other in (after, before):
        if other is not None and other[0] == row[0]:
            common = next((i for i, (a, b) in enumerate(zip(row[1], other[1], strict=False)) if a != b), None)
            common = min(len(row[1]), len(other[1])) if common is None else common
            if common > reach:
                nearest, reach = other[3], common
    return main_text(row[3], nearest)


def _with_text(rows: list[pa.RecordBatch], texts: list[str]) -> pa.RecordBatch:
    joined = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    return pa.RecordBatch.from_arrays([*joined.columns, pa.array(texts, pa.string())], [*joined.schema.names, "main_text"])
