"""Splitting oversized texts at natural boundaries, range by range.

A text or file is looked at in ranges. Workers make a small table of the boundaries of each range; what a range's ends leave
open (white space, a line, a piece) is part of the table, so tables of neighbours can be stitched exactly, however long
their runs of white space are. Lengths become offsets by prefix sums, and pieces are emitted by offset: they begin anew at
anchors, which lie at fixed offsets and are found alike on both sides, so ranges need not wait for each other and the pieces
don't depend on how the ranges are cut. No step holds more of a file than a range and its halo.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkspan.llm.arrow import map_partitions, struct
from inkspan.session import cut_lineage

#: Boundaries from the best to the least, and what they look like.
LEVELS = ("page", "paragraph", "line", "word")
MARKER = "--- PAGE BREAK ---"
PATTERNS = tuple(
    re.compile(p, re.MULTILINE)
    for p in (r"^[^\S\n]*--- PAGE BREAK ---[^\S\n]*$", r"\n(?:[^\S\n]*\n)+", r"\n", r"\s+")
)
#: Characters of a text's range, bytes of a file's, ranges of a file that are stitched at a time, anchors in limits.
RANGE, RANGE_BYTES, STITCH, SPAN = 4096, 64 << 20, 1024, 16
NONE = -1


# -- boundary tables ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Table:
    """The boundaries of a range, as offsets in it.

    n: characters. gaps: white space at its ends, then for paragraph, line and word: start and end of the first piece,
    longest piece between, start and end of the last one, 1 for a single piece or 2. page: 1 if the range has no line end,
    else 0; the extent of its open first line; its complete lines by page; the extent of its open last line. head, tail:
    the open lines, as short as they need to be to tell whether they become page breaks.
    """

    n: int
    gaps: tuple[int, ...]
    page: tuple[int, ...]
    head: str
    tail: str


def _extent(text: str, a: int, b: int) -> tuple[int, int]:
    """Offsets of the first and after the last character of text[a:b] that is no white space, else NONE."""
    part = text[a:b]
    left = part.lstrip()
    if not left:
        return NONE, NONE
    start = b - len(left)
    return start, start + len(left.rstrip())


def _short(line: str) -> str:
    """A part of a line that can be told from a page break's parts as well as the whole part."""
    inner = line.strip()
    if not inner:
        return line[:2]
    at = line.find(inner)
    return line[:at][:2] + (inner if len(inner) <= len(MARKER) else "\0" * (len(MARKER) + 1)) + line[at + len(inner) :][:2]


def _line(head: str, extent: tuple[int, int]) -> tuple[int, ...]:
    """The pages of one complete line."""
    return (1, NONE, NONE, 0, NONE, NONE) if head.strip() == MARKER else (0, *extent, 0, NONE, NONE)


def _pages(text: str, a: int, b: int) -> tuple[int, ...]:
    """Boundary?, first piece, longest between, last piece of the complete lines text[a:b]."""
    at, first, longest, any_ = a, None, 0, 0
    if MARKER in text:
        for m in PATTERNS[0].finditer(text[a:b]):
            piece = _extent(text, at, a + m.start())
            if first is None:
                first = piece
            else:
                longest = max(longest, piece[1] - piece[0])
            at, any_ = a + m.end(), 1
    last = _extent(text, at, b)
    return (0, *last, 0, NONE, NONE) if first is None else (any_, *first, longest, *last)


def table_of(text: str) -> Table:
    """The table of one range."""
    s, e = _extent(text, 0, len(text))
    head_end, tail_at = text.find("\n"), text.rfind("\n")
    if head_end < 0:
        page, head, tail = (1, s, e, *[NONE] * 8), _short(text), ""
    else:
        head, tail = _short(text[:head_end]), _short(text[tail_at + 1 :])
        inner = _pages(text, head_end + 1, tail_at) if tail_at > head_end else (0, NONE, NONE, 0, NONE, NONE)
        page = (0, *_extent(text, 0, head_end), *inner, *_extent(text, tail_at + 1, len(text)))
    if s == NONE:
        return Table(len(text), (int(bool(text)), min(2, text.count("\n")), 0, 0, *[NONE] * 18), page, head, tail)
    gaps = [int(s > 0), min(2, text.count("\n", 0, s)), int(e < len(text)), min(2, text.count("\n", e))]
    body = text[s:e]
    for sizes in ([len(x.strip()) for x in PATTERNS[1].split(body)], [len(x.strip()) for x in body.split("\n")], [len(x) for x in body.split()]):
        gaps += [s, s + sizes[0], max(sizes[1:-1], default=0), e - sizes[-1], e, min(2, len(sizes))]
    return Table(len(text), tuple(gaps), page, head, tail)


def _moved(x: int, by: int) -> int:
    return x if x == NONE else x + by


def _union(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    if a[0] == NONE:
        return b
    return a if b[0] == NONE else (a[0], b[1])


def _pieces_joined(a: tuple[int, ...], b: tuple[int, ...], boundary: bool) -> tuple[int, ...]:
    if boundary:
        longest = max(a[2], b[2], a[4] - a[3] if a[5] == 2 else 0, b[1] - b[0] if b[5] == 2 else 0)
        return (a[0], a[1], longest, b[3], b[4], 2)
    if a[5] == 1:
        return (a[0], b[1], b[2], b[3] if b[5] == 2 else a[0], b[4], b[5])
    if b[5] == 1:
        return (a[0], a[1], a[2], a[3], b[4], 2)
    return (a[0], a[1], max(a[2], b[2], b[1] - a[3]), b[3], b[4], 2)


def _pages_joined(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    if not a[0] and not b[0]:
        return (0, *_union(a[1:3], b[1:3]), 0, NONE, NONE)
    if not a[0]:
        return (1, *_union(a[1:3], b[1:3]), b[3], *b[4:6])
    if not b[0]:
        return (1, *a[1:3], a[3], *_union(a[4:6], b[1:3]))
    s, e = _union(a[4:6], b[1:3])
    return (1, *a[1:3], max(a[3], b[3], e - s), *b[4:6])


def joined(a: Table, b: Table) -> Table:
    """The table of two neighbours as one range."""
    g = (*b.gaps[:4], *[b.gaps[k] if k % 6 in (0, 3) else _moved(b.gaps[k], a.n) for k in range(4, 22)])
    p = (b.page[0], _moved(b.page[1], a.n), _moved(b.page[2], a.n), b.page[3], *(_moved(x, a.n) for x in b.page[4:6]), b.page[6], *(_moved(x, a.n) for x in b.page[7:]))
    if a.gaps[4] == NONE or g[4] == NONE:  # one of them is white space only
        white = (a, g) if a.gaps[4] == NONE else (b, a.gaps)
        blank, lines, rest = white[0].gaps[0], white[0].gaps[1], list(white[1])
        k = 0 if white[0] is a or rest[4] == NONE else 2
        rest[k], rest[k + 1] = max(rest[k], blank), min(2, rest[k + 1] + lines)
        gaps = tuple(rest)
    else:
        space, lines = a.gaps[2] or g[0], a.gaps[3] + g[1]
        levels = [_pieces_joined(a.gaps[k : k + 6], g[k : k + 6], bool(x)) for k, x in ((4, lines > 1), (10, lines > 0), (16, space))]
        gaps = (*a.gaps[:2], *g[2:4], *levels[0], *levels[1], *levels[2])
    head, tail = a.head, b.tail
    if a.page[0] and p[0]:
        page, head = (1, *_union(a.page[1:3], p[1:3]), *[NONE] * 8), _short(a.head + b.head)
    elif a.page[0]:
        page, head = (0, *_union(a.page[1:3], p[1:3]), *p[3:]), _short(a.head + b.head)
    elif p[0]:
        page, tail = (*a.page[:9], *_union(a.page[9:], p[1:3])), _short(a.tail + b.head)
    else:
        line = _line(a.tail + b.head, _union(a.page[9:], p[1:3]))
        page = (0, *a.page[1:3], *_pages_joined(_pages_joined(a.page[3:9], line), p[3:9]), *p[9:])
    return Table(a.n + b.n, gaps, page, head, tail)


def stitched(tables: Iterable[Table]) -> Table:
    """The table of consecutive ranges as one range."""
    return reduce(joined, tables, table_of(""))


def longest_pieces(t: Table) -> list[int]:
    """The longest piece at each level when every boundary of the level is cut."""
    pages = _line(t.head, t.page[1:3])
    if not t.page[0]:
        pages = _pages_joined(_pages_joined(pages, t.page[3:9]), _line(t.tail, t.page[9:]))
    out = [max(pages[2] - pages[1], pages[3], pages[5] - pages[4])]
    return out + [max(t.gaps[k + 1] - t.gaps[k], t.gaps[k + 2], t.gaps[k + 4] - t.gaps[k + 3], 0) for k in (4, 10, 16)]


def level_of(longest: list[int], limit: int) -> str:
    """The first level whose pieces are within the limit, else ``none``."""
    return next((name for name, n in zip(LEVELS, longest, strict=True) if n <= limit), "none")


# -- pieces -----------------------------------------------------------------------------------------------------------


def best_cut(text: str, low: int, high: int, least: int = 0) -> tuple[int, str]:
    """The offset in (low, high] at which to end a piece, and its boundary: the best one of the second half of the
    piece, else of the first (beyond its ``least`` characters), else ``none`` at high."""
    window = text[low:high]
    middle = (high - low) // 2
    ends = []
    for pattern in PATTERNS:
        ends.append([low + m.end() for m in pattern.finditer(window) if m.end() < len(window) or high == len(text) or not text[high].isspace()])
    for late in (True, False):
        for level, at in zip(LEVELS, ends, strict=True):
            fit = [x for x in at if (x - low > middle) == late and x > low + least]
            if fit:
                return fit[-1], level
    return high, "none"


def _anchor(window: str) -> tuple[int, str]:
    """Where within the first characters after a fixed offset pieces begin anew."""
    return best_cut(window, 0, len(window))


def span_pieces(chunk: str, before: int, own: int, first: bool, last: bool, limit: int, overlap: int) -> list[tuple[int, int, str]]:
    """(start, end, boundary) of the pieces from a span's anchor to the next one's, as offsets in the chunk: ``before``
    characters, the span's own, then the first ``limit - overlap`` of the next.

    Each piece but the item's first repeats the ``overlap`` characters before it, and no piece is longer than ``limit``.
    """
    step = limit - overlap
    start = 0 if first else before + _anchor(chunk[before : before + step])[0]
    end = before + own
    anchor, final = (end, "end") if last else _anchor(chunk[end : end + step])
    anchor += 0 if last else end
    out, at = [], start
    begins = first
    while at < anchor:
        room = limit if begins else step
        if anchor - at <= room:
            cut, level = anchor, final
        else:
            cut, level = best_cut(chunk, at, at + room, overlap if begins else 0)
        out.append((at if begins else at - overlap, cut, level))
        at, begins = cut, False
    return out


def _spans(low: int, high: int, n: int, span: int) -> Iterator[tuple[int, int, int]]:
    """(number, start, past) of the spans that start from low to before high, in an item of n characters; the last
    span is the longest."""
    spans = max(1, n // span)
    for k in range(-(-low // span), spans):
        if k * span >= max(high, 1):
            break
        yield k, k * span, n if k == spans - 1 else (k + 1) * span


def pieces_of(text: str, low: int, high: int, base: int, n: int, limit: int, overlap: int) -> Iterator[tuple[int, int, int, str, str]]:
    """(span, start, end, boundary, piece) of the spans of an item that start from low to before high. text: the part of
    the item that begins at base and reaches far enough."""
    span = SPAN * limit
    for k, a, b in _spans(low, high, n, span):
        before = min(a, overlap)
        chunk = text[a - before - base : b + limit - overlap - base]
        for s, e, level in span_pieces(chunk, before, b - a, k == 0, b == n, limit, overlap):
            yield k, a - before + s, a - before + e, level, chunk[s:e]


def _checked(limit: int, overlap: int) -> None:
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half of the limit")


# -- texts of a column ----------------------------------------------------------------------------------------------


def boundary_levels(df: DataFrame, id_col: str, text_col: str, limit: int = 4000, range_chars: int = RANGE) -> DataFrame:
    """(item, boundary) of each row longer than the limit: the first level at which cutting everywhere leaves no piece
    over the limit, white space around pieces not counted, else ``none``. Every text is looked at by ranges, whose
    tables are stitched; one pass, no shuffle.

    Null, empty and short texts have no row; rows with the same id are separate items.
    """
    text = F.col(f"`{text_col}`")
    long = df.where(F.length(text) > limit).select(F.col(f"`{id_col}`").alias("item"), text.alias("text"))

    def make():
        def go(cols):
            return [
                (key, level_of(longest_pieces(stitched(table_of(t[k : k + range_chars]) for k in range(0, len(t), range_chars))), limit))
                for key, t in (zip(*cols, strict=True) if cols else ())
            ]

        return go

    return map_partitions(long, ["item", "text"], make, StructType([long.schema["item"], *struct("boundary string").fields]))


def split_texts(df: DataFrame, id_col: str, text_col: str, limit: int = 4000, overlap: int = 200) -> DataFrame:
    """(item, piece_no, start, end, boundary, piece): the pieces of every text, none longer than ``limit``, each but the
    first repeating ``overlap`` characters.

    Texts within the limit are one piece with the boundary ``end``; empty texts have one empty piece; null texts none.
    start and end are offsets in characters; the pieces without their overlaps make up the text again. Rows with the same
    id are numbered each for itself.
    """
    _checked(limit, overlap)
    text = F.col(f"`{text_col}`")
    keyed = df.select(F.col(f"`{id_col}`").alias("item"), text.alias("text"))

    def make():
        def go(cols):
            out = []
            for key, t in zip(*cols, strict=True) if cols else ():
                for no, (_, s, e, level, piece) in enumerate(pieces_of(t, 0, len(t), 0, len(t), limit, overlap), 1):
                    out.append((key, no, s, e, level, piece))
            return out

        return go

    schema = StructType([keyed.schema["item"], *struct("piece_no bigint, start bigint, `end` bigint, boundary string, piece string").fields])
    long = map_partitions(keyed.where(F.length("text") > limit), ["item", "text"], make, schema)
    n = F.length("text").cast("bigint")
    short = keyed.where(F.length("text") <= limit).select("item", F.lit(1).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("start"), n.alias("end"), F.lit("end").alias("boundary"), F.col("text").alias("piece"))
    return short.unionByName(long)


# -- files ------------------------------------------------------------------------------------------------------------


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def read_range(path: str, first: int, past: int, before: int = 0, after: int = 0) -> tuple[str, int, int]:
    """The characters that start in a range of bytes, with at most so many characters before and after; how many stand
    before, and how many are the range's own. Undecodable bytes become replacement characters."""
    system, inner = _opened(path)
    with system.open_input_file(inner) as f:
        size = f.size()
        a, b = max(0, first - 4 * before - 4), min(size, past + 4 * after + 4)
        data = f.read_at(b - a, a)

    def char(x: int) -> int:  # the first character that starts at x or later
        x -= a
        while 0 < x < len(data) and data[x] & 0xC0 == 0x80:
            x += 1
        return min(x, len(data))

    at, end = char(first), char(past)
    lead = data[char(a + 3) if a else 0 : at].decode("utf-8", "replace")[-before:] if before else ""
    own = data[at:end].decode("utf-8", "replace")
    rest = data[end:].decode("utf-8", "replace")[:after]
    return lead + own + rest, len(lead), len(own)


def _file_ranges(spark: SparkSession, paths: list[str], range_bytes: int) -> DataFrame:
    rows = []
    for path in paths:
        system, inner = _opened(path)
        size = system.get_file_info(inner).size
        n = max(1, size // range_bytes)
        rows += [(path, k, k * range_bytes, size if k == n - 1 else (k + 1) * range_bytes) for k in range(n)]
    listed = spark.createDataFrame(rows, "item string, range_no int, first bigint, past bigint")
    return listed.repartition(max(1, len(rows)), "item", "range_no")


_PARTS = "gaps array<bigint>, page array<bigint>, head string, tail string"


def file_tables(spark: SparkSession, paths: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(item, range_no, first, past, n, gaps, page, head, tail): the boundary table of every range of the files."""

    def make():
        def go(cols):
            out = []
            for path, no, first, past in zip(*cols, strict=True) if cols else ():
                t = table_of(read_range(path, first, past)[0])
                out.append((path, no, first, past, t.n, list(t.gaps), list(t.page), t.head, t.tail))
            return out

        return go

    schema = f"item string, range_no int, first bigint, past bigint, n bigint, {_PARTS}"
    return cut_lineage(map_partitions(_file_ranges(spark, paths, range_bytes), ["item", "range_no", "first", "past"], make, schema))


def file_levels(tables: DataFrame, limit: int = 4000) -> DataFrame:
    """(item, chars, boundary) of every file: what boundary_levels says of texts, from the tables of its ranges. Tables
    are stitched by 1,024 and then these, so no task holds more. A file within the limit has the boundary ``end``."""

    def stitch(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("range_no")
        t = stitched(Table(int(r.n), tuple(map(int, r.gaps)), tuple(map(int, r.page)), r.head, r.tail) for r in pdf.itertuples(index=False))
        boundary = "end" if t.n <= limit else level_of(longest_pieces(t), limit)
        return pd.DataFrame({"item": [pdf["item"].iloc[0]], "range_no": [int(pdf["part"].iloc[0])], "n": [t.n], "gaps": [list(t.gaps)], "page": [list(t.page)], "head": [t.head], "tail": [t.tail], "boundary": [boundary]})

    schema = f"item string, range_no int, n bigint, {_PARTS}, boundary string"
    part = F.floor(F.col("range_no") / STITCH).cast("int").alias("part")
    columns = ["item", "range_no", "n", "gaps", "page", "head", "tail"]
    halves = tables.select(*columns, part).groupBy("item", "part").applyInPandas(stitch, schema)
    whole = halves.select(*columns, F.lit(0).alias("part")).groupBy("item").applyInPandas(stitch, schema)
    return whole.select("item", F.col("n").alias("chars"), "boundary")


def file_pieces(tables: DataFrame, limit: int = 4000, overlap: int = 200) -> DataFrame:
    """(item, piece_no, start, end, boundary, piece): the pieces of UTF-8 files, read by byte ranges. The same that
    split_texts makes of the whole text, however the ranges are cut.

    Offsets of the ranges are the prefix sums of their lengths, numbers those of the ranges' piece counts. Each task
    opens its file and reads its range with a halo of two anchor distances.
    """
    _checked(limit, overlap)
    w = Window.partitionBy("item").orderBy("range_no")  # a small row for each range
    based = tables.select("item", "range_no", "first", "past", (F.sum("n").over(w) - F.col("n")).alias("base"), F.sum("n").over(Window.partitionBy("item")).alias("total"))
    based = based.repartition(F.col("item"), F.col("range_no"))

    def make():
        def go(cols):
            out = []
            for path, no, first, past, base, total in zip(*cols, strict=True) if cols else ():
                text, lead, own = read_range(path, first, past, overlap, 2 * SPAN * limit + limit)
                if not total:
                    out.append((path, no, 1, 0, 0, "end", ""))
                for k, (_, s, e, level, piece) in enumerate(pieces_of(text, base, base + own, base - lead, total, limit, overlap), 1):
                    out.append((path, no, k, s, e, level, piece))
            return out

        return go

    schema = "item string, range_no int, k bigint, start bigint, `end` bigint, boundary string, piece string"
    pieces = cut_lineage(map_partitions(based, ["item", "range_no", "first", "past", "base", "total"], make, schema))
    counts = pieces.groupBy("item", "range_no").agg(F.count("*").alias("n"))
    before = counts.select("item", "range_no", (F.sum("n").over(w) - F.col("n")).alias("before"))
    return pieces.join(before, ["item", "range_no"]).select("item", (F.col("before") + F.col("k")).alias("piece_no"), "start", "end", "boundary", "piece")


def split_files(spark: SparkSession, paths: list[str], limit: int = 4000, overlap: int = 200, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The pieces of UTF-8 files, see file_pieces."""
    return file_pieces(file_tables(spark, paths, range_bytes), limit, overlap)
