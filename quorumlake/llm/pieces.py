"""Splitting oversized texts and giant files at natural boundaries.

Method: a text is worked on in ranges of ``range_size`` characters.  The worker of a range gets its range with
a halo on either side, and in the halo finds the boundary at which the next range takes over, so two neighbours
agree on the seam without talking to each other.  Between two seams it cuts pieces greedily at the last
paragraph, sentence, line or word end that fits.  Pieces are emitted by offset; numbers of pieces before a range
are a prefix sum over the boundary table, one row a range of that text.  No worker of pieces holds more than a
range and its halos; a text that is a row of a table is one string when it is read, a file (``split_files``) never is.

Texts of one range need no shuffle at all.  Of longer ones only windows and counts of pieces are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1_400, 160
RANGE = 1 << 14
#: Kinds of cuts, best first.
PARAGRAPH, SENTENCE, LINE, WORD, HARD = range(5)
_ENDS = [
    (PARAGRAPH, re.compile(r"(?:\r\n|\n|\r)[^\S\r\n]*(?:\r\n|\n|\r)\s*")),
    (SENTENCE, re.compile(r"[.!?…][\"'”’)\]]*\s+")),
    (LINE, re.compile(r"[\r\n]\s*")),
]
_SPACE = re.compile(r"\s")


def natural_end(text: str, low: int, high: int) -> tuple[int, int] | None:
    """(position, kind) of the best cut in (low, high]: the last of the best kind that leaves no short piece.

    A paragraph end is taken in the last half of the span, a sentence end in the last two thirds, a line end
    in the last third; failing these, the last white space anywhere.  None if there is no white space.
    """
    if high >= len(text):
        high = len(text)
    span = high - low
    for (kind, pattern), share in zip(_ENDS, (0.5, 0.67, 0.33)):
        start, best = max(low + 1, high - int(span * share)), None
        for m in pattern.finditer(text, max(low, start - 8), high):
            if m.end() >= start:
                best = m.end()
        if best is not None and low < best <= high:
            return best, kind
    if high < len(text) and text[high].isspace():
        return high, WORD
    for at in range(high - 1, low, -1):
        if text[at].isspace():
            return at + 1, WORD
    return (low + 1, WORD) if span > 0 and text[low].isspace() else None


def overlap_start(text: str, start: int, end: int, overlap: int) -> int:
    """Where the piece after text[start:end] begins: at a word about ``overlap`` characters before its end."""
    at = max(start + 1, end - overlap)
    for p in range(at, min(end, at + overlap // 2)):
        if text[p - 1].isspace() and not text[p].isspace():
            return p
    return at if at < end else end


def cut_span(text: str, first: int, last: int, limit: int = LIMIT, overlap: int = OVERLAP, more: bool = False) -> list[tuple[int, int, int]]:
    """(start, end, kind of the end) of the pieces that cover text[first:last].

    The first begins at ``first``, or up to ``overlap`` before it if ``more`` says that a piece ended there.
    Every piece has at most ``limit`` characters and ends beyond the one before.  An end inside a word occurs
    only in a stretch without white space that is longer than the limit.
    """
    pieces: list[tuple[int, int, int]] = []
    end, start = first, overlap_start(text, max(0, first - limit), first, overlap) if more and first else first
    while end < last:
        if last - start <= limit:
            inside = last < len(text) and not text[last - 1].isspace() and not text[last].isspace()
            pieces.append((start, last, HARD if inside else WORD))
            break
        cut = natural_end(text, end, min(last, start + limit))
        if cut is None and start < end:
            start = end - min(overlap, end - start)  # less overlap, so that the next word fits whole
            stretch = next((m.start() for m in [_SPACE.search(text, end, min(last, end + limit))] if m), None)
            room = limit - ((stretch if stretch is not None else min(last, end + limit)) - end)
            start = end - max(0, min(end - start, room))
            cut = natural_end(text, end, min(last, start + limit))
            if cut is None and last - start <= limit:
                continue
        cut = cut or (min(last, start + limit), HARD)
        pieces.append((start, cut[0], cut[1]))
        end, start = cut[0], overlap_start(text, start, cut[0], overlap)
    return pieces


def seam(text: str, at: int, halo: int) -> int:
    """The position in [at, at + halo) at which one range hands over to the next, seen alike from both sides."""
    window = text[at : at + halo]
    for _, pattern in _ENDS:
        if m := pattern.search(window):
            return at + m.end()
    m = _SPACE.search(window)
    return at + (m.end() if m else 0)


def _range_pieces(text: str, number: int, range_size: int, halo: int, limit: int, overlap: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Offset of the window in the whole text, and the pieces of range ``number`` as positions in the window."""
    base = max(0, number * range_size - halo)
    first = seam(text, number * range_size - base, halo) if number else 0
    nominal = (number + 1) * range_size - base
    last = seam(text, nominal, halo) if len(text) > nominal else len(text)
    return base, cut_span(text, first, last, limit, overlap, more=number > 0) if last > first else []


def _windows(texts: DataFrame, key: str, text: str, range_size: int, halo: int, several: bool) -> DataFrame:
    """(key, n_range, __text): the whole text of texts of one range, or the window of each range of longer ones.

    A window is cut out where the text is read, so a long text is never repeated.
    """
    size = F.length(F.col(text))
    if not several:
        return texts.where((size > 0) & (size <= range_size + halo)).select(F.col(key), F.lit(0).alias("n_range"), F.col(text).alias("__text"))
    ranges = F.sequence(F.lit(0), F.floor((size - 1) / range_size).cast("int"))
    window = lambda n: F.substr(F.col(text), F.greatest(F.lit(0), n * range_size - halo) + 1, F.lit(range_size + 2 * halo))
    cut = F.transform(ranges, lambda n: F.struct(n.alias("n_range"), window(n).alias("__text")))
    return texts.where(size > range_size + halo).select(F.col(key), F.inline(cut))


def split_texts(texts: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP, range_size: int = RANGE) -> DataFrame:
    """Ordered pieces of every text: (key, piece_no, start, end, cut, n_range, piece), offsets in code points.

    key: a column unique per row; repeated keys are repeated texts and each is cut by itself only if the key
    tells them apart, so give a unique one.  A null text has no piece, an empty one neither; a text within the
    limit is one piece.  ``cut`` is 0 paragraph, 1 sentence, 2 line, 3 word (or the end of the text), 4 inside a
    stretch without white space longer than the limit.  Further columns of ``texts`` are left out, so names
    cannot clash; join them back by the key.
    """
    if limit <= 2 * overlap or range_size < 4 * limit:
        raise ValueError("the limit must exceed twice the overlap, and a range four limits")
    halo = 2 * limit
    kind = texts.schema[key].dataType.simpleString()
    names = [key, "n_range", "n_local", "start", "end", "cut", "piece"]
    out = f"`{key}` {kind}, n_range int, n_local int, start bigint, end bigint, cut int, piece string"

    def spans(n: int, body: str, several: bool) -> tuple[int, list[tuple[int, int, int]]]:
        if several:
            return _range_pieces(body, n, range_size, halo, limit, overlap)
        return 0, cut_span(body, 0, len(body), limit, overlap) if len(body) > limit else [(0, len(body), WORD)]

    def pieces(several: bool):
        def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for k, n, body in batch.itertuples(index=False):
                    base, found = spans(n, body, several)
                    rows += [(k, n, i, base + a, base + b, cut, body[a:b]) for i, (a, b, cut) in enumerate(found)]
                    if len(rows) > 20_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

        return emit

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(k, n, len(spans(n, body, True)[1])) for k, n, body in batch.itertuples(index=False)], columns=[key, "n_range", "n"])

    one, many = (_windows(texts, key, text, range_size, halo, several) for several in (False, True))
    single = one.mapInPandas(pieces(False), out).withColumn("before", F.lit(0))
    # the boundary table of longer texts, then their pieces by offset
    upto = Window.partitionBy(key).orderBy("n_range").rowsBetween(Window.unboundedPreceding, -1)
    bounds = many.mapInPandas(sizes, f"`{key}` {kind}, n_range int, n int").groupBy(key, "n_range").agg(F.max("n").alias("n"))
    bounds = bounds.select(key, "n_range", F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("int").alias("before"))
    longer = many.mapInPandas(pieces(True), out).join(bounds, [key, "n_range"])
    return single.unionByName(longer).select(key, (F.col("before") + F.col("n_local")).alias("piece_no"), "start", "end", "cut", "n_range", "piece")


def found(documents: DataFrame, range_size: int = RANGE) -> DataFrame:
    """(doc_id, at_space) of each document over the limit, from the numbered pieces the operator makes of it.

    A document over the limit has a second piece, and a cut of kind HARD only where white space is lacking.
    """
    pieces = split_texts(documents, range_size=range_size)
    whole = pieces.groupBy("doc_id").agg(F.max("piece_no").alias("last"), F.max("cut").alias("worst"))
    return whole.where("last > 0").select("doc_id", F.when(F.col("worst") == HARD, 0).otherwise(1).cast("int").alias("at_space"))


# ---- giant files -------------------------------------------------------------------------------------------


def _open(path: str):
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return where.open_input_file(name), where.get_file_info(name).size


def _read(path: str, begin: int, end: int) -> bytes:
    file, size = _open(path)
    with file:
        begin, end = max(0, begin), min(size, end)
        return file.read_at(end - begin, begin) if end > begin else b""


def _aligned(data: bytes, at: int) -> int:
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def split_files(spark: SparkSession, paths: list[str], limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = 32 << 20) -> DataFrame:
    """Pieces of UTF-8 files of any size: (path, piece_no, start, end, cut, piece), offsets in code points.

    Each task reads one range of bytes and its halos, never a file.  Two passes: the first counts the
    characters and pieces of each range (a boundary table of one row a range), whose prefix sums give the second
    pass the offsets and numbers to emit.  Bytes that are not UTF-8 become the replacement character.
    An empty file has no piece.
    """
    halo = 8 * limit  # bytes; a character has four at most
    ranges = []
    for path in paths:
        file, size = _open(path)
        file.close()
        ranges += [(path, n) for n in range(-(-size // range_bytes))]
    table = spark.createDataFrame(ranges, "path string, n_range int").repartition(max(1, len(ranges)), "path", "n_range")

    def window(path: str, n: int) -> tuple[str, int, int]:
        """The window's text, and where in it this range begins and ends."""
        base = max(0, n * range_bytes - halo)
        data = _read(path, base, (n + 1) * range_bytes + halo)
        front = _aligned(data, 0) if base else 0
        own, nxt = _aligned(data, n * range_bytes - base), _aligned(data, min(len(data), (n + 1) * range_bytes - base))
        lead, body, tail = (data[a:b].decode("utf-8", "replace") for a, b in ((front, own), (own, nxt), (nxt, len(data))))
        text, a = lead + body + tail, len(lead)
        b = a + len(body)
        return text, seam(text, a, 2 * limit) if n else 0, seam(text, b, 2 * limit) if tail and (n + 1) * range_bytes < base + len(data) else len(text)

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, n in batch.itertuples(index=False):
                text, a, b = window(path, n)
                yield pd.DataFrame([(path, n, b - a, len(cut_span(text, a, b, limit, overlap, more=n > 0)))], columns=["path", "n_range", "chars", "pieces"])

    before = Window.partitionBy("path").orderBy("n_range").rowsBetween(Window.unboundedPreceding, -1)
    bounds = table.mapInPandas(sizes, "path string, n_range int, chars bigint, pieces bigint")
    bounds = bounds.select("path", "n_range", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("at"), F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("no"))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, n, at, no in batch.itertuples(index=False):
                text, a, b = window(path, n)
                rows = [(path, no + i, at + s - a, at + e - a, cut, text[s:e]) for i, (s, e, cut) in enumerate(cut_span(text, a, b, limit, overlap, more=n > 0))]
                for k in range(0, len(rows), 20_000):
                    yield pd.DataFrame(rows[k : k + 20_000], columns=["path", "piece_no", "start", "end", "cut", "piece"])

    return bounds.repartition(max(1, len(ranges)), "path", "n_range").mapInPandas(emit, "path string, piece_no bigint, start bigint, end bigint, cut int, piece string")
