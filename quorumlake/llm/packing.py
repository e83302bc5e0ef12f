"""Filling contexts of a fixed number of tokens with whole documents.

Method: best-fit decreasing over all documents at once.  A segment tree over remaining capacities finds the
tightest open bin in logarithmic time.  As the order is by size and bins with equal room are alike, a run of
documents of one size is placed in one step; the outcome is that of placing them one by one.  So the plan is
made from the histogram of sizes, which has at most as many rows as a context has tokens however many documents
there are, and the documents find their context by their rank within their size.

Scale: texts are tokenised once and never shuffled.  The histogram goes to the driver (at most ``capacity`` + 1
rows); the plan comes back as arrays.  Ranks are made in salted groups, so a size that a third of all documents
have is spread over many tasks.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.io import bounded_rows, cut

CAPACITY = 2_048
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split of a text into stretches within which the byte-level vocabulary merges (a fixed value of that vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GROUP_ROWS = 500_000
_BLANK = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_BLANKS = re.compile(f"(?<!{_BLANK}){_BLANK}{{50000,}}")


class Room:
    """A segment tree over remaining capacities 0..capacity; a leaf holds runs of bins with just that room."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, (capacity + 1).bit_length())
        self.any = bytearray(2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, n: int) -> None:
        if not self.runs[room]:
            self._set(room, 1)
        self.runs[room].append((first, n))

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` bins of the last run with this room: the first and how many."""
        first, n = self.runs[room].pop()
        if n > most:
            self.runs[room].append((first + most, n - most))
            n = most
        elif not self.runs[room]:
            self._set(room, 0)
        return first, n

    def _set(self, room: int, value: int) -> None:
        at = room + self.size
        self.any[at] = value
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The least room of an open bin that is at least ``need``."""
        at = need + self.size
        if at >= 2 * self.size:
            return None
        if self.any[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rows (size, first rank, first bin, documents of this size in each bin) in order of size and rank; bins used.

    The document of rank r within its size, in the row with first rank q, goes to bin first + (r - q) // each.
    Sizes from 1 to capacity.
    """
    room, bins, rows = Room(capacity), 0, []
    for size in sorted((s for s, n in histogram.items() if n > 0), reverse=True):
        left, rank = histogram[size], 0
        while left:
            fit = room.tightest(size)
            each = (fit if fit is not None else capacity) // size  # one bin takes as many of them as it holds, being then the tightest
            if fit is None:
                n, first = max(1, left // each), bins
                bins += n
                fit = capacity
            else:
                first, n = room.take(fit, max(1, left // each))
            each = min(each, left)
            rows.append((size, rank, first, each))
            room.add(fit - each * size, first, n)
            left -= each * n
            rank += each * n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4), bins


_encoders: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer whose ranks stand in the file, loaded once in each process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _encoders[path] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def count_tokens(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of each row with a text that is not null; the whole text is encoded.

    A stretch without a blank may be of any length: the encoder merges long ones in nearly linear time.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(tokenizer)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [_length(coder, t) for t in batch["text"]]})

    return documents.where(F.col("text").isNotNull()).select("doc_id", "text").mapInPandas(count, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_tokens bigint")


def _length(coder, text: str) -> int:
    """Tokens of a text.  The splitting pattern cannot take a million blanks in a row, so such are handed over as the
    one stretch that it makes of them: all but the last, which goes with the word that follows."""
    if len(text) < 50_000:
        return len(coder.encode_ordinary(text))
    total = at = 0
    for m in _BLANKS.finditer(text):
        end = m.end() - (m.end() < len(text))
        total += len(coder.encode_ordinary(text[at : m.start()])) + len(coder._encode_single_piece(text[m.start() : end]))
        at = end
    return total + len(coder.encode_ordinary(text[at:]))


def pack(sizes: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, part, n_tokens, context) for rows (doc_id, n_tokens): every row once, with the context it is in.

    A document of more than ``capacity`` tokens is cut into parts of ``capacity`` and one rest; only such are
    split.  Contexts are numbered from 0 without gaps: first those that hold a full part each, then the packed
    ones.  A document of 0 tokens goes to context 0, a null size is taken as 0.  Ties are in the order of doc_id
    and part; equal rows (one id twice) are packed twice.  An empty table gives an empty result.
    """
    # the sizes are used three times: written once, so that texts are tokenised once and lost executors cost little
    sizes = cut(sizes.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")))
    wholes = F.floor(F.greatest(F.col("n_tokens") - 1, F.lit(0)) / capacity).cast("int")
    parts = sizes.select("doc_id", F.col("n_tokens").alias("__all"), wholes.alias("__full"), F.explode(F.sequence(F.lit(0), wholes)).alias("part"))
    size = F.when(F.col("part") < F.col("__full"), F.lit(capacity)).otherwise(F.col("__all") - F.col("__full") * capacity).cast("bigint")
    parts = parts.select("doc_id", "part", size.alias("n_tokens"))
    histogram = {r["n_tokens"]: r["count"] for r in bounded_rows(parts.groupBy("n_tokens").count(), capacity + 1, "the histogram of sizes")}
    rows, bins = plan({s: n for s, n in histogram.items() if s > 0}, capacity)
    salts = max(1, sum(histogram.values()) // group_rows)
    salted = parts.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "part"), F.lit(salts)).cast("int"))
    ahead = Window.partitionBy("n_tokens").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("n_tokens", "__salt").count().select("n_tokens", "__salt", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("__before"))
    within = Window.partitionBy("n_tokens", "__salt").orderBy("doc_id", "part")
    ranked = salted.withColumn("__rank", F.row_number().over(within) - 1)
    if salts > 1:
        ranked = ranked.join(before, ["n_tokens", "__salt"]).withColumn("__rank", F.col("__rank") + F.col("__before"))
    sent = sizes.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf("bigint")
    def context(size: pd.Series, rank: pd.Series) -> pd.Series:
        table = sent.value
        if not len(table):
            return pd.Series(np.zeros(len(size), dtype=np.int64))
        step = int(table[:, 1].max()) + int(rank.max()) + 2
        at = np.searchsorted(table[:, 0] * step + table[:, 1], size.to_numpy() * step + rank.to_numpy(), side="right") - 1
        row = table[np.maximum(at, 0)]
        found = row[:, 2] + (rank.to_numpy() - row[:, 1]) // np.maximum(row[:, 3], 1)
        return pd.Series(np.where(size.to_numpy() > 0, found, 0))

    return ranked.select("doc_id", "part", "n_tokens", context("n_tokens", F.col("__rank").cast("bigint")).alias("context"))


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Every document with its context: (doc_id, part, n_tokens, context).  A null text counts as empty."""
    empty = documents.where(F.col("text").isNull()).select("doc_id", F.lit(0).cast("bigint").alias("n_tokens"))
    return pack(count_tokens(documents, tokenizer).unionByName(empty), capacity)
