"""Printed schedules of figures by year: columns found by position, subtotals and totals found by their sums."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

YEAR = re.compile(r"\b(?:19|20)\d{2}\b")
SEASONAL = re.compile(r"seasonal|part[- ]time|^\s*source", re.I)
REACH = 14


def figure(token: str) -> float | None:
    """A printed figure: a dash is 0, brackets mean minus."""
    if token in ("-", "–", "—"):
        return 0.0
    bare = token.replace(",", "").replace("%", "").replace("$", "")
    try:
        value = float(bare.strip("()"))
    except ValueError:
        return None
    return -value if bare.startswith("(") and bare.endswith(")") else value


def tolerance(x: float) -> float:
    return max(0.06, 0.0015 * abs(x))


def columns(line: str) -> list[tuple[int, int, int]]:
    """(year, begin, end) of a header line with four years or more, else nothing."""
    found = [(int(m[0]), m.start(), m.end()) for m in YEAR.finditer(line)]
    return found if len(found) >= 4 else []


def values(line: str, cols: list[tuple[int, int, int]]) -> tuple[str, dict[int, float]]:
    """(label, value by year).  A figure for every column goes straight across; else each to the column whose middle
    is nearest, if that is within reach."""
    marks = [(figure(m[0]), m.start(), m.end()) for m in re.finditer(r"\S+", line)]
    figures = [(v, (a + b) / 2, a) for v, a, b in marks if v is not None]
    label = line[: figures[0][2]].strip() if figures else line.strip()
    if len(figures) == len(cols):
        return label, {c[0]: v for c, (v, _, _) in zip(cols, figures)}
    out = {}
    for v, middle, _ in figures:
        year, gap = min(((c[0], abs(middle - (c[1] + c[2]) / 2)) for c in cols), key=lambda x: x[1])
        if gap <= REACH:
            out[year] = v
    return label, out


def table(text: str) -> list[tuple[str, dict[int, float]]]:
    """Rows of the first schedule of a text: from its header of years to a source or seasonal line or a blank stretch."""
    lines, cols, out = text.splitlines(), [], []
    for line in lines:
        if not cols:
            cols = columns(line)
        elif SEASONAL.search(line):
            break
        elif line.strip():
            label, by_year = values(line, cols)
            if by_year and label:
                out.append((label, by_year))
    return out


def classify(rows: list[tuple[str, float | None]]) -> list[str]:
    """leaf, subtotal, grand, blank or after for each (label, value) in print order.

    A subtotal equals the sum of the two rows or more above it, whatever its label; the grand total is the last row
    that equals all leaves but itself; rows from a seasonal line on are not part of the schedule.
    """
    kinds, run = [], []
    stop = next((k for k, (label, _) in enumerate(rows) if SEASONAL.search(label)), len(rows))
    for _, v in rows[:stop]:
        if v is None:
            kinds.append("blank")
        elif len(run) > 1 and abs(v - sum(run)) < tolerance(v):
            kinds.append("subtotal")
            run = []
        else:
            kinds.append("leaf")
            run.append(v)
    leaves = [v for (_, v), k in zip(rows, kinds) if k == "leaf"]
    whole, grand = sum(leaves), None
    for k, (_, v) in enumerate(rows[:stop]):
        if v is not None and len(leaves) > 2 and abs(v - (whole - (v if kinds[k] == "leaf" else 0.0))) < tolerance(v):
            grand = k
    if grand is not None:
        kinds[grand] = "grand"
    return kinds + ["after"] * (len(rows) - stop)


def schedules(files: DataFrame) -> DataFrame:
    """(source_file, row_no, label, year, value, kind) of files (source_file, value); file by file, no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, text in zip(batch["source_file"], batch["value"]):
                found = table(text or "")
                for year in sorted({y for _, by in found for y in by}):
                    kinds = classify([(label, by.get(year)) for label, by in found])
                    rows += [(name, k, label, year, by.get(year), kind) for k, ((label, by), kind) in enumerate(zip(found, kinds))]
            yield pd.DataFrame(rows, columns=["source_file", "row_no", "label", "year", "value", "kind"])

    return files.select("source_file", "value").mapInPandas(run, "source_file string, row_no int, label string, year int, value double, kind string")
