"""Reading level of documents.

Method: sentence lengths and syllables, counted by hyphenation-style rules, give several classic grade
estimates; their median is the grade of a text.  The grades at which one level passes into the next are fitted
on labelled documents.

Scale: one pass of Python over batches of texts, no shuffle of texts.  The labels are a bounded table (its
size is checked); only the labelled documents are read twice.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.io import bounded_rows

_TAGS = re.compile(r"&(?:[a-z]{2,8}|#\d{2,6});")
_MARKS = re.compile(r"(?m)^\s*(?:#{1,6}\s|[-*•·✔>]+\s|\d+[.)]\s)|^\s*(?:\[?[\d:]+\]?\s*)?(?:Speaker|SPEAKER)\s+[A-Z]\s*:")
_ABBREVIATION = re.compile(r"\b(?:No|Nos|Res|Sec|Ord|Mr|Ms|Mrs|Dr|St|Ave|Inc|Jr|Sr|Ch|Art|vs|etc|e\.g|i\.e)\.(?=\s)")
_END = re.compile(r"([.!?…]+[\"')\]”’]*(?=\s|$))|\n\s*\n|\n(?=\s*(?:#{1,6}\s|[-*•·]\s))")
_WORD = re.compile(r"(?<![^\W_])(?:[A-Za-zÀ-ÿ]{1,24}(?:['’][A-Za-z]+)?|\d[\d,.:]*\d|\d)(?![^\W_])")
_VOWELS = re.compile(r"[aeiouyà-ïò-ý]+")
# Endings and letter groups that add or drop a syllable against the count of vowel groups.
_DROP = re.compile(r"(?:[^laeiouy]|[^aeiou]l)es?$|[^aeiouytd]ed$|(?<=[aeiouy][bcdfgklmnprstvz])e(?=(?:ly|ment|ful|less|ness|s)$)")
_LE = re.compile(r"[^aeiouy]les?$")
_ADD = re.compile(r"i[aou](?!n$|ns$|us$)|(?<![tscg])io(?!n)|[aeiouy]ing|ea(?=[tl](?:e|ion|or|ing))|u[ao]|eo(?!u)|ua(?=[lt])|iet|(?<=[aeiouy][^aeiouy])ea$")
_JOIN = re.compile(r"[tscgx]i(?:on|ous|al|an|ent|ence|a)|qu[aeio]|gu[ae]")


#: A sentence longer than this has lost the marks within it, so its length says nothing.
LONGEST = 80
MIN_WORDS = 60
LEVELS = (1, 2, 3, 4)


def syllables(word: str) -> int:
    """Syllables of a lower-case word, by vowel groups corrected for silent and separate letters."""
    if word[0].isdigit():
        return min(5, len(word))
    bare = _JOIN.sub(lambda m: m[0][0] + "o", word)
    n = len(_VOWELS.findall(bare)) + len(_ADD.findall(bare))
    if n > 1 and not _LE.search(bare) and _DROP.search(bare):
        n -= 1
    return max(1, n)


class _Measures(dict):
    """Of each word met: letters, syllables and whether these are three or more, packed so that one sum adds all."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        n = syllables(word.lower())
        self[word] = value = len(word) << 40 | n << 20 | (n >= 3)
        return value


_measures = _Measures()


def sentences(text: str) -> list[tuple[int, int, bool]]:
    """(words, packed measures, ended by a mark) of each sentence, heading, list item or paragraph without marks."""
    if "&" in text:
        text = _TAGS.sub(lambda m: html.unescape(m[0]), text)
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = _MARKS.sub("\n\n", _ABBREVIATION.sub(lambda m: m[0][:-1], text))
    out = []
    parts = _END.split(text) + [None]
    for sentence, mark in zip(parts[::2], parts[1::2]):
        if found := _WORD.findall(sentence):
            out.append((len(found), sum(map(_measures.__getitem__, found)), mark is not None))
    return out


def features(text: str) -> tuple[float, float, float, float, float] | None:
    """(typical sentence length, share of words without an end mark, letters, syllables, hard words per word).

    The typical length is that of the sentence in which the middle word stands, passages without marks left
    out.  None for a text without words.
    """
    parts = sentences(text)
    words = sum(n for n, _, _ in parts)
    if not words:
        return None
    packed = sum(m for _, m, _ in parts)
    marked = sorted(n for n, _, ended in parts if ended and n <= LONGEST)
    half, length, below = sum(marked) / 2, 0, 0
    for n in marked:
        length, below = n, below + n
        if below >= half:
            break
    return float(length), 1 - sum(marked) / words, (packed >> 40) / words, (packed >> 20 & 0xFFFFF) / words, (packed & 0xFFFFF) / words


def grade(length, letters, syll, hard):
    """Median of the grades by Flesch-Kincaid, Gunning fog, SMOG, Coleman-Liau and the automated index; on numbers or arrays."""
    return np.median(
        [
            0.39 * length + 11.8 * syll - 15.59,
            0.4 * (length + 100 * hard),
            1.043 * np.sqrt(30 * hard * length) + 3.1291,
            5.88 * letters - 29.6 / np.maximum(length, 1) - 15.8,
            4.71 * letters + 0.5 * length - 21.43,
        ],
        axis=0,
    )


class Scale:
    """From features to a level: sentence lengths for texts without marks, and the grades between two levels."""

    def __init__(self, measured: np.ndarray, levels: np.ndarray):
        """measured: a row of features for each labelled text; levels: the mean of the levels given to it."""
        self.lengths, self.bounds = np.zeros(4), [6.0, 13.0, 22.0]
        if len(measured) < 20:
            return  # too few to fit anything; the bounds are those between primary, secondary and tertiary school
        marked = measured[:, 1] < 0.2
        if marked.sum() >= 10:
            self.lengths = np.linalg.lstsq(np.c_[np.ones(marked.sum()), measured[marked, 2:]], measured[marked, 0], rcond=None)[0]
        at = np.sort(g := self.grades(measured))
        between = (at[1:] + at[:-1]) / 2
        for k, level in enumerate(LEVELS[:-1]):
            above = levels > level + 0.25  # halves: two raters one level apart
            weight = np.where(levels == np.round(levels), 1.0, 0.0)
            if 0 < (above * weight).sum() < weight.sum():
                # wrongly placed texts at every bound, by running sums over the sorted grades
                order = np.argsort(g, kind="stable")
                up = np.cumsum((above * weight)[order])[:-1] + ((~above) * weight)[order].sum() - np.cumsum(((~above) * weight)[order])[:-1]
                best = np.flatnonzero(up == up.min())
                self.bounds[k] = float(between[best[len(best) // 2]])
        self.bounds = sorted(self.bounds)

    def grades(self, measured: np.ndarray) -> np.ndarray:
        """The grade of each row; where half of the words stand in runs without marks, at the length usual for such words."""
        usual = np.clip(np.c_[np.ones(len(measured)), measured[:, 2:]] @ self.lengths, 5, LONGEST) if self.lengths.any() else np.full(len(measured), 17.0)
        length = np.where(measured[:, 1] > 0.5, usual, measured[:, 0])
        return grade(length, measured[:, 2], measured[:, 3], measured[:, 4])

    def levels(self, measured: np.ndarray) -> np.ndarray:
        return 1 + np.searchsorted(self.bounds, self.grades(measured), side="left")


MAX_LABELS = 50_000


def _measure(documents: DataFrame, finish) -> DataFrame:
    kind = documents.schema["doc_id"].dataType.simpleString()
    fields, rows_of = finish
    out = f"doc_id {kind}, " + fields

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"]
            made = [features(t) if t else None for t in texts]
            empty = (math.nan,) * 5
            frame = pd.DataFrame([m or empty for m in made], columns=[f"f{k}" for k in range(5)], dtype=float)
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            frame["pieces"] = np.fromiter((len(t.split()) if t else 0 for t in texts), dtype=np.int32, count=len(texts))
            yield rows_of(frame)

    return documents.select("doc_id", "text").mapInPandas(run, out)


def fit(documents: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Scale:
    """The scale that labelled documents of MIN_WORDS pieces or more show.

    labels: (doc_id, level); a document rated twice counts with the mean.  Beyond ``max_labels`` labelled
    documents a sample of that many is taken, by the hash of the id.  Rows with a null are passed over.  With
    fewer than 20 usable documents the bounds of school stages are used.
    """
    rated = labels.where("doc_id IS NOT NULL AND level IS NOT NULL").groupBy("doc_id").agg(F.avg("level").alias("__level"))
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    texts = documents.select("doc_id", "text").join(F.broadcast(rated.select("doc_id")), "doc_id", "left_semi")
    measured = _measure(texts, ("pieces int, f0 double, f1 double, f2 double, f3 double, f4 double", lambda d: d[["doc_id", "pieces", "f0", "f1", "f2", "f3", "f4"]]))
    usable = measured.where((F.col("pieces") >= MIN_WORDS) & ~F.isnan("f0")).dropDuplicates(["doc_id"])
    rows = bounded_rows(usable.join(F.broadcast(rated), "doc_id").orderBy("doc_id"), max_labels, "the labelled sample")
    return Scale(np.array([[r[f"f{k}"] for k in range(5)] for r in rows]).reshape(-1, 5), np.array([r["__level"] for r in rows]))


def reading_levels(documents: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """(doc_id, level, grade, pieces) of each row of documents (doc_id, text).

    A null or empty text, or one without words, has null level and grade.  Repeated rows are repeated, columns
    beyond those two are left out.  pieces counts what stands between white space.
    """
    scale = fit(documents, labels, max_labels)

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        known = frame["f0"].notna().to_numpy()
        measured = np.nan_to_num(frame[[f"f{k}" for k in range(5)]].to_numpy())
        frame["level"] = pd.array(np.where(known, scale.levels(measured), 0), dtype="Int32")
        frame["grade"] = np.where(known, scale.grades(measured), np.nan)
        frame.loc[~known, ["level", "grade"]] = None
        return frame[["doc_id", "level", "grade", "pieces"]]

    return _measure(documents, ("level int, grade double, pieces int", finish))


def found(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, level) of the English documents of MIN_WORDS pieces or more that nobody rated.

    The rated ones are taken out after the texts are gone, so that no text is shuffled.
    """
    english = documents.where(F.col("lang") == "en")
    levels = reading_levels(english, labels).where((F.col("pieces") >= MIN_WORDS) & F.col("level").isNotNull())
    return levels.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "level").dropDuplicates(["doc_id"])
