"""Finding passages of held-out evaluation texts in a corpus.

Method: one Aho-Corasick automaton over runs of ``SEED`` words of every normalised evaluation text; each document
is normalised word by word, with the offset of each word in the original kept, and scanned once.  Runs met on
nearly the same diagonal of a document and an item are chained; where the chained runs cover enough of an item, and
enough of its words stand in that part of the document at all, the words between them are aligned, and the pair
counts if some stretch of at least ``MIN_WORDS`` words of the item stands there with at most one word in ``CHANGED``
changed and at most ``FOREIGN`` foreign words in a row.

Bound: a passage is found if at least ``COVER`` of its words stand in runs of ``SEED`` or more.  One with a foreign or changed
word after every second word has no such run and is missed.

Scale: documents are never shuffled or joined; the evaluation set is sent to the executors (its size is
checked), each document is one scan, and only pairs come out.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumlake.io import bounded_rows, built, send

MAX_ITEMS, SEED, COVER = 200_000, 3, 12
MIN_WORDS, CHANGED, FOREIGN = 25, 8, 3
#: How far two runs of one passage may lie apart on the diagonal, and from run to run in the document.
DRIFT, REACH = 12, 24

_WORD = re.compile(r"[a-z0-9]+")
_ENTITY = re.compile(r"&(?:[A-Za-z]{2,8}|#\d{2,6}|#x[0-9A-Fa-f]{2,5});")
_UNSEEN = re.compile("[­​-‏⁠﻿̀-ͯ]")
# Letters of other alphabets that look like Latin ones, and letters that have no parts to fall into.
_LOOK = str.maketrans("аеорсухіјѕкмтнвһԁԛԝ" + "αεορνικτυχ" + "ıłøđ", "aeopcyxijskmthbhdqw" + "aeopviktux" + "ilod")
_MORE = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"}


def _letters(text: str) -> str:
    """Lower case, letters in their plain Latin form, nothing that is not seen."""
    text = unicodedata.normalize("NFKD", text)
    text = _UNSEEN.sub("", text).lower().translate(_LOOK)
    for a, b in _MORE.items():
        text = text.replace(a, b)
    return text


def words(text: str) -> list[str]:
    """The normalised words of a text."""
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    return _WORD.findall(text.lower() if text.isascii() else _letters(text))


def words_with_offsets(text: str) -> tuple[list[str], list[int], list[int]]:
    """The same words with the places in the original where each begins and ends."""
    out: list[str] = []
    begins: list[int] = []
    ends: list[int] = []
    chars, source = [], []
    at = 0
    for piece in re.split(f"({_ENTITY.pattern})", text) if "&" in text else [text]:
        if _ENTITY.fullmatch(piece):
            for c in _letters(html.unescape(piece)):
                chars.append(c)
                source.append(at)
            at += len(piece)
            continue
        for c in piece:
            for x in c.lower() if c.isascii() else _letters(c):
                chars.append(x)
                source.append(at)
            at += 1
    for m in _WORD.finditer("".join(chars)):
        out.append(m[0])
        begins.append(source[m.start()])
        ends.append(source[m.end() - 1] + 1)
    return out, begins, ends


class Automaton:
    """Seeds of all items; built once in each Python worker."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        items = [(n, t) for n, (_, t) in enumerate(items)]  # an item may have several texts
        self.words = {i: words(t) for i, t in items}
        # the measure of length is pieces between white space, as a hyphenated word may be two words here
        self.weight = {i: [1.0 / len(w) for piece in _pieces(t) if (w := words(piece)) for _ in w] for i, t in items}
        # words as numbers from 1; 0 is any word that no item has
        self.numbers: dict[str, int] = {}
        self.numbered = {i: [self.numbers.setdefault(w, len(self.numbers) + 1) for w in ws] for i, ws in self.words.items()}
        self.present = np.zeros(len(self.numbers) + 1, dtype=bool)
        at: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for i, ws in self.numbered.items():
            for p in range(len(ws) - SEED + 1):
                at[tuple(ws[p : p + SEED])].append((i, p))
        self.tree = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for number, seed in enumerate(at):
            self.tree.add_word(seed, number)
        if at:
            self.tree.make_automaton()
        lengths = [np.concatenate(([0.0], np.cumsum(w))) for w in self.weight.values()]
        # of all items, one after another, each with a place before its first word: numbers, weights, and the last place
        # at least MIN_WORDS earlier, -1 if there is none; the place before the first has no weight
        self.sizes = np.array([len(x) for x in lengths], dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.all_numbers = np.concatenate([x for n in self.numbered.values() for x in ([0], n)] or [[]]).astype(np.int64)
        self.all_weights = np.concatenate([np.diff(x, prepend=0.0) for x in lengths] or [[]])
        self.far = np.concatenate([np.searchsorted(x, x - MIN_WORDS + 1e-6, side="right") - 1 for x in lengths] or [[]]).astype(np.int64)
        self.longest = max(map(len, self.words.values()), default=0) + SEED + 1
        # places of each seed, one after another: the item, the word of the item
        self.n_places = np.array([len(v) for v in at.values()], dtype=np.int64)
        self.first_place = np.concatenate(([0], np.cumsum(self.n_places)))[:-1]
        self.place_item = np.array([i for v in at.values() for i, _ in v], dtype=np.int64)
        self.place_word = np.array([p for v in at.values() for _, p in v], dtype=np.int64)

    def _candidates(self, text: tuple[int, ...]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(item, places of its seeds in the text, words of the item) for stretches of seeds that cover COVER words of an item."""
        hits = list(self.tree.iter(text))
        if len(hits) < -(-COVER // SEED):
            return []
        ends, seeds = np.array(hits, dtype=np.int64).T
        n = self.n_places[seeds]
        skip = np.repeat(self.first_place[seeds] - (np.cumsum(n) - n), n)
        place = np.arange(len(skip)) + skip
        item = self.place_item[place]
        # items of which seeds cover words enough, then those whose words stand in the text at all; few are left
        often = np.bincount(item)
        key = np.sort(item * self.longest + self.place_word[place])
        of = key // self.longest
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        fresh = np.minimum(SEED, np.diff(key, append=0))
        fresh[np.concatenate((first[1:], [len(key)])) - 1] = SEED
        items = of[first[np.add.reduceat(fresh, first) >= COVER]]
        if not len(items):
            return []
        near = np.array(text)
        self.present[near] = True
        self.present[0] = False
        items = items[self._may_hold(items, lambda _, numbers: self.present[numbers])]
        self.present[near] = False
        if not len(items):
            return []
        wanted = np.zeros(len(often), dtype=bool)
        wanted[items] = True
        kept = np.flatnonzero(wanted[item])
        item, word, at = item[kept], self.place_word[place[kept]], np.repeat(ends, n)[kept] + 1 - SEED
        order = np.argsort(item, kind="stable")  # hits come in the order of the text
        item, word, at = item[order], word[order], at[order]
        stretch = np.concatenate(([0], np.cumsum((item[1:] != item[:-1]) | (at[1:] - at[:-1] > REACH + SEED))))
        sizes = np.bincount(stretch)
        first = np.cumsum(sizes) - sizes
        fresh = np.minimum(SEED, np.diff(word[np.lexsort((word, stretch))], append=0))
        fresh[first + sizes - 1] = SEED
        covered = np.add.reduceat(fresh, first)
        return [(int(item[first[k]]), at[first[k] : first[k] + sizes[k]], word[first[k] : first[k] + sizes[k]]) for k in np.flatnonzero(covered >= COVER)]

    def _may_hold(self, items: np.ndarray, stands) -> np.ndarray:
        """For each of the items (one may come twice) whether it has a stretch long enough of whose words few enough are lacking.

        stands(own, numbers) says which words stand in the text, own being the place among the items.
        """
        n = self.sizes[items]
        shift = np.cumsum(n) - n
        place = np.arange(shift[-1] + n[-1]) + np.repeat(self.begins[items] - shift, n)
        own = np.repeat(np.arange(len(items)), n)
        weights = self.all_weights[place]
        score = np.cumsum(np.where(stands(own, self.all_numbers[place]), weights, (1.0 - CHANGED) * weights))
        low = 1e7 * own  # keeps the least score of one item from the next
        least = np.minimum.accumulate(score - low) + low
        far = self.far[place]
        some = np.flatnonzero(far >= 0)
        good = some[score[some] - least[far[some] + shift[own[some]]] >= -1e-5]
        out = np.zeros(len(items), dtype=bool)
        out[own[good]] = True
        return out

    def leaks(self, text: str) -> list[tuple[int, int, int]]:
        """(item, first word, word after the last) for each item that the text holds; the words are the text's."""
        ws = words(text) if text and len(self.place_item) else []
        get = self.numbers.get
        numbered = tuple([get(w, 0) for w in ws])
        found = self._candidates(numbered) if len(ws) >= SEED else []
        if not found:
            return []
        # the same test again for each stretch of seeds, of the words around it only: by the sorted places of each word
        items = np.array([i for i, _, _ in found])
        reach = 2 * REACH + np.maximum(0, self.sizes[items] // CHANGED - 3)
        low, high = np.array([at[0] for _, at, _ in found]) - reach, np.array([at[-1] for _, at, _ in found]) + SEED + reach
        size = len(ws) + 1
        known = np.array(numbered, dtype=np.int64)
        at = np.flatnonzero(known)
        at = np.sort(known[at] * size + at)
        low, high = np.maximum(low, 0), np.minimum(high, len(ws))

        def stands(own: np.ndarray, numbers: np.ndarray) -> np.ndarray:
            return np.searchsorted(at, numbers * size + low[own]) < np.searchsorted(at, numbers * size + high[own])

        out = []
        for k in np.flatnonzero(self._may_hold(items, stands)).tolist():
            i, places, of = found[k]
            for group in _groups(list(zip(places.tolist(), of.tolist()))):
                if (span := self._aligned(i, ws, group)) is not None:
                    out.append((self.ids[i], *span))
        return out

    def _aligned(self, i: int, ws: list[str], group: list[tuple[int, int]]) -> tuple[int, int] | None:
        item, weight = self.words[i], self.weight[i]
        low, high = max(0, min(j for j, _ in group) - 2 * REACH), min(len(ws), max(j for j, _ in group) + SEED + 2 * REACH)
        drifts = [j - p for j, p in group]
        near, far = min(drifts) - DRIFT, max(drifts) + DRIFT
        places = defaultdict(list)
        for p, w in enumerate(item):
            places[w].append(p)
        # first with few words lacking in a row, then with as many as may be changed in the whole item
        for most in dict.fromkeys((3, max(3, len(item) // CHANGED))):
            if (span := self._chained(ws[: high + most - 3], max(0, low - most + 3), places, weight, near - most + 3, far + most - 3, most)) is not None:
                return span
        return None

    def _chained(self, ws: list[str], low: int, places: dict[str, list[int]], weight: list[float], near: int, far: int, most: int) -> tuple[int, int] | None:
        # longest chain of equal words; from one to the next up to ``most`` words of the item may be lacking, and
        # beside those up to FOREIGN words more may stand in the text
        best: dict[tuple[int, int], tuple[int, tuple[int, int] | None]] = {}
        recent: list[list[tuple[int, int]]] = []
        for j in range(low, len(ws)):
            mine = []
            for p in places.get(ws[j], ()):
                if near <= j - p <= far:
                    top, back = 0, None
                    for q, earlier in recent:
                        lacking, between = p - q[1] - 1, j - q[0] - 1
                        if 0 <= lacking <= most and between <= lacking + FOREIGN and best[q][0] - 0.01 * (lacking + between) > top:
                            top, back = best[q][0] - 0.01 * (lacking + between), q
                    best[j, p] = (top + 1, back)
                    mine.append(((j, p), j))
            recent = [x for x in recent if j - x[1] <= most + FOREIGN] + mine
        if not best:
            return None
        ends, used = sorted(best, key=lambda q: -best[q][0]), set()
        for q in ends:
            if best[q][0] < MIN_WORDS * (1 - 1 / CHANGED) * 0.6:
                break
            if q in used:
                continue
            chain = []
            while q is not None and q not in used:
                used.add(q)
                chain.append(q)
                q = best[q][1]
            chain.reverse()
            if (span := _long_enough(chain, weight)) is not None:
                return span
        return None


def _pieces(text: str) -> list[str]:
    return (_ENTITY.sub(lambda m: html.unescape(m[0]), text) if "&" in text else text).split()


def _groups(seeds: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Seeds that lie close together in the text on nearly one diagonal, where they cover enough words of the item."""
    groups: list[list[tuple[int, int]]] = []
    open_: list[list[tuple[int, int]]] = []
    for j, p in sorted(seeds):
        open_ = [g for g in open_ if j - g[-1][0] <= REACH + SEED]
        for g in open_:
            if abs((j - p) - (g[-1][0] - g[-1][1])) <= DRIFT:
                g.append((j, p))
                break
        else:
            groups.append([(j, p)])
            open_.append(groups[-1])
    return [g for g in groups if len({p + k for _, p in g for k in range(SEED)}) >= COVER]


def _long_enough(chain: list[tuple[int, int]], weight: list[float]) -> tuple[int, int] | None:
    """The first and last word in the text of a stretch that meets the rule: with a the words of the item that
    stand there and c those that were changed, c is at most an eighth of a + c, which is at least MIN_WORDS."""
    total = [0.0]
    for w in weight:
        total.append(total[-1] + w)
    have = [0.0]
    for _, p in chain:
        have.append(have[-1] + weight[p])
    n = len(chain)
    # widest stretch by the score matched - (CHANGED - 1) * changed >= 0
    for a in range(n):
        for b in range(n - 1, a, -1):
            length = total[chain[b][1] + 1] - total[chain[a][1]]
            if length < MIN_WORDS - 1e-6:
                break
            changed = length - (have[b + 1] - have[a])
            if changed * CHANGED <= length + 1e-6:
                return chain[a][0], chain[b][0] + 1
    return None


def find_leaks(documents: DataFrame, items: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """(doc_id, item_id, begin, end): each item that a document holds, with the place of the passage in its text.

    documents: (doc_id, text), items: (item_id, text); further columns are left out.  Null and empty texts hold
    and yield nothing, items shorter than MIN_WORDS words yield nothing, an empty table gives an empty result.
    Of an item given with several texts under one id each is searched; two ids with one text both count.  Rows of documents repeated under one id give their pairs once.  More than ``max_items`` items are an
    error, as the automaton is sent to every executor.
    """
    kept = sorted({tuple(r) for r in bounded_rows(items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL"), max_items, "the evaluation set")})
    sent = send(documents.sparkSession, kept)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = built(sent, Automaton)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                if not text:
                    continue
                pairs = tree.leaks(text)
                if pairs:
                    _, begins, ends = words_with_offsets(text)
                    first: dict[int, tuple[int, int]] = {}
                    for i, a, b in pairs:
                        span = (begins[min(a, len(begins) - 1)], ends[min(b, len(ends)) - 1])
                        first[i] = min(first.get(i, span), span)
                    rows += [(doc, i, *span) for i, span in first.items()]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "begin", "end"])

    out = f"doc_id {kind}, item_id {items.schema['item_id'].dataType.simpleString()}, begin int, end int"
    return documents.select("doc_id", "text").where(F.length("text") > 0).mapInPandas(scan, out).dropDuplicates(["doc_id", "item_id"])


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) of every document that holds a passage of an item."""
    return find_leaks(documents, items).select("doc_id", "item_id")
