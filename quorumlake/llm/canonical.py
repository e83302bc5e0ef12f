"""Mapping freely typed values to the entries of a reference list.

Method: a symmetric-delete dictionary of the list's labels, notes and given wordings is sent to every
executor (its size is checked).  A typed value is normalised, candidates within a bounded edit distance are
found through shared deletes of a short prefix, and ranked by weighted Damerau-Levenshtein distance, then by
how often the entry's label is met in the data.  A value that is near no phrase is read word by word through a
second such dictionary, of the phrases' words: forms of a word and short forms count as the word, order does not
matter, and the entry whose words it has for the most part holds.  Values without a candidate are reported as ``none``.

Scale: no shuffle for the look-up; each Python worker remembers the values it has seen, so a hot value costs
one dictionary probe per batch.  Only the dictionary and one count per entry travel.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from functools import lru_cache
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlake.io import bounded_rows, built, send

MAX_ENTRIES = 10_000
PREFIX = 9

# Wordings that mean an entry and that neither its label nor its note tells, by field and label.  Forms, short
# forms, orders and misspellings of these and of the labels are left to the rules.  An empty label means "no entry".
WORDINGS: dict[str, dict[str, str]] = {
    "vote": {
        "Yes": "y|yea|yeah|aye|ayes|affirmative|in favor|in favour|for|in the affirmative|approve",
        "No": "n|nay|voted nay|oppose|opposes|against|negative|dissent",
        "Abstain": "abst|abstention|present not voting",
        "Excused": "on leave|excused absence",
        "Absent": "not present|did not attend|no show|missing from meeting",
        "Recused": "recusal|conflict of interest",
        "": "voice vote|not called|pending|unknown|illegible",
    },
    "business_type": {
        "Ordinance": "ordinance 2nd reading",
        "Consent batch": "consent item|consent agenda|consent calendar",
        "Contract award": "contract award bids|bid award",
        "Closed session": "closed meeting|executive session",
        "Proclamation": "proclaim",
        "Rezone": "zone change|zoning map change",
        "Other business": "miscellaneous",
        "": "none given|see packet|scan error|untitled",
    },
    "outcome": {
        "Passed unanimously": "unanimous|unanimously|unan approval|passed unan|all ayes motion carried|all in favor",
        "Passed by divided vote": "passed on a split vote|carried not unanimous|carried with dissent|majority vote",
        "Failed": "motion failed|did not carry|did not pass|not approved|not adopted|defeated|voted down|denied|rejected",
        "Died for lack of a second": "lack of a second|failed for lack of a second|died no second|not seconded|motion died",
        "Tabled": "table|tbld|laid on the table|motion to table carried item tabled",
        "Continued": "contd|continued to a date certain|held over|hold over|postponed|deferred",
        "Withdrawn": "withdrew|w/drawn|item pulled by the applicant",
        "Referred back": "remanded to staff|returned to committee|sent back to staff|sent back to planning",
        "": "tbd|see minutes|see recording|audio lost|not transcribed|unclear",
    },
}
#: One scan misreading each, the letters meant first; and the shapes that are cheap to exchange.
MISREAD = [("m", "rn"), ("u", "ii"), ("d", "cl"), ("n", "ri"), ("w", "vv"), ("in", "m"), ("h", "li")]
ALIKE = {frozenset(p) for p in ("o0", "l1", "i1", "il", "s5", "e3", "a4", "b6", "b8", "ec", "ao", "ft", "hb", "gq", "gy", "z2", "rk", "fp", "co", "c0", "d0", "vu", "nm", "uv", "gc")}
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve".split()

_BULLET = re.compile(r"^[\s*\-–—•·>#]+")
_TAIL = re.compile(r"(?:\s*(?:\*+|[-–—]\s*recorded|\(?by phone\)|\(phone\)|[.;,!:*\s])+)$", re.I)
_WORD = re.compile(r"[a-z0-9/]+|\?+")
_TALLY_WORD = re.compile(r"[a-z0-9]+|[-–—:,]")


def plain(value: str) -> str:
    """Lower case, without bullets, notes at the end and punctuation; lone numbers become ``#``."""
    text = unicodedata.normalize("NFKC", value).lower().replace("’", "'").replace("'", "")
    text = _TAIL.sub("", _BULLET.sub("", text)) or text.strip()
    words = ["#" if w.isdigit() else "?" if w[0] == "?" else w for w in _WORD.findall(text)]
    return " ".join(words) or text.strip()[:1]


def folded(text: str) -> str:
    """A shape that is the same for letters and what a scanner takes them for."""
    for right, wrong in MISREAD:
        text = text.replace(wrong, right)
    text = text.replace("in", "m").replace("ri", "n").replace("rn", "m")
    return text.translate(str.maketrans("0134568", "oieasbb")).replace("l", "i")


def weighted_distance(a: str, b: str, limit: float) -> float:
    """Damerau-Levenshtein with cheap exchanges of letters that look alike, doubled letters and swaps.

    Returns a number above ``limit`` as soon as no alignment can stay within it.
    """
    n, m = len(a), len(b)
    band = int(2 * limit) + 2  # a misread letter shifts by one for half a point
    if abs(n - m) > band:
        return limit + 1
    far = limit + 1
    rows: list[list[float]] = [[0.0] * (m + 1)]
    for j in range(1, m + 1):
        rows[0][j] = rows[0][j - 1] + 1.0
    for i in range(1, n + 1):
        row = [rows[i - 1][0] + 1.0] + [far] * m
        for j in range(max(1, i - band), min(m, i + band) + 1):
            x, y = a[i - 1], b[j - 1]
            step = 0.0 if x == y else 0.5 if frozenset((x, y)) in ALIKE else 1.0
            drop = 0.6 if i > 1 and a[i - 2] == x else 1.0
            best = min(rows[i - 1][j - 1] + step, rows[i - 1][j] + drop, row[j - 1] + (0.6 if j > 1 and b[j - 2] == y else 1.0))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2] and x != y:
                best = min(best, rows[i - 2][j - 2] + 0.6)
            for right, wrong in MISREAD:
                p, q = len(wrong), len(right)
                if i >= p and j >= q and a[i - p : i] == wrong and b[j - q : j] == right:
                    best = min(best, rows[i - p][j - q] + 0.5)
            row[j] = best
        rows.append(row)
        if min(row) > limit and min(rows[i - 1]) > limit:
            return limit + 1
    return rows[n][m]


def allowance(length: int) -> tuple[int, float]:
    """Plain edits within which candidates are searched, and the weighted distance that is still accepted."""
    if length <= 2:
        return 1, 0.5
    if length == 3:
        return 1, 0.6
    if length <= 5:
        return 2, 1.2
    if length <= 8:
        return 2, 2.0
    return 3, 2.6 if length <= 14 else 3.2


def deletes(text: str, edits: int) -> set[str]:
    """The prefix of ``text`` and all it becomes by dropping up to ``edits`` letters."""
    head, out = text[:PREFIX], {text[:PREFIX]}
    for k in range(1, min(edits, len(head)) + 1):
        out.update("".join(c) for c in combinations(head, len(head) - k))
    return out


#: Words that say nothing about which entry is meant.
_FILLERS = frozenset("a an the of to by with was is be in on at as and or self himself herself it its this item items motion # then".split())
_SUFFIX = re.compile(r"(?<=[a-z]{3})(?:ations?|ions?|ments?|ings?|als?|ed|es|e|s)$")


def root(word: str) -> str:
    """A word without its ending, so that its forms are one."""
    return _SUFFIX.sub("", word.removesuffix("ly") if len(word) > 5 else word)


def shortens(short: str, word: str) -> bool:
    """Whether a word is a short form of another: its beginning, or some of its letters in order from the first, at least
    three and clearly fewer."""
    if not 3 <= len(short) <= 0.75 * len(word) or short[0] != word[0]:
        return False
    rest = iter(word)
    return word.startswith(short) or len(short) <= 5 and all(c in rest for c in short) and short[-1] in word[len(word) // 3 :]


class Lexicon:
    """The symmetric-delete dictionary of one field, of whole phrases and of their words.

    Phrases are the labels, the notes, and the wordings of an entry (pairs of label and wording, an empty label for "no entry").
    """

    def __init__(self, entries: list[tuple[str, str, str | None]], wordings: list[tuple[str, str]], frequency: dict[str, int]):
        self.frequency = frequency
        self.phrases: dict[str, str] = {}
        by_label = {label: entry for entry, label, _ in entries}
        for label, form in wordings:
            if not label or label in by_label:
                self.phrases.setdefault(form if form in "?-" else plain(form), by_label.get(label, "none"))
        for entry, label, note in entries:
            if note:
                self.phrases.setdefault(plain(note), entry)
        for entry, label, _ in entries:
            self.phrases[plain(label)] = entry
        self.index: dict[str, set[str]] = defaultdict(set)
        self.shapes: dict[str, set[str]] = defaultdict(set)
        for phrase in self.phrases:
            for key in deletes(phrase, allowance(len(phrase))[0]):
                self.index[key].add(phrase)
            for key in deletes(folded(phrase), 2 if len(phrase) > 4 else 1):
                self.shapes[key].add(phrase)
        # words: the entries in whose phrases a word stands weigh it, as one met in many entries tells little
        self.parts = {p: [w for w in p.split() if w not in _FILLERS] for p in self.phrases}
        of: dict[str, set[str]] = defaultdict(set)
        for phrase, words in self.parts.items():
            for w in words:
                of[w].add(self.phrases[phrase])
        self.weight = {w: 1.0 / len(es) for w, es in of.items()}
        self.holding: dict[str, list[str]] = defaultdict(list)
        for phrase, words in self.parts.items():
            for w in set(words):
                self.holding[w].append(phrase)
        self.told: dict[str, set[str]] = defaultdict(set)
        for phrase, words in self.parts.items():
            self.told[self.phrases[phrase]].update(words)
        self.roots: dict[str, list[str]] = defaultdict(list)
        self.initials: dict[str, list[str]] = defaultdict(list)
        self.words: dict[str, set[str]] = defaultdict(set)
        for w in of:
            self.roots[root(w)].append(w)
            self.initials[w[0]].append(w)
            for key in deletes(w, allowance(len(w))[0]) if len(w) > 3 else ():
                self.words[key].add(w)

    def nearest(self, text: str) -> str | None:
        """Entry of the nearest phrase, ``none`` for a phrase that means no entry, None without a candidate.

        Candidates are the phrases within the allowed plain edits, or within two edits of shape.
        """
        if text in self.phrases:
            return self.phrases[text]
        edits, most = allowance(len(text))
        found = set().union(*(self.index.get(k, ()) for k in deletes(text, edits)))
        shape = folded(text)
        found.update(*(self.shapes.get(k, ()) for k in deletes(shape, 2 if len(text) > 4 else 1)))
        ranked = []
        for phrase in found:
            limit = min(most, allowance(len(phrase))[1])
            d = weighted_distance(text, phrase, limit)
            if d <= limit:
                entry = self.phrases[phrase]
                ranked.append((round(d, 3), -self.frequency.get(entry, 0), entry, phrase))
        return min(ranked)[2] if ranked else None

    def _alike(self, word: str) -> dict[str, float]:
        """Dictionary words that a typed word may stand for, each with how surely."""
        out = {word: 1.0} if word in self.weight else {}
        for w in self.roots.get(root(word), ()) if len(word) > 2 else ():
            out[w] = max(out.get(w, 0.0), 0.95)
        if not out and len(word) > 3:
            edits, most = allowance(len(word))
            for w in set().union(*(self.words.get(k, ()) for k in deletes(word, edits))):
                limit = min(most, allowance(len(w))[1])
                d = weighted_distance(word, w, limit)
                if d <= limit:
                    out[w] = max(out.get(w, 0.0), 0.95 - 0.15 * d)
        if not out or max(out.values()) < 0.9:
            for w in self.initials.get(word[0], ()):
                if shortens(word, w):
                    out[w] = max(out.get(w, 0.0), 0.85)
        return out

    def by_words(self, text: str) -> str | None:
        """Entry of the phrase whose words the text has, in any order and form; None if no phrase has enough of them.

        What a phrase shares is weighed by how few entries a word stands for; words of either that the other lacks count
        against it.
        """
        typed = [w for w in text.split() if w not in _FILLERS][:40]
        alike = [self._alike(w) for w in typed]
        scores: dict[str, tuple[float, str]] = {}
        for phrase in {p for a in alike for w in a for p in self.holding[w]}:
            words = self.parts[phrase]
            best = {w: max((a[w] for a in alike if w in a), default=0.0) for w in words}
            shared = sum(self.weight[w] * x for w, x in best.items())
            here = sum(self.weight[w] for w in set(words))
            known = sum(max((self.weight[w] * a[w] for w in a if w in best), default=0.0) for a in alike)
            entry = self.phrases[phrase]
            own = self.told[entry]
            other = sum(0.0 if any(w in own for w in a) else max((self.weight[w] for w in a), default=0.25) for a in alike)
            score = 2 * shared / (here + known + other) if here else 0.0
            if (score, phrase) > scores.get(entry, (0.0, "")):
                scores[entry] = score, phrase
        ranked = sorted(((-x, -self.frequency.get(e, 0), e) for e, (x, _) in scores.items()))
        return ranked[0][2] if ranked and -ranked[0][0] >= 0.62 else None

    def entry(self, value: str) -> str:
        """Entry for a typed value: as a whole, without a remark in brackets, then without sentences that follow; by phrases
        first, then by words."""
        tries = [value, re.sub(r"\([^)]*\)", " ", value)]
        tries += [value[: m.start()] for m in re.finditer(r"[.;]\s+(?=\S+\s+\S+\s+\S)", value)]
        tries += [re.split(r"\s[-–—]\s", value)[0]]
        keys = list(dict.fromkeys(k for k in map(plain, tries) if k))
        for key in keys:
            found = self.nearest(key)
            if found is not None:
                return found
            if " " in key and (squeezed := self.nearest(key.replace(" ", ""))) is not None and len(key) > 6:
                return squeezed
        return next((e for key in keys if (e := self.by_words(key)) is not None), "none")


def tally(value: str) -> tuple[int, int] | None:
    """Votes for and against stated in figures or words, else None.

    A tally is a number, a dash, colon, "to" or "in favor", and a number; a scan or typing error may stand in
    the words, but at least one of the numbers must be right to the letter.
    """
    text = re.sub(r"\bof(?=\d)|(?<=\d)\s*t[o0]\s*(?=\d)", lambda m: f" {m[0].strip()} ", unicodedata.normalize("NFKC", value).lower())
    words = _TALLY_WORD.findall(text)
    for i in range(len(words) - 2):
        first = _number(words[i][2:] if words[i].startswith("of") and len(words[i]) > 4 else words[i])
        if first is None:
            continue
        for gap in (1, 2, 3):
            second = _number(words[i + gap + 1]) if i + gap + 1 < len(words) else None
            if second is not None and first[1] + second[1] <= 2.0 and 0 in (first[1], second[1]) and _between(words[i + 1 : i + gap + 1]):
                return first[0], second[0]
    return None


def _between(words: list[str]) -> bool:
    if len(words) == 1:
        return words[0] in "-–—:" or len(words[0]) <= 3 and not words[0].isdigit() and weighted_distance(words[0], "to", 1.0) <= 1.0
    favor = words[1]
    return len(words[0]) <= 3 and words[0].isalpha() and len(favor) >= 4 and min(weighted_distance(favor, w, 2.0) for w in ("favor", "favour")) <= 2.0 and words[2:] in ([], [","])


@lru_cache(maxsize=4096)
def _number(word: str) -> tuple[int, float] | None:
    """The number meant and how far the word is from it; only figures and number words count."""
    if word.isdigit():
        return (int(word), 0.0) if len(word) <= 3 else None
    if not 2 <= len(word) <= 7 or sum(map(str.isalpha, word)) < 2:
        return None
    d, n = min((weighted_distance(word, name, 1.0), i) for i, name in enumerate(NUMBERS))
    return (n, d) if d <= 1.0 else None


def outcome_by_tally(counts: tuple[int, int]) -> str:
    """Label of the outcome that a stated tally means."""
    yes, no = counts
    return "Failed" if yes <= no else "Passed unanimously" if no == 0 else "Passed by divided vote"


def default_wordings() -> list[tuple[str, str, str]]:
    """(field, label, wording) of the wordings that no rule gives."""
    return [(field, label, form) for field, by_label in WORDINGS.items() for label, forms in by_label.items() for form in forms.split("|")]


def lexicons(rows: list[tuple], frequency: dict[str, int], known: list[tuple[str, str, str]] | None = None) -> dict[str, Lexicon]:
    """A lexicon for each field of the reference list; rows are (entry_id, field, label, note), known are (field, label, wording)."""
    wordings = defaultdict(list)
    for field, label, form in default_wordings() if known is None else known:
        wordings[field].append((label, form))
    by_field = defaultdict(list)
    for entry, field, label, note in sorted(rows, key=lambda r: tuple(map(str, r))):
        if entry is not None and field is not None and label is not None:
            by_field[field].append((entry, label, note))
    return {field: Lexicon(entries, wordings.get(field, []), frequency) for field, entries in by_field.items()}


def entry_of(books: dict[str, Lexicon], labels: dict[tuple[str, str], str], field: str, value: str) -> str:
    """Entry for one value of one field; a tally in an outcome decides before its words."""
    if field == "outcome" and (counts := tally(value)) and (hit := labels.get((field, outcome_by_tally(counts)))):
        return hit
    return books[field].entry(value) if field in books else "none"


def map_values(values: DataFrame, reference: DataFrame, max_entries: int = MAX_ENTRIES, wordings: DataFrame | None = None) -> DataFrame:
    """``values`` with the column ``entry_id``.

    values: any columns, among them ``field`` and ``value`` (strings).  reference: (entry_id, field, label,
    note), at most ``max_entries`` rows, else an error.  A null or blank value has a null entry_id, a value
    equal to a label gets that entry, one that means no entry ``none``.  An empty reference gives ``none``
    everywhere; rows with a null id, field or label in it are passed over.  Repeated rows stay repeated; of
    equally near entries the more frequent one wins, then the smaller id.  An ``entry_id`` already in values
    is replaced; all other columns are kept.

    wordings: (field, label, wording) of known ways to write an entry, an empty or null label meaning no entry; at most
    ``max_entries`` rows.  Without it the few that no rule gives are taken for the fields that have some.
    """
    entries = [tuple(r) for r in bounded_rows(reference.select("entry_id", "field", "label", "note"), max_entries, "the reference list")]
    labels = {(f, l): e for e, f, l, _ in entries if None not in (e, f, l)}
    exact = F.concat_ws("\x1f", "field", "value")
    typed = [f"{f}\x1f{l}" for f, l in labels]
    frequency: dict[str, int] = {}
    if typed:
        for r in values.where(exact.isin(typed)).groupBy("field", "value").count().collect():  # a row for each label at most
            frequency[labels[r["field"], r["value"]]] = r["count"]
    known = None
    if wordings is not None:
        rows = bounded_rows(wordings.select("field", "label", "wording").where("field IS NOT NULL AND trim(wording) <> ''"), max_entries, "the list of wordings")
        known = sorted({(f, l or "", w) for f, l, w in map(tuple, rows)})
    sent = send(values.sparkSession, (entries, labels, frequency, known))

    @F.pandas_udf("string")
    def entry(field: pd.Series, value: pd.Series) -> pd.Series:
        look = built(sent, _look_up)
        return pd.Series([look(f, v) for f, v in zip(field, value)], dtype=object)

    return values.withColumn("entry_id", entry(F.col("field"), F.col("value")))


def _look_up(sent: tuple):
    """The look-up of a Python worker; it remembers up to 200,000 values and starts over beyond."""
    entries, labels, frequency, known = sent
    books, seen = lexicons(entries, frequency, known), {}

    def look(field, value):
        if field is None or value is None or not str(value).strip():
            return None
        pair = (field, value)
        if pair not in seen:
            if len(seen) >= 200_000:
                seen.clear()
            seen[pair] = labels.get(pair) or entry_of(books, labels, field, value)
        return seen[pair]

    return look


def typed_values(motions: DataFrame) -> DataFrame:
    """(motion_id, field, pos, value) for each typed value of the motions table, null and blank ones left out."""
    one = lambda field, pos, value: F.struct(F.lit(field).alias("field"), pos.cast("int").alias("pos"), value.alias("value"))
    rolls = F.transform(F.coalesce("votes", F.array()), lambda v, i: one("vote", i, v["vote"]))
    every = F.concat(F.array(one("outcome", F.lit(-1), F.col("outcome")), one("business_type", F.lit(-1), F.col("business_type"))), rolls)
    return motions.select(F.col("id").alias("motion_id"), F.explode(F.filter(every, lambda x: x["value"].rlike(r"\S"))).alias("x")).select("motion_id", "x.field", "x.pos", "x.value")


def found(motions: DataFrame, reference: DataFrame) -> DataFrame:
    """(motion_id, field, pos, entry_id) of every value that is not a label itself; rows delivered again count once, and rows
    without an id once for each different value."""
    mapped = map_values(typed_values(motions), reference)
    labels = reference.select("field", F.col("label").alias("value")).distinct()  # as small as the checked list; Spark picks the join
    rest = mapped.join(labels, ["field", "value"], "left_anti").withColumn("__own", F.when(F.col("motion_id").isNull(), F.col("value")))
    return rest.dropDuplicates(["motion_id", "field", "pos", "__own"]).select("motion_id", "field", "pos", "entry_id")
