"""Clean speaker turns from transcript lines.

Method: each line is tokenised; every token is tagged as time mark, speaker label, sound note, hesitation or
speech by a linear-chain sequence model whose best path is found by Viterbi; the tags yield the label, the time
and the number of words of the line.  Turns are then assembled from the lines: forward fill of label and time
in file order, order by time, runs of one voice.

Scale: tagging needs no shuffle.  What is assembled are a few numbers a line, not texts.  The ordered steps
work in chunks of a transcript (by line number, then by time) and carry the state from chunk to chunk through a
table of one row a chunk, so a transcript that holds a third of all lines is spread over many tasks.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.io import cut, spread

CHUNK_LINES, CHUNK_MS = 20_000, 3_600_000

TIME, LABEL, LABEL_END, NOTE, FILLER, SPEECH = range(6)
START = STATES = 6  # the state before the first token
#: Kinds of tokens that the model sees.
KINDS = "time time_colon arrow cue_word cue_letter letter letter_colon title name name_colon open inside close noted filler word word_colon other".split()
_K = {k: n for n, k in enumerate(KINDS)}
_TIME = r"(?:\d{1,3}:)?\d{1,3}:\d{2}(?:[.,]\d{1,3})?|\d{1,2}h\d{1,2}m(?:\d{1,2}s)?"
_IS_TIME = re.compile(rf"[\[(<{{]?(?:{_TIME})[\])>}}]?(:?)")
_IN_TIME = re.compile(_TIME)
_FILLER = re.compile(r"(?:u+h+|u+h*m+|e+r+m*|e+h+m*|a+h+m*|h+m+|m{2,})", re.I)
_EDGE = re.compile(r"^[^\w\[\](){}<>*♪]+|[^\w\[\](){}<>*♪]+$")
_OPEN, _CLOSE = "[({<", "])}>"
# Words that stand before the letter of a voice, and titles that stand before a name.
_CUES = {"speaker", "spk", "spkr", "spkr.", "spk.", "voice"}
_TITLES = {"mr", "ms", "mrs", "dr", "mayor", "councilmember", "councilman", "councilwoman", "commissioner", "cm", "board", "member", "chair", "director", "chief", "vice", "president", "trustee", "judge", "hon"}


def _emissions() -> np.ndarray:
    """Scores of kinds by state; what is not named is very unlikely."""
    table = np.full((STATES, len(KINDS)), -12.0)
    for state, scores in {
        TIME: {"time": 0.0, "time_colon": 0.0, "arrow": 0.0},
        LABEL: {"cue_word": 0.0, "letter": -1.0, "title": -0.5, "name": -1.0},
        LABEL_END: {"cue_letter": 0.0, "letter_colon": 0.0, "name_colon": 0.0, "word_colon": -7.0},
        NOTE: {"open": 0.0, "inside": 0.0, "close": 0.0, "noted": 0.0},
        FILLER: {"filler": 0.0},
        SPEECH: {"word": 0.0, "name": -0.2, "title": -0.2, "letter": -0.2, "word_colon": -0.5, "name_colon": -3.0, "letter_colon": -3.0, "cue_word": -0.5, "cue_letter": -3.0, "other": 0.0, "filler": -6.0, "inside": -2.0, "open": -6.0, "close": -6.0},
    }.items():
        for kind, score in scores.items():
            table[state, _K[kind]] = score
    return table


def _transitions() -> np.ndarray:
    """Scores from state (row; the last row is the start of the line) to state."""
    never = -20.0
    t = np.array(
        [
            # time  label  end    note   filler speech
            [0.0, -0.7, -0.7, -1.5, -1.5, -1.0],  # time
            [never, -0.3, 0.0, never, never, never],  # label: it goes on, or ends with a colon
            [-1.0, never, never, -2.0, -2.0, -1.0],  # end of the label
            [-4.0, -9.0, -9.0, -0.7, -2.0, -0.7],  # note
            [-4.0, -9.0, -9.0, -2.0, -1.5, -0.5],  # filler
            [-4.0, -12.0, -12.0, -2.0, -2.0, -0.2],  # speech
            [-0.7, -0.7, -0.7, -2.0, -2.0, -1.0],  # start
        ]
    )
    return t


EMIT, STEP = _emissions(), _transitions()


def viterbi(kinds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best states for a batch of lines; kinds is (lines, longest), filled up with -1 beyond each length."""
    n, width = kinds.shape
    scores = STEP[START] + EMIT[:, kinds[:, 0]].T
    back = np.zeros((n, width, STATES), dtype=np.int8)
    for t in range(1, width):
        paths = scores[:, :, None] + STEP[None, :STATES, :]
        best = paths.argmax(axis=1)
        moved = np.take_along_axis(paths, best[:, None, :], axis=1)[:, 0, :] + EMIT[:, np.maximum(kinds[:, t], 0)].T
        alive = (t < lengths)[:, None]
        back[:, t] = np.where(alive, best, np.arange(STATES))
        scores = np.where(alive, moved, scores)
    states = np.zeros((n, width), dtype=np.int8)
    states[:, -1] = scores.argmax(axis=1)
    rows = np.arange(n)
    for t in range(width - 1, 0, -1):
        states[:, t - 1] = back[rows, t, states[:, t]]
    return states


_kinds: dict[str, int] = {}


def _kind(token: str) -> int:
    kind = _kinds.get(token)
    if kind is None:
        if len(_kinds) > 300_000:
            _kinds.clear()
        kind = _kinds[token] = _K[_kind_of(token)]
    return kind


def _kind_of(token: str) -> str:
    if m := _IS_TIME.fullmatch(token):
        return "time_colon" if m[1] else "time"
    if token in ("-->", "->", ">>", ">>>", "→"):
        return "arrow"
    core = _EDGE.sub("", token)
    if not core:
        return "other"
    if core[0] in _OPEN and core[-1] in _CLOSE or len(core) > 2 and core[0] == core[-1] and core[0] in "*♪":
        return "noted"
    if core[0] in _OPEN:
        return "open"
    if core[-1] in _CLOSE:
        return "close"
    if core in "*♪" or core[0] in "*♪":
        return "open"
    if core[-1] in "*♪":
        return "close"
    if _FILLER.fullmatch(core) and not token.endswith(":"):
        return "filler"
    colon = token.endswith(":")
    plain = core.lower()
    if re.fullmatch(r"(?:speaker|spkr?|voice)[._ ]?[a-z]", plain) and (colon or "_" in plain):
        return "cue_letter"
    if plain.rstrip(".") in _CUES and not colon:
        return "cue_word"
    if len(core) == 1 and core.isalpha():
        return "letter_colon" if colon else "letter" if core.isupper() or core not in "ai" else "word"
    if colon:
        return "name_colon" if core[0].isupper() else "word_colon"
    if plain.rstrip(".") in _TITLES and core[0].isupper():
        return "title"
    return "name" if core[0].isupper() else "word"


def tokens(line: str) -> list[str]:
    """Pieces between white space; a bracketed note or time mark that touches a word stands by itself."""
    if line.isascii() and not any(c in line for c in "[({<*"):
        return line.split()
    line = re.sub(r"(?<=[^\s\[({<])(?=\[|\(\(?[a-z]|\{|<[a-z])|(?<=[\]}])(?=[^\s\])}:.,;!?…—-])", " ", line)
    return line.split()


def _kinds_of_line(pieces: list[str]) -> list[int]:
    """Kinds of the tokens of a line; those between an opening and a closing mark are inside a note."""
    kinds = [_kind(t) for t in pieces]
    if _K["open"] in kinds:
        at = 0
        while at < len(kinds):
            if kinds[at] == _K["open"]:
                mark = next(c for c in pieces[at] if c in "[({<*♪")
                shut = _CLOSE[_OPEN.index(mark)] if mark in _OPEN else mark
                # a note is short; an opening mark that is never closed is taken as a mark before a word
                end = next((k for k in range(at + 1, min(len(kinds), at + 9)) if shut in pieces[k]), None)
                if end is None:
                    kinds[at] = _K["word"] if any(map(str.isalnum, pieces[at])) else _K["other"]
                else:
                    kinds[at + 1 : end] = [_K["inside"]] * (end - at - 1)
                    kinds[end] = _K["close"]
                    at = end
            at += 1
    # a label may have its colon after a time mark, "Speaker A (1:02):"; then what stands before is its end
    for k, kind in enumerate(kinds[:8]):
        if kind == _K["time_colon"] and k:
            kinds[k - 1] = {_K["letter"]: _K["letter_colon"], _K["name"]: _K["name_colon"], _K["word"]: _K["word_colon"]}.get(kinds[k - 1], kinds[k - 1])
            if kinds[k - 1] == _K["word_colon"] and k >= 2 and kinds[k - 2] == _K["cue_word"]:
                kinds[k - 1] = _K["letter_colon"]
    return kinds


def seconds(mark: str) -> int | None:
    """Milliseconds of the first time in a mark, or None."""
    m = _IN_TIME.search(mark)
    if not m:
        return None
    if "h" in m[0]:
        h, mi, s = re.match(r"(\d+)h(\d+)m(?:(\d+)s)?", m[0]).groups()
        return ((int(h) * 60 + int(mi)) * 60 + int(s or 0)) * 1000
    whole, _, part = m[0].replace(",", ".").partition(".")
    total = 0
    for x in whole.split(":"):
        total = total * 60 + int(x)
    return total * 1000 + int((part + "000")[:3])


def tag_lines(lines: list[str | None]) -> list[tuple[str | None, int | None, int, str, bool]]:
    """(label, time in ms, words, spoken text, holds nothing but time marks) of each line."""
    split = [tokens(x) if x else [] for x in lines]
    out: list[tuple[str | None, int | None, int, str, bool]] = [(None, None, 0, "", False)] * len(lines)
    # lines of like length together, so that the longest does not widen all
    order = sorted((k for k, x in enumerate(split) if x), key=lambda k: len(split[k]))
    for at in range(0, len(order), 4_096):
        part = order[at : at + 4_096]
        kinds = [_kinds_of_line(split[k]) for k in part]
        lengths = np.array([len(x) for x in kinds])
        padded = np.full((len(part), int(lengths.max())), -1)
        for row, x in enumerate(kinds):
            padded[row, : len(x)] = x
        states = viterbi(padded, lengths)
        for row, k in enumerate(part):
            pieces, path = split[k], states[row]
            label = [t for t, s in zip(pieces, path) if s in (LABEL, LABEL_END)]
            times = [t for t, s in zip(pieces, path) if s == TIME]
            said = [t for t, s in zip(pieces, path) if s == SPEECH and any(map(str.isalnum, t))]
            mark = next((ms for t in times if (ms := seconds(t)) is not None), None)
            out[k] = (" ".join(label).rstrip(":").strip() or None, mark, len(said), " ".join(said), mark is not None and len(times) == len(pieces))
    return out


# ---- whose label it is -------------------------------------------------------------------------------------


def _plain(name: str) -> list[str]:
    text = re.sub(r"\([^)]*\)|,.*$", " ", name)
    text = "".join(c for c in unicodedata.normalize("NFKD", text.lower().replace("ø", "o")) if not unicodedata.combining(c))
    return [w for w in re.findall(r"[a-z][a-z'-]*", text) if w not in _TITLES and w not in ("jr", "sr")]


def letter_of(label: str, voices: list[tuple[str, str]]) -> str | None:
    """The letter a label means: the letter itself, or that of the nearest name among voices (letter, name).

    A name is compared as a whole, then by its last part; a few wrong letters are borne.  None if no name is near.
    """
    from quorumlake.llm.canonical import weighted_distance

    m = re.fullmatch(r"(?:(?:speaker|spkr?\.?|voice)[\s_.]*)?([a-z])", label.strip(), re.I)
    if m:
        return m[1].upper()
    mine, best = _plain(label), []
    if not mine:
        return None
    for letter, name in voices:
        theirs = _plain(name or "")
        if not theirs or not letter:
            continue
        whole = weighted_distance(" ".join(mine), " ".join(theirs), 4.0)
        last = weighted_distance(mine[-1], theirs[-1], 3.0)
        parts = min((weighted_distance(mine[-1], x, 2.0) for x in theirs[-1].split("-")), default=9.0) + 0.7
        first = 0.0 if len(mine) == 1 or mine[0][0] == theirs[0][0] else 1.5
        best.append((min(whole, min(last, parts) + first + (0.3 if len(mine) != len(theirs) else 0.0)), letter))
    return min(best)[1] if best and min(best)[0] <= max(1.6, 0.3 * len(mine[-1])) else None


# ---- ordered steps in chunks -------------------------------------------------------------------------------


def carried(df: DataFrame, key: str, chunk: str, order: list[str], fill: dict[str, str]) -> DataFrame:
    """Adds for each new: old of ``fill`` the last value of old that is not null at or before the row.

    Within (key, chunk) by a window; from chunk to chunk through a table of one row a chunk.
    """
    upto = Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({new: F.last(old, ignorenulls=True).over(upto) for new, old in fill.items()})
    at = F.struct(*order)
    ends = df.groupBy(key, chunk).agg(*(F.max_by(F.col(old), F.when(F.col(old).isNotNull(), at)).alias(f"__{new}") for new, old in fill.items()))
    before = Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(key, chunk, *(F.last(f"__{new}", ignorenulls=True).over(before).alias(f"__{new}") for new in fill))
    joined = local.join(ends, [key, chunk])
    return joined.withColumns({new: F.coalesce(F.col(new), F.col(f"__{new}")) for new in fill}).drop(*(f"__{new}" for new in fill))


def runs(df: DataFrame, key: str, chunk: str, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the number of the run of equal values of ``value`` (null equals null) in which a row stands."""
    within = Window.partitionBy(key, chunk).orderBy(*order)
    at = F.struct(*order)
    first = F.row_number().over(within) == 1
    marked = df.withColumns({"__first": first, "__new": F.when(~first & ~F.lag(value).over(within).eqNullSafe(F.col(value)), 1).otherwise(0)})
    ends = df.groupBy(key, chunk).agg(F.min_by(F.struct(value), at).alias("__head"), F.max_by(F.struct(value), at).alias("__tail"))
    changes = marked.groupBy(key, chunk).agg(F.sum("__new").alias("__inside"))
    chunks = Window.partitionBy(key).orderBy(chunk)
    ends = ends.join(changes, [key, chunk])
    ends = ends.withColumn("__turn", F.when(F.lag("__tail").over(chunks).isNull() | ~F.lag("__tail").over(chunks)[value].eqNullSafe(F.col("__head")[value]), 1).otherwise(0))
    ends = ends.withColumn("__base", F.sum(F.col("__turn") + F.col("__inside")).over(chunks.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__inside"))
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("__local", F.sum("__new").over(upto)).join(ends.select(key, chunk, "__base"), [key, chunk]).withColumn(name, F.col("__base") + F.col("__local")).drop("__first", "__new", "__local", "__base")


def speaker_turns(lines: DataFrame, speakers: DataFrame, with_text: bool = True) -> DataFrame:
    """(meeting_id, speaker, start_ms, end_ms, n_words[, text]) of every turn, in no order.

    lines: (meeting_id, line_no, line), speakers: (meeting_id, letter, name); further columns are left out.  A
    null line counts as empty, a line equal to the one before it counts once.  Lines before the first label
    belong to nobody and are left out; before the first time mark the time is 0.  A name that fits nobody keeps
    the voice it has as a label of its own, so its words are not lost: speaker is then the name as written.
    A time mark on a line of its own, as in subtitles, is that of the lines below it up to the next mark; start_ms
    is the earliest mark of the turn's lines (that of the line before, if they have none), end_ms the latest.
    Empty tables give an empty result.
    """
    raw = lines.where("meeting_id IS NOT NULL AND line_no IS NOT NULL").select("meeting_id", F.col("line_no").cast("bigint").alias("line_no"), F.coalesce("line", F.lit("")).alias("line"))
    raw = raw.groupBy("meeting_id", "line_no").agg(F.min("line").alias("line"))  # a row delivered twice
    # A neighbour may stand in the next chunk: the first and last line of each chunk are handed over.
    # Line numbers have no long gaps, so neighbours are found by an equal join on the number that follows.
    chunked = raw.withColumn("__chunk", F.floor(F.col("line_no") / CHUNK_LINES))
    near = Window.partitionBy("meeting_id", "__chunk").orderBy("line_no")
    edges = Window.partitionBy("meeting_id").orderBy("__chunk")
    heads = chunked.groupBy("meeting_id", "__chunk").agg(F.min_by("line", "line_no").alias("__head"), F.max_by("line", "line_no").alias("__tail"))
    heads = heads.select("meeting_id", "__chunk", F.lag("__tail").over(edges).alias("__before"), F.lead("__head").over(edges).alias("__after"))
    placed = chunked.withColumns({"__prev": F.lag("line").over(near), "__next": F.lead("line").over(near)}).join(heads, ["meeting_id", "__chunk"])
    prev, following = F.coalesce("__prev", "__before"), F.coalesce("__next", "__after")
    number = F.col("line").rlike(r"^\s*\d+\s*$") & F.coalesce(following.contains("-->"), F.lit(False))
    kept = placed.where(~F.coalesce(prev == F.col("line"), F.lit(False)) & ~number & F.col("line").rlike(r"\S")).select("meeting_id", "line_no", "__chunk", "line")

    kind = lines.schema["meeting_id"].dataType.simpleString()

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = pd.DataFrame(tag_lines(batch["line"].tolist()), columns=["label", "ms", "n_words", "said", "bare"])
            made["ms"] = made["ms"].astype("Int64")
            made.insert(0, "meeting_id", batch["meeting_id"].to_numpy())
            made.insert(1, "line_no", batch["line_no"].to_numpy())
            made.insert(2, "__chunk", batch["__chunk"].to_numpy())
            yield made[["meeting_id", "line_no", "__chunk", "label", "ms", "n_words", "bare"] + ["said"] * with_text]

    # used for labels and lines alike, several times over: written once, so that no line is tagged twice
    tagged = cut(spread(kept, "meeting_id", "__chunk").mapInPandas(tag, f"meeting_id {kind}, line_no bigint, __chunk bigint, label string, ms bigint, n_words int, bare boolean" + ", said string" * with_text))
    voices = speakers.where("meeting_id IS NOT NULL AND letter IS NOT NULL AND name IS NOT NULL").select("meeting_id", "letter", "name").distinct()
    voices = voices.groupBy("meeting_id").agg(F.sort_array(F.collect_list(F.struct("letter", "name"))).alias("voices"))  # the voices of one meeting

    @F.pandas_udf("string")
    def letter(labels: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([letter_of(x, [(v["letter"], v["name"]) for v in (k if k is not None else [])]) or x for x, k in zip(labels, known)], dtype=object)

    labels = spread(tagged.where(F.col("label").isNotNull()).select("meeting_id", "label").distinct().join(voices, "meeting_id", "left"), "meeting_id", "label")
    labels = labels.select("meeting_id", "label", letter("label", "voices").alias("own"))
    named = tagged.join(labels, ["meeting_id", "label"], "left").withColumn("mark", F.when(F.col("ms").isNotNull(), F.struct("ms", "bare")))
    filled = carried(named, "meeting_id", "__chunk", ["line_no"], {"speaker": "own", "last": "mark"}).where("speaker IS NOT NULL AND NOT bare")
    # a mark on a line of its own, as above the text of a subtitle, is that of the lines below it and of no voice before them
    filled = filled.withColumns({"at": F.coalesce("last.ms", F.lit(0)), "ms": F.when(F.col("last.bare"), F.col("last.ms")).otherwise(F.col("ms"))})
    timed = cut(filled.drop("mark", "last").withColumn("__hour", F.floor(F.col("at") / CHUNK_MS)))
    first = runs(timed, "meeting_id", "__hour", ["at", "line_no"], "speaker", "__stretch")
    said = [F.sort_array(F.collect_list(F.when(F.col("n_words") > 0, F.struct("at", "line_no", "said")))).alias("parts")] if with_text else []
    stretches = first.groupBy("meeting_id", "__stretch").agg(
        F.first("speaker").alias("speaker"), F.coalesce(F.min("ms"), F.min("at")).alias("start_ms"), F.max("at").alias("end_ms"), F.min("__hour").alias("__hour"), F.sum("n_words").cast("int").alias("n_words"), *said
    )
    spoken = runs(cut(stretches.where("n_words > 0")), "meeting_id", "__hour", ["__stretch"], "speaker", "__turn")
    texts = [F.concat_ws(" ", F.transform(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("__stretch", "parts"))), lambda s: s["parts"])), lambda p: p["said"])).alias("text")] if with_text else []
    return spoken.groupBy("meeting_id", "__turn").agg(
        F.first("speaker").alias("speaker"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.sum("n_words").cast("int").alias("n_words"), *texts
    ).drop("__turn")


def found(lines: DataFrame, speakers: DataFrame) -> DataFrame:
    """(meeting_id, speaker, start_s, n_words) of every turn."""
    turns = speaker_turns(lines, speakers, with_text=False)
    return turns.select("meeting_id", "speaker", F.floor(F.col("start_ms") / 1000).cast("int").alias("start_s"), "n_words")
