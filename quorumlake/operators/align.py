"""Turns of a transcript set on the clock of its subtitles, as one fold over arrays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlake.functions.text import norm_word

BAND, TAIL = 10, 4
_TURN = "struct<speaker:string,start_s:double,end_s:double,words:int>"


def words_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\s+"), norm_word), lambda w: w != "")


def _best_end(own: Column, at: Column, stream: Column, band: int, tail: int) -> Column:
    """Where a turn of these words ends: of the places within the band of the expected one, the first before which most of the
    turn's last words stand; the expected place where none stands."""
    n, total = F.size(own), F.size(stream)
    expected = at + n
    low, high = F.greatest(at + 1, expected - band), F.least(total, expected + band)
    last = F.slice(F.reverse(own), F.lit(1), F.lit(tail))
    hits = lambda end: F.size(F.filter(F.transform(last, lambda w, j: (end > j) & (F.get(stream, end - 1 - j) == w)), lambda same: same))
    scored = F.transform(F.sequence(low, F.greatest(low, high)), lambda e: F.struct(hits(e).alias("hits"), (-e).alias("e")))
    best = F.array_max(F.filter(scored, lambda s: (s["hits"] > 0) & (-s["e"] <= high)))
    return F.coalesce(-best["e"], F.least(total, expected))


def timed_turns(turns: DataFrame, cues: DataFrame, key: str = "stem", band: int = BAND, tail: int = TAIL) -> DataFrame:
    """(key, turn_no, speaker, start_s, end_s, words) for turns (key, turn_no, speaker, text) and cues (key, cue_no, start_s, end_s, text).

    One cursor runs through the words of the cues, so a transcript is one row with its words as arrays, and transcripts
    are aligned in parallel.  Turns without words do not move the cursor and are left out; turns after the last word of the
    cues too.  turn_no counts the turns that are left.  Keys without turns or cues give no row.
    """
    said = turns.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("turn_no", "speaker", words_of(F.col("text")).alias("w")))).alias("turns"))
    heard = cues.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("cue_no", "start_s", "end_s", words_of(F.col("text")).alias("w")))).alias("cues"))
    flat = heard.select(key, F.flatten(F.transform("cues", lambda c: c["w"])).alias("stream"), F.flatten(F.transform("cues", lambda c: F.transform(c["w"], lambda _: F.struct(c["start_s"].alias("a"), c["end_s"].alias("b"))))).alias("clock"))
    both = said.join(flat, key)

    def step(state: Column, turn: Column) -> Column:
        at = state["at"]
        end = _best_end(turn["w"], at, F.col("stream"), band, tail)
        made = F.struct(turn["speaker"].alias("speaker"), F.get("clock", at)["a"].alias("start_s"), F.get("clock", end - 1)["b"].alias("end_s"), F.size(turn["w"]).alias("words"))
        moved = F.struct(end.cast("int").alias("at"), F.concat(state["out"], F.array(made)).alias("out"))
        return F.when((F.size(turn["w"]) == 0) | (at >= F.size("stream")), state).otherwise(moved)

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_TURN}>").alias("out"))
    folded = both.select(key, F.aggregate("turns", start, step)["out"].alias("out"))
    return folded.select(key, F.posexplode("out").alias("turn_no", "t")).select(key, "turn_no", "t.*")
