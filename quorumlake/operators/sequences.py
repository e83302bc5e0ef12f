"""Ordered operators: runs, fills, as-of joins, gaps, passages and windows over sentences.

Those that take ``chunk`` work in chunks of a key (see ``ordered``), so that a hot key is spread over tasks; without it a key
is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.functions import text as T
from quorumlake.operators import ordered as O

def _all(chunk: Column | None) -> Column:
    return F.lit(0) if chunk is None else chunk


def drop_repeats(df: DataFrame, key: str, order: list[str], value: str, chunk: Column | None = None) -> DataFrame:
    """Rows without those whose value equals that of the row before; blank values are never dropped."""
    placed = O.with_previous(df, key, _all(chunk), order, {"__b": value})
    return placed.where(F.col("__b").isNull() | F.col(value).isNull() | (F.trim(F.col(value)) == "") | (F.col("__b") != F.col(value))).drop("__b")


def islands(df: DataFrame, key: str, order: list[str], value: str, name: str = "island", chunk: Column | None = None) -> DataFrame:
    """Numbers the runs of equal values; a null value goes on with the run before it."""
    c = _all(chunk)
    filled = O.carried(df, key, c, order, {"__f": value}).withColumn(value, F.col("__f")).drop("__f")
    return O.run_numbers(filled, key, c, order, value, name)


def forward_fill(df: DataFrame, key: str, order: list[str], value: str, name: str, chunk: Column | None = None) -> DataFrame:
    return O.carried(df, key, _all(chunk), order, {name: value})


def asof(left: DataFrame, right: DataFrame, key: str, time: str, value: str, name: str, chunk: Column | None = None) -> DataFrame:
    """Each left row with the value of the latest right row of its key at or before it.

    A union and a running last value: no pairs.
    """
    both = left.withColumn("__side", F.lit(1)).withColumn("__v", F.lit(None).cast(right.schema[value].dataType)).unionByName(
        right.select(key, time, F.struct(F.col(value)).alias("__x")).select(key, time, F.lit(0).alias("__side"), F.col("__x").getField(value).alias("__v")), allowMissingColumns=True
    )
    return O.carried(both, key, _all(chunk), [time, "__side"], {name: "__v"}).where("__side = 1").drop("__side", "__v")


def sessions(df: DataFrame, key: str, time: str, gap_seconds: int, chunk: Column | None = None, tie: str | None = None) -> DataFrame:
    """Adds ``session``: a new one after a pause of more than the gap.  Rows of one time are told apart by ``tie``."""
    micros = lambda x: F.unix_micros(x[time].cast("timestamp"))
    pause = lambda before, row: F.coalesce(micros(row) - micros(before) > gap_seconds * 1_000_000, F.lit(True))
    return O.segments(df, key, _all(chunk), [time, *([tie] if tie else [])], [time], pause, "session")


def crossings(df: DataFrame, order: str, value: str, key: str | None = None, chunk: Column | None = None) -> DataFrame:
    """(from, to, fraction, into_deficit[, key]) where the value changes its sign between neighbours."""
    rows = df.withColumn("__key", F.col(key) if key else F.lit(0))
    pairs = O.with_previous(rows, "__key", _all(chunk), [order], {"from": order, "__a": value})
    a, b = F.col("__a"), F.col(value)
    found = pairs.where((a != 0) & (b != 0) & (F.signum(a) != F.signum(b)))
    return found.select("from", F.col(order).alias("to"), (a / (a - b)).alias("fraction"), (b < 0).alias("into_deficit"), *([key] if key else []))


def passages(texts: DataFrame, key: str, text: str, size: int = 230, overlap: int = 40, least: int = 60) -> DataFrame:
    """(key, passage_no, passage): windows of ``size`` words that overlap; passages under ``least`` characters are left out."""
    words = F.filter(F.split(T.clean(F.col(text)), " "), lambda w: w != "")
    rows = texts.select(key, words.alias("__w")).where(F.size("__w") > 0)
    starts = F.sequence(F.lit(0), F.size("__w") - 1, F.lit(size - overlap))
    cut = rows.select(key, F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice("__w", i + 1, F.lit(size)), " "))).alias("passage_no", "passage"))
    return cut.where(F.length("passage") >= least)


def sentence_windows(texts: DataFrame, key: str, text: str, marker: str) -> DataFrame:
    """(key, sentence_no, passage, near) around each sentence that has the marker: one before to two after it, and it with the next."""
    rows = texts.select(key, T.sentences(F.col(text)).alias("__s")).where(F.size("__s") > 0)
    found = rows.select(key, "__s", F.posexplode(F.transform("__s", lambda s: F.lower(s).rlike(marker))).alias("sentence_no", "__hit")).where("__hit")
    first = F.greatest(F.col("sentence_no"), F.lit(1))
    return found.select(key, "sentence_no", F.array_join(F.slice("__s", first, F.col("sentence_no") + 4 - first), " ").alias("passage"), F.array_join(F.slice("__s", F.col("sentence_no") + 1, F.lit(2)), " ").alias("near"))


def running_total(df: DataFrame, order: str, value: str, name: str, key: str | None = None, chunk: Column | None = None) -> DataFrame:
    rows = df.withColumn("__key", F.col(key) if key else F.lit(0))
    return O.running_sum(rows, "__key", _all(chunk), [order], value, name).drop("__key")


def rate_limited(df: DataFrame, key: str, time: str, seconds: int, most: int) -> DataFrame:
    """Adds ``in_window`` (rows of the key in the last ``seconds``, itself included) and ``limited``.

    A key is cut into stretches of 16 windows; the rows of the last window before a stretch are counted with it and left out
    again, so a hot key is spread and each row is copied once at most.
    """
    micros = seconds * 1_000_000
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = df.withColumn("__at", at).withColumn("__own", F.floor(F.col("__at") / (16 * micros)))
    places = F.when(F.col("__at") >= (F.col("__own") + 1) * 16 * micros - micros, F.array(F.col("__own"), F.col("__own") + 1)).otherwise(F.array("__own"))
    spread = rows.withColumn("__stretch", F.explode(places))
    w = Window.partitionBy(key, "__stretch").orderBy("__at").rangeBetween(-micros, 0)
    counted = spread.withColumn("in_window", F.count(F.lit(1)).over(w)).where(F.col("__stretch").eqNullSafe(F.col("__own")))
    return counted.withColumn("limited", F.col("in_window") > most).drop("__at", "__own", "__stretch")


def top_with_other(df: DataFrame, key: str, label: str, value: str, most: int) -> DataFrame:
    """(key, label, value, rank, n): of each key the largest values by size, the rest as one row "Other".

    Ranks are taken of the first ``most`` only, which Spark cuts to before it shuffles; the rest of a key is what lies beyond
    its last ranked row, and is summed in parts.  Rows like the last ranked one in size and label count with the rest.
    """
    size = (-F.abs(F.col(value))).alias("s")
    w = Window.partitionBy(key).orderBy(F.desc(F.abs(F.col(value))), label)
    ranked = df.select(key, label, value, F.row_number().over(w).alias("rank")).where(F.col("rank") <= most)
    ends = ranked.groupBy(F.col(key).alias("__k")).agg(F.max(F.struct(size, F.col(label).alias("l"))).alias("__end"), F.sum(value).alias("__sum"), F.count(F.lit(1)).alias("__n"))
    whole = df.groupBy(key).agg(F.count(F.lit(1)).alias("__all")).join(ends, F.col(key).eqNullSafe(F.col("__k"))).where("__all > __n").select("__k", "__end", "__n")
    beyond = df.select(key, label, value, F.struct(size, F.col(label).alias("l")).alias("__at")).join(whole, F.col(key).eqNullSafe(F.col("__k")))
    level = beyond.groupBy(key, "__n").agg(
        F.sum(F.when(F.col("__at") > F.col("__end"), F.col(value))).alias("more"), F.count_if(F.col("__at") > F.col("__end")).alias("n"), F.count_if(F.col("__at") <= F.col("__end")).alias("upto"), F.max(F.when(F.col("__at") == F.col("__end"), F.col(value))).alias("same")
    )
    twins = F.col("upto") - F.col("__n")
    rest = level.select(key, F.lit("Other").alias(label), (F.coalesce("more", F.lit(0.0)) + F.when(twins > 0, twins * F.col("same")).otherwise(0.0)).alias(value), F.lit(most + 1).alias("rank"), (F.col("n") + twins).alias("n"))
    return ranked.select(key, label, value, "rank", F.lit(1).cast("bigint").alias("n")).unionByName(rest)


def first_per_key(df: DataFrame, key: list[str], order: list[Column], most: int = 1) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= most).drop("__r")


def longest_per_bucket(turns: DataFrame, key: str, buckets: int = 14, usable: float = 4.0, trim: float = 0.4, longest: float = 12.0) -> DataFrame:
    """(key, start, duration): the longest usable turn of each of equal stretches of time, topped up by the longest of the rest.

    turns: (key, start, end).  Of equally long ones the earliest counts.  The ends are trimmed and the length capped.
    """
    rows = turns.withColumn("duration", F.col("end") - F.col("start")).where(F.col("duration") >= usable)
    spans = rows.groupBy(F.col(key).alias("__k")).agg(F.min("start").alias("__s"), F.greatest(F.max("end") - F.min("start"), F.lit(1.0)).alias("__len"))
    bucket = F.least(F.lit(buckets - 1), F.floor((F.col("start") - F.col("__s")) / F.col("__len") * buckets))
    placed = rows.join(spans, rows[key].eqNullSafe(spans["__k"])).withColumn("__b", bucket).select(key, "start", "duration", "__b")
    longest_first = [F.desc("duration"), F.col("start")]
    best = first_per_key(placed, [key, "__b"], longest_first).withColumn("__top", F.lit(1))
    # of the longest 2k of a key no more than k are the first of their stretch, so k of the rest are among them
    rest = first_per_key(placed, [key], longest_first, 2 * buckets).withColumn("__top", F.lit(0))
    pool = best.unionByName(rest).groupBy(key, "start", "duration").agg(F.max("__top").alias("__top"))
    chosen = first_per_key(pool, [key], [F.desc("__top"), *longest_first], buckets)
    cut = chosen.select(key, F.round(F.col("start") + trim, 3).alias("start"), F.round(F.least(F.col("duration") - 2 * trim, F.lit(longest)), 3).alias("duration"))
    return cut.where(F.col("duration") >= 3.2)
