"""What is said of turns and of the marks of time in a summary: shares of speakers, coverage, readings of marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USABLE_S, LATE_S = 4.0, 120


def speaker_statistics(turns: DataFrame, key: str, speaker: str, start: str, end: str, usable: float = USABLE_S) -> DataFrame:
    """(key, speaker, turns, usable, seconds, place): turns of each voice, those long enough to cut a slice from, and its rank by seconds."""
    length = F.col(end) - F.col(start)
    sums = turns.groupBy(key, speaker).agg(F.count(F.lit(1)).alias("turns"), F.count_if(length >= usable).alias("usable"), F.sum(length).alias("seconds"))
    return sums.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("seconds"), speaker)))  # the voices of one transcript


def coverage(turns: DataFrame, key: str, name: str, words: str) -> DataFrame:
    """(key, turns, words, named, share, voices): how many of the words have a known voice, and how many voices are known."""
    known = F.col(name).isNotNull()
    sums = turns.groupBy(key).agg(F.count(F.lit(1)).alias("turns"), F.sum(words).alias("words"), F.coalesce(F.sum(F.when(known, F.col(words))), F.lit(0)).alias("named"), F.count_distinct(F.when(known, F.col(name))).alias("voices"))
    return sums.withColumn("share", F.try_divide(F.col("named"), F.col("words")))


def readings(marks: DataFrame, key: str, order: str, mark: str) -> DataFrame:
    """``marks`` with ``two`` (it has two fields), ``as_hours`` and ``as_minutes``: its seconds if two fields are H:MM or MM:SS."""
    part = lambda k: F.get(F.split(mark, ":"), F.lit(k)).try_cast("int")
    three = F.size(F.split(mark, ":")) == 3
    whole = part(0) * 3600 + part(1) * 60 + part(2)
    return marks.withColumns({"two": ~three, "as_hours": F.when(three, whole).otherwise(part(0) * 3600 + part(1) * 60), "as_minutes": F.when(three, whole).otherwise(part(0) * 60 + part(1))})


def scale(marks: DataFrame, lengths: DataFrame, key: str, order: str, mark: str, duration: str) -> DataFrame:
    """(key, scale): how the marks of two fields are to be read, "hm" or "ms"; "hms" where there is none.

    The reading with fewer steps backwards holds; of equal ones that whose last mark of two fields ends nearest to the end of
    the recording, by the ratio.  Without a recording it is "hm".
    """
    w = Window.partitionBy(key).orderBy(order)
    steps = readings(marks, key, order, mark)
    steps = steps.withColumns({f"__{c}": (F.col(c) < F.lag(c).over(w)).cast("int") for c in ("as_hours", "as_minutes")})
    sums = steps.groupBy(key).agg(
        F.bool_or("two").alias("two"), *(F.coalesce(F.sum(f"__{c}"), F.lit(0)).alias(f"back_{c}") for c in ("as_hours", "as_minutes")), *(F.max(F.when(F.col("two"), F.col(c))).alias(f"last_{c}") for c in ("as_hours", "as_minutes"))
    ).join(lengths.select(key, F.col(duration).alias("__d")), key, "left")
    off = lambda c: F.when(F.col(f"last_{c}") > 0, F.abs(F.log(F.col(f"last_{c}") / F.col("__d")))).otherwise(float("inf"))
    hours, minutes = (F.struct(F.col(f"back_{c}").alias("a"), off(c).alias("b")) for c in ("as_hours", "as_minutes"))
    return sums.select(key, F.when(~F.col("two"), "hms").when(F.coalesce("__d", F.lit(0)) == 0, "hm").when(minutes < hours, "ms").otherwise("hm").alias("scale"))


def beyond_recording(marks: DataFrame, lengths: DataFrame, key: str, order: str, label: str, mark: str, duration: str, late: int = LATE_S) -> DataFrame:
    """(key, label, seconds, problem) of marks that lie more than ``late`` seconds after the end of the recording; a summary with
    marks and no recording is one problem with a null label."""
    chosen = scale(marks, lengths, key, order, mark, duration).join(lengths.select(key, F.col(duration).alias("__d")), key, "left")
    read = readings(marks, key, order, mark).join(chosen, key)
    seconds = F.when(F.col("scale") == "ms", F.col("as_minutes")).otherwise(F.col("as_hours"))
    late_rows = read.where(seconds > F.col("__d") + late).select(key, F.col(label).alias("label"), seconds.alias("seconds"), F.lit("after the end of the recording").alias("problem"))
    silent = read.where("__d IS NULL").groupBy(key).agg(F.lit(None).cast("string").alias("label"), F.count(F.lit(1)).cast("int").alias("seconds"), F.lit("no recording to check the marks against").alias("problem"))
    return late_rows.unionByName(silent)
