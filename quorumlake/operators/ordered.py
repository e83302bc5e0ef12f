"""Steps over ordered rows that do not put a whole key in one task.

The rows of a key are dealt out to chunks, by an expression that never falls as the order rises (a day of a time, a line number
divided by some thousands).  A step works in each chunk by a window; what one chunk hands to the next goes through a
table of one row a chunk.  So a key that holds a third of all rows is spread over as many tasks as it has chunks.  A null
key is a key like others; a null chunk comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _dealt(df: DataFrame, key: str, chunk: Column) -> DataFrame:
    """``df`` with ``__g``, the key and chunk of a row as one struct, which is never null and equal where its parts are."""
    return df.withColumn("__g", F.struct(F.col(key).alias("k"), chunk.alias("c")))


def _ends(rows: DataFrame, *sums: Column) -> DataFrame:
    return rows.groupBy("__g").agg(*sums)


def _within(order: list[str]):
    return Window.partitionBy("__g").orderBy(*order)


def _chunks():
    return Window.partitionBy("__g.k").orderBy("__g.c")


def _earlier():
    return _chunks().rowsBetween(Window.unboundedPreceding, -1)


def carried(df: DataFrame, key: str, chunk: Column, order: list[str], fill: dict[str, str]) -> DataFrame:
    """Adds for each new: old of ``fill`` the last value of old that is not null at or before the row."""
    rows = _dealt(df, key, chunk)
    upto = _within(order).rowsBetween(Window.unboundedPreceding, 0)
    at = F.struct(*order)
    local = rows.withColumns({new: F.last(old, ignorenulls=True).over(upto) for new, old in fill.items()})
    ends = _ends(rows, *(F.max_by(F.col(old), F.when(F.col(old).isNotNull(), at)).alias(f"__e_{new}") for new, old in fill.items()))
    ends = ends.select("__g", *(F.last(f"__e_{new}", ignorenulls=True).over(_earlier()).alias(f"__e_{new}") for new in fill))
    return local.join(ends, "__g").withColumns({new: F.coalesce(F.col(new), F.col(f"__e_{new}")) for new in fill}).drop("__g", *(f"__e_{new}" for new in fill))


def with_previous(df: DataFrame, key: str, chunk: Column, order: list[str], previous: dict[str, str]) -> DataFrame:
    """Adds for each new: old of ``previous`` the value of old in the row before, null in the first row of a key."""
    rows = _dealt(df, key, chunk)
    within, at = _within(order), F.struct(*order)
    first = F.row_number().over(within) == 1
    local = rows.withColumns({"__first": first, **{new: F.lag(old).over(within) for new, old in previous.items()}})
    last = _ends(rows, F.max_by(F.struct(*[F.col(old).alias(new) for new, old in previous.items()]), at).alias("__tail"))
    ends = last.select("__g", F.lag("__tail").over(_chunks()).alias("__before"))
    joined = local.join(ends, "__g")
    return joined.withColumns({new: F.when(F.col("__first"), F.col("__before")[new]).otherwise(F.col(new)) for new in previous}).drop("__g", "__first", "__before")


def running_sum(df: DataFrame, key: str, chunk: Column, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of the values up to the row."""
    rows = _dealt(df, key, chunk)
    local = rows.withColumn(name, F.sum(value).over(_within(order).rowsBetween(Window.unboundedPreceding, 0)))
    ends = _ends(rows, F.sum(value).alias("__s")).select("__g", F.sum("__s").over(_earlier()).alias("__base"))
    joined = local.join(ends, "__g")
    both = F.coalesce(F.col(name) + F.col("__base"), F.col(name), F.col("__base"))  # of a stretch of nulls the sum is what came before
    return joined.withColumn(name, both).drop("__g", "__base")


def segments(df: DataFrame, key: str, chunk: Column, order: list[str], values: list[str], opens, name: str) -> DataFrame:
    """Adds ``name``: the number, from 1, of the segment in which a row stands.

    opens(before, row) says whether a row opens a segment, from structs of ``values`` of the row before and its own; the first
    row of a key always does.  One window in each chunk; the chunk table says whether a chunk's first row opens one.
    """
    within, at = _within(order), F.struct(*order)
    rows = _dealt(df, key, chunk).withColumn("__v", F.struct(*values))
    before = F.lag("__v").over(within)
    local = rows.withColumn("__b", before).withColumn("__n", F.when(F.col("__b").isNull(), 0).otherwise(opens(F.col("__b"), F.col("__v")).cast("int")))
    local = local.withColumn("__s", F.sum("__n").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    ends = _ends(local, F.min_by("__v", at).alias("__head"), F.max_by("__v", at).alias("__tail"), F.sum("__n").alias("__inside"))
    last = F.lag("__tail").over(_chunks())
    ends = ends.withColumn("__first", F.when(last.isNull(), 1).otherwise(opens(last, F.col("__head")).cast("int")))
    base = F.sum(F.col("__first") + F.col("__inside")).over(_chunks().rowsBetween(Window.unboundedPreceding, 0)) - F.col("__inside")
    joined = local.join(ends.select("__g", base.alias("__base")), "__g")
    return joined.withColumn(name, F.col("__base") + F.col("__s")).drop("__g", "__v", "__b", "__n", "__s", "__base")


def run_numbers(df: DataFrame, key: str, chunk: Column, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the number, from 1, of the run of equal values (null equals null) in which a row stands."""
    return segments(df, key, chunk, order, [value], lambda before, row: ~before[value].eqNullSafe(row[value]), name)


def numbered(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Adds ``name``: the place of a row in the order of all rows, from 1; the order must tell rows apart.

    Rows are dealt out to ranges, written once so that every use sees the same ranges, and numbered from the count of the
    ranges before; only one row a range goes through one task.
    """
    from quorumlake.io import cut

    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, *order).withColumn("__chunk", F.spark_partition_id()))
    counts = ranged.groupBy("__chunk").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__chunk", (F.sum("__n").over(Window.orderBy("__chunk")) - F.col("__n")).alias("__before"))  # a row a range
    local = ranged.withColumn(name, F.row_number().over(Window.partitionBy("__chunk").orderBy(*order)))
    return local.join(before, "__chunk").withColumn(name, F.col(name) + F.col("__before")).drop("__chunk", "__before")
