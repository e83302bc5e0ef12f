"""Set and join operators: pairs over keys, cascades, overrides, audits and bag equality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair(now: DataFrame, prior: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, now, prior, change) over the union of the keys, a missing side taken as 0; rows of two zeros left out."""
    a, b = now.select(*key, F.col(value).alias("now")), prior.select(*key, F.col(value).alias("prior"))
    both = a.join(b, key, "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("now", "prior")})
    return both.where("now <> 0 OR prior <> 0").withColumn("change", F.col("now") - F.col("prior"))


def cascade(key: str, *sources: DataFrame) -> DataFrame:
    """Rows of the first source, then those of each next whose key none before has; ``rank`` tells the source."""
    out, seen = [], None
    for n, s in enumerate(sources):
        fresh = s if seen is None else s.join(seen, key, "left_anti")
        out.append(fresh.withColumn("rank", F.lit(n)))
        keys = s.select(key).distinct()
        seen = keys if seen is None else seen.union(keys).distinct()
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)


def override(base: DataFrame, over: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``over`` and those of ``base`` whose key it lacks."""
    return over.unionByName(base.join(over.select(*key).distinct(), key, "left_anti"))


def newest_wins(newer: DataFrame, older: DataFrame, key: list[str], value: str) -> DataFrame:
    a, b = newer.select(*key, F.col(value).alias("__a")), older.select(*key, F.col(value).alias("__b"))
    return a.join(b, key, "full_outer").select(*key, F.coalesce("__a", "__b").alias(value))


def audit(expected: DataFrame, used: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """(key, problem): expected but neither used nor excluded; used but not expected; excluded and used."""
    e, u, x = (d.select(key).distinct() for d in (expected, used, excluded))
    return (
        e.join(u, key, "left_anti").join(x, key, "left_anti").withColumn("problem", F.lit("left out"))
        .unionByName(u.join(e, key, "left_anti").withColumn("problem", F.lit("outside the rule")))
        .unionByName(x.join(u, key, "left_semi").withColumn("problem", F.lit("excluded but used")))
    )


def bag_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of one bag that the other has not as often, with their number on either side; empty if the bags are equal.

    One aggregate over both instead of two subtractions.
    """
    columns = old.columns
    both = old.withColumn("__s", F.lit(1)).unionByName(new.withColumn("__s", F.lit(0)))
    counts = both.groupBy(*columns).agg(F.sum("__s").alias("in_old"), F.sum(1 - F.col("__s")).alias("in_new"))
    return counts.where("in_old <> in_new")


def changes(old: DataFrame, new: DataFrame, key: str, content: str) -> DataFrame:
    """(key, state): new, changed, same or orphan, by the hash of the content."""
    a = old.select(key, F.sha2(F.col(content), 256).alias("__old"), F.lit(True).alias("__in_old"))
    b = new.select(key, F.sha2(F.col(content), 256).alias("__new"), F.lit(True).alias("__in_new"))
    state = F.when(F.col("__in_old").isNull(), "new").when(F.col("__in_new").isNull(), "orphan").when(F.col("__old").eqNullSafe(F.col("__new")), "same").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def holding(rows: DataFrame, terms: DataFrame, date: str) -> DataFrame:
    """Rows with every term (start, end, open where null) that contains their date.

    Terms are a dimension; Spark broadcasts them if they are small enough and else joins by year, as every term is
    spread over its years first.
    """
    first, last = F.coalesce(F.year(F.to_date("start")), F.lit(1900)), F.coalesce(F.year(F.to_date("end")), F.lit(2100))
    spread = terms.withColumn("__year", F.explode(F.sequence(first, last)))
    return rows.withColumn("__year", F.year(F.to_date(date))).join(spread, "__year").where(
        (F.col("start").isNull() | (F.col(date) >= F.col("start"))) & (F.col("end").isNull() | (F.col(date) <= F.col("end")))
    ).drop("__year")


def shown_names(rows: DataFrame, people: DataFrame, id_: str, name: str) -> DataFrame:
    """``rows`` with ``shown``: the name of the id, else the id, else Unknown; a name that two ids bear has the id beside it."""
    one = people.groupBy(id_).agg(F.min(name).alias("__n"))
    shared = one.groupBy("__n").agg(F.count(F.lit(1)).alias("__k"))
    named = one.join(shared, "__n").select(id_, F.when(F.col("__k") > 1, F.concat("__n", F.lit(" ("), F.col(id_).cast("string"), F.lit(")"))).otherwise(F.col("__n")).alias("__s"))
    return rows.join(named, id_, "left").withColumn("shown", F.coalesce("__s", F.col(id_).cast("string"), F.lit("Unknown"))).drop("__s")
