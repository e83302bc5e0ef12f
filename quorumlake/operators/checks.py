"""Checks that fail a build: each gives the rows that break a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broken(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with ``broken``: the names of the rules, in order.  A rule that is null counts as broken."""
    names = F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())), lambda n: n.isNotNull())
    return df.withColumn("broken", names).where(F.size("broken") > 0)


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dangling(df: DataFrame, column: str, *targets: DataFrame) -> DataFrame:
    """Rows whose reference stands in none of the one-column targets; null references dangle not."""
    known = reduce(lambda a, b: a.union(b), (t.toDF(column) for t in targets)).distinct()
    return df.where(F.col(column).isNotNull()).join(known, column, "left_anti")


def require_empty(df: DataFrame, what: str, shown: int = 20) -> None:
    """An error that shows the first few offending rows."""
    rows = df.limit(shown).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def id_problems(df: DataFrame, id_: str, form: str) -> DataFrame:
    """(id, problem) of ids that are not in the form ("form") or stand more than once ("twice")."""
    counts = df.groupBy(id_).agg(F.count(F.lit(1)).alias("n"))
    problem = F.when(~F.coalesce(F.col(id_).rlike(form), F.lit(False)), "form").when(F.col("n") > 1, "twice")
    return counts.select(id_, problem.alias("problem")).where("problem IS NOT NULL")
