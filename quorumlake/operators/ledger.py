"""Ledgers: several groupings in one pass, pivots over versions, tie-outs, peers and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def groupings(df: DataFrame, sets: list[list[str]], value: Column, name: str) -> DataFrame:
    """Sums of the value for each set of columns, in one pass; ``grouping`` tells which columns are summed over."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return grouped.agg(F.round(F.sum(value), 2).alias(name), F.grouping_id().cast("bigint").alias("grouping"))


def versions(df: DataFrame, key: list[str], version: str, names: list, value: Column) -> DataFrame:
    """One row a key with a column of sums for each version; summed raw and rounded once."""
    return df.groupBy(*key).pivot(version, names).agg(F.round(F.sum(value), 2).cast("double"))


def with_parent(nodes: DataFrame, id_: str, parent: str, label: str) -> DataFrame:
    up = nodes.select(F.col(id_).alias(parent), F.col(label).alias("parent_label"))
    return nodes.join(up, parent, "left")


def tie_out(actual: DataFrame, printed: DataFrame, key: str, tolerance: float) -> DataFrame:
    """Printed figures that the computed ones miss by more than the tolerance; all misses, not the first."""
    both = printed.select(key, F.col("value").alias("printed")).join(actual.select(key, F.col("value").alias("computed")), key, "left")
    return both.where(F.col("computed").isNull() | (F.abs(F.col("computed") - F.col("printed")) > tolerance))


def nearest(df: DataFrame, value: str, name: str, target: float, most: int) -> DataFrame:
    """The ``most`` rows whose value is nearest to the target, ties by name."""
    gap = F.abs(F.col(value) - target)
    top = df.withColumn("gap", gap).orderBy("gap", name).limit(most)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("gap", name)))  # ``most`` rows


def competition_rank(df: DataFrame, key: str, value: str) -> DataFrame:
    """1 + the number of greater values of the key."""
    return df.withColumn("rank", F.rank().over(Window.partitionBy(key).orderBy(F.desc(value))))


def leave_one_out_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Adds the mean of the other rows of the key; null for a row by itself."""
    w = Window.partitionBy(key)
    return df.withColumn("peers_mean", F.try_divide(F.sum(value).over(w) - F.col(value), F.count(value).over(w) - 1))


def project(spark, base: dict, first: int, last: int, scenario: dict, additions: dict[int, float] | None = None, adjustments: list[dict] | None = None) -> DataFrame:
    """The yearly recurrence of a levy: value, rate, revenue, other income, spending, gap and their running sum.

    base: value, rate, certified (or None), collection, appreciation, growth, other, other_growth, spending,
    spending_growth.  scenario: method ("certified" or "fixed_rate"), step (above the certified rate), rates (overrides by year).  additions: new value by
    year.  adjustments: year, amount, side ("revenue" or "spending"), recurring.  A recursive query carries the state.
    """
    additions, adjustments = additions or {}, adjustments or []
    of = lambda y, side, recurring: sum(a["amount"] for a in adjustments if a["year"] == y and a["side"] == side and bool(a["recurring"]) == recurring)
    rows = [
        (y, float(additions.get(y, 0.0)), scenario.get("rates", {}).get(y), float(of(y, "revenue", True)), float(of(y, "spending", True)), float(of(y, "revenue", False)), float(of(y, "spending", False)))
        for y in range(first, last + 1)
    ]
    years = spark.createDataFrame(rows, "year int, addition double, rate_override double, rev_add double, exp_add double, rev_once double, exp_once double")
    b, fixed = base, scenario["method"] == "fixed_rate"
    rate = f"{b['rate']}D" if fixed else f"coalesce(y.rate_override, (p.revenue / (p.value * {1 + b['appreciation']}D * {b['collection']}D)) * {1 + scenario.get('step', 0.0)}D)"
    value = f"p.value * {1 + b['appreciation']}D + p.value * {b['growth']}D + y.addition"
    return spark.sql(f"""
        WITH RECURSIVE p AS (
          SELECT y.year, {b['value']}D AS value, {b['rate']}D AS rate, {b['value']}D * {b['rate']}D * {b['collection']}D AS revenue,
                 {b['other']}D + y.rev_add AS other, {b['spending']}D + y.exp_add AS spending, y.rev_once, y.exp_once
          FROM {{years}} y WHERE y.year = {first}
          UNION ALL
          SELECT y.year, {value}, {rate}, ({value}) * ({rate}) * {b['collection']}D,
                 p.other * {1 + b['other_growth']}D + y.rev_add, p.spending * {1 + b['spending_growth']}D + y.exp_add, y.rev_once, y.exp_once
          FROM p JOIN {{years}} y ON y.year = p.year + 1)
        SELECT year, value, rate, revenue, other + rev_once AS other, spending + exp_once AS spending,
               revenue + other + rev_once - spending - exp_once AS gap,
               sum(revenue + other + rev_once - spending - exp_once) OVER (ORDER BY year) AS cumulative
        FROM p""", years=years)


# The fields of a projection's baseline, and what a growth is called.
BASE_FIELDS = ("taxable_value", "collection_rate", "appreciation_rate", "new_growth_rate", "other_revenue", "other_revenue_growth", "expenditures", "expenditure_growth")
GROWTHS = {"appreciation_rate": "Taxable-value growth", "new_growth_rate": "New growth", "other_revenue_growth": "Other-revenue growth", "expenditure_growth": "Expenditure growth"}


def finite(x: Column) -> Column:
    """The number if it is one, else null."""
    d = x.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def read_baseline(configs: DataFrame, field: str, value: str, overrides: DataFrame | None = None, key: str = "config") -> DataFrame:
    """(key, field, value): fields of each baseline as numbers, a finite override in place of the own.

    configs: (key, field, value), value being a number or JSON with a member ``value``; overrides: (key, field, value).
    """
    own = F.coalesce(F.get_json_object(value, "$.value"), F.col(value))
    rows = configs.select(key, F.col(field).alias("field"), finite(own).alias("value"))
    if overrides is not None:
        more = overrides.select(key, F.col(field).alias("field"), finite(F.col(value)).alias("__o"))
        rows = rows.join(more, [key, "field"], "full_outer").select(key, "field", F.coalesce("__o", "value").alias("value"))
    return rows


def problems(configs: DataFrame) -> DataFrame:
    """``configs`` with ``errors`` and ``warnings``, arrays of (field, message): why a projection cannot be trusted, or may look odd.

    configs: one row each with BASE_FIELDS, first_year, last_year, start_rate (null without a scenario: has_scenario) as columns.
    """
    c = F.col
    of = lambda field, bad, text: F.when(bad, F.struct(F.lit(field).alias("field"), (text if isinstance(text, Column) else F.lit(text)).alias("message")))
    bad = lambda field, wrong: finite(c(field)).isNull() | wrong
    first, last = c("first_year"), c("last_year")
    errors = [
        of("years", first.isNull() | last.isNull(), "The projection period is missing or not a pair of whole years."),
        of("years", last < first, F.format_string("The projection period ends (%d) before it begins (%d).", last, first)),
        of("years", last - first > 30, "The projection period is longer than 30 years, which this model is not built for."),
        of("scenario", ~c("has_scenario"), "No scenario with that id exists in the configuration."),
        of("taxable_value", bad("taxable_value", c("taxable_value") <= 0), "Taxable assessed value must be a positive number."),
        of("collection_rate", bad("collection_rate", (c("collection_rate") <= 0) | (c("collection_rate") > 1)), "The collection rate must be greater than 0 and no more than 1 (100%)."),
        of("other_revenue", bad("other_revenue", c("other_revenue") < 0), "Other city revenue must be zero or a positive number."),
        of("expenditures", bad("expenditures", c("expenditures") <= 0), "Baseline operating expenditure must be a positive number."),
    ]
    warnings = []
    for field, name in GROWTHS.items():
        share = F.format_string("%.1f", c(field) * 100)
        errors.append(of(field, finite(c(field)).isNull(), f"{name} must be a number."))
        errors.append(of(field, c(field) <= -1, F.concat(F.lit(f"{name} of "), share, F.lit("% would wipe out the base in a single year."))))
        warnings.append(of(field, (c(field) > -1) & ((c(field) < -0.25) | (c(field) > 0.5)), F.concat(F.lit(f"{name} is set to "), share, F.lit("% a year, which is far outside anything in the record."))))
    errors.append(of("start_rate", c("has_scenario") & bad("start_rate", c("start_rate") <= 0), "The scenario's starting rate must be a positive number."))
    warnings.append(of("start_rate", c("has_scenario") & (c("start_rate") > 0.05), "The starting rate is above 0.05, which is not a plausible city levy."))
    told = lambda xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    return configs.withColumns({"errors": told(errors), "warnings": told(warnings)})


def summary(projected: DataFrame, key: list[str]) -> DataFrame:
    """Of each projection the first and last year, years in deficit, the worst year and gap, the last running sum, and the rate
    that would close the last year's gap (null without one)."""
    last = lambda x: F.max_by(x, "year")
    closing = F.when((last("gap") < 0) & (last("value") > 0), last("rate") - last("gap") / last("value"))
    return projected.groupBy(*key).agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count_if(F.col("gap") < 0).alias("deficit_years"), F.min_by("year", F.struct("gap", "year")).alias("worst_year"),
        F.min("gap").alias("worst_gap"), last("cumulative").alias("cumulative"), closing.alias("closing_rate"),
    )


def above_certified(rate: Column, certified: Column) -> Column:
    """How far a rate lies above the certified one; null where either is missing or 0."""
    return F.when((rate != 0) & (certified != 0), rate / certified - 1)


def additions_by_year(additions: DataFrame, mode: str) -> DataFrame:
    """(year, amount) of new value: mode "full" takes all, "partial" what is free of incentives, "none" nothing."""
    kept = {"full": F.lit(True), "partial": F.coalesce("incentive_free", F.lit(False)), "none": F.lit(False)}[mode]
    return additions.where(kept).groupBy("year").agg(F.sum("amount").alias("amount"))


def mapped(df: DataFrame, name: str, mapping: DataFrame, value: Column) -> DataFrame:
    """(area, total) by a mapping (name, area) of names to areas; a name with a total but no area is an error, never a row of its own."""
    sums = df.groupBy(name).agg(F.sum(value).alias("total"))
    joined = sums.join(mapping.select(F.col("name").alias(name), "area"), name, "left")
    checked = F.when(F.col("area").isNull() & (F.col("total") != 0), F.raise_error(F.concat(F.lit("no area for "), F.coalesce(name, F.lit("null"))))).otherwise(F.col("area"))
    return joined.withColumn("area", checked.cast("string")).where("area IS NOT NULL").groupBy("area").agg(F.sum("total").alias("total"))


def pooled(df: DataFrame, name: str, fund: str, group: str, value: Column) -> DataFrame:
    """(name, total, groups, funds): one row a department over all funds, with its different groups and its funds by falling total."""
    by_fund = df.groupBy(name, fund).agg(F.sum(value).alias("total"), F.collect_set(F.nullif(F.col(group), F.lit(""))).alias("groups"))
    return by_fund.groupBy(name).agg(
        F.sum("total").alias("total"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("groups")))).alias("groups"),
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("k"), F.col(fund).alias("name")))), lambda x: F.struct(x["name"], (-x["k"]).alias("total"))).alias("funds"),
    )


def line_total(df: DataFrame, account: str, number: str, value: Column) -> DataFrame:
    """The total of one account line; a line that is missing is an error."""
    rows = df.where(F.col(account) == number).agg(F.sum(F.coalesce(value, F.lit(0))).alias("total"), F.count(F.lit(1)).alias("n"))
    return rows.select(F.when(F.col("n") == 0, F.raise_error(F.lit(f"no line {number}")).cast("double")).otherwise(F.col("total")).alias("total"))


def in_printed_order(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """``df`` with ``place``: the place of the name in the printed order, names not in it after all others."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(name))
    return df.withColumn("place", F.when(place > 0, place).otherwise(len(order) + 1).cast("int"))


def deltas(df: DataFrame, name: str, before: str, after: str) -> DataFrame:
    """(name, before, after, change, place) of lines that changed, by the size of the change; the lines of one book."""
    rows = df.where(F.col(before) != F.col(after)).withColumn("change", F.round(F.col(after) - F.col(before), 2))
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.abs("change")), name)))


def largest(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows in the order, with ``place``."""
    return df.orderBy(*order).limit(most).withColumn("place", F.row_number().over(Window.orderBy(*order)))  # ``most`` rows


def regrouped(df: DataFrame, key: list[str], old: str, new: Column, value: Column) -> DataFrame:
    """(key, old_total, new_total, old_groups, new_groups): totals and numbers of groups by an old and a new grouping."""
    both = df.groupBy(*key, old, new.alias("__new")).agg(F.sum(value).alias("__v"))
    return both.groupBy(*key).agg(*(F.round(F.sum("__v"), 2).alias(n) for n in ("old_total", "new_total")), F.count_distinct(old).alias("old_groups"), F.count_distinct("__new").alias("new_groups"))
