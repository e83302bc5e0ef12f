"""Staff by function, measures by head of the population, and costs over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions by the words of a department's label, the first that fits.
FUNCTIONS = [
    ("public_safety", "police|officer|dispatch|fire\\b|firefight|emt|ambulance|animal|crossing guard|emergency service|ordinance enforcement|^civilians$|^support staff$"),
    ("library", "library|literacy"),
    ("parks_rec", "parks|recreation|cemetery|senior|community event|fitness|golf|boat harbor|open space|trail"),
    ("utilities", "water|sewer|wastewater|storm|solid waste|power|electric|fiber|broadband|irrigation|utility|environmental health|garbage|refuse"),
    ("community_dev", "planning|zoning|building|economic development|code enforcement|community development|development services"),
    ("public_works", "street|road|engineer|fleet|facilit|shop|public works|central garage|public infrastructure|highway|lighting"),
    ("general_gov", "general government|manager|administrat|executive|finance|treasur|recorder|attorney|legal|human resource|legislative|council|mayor|court|clerk|information|communication|gis|risk management|customer service|public information|non-departmental|energy|management|other"),
]


def function_of(label: Column) -> Column:
    """The function of a department's label, "unmapped" if no word tells."""
    low = F.lower(F.coalesce(label, F.lit("")))
    return F.coalesce(*(F.when(low.rlike(words), name) for name, words in FUNCTIONS), F.lit("unmapped"))


def by_function(departments: DataFrame, key: list[str], label: str, value: Column) -> DataFrame:
    """(key, function, total) of the leaves of schedules, summed raw and rounded once."""
    return departments.groupBy(*key, function_of(F.col(label)).alias("function")).agg(F.round(F.sum(value), 2).alias("total"))


def per_thousand(functions: DataFrame, population: DataFrame, key: list[str]) -> DataFrame:
    """(key, total, excl_public_safety, core, raw_1k, excl_1k, core_1k): staff of a place, without public safety, and without
    utilities as well; and each for a thousand people.  population: (key, people); a place without one has null rates."""
    of = lambda name: F.sum(F.when(F.col("function") == name, F.col("total")).otherwise(0.0))
    sums = functions.groupBy(*key).agg(F.sum("total").alias("__t"), of("public_safety").alias("__p"), of("utilities").alias("__u")).join(population.select(*key, "people"), key, "left")
    shares = {"total": F.col("__t"), "excl_public_safety": F.col("__t") - F.col("__p"), "core": F.col("__t") - F.col("__p") - F.col("__u")}
    rate = lambda x: F.round(F.try_divide(x, F.col("people") / 1000), 3)
    return sums.select(*key, *(F.round(x, 2).alias(n) for n, x in shares.items()), *(rate(x).alias(n) for n, x in zip(("raw_1k", "excl_1k", "core_1k"), shares.values())))


def whole_places(parts: DataFrame, place: str, year: str, value: str) -> DataFrame:
    """(place, year, value): places that lie in several counties are several rows, which are added up."""
    return parts.groupBy(F.trim(place).alias(place), year).agg(F.sum(F.col(value).try_cast("bigint")).alias(value))


def cost_series(books: DataFrame, kind: str, wanted: str, label: str, value: Column, order: list[str]) -> DataFrame:
    """(place, label, value, change): one kind of cost through the books in their order, with the change from the one before as a share."""
    from pyspark.sql import Window

    from quorumlake.operators.ledger import in_printed_order

    sums = in_printed_order(books.where(F.col(kind) == wanted).groupBy(label).agg(F.sum(value).alias("value")), label, order).where(F.col("place") <= len(order))
    w = Window.orderBy("place")  # one row a book
    return sums.select("place", label, "value", (F.col("value") / F.nullif(F.lag("value").over(w), F.lit(0.0)) - 1).alias("change"))
