"""Queries over ledgers, projections and staff; books are years of orders, accounts are parts and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.io import table
from quorumlake.operators import ledger as L
from quorumlake.operators import staffing as S
from quorumlake.plans.registry import query

_LINES = "ln AS (SELECT p_brand AS department, p_type AS grp, n_name AS fund, strftime(l_shipdate,'%Y') AS book, l_extendedprice*(1-l_discount) AS amount FROM lineitem JOIN part ON p_partkey=l_partkey JOIN supplier ON s_suppkey=l_suppkey JOIN nation ON n_nationkey=s_nationkey)"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    t = lambda name: table(spark, folder, name)
    rows = t("lineitem").join(t("part"), F.col("p_partkey") == F.col("l_partkey")).join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey")).join(t("nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    return rows.select(F.col("p_brand").alias("department"), F.col("p_type").alias("grp"), F.col("n_name").alias("fund"), F.date_format("l_shipdate", "yyyy").alias("book"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"))


@query(f"WITH {_LINES} SELECT CASE WHEN right(fund,1)<'5' THEN 'north' ELSE 'south' END AS area, round(sum(amount),2) AS total FROM ln GROUP BY 1")
def service_areas(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of funds by the areas they belong to; a fund without an area would be an error."""
    lines = _lines(spark, folder)
    names = table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.when(F.right("n_name", F.lit(1)) < "5", "north").otherwise("south").alias("area"))
    return L.mapped(lines, "fund", names, F.col("amount")).select("area", F.round("total", 2).alias("total"))


@query(f"WITH {_LINES}, f AS (SELECT department, fund, sum(amount) AS t FROM ln GROUP BY 1,2), g AS (SELECT department, list_sort(list(DISTINCT grp)) AS groups FROM ln GROUP BY 1) SELECT f.department, round(sum(t),0) AS total, any_value(groups) AS groups, count(*) AS funds, arg_max(fund, t) AS largest FROM f JOIN g USING(department) GROUP BY 1")
def pooled_departments(spark: SparkSession, folder: str) -> DataFrame:
    pool = L.pooled(_lines(spark, folder), "department", "fund", "grp", F.col("amount"))
    return pool.select("department", F.round("total", 0).alias("total"), "groups", F.size("funds").cast("bigint").alias("funds"), F.get("funds", F.lit(0))["name"].alias("largest"))


@query(f"WITH {_LINES}, b AS (SELECT department, round(sum(amount) FILTER (book='1996'),2) AS adopted, round(sum(amount) FILTER (book='1997'),2) AS amended FROM ln GROUP BY 1) SELECT department, adopted, amended, round(amended-adopted,2) AS change, row_number() OVER (ORDER BY abs(round(amended-adopted,2)) DESC, department)::INT AS place FROM b WHERE adopted<>amended")
def amendments(spark: SparkSession, folder: str) -> DataFrame:
    """What changed from one version of the book to the next, by the size of the change."""
    books = L.versions(_lines(spark, folder).where("book IN ('1996', '1997')"), ["department"], "book", ["1996", "1997"], F.col("amount"))
    return L.deltas(books.select("department", F.col("1996").alias("adopted"), F.col("1997").alias("amended")), "department", "adopted", "amended")


@query(f"WITH {_LINES} SELECT fund, department, round(sum(amount),2) AS total, grouping_id(fund, department)::BIGINT AS level, bool_or(book>='1998') AS active FROM ln GROUP BY ROLLUP(fund, department)")
def nested_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Funds and their departments with totals on each level, and whether a line is still in use."""
    return _lines(spark, folder).rollup("fund", "department").agg(F.round(F.sum("amount"), 2).alias("total"), F.grouping_id().alias("level"), F.bool_or(F.col("book") >= "1998").alias("active"))


@query(f"WITH {_LINES} SELECT round(sum(coalesce(amount,0)),2) AS total FROM ln WHERE department='Brand#11' OR department='Brand#1'")
def account_line(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder).withColumn("department", F.when(F.col("department").isin("Brand#11", "Brand#1"), "11").otherwise(F.col("department")))
    return L.line_total(lines, "department", "11", F.col("amount")).select(F.round("total", 2).alias("total"))


_ORDER = ["Taxes", "AFRICA", "ASIA", "EUROPE"]


@query("SELECT r_name, (CASE r_name WHEN 'AFRICA' THEN 2 WHEN 'ASIA' THEN 3 WHEN 'EUROPE' THEN 4 ELSE 5 END)::INT AS place FROM region")
def printed_order(spark: SparkSession, folder: str) -> DataFrame:
    return L.in_printed_order(table(spark, folder, "region"), "r_name", _ORDER).select("r_name", "place")


@query("SELECT n_name AS fund, s_name AS department, row_number() OVER (ORDER BY active DESC, total DESC, n_name, s_name)::INT AS place FROM (SELECT n_name, s_name, s_acctbal>0 AS active, round(s_acctbal,0) AS total FROM supplier JOIN nation ON n_nationkey=s_nationkey) ORDER BY place LIMIT 40")
def borrowing(spark: SparkSession, folder: str) -> DataFrame:
    """The forty largest lines, active ones first."""
    rows = table(spark, folder, "supplier").join(table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("n_name").alias("fund"), F.col("s_name").alias("department"), (F.col("s_acctbal") > 0).alias("active"), F.round("s_acctbal", 0).alias("total"))
    return L.largest(rows, [F.desc("active"), F.desc("total"), F.col("fund"), F.col("department")], 40).select("fund", "department", "place")


# ---- projections -----------------------------------------------------------------------------------------------------


@query("""SELECT s_suppkey AS config, f AS field, CASE WHEN f='taxable_value' AND s_suppkey%3=0 THEN 500.0::DOUBLE WHEN f='taxable_value' THEN (s_suppkey*10)::DOUBLE WHEN s_suppkey%4=0 THEN NULL ELSE 0.98::DOUBLE END AS value FROM supplier, (VALUES ('taxable_value'),('collection_rate')) t(f)""")
def baselines(spark: SparkSession, folder: str) -> DataFrame:
    """Baseline fields as numbers or objects, with overrides of which only finite ones hold."""
    s = table(spark, folder, "supplier")
    wrapped = F.concat(F.lit('{"value": '), (F.col("s_suppkey") * 10).cast("string"), F.lit(', "confirm": true}'))
    value = s.select(F.col("s_suppkey").alias("config"), F.lit("taxable_value").alias("field"), F.when(F.col("s_suppkey") % 2 == 0, wrapped).otherwise((F.col("s_suppkey") * 10).cast("string")).alias("value"))
    rate = s.select(F.col("s_suppkey").alias("config"), F.lit("collection_rate").alias("field"), F.when(F.col("s_suppkey") % 4 == 0, "n/a").otherwise("0.98").alias("value"))
    over = s.select(F.col("s_suppkey").alias("config"), F.lit("taxable_value").alias("field"), F.when(F.col("s_suppkey") % 3 == 0, "500").when(F.col("s_suppkey") % 3 == 1, "NaN").otherwise("Infinity").alias("value"))
    return L.read_baseline(value.unionByName(rate), "field", "value", over)


@query("""WITH c AS (SELECT s_suppkey AS config, CASE WHEN s_suppkey%5=0 THEN 0 ELSE s_acctbal END AS tv, CASE s_suppkey%4 WHEN 0 THEN 1.5 ELSE 0.98 END AS cr, CASE s_suppkey%6 WHEN 0 THEN -1.0 WHEN 1 THEN 0.6 ELSE 0.03 END AS eg, s_suppkey%7<>0 AS sc, CASE s_suppkey%8 WHEN 0 THEN 0.06 WHEN 1 THEN -0.1 ELSE 0.002 END AS sr, 2027+s_suppkey%3 AS fy, CASE s_suppkey%9 WHEN 0 THEN 2020 WHEN 1 THEN 2070 ELSE 2035 END AS ly FROM supplier)
SELECT config, list_sort(list_filter([CASE WHEN ly<fy THEN 'years: The projection period ends ('||ly||') before it begins ('||fy||').' END, CASE WHEN ly-fy>30 THEN 'years: The projection period is longer than 30 years, which this model is not built for.' END, CASE WHEN NOT sc THEN 'scenario: No scenario with that id exists in the configuration.' END, CASE WHEN tv<=0 THEN 'taxable_value: Taxable assessed value must be a positive number.' END,
 CASE WHEN cr>1 THEN 'collection_rate: The collection rate must be greater than 0 and no more than 1 (100%).' END, CASE WHEN eg<=-1 THEN 'expenditure_growth: Expenditure growth of -100.0% would wipe out the base in a single year.' END, CASE WHEN sc AND sr<=0 THEN 'start_rate: The scenario''s starting rate must be a positive number.' END], lambda x: x IS NOT NULL)) AS errors,
 list_sort(list_filter([CASE WHEN eg=0.6 THEN 'expenditure_growth: Expenditure growth is set to 60.0% a year, which is far outside anything in the record.' END, CASE WHEN sc AND sr>0.05 THEN 'start_rate: The starting rate is above 0.05, which is not a plausible city levy.' END], lambda x: x IS NOT NULL)) AS warnings FROM c""")
def validations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    of = lambda n, *cases: _case(key % n, *cases)
    configs = table(spark, folder, "supplier").select(
        key.alias("config"), F.when(key % 5 == 0, 0.0).otherwise(F.col("s_acctbal")).alias("taxable_value"), of(4, 1.5, 0.98).alias("collection_rate"), F.lit(0.03).alias("appreciation_rate"), F.lit(0.02).alias("new_growth_rate"),
        F.lit(0.0).alias("other_revenue"), F.lit(0.02).alias("other_revenue_growth"), F.lit(10.0).alias("expenditures"), of(6, -1.0, 0.6, 0.03).alias("expenditure_growth"), (key % 7 != 0).alias("has_scenario"),
        of(8, 0.06, -0.1, 0.002).alias("start_rate"), (2027 + key % 3).cast("int").alias("first_year"), of(9, 2020, 2070, 2035).cast("int").alias("last_year"),
    )
    told = lambda c: F.array_sort(F.transform(c, lambda p: F.concat_ws(": ", p["field"], p["message"])))
    return L.problems(configs).select("config", told("errors").alias("errors"), told("warnings").alias("warnings"))


def _case(n, *values):
    """The values of 0, 1, ... and the last for all others."""
    return F.coalesce(*(F.when(n == k, v) for k, v in enumerate(values[:-1])), F.lit(values[-1]))


_GAPS = "g AS (SELECT o_custkey%97 AS scenario, year(o_orderdate)::INT AS year, round(sum(o_totalprice)-200000,2) AS gap, round(1000+sum(o_totalprice),2) AS value FROM orders GROUP BY 1,2), r AS (SELECT *, 0.001 AS rate, round(sum(gap) OVER (PARTITION BY scenario ORDER BY year),2) AS cumulative FROM g)"


@query(f"WITH {_GAPS} SELECT scenario, min(year) AS first_year, max(year) AS last_year, count(*) FILTER (gap<0) AS deficit_years, arg_min(year, (gap, year)) AS worst_year, min(gap) AS worst_gap, arg_max(cumulative, year) AS cumulative, CASE WHEN arg_max(gap,year)<0 AND arg_max(value,year)>0 THEN round(0.001-arg_max(gap,year)/arg_max(value,year),6) END AS closing_rate FROM r GROUP BY 1")
def projection_summary(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import Window

    o = table(spark, folder, "orders").groupBy((F.col("o_custkey") % 97).alias("scenario"), F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("t"))
    rows = o.select("scenario", "year", F.round(F.col("t") - 200000, 2).alias("gap"), F.round(1000 + F.col("t"), 2).alias("value"), F.lit(0.001).alias("rate"))
    rows = rows.withColumn("cumulative", F.round(F.sum("gap").over(Window.partitionBy("scenario").orderBy("year")), 2))
    return L.summary(rows, ["scenario"]).withColumn("closing_rate", F.round("closing_rate", 6))


@query("SELECT o_orderkey, CASE WHEN o_totalprice<>0 AND c_acctbal<>0 THEN round(o_totalprice/c_acctbal-1,6) END AS above FROM orders JOIN customer ON c_custkey=o_custkey")
def above_certified(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return rows.select("o_orderkey", F.round(L.above_certified(F.col("o_totalprice"), F.col("c_acctbal")), 6).alias("above"))


@query("WITH a AS (SELECT year(o_orderdate)::INT AS year, o_totalprice AS amount, o_orderstatus='F' AS free FROM orders) SELECT 'full' AS mode, year, round(sum(amount),2) AS amount FROM a GROUP BY 2 UNION ALL SELECT 'partial', year, round(sum(amount),2) FROM a WHERE free GROUP BY 2")
def additions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("amount"), (F.col("o_orderstatus") == "F").alias("incentive_free"))
    parts = [L.additions_by_year(rows, mode).select(F.lit(mode).alias("mode"), "year", F.round("amount", 2).alias("amount")) for mode in ("full", "partial", "none")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- staff -----------------------------------------------------------------------------------------------------------


_WORDS = ["Police patrol", "City library", "Parks and recreation", "Water division", "Planning", "Street lighting", "Finance", "Zebra desk"]
_STAFF = "st AS (SELECT s_nationkey AS place, CASE (s_suppkey%8) " + " ".join(f"WHEN {n} THEN '{w}'" for n, w in enumerate(_WORDS)) + " END AS label, (s_suppkey%50+1)::DOUBLE AS fte FROM supplier)"
_FUNCTION = "CASE " + " ".join(f"WHEN regexp_matches(lower(label), '{p}') THEN '{n}'" for n, p in S.FUNCTIONS) + " ELSE 'unmapped' END"


def _staff(spark: SparkSession, folder: str) -> DataFrame:
    label = F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("s_suppkey") % 8 + 1).cast("int"))
    return table(spark, folder, "supplier").select(F.col("s_nationkey").alias("place"), label.alias("label"), (F.col("s_suppkey") % 50 + 1).cast("double").alias("fte"))


@query(f"WITH {_STAFF} SELECT place, {_FUNCTION} AS function, round(sum(fte),2) AS total FROM st GROUP BY 1,2")
def staff_by_function(spark: SparkSession, folder: str) -> DataFrame:
    return S.by_function(_staff(spark, folder), ["place"], "label", F.col("fte"))


@query(f"""WITH {_STAFF}, f AS (SELECT place, {_FUNCTION} AS fn, sum(fte) AS t FROM st GROUP BY 1,2), p AS (SELECT c_nationkey AS place, count(*)*100 AS people FROM customer GROUP BY 1), g AS (SELECT place, sum(t) AS t, coalesce(sum(t) FILTER (fn='public_safety'),0) AS ps, coalesce(sum(t) FILTER (fn='utilities'),0) AS ut FROM f GROUP BY 1)
SELECT place, round(t,2) AS total, round(t-ps,2) AS excl_public_safety, round(t-ps-ut,2) AS core, round(t/(people/1000.0),3) AS raw_1k, round((t-ps)/(people/1000.0),3) AS excl_1k, round((t-ps-ut)/(people/1000.0),3) AS core_1k FROM g LEFT JOIN p USING(place)""")
def staff_per_thousand(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer").groupBy(F.col("c_nationkey").alias("place")).agg((F.count(F.lit(1)) * 100).alias("people"))
    return S.per_thousand(S.by_function(_staff(spark, folder), ["place"], "label", F.col("fte")), people, ["place"])


@query("SELECT 'city '||(c_nationkey%7) AS place, y AS year, sum(c_custkey*10+y)::BIGINT AS people FROM customer, (VALUES (2023),(2024)) t(y) GROUP BY 1,2")
def whole_places(spark: SparkSession, folder: str) -> DataFrame:
    """Places that lie in several counties, as one."""
    rows = table(spark, folder, "customer").select(F.concat(F.lit(" city "), (F.col("c_nationkey") % 7).cast("string"), F.lit(" ")).alias("place"), F.explode(F.array(F.lit(2023), F.lit(2024))).alias("year"), "c_custkey")
    return S.whole_places(rows.withColumn("people", (F.col("c_custkey") * 10 + F.col("year")).cast("string")), "place", "year", "people")


@query("WITH s AS (SELECT strftime(o_orderdate,'%Y') AS label, sum(o_totalprice) AS v FROM orders WHERE o_orderpriority='1-URGENT' GROUP BY 1), k AS (SELECT label, v, CASE label WHEN '1995' THEN 1 WHEN '1993' THEN 2 WHEN '1997' THEN 3 END AS place FROM s) SELECT place::INT AS place, label, round(v,2) AS value, round(v/lag(v) OVER (ORDER BY place)-1,6) AS change FROM k WHERE place IS NOT NULL")
def cost_series(spark: SparkSession, folder: str) -> DataFrame:
    o = table(spark, folder, "orders").withColumn("label", F.date_format("o_orderdate", "yyyy"))
    series = S.cost_series(o, "o_orderpriority", "1-URGENT", "label", F.col("o_totalprice"), ["1995", "1993", "1997"])
    return series.select("place", "label", F.round("value", 2).alias("value"), F.round("change", 6).alias("change"))
