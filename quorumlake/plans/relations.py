"""Queries over joins, sets, ledgers and peers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumlake.functions import text as T
from quorumlake.io import table
from quorumlake.operators import ledger as L
from quorumlake.operators import relations as R
from quorumlake.plans.registry import query

REVENUE = "(l_extendedprice*(1-l_discount))::DECIMAL(18,4)"  # exact sums, the same in any order


def money():
    return (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")



@query(f"""WITH r AS (SELECT n_name, year(o_orderdate) AS y, sum({REVENUE}) AS v FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey WHERE year(o_orderdate) IN (1996,1997) GROUP BY 1,2),
a AS (SELECT * FROM r WHERE y=1997), b AS (SELECT * FROM r WHERE y=1996)
SELECT coalesce(a.n_name,b.n_name) AS n_name, round(coalesce(a.v,0),2)::DOUBLE AS now, round(coalesce(b.v,0),2)::DOUBLE AS prior, round(coalesce(a.v,0)-coalesce(b.v,0),2)::DOUBLE AS change FROM a FULL JOIN b ON a.n_name=b.n_name""")
def full_outer_pair(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y")).where("y IN (1996, 1997)")
    facts = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    facts = facts.groupBy("o_custkey", "y").agg(F.sum(money()).alias("v"))
    named = facts.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    by = named.groupBy("n_name", "y").agg(F.sum("v").alias("v"))
    return R.pair(by.where("y = 1997"), by.where("y = 1996"), ["n_name"], "v").select("n_name", *(F.round(c, 2).cast("double").alias(c) for c in ("now", "prior", "change")))


@query(f"""SELECT p_brand, s_nationkey, {', '.join(f'round(sum(CASE WHEN year(l_shipdate)={y} THEN {REVENUE} END),2)::DOUBLE AS "{y}"' for y in range(1994, 2000))} FROM lineitem JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey WHERE year(l_shipdate) BETWEEN 1994 AND 1999 GROUP BY 1,2""")
def ledger_pivot(spark: SparkSession, folder: str) -> DataFrame:
    years = list(range(1994, 2000))
    items = table(spark, folder, "lineitem").withColumn("y", F.year("l_shipdate")).where(F.col("y").isin(years))
    facts = items.groupBy("l_partkey", "l_suppkey", "y").agg(F.sum(money()).alias("v"))
    joined = facts.join(table(spark, folder, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return L.versions(joined, ["p_brand", "s_nationkey"], "y", years, F.col("v"))


@query("""SELECT n_regionkey, c_mktsegment, o_orderpriority, round(sum(o_totalprice),2) AS total, grouping(n_regionkey, c_mktsegment, o_orderpriority)::BIGINT AS grouping FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey
GROUP BY GROUPING SETS ((n_regionkey),(c_mktsegment),(o_orderpriority),(n_regionkey,c_mktsegment),(n_regionkey,o_orderpriority))""")
def grouping_sets_flow(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.sum("o_totalprice").alias("v"))
    wide = orders.join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    sets = [["n_regionkey"], ["c_mktsegment"], ["o_orderpriority"], ["n_regionkey", "c_mktsegment"], ["n_regionkey", "o_orderpriority"]]
    return L.groupings(wide, sets, F.col("v"), "total").select("n_regionkey", "c_mktsegment", "o_orderpriority", "total", "grouping")


@query("SELECT n_nationkey, n_name, r_name AS parent_label FROM nation LEFT JOIN region ON n_regionkey=r_regionkey")
def parent_join(spark: SparkSession, folder: str) -> DataFrame:
    nodes = table(spark, folder, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("label"), F.lit(None).cast("int").alias("n_nationkey"))
    nodes = nodes.unionByName(table(spark, folder, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.col("n_name").alias("label"), "n_nationkey"))
    return L.with_parent(nodes, "id", "parent", "label").where("n_nationkey IS NOT NULL").select("n_nationkey", F.col("label").alias("n_name"), "parent_label")


@query("""SELECT p_partkey, CASE WHEN starts_with(p_type,'PROMO') THEN 'revenue' WHEN starts_with(p_type,'STANDARD') THEN 'expense' ELSE 'other' END AS side,
CASE WHEN right(p_brand,2)::INT BETWEEN 11 AND 25 THEN 'taxes' WHEN right(p_brand,2)::INT BETWEEN 31 AND 45 THEN 'fees' ELSE 'rest' END AS category FROM part WHERE regexp_matches(p_brand,'[0-9][0-9]$')""")
def prefix_side(spark: SparkSession, folder: str) -> DataFrame:
    number = F.right("p_brand", F.lit(2)).cast("int")
    side = F.when(F.col("p_type").startswith("PROMO"), "revenue").when(F.col("p_type").startswith("STANDARD"), "expense").otherwise("other")
    category = F.when(number.between(11, 25), "taxes").when(number.between(31, 45), "fees").otherwise("rest")
    return table(spark, folder, "part").where(F.col("p_brand").rlike("[0-9][0-9]$")).select("p_partkey", side.alias("side"), category.alias("category"))


TERMS = [("first", None, "1995-12-31"), ("second", "1995-07-01", "1997-06-30"), ("third", "1997-01-01", None)]
_TERMS_SQL = "(VALUES ('first',NULL,'1995-12-31'),('second','1995-07-01','1997-06-30'),('third','1997-01-01',NULL)) t(term,s,e)"


@query(f"SELECT o_orderkey, term FROM (SELECT o_orderkey, strftime(o_orderdate,'%Y-%m-%d') AS d FROM orders) o JOIN {_TERMS_SQL} ON (s IS NULL OR d>=s) AND (e IS NULL OR d<=e)")
def interval_member(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return R.holding(orders, spark.createDataFrame(TERMS, "term string, start string, end string"), "d").select("o_orderkey", "term")


@query("""WITH m AS (SELECT DISTINCT meeting_id AS id FROM motions), t AS (SELECT DISTINCT meeting_id AS id FROM transcript_lines), a AS (SELECT DISTINCT id FROM meetings)
SELECT id, 0 AS rank FROM m UNION ALL SELECT id, 1 FROM t WHERE id NOT IN (SELECT id FROM m) UNION ALL SELECT id, 2 FROM a WHERE id NOT IN (SELECT id FROM m) AND id NOT IN (SELECT id FROM t)""")
def anti_cascade(spark: SparkSession, folder: str) -> DataFrame:
    ids = lambda name, c: table(spark, folder, name).select(F.col(c).alias("id")).distinct()
    return R.cascade("id", ids("motions", "meeting_id"), ids("transcript_lines", "meeting_id"), ids("meetings", "id"))


@query("""WITH o AS (SELECT meeting_id, letter, min(name) AS name FROM speakers WHERE method='hand' GROUP BY 1,2), b AS (SELECT meeting_id, letter, min(name) AS name FROM speakers WHERE method IS DISTINCT FROM 'hand' GROUP BY 1,2)
SELECT * FROM o UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.meeting_id=b.meeting_id AND o.letter=b.letter)""")
def hand_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "speakers")
    by = lambda d: d.groupBy("meeting_id", "letter").agg(F.min("name").alias("name"))
    hand = F.coalesce(F.col("method") == "hand", F.lit(False))
    return R.override(by(rows.where(~hand)), by(rows.where(hand)), ["meeting_id", "letter"])


@query("""WITH a AS (SELECT c_nationkey AS k, round(avg(c_acctbal),4) AS v FROM customer WHERE c_mktsegment='BUILDING' GROUP BY 1), b AS (SELECT s_nationkey AS k, round(avg(s_acctbal),4) AS v FROM supplier GROUP BY 1) SELECT coalesce(a.k,b.k) AS k, coalesce(a.v,b.v) AS v FROM a FULL JOIN b ON a.k=b.k""")
def vintage_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'").groupBy(F.col("c_nationkey").alias("k")).agg(F.round(F.avg("c_acctbal"), 4).alias("v"))
    b = table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.round(F.avg("s_acctbal"), 4).alias("v"))
    return R.newest_wins(a, b, ["k"], "v")


@query("""WITH e AS (SELECT DISTINCT id AS body FROM bodies WHERE NOT hidden), u AS (SELECT DISTINCT body FROM meetings), x AS (SELECT DISTINCT id AS body FROM bodies WHERE category='board')
SELECT body, 'left out' AS problem FROM e WHERE body NOT IN (SELECT body FROM u) AND body NOT IN (SELECT body FROM x) UNION ALL SELECT body, 'outside the rule' FROM u WHERE body NOT IN (SELECT body FROM e) UNION ALL SELECT body, 'excluded but used' FROM x WHERE body IN (SELECT body FROM u)""")
def audit_peer_rule(spark: SparkSession, folder: str) -> DataFrame:
    bodies = table(spark, folder, "bodies").withColumnRenamed("id", "body")
    return R.audit(bodies.where(~F.col("hidden")), table(spark, folder, "meetings"), bodies.where("category = 'board'"), "body")


@query("""WITH a AS (SELECT body, business_type, outcome FROM motions), b AS (SELECT body, business_type, outcome FROM motions WHERE lead), c AS (SELECT *, count(*) AS n FROM a GROUP BY ALL), d AS (SELECT *, count(*) AS n FROM b GROUP BY ALL)
SELECT c.body, c.business_type, c.outcome, c.n::BIGINT AS in_old, coalesce(d.n,0)::BIGINT AS in_new FROM c LEFT JOIN d ON c.body=d.body AND c.business_type IS NOT DISTINCT FROM d.business_type AND c.outcome IS NOT DISTINCT FROM d.outcome WHERE c.n<>coalesce(d.n,0)""")
def bag_equality(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "motions")
    return R.bag_difference(m.select("body", "business_type", "outcome"), m.where("lead").select("body", "business_type", "outcome"))


@query("""WITH a AS (SELECT id, max(coalesce(headline,'')) AS c FROM motions GROUP BY 1), b AS (SELECT id, max(coalesce(summary,headline,'')) AS c FROM motions WHERE page>1 GROUP BY 1)
SELECT coalesce(a.id,b.id) AS id, CASE WHEN a.id IS NULL THEN 'new' WHEN b.id IS NULL THEN 'orphan' WHEN a.c=b.c THEN 'same' ELSE 'changed' END AS state FROM a FULL JOIN b ON a.id=b.id""")
def page_changes(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "motions")
    old = m.groupBy("id").agg(F.max(F.coalesce("headline", F.lit(""))).alias("c"))
    return R.changes(old, m.where("page > 1").groupBy("id").agg(F.max(F.coalesce("summary", "headline", F.lit(""))).alias("c")), "id", "c")


@query("SELECT s_nationkey, round(median(s_acctbal),4) AS median, round(avg(s_acctbal),4) AS mean, count(*) AS n FROM supplier GROUP BY 1")
def median_peers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").groupBy("s_nationkey").agg(F.round(F.percentile("s_acctbal", 0.5), 4).alias("median"), F.round(F.avg("s_acctbal"), 4).alias("mean"), F.count(F.lit(1)).alias("n"))


@query("SELECT s_suppkey, s_name, round(abs(s_acctbal-5000),4) AS gap, row_number() OVER (ORDER BY abs(s_acctbal-5000), s_name)::INT AS rank FROM supplier ORDER BY abs(s_acctbal-5000), s_name LIMIT 10")
def nearest_peers(spark: SparkSession, folder: str) -> DataFrame:
    return L.nearest(table(spark, folder, "supplier"), "s_acctbal", "s_name", 5000.0, 10).select("s_suppkey", "s_name", F.round("gap", 4).alias("gap"), "rank")


@query("""SELECT s_suppkey, rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC)::INT AS rank, CASE WHEN count(*) OVER p>1 THEN round((sum(s_acctbal) OVER p-s_acctbal)/(count(*) OVER p-1),4) END AS peers_mean FROM supplier WINDOW p AS (PARTITION BY s_nationkey)""")
def peer_ranks(spark: SparkSession, folder: str) -> DataFrame:
    ranked = L.leave_one_out_mean(L.competition_rank(table(spark, folder, "supplier"), "s_nationkey", "s_acctbal"), "s_nationkey", "s_acctbal")
    return ranked.select("s_suppkey", "rank", F.round("peers_mean", 4).alias("peers_mean"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice/sum(l_extendedprice) OVER (PARTITION BY l_orderkey),8) AS share FROM lineitem")
def bill_share(spark: SparkSession, folder: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / F.sum("l_extendedprice").over(w), 8).alias("share"))


@query("""WITH t AS (SELECT 'u'||user_id AS k, round(sum(value),4) AS v FROM events GROUP BY 1), p AS (SELECT 'u'||user_id AS k, round(sum(value) FILTER (event_type<>'error'),4) AS v FROM events GROUP BY 1)
SELECT p.k, p.v AS printed, t.v AS computed FROM p LEFT JOIN t USING(k) WHERE t.v IS NULL OR abs(t.v-p.v)>1""")
def tie_out(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events").withColumn("k", F.concat(F.lit("u"), "user_id"))
    actual = e.groupBy("k").agg(F.round(F.sum("value"), 4).alias("value"))
    printed = e.groupBy("k").agg(F.round(F.sum(F.when(F.col("event_type") != "error", F.col("value"))), 4).alias("value"))
    return L.tie_out(actual, printed, "k", 1.0)


@query("""WITH RECURSIVE b AS (SELECT round(sum(o_totalprice),2) AS v FROM orders), p(year,value,rate,revenue,other,spending) AS (
 SELECT 2027, v, 0.001::DOUBLE, v*0.001, 1000.0::DOUBLE, v*0.0011 FROM b UNION ALL
 SELECT year+1, value*1.03+value*0.02, revenue/(value*1.03*1.0), (value*1.03+value*0.02)*(revenue/(value*1.03*1.0)), other*1.02, spending*1.04 FROM p WHERE year<2032)
SELECT year, round(value,2) AS value, round(revenue,2) AS revenue, round(revenue+other-spending,2) AS gap FROM p""")
def projection(spark: SparkSession, folder: str) -> DataFrame:
    value = table(spark, folder, "orders").agg(F.round(F.sum("o_totalprice"), 2)).first()[0] or 0.0  # one number, the base of the projection
    base = {"value": value, "rate": 0.001, "collection": 1.0, "appreciation": 0.03, "growth": 0.02, "other": 1000.0, "other_growth": 0.02, "spending": value * 0.0011, "spending_growth": 0.04}
    rows = L.project(spark, base, 2027, 2032, {"method": "certified"})
    return rows.select("year", *(F.round(c, 2).alias(c) for c in ("value", "revenue", "gap")))


@query("""WITH k AS (SELECT doc_id, kind, body, tags FROM documents WHERE kind IN ('claim','notice','site') AND len(tags)>0), p AS (SELECT a.doc_id, b.doc_id AS related, CASE WHEN a.tags[1]=b.tags[1] THEN 0 ELSE 1 END AS tier FROM k a JOIN k b ON a.body=b.body AND a.doc_id<>b.doc_id AND list_has_any(a.tags,b.tags))
SELECT doc_id, related FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tier, related) AS r FROM p) WHERE r<=4""")
def related_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Up to four related documents of the same body: those with the same first tag, then those with any in common.

    The feature is a top four, so each (body, tag) list is cut to the few first that can matter for it before any
    pairing: a document's best come from the first five of each of its tags' lists.
    """
    k = table(spark, folder, "documents").where(F.col("kind").isin("claim", "notice", "site") & (F.size("tags") > 0)).select("doc_id", "body", "tags")
    tagged = k.select("doc_id", "body", F.explode(F.array_distinct("tags")).alias("tag"), F.element_at("tags", 1).alias("lead"))
    heads = tagged.groupBy("body", "tag").agg(F.slice(F.sort_array(F.collect_set(F.struct("doc_id", "lead"))), 1, 5).alias("any5"), F.slice(F.sort_array(F.collect_set(F.when(F.col("lead") == F.col("tag"), F.struct("doc_id", "lead")))), 1, 5).alias("lead5"))
    near = tagged.join(heads, ["body", "tag"]).select("doc_id", "lead", F.explode(F.array_union("any5", "lead5")).alias("x")).where(F.col("x.doc_id") != F.col("doc_id"))
    tier = F.when(F.col("x.lead") == F.col("lead"), 0).otherwise(1)
    pairs = near.select("doc_id", F.col("x.doc_id").alias("related"), tier.alias("tier")).groupBy("doc_id", "related").agg(F.min("tier").alias("tier"))
    w = Window.partitionBy("doc_id").orderBy("tier", "related")
    return pairs.withColumn("r", F.row_number().over(w)).where("r <= 4").select("doc_id", "related")
