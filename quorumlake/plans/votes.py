"""Queries over roll calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.functions import text as T
from quorumlake.io import table
from quorumlake.operators import votes as V
from quorumlake.plans.registry import query

ONCE = "SELECT * FROM motions QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1"
ONCE_MEETINGS = "SELECT * FROM meetings QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1"
AGREE = "CASE WHEN lower(vote)='yes' THEN 'y' WHEN lower(vote) IN ('no','nay') THEN 'n' ELSE 'x' END"
SIDE = "CASE WHEN lower(vote) IN ('yes','aye') THEN 'y' WHEN lower(vote) IN ('no','nay') THEN 'n' ELSE 'x' END"
SUMMARY = "CASE WHEN lower(trim(vote)) IN ('yes','aye','y') THEN 'y' WHEN lower(trim(vote)) IN ('no','nay','n') THEN 'n' ELSE 'x' END"
OUTCOME = """CASE WHEN contains(o,'passed') OR contains(o,'approved') OR contains(o,'carried') THEN 'passed' WHEN contains(o,'fail') OR contains(o,'denied') OR contains(o,'not pass') THEN 'failed' ELSE 'other' END"""
VOTES = f"v AS (SELECT id AS motion_id, unnest(range(1, len(votes)+1)) AS pos, unnest(votes) AS u FROM ({ONCE})), votes_long AS (SELECT motion_id, pos, u.member_id AS member_id, u.vote AS vote FROM v)"


def motions_once(spark: SparkSession, folder: str) -> DataFrame:
    return V.once(table(spark, folder, "motions"), "id")


def long_votes(spark: SparkSession, folder: str) -> DataFrame:
    return V.cast_votes(motions_once(spark, folder))


@query(f"""
WITH {VOTES}, members AS (SELECT DISTINCT member_id FROM votes_long)
SELECT m.member_id, count(v.motion_id) AS total,
  count(*) FILTER (lower(vote)='yes') AS yes, count(*) FILTER (lower(vote)='no') AS no, count(*) FILTER (lower(vote)='abstain') AS abstain,
  count(*) FILTER (lower(vote)='excused') AS excused, count(*) FILTER (lower(vote)='absent') AS absent, count(*) FILTER (lower(vote)='nay') AS nay,
  round(coalesce(count(*) FILTER (lower(vote)='yes') / nullif(count(*) FILTER (lower(vote) IN ('yes','no','nay')), 0)::DOUBLE, 0), 6) AS yes_rate
FROM members m LEFT JOIN votes_long v ON v.member_id = m.member_id WHERE m.member_id IS NOT NULL GROUP BY 1""")
def vote_counts(spark: SparkSession, folder: str) -> DataFrame:
    votes = long_votes(spark, folder)
    return V.vote_counts(votes, votes.select("member_id").where("member_id IS NOT NULL").distinct())


@query("""SELECT c.c_custkey AS member_id, count(o.o_orderkey) AS total, count(*) FILTER (o_orderstatus='F') AS yes, count(*) FILTER (o_orderstatus='O') AS no,
  round(coalesce(count(*) FILTER (o_orderstatus='F') / nullif(count(*) FILTER (o_orderstatus IN ('F','O')),0)::DOUBLE, 0), 6) AS yes_rate
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1""")
def yes_rate(spark: SparkSession, folder: str) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    status = F.col("o_orderstatus")
    counts = orders.groupBy(F.col("o_custkey").alias("member_id")).agg(F.count(F.lit(1)).alias("total"), F.count_if(status == "F").alias("yes"), F.count_if(status == "O").alias("no"))
    every = customers.select(F.col("c_custkey").alias("member_id")).join(counts, "member_id", "left").na.fill(0)
    return every.withColumn("yes_rate", F.round(F.coalesce(F.try_divide("yes", F.col("yes") + F.col("no")), F.lit(0.0)), 6))


@query(f"""WITH {VOTES} SELECT least(x.member_id,y.member_id) AS a, greatest(x.member_id,y.member_id) AS b, round(avg((x.k=y.k)::INT::DOUBLE),6) AS agreement, count(*) AS n
FROM (SELECT *, {AGREE} AS k FROM votes_long) x JOIN (SELECT *, {AGREE} AS k FROM votes_long) y ON x.motion_id=y.motion_id AND x.pos<y.pos GROUP BY 1,2""")
def pair_agreement(spark: SparkSession, folder: str) -> DataFrame:
    return V.pair_agreement(long_votes(spark, folder))


@query(f"""WITH {VOTES} SELECT motion_id, count(*) FILTER (k='y') AS yes, count(*) FILTER (k='n') AS no,
  CASE WHEN count(*) FILTER (k='y') < count(*) FILTER (k='n') THEN 'y' WHEN count(*) FILTER (k='n') < count(*) FILTER (k='y') THEN 'n' END AS minority
FROM (SELECT *, {SIDE} AS k FROM votes_long) GROUP BY 1 HAVING count(*) FILTER (k='y')>0 AND count(*) FILTER (k='n')>0""")
def divided_votes(spark: SparkSession, folder: str) -> DataFrame:
    return V.divided(long_votes(spark, folder))


@query(f"""WITH {VOTES}, k AS (SELECT *, {SIDE} AS k FROM votes_long),
d AS (SELECT motion_id, count(*) FILTER (k='y') AS y, count(*) FILTER (k='n') AS n FROM k GROUP BY 1 HAVING y>0 AND n>0)
SELECT member_id, count(*) AS seen, count(*) FILTER (k = CASE WHEN y<n THEN 'y' WHEN n<y THEN 'n' END) AS lost FROM k JOIN d USING(motion_id) WHERE k<>'x' GROUP BY 1""")
def split_record(spark: SparkSession, folder: str) -> DataFrame:
    return V.split_record(long_votes(spark, folder))


@query(f"""SELECT body, {OUTCOME} AS outcome_class, count(*) AS n FROM (SELECT body, lower(coalesce(outcome,'')) AS o FROM ({ONCE})) GROUP BY 1,2""")
def outcome_class(spark: SparkSession, folder: str) -> DataFrame:
    return motions_once(spark, folder).groupBy("body", T.outcome_class(F.col("outcome")).alias("outcome_class")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT tag, left(date,4) AS year, count(*) AS n FROM (SELECT unnest(tags) AS tag, date FROM ({ONCE})) WHERE date IS NOT NULL AND date<>'' GROUP BY 1,2""")
def tag_by_year(spark: SparkSession, folder: str) -> DataFrame:
    rows = motions_once(spark, folder).where("date IS NOT NULL AND date <> ''")
    return rows.select(F.explode("tags").alias("tag"), F.left("date", F.lit(4)).alias("year")).groupBy("tag", "year").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {VOTES} SELECT member_id, tag, count(*) AS n FROM votes_long v JOIN (SELECT id, unnest(tags) AS tag FROM ({ONCE})) t ON t.id=v.motion_id GROUP BY 1,2""")
def member_tags(spark: SparkSession, folder: str) -> DataFrame:
    rows = motions_once(spark, folder).select(F.explode("tags").alias("tag"), F.col("votes.member_id").alias("m"))
    return rows.select(F.explode("m").alias("member_id"), "tag").groupBy("member_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT (SELECT count(*) FROM ({ONCE_MEETINGS})) AS meetings, (SELECT count(*) FROM ({ONCE})) AS motions, (SELECT sum(len(votes))::BIGINT FROM ({ONCE})) AS votes,
 (SELECT sum(ord_count)::BIGINT FROM ({ONCE_MEETINGS})) AS ordinances, (SELECT sum(res_count)::BIGINT FROM ({ONCE_MEETINGS})) AS resolutions""")
def counts_rollup(spark: SparkSession, folder: str) -> DataFrame:
    m = motions_once(spark, folder).agg(F.count(F.lit(1)).alias("motions"), F.sum(F.size("votes")).alias("votes"))
    k = V.once(table(spark, folder, "meetings"), "id").agg(F.count(F.lit(1)).alias("meetings"), F.sum("ord_count").alias("ordinances"), F.sum("res_count").alias("resolutions"))
    return k.crossJoin(m)  # two rows of one each


@query(f"""SELECT id AS motion_id, array_to_string(list_sort([coalesce(x.member_id,'')||': '||coalesce(x.vote,'') FOR x IN votes]), '; ') AS roll_call FROM ({ONCE})""")
def roll_call_text(spark: SparkSession, folder: str) -> DataFrame:
    return motions_once(spark, folder).select(F.col("id").alias("motion_id"), V.roll_call_text(F.col("votes")).alias("roll_call"))


@query("""SELECT row_id, member, vote, CASE WHEN length(motion_excerpt)>500 THEN left(motion_excerpt,500)||'…' ELSE motion_excerpt END AS excerpt
FROM votes_by_member_raw QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY loaded_at DESC)=1""")
def member_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.once(table(spark, folder, "votes_by_member_raw"), "row_id")
    return rows.select("row_id", "member", "vote", T.excerpt(F.col("motion_excerpt")).alias("excerpt"))


NORM = "regexp_replace(regexp_replace(trim(lower({x})), '[^a-z\\s''-]', '', 'g'), '\\s+', ' ', 'g')"


@query(f"""WITH a AS (SELECT n, min(id) AS member_id FROM (SELECT {NORM.format(x='label')} AS n, id FROM bodies) WHERE n<>'' GROUP BY 1), g AS (SELECT DISTINCT {NORM.format(x="town || ' city council'")} AS n FROM bodies)
SELECT d.name, a.member_id, CASE WHEN a.member_id IS NOT NULL THEN 'resolved' WHEN g.n IS NOT NULL THEN 'ignored' ELSE 'unresolved' END AS state
FROM (SELECT DISTINCT replace(body,'-',' ') AS name FROM documents WHERE body IS NOT NULL) d LEFT JOIN a ON a.n={NORM.format(x='d.name')} LEFT JOIN g ON g.n={NORM.format(x='d.name')}""")
def alias_resolve(spark: SparkSession, folder: str) -> DataFrame:
    bodies = table(spark, folder, "bodies")
    names = table(spark, folder, "documents").where("body IS NOT NULL").select(F.translate("body", "-", " ").alias("name")).distinct()
    ignored = bodies.select(F.concat("town", F.lit(" city council")).alias("name"))
    return V.resolve_aliases(names, bodies.select(F.col("label").alias("alias"), F.col("id").alias("member_id")), ignored).select("name", "member_id", "state")


RULES = [("roads", "road"), ("roads", "traffic"), ("parks", "park"), ("parks", "pavilion"), ("water", "sewer"), ("water", "culvert"), ("money", "budget"), ("money", "assessment"), ("land", "zoning"), ("land", "annexation")]
_GUARD = "(^|[^a-zà-ÿ])({})([^a-zà-ÿ]|$)"
_CASES = ", ".join(f"CASE WHEN regexp_matches(t, '{_GUARD.format('|'.join(w for g, w in RULES if g == tag))}') THEN '{tag}' END" for tag in dict.fromkeys(t for t, _ in RULES))


@query(f"SELECT doc_id, list_filter([{_CASES}], lambda x: x IS NOT NULL) AS tags FROM (SELECT doc_id, lower(text) AS t FROM documents)")
def keyword_tagger(spark: SparkSession, folder: str) -> DataFrame:
    return V.tag_texts(table(spark, folder, "documents"), RULES, "doc_id", "text")


@query(f"""SELECT m.id AS motion_id, substr(sha1(concat_ws('|', coalesce(item_title,''), coalesce(motion,''))),1,16) AS content_key, c.n AS copies FROM ({ONCE}) m
JOIN (SELECT substr(sha1(concat_ws('|', coalesce(item_title,''), coalesce(motion,''))),1,16) AS k, count(*) AS n FROM ({ONCE}) GROUP BY 1) c ON c.k=substr(sha1(concat_ws('|', coalesce(m.item_title,''), coalesce(m.motion,''))),1,16)""")
def content_key(spark: SparkSession, folder: str) -> DataFrame:
    keyed = motions_once(spark, folder).select(F.col("id").alias("motion_id"), T.content_key(F.col("item_title"), F.col("motion")).alias("content_key"))
    return keyed.join(keyed.groupBy("content_key").agg(F.count(F.lit(1)).alias("copies")), "content_key")


@query(f"""SELECT tag, sum(CASE WHEN m.tag IS NULL THEN 0 ELSE m.n END)::BIGINT AS motion_count FROM (SELECT DISTINCT unnest(tags) AS tag FROM documents) d
LEFT JOIN (SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM ({ONCE})) GROUP BY 1) m USING(tag) GROUP BY 1""")
def tag_motion_counts(spark: SparkSession, folder: str) -> DataFrame:
    tags = table(spark, folder, "documents").select(F.explode("tags").alias("tag")).distinct()
    counts = motions_once(spark, folder).select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("motion_count"))
    return tags.join(counts, "tag", "left").na.fill(0, ["motion_count"])


@query(f"""WITH {VOTES} SELECT motion_id, count(*) FILTER (k='y') AS yes, count(*) FILTER (k='n') AS no, count(*) FILTER (k='x') AS other,
 coalesce(string_agg(member_id, ', ' ORDER BY pos) FILTER (k='y'),'') AS in_favor, coalesce(string_agg(member_id, ', ' ORDER BY pos) FILTER (k='n'),'') AS against FROM (SELECT *, {SUMMARY} AS k FROM votes_long) GROUP BY 1""")
def vote_summary(spark: SparkSession, folder: str) -> DataFrame:
    k = lambda v: V.summary_class(v["vote"])
    named = lambda c: F.array_join(F.transform(F.filter("votes", lambda v: k(v) == c), lambda v: v["member_id"]), ", ")
    n = lambda c: F.size(F.filter("votes", lambda v: k(v) == c)).cast("bigint")
    rows = motions_once(spark, folder).where(F.size("votes") > 0)
    return rows.select(F.col("id").alias("motion_id"), n("y").alias("yes"), n("n").alias("no"), n("x").alias("other"), named("y").alias("in_favor"), named("n").alias("against"))


@query("""SELECT member, count(*) AS n FROM (SELECT * FROM votes_by_member_raw QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY loaded_at DESC)=1) WHERE member NOT LIKE '% %' GROUP BY 1 ORDER BY n DESC, member LIMIT 50""")
def unresolved_voters(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.once(table(spark, folder, "votes_by_member_raw"), "row_id").where(~F.col("member").contains(" "))
    return rows.groupBy("member").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "member").limit(50)
