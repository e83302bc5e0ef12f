"""Queries over bodies, feeds, caches and printed text."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.functions import text as T
from quorumlake.io import shared_folder, table
from quorumlake.operators import checks as C
from quorumlake.operators import ledger as L
from quorumlake.operators import records as R
from quorumlake.operators import relations
from quorumlake.operators import votes as V
from quorumlake.plans.registry import query
from quorumlake.plans.votes import ONCE, ONCE_MEETINGS, motions_once
from quorumlake.sources.portal import PortalSource, _files

_CLEAN = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


def _meetings(spark: SparkSession, folder: str) -> DataFrame:
    return V.once(table(spark, folder, "meetings"), "id")


# ---- the portal --------------------------------------------------------------------------------------------------


def _portal(spark: SparkSession, folder: str) -> DataFrame:
    """The meetings as the portal would give them, fifteen a page, read by the data source."""
    from pyspark.sql import Window

    place = shared_folder(spark, f"portal/{uuid.uuid4()}")
    n = F.row_number().over(Window.partitionBy("body").orderBy("id")) - 1
    m = _meetings(spark, folder).where("body IS NOT NULL").withColumn("n", n)
    event = F.struct("id", F.concat(F.coalesce("date", F.lit("")), F.lit("T18:00:00Z")).alias("eventDate"), F.col("type").alias("eventName"), (F.col("text_chars") >= 200).alias("hasMedia"), F.lit("Published").alias("isPublished"))
    pages = m.groupBy("body", F.floor(F.col("n") / 15).alias("page")).agg(F.to_json(F.array_sort(F.collect_list(event))).alias("json"))

    def write(rows) -> None:
        for r in rows:
            where, root = _files(place)
            where.create_dir(f"{root}/{r['body']}", recursive=True)
            with where.open_output_stream(f"{root}/{r['body']}/{r['page'] * 15}.json") as file:
                file.write(r["json"].encode())

    pages.foreachPartition(write)
    spark.dataSource.register(PortalSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("portal").option("path", place).load()


@query(f"SELECT id, body AS category, left(coalesce(date,'')||'T18:00:00Z',10) AS date, type AS name, coalesce(text_chars>=200,false) AS has_media, true AS published FROM ({ONCE_MEETINGS}) WHERE body IS NOT NULL")
def portal_events(spark: SparkSession, folder: str) -> DataFrame:
    return _portal(spark, folder)


@query(f"SELECT id, category, date FROM (SELECT id, body AS category, coalesce(date,'') AS date FROM ({ONCE_MEETINGS}) WHERE body IS NOT NULL) WHERE date>='2016-01-01' ORDER BY date, id LIMIT 30")
def portal_window(spark: SparkSession, folder: str) -> DataFrame:
    """The first thirty events from a day on; the day reaches the reader.  Of a meeting without a date the portal gives the hour only, which is no day."""
    return _portal(spark, folder).where("date >= '2016-01-01' AND date <> 'T18:00:00Z'").orderBy("date", "id").limit(30).select("id", "category", "date")


# ---- bodies, feeds, links ------------------------------------------------------------------------------------------


@query("SELECT id, label FROM bodies WHERE NOT coalesce(hidden,false)")
def public_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return R.public(table(spark, folder, "bodies")).select("id", "label")


@query(f"SELECT id, coalesce(motion_count>0,false) AND (nullif(trim(summary),'') IS NOT NULL OR nullif(trim(type),'') IS NOT NULL) AS recorded FROM ({ONCE_MEETINGS})")
def recordings(spark: SparkSession, folder: str) -> DataFrame:
    return _meetings(spark, folder).select("id", R.has_recording(F.col("motion_count") > 0, F.col("summary"), F.col("type")).alias("recorded"))


@query(f"SELECT id AS motion_id, significance IS NOT DISTINCT FROM 'routine' AS routine, significance IS NOT DISTINCT FROM 'notable' AS notable, trim(coalesce(outcome,''))='' OR contains(lower(outcome),'not found') AS unknown, coalesce(headline,'')='' AND coalesce(length({_CLEAN.format('item_title')}),0)>60 AS oversized FROM ({ONCE})")
def motion_flags(spark: SparkSession, folder: str) -> DataFrame:
    s = F.col("significance")
    long = (F.coalesce("headline", F.lit("")) == "") & (F.coalesce(F.length(T.clean(F.col("item_title"))), F.lit(0)) > 60)
    return motions_once(spark, folder).select(F.col("id").alias("motion_id"), s.eqNullSafe(F.lit("routine")).alias("routine"), s.eqNullSafe(F.lit("notable")).alias("notable"), T.unknown_outcome(F.col("outcome")).alias("unknown"), long.alias("oversized"))


@query(f"""WITH v AS (SELECT id, unnest(votes) AS v, unnest(range(len(votes))) AS pos FROM ({ONCE})), c AS (SELECT DISTINCT left(sha1(member),16) AS key, member AS plain FROM votes_by_member_raw WHERE member IS NOT NULL), k AS (SELECT key, min(plain) AS plain FROM c GROUP BY 1)
SELECT v.id AS motion_id, v.pos, v.v.member_id AS member_id, coalesce(k.plain,'') AS plain FROM v LEFT JOIN k ON k.key=left(sha1(replace(coalesce(v.v.member_id,''),'-',' ')),16)""")
def plain_items(spark: SparkSession, folder: str) -> DataFrame:
    """Nested items joined with a cache by the hash of their content, and put together again."""
    cache = table(spark, folder, "votes_by_member_raw").where("member IS NOT NULL").select(F.left(F.sha1("member"), F.lit(16)).alias("key"), F.col("member").alias("plain"))
    key = lambda i: F.left(F.sha1(F.replace(F.coalesce(i["member_id"], F.lit("")), F.lit("-"), F.lit(" "))), F.lit(16))
    rows = R.with_plain(motions_once(spark, folder).select("id", "votes"), "votes", cache, key)
    return rows.select(F.col("id").alias("motion_id"), F.posexplode("votes").alias("pos", "i")).select("motion_id", F.col("pos").cast("bigint").alias("pos"), "i.member_id", "i.plain")


@query(f"SELECT m.id AS motion_id, coalesce('/meetings/'||k.date||'-'||k.id||'.html', '/motions?id='||m.id) AS link FROM ({ONCE}) m LEFT JOIN (SELECT * FROM ({ONCE_MEETINGS}) WHERE coalesce(text_chars,0)>=2500) k ON k.id=m.meeting_id")
def linked_sources(spark: SparkSession, folder: str) -> DataFrame:
    pages = _meetings(spark, folder).where("coalesce(text_chars, 0) >= 2500").select(F.col("id").alias("meeting_id"), F.concat(F.lit("/meetings/"), "date", F.lit("-"), F.col("id").cast("string"), F.lit(".html")).alias("page"))
    return R.linked(motions_once(spark, folder), pages, "meeting_id", F.concat(F.lit("/motions?id="), F.col("id").cast("string"))).select(F.col("id").alias("motion_id"), "link")


@query(f"""WITH e AS (SELECT body, meeting_id AS id, min(coalesce(date,'')) AS date, count(*) FILTER (page>1)::INT AS items, count(*) FILTER (contains(upper(coalesce(business_type,'')),'PUBLIC HEARING'))::INT AS hearings FROM ({ONCE}) WHERE body IS NOT NULL AND meeting_id IS NOT NULL GROUP BY 1,2)
SELECT body, id, date, '18:00' AS start, items, hearings FROM e WHERE date>='2015-06-01' QUALIFY row_number() OVER (PARTITION BY body ORDER BY date, id)=1""")
def upcoming_cards(spark: SparkSession, folder: str) -> DataFrame:
    m = motions_once(spark, folder).where("body IS NOT NULL AND meeting_id IS NOT NULL")
    head = F.struct((F.coalesce("page", F.lit(0)) <= 1).alias("procedural"), F.array(F.struct(F.coalesce("business_type", F.lit("")).alias("kind"))).alias("items"))
    events = m.groupBy("body", F.col("meeting_id").alias("id")).agg(F.min(F.coalesce("date", F.lit(""))).alias("date"), F.lit("18:00").alias("start"), F.collect_list(head).alias("agenda"))
    return R.upcoming_card(events, "2015-06-01")


@query(f"""WITH m AS (SELECT id FROM ({ONCE_MEETINGS}) WHERE coalesce(text_chars,0)>=2500), t AS (SELECT DISTINCT meeting_id AS id FROM transcript_lines), a AS (SELECT id FROM ({ONCE_MEETINGS}))
SELECT id, 'minutes' AS source FROM m UNION ALL SELECT id, 'transcript' FROM t WHERE id NOT IN (SELECT id FROM m) UNION ALL SELECT id, 'agenda' FROM a WHERE id NOT IN (SELECT id FROM m) AND id NOT IN (SELECT id FROM t)""")
def every_meeting(spark: SparkSession, folder: str) -> DataFrame:
    """Meetings with minutes, then those with a transcript only, then those of which only the agenda is known."""
    m = _meetings(spark, folder)
    rows = relations.cascade("id", m.where("coalesce(text_chars, 0) >= 2500").select("id"), table(spark, folder, "transcript_lines").select(F.col("meeting_id").alias("id")).distinct(), m.select("id"))
    return rows.select("id", F.element_at(F.array(F.lit("minutes"), F.lit("transcript"), F.lit("agenda")), F.col("rank") + 1).alias("source"))


@query("""WITH l AS (SELECT meeting_id, line_no, coalesce(min(line),'') AS line FROM transcript_lines GROUP BY 1,2) SELECT meeting_id, sum(len(list_filter(string_split(trim(regexp_replace(line,'\\s+',' ','g')),' '), lambda x: x<>'')))::BIGINT AS words, bool_or(regexp_matches(line,'^Speaker [A-Z]:')) AS diarized, count(*) AS lines FROM l GROUP BY 1""")
def transcript_facts(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines").groupBy("meeting_id", "line_no").agg(F.coalesce(F.min("line"), F.lit("")).alias("line"))
    words = F.size(F.filter(F.split(T.clean(F.col("line")), " "), lambda w: w != ""))
    return lines.groupBy("meeting_id").agg(F.sum(words).alias("words"), F.bool_or(F.col("line").rlike("^Speaker [A-Z]:")).alias("diarized"), F.count(F.lit(1)).alias("lines"))


@query("SELECT DISTINCT meeting_id FROM transcript_lines WHERE meeting_id NOT IN (SELECT meeting_id FROM speakers WHERE method='hand') AND meeting_id NOT IN (SELECT id FROM meetings WHERE coalesce(text_chars,0)>=2500)")
def unlabelled_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Transcripts that neither a hand-labelled voice nor minutes of any length refer to."""
    t = table(spark, folder, "transcript_lines").select("meeting_id").distinct()
    hand = table(spark, folder, "speakers").where("method = 'hand'").select("meeting_id")
    return C.dangling(t, "meeting_id", hand, table(spark, folder, "meetings").where("coalesce(text_chars, 0) >= 2500").select("id"))


# ---- caches and calls ------------------------------------------------------------------------------------------------


@query(f"SELECT body, batch, count(*) AS motions FROM (SELECT body, (row_number() OVER (PARTITION BY body ORDER BY id)-1)//25 AS batch FROM ({ONCE}) WHERE coalesce(headline,'')='' OR page>5) GROUP BY 1,2")
def call_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of at most 25 motions that have no result made with these parameters yet."""
    m = motions_once(spark, folder)
    done = m.where("coalesce(headline, '') <> ''").select("id", F.when(F.col("page") > 5, "v1").otherwise("v2").alias("parameters"))
    return R.batched(R.to_do(m, done, ["id"], "v2"), "body", ["id"], 25).groupBy("body", "batch").agg(F.count(F.lit(1)).alias("motions"))


@query("""SELECT doc_id, CASE WHEN doc_id%4=3 THEN NULL ELSE 'd'||doc_id END AS headline, CASE WHEN doc_id%4=3 THEN NULL WHEN doc_id%4=1 THEN 'routine' ELSE 'notable' END AS significance FROM documents""")
def salvaged_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies with fences and words around them; what is no JSON is null, a significance that is not allowed becomes routine."""
    number = F.col("doc_id").cast("string")
    kind = F.when(F.col("doc_id") % 4 == 1, "great").otherwise("notable")
    good = F.concat(F.lit('Here:\n```json\n{"headline": "d'), number, F.lit('", "significance": "'), kind, F.lit('"}\n```'))
    reply = T.reply_json(F.when(F.col("doc_id") % 4 == 3, "no idea").otherwise(good))
    parsed = table(spark, folder, "documents").select("doc_id", F.from_json(reply, "headline string, significance string").alias("r"))
    allowed = F.when(F.col("r.significance").isin("routine", "notable"), F.col("r.significance")).when(F.col("r.significance").isNotNull(), "routine")
    return parsed.select("doc_id", "r.headline", allowed.alias("significance"))


# ---- text ------------------------------------------------------------------------------------------------------------


@query(f"""WITH c AS (SELECT doc_id, {_CLEAN.format('text')} AS t FROM documents) SELECT doc_id, rtrim(left(t,120)) AS hard, CASE WHEN length(t)<=120 THEN t WHEN regexp_extract(left(t,120),'^(.*[.!?])(?:\\s|$)',1)<>'' THEN regexp_extract(left(t,120),'^(.*[.!?])(?:\\s|$)',1) ELSE rtrim(left(t,120)) END AS whole FROM c""")
def cut_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", T.cut_hard(F.col("text"), 120).alias("hard"), T.cut_at_sentence(F.col("text"), 120).alias("whole"))


@query("SELECT doc_id, ('0x'||left(sha1(text),12))::BIGINT AS number, left(sha1(text),10) AS mark, left(sha1(coalesce(title,'')||'|'||coalesce(text,'')),16) AS key FROM documents")
def stable_ids(spark: SparkSession, folder: str) -> DataFrame:
    x = F.col("text")
    return table(spark, folder, "documents").select("doc_id", T.stable_number(x).alias("number"), T.version_mark(x).alias("mark"), T.content_key(F.col("title"), x).alias("key"))


_ESC = "replace(replace(replace(replace(replace({0},'&','&amp;'),'<','&lt;'),'>','&gt;'),'\"','&quot;'),'''','&#x27;')"


@query(f"""SELECT id, '<h3>'||e||' notes</h3><p>about <strong>'||e||'</strong> in <em>'||t||'</em></p><ul><li>one <code>x_1</code></li> <li>two <a href="https://h/'||id||'">'||t||'</a></li></ul><p>end</p>' AS html FROM (SELECT id, {_ESC.format('label')} AS e, {_ESC.format('town')} AS t FROM bodies)""")
def small_markdown(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(F.lit("## "), "label", F.lit(" notes\nabout **"), "label", F.lit("** in *"), "town", F.lit("*\n\n- one `x_1`\n- two ["), "town", F.lit("](https://h/"), "id", F.lit(")\n\nend\n"))
    return table(spark, folder, "bodies").select("id", T.markdown(text).alias("html"))


# ---- checks ------------------------------------------------------------------------------------------------------------


@query("SELECT id, CASE WHEN NOT regexp_matches(id,'^[a-z0-9-]+$') THEN 'form' ELSE 'twice' END AS problem FROM (SELECT town AS id, count(*) AS n FROM bodies GROUP BY 1) WHERE NOT regexp_matches(id,'^[a-z0-9-]+$') OR n>1")
def claim_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that are not in the form asked for, or stand for more than one thing."""
    ids = table(spark, folder, "bodies").select(F.col("town").alias("id"))
    return C.id_problems(ids, "id", "^[a-z0-9-]+$")


@query("WITH o AS (SELECT p_brand AS b, p_type AS t, round(sum(p_retailprice),2) AS v FROM part GROUP BY 1,2) SELECT b, round(sum(v),2) AS old_total, round(sum(v),2) AS new_total, count(*) AS old_groups, count(DISTINCT CASE WHEN t IN ('PROMO','SMALL') THEN 'X' ELSE t END) AS new_groups FROM o GROUP BY 1")
def regrouping(spark: SparkSession, folder: str) -> DataFrame:
    """A new grouping against the old: totals must stay, groups may join."""
    parts = table(spark, folder, "part")
    joined = F.when(F.col("p_type").isin("PROMO", "SMALL"), "X").otherwise(F.col("p_type"))
    return L.regrouped(parts, ["p_brand"], "p_type", joined, F.col("p_retailprice")).withColumnRenamed("p_brand", "b")


@query("SELECT count(*) AS lines, true AS ties FROM lineitem")
def published_total(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the sum of all orders' lines ties to the printed total within one unit a thousand lines."""
    lines = table(spark, folder, "lineitem")
    printed = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).agg(F.sum("q").alias("printed"))
    actual = lines.agg(F.sum("l_quantity").alias("computed"), F.count(F.lit(1)).alias("lines"))
    return actual.crossJoin(printed).select("lines", (F.abs(F.col("computed") - F.col("printed")) <= 1).alias("ties"))  # one row each

