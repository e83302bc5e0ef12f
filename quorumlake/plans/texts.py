"""Queries over text and date functions, checks, sinks' data and subtitles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.functions import dates as D
from quorumlake.functions import text as T
from quorumlake.io import table
from quorumlake.operators import checks as C
from quorumlake.operators import search as S
from quorumlake.operators import votes as V
from quorumlake.plans.registry import query
from quorumlake.plans.votes import ONCE, ONCE_MEETINGS, motions_once
from quorumlake.sources import readers, sinks


@query("""SELECT id, regexp_replace(regexp_replace(lower(label),'[^a-z0-9]+','-','g'),'^-+|-+$','','g') AS slug, upper(left(label,1)||left(regexp_extract(label,'([^ ]+)$',1),1)) AS initials,
CASE WHEN length(label)<=18 THEN label ELSE rtrim(CASE WHEN contains(left(label,18),' ') AND 18-strpos(reverse(left(label,18)),' ')>0.6*18 THEN left(label,18-strpos(reverse(left(label,18)),' ')) ELSE left(label,18) END)||' …' END AS clipped FROM bodies""")
def labels(spark: SparkSession, folder: str) -> DataFrame:
    x = F.col("label")
    return table(spark, folder, "bodies").select("id", T.slug(x).alias("slug"), T.initials(x).alias("initials"), T.clip(x, 18).alias("clipped"))


@query(f"""SELECT id, motion_count || ' motion' || CASE WHEN motion_count=1 THEN '' ELSE 's' END AS line, motion_count::VARCHAR || CASE WHEN motion_count%100 BETWEEN 11 AND 13 THEN 'th' WHEN motion_count%10=1 THEN 'st' WHEN motion_count%10=2 THEN 'nd' WHEN motion_count%10=3 THEN 'rd' ELSE 'th' END AS ordinal, text_chars<200 AS scanned FROM ({ONCE_MEETINGS}) WHERE motion_count IS NOT NULL""")
def counts_lines(spark: SparkSession, folder: str) -> DataFrame:
    m = V.once(table(spark, folder, "meetings"), "id").where("motion_count IS NOT NULL")
    return m.select("id", T.plural(F.col("motion_count"), "motion").alias("line"), T.ordinal(F.col("motion_count")).alias("ordinal"), (F.col("text_chars") < 200).alias("scanned"))


@query(f"""SELECT id, CASE WHEN d IS NULL THEN '' ELSE lower(strftime(d,'%Y-%m-%d')||' | '||strftime(d,'%B %-d %Y')||' | '||strftime(d,'%B %-d, %Y')||' | '||strftime(d,'%b %-d %Y')||' | '||strftime(d,'%b %-d, %Y')||' | '||strftime(d,'%-d %B %Y')||' | '||strftime(d,'%-d %b %Y')||' | '||strftime(d,'%-m/%-d/%Y')||' | '||strftime(d,'%-m/%-d/%y')) END AS forms FROM (SELECT id, try_strptime(date,'%Y-%m-%d') AS d FROM ({ONCE_MEETINGS}))""")
def date_forms(spark: SparkSession, folder: str) -> DataFrame:
    return V.once(table(spark, folder, "meetings"), "id").select("id", D.date_forms(F.col("date")).alias("forms"))


@query("SELECT event_id, (v//3600)::BIGINT||':'||lpad(((v%3600)//60)::BIGINT::VARCHAR,2,'0')||':'||lpad((v%60)::BIGINT::VARCHAR,2,'0') AS hms, CASE WHEN v//60>=60 THEN (v//3600)::BIGINT||'h '||lpad(((v//60)%60)::BIGINT::VARCHAR,2,'0')||'m' ELSE (v//60)::BIGINT||'m' END AS label FROM (SELECT event_id, event_id*37%20000 AS v FROM events)")
def durations(spark: SparkSession, folder: str) -> DataFrame:
    s = (F.col("event_id") * 37) % 20000
    return table(spark, folder, "events").select("event_id", D.hms(s).alias("hms"), D.duration_label(s).alias("label"))


@query("""SELECT doc_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(text,'(?s)<(script|style)[^>]*>.*?</(script|style)>',' ','g'),'<[^>]+>',' ','g'),'&lt;','<'),'&gt;','>'),'&quot;','"'),'&#x27;',''''),'&#39;',''''),'&nbsp;',' '),'&amp;','&'),'\\s+',' ','g')) AS plain FROM documents""")
def html_strip(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", T.strip_tags(F.col("text")).alias("plain"))


@query("SELECT doc_id, list_distinct(regexp_extract_all(lower(text),'[a-z]{4,}')).len()::INT AS words, (SELECT count(*) FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text),'[a-z0-9]+'))))::INT AS tokens FROM documents")
def word_sets(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.size(T.long_word_set(F.col("text"))).alias("words"), F.size(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)))).alias("tokens"))


@query(f"""SELECT id AS motion_id, list_filter([CASE WHEN coalesce(len(votes),0)=0 THEN 'no votes' END, CASE WHEN coalesce(outcome,'')='' THEN 'no outcome' END, CASE WHEN coalesce(page,0)<1 THEN 'no page' END], lambda x: x IS NOT NULL) AS broken FROM ({ONCE}) WHERE coalesce(len(votes),0)=0 OR coalesce(outcome,'')='' OR coalesce(page,0)<1""")
def broken_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = {"no votes": F.size("votes") > 0, "no outcome": F.col("outcome") != "", "no page": F.col("page") >= 1}
    return C.broken(motions_once(spark, folder), rules).select(F.col("id").alias("motion_id"), "broken")


@query("SELECT DISTINCT meeting_id FROM transcript_lines WHERE meeting_id NOT IN (SELECT id FROM meetings) AND meeting_id NOT IN (SELECT meeting_id FROM speakers)")
def dangling_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    t = table(spark, folder, "transcript_lines").select("meeting_id").distinct()
    return C.dangling(t, "meeting_id", table(spark, folder, "meetings").select("id"), table(spark, folder, "speakers").select("meeting_id"))


@query("SELECT id, count(*) AS n FROM motions GROUP BY 1 HAVING count(*)>1")
def delivered_again(spark: SparkSession, folder: str) -> DataFrame:
    return C.duplicates(table(spark, folder, "motions"), "id")


@query("""SELECT meeting_id, line_no, round(a[1]::DOUBLE*3600+a[2]::DOUBLE*60+a[3]::DOUBLE+a[4]::DOUBLE/1000,3) AS start_s, round(a[5]::DOUBLE*3600+a[6]::DOUBLE*60+a[7]::DOUBLE+a[8]::DOUBLE/1000,3) AS end_s
FROM (SELECT meeting_id, line_no, string_split(regexp_replace(line,'^(\\d{1,2}):(\\d{2}):(\\d{2})[.,](\\d{3})\\s*-->\\s*(\\d{1,2}):(\\d{2}):(\\d{2})[.,](\\d{3}).*$','\\1|\\2|\\3|\\4|\\5|\\6|\\7|\\8'),'|') AS a FROM transcript_lines WHERE regexp_matches(line,'^\\d{1,2}:\\d{2}:\\d{2}[.,]\\d{3}\\s*-->'))""")
def cue_times(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines").where(F.col("line").contains("-->"))
    blocks = lines.select(F.concat_ws("/", "meeting_id", "line_no").alias("source_file"), F.col("line").alias("value"))
    key = F.split("source_file", "/")
    return readers.cues(blocks).select(F.get(key, F.lit(0)).cast("bigint").alias("meeting_id"), F.get(key, F.lit(1)).cast("int").alias("line_no"), F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"))


@query("SELECT meeting_id, round(max(s),3) AS recording_s, count(*) AS cues FROM (SELECT meeting_id, (a[1]::DOUBLE*3600+a[2]::DOUBLE*60+a[3]::DOUBLE) AS s FROM (SELECT meeting_id, string_split(regexp_extract(line,'--> *(\\d{1,2}:\\d{2}:\\d{2})',1),':') AS a FROM transcript_lines WHERE contains(line,'-->'))) GROUP BY 1")
def recording_lengths(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines").where(F.col("line").contains("-->"))
    end = D.elapsed(F.regexp_extract("line", r"--> *(\d{1,2}:\d{2}:\d{2})", 1)).cast("double")
    return lines.groupBy("meeting_id").agg(F.round(F.max(end), 3).alias("recording_s"), F.count(F.lit(1)).alias("cues"))


@query(f"SELECT body, list(row(d,id) ORDER BY d DESC, id DESC)[1][2] AS newest, count(*) AS n FROM (SELECT body, coalesce(date,'') AS d, id FROM ({ONCE_MEETINGS})) GROUP BY 1")
def newest_by_body(spark: SparkSession, folder: str) -> DataFrame:
    m = V.once(table(spark, folder, "meetings"), "id").select("body", F.coalesce("date", F.lit("")).alias("d"), "id")
    return m.groupBy("body").agg(F.max_by("id", F.struct("d", "id")).alias("newest"), F.count(F.lit(1)).alias("n"))


@query("SELECT '<url><loc>/'||id||'</loc><lastmod>2026-01-01</lastmod><priority>'||CASE WHEN hidden THEN '0.1' ELSE '0.7' END||'</priority></url>' AS value FROM bodies")
def sitemap(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "bodies").select(F.concat(F.lit("/"), "id").alias("url"), F.lit("2026-01-01").alias("changed"), F.when(F.col("hidden"), -0.3).otherwise(0.7).alias("priority"))
    return sinks.sitemap(pages)


@query("""WITH t AS (SELECT meeting_id AS conv, line_no AS turn, CASE WHEN regexp_matches(line,'^Speaker [A-C]:') THEN 'user' ELSE 'assistant' END AS role, line AS text FROM transcript_lines WHERE length(trim(line))>0),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn DESC) AS r FROM t) WHERE r<=6), l AS (SELECT *, min(CASE WHEN role='user' THEN turn END) OVER (PARTITION BY conv) AS f FROM r), k AS (SELECT * FROM l WHERE turn>=f),
n AS (SELECT *, lead(role) OVER (PARTITION BY conv ORDER BY turn) AS nx FROM k), m AS (SELECT * FROM n WHERE nx IS NULL OR nx<>role), e AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn DESC) AS z FROM m)
SELECT conv, turn, role, trim(text) AS text FROM e WHERE NOT (z=1 AND role='user')""")
def history_norm(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "transcript_lines").groupBy(F.col("meeting_id").alias("conv"), F.col("line_no").alias("turn")).agg(F.min("line").alias("text"))
    turns = turns.withColumn("role", F.when(F.col("text").rlike("^Speaker [A-C]:"), "user").otherwise("assistant"))
    return S.merge_history(turns, "conv", "turn", "role", "text")
