"""Queries over ordered data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumlake.functions import text as T
from quorumlake.io import table
from quorumlake.operators import ordered as O
from quorumlake.operators import sequences as S
from quorumlake.plans.registry import query

CLEAN = "trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query("""SELECT doc_id, line_no, line FROM (SELECT doc_id, unnest(range(0,len(l))) AS line_no, trim(unnest(l)) AS line FROM (SELECT doc_id, string_split_regex(text, '\\r\\n|\\n|\\r') AS l FROM documents)) WHERE line<>''""")
def scan_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\r\n|\n|\r")).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", F.trim("line").alias("line")).where("line <> ''")


@query("""SELECT meeting_id, line_no, line FROM (SELECT *, lag(line) OVER (PARTITION BY meeting_id ORDER BY line_no, line_id) AS b FROM transcript_lines) WHERE b IS NULL OR trim(line)='' OR b<>line""")
def dedupe_consecutive(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines")
    return S.drop_repeats(lines, "meeting_id", ["line_no", "line_id"], "line", F.floor(F.col("line_no") / 20_000)).select("meeting_id", "line_no", "line")


@query("""WITH e AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w>1 THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e)
SELECT user_id, island::BIGINT AS island, any_value(event_type) AS event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM i GROUP BY 1,2""")
def speaker_islands(spark: SparkSession, folder: str) -> DataFrame:
    runs = S.islands(table(spark, folder, "events"), "user_id", ["ts", "event_id"], "event_type", chunk=F.to_date("ts"))
    return runs.groupBy("user_id", "island").agg(F.first("event_type").alias("event_type"), F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("""SELECT p.event_id, p.user_id, p.ts, c.value AS last_click FROM (SELECT * FROM events WHERE event_type='purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type='click' AND value IS NOT NULL GROUP BY 1,2) c ON p.user_id=c.user_id AND p.ts>=c.ts""")
def asof_event(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click' AND value IS NOT NULL").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return S.asof(bought, clicks, "user_id", "ts", "value", "last_click", F.to_date("ts"))


@query("""WITH d AS (SELECT l_shipdate::DATE::VARCHAR AS day, sum((l_extendedprice*(1-l_discount))::DECIMAL(18,4)) AS revenue FROM lineitem GROUP BY 1) SELECT day, revenue::DOUBLE AS revenue, (sum(revenue) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING))::DOUBLE AS cumulative FROM d""")
def running_cumulative(spark: SparkSession, folder: str) -> DataFrame:
    daily = table(spark, folder, "lineitem").groupBy(F.to_date("l_shipdate").cast("string").alias("day")).agg(F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")).alias("revenue"))
    return S.running_total(daily, "day", "revenue", "cumulative", chunk=F.year("day")).withColumns({c: F.col(c).cast("double") for c in ("revenue", "cumulative")})  # a row a day


@query("""WITH d AS (SELECT ts::DATE::VARCHAR AS day, sum(value) AS v FROM events GROUP BY 1), g AS (SELECT day, round(v-(SELECT avg(v) FROM d),4) AS gap FROM d), n AS (SELECT day, gap, lead(day) OVER (ORDER BY day) AS nd, lead(gap) OVER (ORDER BY day) AS ng FROM g)
SELECT day AS "from", nd AS "to", round(gap/(gap-ng),6) AS fraction, ng<0 AS into_deficit FROM n WHERE gap<>0 AND ng<>0 AND sign(gap)<>sign(ng)""")
def zero_crossings(spark: SparkSession, folder: str) -> DataFrame:
    daily = table(spark, folder, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.sum("value").alias("v"))
    gaps = daily.select("day", F.round(F.col("v") - F.avg("v").over(Window.partitionBy()), 4).alias("gap"))  # a row a day
    return S.crossings(gaps, "day", "gap", chunk=F.to_date(F.date_trunc("month", "day"))).withColumn("fraction", F.round("fraction", 6))


@query(f"""SELECT doc_id, i AS passage_no, p AS passage FROM (SELECT doc_id, unnest(range(0, len(r))) AS i, array_to_string(w[unnest(r)+1 : unnest(r)+230], ' ') AS p
FROM (SELECT doc_id, w, range(0, len(w), 190) AS r FROM (SELECT doc_id, string_split({CLEAN.format(x='text')}, ' ') AS w FROM documents) WHERE array_to_string(w,'')<>'')) WHERE length(p)>=60""")
def passages(spark: SparkSession, folder: str) -> DataFrame:
    return S.passages(table(spark, folder, "documents"), "doc_id", "text")


@query(f"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace({CLEAN.format(x='text')}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x<>'') AS s FROM documents),
f AS (SELECT doc_id, s, unnest(range(0,len(s))) AS n FROM s)
SELECT doc_id, n AS sentence_no, array_to_string(s[greatest(n,1):n+3],' ') AS passage, array_to_string(s[n+1:n+2],' ') AS near FROM f WHERE regexp_matches(lower(s[n+1]), 'questioned|percent')""")
def sentence_windows(spark: SparkSession, folder: str) -> DataFrame:
    return S.sentence_windows(table(spark, folder, "documents"), "doc_id", "text", "questioned|percent")


@query("""SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS in_window, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) > 3 AS limited FROM events""")
def rate_limit(spark: SparkSession, folder: str) -> DataFrame:
    return S.rate_limited(table(spark, folder, "events"), "user_id", "ts", 6 * 3600, 3).select("event_id", "user_id", "in_window", "limited")


@query("""WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM e)
SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n FROM s GROUP BY user_id, session""")
def session_debounce(spark: SparkSession, folder: str) -> DataFrame:
    s = S.sessions(table(spark, folder, "events"), "user_id", "ts", 1800, F.to_date("ts"), "event_id")
    return s.groupBy("user_id", "session").agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("n")).drop("session")


@query("""WITH m AS (SELECT max(ts) AS t FROM events) SELECT e.event_id, e.user_id FROM events e, m WHERE e.ts >= m.t - INTERVAL 6 DAY AND NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id=e.user_id AND p.event_type='purchase' AND p.ts>=m.t - INTERVAL 6 DAY)""")
def late_lookback(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    recent = events.join(F.broadcast(events.agg((F.max("ts") - F.expr("INTERVAL 6 DAYS")).alias("since"))), F.col("ts") >= F.col("since"))  # one row
    done = recent.where("event_type = 'purchase'").select("user_id").distinct()
    return recent.join(done, "user_id", "left_anti").select("event_id", "user_id")


@query("""SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, coalesce(json_extract(props, '$.missing')::BIGINT, -1) AS fallback FROM events""")
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    value = lambda path: F.get_json_object("props", path).cast("bigint")
    return table(spark, folder, "events").select("event_id", value("$.k").alias("k"), F.coalesce(value("$.missing"), F.lit(-1)).alias("fallback"))


@query("""SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, ts, event_id) AS r FROM events) WHERE r<=2""")
def priority_topk(spark: SparkSession, folder: str) -> DataFrame:
    tier = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).otherwise(2)
    return S.first_per_key(table(spark, folder, "events"), ["user_id"], [tier, F.col("ts"), F.col("event_id")], 2).select("user_id", "event_type", "event_id")


@query("""WITH p AS (SELECT p_brand, p_name||'#'||p_partkey AS label, p_retailprice AS value, row_number() OVER (PARTITION BY p_brand ORDER BY abs(p_retailprice) DESC, p_name||'#'||p_partkey) AS r FROM part)
SELECT p_brand, CASE WHEN r<=40 THEN label ELSE 'Other' END AS label, least(r,41)::INT AS rank, round(sum(value),2) AS value, count(*) AS n FROM p GROUP BY 1,2,3""")
def topn_other(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_brand", F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("label"), F.col("p_retailprice").alias("value"))
    return S.top_with_other(parts, "p_brand", "label", "value", 40).withColumn("value", F.round("value", 2))


@query("""SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS r FROM documents) WHERE r=1""")
def content_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    first = docs.groupBy(F.sha2("text", 256).alias("hash")).agg(F.min("doc_id").alias("doc_id"))  # digests are shuffled, not texts
    return docs.join(first, "doc_id", "left_semi").select("doc_id", "text")


@query("""WITH t AS (SELECT user_id AS key, epoch(ts) - 1704067200 AS start, epoch(ts) - 1704067200 + abs(value) AS "end" FROM events WHERE value IS NOT NULL), u AS (SELECT *, "end"-start AS d FROM t WHERE "end"-start>=4),
b AS (SELECT *, least(13, floor((start-min(start) OVER (PARTITION BY key))/greatest(max("end") OVER (PARTITION BY key)-min(start) OVER (PARTITION BY key),1)*14)) AS b FROM u),
r AS (SELECT *, row_number() OVER (PARTITION BY key,b ORDER BY d DESC, start) AS r FROM b), k AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY (r>1)::INT, d DESC, start) AS k FROM r)
SELECT key, round(start+0.4,3) AS start, round(least(d-0.8,12),3) AS duration FROM k WHERE k<=14 AND round(least(d-0.8,12),3)>=3.2""")
def longest_per_bucket(spark: SparkSession, folder: str) -> DataFrame:
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 1704067200
    turns = table(spark, folder, "events").where("value IS NOT NULL").select(F.col("user_id").alias("key"), start.alias("start"), (start + F.abs("value")).alias("end"))
    return S.longest_per_bucket(turns, "key")


@query("""WITH m AS (SELECT user_id, ts, event_id, extract(hour FROM ts)::INT AS a, extract(minute FROM ts)::INT AS b FROM events), l AS (SELECT *, a*60+b AS mmss, a*3600+b*60 AS hhmm FROM m)
SELECT user_id, count(*) FILTER (mmss<pm) AS back_minutes, count(*) FILTER (hhmm<ph) AS back_hours FROM (SELECT *, lag(mmss) OVER w AS pm, lag(hhmm) OVER w AS ph FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY 1""")
def elapsed_scale(spark: SparkSession, folder: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    m = table(spark, folder, "events").select("user_id", "ts", "event_id", (F.hour("ts") * 60 + F.minute("ts")).alias("mmss"), (F.hour("ts") * 3600 + F.minute("ts") * 60).alias("hhmm"))
    return m.select("user_id", "mmss", "hhmm", F.lag("mmss").over(w).alias("pm"), F.lag("hhmm").over(w).alias("ph")).groupBy("user_id").agg(F.count_if(F.col("mmss") < F.col("pm")).alias("back_minutes"), F.count_if(F.col("hhmm") < F.col("ph")).alias("back_hours"))


@query("""WITH l AS (SELECT meeting_id, line_no, line_id, line, nullif(regexp_extract(line, '^Speaker ([A-Z]):', 1),'') AS sp FROM transcript_lines)
SELECT meeting_id, line_no, line_id, last_value(sp IGNORE NULLS) OVER (PARTITION BY meeting_id ORDER BY line_no, line_id ROWS UNBOUNDED PRECEDING) AS speaker FROM l""")
def speaker_fill(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines").select("meeting_id", "line_no", "line_id", F.nullif(F.regexp_extract("line", "^Speaker ([A-Z]):", 1), F.lit("")).alias("sp"))
    return S.forward_fill(lines, "meeting_id", ["line_no", "line_id"], "sp", "speaker", F.floor(F.col("line_no") / 20_000)).drop("sp")


@query(f"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace({CLEAN.format(x='text')}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x<>'') AS s FROM documents)
SELECT doc_id, g AS paragraph_no, array_to_string(s[g*4+1:g*4+4],' ') AS paragraph FROM (SELECT doc_id, s, unnest(range(0, (len(s)+3)//4)) AS g FROM s)""")
def paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "documents").select("doc_id", T.sentences(F.col("text")).alias("s")).where(F.size("s") > 0)
    groups = F.sequence(F.lit(0), F.floor((F.size("s") - 1) / 4))
    return s.select("doc_id", F.explode(groups).alias("paragraph_no"), "s").select("doc_id", "paragraph_no", F.array_join(F.slice("s", (F.col("paragraph_no") * 4 + 1).cast("int"), F.lit(4)), " ").alias("paragraph"))


@query("""SELECT id AS motion_id, row_number() OVER (ORDER BY meeting_id, id) AS surrogate, (row_number() OVER (PARTITION BY meeting_id ORDER BY id)-1)//25 AS batch FROM (SELECT DISTINCT id, meeting_id FROM motions)""")
def surrogate_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Running ids over all rows without one global window."""
    rows = O.numbered(table(spark, folder, "motions").select("id", "meeting_id").distinct(), ["meeting_id", "id"], "surrogate")
    own = F.row_number().over(Window.partitionBy("meeting_id").orderBy("id"))
    return rows.select(F.col("id").alias("motion_id"), "surrogate", F.floor((own - 1) / 25).alias("batch"))
