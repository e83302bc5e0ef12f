"""Queries of readers, sinks and text functions over texts that are printed from the tables; the SQL tells from the tables what must
come out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.functions import dates as D
from quorumlake.functions import text as T
from quorumlake.io import shared_folder, table
from quorumlake.operators import records as R
from quorumlake.operators import relations, schedules
from quorumlake.operators import votes as V
from quorumlake.plans.registry import query
from quorumlake.plans.votes import ONCE, ONCE_MEETINGS, motions_once
from quorumlake.sources import readers, sinks
from quorumlake.streaming import streams

_CLEAN = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


def _meetings(spark: SparkSession, folder: str) -> DataFrame:
    return V.once(table(spark, folder, "meetings"), "id")


def _place(spark: SparkSession) -> str:
    return shared_folder(spark, f"printed/{uuid.uuid4()}")


# ---- readers -----------------------------------------------------------------------------------------------------


@query("SELECT meeting_id::VARCHAR AS source_file, (row_number() OVER (PARTITION BY meeting_id ORDER BY line_no)-1)::INT AS line_no, nullif(regexp_extract(line,'^Speaker ([A-Z]):\\s*(.*)$',1),'') AS speaker, CASE WHEN regexp_matches(line,'^Speaker ([A-Z]):\\s*(.*)$') THEN regexp_extract(line,'^Speaker ([A-Z]):\\s*(.*)$',2) ELSE line END AS said FROM (SELECT meeting_id, line_no, coalesce(min(line),'') AS line FROM transcript_lines GROUP BY 1,2)")
def speaker_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines").groupBy("meeting_id", "line_no").agg(F.coalesce(F.min("line"), F.lit("")).alias("line"))
    files = lines.groupBy(F.col("meeting_id").cast("string").alias("source_file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("value"))
    return readers.speaker_lines(files)


@query("SELECT user_id::VARCHAR AS source_file, event_type AS label, (epoch(ts)::BIGINT%24)||':'||lpad((event_id%60)::VARCHAR,2,'0') AS mark FROM (SELECT *, floor(epoch(ts)) AS e FROM events) WHERE event_type<>'error'".replace("epoch(ts)::BIGINT%24", "e::BIGINT%24"))
def table_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Marks out of the pipe tables of summaries; other sections and cells that are no mark are passed over."""
    e = table(spark, folder, "events")
    mark = F.concat((F.unix_seconds(F.col("ts").cast("timestamp")) % 24).cast("string"), F.lit(":"), F.lpad((F.col("event_id") % 60).cast("string"), 2, "0"))
    row = F.concat(F.lit("| "), "event_type", F.lit(" | "), F.when(F.col("event_type") == "error", "soon").otherwise(mark), F.lit(" |"))
    rows = e.groupBy(F.col("user_id").cast("string").alias("source_file")).agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("t"))
    text = F.concat(F.lit("# Summary\n## Other\n| a | elapsed |\n|---|---|\n| b | 1:00 |\n## Meeting map\n| topic | Elapsed time |\n|---|---|\n"), "t", F.lit("\n## After\n| c | 2:00 |"))
    return readers.table_marks(rows.select("source_file", text.alias("value"))).select("source_file", "label", "mark")


@query("SELECT event_id AS id, event_type AS kind, (event_id%7=0) AS broken FROM events WHERE event_id%5<>0")
def json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines as they were written, with comments, blank lines and broken lines among them."""
    e, path = table(spark, folder, "events"), _place(spark)
    line = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("# "), "event_type")).when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"id": '), "event_id", F.lit(', "kind": "'), "event_type")).otherwise(F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))))
    e.select(line.alias("value")).write.text(path)
    rows = readers.json_lines(spark, path, "id bigint, kind string")
    number = F.regexp_extract("bad", r'"id": (\d+)', 1).try_cast("bigint")
    return rows.select(F.coalesce("id", number).alias("id"), F.coalesce("kind", F.regexp_extract("bad", r'"kind": "(\w+)', 1)).alias("kind"), F.col("bad").isNotNull().alias("broken"))


@query("SELECT n_name AS name, y AS year, (n_nationkey*100+y)::BIGINT AS value FROM nation, (VALUES (2010),(2011),(2012)) t(y) WHERE n_regionkey<3")
def wide_years(spark: SparkSession, folder: str) -> DataFrame:
    """A table with one column a year, as Latin-1, turned to rows."""
    path = _place(spark)
    years = [(F.col("n_nationkey") * 100 + y).alias(f"POP{y}") for y in (2010, 2011, 2012)]
    table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.when(F.col("n_regionkey") < 3, "162").otherwise("040").alias("SUMLEV"), *years).write.csv(path, header=True, encoding="ISO-8859-1")
    return readers.wide_years(spark, path, "SUMLEV = '162'", "POP", ["name"])


@query("SELECT id AS slug, label AS term FROM bodies WHERE label<>''")
def glossary(spark: SparkSession, folder: str) -> DataFrame:
    block = F.concat(F.lit('<div class="def" id="'), "id", F.lit('"><dt>'), T.escape_html(F.col("label")), F.lit('<a href="#x">¶</a></dt><dd>text</dd></div>'))
    page = table(spark, folder, "bodies").agg(F.lit("page").alias("source_file"), F.array_join(F.collect_list(block), "\n").alias("value"))  # a page of the few bodies
    return readers.glossary(page).select("slug", "term")


@query("SELECT n_name AS family, w AS weight, n_nationkey::VARCHAR AS remote FROM nation, (VALUES ('400'),('700')) t(w) WHERE n_regionkey<>2")
def font_faces(spark: SparkSession, folder: str) -> DataFrame:
    face = lambda w: F.concat(F.lit("/* "), F.when(F.col("n_regionkey") == 2, "greek").otherwise("latin"), F.lit(" */\n@font-face { font-family: '"), "n_name", F.lit(f"'; font-style: normal; font-weight: {w}; src: url(https://h/"), F.col("n_nationkey").cast("string"), F.lit(".woff2) format('woff2'); }\n"))
    sheet = F.array_join(F.flatten(F.collect_list(F.array(face(400), face(700), face(400)))), "")
    css = table(spark, folder, "nation").agg(F.lit("a.css").alias("source_file"), sheet.alias("value"))  # a sheet of the few nations
    return readers.font_faces(css, ["latin"]).select("family", "weight", F.regexp_extract("remote", r"/(\d+)\.woff2", 1).alias("remote"))


@query(f"SELECT id, date, motion_count::BIGINT AS lines FROM ({ONCE_MEETINGS}) WHERE regexp_matches(coalesce(date,''),'^\\d{{4}}-\\d{{2}}-\\d{{2}}$') AND coalesce(motion_count,0)>0")
def landed_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Files of minutes by name and lines, read from a folder of folders; form feeds divide pages, blank lines do not count."""
    path = _place(spark)
    m = _meetings(spark, folder).where("date IS NOT NULL")
    stem = F.concat("date", F.lit("__"), F.col("id").cast("string"))
    text = F.concat_ws("\f\n\n", F.transform(F.sequence(F.lit(1), F.greatest(F.coalesce("motion_count", F.lit(0)), F.lit(1))), lambda n: F.when(F.coalesce("motion_count", F.lit(0)) > 0, F.concat(F.lit("  line "), n.cast("string"))).otherwise("   ")))
    m.select(stem.alias("stem"), text.alias("value")).repartition(1).write.partitionBy("stem").text(path)
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), "stem=([^/]+)/", 1).alias("source_file"), "value")
    date, number = readers.stem_parts(F.col("source_file"))
    pages = files.select("source_file", F.explode(F.split("value", "\f")).alias("p")).select("source_file", F.explode(F.split("p", "\r\n|\n|\r")).alias("line")).where("trim(line) <> ''")
    return pages.groupBy(number.alias("id"), date.alias("date")).agg(F.count(F.lit(1)).alias("lines")).where("date IS NOT NULL")


@query(f"WITH m AS ({ONCE_MEETINGS}) SELECT id, body, coalesce(motion_count,0)::BIGINT AS motions FROM m")
def landed_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies landed as JSON several times, the newest of each key."""
    path = _place(spark)
    table(spark, folder, "meetings").select("id", "body", F.coalesce("motion_count", F.lit(0)).cast("bigint").alias("motions"), F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")).write.json(path)
    return readers.landed(spark, path, "id bigint, body string, motions bigint, at string", "id", "at").drop("at")


@query("SELECT kind, sum(length(text))::BIGINT AS chars, count(*) AS files FROM documents WHERE kind IS NOT NULL GROUP BY 1")
def binary_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of files below folders, one folder a kind, put together again."""
    path = _place(spark)
    docs = table(spark, folder, "documents").where("kind IS NOT NULL")
    docs.select("kind", F.hex(F.encode("text", "utf-8")).alias("value")).write.partitionBy("kind").text(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.regexp_extract("path", "kind=([^/]+)/", 1).alias("kind"), F.decode("content", "utf-8").alias("c"))
    texts = files.select("kind", F.explode(F.split("c", "\n")).alias("b"))
    return texts.groupBy("kind").agg(F.sum(F.length(F.decode(F.unhex("b"), "utf-8"))).alias("chars"), F.count_if(F.col("b") != "").alias("files")).withColumn("files", F.col("files") + F.lit(0))


# ---- roll calls, members, queues -----------------------------------------------------------------------------------


@query(f"""WITH t AS (SELECT id, array_to_string(list_sort(list_transform(votes, lambda v: coalesce(v.member_id,'')||': '||coalesce(v.vote,''))), '; ') AS t FROM ({ONCE})), p AS (SELECT id, unnest(list_filter(string_split(t,';'), lambda s: contains(s,':'))) AS s FROM t)
SELECT id AS motion_id, trim(regexp_extract(s,'(?s)^(.*):([^:]*)$',1)) AS name, trim(regexp_extract(s,'(?s)^(.*):([^:]*)$',2)) AS vote, count(*) AS n FROM p GROUP BY ALL""")
def roll_calls(spark: SparkSession, folder: str) -> DataFrame:
    text = motions_once(spark, folder).select(F.col("id").alias("motion_id"), V.roll_call_text(F.col("votes")).alias("t"))
    return text.select("motion_id", F.inline(V.roll_call(F.col("t")))).groupBy("motion_id", "name", "vote").agg(F.count(F.lit(1)).alias("n"))


_TERMS = f"tm AS (SELECT v.member_id AS member_id, body AS role, min(date) AS s, max(date) AS e FROM (SELECT body, date, unnest(votes) AS v FROM ({ONCE}) WHERE coalesce(date,'')<>'') WHERE v.member_id IS NOT NULL GROUP BY 1,2)"


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    """Members with a term for each body they vote in."""
    rows = motions_once(spark, folder).where("coalesce(date, '') <> ''").select("body", "date", F.explode("votes").alias("v")).where("v.member_id IS NOT NULL")
    terms = rows.groupBy(F.col("v.member_id").alias("member_id"), F.col("body").alias("role")).agg(F.min("date").alias("start"), F.max("date").alias("end"))
    return terms.groupBy("member_id").agg(F.collect_list(F.struct("role", "start", "end")).alias("terms"))


@query(f"""WITH {_TERMS}, r AS (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY s DESC, role DESC, e DESC) AS k FROM tm) SELECT member_id, max(CASE WHEN k=1 THEN role END) AS role, max(CASE WHEN k=1 THEN s END) AS start, min(s) AS first, left(max(CASE WHEN k=1 THEN s END),4)||'–'||left(max(CASE WHEN k=1 THEN e END),4) AS years,
bool_or(s<='2016-06-01' AND e>='2016-06-01') AS serving, max(CASE WHEN k=1 THEN s END) AS run FROM r GROUP BY 1""")
def member_terms(spark: SparkSession, folder: str) -> DataFrame:
    m = R.terms_newest_first(_terms(spark, folder))
    return m.select("member_id", "role", "start", R.first_seated(F.col("terms")).alias("first"), D.term_years(F.col("start"), F.col("end")).alias("years"), R.serving(F.col("terms"), F.lit("2016-06-01")).alias("serving"), R.role_run_start(F.col("terms")).alias("run"))


@query(f"""SELECT meeting_id, arg_min(id, (CASE WHEN contains(lower(coalesce(headline,'')),'approve') THEN 0 ELSE 1 END, -coalesce(regexp_replace(date,'\\D','','g'),'0')::BIGINT, id)) AS file_id FROM ({ONCE}) WHERE page%3=0 AND meeting_id IS NOT NULL AND regexp_matches(coalesce(date,''),'^\\d') GROUP BY 1""")
def best_files(spark: SparkSession, folder: str) -> DataFrame:
    """Of a meeting's files of one kind the approved one, else the newest, else the smaller id."""
    m = motions_once(spark, folder).where("meeting_id IS NOT NULL").where(F.coalesce("date", F.lit("")).rlike(r"^\d"))
    name = F.replace(F.lower(F.coalesce("headline", F.lit(""))), F.lit("approve"), F.lit("approved"))
    files = m.groupBy("meeting_id").agg(F.array_sort(F.collect_list(F.struct(F.col("id").alias("fileId"), (F.col("page") % 3 + 4).alias("fileType"), name.alias("name"), F.col("date").alias("publishOn")))).alias("files"))
    return files.select("meeting_id", R.best_file(F.col("files"), 4)["fileId"].alias("file_id")).where("file_id IS NOT NULL")


@query(f"""SELECT id, date FROM ({ONCE_MEETINGS}) WHERE try_strptime(date,'%Y-%m-%d')::DATE BETWEEN DATE '2016-06-01' - 900 AND DATE '2016-06-01' AND coalesce(text_chars,0)>=200 AND id NOT IN (SELECT meeting_id FROM speakers) AND body NOT IN (SELECT id FROM bodies WHERE hidden) ORDER BY date, id LIMIT 25""")
def pending_queue(spark: SparkSession, folder: str) -> DataFrame:
    m = _meetings(spark, folder)
    events = m.select("id", F.when(F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).isNotNull(), F.col("date")).alias("date"), F.lit(True).alias("published"), (F.coalesce("text_chars", F.lit(0)) >= 200).alias("has_media"))
    hidden = m.join(table(spark, folder, "bodies").where("hidden").select(F.col("id").alias("body")), "body", "left_semi")
    done = table(spark, folder, "speakers").select(F.col("meeting_id").alias("id"))
    return R.pending(events, done, hidden, "2016-06-01", 900, 25).select("id", "date")


@query("SELECT meeting_id, letter, min(name) AS name FROM speakers WHERE method IS DISTINCT FROM 'voiceprint' AND letter IS NOT NULL GROUP BY 1,2")
def hand_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "speakers").where("letter IS NOT NULL")
    one = rows.groupBy("meeting_id", "letter", F.coalesce("method", F.lit("?")).alias("m")).agg(F.min("name").alias("name"))
    maps = one.groupBy("meeting_id", "m").agg(F.map_from_entries(F.collect_list(F.struct("letter", F.struct("name", F.nullif(F.col("m"), F.lit("?")).alias("method"))))).alias("v"))
    return maps.select("meeting_id", F.explode(R.hand_made(F.col("v"))).alias("letter", "x")).groupBy("meeting_id", "letter").agg(F.min("x.name").alias("name"))


@query("""WITH p AS (SELECT member AS id, min(body) AS name FROM votes_by_member_raw GROUP BY 1), s AS (SELECT name, count(*) AS k FROM p GROUP BY 1) SELECT r.row_id, r.id, coalesce(CASE WHEN s.k>1 THEN p.name||' ('||p.id||')' ELSE p.name END, r.id, 'Unknown') AS shown FROM (SELECT row_id, min(member) AS id FROM votes_by_member_raw GROUP BY 1) r LEFT JOIN p ON p.id=r.id LEFT JOIN s ON s.name=p.name""")
def shown_names(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "votes_by_member_raw")
    people = raw.select(F.col("member").alias("id"), F.col("body").alias("name"))
    return relations.shown_names(raw.groupBy("row_id").agg(F.min("member").alias("id")), people, "id", "name")


@query(f"SELECT id, coalesce(date,'') AS date FROM ({ONCE_MEETINGS}) WHERE coalesce(date,'')>='2014-01-01' AND id NOT IN (SELECT meeting_id FROM transcript_lines)")
def not_landed(spark: SparkSession, folder: str) -> DataFrame:
    listed = _meetings(spark, folder).select("id", F.coalesce("date", F.lit("")).alias("date"))
    return streams.not_landed(listed, table(spark, folder, "transcript_lines").select(F.col("meeting_id").alias("id")), "id", since="2014-01-01")


# ---- text and dates --------------------------------------------------------------------------------------------------


@query("""WITH t AS (SELECT DISTINCT member AS m FROM votes_by_member_raw WHERE member IS NOT NULL), b AS (SELECT m, trim(regexp_replace(regexp_replace(regexp_replace(trim(m),'\\s*\\([^)]*\\)\\s*$',''), '(?i)^(?:(?:mayor pro tem|mayor|councilmember|council member|chief deputy|deputy|chief|mr\\.|mrs\\.|ms\\.|dr\\.|miss)\\s+)+',''), '\\s*["“”][^"“”]*["“”]\\s*',' ','g')) AS p0, trim(regexp_extract(trim(m),'\\(([^)]*)\\)\\s*$',1)) AS role FROM t),
c AS (SELECT m, trim(regexp_replace(p0,'\\s+',' ','g')) AS p, role FROM b), f AS (SELECT lower(string_split(p,' ')[1]) AS f, list_sort(list(DISTINCT p)) AS candidates FROM c WHERE contains(p,' ') GROUP BY 1)
SELECT m AS member, role, CASE WHEN contains(p,' ') THEN p WHEN len(candidates)=1 THEN candidates[1] END AS person, CASE WHEN contains(p,' ') THEN [] ELSE coalesce(candidates,[]) END AS candidates FROM c LEFT JOIN f ON f.f=CASE WHEN NOT contains(p,' ') THEN lower(p) END""")
def resolved_people(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "votes_by_member_raw").where("member IS NOT NULL").select("member").distinct()
    return T.resolve_people(names, "member").select("member", "role", "person", "candidates")


_SMALL, _CAPS = ("[" + ",".join(f"'{w}'" for w in ws) + "]" for ws in (T.SMALL_WORDS, T.CAPITALS))


@query(f"""WITH u AS (SELECT id, upper(label)||' OF THE '||upper(town)||'/RDA - MIXED-USE (PHASE 2B)' AS x FROM bodies), w AS (SELECT id, string_split(x,' ') AS w FROM u)
SELECT id, array_to_string(list_transform(w, lambda t, i: CASE WHEN regexp_matches(t,'[0-9]') OR list_contains({_CAPS}, lower(regexp_replace(t,'[()\\[\\]"''.,:;]','','g'))) THEN t WHEN i>1 AND list_contains({_SMALL}, lower(regexp_replace(t,'[()\\[\\]"''.,:;]','','g'))) THEN lower(t)
 ELSE array_to_string(list_transform(string_split(t,'-'), lambda p: array_to_string(list_transform(string_split(p,'/'), lambda q: regexp_extract(q,'^[("'']*')||upper(left(regexp_replace(q,'^[("'']*',''),1))||lower(substr(regexp_replace(q,'^[("'']*',''),2))),'/')),'-') END), ' ') AS calm FROM w""")
def calm_titles(spark: SparkSession, folder: str) -> DataFrame:
    loud = F.concat(F.upper("label"), F.lit(" OF THE "), F.upper("town"), F.lit("/RDA - MIXED-USE (PHASE 2B)"))
    return table(spark, folder, "bodies").select("id", T.calm_caps(loud).alias("calm"))


@query(f"""SELECT id AS motion_id, 'RESOLUTION/HEARING' AS kind, trim(coalesce(t,'')) AS rest, CASE WHEN ends_with(a,'-') THEN a||b ELSE concat_ws(' ', nullif(a,''), nullif(b,'')) END AS joined, regexp_replace(lower(coalesce(t,'')), '[^a-z0-9'']', '', 'g') AS word FROM (SELECT id, regexp_replace(item_title, '[\\r\\n]+', ' ', 'g') AS t, coalesce(string_split(item_title, chr(10))[1],'') AS a, coalesce(string_split(item_title, chr(10))[2],'') AS b FROM ({ONCE}))""")
def title_parts(spark: SparkSession, folder: str) -> DataFrame:
    m = motions_once(spark, folder).withColumns({"t": F.regexp_replace("item_title", r"[\r\n]+", " "), "lines": F.split("item_title", "\n")})
    kind, rest = T.split_kind(F.concat(F.lit("RESOLUTION/HEARING - "), F.coalesce("t", F.lit(""))))
    line = lambda n: F.coalesce(F.get("lines", F.lit(n)), F.lit(""))
    return m.select(F.col("id").alias("motion_id"), kind.alias("kind"), F.trim(rest).alias("rest"), T.wrap_join(line(0), line(1)).alias("joined"), T.norm_word(F.coalesce("t", F.lit(""))).alias("word"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber%4=0 THEN -round(l_extendedprice,0) WHEN l_linenumber%4=1 THEN round(l_extendedprice,0) WHEN l_linenumber%4=2 THEN 0 ELSE l_linenumber END::DOUBLE AS value FROM lineitem")
def figures(spark: SparkSession, folder: str) -> DataFrame:
    """Printed figures read: brackets, commas and dollars, dashes, percents."""
    n, price = F.col("l_linenumber"), F.format_number(F.round("l_extendedprice", 0), 0)
    shown = F.when(n % 4 == 0, F.concat(F.lit("("), price, F.lit(")"))).when(n % 4 == 1, F.concat(F.lit("$"), price)).when(n % 4 == 2, "–").otherwise(F.concat(n.cast("string"), F.lit("%")))
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", T.numeric(shown).alias("value"))


@query(f"""WITH d AS (SELECT id, try_strptime(date,'%Y-%m-%d') AS d FROM ({ONCE_MEETINGS})) SELECT id, strftime(d,'%Y-%m-%d') AS heading, strftime(d,'%Y-%m-%d') AS posted, strftime(d,'%Y-%m-%d') AS free, strftime(d,'%Y%m%d')||'183000' AS number, strftime(d,'%Y-%m-%d') AS day, '18:30' AS clock, '6:30 PM' AS label, strftime(d,'%Y-%m-%d') AS local FROM d WHERE d IS NOT NULL""")
def read_dates(spark: SparkSession, folder: str) -> DataFrame:
    """The date of a meeting out of a heading, a certificate, a free text, a stamp and an instant."""
    d = F.try_to_timestamp("date", F.lit("yyyy-MM-dd"))
    m = _meetings(spark, folder).where(d.isNotNull())
    iso = lambda x: F.date_format(x, "yyyy-MM-dd")
    heading = F.concat(F.lit("MINUTES\nof "), F.date_format(d, "MMMM d, yyyy"), F.lit(" at 6:30"))
    certificate = F.concat(F.lit("was posted on\nthis "), F.dayofmonth(d).cast("string"), F.lit(" day of "), F.date_format(d, "MMMM, yyyy"))
    stamp = F.concat("date", F.lit("T18:30:00Z"))
    day, clock = D.split_event_time(stamp)
    return m.select(
        "id", iso(D.heading_date(heading)).alias("heading"), iso(D.posted_on(certificate)).alias("posted"), iso(D.free_date(F.date_format(d, "MMM d, yyyy"))).alias("free"), D.publish_number(stamp).cast("string").alias("number"),
        day.alias("day"), clock.alias("clock"), D.clock(clock).alias("label"), iso(D.local_today(F.concat("date", F.lit(" 23:00:00")).cast("timestamp"), "America/Denver")).alias("local"),
    )


@query("""SELECT doc_id, '{"id": '||doc_id||', "kind": "'||coalesce(kind,'')||'"}' AS reply, CASE WHEN kind='motion' THEN ['u'||(doc_id%9)] ELSE ['a','b','c'] END AS used, 'https://h/m?id='||doc_id||CASE WHEN kind='motion' THEN '' ELSE '&body='||coalesce(kind,'x') END AS address FROM documents""")
def replies_and_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """What is taken out of a model's reply, the sources it cites, and addresses in their one form."""
    docs = table(spark, folder, "documents")
    number, kind = F.col("doc_id").cast("string"), F.coalesce("kind", F.lit(""))
    body = F.concat(F.lit('{"id": '), number, F.lit(', "kind": "'), kind, F.lit('"}'))
    url = F.concat(F.lit("http://other/m?x=1&id="), number, F.lit("&body="), F.coalesce("kind", F.lit("x")), F.lit("#top"))
    cited = F.when(F.coalesce(F.col("kind") == "motion", F.lit(False)), F.concat(F.lit("see u"), (F.col("doc_id") % 9).cast("string"))).otherwise("nothing")
    sources = F.concat(F.transform(F.array(*map(F.lit, "abcdef")), lambda u: F.struct(F.when(cited == "nothing", u).otherwise(F.concat(F.lit("http://"), u)).alias("url"))), F.array(F.struct(F.concat(F.lit("u"), (F.col("doc_id") % 9).cast("string")).alias("url"))))
    sources = F.when(cited == "nothing", F.filter(sources, lambda s: F.length(s["url"]) == 1)).otherwise(sources)
    answer = F.when(cited == "nothing", "").otherwise(cited)
    used = F.transform(T.used_sources(sources, answer), lambda s: s["url"])
    return docs.select("doc_id", T.reply_json(F.concat(F.lit("```json\n"), body, F.lit("\n``` done"))).alias("reply"), used.alias("used"), T.canonical_url(url, "https://h", "motion").alias("address"))


@query("""WITH c AS (SELECT doc_id, 'sources' AS event, coalesce(kind,'') AS data, 0 AS event_no FROM documents UNION ALL SELECT doc_id, 'message', coalesce(lang,'none')||chr(10)||coalesce(source,'none'), 1 FROM documents) SELECT doc_id, event_no, event, data FROM c""")
def server_events(spark: SparkSession, folder: str) -> DataFrame:
    """Streams of events written, broken into pieces of seven letters, and decoded again."""
    docs = table(spark, folder, "documents")
    two = F.concat(F.coalesce("lang", F.lit("none")), F.lit("\n"), F.coalesce("source", F.lit("none")))
    text = F.concat(sinks.server_event(F.lit("sources"), F.coalesce("kind", F.lit(""))), sinks.server_event(F.lit("message"), two), F.lit(": note\n"))
    pieces = docs.select("doc_id", text.alias("t")).select("doc_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.length("t") - 1, F.lit(7)), lambda k: F.substr(F.col("t"), k + 1, F.lit(7)))).alias("n", "c"))
    return streams.server_events(pieces, "doc_id", "n", "c").where("event_no < 2")


# ---- schedules and sinks -----------------------------------------------------------------------------------------------


_SCHED = "s AS (SELECT s_nationkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n, s_name AS label, (1000 + s_suppkey*37%911 + (s_suppkey*s_suppkey)%613)::DOUBLE AS v FROM supplier), t AS (SELECT *, (n-1)//3 AS g, count(*) OVER (PARTITION BY k) AS c FROM s)"


@query(f"""WITH {_SCHED}, l AS (SELECT k, label, v+y AS value, y, 'leaf' AS kind FROM t, (VALUES (0),(1),(2),(3)) yy(y) WHERE c>=3 UNION ALL SELECT k, 'Total '||chr((65+g)::INT), sum(v+y), y, 'subtotal' FROM t, (VALUES (0),(1),(2),(3)) yy(y) WHERE c>=3 GROUP BY k, g, y HAVING count(*)>1
 UNION ALL SELECT k, 'All staff', sum(v+y), y, 'grand' FROM t, (VALUES (0),(1),(2),(3)) yy(y) WHERE c>=3 AND c%3<>1 GROUP BY k, y HAVING count(*)>3) SELECT k::VARCHAR AS source_file, label, 2019+y AS year, value, kind FROM l WHERE k IN (SELECT k FROM t WHERE c>3 AND c%3<>1)""")
def printed_schedules(spark: SparkSession, folder: str) -> DataFrame:
    """Schedules of a nation's suppliers, printed in columns by year with subtotals of three and a total, and read again."""
    from pyspark.sql import Window

    s = table(spark, folder, "supplier")
    w = Window.partitionBy("s_nationkey")
    key = F.col("s_suppkey")
    rows = s.select(F.col("s_nationkey").alias("k"), F.row_number().over(w.orderBy("s_suppkey")).alias("n"), F.count(F.lit(1)).over(w).alias("c"), F.col("s_name").alias("label"), (1000 + key * 37 % 911 + (key * key) % 613).alias("v")).where("c > 3 AND c % 3 <> 1")
    rows = rows.withColumn("g", F.floor((F.col("n") - 1) / 3))
    line = lambda label, n: F.concat(F.rpad(label, 30, " "), *(F.lpad(x.cast("string"), 12, " ") for x in n))
    four = lambda v, m: [v + m * y for y in range(4)]
    leaves = rows.select("k", F.struct("g", F.lit(0).alias("a"), "n", line(F.col("label"), four(F.col("v"), 1)).alias("t")).alias("x"))
    sums = rows.groupBy("k", "g").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("m")).where("m > 1").select("k", F.struct("g", F.lit(1).alias("a"), F.lit(0).alias("n"), line(F.concat(F.lit("Total "), F.char(65 + F.col("g"))), four(F.col("v"), F.col("m"))).alias("t")).alias("x"))
    total = rows.groupBy("k").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("m")).select("k", F.struct(F.lit(10**6).cast("bigint").alias("g"), F.lit(2).alias("a"), F.lit(0).alias("n"), line(F.lit("All staff"), four(F.col("v"), F.col("m"))).alias("t")).alias("x"))
    text = leaves.unionByName(sums).unionByName(total).groupBy(F.col("k").cast("string").alias("source_file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("body"))
    head = line(F.lit("Department"), [F.lit(y) for y in range(2019, 2023)])
    files = text.select("source_file", F.concat(F.lit("Staff\n"), head, F.lit("\n"), "body", F.lit("\nSeasonal staff   9  9  9  9")).alias("value"))
    return schedules.schedules(files).where("value IS NOT NULL AND kind <> 'after'").select("source_file", "label", "year", "value", "kind")


@query(f"SELECT body, meeting_id, count(*) AS motions, sum(len(coalesce(votes,[])))::BIGINT AS votes FROM ({ONCE}) WHERE body IS NOT NULL AND meeting_id IS NOT NULL GROUP BY 1,2")
def documents_by_meeting(spark: SparkSession, folder: str) -> DataFrame:
    """A JSON document a meeting, written and read again."""
    path = _place(spark)
    sinks.by_meeting(motions_once(spark, folder).where("body IS NOT NULL AND meeting_id IS NOT NULL"), path)
    docs = spark.read.json(path)
    return docs.select("body", "meeting_id", F.size("motions").cast("bigint").alias("motions"), F.aggregate("motions", F.lit(0).cast("bigint"), lambda n, m: n + F.size(F.coalesce(m["votes"], F.array().cast(docs.schema["motions"].dataType.elementType["votes"].dataType)))).alias("votes"))


@query(f"SELECT body, date, id FROM (SELECT body, coalesce(date,'') AS date, id, row_number() OVER (PARTITION BY body ORDER BY coalesce(date,'') DESC, id DESC) AS r FROM ({ONCE_MEETINGS})) WHERE r=1")
def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The index of documents by body, newest first, written as JSON lines and read again."""
    path = _place(spark)
    sinks.roll_up(sinks.index_by_body(_meetings(spark, folder).withColumn("date", F.coalesce("date", F.lit(""))), "body", "date", ["id"]), path)
    rows = spark.read.text(path).select(F.from_json("value", "body string, entries array<struct<date:string,id:bigint>>").alias("r"))
    return rows.select("r.body", F.element_at("r.entries", 1).alias("e")).select("body", "e.date", "e.id")


@query(f"WITH o AS ({ONCE}) SELECT id, CASE WHEN page>1 THEN 'fresh' ELSE 'kept' END AS state FROM o UNION ALL SELECT -1, 'fresh'")
def upserted(spark: SparkSession, folder: str) -> DataFrame:
    """A keyed cache with fresh rows in place of old ones, appended lines among the fresh."""
    path = _place(spark)
    m = motions_once(spark, folder)
    sinks.append_lines(m.where("page > 1").select("id", F.lit("fresh").alias("state")), f"{path}/lines")
    sinks.append_lines(spark.range(1).select(F.lit(-1).cast("bigint").alias("id"), F.lit("fresh").alias("state")), f"{path}/lines")
    sinks.upsert(m.select("id", F.lit("kept").alias("state")), spark.read.schema("id bigint, state string").json(f"{path}/lines"), ["id"], f"{path}/cache")
    return spark.read.parquet(f"{path}/cache")


@query(f"""SELECT id, 'head<!--B-->'||coalesce(type,'')||'<!--E-->tail' AS page, '{{"@context":"https://schema.org","@type":"Event","name":"'||id||'"'||CASE WHEN type IS NULL THEN '' ELSE ',"about":"'||type||'"' END||'}}' AS node FROM ({ONCE_MEETINGS}) WHERE type IS NULL OR NOT regexp_matches(type,'["\\\\/]')""")
def spliced_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Generated blocks between markers, and nodes of linked data."""
    m = _meetings(spark, folder).where("type IS NULL OR NOT type RLIKE '[\"\\\\\\\\/]'")
    return m.select("id", sinks.spliced(F.lit("head<!--B-->old<!--E-->tail"), F.coalesce("type", F.lit("")), "<!--B-->", "<!--E-->").alias("page"), sinks.node("Event", name=F.col("id").cast("string"), about=F.col("type")).alias("node"))


@query("SELECT id AS body, 'page' AS name FROM bodies WHERE id IN (SELECT body FROM motions) UNION ALL SELECT NULL, 'about'")
def pages_with_records(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "bodies").select(F.col("id").alias("body"), F.lit("page").alias("name"))
    return sinks.pages_with_records(pages.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("body"), F.lit("about").alias("name"))), table(spark, folder, "motions"))


@query(f"""WITH m AS (SELECT body, id, 'minutes' AS src FROM ({ONCE_MEETINGS}) WHERE coalesce(text_chars,0)>=2500), f AS (SELECT id AS body, 0 AS id, 'fallback' AS src FROM bodies) SELECT * FROM m UNION ALL SELECT * FROM f WHERE body NOT IN (SELECT body FROM m)""")
def loaded_or_fallback(spark: SparkSession, folder: str) -> DataFrame:
    own = _meetings(spark, folder).where("coalesce(text_chars, 0) >= 2500").select("body", "id", F.lit("minutes").alias("src"))
    return sinks.loaded(own, table(spark, folder, "bodies").select(F.col("id").alias("body"), F.lit(0).cast("bigint").alias("id"), F.lit("fallback").alias("src")), "body")
