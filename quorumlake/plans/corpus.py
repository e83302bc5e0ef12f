"""Queries that build the corpus and what is printed of motions and members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.functions import dates as D
from quorumlake.functions import text as T
from quorumlake.io import table
from quorumlake.operators import corpus as C
from quorumlake.operators import records as R
from quorumlake.operators import talk
from quorumlake.operators import votes as V
from quorumlake.plans.registry import query
from quorumlake.plans.votes import AGREE, ONCE, ONCE_MEETINGS, OUTCOME, SUMMARY, VOTES, long_votes, motions_once

_CLEAN = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_NAME = "replace(coalesce({0},''),'-',' ')"


def _named(spark: SparkSession, folder: str) -> DataFrame:
    """Motions with the names of their voters."""
    name = lambda v: F.struct(F.replace(F.coalesce(v["member_id"], F.lit("")), F.lit("-"), F.lit(" ")).alias("name"), v["vote"].alias("vote"))
    return motions_once(spark, folder).withColumn("votes", F.transform("votes", name))


def _meetings(spark: SparkSession, folder: str) -> DataFrame:
    return V.once(table(spark, folder, "meetings"), "id")


_SIDE = SUMMARY.replace("vote", "v.vote")
_YES = f"list_transform(list_filter(coalesce(votes,[]), lambda v: ({_SIDE})='y'), lambda v: {_NAME.format('v.member_id')})"
_NO = f"list_transform(list_filter(coalesce(votes,[]), lambda v: ({_SIDE})='n'), lambda v: {_NAME.format('v.member_id')})"
_MOTION_DOCS = f"""SELECT body||':motion:'||id AS id, 'motion' AS kind, body, {_CLEAN.format("coalesce(nullif(headline,''), nullif(item_title,''), 'Motion')")} AS title, coalesce(date,'') AS date, 'motions.html?id='||id||'&body='||body AS url, coalesce(tags,[]) AS tags,
 array_to_string(list_filter([{", ".join(_CLEAN.format(c) for c in ("headline", "summary", "impact", "significance", "item_title", "motion"))}, CASE WHEN coalesce(outcome,'')<>'' THEN {_CLEAN.format("'Outcome: '||outcome||'.'")} END,
 {_CLEAN.format("concat_ws(' ', CASE WHEN len(y)>0 OR len(n)>0 THEN 'Vote: '||len(y)||' yes, '||len(n)||' no.' END, CASE WHEN len(y)>0 THEN 'In favor: '||array_to_string(y,', ')||'.' END, CASE WHEN len(n)>0 THEN 'Opposed: '||array_to_string(n,', ')||'.' END)")}, CASE WHEN len(tags)>0 THEN 'Topics: '||array_to_string(tags,', ')||'.' END], lambda x: x IS NOT NULL AND x<>''), ' ') AS text
 FROM (SELECT *, {_YES} AS y, {_NO} AS n FROM ({ONCE}))"""


@query(_MOTION_DOCS)
def motion_documents(spark: SparkSession, folder: str) -> DataFrame:
    return C.motion_documents(_named(spark, folder))


@query(f"""WITH h AS (SELECT meeting_id, id, {_CLEAN.format("coalesce(nullif(headline,''), item_title)")} AS head FROM ({ONCE})), r AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY id) AS r FROM h WHERE length(head)>0), l AS (SELECT meeting_id, string_agg(head, '; ' ORDER BY id) AS heads FROM r WHERE r<=40 GROUP BY 1)
SELECT body||':meeting:'||m.id AS id, 'Meeting — '||coalesce(date,'') AS title, array_to_string(list_filter(['Meeting of '||coalesce(date,'')||'.', coalesce(motion_count,0)||' motions ('||coalesce(ord_count,0)||' ordinances, '||coalesce(res_count,0)||' resolutions).', {_CLEAN.format("'Decisions included: '||heads||'.'")}, {_CLEAN.format("summary")}], lambda x: x IS NOT NULL AND x<>''), ' ') AS text FROM ({ONCE_MEETINGS}) m LEFT JOIN l ON l.meeting_id=m.id""")
def meeting_documents(spark: SparkSession, folder: str) -> DataFrame:
    return C.meeting_documents(_meetings(spark, folder), motions_once(spark, folder)).select("id", "title", "text")


def _members(spark: SparkSession, folder: str) -> DataFrame:
    """(body, member_id, name, role, start, end): who votes in a body, with the first and last day of a vote."""
    votes = motions_once(spark, folder).select("body", "date", F.explode("votes").alias("v"))
    rows = votes.where("v.member_id IS NOT NULL").groupBy("body", F.col("v.member_id").alias("member_id")).agg(F.min(F.nullif(F.col("date"), F.lit(""))).alias("start"), F.max(F.nullif(F.col("date"), F.lit(""))).alias("end"))
    return rows.withColumns({"name": F.replace(F.col("member_id"), F.lit("-"), F.lit(" ")), "role": F.lit("Member")})


_MEMBERS = f"mb AS (SELECT body, v.member_id AS member_id, min(nullif(date,'')) AS s, max(nullif(date,'')) AS e FROM (SELECT body, date, unnest(votes) AS v FROM ({ONCE})) WHERE v.member_id IS NOT NULL GROUP BY 1,2)"


@query(f"""WITH {VOTES}, {_MEMBERS}, c AS (SELECT member_id, count(*) AS n, count(*) FILTER (({SUMMARY})='y') AS y, count(*) FILTER (({SUMMARY})='n') AS o FROM votes_long GROUP BY 1)
SELECT body||':member:'||member_id AS id, {_CLEAN.format("replace(member_id,'-',' ')||' — Member. Term: '||coalesce(s,'')||' to '||coalesce(e,'present')||'. Cast '||n||' recorded votes on file: '||y||' yes, '||o||' no.'")} AS text FROM mb JOIN c USING(member_id)""")
def member_documents(spark: SparkSession, folder: str) -> DataFrame:
    return C.member_documents(_members(spark, folder), long_votes(spark, folder)).select("id", "text")


@query(f"""WITH {_MEMBERS}, o AS ({ONCE}), h AS (SELECT body, count(*) AS meetings FROM ({ONCE_MEETINGS}) GROUP BY 1), m AS (SELECT body, count(*) AS motions, coalesce(sum(len(votes)),0)::BIGINT AS votes FROM o GROUP BY 1),
t AS (SELECT body, tag, count(*) AS n, row_number() OVER (PARTITION BY body ORDER BY count(*) DESC, tag) AS r FROM (SELECT body, unnest(tags) AS tag FROM o) GROUP BY 1,2), tt AS (SELECT body, string_agg(tag||' ('||n||')', ', ' ORDER BY r) AS topics FROM t WHERE r<=8 GROUP BY 1),
p AS (SELECT body, string_agg(DISTINCT replace(member_id,'-',' ')||' (Member)', ', ' ORDER BY replace(member_id,'-',' ')||' (Member)') AS people FROM mb GROUP BY 1)
SELECT b.id||':overview:all' AS id, {_CLEAN.format("'These are the records of the '||coalesce(label,b.id)||'. They cover '||meetings||' meetings, '||coalesce(motions,0)||' motions, and '||coalesce(votes,0)||' recorded votes. Common topics: '||coalesce(topics,'')||'. People on record: '||coalesce(people,'')||'.'")} AS text FROM bodies b JOIN h ON h.body=b.id LEFT JOIN m ON m.body=b.id LEFT JOIN tt ON tt.body=b.id LEFT JOIN p ON p.body=b.id""")
def overview_documents(spark: SparkSession, folder: str) -> DataFrame:
    return C.overview_documents(table(spark, folder, "bodies"), _meetings(spark, folder), motions_once(spark, folder), _members(spark, folder)).select("id", "text")


def _transcripts(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines").groupBy("meeting_id", "line_no").agg(F.min("line").alias("line"))
    texts = lines.groupBy(F.col("meeting_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", F.coalesce("line", F.lit("")).alias("line")))), lambda x: x["line"]), " ").alias("text"))
    return texts.join(_meetings(spark, folder).select("id", "body", "date", F.col("type").alias("title")), "id")


@query(f"""WITH l AS (SELECT DISTINCT meeting_id, line_no, min(line) OVER (PARTITION BY meeting_id, line_no) AS line FROM transcript_lines), t AS (SELECT meeting_id AS id, list_filter(string_split({_CLEAN.format("string_agg(coalesce(line,''), ' ' ORDER BY line_no)")}, ' '), lambda x: x<>'') AS w FROM l GROUP BY 1),
k AS (SELECT id, unnest(range(0, len(w), 190)) AS i, w FROM t WHERE len(w)>0) SELECT m.body||':transcript:'||k.id||':'||i AS id, 'Transcript — '||coalesce(nullif({_CLEAN.format("m.type")},''),'Meeting')||' ('||coalesce(m.date,'')||')' AS title, array_to_string(w[i+1:i+230],' ') AS text FROM k JOIN ({ONCE_MEETINGS}) m ON m.id=k.id WHERE length(array_to_string(w[i+1:i+230],' '))>=60""")
def transcript_documents(spark: SparkSession, folder: str) -> DataFrame:
    return C.transcript_documents(_transcripts(spark, folder)).select("id", "title", "text")


@query(f"""SELECT body||':meeting:'||id AS id, coalesce(nullif({_CLEAN.format("type")},''),'Meeting')||' — '||coalesce(date,'')||' (no minutes yet)' AS title, array_to_string(list_filter(['Meeting of '||coalesce(date,'')||'.', 'No minutes are published.', {_CLEAN.format("summary")}], lambda x: x IS NOT NULL AND x<>''), ' ') AS text FROM ({ONCE_MEETINGS}) m WHERE NOT coalesce(text_chars>=2500, false)""")
def unminuted_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Meetings whose minutes are short scans count as not minuted."""
    minuted = _meetings(spark, folder).where("text_chars >= 2500").select("id")
    return C.unminuted_documents(_meetings(spark, folder).withColumn("title", F.col("type")), minuted, "No minutes are published.").select("id", "title", "text")


@query(f"""WITH {_MEMBERS} SELECT 'motion' AS kind, count(*) AS n FROM ({ONCE}) UNION ALL SELECT 'meeting', count(*) FROM ({ONCE_MEETINGS}) UNION ALL SELECT 'member', count(*) FROM mb UNION ALL SELECT 'overview', count(*) FROM bodies WHERE id IN (SELECT body FROM meetings)""")
def corpus_kinds(spark: SparkSession, folder: str) -> DataFrame:
    meetings, motions, members = _meetings(spark, folder), _named(spark, folder), _members(spark, folder)
    return C.kinds(C.union(C.motion_documents(motions), C.meeting_documents(meetings, motions), C.member_documents(members, long_votes(spark, folder)), C.overview_documents(table(spark, folder, "bodies"), meetings, motions, members)))


@query("""WITH s AS (SELECT DISTINCT m.body, s.name, coalesce(s.basis,'none') AS role FROM speakers s JOIN (SELECT DISTINCT id, body FROM meetings) m ON m.id=s.meeting_id WHERE s.name IS NOT NULL),
u AS (SELECT body, max_by(role, (n, role)) AS usual FROM (SELECT body, role, count(*) AS n FROM s GROUP BY 1,2) GROUP BY 1), l AS (SELECT body, string_agg(DISTINCT CASE WHEN role=usual THEN name ELSE name||' ('||role||')' END, ', ' ORDER BY CASE WHEN role=usual THEN name ELSE name||' ('||role||')' END) AS names FROM s JOIN u USING(body) GROUP BY 1),
c AS (SELECT name FROM s WHERE body=(SELECT min(body) FROM s)), x AS (SELECT DISTINCT body FROM s WHERE name IN (SELECT name FROM c))
SELECT b.id AS body, coalesce(label||' members: '||names||'.', 'No roster is on file for this body.') AS text, (names IS NOT NULL AND b.id NOT IN (SELECT body FROM x)) AS apart FROM bodies b LEFT JOIN l ON l.body=b.id""")
def rosters(spark: SparkSession, folder: str) -> DataFrame:
    where = table(spark, folder, "meetings").select(F.col("id").alias("meeting_id"), "body").distinct()
    people = table(spark, folder, "speakers").where("name IS NOT NULL").join(where, "meeting_id").select("body", "name", F.coalesce("basis", F.lit("none")).alias("role"), F.lit(True).alias("serving")).distinct()
    first = people.agg(F.min("body").alias("body"))
    return C.roster(people, people.join(first, "body", "left_semi"), table(spark, folder, "bodies"))


# ---- what is printed -----------------------------------------------------------------------------------------

_COUNTS = f"""c AS (SELECT id, outcome, headline, item_title, len(list_filter(coalesce(votes,[]), lambda v: lower(coalesce(v.vote,'')) IN ('yes','aye'))) AS y, len(list_filter(coalesce(votes,[]), lambda v: lower(coalesce(v.vote,'')) IN ('no','nay'))) AS n, len(coalesce(votes,[])) AS t FROM ({ONCE})),
d AS (SELECT *, t-y-n AS x, lower(coalesce(outcome,'')) AS o, regexp_replace(trim(coalesce(outcome,'')),'[.]$','') AS raw, (trim(coalesce(outcome,''))='' OR coalesce(contains(lower(outcome),'not found'),false)) AS unknown FROM c),
e AS (SELECT *, {OUTCOME} AS k FROM d), f AS (SELECT *, CASE WHEN k='passed' THEN 'Passed' WHEN k='failed' THEN 'Failed' WHEN raw='' THEN 'Decided' ELSE upper(left(raw,1))||substr(raw,2) END AS word, y||'–'||n||CASE WHEN x>0 THEN '–'||x ELSE '' END AS tally FROM e)"""


@query(f"""WITH {_COUNTS} SELECT id AS motion_id, word, CASE WHEN unknown THEN 'other' ELSE k END AS pill, CASE WHEN unknown THEN 'Not recorded' WHEN k='other' THEN word ELSE k END AS label,
CASE WHEN unknown AND t=0 THEN 'The minutes don’t record a result or a roll-call vote for this motion.' WHEN unknown THEN 'The minutes don’t state the result. The roll call was '||tally||'.' WHEN t=0 THEN word||'. No roll-call vote was recorded.' WHEN k='passed' AND n=0 AND x=0 THEN 'Passed unanimously, '||y||'–0.' ELSE word||' '||tally||' ('||y||' yes, '||n||' no'||CASE WHEN x>0 THEN ', '||x||' other' ELSE '' END||').' END AS sentence FROM f""")
def outcome_sentences(spark: SparkSession, folder: str) -> DataFrame:
    low = lambda v: F.lower(F.coalesce(v["vote"], F.lit("")))
    votes = F.coalesce("votes", F.array())
    m = motions_once(spark, folder).withColumns({"y": F.size(F.filter(votes, lambda v: low(v).isin("yes", "aye"))), "n": F.size(F.filter(votes, lambda v: low(v).isin("no", "nay"))), "t": F.size(votes)})
    o = F.col("outcome")
    pill, label = T.outcome_pill(o)
    return m.select(F.col("id").alias("motion_id"), T.outcome_word(o).alias("word"), pill.alias("pill"), label.alias("label"), T.outcome_sentence(o, F.col("y"), F.col("n"), F.col("t") - F.col("y") - F.col("n")).alias("sentence"))


@query(f"""WITH t AS (SELECT id, headline, {_CLEAN.format("regexp_replace(item_title, '(?i)^((?:A\\s+)?Resolution|(?:An\\s+)?Ordinance)\\s+of(?:\\s+the\\s+City\\s+of)?\\s+[A-Z][a-z]+,?\\s*', '\\1 ')")} AS c FROM ({ONCE})), h AS (SELECT *, left(c,140) AS h, 140-strpos(reverse(left(c,140)),' ') AS cut_at FROM t)
SELECT id AS motion_id, c AS title, coalesce(nullif(headline,''), CASE WHEN coalesce(c,'')='' THEN '(no title)' WHEN length(c)<=140 THEN c ELSE regexp_replace(CASE WHEN contains(h,' ') AND cut_at>60 THEN left(h,cut_at) ELSE h END, '[,;:.\\s]+$', '')||'…' END) AS shown FROM h""")
def motion_titles(spark: SparkSession, folder: str) -> DataFrame:
    title = T.clean_title(F.col("item_title"), "[A-Z][a-z]+")
    return motions_once(spark, folder).select(F.col("id").alias("motion_id"), title.alias("title"), T.motion_title(F.col("headline"), title).alias("shown"))


@query(f"""SELECT id, CASE WHEN d IS NULL THEN coalesce(date,'') ELSE strftime(d,'%-d %B %Y') END AS long, CASE WHEN d IS NULL THEN coalesce(date,'') ELSE strftime(d,'%b %-d, %Y') END AS short, CASE WHEN d IS NULL THEN coalesce(date,'') ELSE strftime(d,'%A, %B %-d, %Y') END AS weekday, epoch(greatest(d, loaded_at))::BIGINT AS newest FROM (SELECT *, try_strptime(left(date,10),'%Y-%m-%d') AS d FROM ({ONCE_MEETINGS}))""")
def printed_dates(spark: SparkSession, folder: str) -> DataFrame:
    d = F.col("date")
    newest = D.newest(D.instant(d), D.instant(F.date_format("loaded_at", "yyyy-MM-dd'T'HH:mm:ss")))
    return _meetings(spark, folder).select("id", D.day_month_year(d).alias("long"), D.month_day_year(d).alias("short"), D.weekday_date(d).alias("weekday"), F.unix_seconds(newest).alias("newest"))


@query("""SELECT line_id, trim(regexp_replace(line, '^\\s*(?:Speaker\\s+[A-Z0-9]+|[A-Z][a-zA-Z.''-]+(?:\\s+[A-Z][a-zA-Z.''-]+){0,3})\\s*:\\s*', '')) AS said FROM transcript_lines""")
def without_speakers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "transcript_lines").select("line_id", T.without_speaker(F.col("line")).alias("said"))


def _re2(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


@query(f"""WITH q AS (SELECT doc_id, left(text, 200) AS q FROM documents), b AS (SELECT doc_id, min(id) AS body FROM (SELECT DISTINCT q.doc_id, b.id FROM q JOIN bodies b ON contains(lower(q), lower(label)) AND label<>'') GROUP BY 1)
SELECT doc_id, regexp_matches(q, {_re2(T.IDENTITY)}) AS identity, regexp_matches(q, {_re2(T.TEMPORAL)}) AS temporal, regexp_matches(q, {_re2(T.DISCUSSION)}) AS discussion, coalesce(b.body, 'none') AS body FROM q LEFT JOIN b USING(doc_id)""")
def question_cues(spark: SparkSession, folder: str) -> DataFrame:
    """Cues of questions, over the beginnings of all documents."""
    asked = table(spark, folder, "documents").select("doc_id", F.left("text", F.lit(200)).alias("q"))
    cues = T.question_cues(F.col("q"))
    named = T.named_body(asked, "q", table(spark, folder, "bodies"), "none")
    return named.select("doc_id", *(c.alias(n) for n, c in cues.items()), "body")


# ---- members, tops and orders ----------------------------------------------------------------------------------


@query(f"""WITH {_MEMBERS}, {VOTES}, t AS (SELECT member_id, count(*) AS n FROM votes_long GROUP BY 1) SELECT body, member_id, place FROM (SELECT body, member_id, row_number() OVER (PARTITION BY body ORDER BY CASE WHEN contains(member_id,'chair') OR contains(member_id,'mayor') THEN 0 ELSE 1 END, coalesce(s,'9999'), -coalesce(n,0), member_id) AS place FROM mb LEFT JOIN t USING(member_id))""")
def member_order(spark: SparkSession, folder: str) -> DataFrame:
    totals = long_votes(spark, folder).groupBy("member_id").agg(F.count(F.lit(1)).alias("n"))
    return R.in_order(_members(spark, folder).join(totals, "member_id", "left"), "body", [(~F.col("member_id").rlike("chair|mayor")).cast("int"), F.coalesce("start", F.lit("9999")), -F.coalesce("n", F.lit(0)), F.col("member_id")]).select("body", "member_id", "place")


@query(f"""WITH {VOTES}, a AS (SELECT least(x.member_id,y.member_id) AS a, greatest(x.member_id,y.member_id) AS b, avg((x.k=y.k)::INT::DOUBLE) AS agreement, count(*) AS n FROM (SELECT *, {AGREE} AS k FROM votes_long) x JOIN (SELECT *, {AGREE} AS k FROM votes_long) y ON x.motion_id=y.motion_id AND x.pos<y.pos GROUP BY 1,2 HAVING count(*)>=10),
b AS (SELECT a AS member_id, b AS other, agreement, n FROM a WHERE a<>b UNION ALL SELECT b, a, agreement, n FROM a WHERE a<>b) SELECT member_id, other, round(agreement,6) AS agreement, n, row_number() OVER (PARTITION BY member_id ORDER BY round(agreement,6) DESC, other) AS place FROM b""")
def agreement_order(spark: SparkSession, folder: str) -> DataFrame:
    """Whom each member agrees with, of pairs with ten votes or more together."""
    pairs = V.pair_agreement(long_votes(spark, folder)).where("n >= 10 AND a <> b")
    both = pairs.select(F.col("a").alias("member_id"), F.col("b").alias("other"), "agreement", "n").unionByName(pairs.select(F.col("b").alias("member_id"), F.col("a").alias("other"), "agreement", "n"))
    return R.in_order(both, "member_id", [F.desc("agreement"), F.col("other")])


@query(f"""WITH v AS (SELECT v.member_id AS member_id, tags FROM (SELECT unnest(votes) AS v, tags FROM ({ONCE}))), t AS (SELECT member_id, tag, count(*) AS n FROM (SELECT member_id, unnest(tags) AS tag FROM v WHERE member_id IS NOT NULL) GROUP BY 1,2) SELECT member_id, tag, n, place FROM (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY n DESC, tag) AS place FROM t) WHERE place<=20""")
def top_tags(spark: SparkSession, folder: str) -> DataFrame:
    rows = motions_once(spark, folder).select(F.explode("votes").alias("v"), "tags").where("v.member_id IS NOT NULL").select(F.col("v.member_id").alias("member_id"), F.explode("tags").alias("tag"))
    return R.in_order(rows.groupBy("member_id", "tag").agg(F.count(F.lit(1)).alias("n")), "member_id", [F.desc("n"), F.col("tag")], 20)


@query(f"SELECT id AS motion_id, body, date FROM ({ONCE}) WHERE coalesce(headline,'')<>'' ORDER BY coalesce(date,'') DESC, id DESC LIMIT 100")
def latest_headlined(spark: SparkSession, folder: str) -> DataFrame:
    return R.latest(motions_once(spark, folder).where("coalesce(headline, '') <> ''"), "date", "id", 100).select(F.col("id").alias("motion_id"), "body", "date")


@query(f"SELECT body, id, place FROM (SELECT body, id, row_number() OVER (PARTITION BY body ORDER BY coalesce(date,'') DESC, id DESC) AS place FROM ({ONCE_MEETINGS}) WHERE coalesce(date,'')>='2015-01-01') WHERE place<=4")
def newest_since(spark: SparkSession, folder: str) -> DataFrame:
    """The newest four meetings of each body since a day."""
    rows = _meetings(spark, folder).where("coalesce(date, '') >= '2015-01-01'")
    return R.in_order(rows, "body", [F.desc(F.coalesce("date", F.lit(""))), F.desc("id")], 4).select("body", "id", "place")


@query(f"SELECT body, id, place, place<=3 AS looked_at FROM (SELECT body, id, row_number() OVER (PARTITION BY body ORDER BY date, id) AS place FROM ({ONCE_MEETINGS}) WHERE date>='2015-06-01') WHERE place<=6")
def horizon(spark: SparkSession, folder: str) -> DataFrame:
    """The next six meetings of each body, of which the agendas of three are looked at."""
    rows = R.in_order(_meetings(spark, folder).where("date >= '2015-06-01'"), "body", [F.col("date"), F.col("id")], 6)
    return rows.select("body", "id", "place", (F.col("place") <= 3).alias("looked_at"))


@query(f"""WITH o AS ({ONCE}), m AS ({ONCE_MEETINGS}), d AS (SELECT body, m.date, m.id AS meeting_id, list({{'id': o.id, 'title': o.item_title}} ORDER BY coalesce(o.date,'') DESC, o.id DESC) AS items FROM m JOIN o ON o.meeting_id=m.id GROUP BY ALL) SELECT meeting_id, len(items) AS n, items[1].id AS first_id, items[-1].id AS last_id FROM d""".replace("body, m.date", "m.body, m.date"))
def grouped_motions(spark: SparkSession, folder: str) -> DataFrame:
    """Motions under their meetings, newest first."""
    grouped = R.grouped(_meetings(spark, folder), motions_once(spark, folder).withColumn("date", F.coalesce("date", F.lit(""))), "meeting_id", ["date", "id"], ["item_title"])
    return grouped.select(F.col("id").alias("meeting_id"), F.size("items").cast("bigint").alias("n"), F.element_at("items", 1)["id"].alias("first_id"), F.element_at("items", -1)["id"].alias("last_id"))


@query("SELECT topic, category, count(*) AS n FROM (SELECT unnest(tags) AS topic, kind AS category FROM documents) GROUP BY 1,2")
def topic_counts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.explode("tags").alias("topic"), F.col("kind").alias("category")).groupBy("topic", "category").agg(F.count(F.lit(1)).alias("n"))


# ---- talk --------------------------------------------------------------------------------------------------------

_TURNS = "t AS (SELECT meeting_id, letter AS speaker, line_no*3.0 AS s, line_no*3.0 + 1 + length(line)/12.0 AS e, name, len(list_filter(string_split(line,' '), lambda x: x<>'')) AS words FROM (SELECT l.meeting_id, l.line_no, min(l.line) AS line, min(regexp_extract(l.line,'^Speaker ([A-Z]):',1)) AS letter FROM transcript_lines l GROUP BY 1,2) JOIN (SELECT meeting_id AS mid, letter AS lt, min(name) AS name FROM speakers GROUP BY 1,2) s ON s.mid=meeting_id AND s.lt=letter WHERE letter<>'')"


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "transcript_lines").groupBy("meeting_id", "line_no").agg(F.min("line").alias("line"), F.min(F.regexp_extract("line", "^Speaker ([A-Z]):", 1)).alias("speaker")).where("speaker <> ''")
    names = table(spark, folder, "speakers").groupBy("meeting_id", F.col("letter").alias("speaker")).agg(F.min("name").alias("name"))
    start = F.col("line_no") * 3.0
    return lines.join(names, ["meeting_id", "speaker"]).select("meeting_id", "speaker", "name", start.alias("s"), (start + 1 + F.length("line") / 12.0).alias("e"), F.size(F.filter(F.split("line", " "), lambda x: x != "")).alias("words"))


@query(f"WITH {_TURNS} SELECT meeting_id, speaker, count(*) AS turns, count(*) FILTER (e-s>=4) AS usable, round(sum(e-s),4) AS seconds, row_number() OVER (PARTITION BY meeting_id ORDER BY sum(e-s) DESC, speaker) AS place FROM t GROUP BY 1,2")
def speaker_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return talk.speaker_statistics(_turns(spark, folder), "meeting_id", "speaker", "s", "e").withColumn("seconds", F.round("seconds", 4))


@query(f"WITH {_TURNS} SELECT meeting_id, count(*) AS turns, sum(words)::BIGINT AS words, coalesce(sum(words) FILTER (name IS NOT NULL),0)::BIGINT AS named, count(DISTINCT name) AS voices, round(coalesce(sum(words) FILTER (name IS NOT NULL),0)/sum(words)::DOUBLE,6) AS share FROM t GROUP BY 1")
def word_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return talk.coverage(_turns(spark, folder), "meeting_id", "name", "words").withColumn("share", F.round("share", 6))


_MARKS = """k AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, ((floor(epoch(ts))::BIGINT % 7200) // 60) AS mi, event_type FROM events), mk AS (SELECT user_id, n, event_type AS label, CASE WHEN mi<60 THEN mi||':'||lpad((n%60)::VARCHAR,2,'0') ELSE '1:'||lpad((mi-60)::VARCHAR,2,'0')||':'||lpad((n%60)::VARCHAR,2,'0') END AS mark FROM k),
r AS (SELECT *, len(string_split(mark,':'))=2 AS two, CASE WHEN len(string_split(mark,':'))=3 THEN string_split(mark,':')[1]::INT*3600+string_split(mark,':')[2]::INT*60+string_split(mark,':')[3]::INT ELSE string_split(mark,':')[1]::INT*3600+string_split(mark,':')[2]::INT*60 END AS ah, CASE WHEN len(string_split(mark,':'))=3 THEN string_split(mark,':')[1]::INT*3600+string_split(mark,':')[2]::INT*60+string_split(mark,':')[3]::INT ELSE string_split(mark,':')[1]::INT*60+string_split(mark,':')[2]::INT END AS am FROM mk),
b AS (SELECT *, (ah<lag(ah) OVER w)::INT AS bh, (am<lag(am) OVER w)::INT AS bm FROM r WINDOW w AS (PARTITION BY user_id ORDER BY n)), ln AS (SELECT user_id, CASE WHEN user_id%5=0 THEN NULL ELSE 600*(1+user_id%9) END AS d FROM (SELECT DISTINCT user_id FROM events)),
s AS (SELECT user_id, bool_or(two) AS two, coalesce(sum(bh),0) AS bh, coalesce(sum(bm),0) AS bm, max(CASE WHEN two THEN ah END) AS lh, max(CASE WHEN two THEN am END) AS lm FROM b GROUP BY 1),
sc AS (SELECT user_id, d, CASE WHEN NOT two THEN 'hms' WHEN coalesce(d,0)=0 THEN 'hm' WHEN bm<bh OR (bm=bh AND CASE WHEN lm>0 THEN abs(ln(lm/d)) ELSE 1e300 END < CASE WHEN lh>0 THEN abs(ln(lh/d)) ELSE 1e300 END) THEN 'ms' ELSE 'hm' END AS scale FROM s JOIN ln USING(user_id))"""


def _marks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Marks of time of each user's events, in minutes up to an hour and in hours beyond, and lengths of recordings, some missing."""
    from pyspark.sql import Window

    e = table(spark, folder, "events").withColumn("n", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    minutes = F.floor(F.pmod(F.unix_seconds(F.col("ts").cast("timestamp")), F.lit(7200)) / 60)
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    mark = F.when(minutes < 60, F.concat(minutes.cast("string"), F.lit(":"), two(F.col("n") % 60))).otherwise(F.concat(F.lit("1:"), two(minutes - 60), F.lit(":"), two(F.col("n") % 60)))
    lengths = e.select("user_id").distinct().withColumn("d", F.when(F.col("user_id") % 5 != 0, 600 * (1 + F.col("user_id") % 9)))
    return e.select("user_id", "n", F.col("event_type").alias("label"), mark.alias("mark")), lengths


@query(f"WITH {_MARKS} SELECT user_id, scale FROM sc")
def mark_scales(spark: SparkSession, folder: str) -> DataFrame:
    marks, lengths = _marks(spark, folder)
    return talk.scale(marks, lengths, "user_id", "n", "mark", "d")


@query(f"WITH {_MARKS} SELECT user_id, label, (CASE WHEN scale='ms' THEN am ELSE ah END)::INT AS seconds, 'after the end of the recording' AS problem FROM r JOIN sc USING(user_id) WHERE CASE WHEN scale='ms' THEN am ELSE ah END > d+120 UNION ALL SELECT user_id, NULL, count(*)::INT, 'no recording to check the marks against' FROM r JOIN sc USING(user_id) WHERE d IS NULL GROUP BY 1")
def late_marks(spark: SparkSession, folder: str) -> DataFrame:
    marks, lengths = _marks(spark, folder)
    return talk.beyond_recording(marks, lengths, "user_id", "n", "label", "mark", "d")
