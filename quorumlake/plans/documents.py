"""Queries over documents put together from the tables: minutes and agendas as lines of print.

The motions of a meeting are printed as minutes (heading, motion, roll call with a page head in it, outcome) or as an agenda;
the parsers read the print, and the SQL says from the tables what must come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumlake.functions import dates as D
from quorumlake.io import table
from quorumlake.operators import agenda as A
from quorumlake.operators import align
from quorumlake.operators import minutes as M
from quorumlake.plans.registry import query
from quorumlake.plans.votes import ONCE, motions_once

_PAGE_HEAD = "Council Minutes Page 3 of 9"


def printed_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, page, line_no, line): the motions of each meeting as its minutes would print them, a page each."""
    m = motions_once(spark, folder).where("meeting_id IS NOT NULL").withColumn("page", F.row_number().over(Window.partitionBy("meeting_id").orderBy("id")))
    rows = lambda x: F.split(F.coalesce(x, F.lit("")), "\r?\n")
    sort = F.when(F.lower(F.coalesce("business_type", F.lit(""))).contains("ord"), "ORDINANCE").otherwise("RESOLUTION")
    title = F.concat(F.lit("7.A. "), sort, F.lit(" – "), F.coalesce("item_title", F.lit("")))
    heading = F.when(F.trim(F.coalesce("item_title", F.lit(""))) != "", rows(title)).otherwise(F.array().cast("array<string>"))
    votes = F.transform(F.coalesce("votes", F.array().cast(m.schema["votes"].dataType)), lambda v: F.concat(F.replace(F.coalesce(v["member_id"], F.lit("")), F.lit("-"), F.lit(" ")), F.lit(" "), F.coalesce(v["vote"], F.lit(""))))
    call = F.concat(F.slice(votes, 1, 1), F.array(F.lit(_PAGE_HEAD)), F.slice(votes, 2, 1_000_000))
    outcome = F.when(F.coalesce("outcome", F.lit("")) != "", F.array(F.concat(F.lit("The motion "), "outcome"))).otherwise(F.array().cast("array<string>"))
    lines = F.concat(heading, rows(F.concat(F.lit("MOTION: "), F.coalesce("motion", F.lit("")))), call, outcome)
    return m.select(F.col("meeting_id").cast("string").alias("source_file"), "page", F.posexplode(lines).alias("line_no", "line"))


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_VOTE = f"regexp_matches(x, {_sql(M.VOTE)}) AND NOT regexp_matches(x, '(?i)^councilmember | moved to ') AND len(regexp_split_to_array(x, '\\s+')) BETWEEN 2 AND 5"
_HEAD = "contains(x,'Council Minutes') AND contains(x,'Page') AND contains(x,'of')"
_CLEAN = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"
_KEPT = "list_filter(list_transform({0}, lambda s: trim(s)), lambda x: x<>'' AND NOT (" + _HEAD + "))"
_FIRST = "coalesce(list_position(list_transform({0}, lambda x: {1}), true), 1000000)"
_PROCEDURAL = f"(regexp_matches(low, {_sql(M.CLOSED)}) OR ((regexp_matches(low, {_sql(M.ADJOURNED)}) OR (NOT consent AND regexp_matches(low, 'adjourn at \\d'))) AND NOT contains(low,'closed session')))"
MINUTES = f"""o AS ({ONCE}),
p AS (SELECT id, meeting_id::VARCHAR AS source_file, row_number() OVER (PARTITION BY meeting_id ORDER BY id) AS page, CASE WHEN contains(lower(coalesce(business_type,'')),'ord') THEN 'Ordinance' ELSE 'Resolution' END AS sort, trim(coalesce(item_title,''))<>'' AS headed,
 {_KEPT.format("regexp_split_to_array(coalesce(item_title,''), '\\r?\\n')")} AS t, {_KEPT.format("regexp_split_to_array('MOTION: '||coalesce(motion,''), '\\r?\\n')")} AS m, {_KEPT.format("list_transform(coalesce(votes,[]), lambda v: replace(coalesce(v.member_id,''),'-',' ')||' '||coalesce(v.vote,''))")} AS v, coalesce(outcome,'') AS oc FROM o WHERE meeting_id IS NOT NULL),
q AS (SELECT *, list_concat(list_concat(m[2:], v), CASE WHEN oc<>'' THEN [trim('The motion '||oc)] ELSE [] END) AS rest FROM p),
r AS (SELECT *, {_FIRST.format("rest", f"({_VOTE}) OR regexp_matches(x, {_sql(M.TEXT_ENDS)})")} AS te, {_FIRST.format("t", f"regexp_matches(x, {_sql(M.DIVIDERS)}) OR regexp_matches(x, '^The recording')")} AS tte FROM q),
s AS (SELECT *, te - 1 + {_FIRST.format("rest[te:]", f"NOT ({_VOTE})")} AS ce FROM r),
u AS (SELECT source_file, page, sort, headed, rest[te:ce-1] AS call, rest[ce] AS last, {_CLEAN.format("array_to_string(list_concat([trim(regexp_extract(m[1], '(?i)^MOTION:\\s*(.*)$', 1))], rest[:te-1]), ' ')")} AS said, array_to_string(list_filter(list_concat([trim(t[1])], t[2:tte-1]), lambda x: x<>''), ' ') AS title FROM s),
w AS (SELECT *, CASE WHEN said='' THEN 'MOTION:' ELSE said END AS motion, trim(regexp_extract(coalesce(last,''), {_sql(M.OUTCOME)}, 1)) AS told FROM u),
x AS (SELECT *, lower({_CLEAN.format("motion")}) AS low, contains(lower(motion),'consent agenda') AND contains(lower(motion),'moved') AS consent, {_CLEAN.format(f"regexp_extract(motion, {_sql(M.INLINE)}, 1)")} AS inl,
 rtrim({_CLEAN.format(f"regexp_extract(motion, {_sql(M.preamble())}, 1)")}, '.') AS named, {_CLEAN.format(f"regexp_extract(motion, {_sql(M.NUMBERED)}, 1)")} AS num, rtrim({_CLEAN.format(f"regexp_extract(motion, {_sql(M.ACTION)}, 1)")}, '.,') AS act FROM w),
y AS (SELECT * FROM x WHERE NOT {_PROCEDURAL}),
parsed AS (SELECT source_file, row_number() OVER (PARTITION BY source_file ORDER BY page) - 1 AS motion_no, page, motion, call,
 CASE WHEN consent THEN 'Consent' WHEN headed THEN '7.A.' ELSE '' END AS agenda_ref,
 CASE WHEN consent THEN 'Consent batch' WHEN headed THEN sort WHEN named<>'' THEN CASE WHEN regexp_matches(array_to_string(string_split(lower(named),' ')[1:3],' '),'(^| )ordinance( |$)') THEN 'Ordinance' ELSE 'Resolution' END WHEN num<>'' THEN CASE WHEN contains(lower(num),'ordinance') THEN 'Ordinance' ELSE 'Resolution' END ELSE '{M.OTHER}' END AS business_type,
 CASE WHEN consent THEN '{M.CONSENT_TITLE}' WHEN headed THEN CASE WHEN title='' THEN '7.A. '||sort ELSE title END WHEN named<>'' THEN upper(left(named,1))||substr(named,2) WHEN num<>'' THEN num WHEN length(act)>96 THEN rtrim(upper(left(act,1))||substr(act,2,94))||'…' ELSE upper(left(act,1))||substr(act,2) END AS item_title,
 CASE WHEN told<>'' THEN CASE WHEN regexp_matches(told,'[.!]$') THEN told ELSE told||'.' END WHEN inl<>'' THEN CASE WHEN regexp_matches(inl,'[.!]$') THEN inl ELSE inl||'.' END WHEN len(call)>0 THEN '{M.NO_OUTCOME}' ELSE '' END AS outcome FROM y)"""
_NAME = f"trim(regexp_extract(c, {_sql(M.VOTE)}, 1))"
_VOTED = f"regexp_extract(c, {_sql(M.VOTE)}, 2)"


@query(f"WITH {MINUTES} SELECT source_file, motion_no, page, agenda_ref, business_type, item_title, motion, outcome, array_to_string(list_sort(list_transform(call, lambda c: {_NAME}||': '||{_VOTED})), '; ') AS roll_call FROM parsed")
def minutes_motions(spark: SparkSession, folder: str) -> DataFrame:
    return M.document_tables(printed_minutes(spark, folder))["motions"].drop("meeting_date")


@query(f"WITH {MINUTES} SELECT source_file, page, pos, {_NAME} AS member, {_VOTED} AS vote, CASE WHEN length(motion)>500 THEN left(motion,500)||'…' ELSE motion END AS motion_excerpt FROM (SELECT source_file, page, motion, unnest(call) AS c, unnest(range(len(call))) AS pos FROM parsed)")
def minutes_votes(spark: SparkSession, folder: str) -> DataFrame:
    return M.document_tables(printed_minutes(spark, folder))["votes"].select("source_file", "page", "pos", "member", "vote", "motion_excerpt")


@query(f"""WITH {MINUTES}, l AS (SELECT source_file, page, unnest(list_concat(list_concat(list_concat(CASE WHEN headed THEN regexp_split_to_array('7.A. '||upper(sort)||' – '||it, '\\r?\\n') ELSE [] END, regexp_split_to_array('MOTION: '||mo, '\\r?\\n')), list_transform(vo, lambda z: replace(coalesce(z.member_id,''),'-',' ')||' '||coalesce(z.vote,''))), CASE WHEN oc<>'' THEN ['The motion '||oc] ELSE [] END)) AS line
 FROM (SELECT p.*, coalesce(o.item_title,'') AS it, coalesce(o.motion,'') AS mo, coalesce(o.votes,[]) AS vo FROM p JOIN o USING(id)))
SELECT source_file, word, count(*) AS lines FROM l, (VALUES ('ordinance'),('resolution')) w(word) WHERE regexp_matches(lower(line), '(^|[^a-z0-9_])'||word||'([^a-z0-9_]|$)') GROUP BY 1,2""")
def minutes_hits(spark: SparkSession, folder: str) -> DataFrame:
    tables = M.document_tables(printed_minutes(spark, folder))
    both = tables["ordinances"].withColumn("word", F.lit("ordinance")).unionByName(tables["resolutions"].withColumn("word", F.lit("resolution")))
    return both.groupBy("source_file", "word").agg(F.count(F.lit(1)).alias("lines"))


def printed_agendas(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, value): the motions of each meeting as its agenda would print them.

    A motion with an agenda reference has a heading of its own; the others are items under a number of their own.  Above
    the first stands a letterhead and a session, above the second a group and a session with public comments.
    """
    n = F.row_number().over(Window.partitionBy("meeting_id").orderBy("id"))
    m = motions_once(spark, folder).where("meeting_id IS NOT NULL").withColumn("n", n).where("n < 100")  # agendas number with two digits
    flat = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"\r?\n", "\n~ ")
    number = F.col("n").cast("string")
    headed = F.coalesce("agenda_ref", F.lit("")) != ""
    banner = F.when(F.col("n") == 1, "Town hall\n1234 E. Main\n5:30 PM WORK SESSION\n").when(F.col("n") == 2, F.when(headed, "7:00 P.M. POLICY SESSION\n2. PUBLIC COMMENTS\nCONSENT AGENDA\n").otherwise("7:00 P.M. POLICY SESSION\n")).otherwise("")
    item = F.concat(number, F.lit(".A. RESOLUTION/PUBLIC HEARING - "), flat(F.col("item_title")), F.lit("\n~ (anticipated time "), number, F.lit(" minutes)\nBACKGROUND: "), flat(F.col("motion")), F.lit("\n"))
    block = F.concat(banner, F.when(headed, F.concat(number, F.lit(". MINUTES AND "), F.upper("agenda_ref"), F.lit("\na note of cross-\nreference\n"))).otherwise(""), item)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", block.alias("b")))), lambda x: x["b"]), "")
    return m.groupBy(F.col("meeting_id").cast("string").alias("source_file")).agg(F.concat(text, F.lit("CERTIFICATE OF POSTING\n9. NOT READ")).alias("value"))


_WRAP = "coalesce(list_reduce(list_filter(list_transform({0}, lambda s: regexp_replace(s,'^\\s+|\\s+$','','g')), lambda s: s<>''), lambda a, x: CASE WHEN regexp_matches(a,'[\\p{{L}}\\p{{N}}]-$') THEN a||x ELSE a||' '||x END), '')"
_FLAT = "regexp_split_to_array(regexp_replace(coalesce({0},''), '\\r?\\n', chr(10)||'~ ', 'g'), chr(10))"


@query(f"""WITH o AS ({ONCE}), m AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY id) AS n, coalesce(agenda_ref,'')<>'' AS headed FROM o WHERE meeting_id IS NOT NULL),
k AS (SELECT meeting_id, n, headed, agenda_ref, {_WRAP.format("list_concat([trim(" + _FLAT.format("item_title") + "[1])], list_concat(" + _FLAT.format("item_title") + "[2:], ['~']))")} AS title, {_WRAP.format(_FLAT.format("motion"))} AS background, bool_or(headed AND n=2) OVER (PARTITION BY meeting_id) AS grouped FROM m WHERE n<100)
SELECT meeting_id::VARCHAR AS source_file, n::VARCHAR AS number, CASE WHEN headed THEN 'MINUTES AND '||upper(agenda_ref) ELSE '' END AS heading, CASE WHEN headed THEN 'a note of cross-reference' ELSE '' END AS note, CASE WHEN n=1 THEN '5:30 PM' ELSE '7:00 PM' END AS start_label,
 CASE WHEN n>1 AND grouped THEN 'Consent Agenda' END AS "group", false AS procedural, n||'.A' AS item, 'RESOLUTION/PUBLIC HEARING' AS kind, title, n||' minutes' AS time, background FROM k
UNION ALL SELECT meeting_id::VARCHAR, '2', 'PUBLIC COMMENTS', '', '7:00 PM', NULL, false, NULL, NULL, NULL, NULL, NULL FROM k WHERE n=2 AND headed""")
def agenda_tree(spark: SparkSession, folder: str) -> DataFrame:
    tree = A.agendas(printed_agendas(spark, folder)).select("source_file", "number", F.col("title").alias("heading"), "note", "start_label", "group", "procedural", F.explode_outer("items").alias("i"))
    return tree.select("source_file", "number", "heading", "note", "start_label", "group", "procedural", F.col("i.number").alias("item"), "i.kind", "i.title", "i.time", "i.background")


@query(f"""WITH o AS ({ONCE}), m AS (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY id) AS n, coalesce(agenda_ref,'')<>'' AS headed FROM o WHERE meeting_id IS NOT NULL)
SELECT meeting_id::VARCHAR AS source_file, '17:30' AS start, '5:30 PM' AS start_label, 'Work Session' AS label, false AS public_comment FROM m WHERE n=1 UNION ALL SELECT meeting_id::VARCHAR, '19:00', '7:00 PM', 'Policy Session', headed FROM m WHERE n=2""")
def agenda_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return A.sessions(printed_agendas(spark, folder))


@query()
def timed_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of the subtitled transcripts, set again on the clock of their cues."""
    w = Window.partitionBy("meeting_id").orderBy("line_no")
    lines = table(spark, folder, "transcript_lines").groupBy("meeting_id", "line_no").agg(F.min("line").alias("line"))
    marked = lines.withColumn("cue_no", F.count_if(F.col("line").contains("-->")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("cue_no > 0")
    said = marked.where(~F.col("line").contains("-->") & ~F.col("line").rlike(r"^\s*\d*\s*$"))
    label, words = F.nullif(F.regexp_extract("line", r"^([^:]{1,40}): ", 1), F.lit("")), F.regexp_replace("line", r"^[^:]{1,40}: ", "")
    times = marked.where(F.col("line").contains("-->")).select("meeting_id", "cue_no", *(D.elapsed(F.regexp_replace(F.trim(F.get(F.split("line", "-->"), F.lit(k))), "[,.].*$", "")).cast("double").alias(n) for k, n in enumerate(("start_s", "end_s"))))
    cues = said.groupBy("meeting_id", "cue_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", words.alias("t")))), lambda x: x["t"]), " ").alias("text")).join(times, ["meeting_id", "cue_no"])
    voiced = said.withColumn("turn_no", F.count(label).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    turns = voiced.groupBy("meeting_id", "turn_no").agg(F.min_by(label, "line_no").alias("speaker"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", words.alias("t")))), lambda x: x["t"]), " ").alias("text"))
    return align.timed_turns(turns, cues, "meeting_id")
