"""The retrieval corpus: documents made of motions, meetings, members, overviews, transcripts and notices, in one shape.

Each builder is a plan over its own tables; the corpus is their union, so a builder that is not wanted is not run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorumlake.functions.text import clean
from quorumlake.operators.sequences import passages
from quorumlake.operators.votes import summary_class

FIELDS = ("id", "kind", "body", "title", "date", "url", "tags", "text")
_NO_TAGS = "array<string>"


def _joined(parts: list[Column], mark: str = " ") -> Column:
    """The parts that are neither null nor blank, cleaned, with a mark between."""
    return F.array_join(F.filter(F.array(*(clean(p) for p in parts)), lambda p: p.isNotNull() & (p != "")), mark)


def _shape(df: DataFrame, kind: str, local: Column, title: Column, text: Column, url: Column, date: Column | None = None, tags: Column | None = None) -> DataFrame:
    return df.select(
        F.concat_ws(":", "body", F.lit(kind), local).alias("id"), F.lit(kind).alias("kind"), "body", title.alias("title"), F.coalesce(date if date is not None else F.col("date"), F.lit("")).alias("date"),
        url.alias("url"), F.coalesce(tags if tags is not None else F.array().cast(_NO_TAGS), F.array().cast(_NO_TAGS)).alias("tags"), text.alias("text"),
    )


def vote_line(votes: Column) -> Column:
    """"Vote: 3 yes, 1 no. In favor: ... Opposed: ..." of votes (name, vote); empty without a yes or no."""
    named = lambda k: F.transform(F.filter(votes, lambda v: summary_class(v["vote"]) == k), lambda v: F.coalesce(v["name"], F.lit("")))
    yes, no = named("y"), named("n")
    count = F.when((F.size(yes) > 0) | (F.size(no) > 0), F.concat(F.lit("Vote: "), F.size(yes).cast("string"), F.lit(" yes, "), F.size(no).cast("string"), F.lit(" no.")))
    told = lambda word, names: F.when(F.size(names) > 0, F.concat(F.lit(word), F.array_join(names, ", "), F.lit(".")))
    return F.concat_ws(" ", count, told("In favor: ", yes), told("Opposed: ", no))


def motion_documents(motions: DataFrame) -> DataFrame:
    """Motions (id, body, date, headline, summary, impact, significance, item_title, motion, outcome, tags, votes (name, vote)): what was
    written for readers first, then the record."""
    outcome = F.when(F.coalesce("outcome", F.lit("")) != "", F.concat(F.lit("Outcome: "), "outcome", F.lit(".")))
    topics = F.when(F.size(F.coalesce("tags", F.array().cast(_NO_TAGS))) > 0, F.concat(F.lit("Topics: "), F.array_join("tags", ", "), F.lit(".")))
    text = _joined([*map(F.col, ("headline", "summary", "impact", "significance", "item_title", "motion")), outcome, vote_line(F.col("votes")), topics])
    title = clean(F.coalesce(F.nullif(F.col("headline"), F.lit("")), F.nullif(F.col("item_title"), F.lit("")), F.lit("Motion")))
    number = F.col("id").cast("string")
    return _shape(motions, "motion", number, title, text, F.concat(F.lit("motions.html?id="), number, F.lit("&body="), "body"), tags=F.col("tags"))


def meeting_documents(meetings: DataFrame, motions: DataFrame, most: int = 40) -> DataFrame:
    """Meetings (id, body, date, motion_count, ord_count, res_count, summary) with the heads of their first ``most`` motions.

    The heads are ranked before they are gathered, so a meeting's row stays small."""
    head = clean(F.coalesce(F.nullif(F.col("headline"), F.lit("")), F.col("item_title")))
    heads = motions.select("meeting_id", "id", head.alias("head")).where(F.length("head") > 0)
    heads = heads.withColumn("__r", F.row_number().over(Window.partitionBy("meeting_id").orderBy("id"))).where(F.col("__r") <= most)
    listed = heads.groupBy(F.col("meeting_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "head"))), lambda x: x["head"]), "; ").alias("heads"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("string")
    date = F.coalesce("date", F.lit(""))
    counts = F.concat(n("motion_count"), F.lit(" motions ("), n("ord_count"), F.lit(" ordinances, "), n("res_count"), F.lit(" resolutions)."))
    text = _joined([F.concat(F.lit("Meeting of "), date, F.lit(".")), counts, F.concat(F.lit("Decisions included: "), "heads", F.lit(".")), F.col("summary")])
    number = F.col("id").cast("string")
    return _shape(meetings.join(listed, "id", "left"), "meeting", number, F.concat(F.lit("Meeting — "), date), text, F.concat(F.lit("meetings.html?id="), number, F.lit("&body="), "body"))


def unminuted_documents(meetings: DataFrame, minuted: DataFrame, note: str) -> DataFrame:
    """Meetings (id, body, date, title, summary) that have no minutes yet, with a note that says so."""
    date, number = F.coalesce("date", F.lit("")), F.col("id").cast("string")
    rows = meetings.join(minuted.select("id"), "id", "left_anti")
    text = _joined([F.concat(F.lit("Meeting of "), date, F.lit(".")), F.lit(note), F.col("summary")])
    title = F.concat(F.coalesce(F.nullif(clean(F.col("title")), F.lit("")), F.lit("Meeting")), F.lit(" — "), date, F.lit(" (no minutes yet)"))
    return _shape(rows, "meeting", number, title, text, F.concat(F.lit("meetings.html?id="), number, F.lit("&body="), "body"))


def member_documents(members: DataFrame, votes: DataFrame) -> DataFrame:
    """Members (body, member_id, name, role, start, end) with the counts of their votes (member_id, vote)."""
    k = summary_class(F.col("vote"))
    counts = votes.groupBy("member_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(k == "y").alias("y"), F.count_if(k == "n").alias("o"))
    rows = members.join(counts, "member_id", "left").na.fill(0, ["n", "y", "o"])
    s = lambda c: F.col(c).cast("string")
    name = F.coalesce("name", F.lit(""))
    text = clean(F.concat(name, F.lit(" — "), F.coalesce("role", F.lit("Member")), F.lit(". Term: "), F.coalesce("start", F.lit("")), F.lit(" to "), F.coalesce(F.nullif(F.col("end"), F.lit("")), F.lit("present")), F.lit(". Cast "), s("n"), F.lit(" recorded votes on file: "), s("y"), F.lit(" yes, "), s("o"), F.lit(" no.")))
    return _shape(rows, "member", F.col("member_id"), clean(name), text, F.concat(F.lit("motions.html?member="), "member_id", F.lit("&body="), "body"), date=F.col("start"))


def overview_documents(bodies: DataFrame, meetings: DataFrame, motions: DataFrame, members: DataFrame, top: int = 8) -> DataFrame:
    """One document a body (id, label): its counts, the ``top`` topics and the people on record.  Bodies without meetings have none.

    motions: (body, id, tags, votes), members: (body, name, role).
    """
    held = meetings.groupBy("body").agg(F.count(F.lit(1)).alias("meetings"))
    moved = motions.groupBy("body").agg(F.count(F.lit(1)).alias("motions"), F.coalesce(F.sum(F.size("votes")), F.lit(0)).alias("votes"))
    tags = motions.select("body", F.explode("tags").alias("tag")).groupBy("body", "tag").agg(F.count(F.lit(1)).alias("n"))
    best = tags.withColumn("__r", F.row_number().over(Window.partitionBy("body").orderBy(F.desc("n"), "tag"))).where(F.col("__r") <= top)
    topics = best.groupBy("body").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", "tag", "n"))), lambda x: F.concat(x["tag"], F.lit(" ("), x["n"].cast("string"), F.lit(")"))), ", ").alias("topics"))
    people = members.groupBy("body").agg(F.array_join(F.array_sort(F.collect_set(F.concat(F.coalesce("name", F.lit("")), F.lit(" ("), F.coalesce("role", F.lit("Member")), F.lit(")")))), ", ").alias("people"))
    rows = bodies.select(F.col("id").alias("body"), F.coalesce("label", "id").alias("label")).join(held, "body")
    rows = rows.join(moved, "body", "left").join(topics, "body", "left").join(people, "body", "left").na.fill(0, ["motions", "votes"]).na.fill("", ["topics", "people"])
    s = lambda c: F.col(c).cast("string")
    text = clean(F.concat(F.lit("These are the records of the "), "label", F.lit(". They cover "), s("meetings"), F.lit(" meetings, "), s("motions"), F.lit(" motions, and "), s("votes"), F.lit(" recorded votes. Common topics: "), "topics", F.lit(". People on record: "), "people", F.lit(".")))
    return _shape(rows, "overview", F.lit("all"), F.concat(F.lit("About "), "label"), text, F.concat(F.lit("index.html?body="), "body"), date=F.lit(""))


def transcript_documents(transcripts: DataFrame, size: int = 230, overlap: int = 40, least: int = 60) -> DataFrame:
    """Passages of transcripts (id, body, date, title, text) that overlap; ``at`` of a passage is its first word."""
    cut = passages(transcripts, "id", "text", size, overlap, least)
    rows = transcripts.select("id", "body", "date", "title").join(cut, "id")
    number, date = F.col("id").cast("string"), F.coalesce("date", F.lit(""))
    title = F.concat(F.lit("Transcript — "), F.coalesce(F.nullif(clean(F.col("title")), F.lit("")), F.lit("Meeting")), F.lit(" ("), date, F.lit(")"))
    return _shape(rows, "transcript", F.concat_ws(":", number, (F.col("passage_no") * (size - overlap)).cast("string")), title, F.col("passage"), F.concat(F.lit("meetings.html?id="), number, F.lit("&body="), "body"))


def union(*builders: DataFrame) -> DataFrame:
    """All documents, as they are; ids tell kind and body."""
    return reduce(lambda a, b: a.unionByName(b), (b.select(*FIELDS) for b in builders))


def kinds(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def roster(members: DataFrame, council: DataFrame, bodies: DataFrame) -> DataFrame:
    """(body, text, apart): the roster of each body (members: body, name, role, serving; bodies: id, label) as a prompt's lines.

    Members whose role is not the body's most frequent one (ties to the smaller) are marked; ``apart`` says that no name is
    shared with the council (name).  Bodies without members get a line that says so.
    """
    serving = members.where("serving AND name IS NOT NULL")
    usual = serving.groupBy("body", "role").agg(F.count(F.lit(1)).alias("n")).groupBy("body").agg(F.max_by("role", F.struct("n", F.col("role"))).alias("usual"))
    shown = F.when(F.col("role").eqNullSafe(F.col("usual")) | F.col("role").isNull(), F.col("name")).otherwise(F.concat("name", F.lit(" ("), "role", F.lit(")")))
    shared = serving.join(council.select("name").distinct(), "name", "left_semi").select("body").distinct().withColumn("shared", F.lit(True))
    lists = serving.join(usual, "body").groupBy("body").agg(F.array_join(F.array_sort(F.collect_set(shown)), ", ").alias("names"))
    rows = bodies.select(F.col("id").alias("body"), "label").join(lists, "body", "left").join(shared, "body", "left")
    text = F.when(F.col("names").isNull(), "No roster is on file for this body.").otherwise(F.concat("label", F.lit(" members: "), "names", F.lit(".")))
    return rows.select("body", text.alias("text"), (F.col("names").isNotNull() & F.col("shared").isNull()).alias("apart"))
