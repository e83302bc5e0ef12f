"""Queries over members, meetings and feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.io import table
from quorumlake.operators import glyphs
from quorumlake.operators import records as R
from quorumlake.operators import votes as V
from quorumlake.plans.registry import query
from quorumlake.plans.votes import ONCE, ONCE_MEETINGS, motions_once


def _meetings(spark: SparkSession, folder: str) -> DataFrame:
    return V.once(table(spark, folder, "meetings"), "id")


@query(f"WITH m AS ({ONCE_MEETINGS}) SELECT id FROM m WHERE date IS NOT NULL AND EXISTS (SELECT 1 FROM m n WHERE n.date=m.date AND n.id<>m.id)")
def same_day(spark: SparkSession, folder: str) -> DataFrame:
    return R.sharing(_meetings(spark, folder).where("date IS NOT NULL").select("id", "date"), "date").select("id")


@query(f"SELECT body, business_type, n FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY n DESC, business_type) AS r FROM (SELECT body, business_type, count(*) AS n FROM ({ONCE}) WHERE business_type IS NOT NULL GROUP BY 1,2)) WHERE r=1")
def usual_business(spark: SparkSession, folder: str) -> DataFrame:
    return R.most_frequent(motions_once(spark, folder), "body", "business_type")


@query(f"SELECT body, min(date) AS next, date_diff('day', DATE '2015-06-01', min(date)::DATE)::INT AS days_away FROM ({ONCE_MEETINGS}) WHERE date>='2015-06-01' GROUP BY 1")
def next_meeting(spark: SparkSession, folder: str) -> DataFrame:
    return R.upcoming(_meetings(spark, folder), "body", "date", "2015-06-01")


@query(f"""SELECT id AS motion_id, meeting_id, tier::INT AS tier FROM (SELECT *, row_number() OVER (PARTITION BY meeting_id ORDER BY tier, id) AS r FROM (SELECT id, meeting_id, CASE WHEN lead THEN 0 WHEN significance='notable' THEN 1 WHEN coalesce(headline,'')<>'' THEN 2 ELSE 3 END AS tier FROM ({ONCE}))) WHERE r<=6""")
def leading_motions(spark: SparkSession, folder: str) -> DataFrame:
    tiers = [F.col("lead"), F.col("significance") == "notable", F.coalesce("headline", F.lit("")) != ""]
    return R.tiered(motions_once(spark, folder), "meeting_id", tiers, [F.col("id")], 6).select(F.col("id").alias("motion_id"), "meeting_id", "tier")


@query(f"""SELECT m.id AS motion_id, coalesce(nullif(k.summary,''), m.summary) AS summary, (coalesce(trim(m.impact),'')='' OR m.significance IS NULL OR m.significance NOT IN ('routine','notable')) AS stale FROM ({ONCE}) m LEFT JOIN ({ONCE_MEETINGS}) k ON k.id=m.meeting_id""")
def enriched(spark: SparkSession, folder: str) -> DataFrame:
    extra = _meetings(spark, folder).select(F.col("id").alias("meeting_id"), "summary")
    rows = R.enrich(motions_once(spark, folder), extra, ["meeting_id"], ["summary"])
    return rows.select(F.col("id").alias("motion_id"), "summary", R.stale(F.col("impact"), F.col("significance"), ["routine", "notable"]).alias("stale"))


@query("SELECT meeting_id, line_no, line_id FROM transcript_lines t WHERE line_no < coalesce((SELECT min(line_no) FROM transcript_lines s WHERE s.meeting_id=t.meeting_id AND contains(s.line,'Second.')), 1000000000)")
def before_second(spark: SparkSession, folder: str) -> DataFrame:
    return R.until(table(spark, folder, "transcript_lines"), "meeting_id", "line_no", F.col("line").contains("Second.")).select("meeting_id", "line_no", "line_id")


@query(f"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(coalesce(motion,'')),'[a-z]+')) AS word FROM ({ONCE})) GROUP BY 1")
def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return R.vocabulary(motions_once(spark, folder), "motion")


@query()
def glyph_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Motions with every i printed as a glyph of a bad scan, read by the words of the motions as they are."""
    motions = motions_once(spark, folder).select("id", "motion")
    scanned = motions.withColumn("motion", F.translate("motion", "i", "í"))
    return glyphs.repair(scanned, "motion", glyphs.clean_vocabulary(motions, "motion")).select(F.col("id").alias("motion_id"), "motion")


@query(rf"""SELECT id AS motion_id, trim(regexp_replace(CASE WHEN regexp_matches(t, '\b[Tt]he motion (passed|failed|carried|was)\b[^.]*[.]') THEN regexp_extract(t, '(?s)^(.*?\b[Tt]he motion (?:passed|failed|carried|was)\b[^.]*[.])', 1) ELSE t END, '\s{{2,}}|^\s|\s$', ' ', 'g')) AS motion
FROM (SELECT id, motion||' The motion carried by the board. Next item.' AS t FROM ({ONCE}))""")
def trimmed_motions(spark: SparkSession, folder: str) -> DataFrame:
    """Motions printed with a grid of votes and what comes after, cut back to the motion."""
    printed = F.concat("motion", F.lit("  Those Voting Yes A B Those Voting No C The motion carried by the board. Next item."))
    return motions_once(spark, folder).select(F.col("id").alias("motion_id"), glyphs.trimmed(printed).alias("motion"))


@query(f"""SELECT id AS motion_id, '1'||page||'.'||(page*10)||'.0'||page AS number FROM ({ONCE}) WHERE page IS NOT NULL""")
def section_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Section numbers with O for 0 and strokes for 1, as a scan gives them, put right."""
    wrong = F.concat(F.lit("|"), "page", F.lit("."), F.translate((F.col("page") * 10).cast("string"), "01", "O|"), F.lit(".O"), "page")
    return motions_once(spark, folder).where("page IS NOT NULL").select(F.col("id").alias("motion_id"), glyphs.sections(wrong).alias("number"))
