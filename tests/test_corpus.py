import math

import pytest
from pyspark.sql import functions as F

from quorumlake.functions import dates as D
from quorumlake.functions import text as T
from quorumlake.operators import checks, corpus, ledger, records, search, staffing, talk

DOCS = [
    (1, "Water budget", "The council approved the water budget. Budgets grow.", ["budget"], "motion", "a", "2026-01-01"),
    (2, None, "Nothing here of it at all", None, "transcript", "b", None),
    (3, "", "", [], "motion", "a", "x"),
    (4, "Member", "water water water", [], "member", "a", "2026-01-01"),
    (5, "Sewer", None, ["water"], None, None, "2020-01-01"),
    (6, "A claim", 'They said "the sewer" budgets 41 percent', [], "claim", "", ""),
]
SCHEMA = "doc_id bigint, title string, text string, tags array<string>, kind string, body string, date string"


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, SCHEMA).withColumn("term", F.lit("clash"))
    return search.write_index(docs, str(tmp_path_factory.mktemp("index")), parts=3), docs


def stems(spark, text):
    return spark.createDataFrame([(text,)], "x string").select(T.tokens(F.col("x"))).first()[0]


def test_index(spark, index):
    own, docs = index
    rows = {(r["term"], r["doc_id"]): r for r in own.postings.collect()}
    assert (rows["budget", 1]["tf"], rows["budget", 1]["in_title"], rows["budget", 1]["in_tags"]) == (3, True, True)
    assert (rows["water", 5]["tf"], rows["water", 5]["in_tags"]) == (0, True) and not any(d == 3 for _, d in rows)
    assert own.stats["n"] == 6 and own.stats["tokens"] == sum(r["tf"] for r in rows.values())
    assert {r["term"]: r["df"] for r in own.terms.collect()}["water"] == 2


def test_bm25_against_the_formula(spark, index):
    own, docs = index
    terms = search.query_terms("Water budgets?", ["the sewer"], {"water": ["sewer"]}, spark)
    assert dict((t, (w, r)) for t, w, r in terms) == {"water": (1.0, True), "sewer": (1.0, True), "budget": (1.0, True)}
    tokens = {d[0]: stems(spark, f"{d[1] or ''} {d[2] or ''}") for d in DOCS}
    average = sum(map(len, tokens.values())) / 6
    want = {}
    for doc, title, _, tags, kind, _, date in DOCS:
        if kind in search.PINNED:
            continue
        score = 0.0
        for t, w, _ in terms:
            df, tf = sum(t in x for x in tokens.values()), tokens[doc].count(t)
            if tf:
                score += max(0.3, math.log(1 + (6 - df + 0.5) / (df + 0.5))) * w * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tokens[doc]) / average))
        if not score:
            continue
        asked = {t for t, _, _ in terms}
        score *= 1.3 if asked & set(stems(spark, title)) else 1.0
        score *= 1.15 if asked & set(stems(spark, " ".join(tags or []))) else 1.0
        age = {"2026-01-01": 151, "2020-01-01": 2343}.get(date)
        want[doc] = score * (1 + 0.3 * math.exp(-age / 1800) if age is not None else 1.0)
    got = {r["doc_id"]: r["score"] for r in search.bm25(own, terms, now="2026-06-01").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert {r["doc_id"] for r in search.bm25(own, terms, body="b").collect()} <= {5, 6}
    assert search.bm25(own, [], now="2026-06-01").count() == 0
    # terms of earlier questions weigh less and are not asked for
    assert ("budget", 0.35, False) in search.query_terms("water", ["water budget"], {}, spark)


def test_claim_search(spark, index):
    own, docs = index
    got = [r["doc_id"] for r in search.claim_search(own, docs, 'is "the sewer" over 41 percent').collect()]
    assert got == [6]
    assert {r["doc_id"] for r in search.claim_search(own, docs, "water budget").collect()} == {1, 4}


def test_empty_index(spark, tmp_path):
    own = search.write_index(spark.createDataFrame([], SCHEMA), str(tmp_path / "i"), parts=2)
    assert own.stats["n"] == 0 and search.bm25(own, [("water", 1.0, True)]).count() == 0 and search.claim_search(own, spark.createDataFrame([], SCHEMA), "water").count() == 0


def test_corpus_documents(spark):
    votes = "votes array<struct<name:string,vote:string>>"
    m = spark.createDataFrame([(7, "b", "2024-01-01", "Head", "", None, None, " item\n title ", "moved", "passed.", ["x", "y"], [("Pat", "Yes"), ("Sam", "nay"), (None, "abstain")]), (8, "b", None, None, None, None, None, None, None, None, None, None)], f"id bigint, body string, date string, headline string, summary string, impact string, significance string, item_title string, motion string, outcome string, tags array<string>, {votes}")
    a, b = corpus.motion_documents(m).orderBy("id").collect()
    assert (a["id"], a["title"], a["text"]) == ("b:motion:7", "Head", "Head item title moved Outcome: passed.. Vote: 1 yes, 1 no. In favor: Pat. Opposed: Sam. Topics: x, y.")
    assert (b["title"], b["text"], b["date"], b["tags"]) == ("Motion", "", "", [])
    meetings = spark.createDataFrame([(1, "b", "2024-01-01", 2, None, 1, "sum"), (2, "b", None, None, None, None, None)], "id bigint, body string, date string, motion_count int, ord_count int, res_count int, summary string")
    heads = m.withColumn("meeting_id", F.lit(1).cast("bigint"))
    one, two = corpus.meeting_documents(meetings, heads).orderBy("id").collect()
    assert one["text"] == "Meeting of 2024-01-01. 2 motions (0 ordinances, 1 resolutions). Decisions included: Head. sum" and two["text"] == "Meeting of . 0 motions (0 ordinances, 0 resolutions)."
    note = corpus.unminuted_documents(meetings.withColumn("title", F.lit(None).cast("string")), meetings.where("id = 1"), "No minutes.").collect()
    assert [(r["title"], r["text"]) for r in note] == [("Meeting —  (no minutes yet)", "Meeting of . No minutes.")]
    members = spark.createDataFrame([("b", "p", "Pat", None, "2020-01-01", ""), ("b", "q", None, "Chair", None, None)], "body string, member_id string, name string, role string, start string, end string")
    cast = spark.createDataFrame([("p", "AYE"), ("p", "n"), ("p", None)], "member_id string, vote string")
    texts = {r["id"]: r["text"] for r in corpus.member_documents(members, cast).collect()}
    assert texts["b:member:p"] == "Pat — Member. Term: 2020-01-01 to present. Cast 3 recorded votes on file: 1 yes, 1 no."
    bodies = spark.createDataFrame([("b", "Board"), ("empty", None)], "id string, label string")
    over = corpus.overview_documents(bodies, meetings, m, members).collect()
    assert [r["text"] for r in over] == ["These are the records of the Board. They cover 2 meetings, 2 motions, and 3 recorded votes. Common topics: x (1), y (1). People on record: (Chair), Pat (Member)."]
    both = corpus.union(corpus.motion_documents(m), corpus.member_documents(members, cast))
    assert {r["kind"]: r["n"] for r in corpus.kinds(both).collect()} == {"motion": 2, "member": 2}
    rows = spark.createDataFrame([("b", "Pat", "Member", True), ("b", "Kim", "Alternate", True), ("b", "Old", "Member", False), ("b", "Sam", "Member", True)], "body string, name string, role string, serving boolean")
    lines = {r["body"]: (r["text"], r["apart"]) for r in corpus.roster(rows, spark.createDataFrame([("Zed",)], "name string"), bodies).collect()}
    assert lines == {"b": ("Board members: Kim (Alternate), Pat, Sam.", True), "empty": ("No roster is on file for this body.", False)}


def test_printed_outcomes(spark):
    cases = [("passed with 3", 3, 0, 0), ("carried", 2, 1, 1), (None, 0, 0, 0), ("(outcome not found)", 1, 0, 0), ("tabled.", 0, 0, 0), ("denied", 1, 2, 0)]
    df = spark.createDataFrame(cases, "o string, y int, n int, x int")
    got = [r[0] for r in df.select(T.outcome_sentence(F.col("o"), F.col("y"), F.col("n"), F.col("x"))).collect()]
    assert got == ["Passed unanimously, 3–0.", "Passed 2–1–1 (2 yes, 1 no, 1 other).", "The minutes don’t record a result or a roll-call vote for this motion.", "The minutes don’t state the result. The roll call was 1–0.", "Tabled. No roll-call vote was recorded.", "Failed 1–2 (1 yes, 2 no)."]
    titles = spark.createDataFrame([("", "A Resolution of Fennby City, Utah, Approving  x"), ("Head", "t"), (None, None), ("", "word " * 60)], "h string, t string")
    shown = [r[0] for r in titles.select(T.motion_title(F.col("h"), T.clean_title(F.col("t"), "Fennby(?: City)?,?\\s*Utah"))).collect()]
    assert shown[:3] == ["A Resolution Approving x", "Head", "(no title)"] and shown[3].endswith("word…") and len(shown[3]) <= 141


def test_dates_and_text(spark):
    one = lambda f, v: spark.createDataFrame([(v,)], "x string").select(f(F.col("x"))).first()[0]
    assert [one(D.day_month_year, v) for v in ("2026-07-21", "soon", None)] == ["21 July 2026", "soon", ""]
    assert one(D.month_day_year, "2026-10-08T00:00") == "Oct 8, 2026" and one(D.weekday_date, "2026-07-21") == "Tuesday, July 21, 2026"
    at = lambda v: one(lambda c: F.unix_seconds(D.instant(c)), v)
    assert at("2026-01-01T00:00:00Z") == at("2026-01-01") == at("2026-01-01 00:00:00") == at("2026-01-01T02:00:00+02:00") == 1767225600 and at("x") is None
    assert one(lambda c: F.unix_seconds(D.newest(D.instant(c), F.lit(None).cast("timestamp"))), "2026-01-01") == 1767225600
    assert one(T.without_speaker, "Speaker B: hello: you") == "hello: you" and one(T.without_speaker, "no label here") == "no label here"
    assert one(T.title_case, "PUBLIC HEARINGS/ITEMS") == "Public Hearings/Items"
    assert one(lambda c: T.cut_at_sentence(c, 12), "One two. Three four") == "One two." and one(lambda c: T.cut_at_sentence(c, 5), "abcdefgh") == "abcde"
    assert one(T.markdown, "# A & B\nx *y* **z**\nw\n\n- one\n- `t`\n\n[l](https://h/)") == '<h3>A &amp; B</h3><p>x <em>y</em> <strong>z</strong> w</p><ul><li>one</li> <li><code>t</code></li></ul><p><a href="https://h/">l</a></p>' and one(T.markdown, "") == ""
    cues = T.question_cues(F.col("x"))
    asked = spark.createDataFrame([("Who is Pat?",), ("What was said last night?",), ("plain",)], "x string").select(*cues.values()).collect()
    assert [tuple(r) for r in asked] == [(True, False, False), (False, True, True), (False, False, False)]


CONFIG = dict(taxable_value=1e9, collection_rate=1.0, appreciation_rate=0.02, new_growth_rate=0.02, other_revenue=0.0, other_revenue_growth=0.0, expenditures=1.0, expenditure_growth=0.03, has_scenario=True, start_rate=0.001, first_year=2027, last_year=2032)


@pytest.mark.parametrize(
    "change, errors, warnings",
    [
        ({}, [], []), ({"taxable_value": 0.0}, ["taxable_value"], []), ({"collection_rate": 1.5}, ["collection_rate"], []), ({"expenditure_growth": -1.0}, ["expenditure_growth"], []), ({"expenditure_growth": 0.6}, [], ["expenditure_growth"]),
        ({"start_rate": None}, ["start_rate"], []), ({"has_scenario": False, "start_rate": None}, ["scenario"], []), ({"start_rate": 0.06}, [], ["start_rate"]), ({"last_year": 2020}, ["years"], []), ({"last_year": 2070}, ["years"], []), ({"first_year": None}, ["years"], []),
        ({"expenditures": float("nan")}, ["expenditures"], []), ({"new_growth_rate": None}, ["new_growth_rate"], []),
    ],
)
def test_validation(spark, change, errors, warnings):
    schema = ", ".join(f"{k} {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'double'}" for k, v in CONFIG.items())
    row = ledger.problems(spark.createDataFrame([tuple((CONFIG | change).values())], schema)).first()
    assert [e["field"] for e in row["errors"]] == errors and [w["field"] for w in row["warnings"]] == warnings


def test_ledgers(spark):
    gaps = spark.createDataFrame([("s", 2027, 5.0, 1.0, 100.0, 0.1), ("s", 2028, -7.0, -6.0, 100.0, 0.1), ("t", 2027, 1.0, 1.0, 0.0, 0.1)], "s string, year int, gap double, cumulative double, value double, rate double")
    rows = {r["s"]: r for r in ledger.summary(gaps, ["s"]).collect()}
    assert (rows["s"]["worst_year"], rows["s"]["deficit_years"], rows["s"]["cumulative"]) == (2028, 1, -6.0) and abs(rows["s"]["closing_rate"] - 0.17) < 1e-12 and rows["t"]["closing_rate"] is None
    lines = spark.createDataFrame([("a", "f", "g", 1.0), ("a", "h", "", 2.0), ("b", "f", None, 0.0)], "d string, fund string, grp string, v double")
    areas = spark.createDataFrame([("a", "north")], "name string, area string")
    assert [tuple(r) for r in ledger.mapped(lines, "d", areas, F.col("v")).collect()] == [("north", 3.0)]
    with pytest.raises(Exception, match="no area for"):
        ledger.mapped(lines, "d", areas.limit(0), F.col("v")).collect()
    pool = {r["d"]: r for r in ledger.pooled(lines, "d", "fund", "grp", F.col("v")).collect()}
    assert (pool["a"]["total"], pool["a"]["groups"], [f["name"] for f in pool["a"]["funds"]]) == (3.0, ["g"], ["h", "f"]) and pool["b"]["groups"] == []
    with pytest.raises(Exception, match="no line z"):
        ledger.line_total(lines, "d", "z", F.col("v")).collect()
    assert [r["place"] for r in ledger.in_printed_order(lines, "fund", ["h", "f"]).orderBy("d", "fund").collect()] == [2, 1, 2]
    # two projections in one session do not disturb each other
    base = {"value": 1e9, "rate": 0.001, "collection": 1.0, "appreciation": 0.0, "growth": 0.0, "other": 0.0, "other_growth": 0.0, "spending": 0.0, "spending_growth": 0.0}
    first, second = ledger.project(spark, base, 2027, 2028, {"method": "certified"}), ledger.project(spark, base, 2030, 2033, {"method": "certified"})
    assert (first.count(), second.count()) == (2, 4) and first.agg(F.min("year")).first()[0] == 2027


def test_staffing(spark):
    labels = ["Police", "Fire", "City Library", "Parks & Rec", "Storm water", "Planning", "Streets", "Mayor", "Zzz", None]
    got = spark.createDataFrame([(x,) for x in labels], "x string").select(staffing.function_of(F.col("x"))).collect()
    assert [r[0] for r in got] == ["public_safety", "public_safety", "library", "parks_rec", "utilities", "community_dev", "public_works", "general_gov", "unmapped", "unmapped"]
    f = spark.createDataFrame([("c", "public_safety", 10.0), ("c", "utilities", 2.5), ("c", "library", 1.0), ("d", "library", 1.0)], "city string, function string, total double")
    rows = {r["city"]: r for r in staffing.per_thousand(f, spark.createDataFrame([("c", 5000)], "city string, people int"), ["city"]).collect()}
    assert (rows["c"]["raw_1k"], rows["c"]["excl_1k"], rows["c"]["core_1k"], rows["d"]["raw_1k"]) == (2.7, 0.7, 0.2, None)
    parts = spark.createDataFrame([(" Dra ", 2024, "10"), ("Dra", 2024, "5"), ("Dra", 2024, "x")], "place string, year int, n string")
    assert [tuple(r) for r in staffing.whole_places(parts, "place", "year", "n").collect()] == [("Dra", 2024, 15)]


def test_marks_and_turns(spark):
    marks = spark.createDataFrame([("a", 1, "x", "23:46"), ("a", 2, "y", "41:34"), ("a", 3, "z", "1:24:26"), ("b", 1, "x", "0:30"), ("b", 2, "late", "1:50"), ("c", 1, "x", "0:10:00"), ("d", 1, "x", "0:10")], "k string, n int, label string, mark string")
    lengths = spark.createDataFrame([("a", 5400), ("b", 5400), ("c", 900)], "k string, d int")
    assert {r["k"]: r["scale"] for r in talk.scale(marks, lengths, "k", "n", "mark", "d").collect()} == {"a": "ms", "b": "hm", "c": "hms", "d": "hm"}
    late = {(r["k"], r["label"]): r["seconds"] for r in talk.beyond_recording(marks, lengths, "k", "n", "label", "mark", "d").collect()}
    assert late == {("b", "late"): 6600, ("d", None): 1}
    turns = spark.createDataFrame([("m", "A", 0.0, 5.0, "Pat", 10), ("m", "A", 6.0, 7.0, "Pat", 2), ("m", "B", 8.0, 30.0, None, 8)], "m string, s string, a double, b double, name string, words int")
    stats = {r["s"]: (r["turns"], r["usable"], r["seconds"], r["place"]) for r in talk.speaker_statistics(turns, "m", "s", "a", "b").collect()}
    assert stats == {"A": (2, 1, 6.0, 2), "B": (1, 1, 22.0, 1)}
    c = talk.coverage(turns, "m", "name", "words").first()
    assert (c["words"], c["named"], c["share"], c["voices"]) == (20, 12, 0.6, 1)


def test_records(spark):
    rows = spark.createDataFrame([(1, [("k1",), ("k2",)]), (2, []), (3, None)], "id int, items array<struct<k:string>>")
    cache = spark.createDataFrame([("k1", "one"), ("k1", "two")], "key string, plain string")
    got = {r["id"]: r["items"] for r in records.with_plain(rows, "items", cache, lambda i: i["k"]).collect()}
    assert [tuple(i) for i in got[1]] == [("k1", "one"), ("k2", "")] and got[2] == [] and got[3] == []
    events = spark.createDataFrame([("b", 2, "2024-05-02", "10:00", None), ("b", 1, "2024-05-02", "09:00", [(True, [("X",)]), (False, [("PUBLIC HEARING",), ("Y",)])]), ("b", 0, "2024-01-01", "09:00", None)], "body string, id int, date string, start string, agenda array<struct<procedural:boolean,items:array<struct<kind:string>>>>")
    assert [tuple(r) for r in records.upcoming_card(events, "2024-05-01").collect()] == [("b", "2024-05-02", "09:00", 1, 2, 1)]
    done = spark.createDataFrame([(1, "v1"), (2, "v2")], "id int, parameters string")
    assert {r["id"] for r in records.to_do(rows, done, ["id"], "v2").collect()} == {1, 3}
    assert [r["batch"] for r in records.batched(rows.withColumn("k", F.lit(0)), "k", ["id"], 2).orderBy("id").collect()] == [0, 0, 1]
    ids = spark.createDataFrame([("ok",), ("Bad id",), ("two",), ("two",), (None,)], "i string")
    assert {(r["i"], r["problem"]) for r in checks.id_problems(ids, "i", "^[a-z]+$").collect()} == {("Bad id", "form"), ("two", "twice"), (None, "form")}
    assert {r["link"] for r in records.linked(done, spark.createDataFrame([(1, "p"), (1, "a")], "id int, page string"), "id", F.lit("none")).collect()} == {"a", "none"}
