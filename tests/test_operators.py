import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumlake.operators import agenda, align, checks, ledger, minutes, relations, schedules, search, sequences, voices, votes

MINUTES = """ELECTED OFFICIALS PRESENT: all
13.A. RESOLUTION – A Resolution of Fennby
Approving the plan
City Council Minutes Page 2 of 9
MOTION: Councilmember Doe moved to approve a thing. Councilmember Roe
seconded the motion.
Pat Doe Yes
City Council Minutes Page 3 of 9

Sam Roe No.
The motion passed with a vote of 1:1
MOTION: Councilmember Roe moved to appoint a committee. Councilmember Doe seconded the motion. The motion passed unanimously.
MOTION: Councilmember Roe moved to adjourn the meeting at 9:00.
MOTION: Councilmember Doe moved to approve the consent agenda.
Pat Doe Yes
14.B. ORDINANCE –
SCHEDULED ITEMS
4. ADJOURN
MOTION:
Kim Poe Yes
14.C. ORDINANCE -
MOTION: go on
The meeting ended.
Pat Doe Yes
"""


def document(spark, *texts):
    return spark.createDataFrame([(f"f{k}", 1 if n < 9 else 2, n, s, "extra") for k, t in enumerate(texts) for n, s in enumerate(t.splitlines())] + [("z", None, None, None, None), (None, 1, 1, "MOTION: x", None)], "source_file string, page int, line_no int, line string, kind string")


def test_minutes(spark):
    rows = minutes.motions(document(spark, MINUTES, "nothing")).orderBy("motion_no").collect()
    assert [r["motion_no"] for r in rows] == [0, 1, 2, 3, 4] and {r["source_file"] for r in rows} == {"f0"}
    a, b, c, d, e = rows
    assert (a["agenda_ref"], a["business_type"], a["item_title"]) == ("13.A.", "Resolution", "A Resolution of Fennby Approving the plan")
    # a page head between two votes does not end the roll call; the page is that of the last vote
    assert [tuple(v) for v in a["votes"]] == [("Pat Doe", "Yes"), ("Sam Roe", "No")] and a["outcome"] == "passed with a vote of 1:1." and a["page"] == 2
    assert a["motion"] == "Councilmember Doe moved to approve a thing. Councilmember Roe seconded the motion."
    assert (b["agenda_ref"], b["business_type"], b["item_title"], b["outcome"]) == ("", minutes.OTHER, "Appoint a committee", "passed unanimously.")
    assert (c["business_type"], c["outcome"]) == ("Consent batch", minutes.NO_OUTCOME)
    # a line of adjournment takes the heading away; an empty motion keeps its own line
    assert (d["agenda_ref"], d["motion"], [v["name"] for v in d["votes"]]) == ("", "MOTION:", ["Kim Poe"])
    assert (e["agenda_ref"], e["item_title"], e["motion"], e["votes"], e["outcome"]) == ("14.C.", "14.C. Ordinance", "go on", [], "")
    tables = minutes.document_tables(document(spark, MINUTES))
    assert {k: t.count() for k, t in tables.items()} == {"motions": 5, "votes": 4, "ordinances": 2, "resolutions": 1, "documents": 2}
    assert minutes.motions(document(spark).limit(0)).count() == 0


def test_vote_lines(spark):
    lines = ["Jane Doe Yes", "Councilmember Doe Yes", "one two three four five Yes", "Doe seconded the motion", "Doe moved to table No", "Yes"]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    assert [r[0] for r in df.select(minutes.is_vote(F.col("x"))).collect()] == [True, False, False, False, False, False]


def test_titles_of_motions(spark):
    title, kind = minutes.title_of(F.col("x"), "Fennby")
    texts = ["Mayor Doe moved to adopt an Ordinance of Fennby Amending  Rules. Mayor Roe seconded.", "moved to approve Resolution No. 2024-1 now.", "Doe moved by Roe to " + "go " * 60 + ".", "nothing"]
    got = [tuple(r) for r in spark.createDataFrame([(x,) for x in texts], "x string").select(title, kind).collect()]
    assert got[0] == ("An Ordinance of Fennby Amending Rules", "Ordinance") and got[1] == ("Resolution No. 2024-1", "Resolution") and got[3] == ("", None)
    assert len(got[2][0]) <= 96 and got[2][0].startswith("Go go") and got[2][0].endswith("…")


AGENDA = """Town of Fennby
2.A. TOO EARLY
4:00 PM WORK SESSION
1. CALL TO ORDER
a note of cross-
reference
2. DISCUSSION
2.A. DISCUSSION - Mid-
Valley road (anticipated time 15 minutes)
BACKGROUND:
BACKGROUND: first
second
7:00 PM MAYOR'S SESSION
3. PUBLIC COMMENTS
CONSENT AGENDA
4. MOTIONS
5.B RESOLUTION/PUBLIC HEARING - A plan
7:00 PM OTHER SESSION
CERTIFICATE OF POSTING
9. NOT READ
"""


def test_agenda(spark):
    files = spark.createDataFrame([("a", AGENDA, 1), ("b", None, 2), ("c", "", 3), (None, AGENDA, 4)], "source_file string, value string, pos int")
    heads = agenda.agendas(files).orderBy("pos").collect()
    assert [(h["number"], h["pos"]) for h in heads] == [("1", 0), ("2", 1), ("3", 2), ("4", 3), ("5", 4)]
    assert heads[0]["procedural"] and not heads[2]["procedural"] and heads[0]["note"] == "a note of cross-reference"
    assert heads[1]["items"][0].asDict() == {"number": "2.A", "kind": "DISCUSSION", "title": "Mid-Valley road", "plain": "", "time": "15 minutes", "background": "first second"}
    assert (heads[3]["group"], heads[3]["session"], heads[3]["start_label"], heads[2]["group"]) == ("Consent Agenda", "19:00", "7:00 PM", None)
    assert (heads[4]["title"], heads[4]["items"][0]["kind"]) == ("", "RESOLUTION/PUBLIC HEARING")
    assert [tuple(r) for r in agenda.sessions(files).orderBy("start").collect()] == [("a", "16:00", "4:00 PM", "Work Session", False), ("a", "19:00", "7:00 PM", "Mayor's Session", True)]
    assert agenda.agendas(files.limit(0)).count() == 0


def plain_alignment(turns, cues, band=10, tail=4):
    """The definition word by word, for comparison."""
    words = lambda t: [w for w in ("".join(c for c in x.lower() if c in "abcdefghijklmnopqrstuvwxyz0123456789'") for x in (t or "").split()) if w]
    stream = [(w, c) for c in cues for w in words(c[2])]
    at, out = 0, []
    for speaker, text in turns:
        own = words(text)
        if not own or at >= len(stream):
            continue
        places = range(max(at + 1, at + len(own) - band), min(len(stream), at + len(own) + band) + 1)
        hits = {e: sum(e > j and stream[e - 1 - j][0] == own[-1 - j] for j in range(min(tail, len(own)))) for e in places}
        end = min((e for e in places if hits[e] == max(hits.values()) > 0), default=min(len(stream), at + len(own)))
        out.append((speaker, stream[at][1][0], stream[end - 1][1][1], len(own)))
        at = end
    return out


def test_alignment(spark):
    import random

    rng = random.Random(5)
    cues = {"x": [(0.0, 1.0, "one two three"), (1.0, 2.0, "four five six"), (2.0, 3.0, "seven eight")], "none": []}
    turns = {"x": [("A", "One, two three four"), ("B", "--"), ("C", "five six"), ("D", None), ("E", "seven eight"), ("F", "more")], "none": [("A", "x")]}
    for k in range(6):
        stream = [rng.choice("aa bb cc dd ee ff gg hh".split()) for _ in range(rng.randint(1, 200))]
        cues[f"r{k}"] = [(float(n), n + 1.0, " ".join(stream[j : j + 7])) for n, j in enumerate(range(0, len(stream), 7))]
        turns[f"r{k}"] = [(rng.choice("AB"), " ".join(w for w in stream[j : j + 23] if rng.random() > 0.08)) for j in range(0, len(stream) + 46, 23)]
    t = spark.createDataFrame([(k, n, *x) for k, v in turns.items() for n, x in enumerate(v)], "stem string, turn_no int, speaker string, text string")
    c = spark.createDataFrame([(k, n, *x) for k, v in cues.items() for n, x in enumerate(v)], "stem string, cue_no int, start_s double, end_s double, text string")
    got = {}
    for r in align.timed_turns(t, c).orderBy("stem", "turn_no").collect():
        got.setdefault(r["stem"], []).append(tuple(r)[2:])
    assert got == {k: p for k in turns if (p := plain_alignment(turns[k], cues[k]))}
    assert got["x"] == [("A", 0.0, 2.0, 4), ("C", 1.0, 2.0, 2), ("E", 2.0, 3.0, 2)]
    assert align.timed_turns(t.limit(0), c).count() == 0


SCHEDULE = """Full-time positions
Department            2019    2020    2021    2022
Police                10.0    11.0    12.0    13.0
Fire                   5.0     5.0     5.0     5.0
Toal Public Safety    15.0    16.0    17.0    18.0
Parks                          2.0     2.0     2.0
Library                2.0     3.0     3.0     -
Grand total           17.0    21.0    22.0    20.0
Seasonal              40      40      40      40
"""


def test_schedules(spark):
    rows = spark.createDataFrame([("x", SCHEDULE), ("y", ""), ("z", None)], "source_file string, value string")
    got = {(r["label"], r["year"]): (r["value"], r["kind"]) for r in schedules.schedules(rows).collect()}
    assert got["Toal Public Safety", 2020] == (16.0, "subtotal") and got["Grand total", 2020][1] == "grand"
    assert got["Parks", 2019] == (None, "blank") and got["Library", 2022] == (0.0, "leaf")


def test_projection_keeps_the_levy_flat(spark):
    base = {"value": 1e9, "rate": 0.001, "collection": 1.0, "appreciation": 0.2, "growth": 0.0, "other": 0.0, "other_growth": 0.0, "spending": 0.0, "spending_growth": 0.0}
    rows = ledger.project(spark, base, 2027, 2029, {"method": "certified"}).orderBy("year").collect()
    assert all(abs(r["revenue"] - 1e6) < 1e-3 for r in rows)
    assert abs(rows[1]["rate"] - 0.001 / 1.2) < 1e-12 and abs(rows[2]["rate"] - 0.001 / 1.44) < 1e-12
    grown = ledger.project(spark, base | {"growth": 0.05, "appreciation": 0.0}, 2027, 2028, {"method": "certified"}).orderBy("year").collect()
    assert abs(grown[1]["revenue"] - 1_050_000) < 1e-3
    other = base | {"other": 1e6, "other_growth": 0.1, "value": 0.0, "rate": 0.0}
    adjusted = ledger.project(spark, other, 2027, 2030, {"method": "fixed_rate"}, adjustments=[{"year": 2028, "amount": 1e5, "side": "revenue", "recurring": True}, {"year": 2029, "amount": 1e5, "side": "revenue", "recurring": False}])
    assert [round(r["other"]) for r in adjusted.orderBy("year").collect()] == [1_000_000, 1_200_000, 1_420_000, 1_452_000]


def test_crossings(spark):
    rows = lambda *gaps: spark.createDataFrame([(2027 + n, float(g)) for n, g in enumerate(gaps)], "year int, gap double")
    found = sequences.crossings(rows(200e3, 100e3, -10e3, -131e3), "year", "gap").collect()
    assert [(r["from"], r["to"], round(r["fraction"], 6), r["into_deficit"]) for r in found] == [(2028, 2029, round(100 / 110, 6), True)]
    assert sequences.crossings(rows(5, 0, 5), "year", "gap").count() == 0 and sequences.crossings(rows(5, -5), "year", "gap").count() == 1


def test_vote_operators(spark):
    v = spark.createDataFrame([(1, 0, "a", "Yes"), (1, 1, "b", "No"), (1, 2, "c", "Yes"), (2, 0, "a", "Abstain"), (2, 1, "b", "Excused"), (3, 0, "a", None)], "motion_id int, pos int, member_id string, vote string")
    members = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "member_id string")
    counts = {r["member_id"]: r for r in votes.vote_counts(v, members).collect()}
    assert counts["a"]["total"] == 3 and counts["a"]["yes_rate"] == 1.0 and counts["z"]["total"] == 0 and counts["z"]["yes_rate"] == 0.0
    agreement = {(r["a"], r["b"]): (r["agreement"], r["n"]) for r in votes.pair_agreement(v).collect()}
    assert agreement["a", "b"] == (0.5, 2) and agreement["a", "c"] == (1.0, 1)
    assert [(r["motion_id"], r["minority"]) for r in votes.divided(v).collect()] == [(1, "n")]
    text = spark.createDataFrame([("Pat: Q: Yes; Sam: No; nobody",), (None,)], "t string").select(votes.roll_call(F.col("t")).alias("r")).collect()
    assert [(x["name"], x["vote"]) for x in text[0]["r"]] == [("Pat: Q", "Yes"), ("Sam", "No")] and text[1]["r"] == []


def test_relations(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 0.0)], "k string, v double")
    b = spark.createDataFrame([("z", 2.0), ("y", 0.0)], "k string, v double")
    assert {r["k"]: r["change"] for r in relations.pair(a, b, ["k"], "v").collect()} == {"x": 1.0, "z": -2.0}
    assert relations.bag_difference(a, a).count() == 0 and relations.bag_difference(a.union(a), a).count() == 2
    assert {r["k"]: r["state"] for r in relations.changes(a.withColumn("v", F.col("v").cast("string")), b.withColumn("v", F.col("v").cast("string")), "k", "v").collect()} == {"x": "orphan", "y": "same", "z": "new"}
    assert {r["k"]: r["problem"] for r in relations.audit(a, b, b.limit(0), "k").collect()} == {"x": "left out", "z": "outside the rule"}


def test_novelty_and_selection(spark):
    p = spark.createDataFrame([("b", 1, "alpha beta gamma delta"), ("b", 2, "alpha beta gamma delta more"), ("b", 3, "other words here entirely"), ("b", 4, None)], "k string, n int, t string")
    assert [r["n"] for r in search.novel(p, "k", "n", "t").orderBy("n").collect()] == [1, 3, 4]
    ranked = spark.createDataFrame([(n, 10.0 - n, "transcript" if n < 4 else "motion", "u" if n > 5 else f"v{n}", 100) for n in range(12)], "doc_id int, score double, kind string, url string, chars int")
    assert [r["doc_id"] for r in search.select_passages(ranked, k=5)] == [0, 1, 4, 5, 6]


def test_selection_is_that_of_the_plain_walk(spark):
    import random

    for seed in range(4):
        rng = random.Random(seed)
        rows = [(n, float(rng.randint(0, 60)), rng.choice(["transcript", "motion", None]), rng.choice(["u", "v", "w", None]), rng.randint(1, 900)) for n in range(150)]
        plain, chars, heard, seen = [], 0, 0, {}
        for d, s, kind, url, c in sorted(rows, key=lambda r: (-r[1], r[0])):
            if len(plain) >= 7 or chars >= 3000:
                break
            if kind == "transcript" and heard >= 2 or seen.get(url, 0) >= 2:
                continue
            plain.append(d)
            chars, heard, seen[url] = chars + c, heard + (kind == "transcript"), seen.get(url, 0) + 1
        ranked = spark.createDataFrame(rows, "doc_id int, score double, kind string, url string, chars int")
        assert [r["doc_id"] for r in search.select_passages(ranked, k=7, budget=3000)] == plain


def test_split_voices():
    rng = np.random.default_rng(1)
    a, b = np.eye(16)[0] * 5, np.eye(16)[1] * 5
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    one, two = rng.normal(0, 0.5, (8, 16)) + a, rng.normal(0, 0.5, (8, 16)) + b
    split = lambda m: voices.two_voices(unit(m) @ unit(m).T)
    assert split(np.vstack([one, two])) and not split(one) and not split(one[:5]) and not split(np.vstack([one, two[:1]])) and not split(np.vstack([one[:1]] * 7))


def test_trimmed_centroids(spark):
    rng = np.random.default_rng(2)
    groups = {k: rng.normal(0, 1, (n, 6)) + 2 for k, n in (("a", 9), ("b", 3), ("c", 1), ("d", 6))}
    df = spark.createDataFrame([(k, n, [float(x) for x in v]) for k, vs in groups.items() for n, v in enumerate(vs)], "k string, n int, v array<double>")
    got = {r["k"]: np.array(r["centroid"]) for r in voices.trimmed_centroids(df, ["k"], "n", "v").collect()}
    for k, vs in groups.items():
        u = vs / np.linalg.norm(vs, axis=1, keepdims=True)
        c = u.mean(axis=0)
        near = sorted(range(len(u)), key=lambda n: -(u[n] @ c))[: max(3, round(0.75 * len(u)))] if len(u) > 3 else range(len(u))
        want = u[list(near)].mean(axis=0)
        assert np.allclose(got[k], want / np.linalg.norm(want))


def test_decisions(spark):
    e = np.eye(12)
    rows = [("p", 1, e[0]), ("p", 2, e[0] + 0.1 * e[5]), ("p", 3, e[0] + 0.1 * e[6])] + [("q", n, e[1] + 0.1 * e[n + 5]) for n in (1, 1)] + [(x, n, e[k]) for k, x in ((2, "r"), (3, "s"), (4, "t"), (7, "u"), (8, "v"), (9, "w"), (10, "x"), (11, "y")) for n in (1, 2)]
    schema = "id int, who string, night int, v array<double>"
    df = spark.createDataFrame([(n, who, night, [float(x) for x in v]) for n, (who, night, v) in enumerate(rows)] + [(99, None, None, [1.0] * 12)], schema)
    known = df.where("who IS NOT NULL")
    judge = lambda **k: {r["id"]: r for r in voices.judged(df, voices.centroids(known, "who", "v"), voices.night_centroids(known, "who", "night", "v"), "id", "who", "night", "v", own="who", own_night="night", **k).collect()}
    got = judge()
    assert (got[0]["best"], got[0]["verdict"], got[0]["nights"], got[0]["hits"]) == ("p", "named", 2, 2)
    assert got[3]["best"] == "q" and got[3]["verdict"] == "known from one night" and got[3]["nights"] == 0
    assert got[99]["verdict"] == "below the floor"
    strangers = judge(strangers=True)
    assert strangers[0]["best"] != "p" and strangers[0]["verdict"] == "below the floor"
    alone = voices.judged(df, voices.centroids(known.where("who = 'p'"), "who", "v"), voices.night_centroids(known, "who", "night", "v"), "id", "who", "night", "v", own="who", strangers=True)
    assert alone.where("id = 0").first()["verdict"] == "empty" and alone.where("id = 3").first()["runner_up"] is None
    m = voices.trial_metrics(voices.judged(df, voices.centroids(known, "who", "v"), voices.night_centroids(known, "who", "night", "v"), "id", "who", "night", "v").join(df.select("id", "who"), "id"), "who", F.col("who") == "p").first()
    assert m["trials"] == len(rows) + 1 and m["wrong"] == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "id int, x string")
    assert [r["broken"] for r in checks.broken(df, {"x": F.col("x").isNotNull(), "small": F.col("id") < 2}).collect()] == [["x"], ["small"]]
    assert checks.duplicates(df, "id").count() == 1
    with pytest.raises(ValueError, match="twice"):
        checks.require_empty(checks.duplicates(df, "id"), "twice")


def test_asof_and_islands(spark):
    left = spark.createDataFrame([("u", 5, 1), ("u", 1, 2), ("w", 9, 3)], "k string, t int, id int")
    right = spark.createDataFrame([("u", 2, "old"), ("u", 5, "same"), ("w", 10, "late")], "k string, t int, v string")
    assert {r["id"]: r["found"] for r in sequences.asof(left, right, "k", "t", "v", "found").collect()} == {1: "same", 2: None, 3: None}
    s = spark.createDataFrame([("m", 1, "A"), ("m", 2, None), ("m", 3, "B"), ("m", 4, "A")], "k string, n int, s string")
    assert [r["island"] for r in sequences.islands(s, "k", ["n"], "s").orderBy("n").collect()] == [1, 1, 2, 3]
