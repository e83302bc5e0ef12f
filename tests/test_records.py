from pyspark.sql import functions as F

from quorumlake.operators import glyphs
from quorumlake.operators import records as R

TERMS = "id string, terms array<struct<role:string,start:string,end:string>>"


def test_terms(spark):
    df = spark.createDataFrame([("a", [("member", "2014-01-01", "2017-12-31"), ("mayor", "2022-01-01", None), ("mayor", "2018-01-01", "2021-12-31")]), ("b", [])], TERMS)
    rows = {r["id"]: r for r in R.terms_newest_first(df).withColumns({"first": R.first_seated(F.col("terms")), "run": R.role_run_start(F.col("terms")), "on": R.serving(F.col("terms"), F.lit("2017-06-01")), "gap": R.serving(F.col("terms"), F.lit("2013-01-01"))}).collect()}
    assert (rows["a"]["role"], rows["a"]["start"], rows["a"]["first"], rows["a"]["run"], rows["a"]["on"], rows["a"]["gap"]) == ("mayor", "2022-01-01", "2014-01-01", "2018-01-01", True, False)
    assert rows["b"]["role"] is None and rows["b"]["first"] == "9999" and rows["b"]["on"]


def test_files_and_queue(spark):
    files = spark.createDataFrame([([(1, 4, "Draft", "2024-03-01"), (2, 4, "Approved minutes", "2024-02-01"), (3, 1, "Agenda", "2025-01-01")],), ([(5, 4, "Draft", "2024-03-01"), (6, 4, "Draft 2", "2024-03-02")],), ([],)], "f array<struct<fileId:int,fileType:int,name:string,publishOn:string>>")
    assert [r[0] for r in files.select(R.best_file(F.col("f"), 4)["fileId"]).collect()] == [2, 6, None]
    events = spark.createDataFrame([(1, "2024-05-01", True, True), (2, "2024-05-02", True, True), (3, "2024-05-03", True, False), (4, "2024-01-01", True, True), (5, "2024-05-03", True, True)], "id int, date string, published boolean, has_media boolean")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id int")
    assert [r["id"] for r in R.pending(events, ids(1), ids(2), "2024-05-04", 6, 5).collect()] == [5]


def test_hand_made_and_enrich(spark):
    v = spark.createDataFrame([({"A": ("x", "voiceprint"), "B": ("y", None), "C": ("z", "hand")},)], "m map<string,struct<name:string,method:string>>")
    assert set(v.select(R.hand_made(F.col("m")).alias("m")).first()["m"]) == {"B", "C"}
    rows = spark.createDataFrame([(1, "old"), (2, "old"), (3, None)], "k int, s string")
    got = R.enrich(rows, spark.createDataFrame([(1, "new"), (2, "")], "k int, s string"), ["k"], ["s"]).orderBy("k").collect()
    assert [r["s"] for r in got] == ["new", "old", None]


def test_until_sharing_tiered(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "stop"), ("a", 3, "y"), ("b", 1, "z")], "k string, n int, t string")
    assert sorted(r["t"] for r in R.until(df, "k", "n", F.col("t") == "stop").collect()) == ["x", "z"]
    assert {r["k"] for r in R.sharing(df, "k").collect()} == {"a"}
    assert [r["t"] for r in R.tiered(df, "k", [F.col("t") == "y"], [F.col("n")], 2).where("k = 'a'").orderBy("place").collect()] == ["y", "x"]


def test_glyphs(spark):
    counts = {"city": 30, "of": 100, "may": 50, "mag": 1, "utah": 30, "council": 30, "require": 10, "guest": 4, "quest": 4, "modern": 9, "ages": 9}
    words = spark.createDataFrame([(w, float(n)) for w, n in counts.items()], "word string, n double")
    cases = {
        "cíty of Bømont": "city of Bamont", "see |7.7O.O3O": "see 17.70.030", "î635.ßO(a)": "1635.30(a)", "C¡TY mag reguire guest": "CITY may require guest", "lltah Coancil ages¡": "Utah Council agesi",
        "mag Coancil": "mag Coancil", "": "", None: None,
    }
    df = spark.createDataFrame([(t, n) for n, t in enumerate([*cases, "cíty of Bømont"])], "t string, word int")
    got = glyphs.repair(df, "t", words).orderBy("word").collect()
    assert [r["t"] for r in got] == [*cases.values(), "city of Bamont"] and got[0].asDict().keys() == {"t", "word"}
    assert glyphs.repair(df.limit(0), "t", words).count() == 0


def test_trimmed_motions(spark):
    texts = {"a moved. Those Voting Yes x Those Voting No y The motion passed with 3. More": "a moved. The motion passed with 3.", "no grid. the motion was  ok. tail": "no grid. the motion was ok.", "Those Voting Aye x": "", None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(glyphs.trimmed(F.col("t"))).collect()] == list(texts.values())
    assert df.select(glyphs.trimmed(F.col("t"), False)).first()[0].startswith("a moved. Those Voting")


def test_vocabulary(spark):
    texts = spark.createDataFrame([("a b a",), (None,)], "t string")
    assert {r["word"]: r["n"] for r in R.vocabulary(texts, "t", ["B c"], 50).collect()} == {"a": 2, "b": 51, "c": 50}
