from pyspark.sql import functions as F

from quorumlake.functions import dates as D
from quorumlake.functions import text as T
from quorumlake.functions import vectors as X


def one(spark, column, value=None):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_outcome_class_keeps_the_order_of_its_tests(spark):
    assert [one(spark, T.outcome_class, v) for v in ("passed with a unanimous vote.", "did not pass", "not passed", "motion fails", "tabled", "", None)] == ["passed", "failed", "passed", "failed", "other", "other", "other"]


def test_numeric(spark):
    assert [one(spark, T.numeric, v) for v in ("(1,234)", "-", "5%", "$1,000.50", "abc", None)] == [-1234.0, 0.0, 5.0, 1000.5, None, None]


def test_stem_and_tokens(spark):
    assert [one(spark, T.stem, w) for w in ("votes", "voted", "voting", "vote", "parties", "churches", "bus", "status", "red")] == ["vot", "vot", "vot", "vot", "party", "church", "bus", "status", "red"]
    assert one(spark, T.tokens, "The Votes of a Council, 2024!") == ["vot", "council", "2024"]
    assert one(spark, T.tokens, None) == []


def test_names_slugs_and_initials(spark):
    assert one(spark, T.norm_name, "  Pat  O'Neil-Doe, Jr. ") == "pat o'neil-doe jr"
    assert one(spark, T.slug, " Parks & Trails (2024) ") == "parks-trails-2024"
    assert [one(spark, T.initials, v) for v in ("Pat Doe", "pat", "Pat Q. Doe", "", None)] == ["PD", "PP", "PD", "?", "?"]
    assert [spark.range(1).select(T.ordinal(F.lit(n))).first()[0] for n in (1, 2, 3, 11, 12, 21, 113)] == ["1st", "2nd", "3rd", "11th", "12th", "21st", "113th"]


def test_wrapping_and_caps(spark):
    join = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(T.wrap_join(F.col("a"), F.col("b"))).first()[0]
    assert join("Mid-", "Valley") == "Mid-Valley" and join("one", "two") == "one two" and join("", "two") == "two"
    assert one(spark, T.calm_caps, "AN ORDINANCE OF THE CITY") == "An Ordinance of the City"
    assert one(spark, T.calm_caps, "An Ordinance of the City") == "An Ordinance of the City"
    assert one(spark, T.calm_caps, "RDA PLAN - MIXED-USE/RETAIL (PHASE 2B) IN THE CITY") == "RDA Plan - Mixed-Use/Retail (Phase 2B) in the City"


def test_sentences_and_clip(spark):
    assert one(spark, T.sentences, "One.  Two? Three") == ["One.", "Two?", "Three"]
    assert one(spark, T.sentences, "") == []
    assert one(spark, lambda c: T.clip(c, 12), "alpha beta gamma") == "alpha beta …"
    assert one(spark, lambda c: T.clip(c, 40), "alpha beta") == "alpha beta"


def test_html(spark):
    assert one(spark, T.strip_tags, "<p>a &amp; b</p><script>x()</script>") == "a & b"
    assert one(spark, T.escape_html, "<a href='x'>&</a>") == "&lt;a href=&#x27;x&#x27;&gt;&amp;&lt;/a&gt;"


def test_dates(spark):
    day = spark.createDataFrame([("2026-08-18T16:00:00Z",)], "x string")
    date, clock = D.split_event_time(F.col("x"))
    assert day.select(date, clock, D.clock(clock)).first()[:] == ("2026-08-18", "16:00", "4:00 PM")
    forms = one(spark, D.date_forms, "2024-07-02")
    assert all(f in forms for f in ("july 2", "7/2/24", "2 july 2024")) and "july 3" not in forms
    assert [one(spark, D.elapsed, v) for v in ("23:46", "1:24:26", "x")] == [1426, 5066, None]
    assert str(one(spark, D.free_date, "July 2, 2024")) == "2024-07-02" and one(spark, D.free_date, "soon") is None
    assert str(one(spark, D.heading_date, "MINUTES OF\nJuly 2, 2024 at 6")) == "2024-07-02"
    assert [one(spark, lambda c: D.duration_label(c.cast("int")), v) for v in ("17040", "59", "3600")] == ["4h 44m", "0m", "1h 00m"]


def test_claims(spark):
    score = lambda p, n: spark.createDataFrame([(p, n)], "p string, n string").select(T.claim_score(F.col("p"), F.col("n"))).first()[0]
    assert score("We like the park.", "We like the park.") == 0.0
    assert score("I heard that the city is going to sell the water company for 5,000 dollars and that no one asked us first at all", "x") > 3.0
    assert score("I heard him say that the city is selling 5,000 acres of the big park and lake by the road there", "x") == 0.0


def test_vectors(spark):
    row = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>, z array<double>").select(X.norm("a").alias("n"), X.cosine(F.col("a"), F.col("b")).alias("c"), X.unit(F.col("z")).alias("u")).first()
    assert row["n"] == 5.0 and abs(row["c"] - 1) < 1e-9 and row["u"] == [0.0, 0.0]


def test_people(spark):
    labels = ["Councilmember Pat Doe (mayor pro tem)", "Pat", "Mayor Dr. Sam \"Sammy\" Roe", "Sam", "Sam Poe", "Kim"]
    rows = {r["x"]: r for r in T.resolve_people(spark.createDataFrame([(x,) for x in labels], "x string"), "x").collect()}
    assert (rows[labels[0]]["person"], rows[labels[0]]["role"]) == ("Pat Doe", "mayor pro tem") and rows["Pat"]["person"] == "Pat Doe"
    assert rows[labels[2]]["person"] == "Sam Roe" and rows["Sam"]["person"] is None and rows["Sam"]["candidates"] == ["Sam Poe", "Sam Roe"] and rows["Kim"]["candidates"] == []


def test_addresses_replies_and_notices(spark):
    url = lambda x: one(spark, lambda c: T.canonical_url(c, "https://h", "council"), x)
    assert [url(x) for x in ("https://a/m.html?x=1&id=7&body=council", "http://b/index.html", "https://a/m?body=board", None)] == ["https://h/m.html?id=7", "https://h/", "https://h/m?body=board", None]
    assert one(spark, T.reply_json, '```json\n{"a": {"b": 1}}\n```') == '{"a": {"b": 1}}' and one(spark, T.reply_json, "none") is None
    assert str(one(spark, D.posted_on, "was posted on\nthis 13 day of August, 2026, on the boards")) == "2026-08-13" and one(spark, D.posted_on, "no") is None
    kind, rest = T.split_kind(F.col("x"))
    assert spark.createDataFrame([("RESOLUTION/PUBLIC HEARING - A plan",), ("plain",)], "x string").select(kind, rest).collect()[0][:] == ("RESOLUTION/PUBLIC HEARING", "A plan")
    s = spark.createDataFrame([([("u1",), ("u2",), ("u3",), ("u4",)], "see u4"), ([("u1",), ("u2",), ("u3",), ("u4",)], "none")], "s array<struct<url:string>>, a string")
    assert [[x["url"] for x in r[0]] for r in s.select(T.used_sources(F.col("s"), F.col("a"))).collect()] == [["u4"], ["u1", "u2", "u3"]]
