import json

import duckdb
import pytest

from pyspark.sql import functions as F

from quorumlake.plans import registry
from quorumlake.sources import readers, sinks
from quorumlake.sources.portal import PortalSource


def files(spark, *texts):
    return spark.createDataFrame([(f"f{n}", t) for n, t in enumerate(texts)], "source_file string, value string")


def test_minutes_lines(spark, tmp_path):
    (tmp_path / "2024-01-02__7.txt").write_text("one\n\n two \fthree")
    rows = readers.minutes_lines(spark, str(tmp_path)).orderBy("page", "line_no").collect()
    assert [(r["page"], r["line"]) for r in rows] == [(1, "one"), (1, "two"), (2, "three")]
    date, number = readers.stem_parts(F.col("source_file"))
    assert readers.minutes_lines(spark, str(tmp_path)).select(date, number).first()[:] == ("2024-01-02", 7)


def test_cues(spark):
    got = readers.cues(files(spark, "1\n00:00:01,500 --> 00:00:02,250\nHello\nthere\n\n2\n00:00:03.000 --> 01:00:04.000\nx\n", "", None)).orderBy("cue_no").collect()
    assert [(r["cue_no"], r["start_s"], r["end_s"], r["text"]) for r in got] == [(1, 1.5, 2.25, "Hello there"), (2, 3.0, 3604.0, "x")]


def test_speakers_and_tables(spark):
    assert [(r["speaker"], r["said"]) for r in readers.speaker_lines(files(spark, "Speaker A: hi\nmore")).orderBy("line_no").collect()] == [("A", "hi"), (None, "more")]
    text = "# x\n## Other\n| a | elapsed |\n| b | 1:00 |\n## Meeting map\n| topic | Elapsed time |\n|---|---|\n| Start | 23:46 |\n| | 1:24:26 |\n| bad | soon |\n"
    assert [(r["label"], r["mark"]) for r in readers.table_marks(files(spark, text)).orderBy("line_no").collect()] == [("Start", "23:46"), ("(row)", "1:24:26")]


def test_json_lines(spark, tmp_path):
    (tmp_path / "inbox.jsonl").write_text('# note\n{"claim": "a"}\n\n{"claim": \n')
    rows = readers.json_lines(spark, str(tmp_path), "claim string").orderBy("line_no").collect()
    assert [(r["line_no"], r["claim"], r["bad"] is None) for r in rows] == [(2, "a", True), (4, None, False)]


def test_wide_years(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes("STNAME,SUMLEV,NAME,POP2010,POP2011\nX,162,Ca\xf1on,1,2\nX,040,State,9,9\n".encode("latin-1"))
    rows = readers.wide_years(spark, str(tmp_path / "p.csv"), "SUMLEV = '162'", "POP", ["NAME"]).orderBy("year").collect()
    assert [tuple(r) for r in rows] == [("Cañon", 2010, 1), ("Cañon", 2011, 2)]


def test_html_and_css(spark):
    html = '<div class="def" id="levy"><dt>Levy &amp; rate<a href="#levy">¶</a></dt></div><div class="def" id="x"><dd>no</dd></div>'
    assert [(r["slug"], r["term"]) for r in readers.glossary(files(spark, html)).collect()] == [("levy", "Levy & rate")]
    face = "/* latin */\n@font-face { font-family: 'A B'; font-style: normal; font-weight: %d; src: url(https://h/f.woff2) format('woff2'); }\n"
    css = face % 400 + face % 700 + (face % 400) + "/* greek */\n@font-face { font-family: 'A B'; font-style: normal; font-weight: 400; src: url(https://h/g.woff2); }"
    rows = readers.font_faces(files(spark, css), ["latin"]).orderBy("weight").collect()
    assert [(r["weight"], r["file"]) for r in rows] == [("400", "a-b-normal-400-latin.woff2"), ("700", "a-b-normal-400-latin.woff2")]


def test_settings():
    text = "# c\nexport A='b c'\nD = e\n\nbad line\n"
    assert readers.settings(text) == {"A": "b c", "D": "e"}
    assert readers.settings(text, {"D": "f", "A": "", "HOME": "/"}) == {"A": "b c", "D": "f"}


def test_committed_at(tmp_path):
    import subprocess

    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True, env={"GIT_COMMITTER_DATE": "2024-01-02T03:04:05+00:00", "PATH": "/usr/bin:/bin:/usr/local/bin"})
    git("init")
    (tmp_path / "a").write_text("x")
    git("add", "a")
    git("commit", "-m", "m")
    assert readers.committed_at(str(tmp_path / "a")).isoformat() == "2024-01-02T03:04:05+00:00"
    assert readers.committed_at(str(tmp_path / "b")) is None and readers.committed_at("/nowhere/x") is None


def test_portal(spark, tmp_path):
    for cat in ("council", "planning"):
        (tmp_path / cat).mkdir()
        for skip, ids in ((0, (1, 2)), (2, (3,))):
            (tmp_path / cat / f"{skip}.json").write_text(json.dumps([{"id": i, "eventDate": f"2024-0{i}-01T18:00:00Z", "eventName": "x", "hasMedia": True, "isPublished": "Published"} for i in ids]))
    spark.dataSource.register(PortalSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    events = spark.read.format("portal").option("path", str(tmp_path)).load()
    assert events.count() == 6
    assert {r["id"] for r in events.where("category = 'council' AND date >= '2024-02-01'").collect()} == {2, 3}


def test_sinks(spark, tmp_path):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, v string")
    new = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "k string, v string")
    states = sinks.write_changed(new, old, "k", "v", str(tmp_path / "pages"))
    assert {r["k"]: r["state"] for r in states.collect()} == {"a": "same", "b": "changed", "c": "orphan", "d": "new"}
    assert {r["k"] for r in spark.read.parquet(str(tmp_path / "pages")).collect()} == {"b", "d"}
    sinks.upsert(old, new, ["k"], str(tmp_path / "cache"))
    assert {r["k"]: r["v"] for r in spark.read.parquet(str(tmp_path / "cache")).collect()} == {"a": "1", "b": "x", "c": "3", "d": "4"}
    page = spark.createDataFrame([("x<!--B-->old<!--E-->y",), ("none",)], "s string")
    assert [r[0] for r in page.select(sinks.spliced(F.col("s"), F.lit("new"), "<!--B-->", "<!--E-->")).collect()] == ["x<!--B-->new<!--E-->y", "none"]
    motions = spark.createDataFrame([("b", 1, 2, 1, "t", "m", "o", [("p", "Yes")])], "body string, meeting_id int, id int, page int, item_title string, motion string, outcome string, votes array<struct<member_id:string,vote:string>>")
    sinks.by_meeting(motions, str(tmp_path / "meetings"))
    assert spark.read.json(str(tmp_path / "meetings")).first()["meeting_id"] == 1


def test_workbook(spark, tmp_path):
    import zipfile
    from io import BytesIO
    from xml.etree import ElementTree

    df = spark.createDataFrame([(1, "a<b", None), (2, None, 2.5)], "n int, t string, x double")
    with zipfile.ZipFile(BytesIO(sinks.workbook({"one & two": df, "empty": df.limit(0)}))) as z:
        ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
        assert [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{{{ns['m']}}}sheet")] == ["one & two", "empty"]
        rows = ElementTree.fromstring(z.read("xl/worksheets/sheet1.xml")).findall(".//m:row", ns)
        assert [["".join(c.itertext()) for c in r] for r in rows] == [["n", "t", "x"], ["1", "a<b", ""], ["2", "", "2.5"]]
        assert len(ElementTree.fromstring(z.read("xl/worksheets/sheet2.xml")).findall(".//m:row", ns)) == 1
    with pytest.raises(ValueError, match="more than 1"):
        sinks.workbook({"x": df}, most_rows=1)


def test_events_pages_and_fallbacks(spark):
    df = spark.createDataFrame([("e", "a\nb")], "e string, d string")
    assert df.select(sinks.server_event(F.col("e"), F.col("d"))).first()[0] == "event: e\ndata: a\ndata: b\n\n"
    pages = spark.createDataFrame([("x", "p"), ("y", "q"), (None, "about")], "body string, page string")
    assert {r["page"] for r in sinks.pages_with_records(pages, spark.createDataFrame([("x",), ("x",)], "body string")).collect()} == {"p", "about"}
    own, other = spark.createDataFrame([("x", 1)], "k string, v int"), spark.createDataFrame([("x", 2), ("y", 3)], "k string, v int")
    assert {tuple(r) for r in sinks.loaded(own, other, "k").collect()} == {("x", 1), ("y", 3)}


def test_landed_and_refused(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1, "at": "1", "v": "old"}\n{"k": 1, "at": "2", "v": "new"}\n{"k": 2, "at": "1", "v": "x"}')
    assert {tuple(r) for r in readers.landed(spark, str(tmp_path), "k int, at string, v string", "k", "at").select("k", "v").collect()} == {(1, "new"), (2, "x")}
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "x.pdf").write_text("x")
    with pytest.raises(Exception, match="no text reader"):
        readers.minutes_lines(spark, str(tmp_path / "docs")).collect()


def test_portal_guard(spark, tmp_path):
    (tmp_path / "council").mkdir()
    (tmp_path / "council" / "0.json").write_text(json.dumps([{"id": i, "eventDate": "2024-01-01"} for i in range(3)]))
    (tmp_path / "council" / "3.json").write_text(json.dumps([{"id": 9, "eventDate": "2024-01-01"}]))
    spark.dataSource.register(PortalSource)
    with pytest.raises(Exception, match="guard"):
        spark.read.format("portal").option("path", str(tmp_path)).option("guard", "3").load().collect()
    assert spark.read.format("portal").option("path", str(tmp_path)).load().count() == 4


def long_category(folder: str, n: int, others: int = 40) -> duckdb.DuckDBPyConnection:
    """Writes ``n`` meetings of one body, the newest last, and some of another, each tenth delivered twice; gives the SQL side."""
    con = duckdb.connect()
    con.sql(f"""CREATE TABLE meetings AS WITH m AS (SELECT i::BIGINT AS id, if(i<={n},'long-council','short-board') AS body, strftime(DATE '2010-01-01'+i::INTEGER,'%Y-%m-%d') AS date, if(i%3=0,NULL,'regular') AS type, (i%400)::INTEGER AS text_chars, TIMESTAMP '2024-01-01' AS loaded_at FROM range(1,{n + others}+1) t(i))
        FROM m UNION ALL SELECT * REPLACE (text_chars+1 AS text_chars, loaded_at+INTERVAL 1 DAY AS loaded_at) FROM m WHERE id%10=0""")
    con.sql(f"COPY meetings TO '{folder}/meetings.parquet'")
    return con


def test_portal_events_of_a_long_category(spark, tmp_path):
    registry.load()
    con = long_category(str(tmp_path), 2130)
    events = registry.QUERIES["portal_events"](spark, str(tmp_path))
    columns = ", ".join(events.columns)
    mine, theirs = [tuple(r) for r in events.collect()], con.sql(f"SELECT {columns} FROM ({registry.ORACLE['portal_events']})").fetchall()
    assert len(mine) == 2170
    assert sorted(map(repr, mine)) == sorted(map(repr, theirs))


def test_portal_window_beyond_two_thousand_events(spark, tmp_path):
    registry.load()
    con = long_category(str(tmp_path), 2400)
    window = registry.QUERIES["portal_window"](spark, str(tmp_path))
    mine = [tuple(r) for r in window.collect()]
    assert mine == con.sql(f"SELECT {', '.join(window.columns)} FROM ({registry.ORACLE['portal_window']}) ORDER BY date, id").fetchall()
    assert len(mine) == 30 and mine[0] == (2191, "long-council", "2016-01-01")


def test_portal_window_without_undated_meetings(spark, tmp_path):
    registry.load()
    con = duckdb.connect()
    con.sql("""CREATE TABLE meetings AS SELECT i::BIGINT AS id, 'council' AS body, CASE i WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '2015-05-05' ELSE '2017-01-0'||i END AS date, 'regular' AS type, 300 AS text_chars, TIMESTAMP '2024-01-01' AS loaded_at FROM range(1,7) t(i)""")
    con.sql(f"COPY meetings TO '{tmp_path}/meetings.parquet'")
    window = registry.QUERIES["portal_window"](spark, str(tmp_path))
    mine = [tuple(r) for r in window.collect()]
    assert mine == con.sql(f"SELECT {', '.join(window.columns)} FROM ({registry.ORACLE['portal_window']}) ORDER BY date, id").fetchall()
    assert [r[0] for r in mine] == [4, 5, 6]
