from datetime import datetime, timedelta

from quorumlake.streaming import streams as S


def rows(spark, path, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def test_limit_matches_a_plain_count_over_two_runs(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    schema = "user_id bigint, ts timestamp"
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows(spark, src, [(1, t0 + timedelta(seconds=s)) for s in (0, 1, 2)] + [(2, t0)], schema)
    stream = lambda: S.limited(S.folder_stream(spark, src, "parquet", schema), "user_id", "ts", 60, 2)
    S.run_available(stream(), out, state)
    rows(spark, src, [(1, t0 + timedelta(seconds=s)) for s in (30, 61)], schema)
    S.run_available(stream(), out, state)
    got = sorted((r["user_id"], r["at_us"], r["allowed"]) for r in spark.read.parquet(out).collect())
    assert [ok for u, _, ok in got if u == 1] == [True, True, False, False, True]
    assert [ok for u, _, ok in got if u == 2] == [True]


def test_server_events(spark):
    text = "event: sources\ndata: [1]\n\ndata: hel\ndata: lo\n\n: note\n"
    chunks = spark.createDataFrame([("q", n, text[k : k + 5]) for n, k in enumerate(range(0, len(text), 5))], "q string, n int, c string")
    got = S.server_events(chunks, "q", "n", "c").orderBy("event_no").collect()
    assert [(r["event"], r["data"]) for r in got[:2]] == [("sources", "[1]"), ("message", "hel\nlo")]


def test_not_landed(spark):
    listed = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01"), (3, "2024-03-01")], "id int, date string")
    landed = spark.createDataFrame([(2,)], "id int")
    assert [r["id"] for r in S.not_landed(listed, landed, "id", since="2024-01-15").collect()] == [3]
