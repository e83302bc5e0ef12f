"""Steps in chunks give what one window over the whole key gives, wherever the chunks are cut."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quorumlake.operators import ordered as O
from quorumlake.operators import sequences as S


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), n, rng.choice(["x", "x", "y", None]), rng.choice([1.0, 2.0, None]), "extra") for n in range(160)] + [("lone", 5, None, None, None)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, n int, v string, d double, __x string")


CHUNKS = [lambda: F.lit(0), lambda: F.floor(F.col("n") / 7), lambda: F.col("n"), lambda: F.when(F.col("n") >= 20, F.floor(F.col("n") / 50))]


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert sorted(map(repr, map(tuple, a.select(*columns).collect()))) == sorted(map(repr, map(tuple, b.select(*columns).collect())))


@pytest.mark.parametrize("chunk", CHUNKS)
def test_chunks(rows, chunk):
    chunk = chunk()
    w = Window.partitionBy("k").orderBy("n")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    same(O.carried(rows, "k", chunk, ["n"], {"f": "v", "g": "d"}), rows.withColumns({"f": F.last("v", ignorenulls=True).over(upto), "g": F.last("d", ignorenulls=True).over(upto)}))
    same(O.with_previous(rows, "k", chunk, ["n"], {"p": "v"}), rows.withColumn("p", F.lag("v").over(w)))
    same(O.running_sum(rows, "k", chunk, ["n"], "d", "s"), rows.withColumn("s", F.sum("d").over(upto)))
    change = F.when((F.row_number().over(w) == 1) | ~F.lag("v").over(w).eqNullSafe(F.col("v")), 1).otherwise(0)
    same(O.run_numbers(rows, "k", chunk, ["n"], "v", "r"), rows.withColumn("c", change).withColumn("r", F.sum("c").over(upto)).drop("c"))
    assert O.run_numbers(rows.limit(0), "k", chunk, ["n"], "v", "r").count() == 0


def test_numbers_over_all(spark, rows):
    got = O.numbered(rows.where("k IS NOT NULL"), ["k", "n"], "no", 5)
    w = Window.orderBy("k", "n")
    same(got, rows.where("k IS NOT NULL").withColumn("no", F.row_number().over(w)))


def test_repeats_sessions_and_crossings(spark):
    lines = spark.createDataFrame([("m", n, x) for n, x in enumerate(["a", "a", " ", " ", "b", None, None, "b", "b"])], "k string, n int, t string")
    for chunk in (None, F.col("n"), F.floor(F.col("n") / 2)):
        assert [r["n"] for r in S.drop_repeats(lines, "k", ["n"], "t", chunk).orderBy("n").collect()] == [0, 2, 3, 4, 5, 6, 7]
    times = spark.createDataFrame([("u", s) for s in (0, 10, 100, 105, 500)], "k string, s int").withColumn("t", F.timestamp_seconds("s"))
    assert [r["session"] for r in S.sessions(times, "k", "t", 60, F.floor(F.col("s") / 100)).orderBy("s").collect()] == [1, 1, 2, 2, 3]
    gaps = spark.createDataFrame([("p", 1, 5.0), ("p", 2, -5.0), ("p", 3, 0.0), ("p", 4, 2.0), ("q", 1, 1.0), ("q", 2, 1.0)], "k string, y int, g double")
    assert [tuple(r) for r in S.crossings(gaps, "y", "g", "k", F.col("y")).collect()] == [(1, 2, 0.5, True, "p")]


def test_limits_and_tops(spark):
    rng = random.Random(8)
    data = [(rng.choice("ab"), rng.randint(0, 5_000)) for _ in range(300)]
    df = spark.createDataFrame(data, "k string, s int").withColumn("t", F.timestamp_seconds("s"))
    for r in S.rate_limited(df, "k", "t", 60, 2).collect():
        n = sum(k == r["k"] and r["s"] - 60 <= s <= r["s"] for k, s in data)
        assert r["in_window"] == n and r["limited"] == (n > 2)
    sizes = spark.createDataFrame([("k", f"l{n}", float(v)) for n, v in enumerate([5, -9, 3, 1, 1, 2])] + [("one", "x", 1.0), ("twin", "t", 2.0), ("twin", "t", 2.0), ("twin", "u", 1.0)], "k string, l string, v double")
    got = {(r["k"], r["l"]): (r["v"], r["rank"], r["n"]) for r in S.top_with_other(sizes, "k", "l", "v", 2).collect()}
    assert got["k", "l1"] == (-9.0, 1, 1) and got["k", "l0"] == (5.0, 2, 1) and got["k", "Other"] == (7.0, 3, 4) and got["one", "x"] == (1.0, 1, 1) and ("one", "Other") not in got
    assert got["twin", "Other"] == (1.0, 3, 1)
    assert {(r["k"], r["l"]): (r["v"], r["n"]) for r in S.top_with_other(sizes, "k", "l", "v", 1).collect()}["twin", "Other"] == (3.0, 2)
