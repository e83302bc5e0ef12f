import random
import re

import pytest
from pyspark.sql import functions as F

from quorumlake.llm import pieces as P


def made(seed, n):
    rng = random.Random(seed)
    out = []
    while sum(map(len, out)) < n:
        out.append("".join(rng.choice("abcdeé🚧") for _ in range(rng.choice([2, 5, 9, 40]))) + rng.choice([" ", " ", " ", ". ", "\n", "\n\n", "\r\n\r\n", "   "]))
    return "".join(out)[:n]


def verify(text, spans, limit, overlap):
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    for (a, b, kind), (c, d, _) in zip(spans, spans[1:]):
        assert c <= b < d and b - c <= overlap + 1
        if kind != P.HARD:
            assert text[b - 1].isspace() or text[b].isspace()
    assert all(0 < b - a <= limit for a, b, _ in spans)


@pytest.mark.parametrize("seed", range(40))
def test_pieces_cover_the_text(seed):
    text = made(seed, random.Random(seed).randint(1, 6000))
    spans = P.cut_span(text, 0, len(text), 200, 30)
    verify(text, spans, 200, 30)
    assert any(k == P.HARD for _, _, k in spans) == bool(re.search(r"\S{201}", text))


@pytest.mark.parametrize("text", ["a" * 1400, "a" * 1401, "b " * 700 + "a" * 1400, " " * 5000, "x" + " " * 3000 + "y" * 1400 + " z", "w " * 690 + "a" * 1390 + " " + "b" * 1400 + "c " * 20, "\n\n" * 900, "a" * 5000])
def test_long_words_and_blanks(text):
    spans = P.cut_span(text, 0, len(text))
    verify(text, spans, 1400, 160)
    assert any(k == P.HARD for _, _, k in spans) == bool(re.search(r"\S{1401}", text))


def test_natural_ends_are_taken():
    text = "One two three. " * 40 + "\n\n" + "Four five six. " * 60
    spans = P.cut_span(text, 0, len(text), 700, 80)
    assert spans[0][2] == P.PARAGRAPH and all(k == P.SENTENCE for _, _, k in spans[1:-1])
    assert all(text[a - 1].isspace() and 40 <= b - a <= 80 for (_, b, _), (a, _, _) in zip(spans, spans[1:]))


def test_tables_in_one_range_and_in_many(spark):
    texts = [(n, made(n, size)) for n, size in enumerate((0, 1, 199, 200, 201, 5000, 30_000, 80_000))] + [(90, None)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("piece_no", F.lit("clash")).repartition(4)
    for size in (8_000, 1 << 20):
        got = P.split_texts(df, limit=200, overlap=30, range_size=size).collect()
        by = {}
        for r in got:
            by.setdefault(r["doc_id"], []).append(r)
        for n, text in texts:
            if not text:
                assert n not in by
                continue
            rows = sorted(by[n], key=lambda r: r["piece_no"])
            assert [r["piece_no"] for r in rows] == list(range(len(rows)))
            assert all(r["piece"] == text[r["start"] : r["end"]] and len(r["piece"]) <= 200 for r in rows)
            assert rows[0]["start"] == 0 and rows[-1]["end"] == len(text) and all(b["start"] <= a["end"] < b["end"] for a, b in zip(rows, rows[1:]))
    assert P.split_texts(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.split_texts(df, limit=100, overlap=60)


def test_found(spark):
    rows = [(1, "a " * 600), (2, "a " * 800), (3, "a" * 1401), (4, "b" * 1400 + " c"), (5, None), (6, "é" * 1400)]
    assert sorted(tuple(r) for r in P.found(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()) == [(2, 1), (3, 0), (4, 1)]


@pytest.mark.parametrize("range_size", [6_000, P.RANGE])
def test_found_over_the_corpus(spark, range_size):
    """Seams run on the longer texts; what comes out is what a look at the whole texts gives."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {(r["doc_id"], int(not re.search(r"\S{1401}", r["text"]))) for r in docs.select("doc_id", "text").collect() if r["text"] and len(r["text"]) > P.LIMIT}
    assert {tuple(r) for r in P.found(docs, range_size).collect()} == want
    pieces = P.split_texts(docs, range_size=range_size)
    assert pieces.where("n_range > 0").count() > 0
    long = {r["doc_id"]: r["text"] for r in docs.where(F.length("text") > range_size + 2 * P.LIMIT).collect()}
    by = {}
    for r in pieces.where(F.col("doc_id").isin(list(long))).collect():
        by.setdefault(r["doc_id"], []).append(r)
    for k, text in long.items():
        rows = sorted(by[k], key=lambda r: r["piece_no"])
        assert [r["piece_no"] for r in rows] == list(range(len(rows))) and rows[0]["start"] == 0 and rows[-1]["end"] == len(text)
        assert all(r["piece"] == text[r["start"] : r["end"]] and len(r["piece"]) <= P.LIMIT for r in rows) and all(b["start"] <= a["end"] < b["end"] for a, b in zip(rows, rows[1:]))


def test_a_seam_within_a_stretch_is_a_hard_cut(spark):
    rows = spark.createDataFrame([(1, "a" * 40_000), (2, "b " * 9_000 + "c" * 3_000 + " d" * 9_000)], "doc_id bigint, text string")
    pieces = P.split_texts(rows, range_size=6_000).collect()
    for k, text in ((1, "a" * 40_000), (2, "b " * 9_000 + "c" * 3_000 + " d" * 9_000)):
        ends = {r["end"]: r["cut"] for r in pieces if r["doc_id"] == k}
        assert all((cut == P.HARD) == (e < len(text) and not text[e - 1].isspace() and not text[e].isspace()) for e, cut in ends.items())


def test_files(spark, tmp_path):
    texts = {f"{n}.txt": made(n, size) for n, size in enumerate((0, 10, 20_000, 90_000))}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    got = P.split_files(spark, [str(tmp_path / n) for n in texts], limit=200, overlap=30, range_bytes=16_000).collect()
    for name, text in texts.items():
        rows = sorted((r for r in got if r["path"].endswith(name)), key=lambda r: r["piece_no"])
        assert [r["piece_no"] for r in rows] == list(range(len(rows)))
        assert all(r["piece"] == text[r["start"] : r["end"]] for r in rows)
        assert not rows and not text or rows[0]["start"] == 0 and rows[-1]["end"] == len(text)
