import random

import numpy as np
import pytest

from quorumlake.llm import packing as P


def one_by_one(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        open_ = [(room, n) for n, room in enumerate(bins) if room >= s]
        if open_:
            bins[min(open_)[1]] -= s
        else:
            bins.append(capacity - s)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(120))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 50, 100])
    few = [rng.randint(1, capacity) for _ in range(3)]
    sizes = [rng.choice(few) if seed % 2 else rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
    counts = {s: sizes.count(s) for s in set(sizes)}
    rows, bins = P.plan(counts, capacity)
    load = np.zeros(bins, dtype=int)
    for s, n in counts.items():
        own = rows[rows[:, 0] == s]
        for r in range(n):
            row = own[np.searchsorted(own[:, 1], r, side="right") - 1]
            load[row[2] + (r - row[1]) // row[3]] += s
    assert sorted((capacity - load).tolist()) == one_by_one(sizes, capacity)


@pytest.mark.parametrize("group_rows", [500_000, 20])
def test_pack(spark, group_rows):
    rng = random.Random(5)
    sizes = [(n, rng.choice([3, 40, 40, 99, 100, 101, 250, 0, None])) for n in range(300)]
    df = spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint").repartition(5)
    got = P.pack(df, 100, group_rows).collect()
    load, whole = {}, {}
    for r in got:
        load[r["context"]] = load.get(r["context"], 0) + r["n_tokens"]
        whole.setdefault(r["doc_id"], []).append((r["part"], r["n_tokens"]))
    assert all(sum(t for _, t in whole[n]) == (s or 0) for n, s in sizes) and len(whole) == 300
    assert max(load.values()) <= 100 and sorted(load) == list(range(max(load) + 1))
    assert all(len(p) == max(1, -(-(s or 0) // 100)) for n, s in sizes for p in [whole[n]])
    pieces = [t for p in whole.values() for _, t in p if t]
    assert sorted(100 - v for v in load.values()) == one_by_one(pieces, 100)
    assert P.pack(df.limit(0), 100).count() == 0


def test_texts(spark):
    docs = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "x" * 9000), (5, "word " * 3000), (5, "word " * 3000)], "doc_id bigint, text string").withColumnRenamed("text", "text")
    got = P.pack_documents(docs).collect()
    sizes = {}
    for r in got:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["n_tokens"]
    assert sizes[1] == 2 and sizes[2] == sizes[3] == 0 and sizes[5] == 2 * len(P.encoder(P.TOKENIZER).encode_ordinary("word " * 3000))
    assert len({r["context"] for r in got if r["doc_id"] == 5}) >= 2


def test_long_stretches_are_counted_exactly(spark):
    rng = random.Random(7)
    texts = ["go " + "".join(rng.choice("abcdefgh/.-_") for _ in range(n)) + " on" for n in (1999, 2001, 4914, 60_000)] + ["é" * 4001 + "  a", "x" * 3000 + "\n" + "y" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    encode = P.encoder(P.TOKENIZER).encode_ordinary
    assert {r["doc_id"]: r["n_tokens"] for r in P.count_tokens(docs).collect()} == {n: len(encode(t)) for n, t in enumerate(texts)}


def test_long_blanks():
    coder = P.encoder(P.TOKENIZER)
    for text in ("one\n" + " " * 60_000 + "two" + " \t\u3000" * 30_000 + "\nthree" + " " * 60_000, " " * 70_000, "\x1c" * 70_000, "a" * 70_000):
        assert P._length(coder, text) == len(coder.encode_ordinary(text))
    assert P._length(coder, "a" + " " * 1_000_000 + "b") > 2
