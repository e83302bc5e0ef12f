from pyspark.sql import functions as F

import __spark_entry__ as E

FOLDER = "/root/testdata/sf0.001"


def test_ordered_pieces_with_texts(spark):
    rows = E.queries()["p2_pieces"](spark, FOLDER).orderBy("doc_id", "piece_no").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").where(F.length("text") > 0).collect()}
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(texts) and any(len(p) > 1 for p in by_doc.values())
    for doc, found in by_doc.items():
        assert [r["piece_no"] for r in found] == list(range(len(found)))
        assert all(r["piece"] == texts[doc][r["start"] : r["end"]] and len(r["piece"]) <= 1400 for r in found)
        assert found[0]["start"] == 0 and found[-1]["end"] == len(texts[doc]) and all(a["end"] >= b["start"] for a, b in zip(found, found[1:]))


def test_clean_turns_with_texts(spark):
    turns = E.queries()["p4_turns"](spark, FOLDER).collect()
    few = E.queries()["p4_found"](spark, FOLDER).collect()
    assert all(r["text"] and r["end_ms"] >= r["start_ms"] for r in turns)
    assert sorted((r["meeting_id"], r["speaker"], r["start_ms"] // 1000, len(r["text"].split())) for r in turns) == sorted(map(tuple, few))
