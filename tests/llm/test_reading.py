import numpy as np
import pytest

from quorumlake.llm import reading as R


@pytest.mark.parametrize("word, n", [("cat", 1), ("table", 2), ("reading", 2), ("created", 3), ("motion", 2), ("idea", 3), ("make", 1), ("makes", 1), ("walked", 1), ("wanted", 2), ("agreement", 3), ("telecommunications", 7), ("authority", 4), ("the", 1), ("area", 3), ("42", 2)])
def test_syllables(word, n):
    assert R.syllables(word) == n


EASY = "The cat sat on the mat. It is warm and dry. We like the park. The dog ran to the big tree. "
HARD = "Notwithstanding any preliminary authorization contemplated by the appropriate municipality, the administering jurisdiction is obligated to facilitate the intergovernmental reconciliation of all nonconforming appropriations, provided that certification of the supplementary documentation is undertaken in accordance with the aforementioned provisions. "


def test_features_bear_lost_marks_and_junk():
    easy, hard = R.features(EASY * 5), R.features(HARD * 3)
    assert easy[0] < 8 and hard[0] > 30 and hard[3] > 2 * easy[3] - 1
    bare = R.features((EASY * 20).replace(".", ""))
    assert bare[1] == 1.0
    assert abs(R.features(EASY * 5 + " " + "x7" * 900)[2] - easy[2]) < 0.01
    assert R.features("") is None and R.features("... 🚧") is None
    assert R.sentences("Res. No. 5 passed. Mr. Doe left.")[0][0] == 4


def test_scale():
    rng = np.random.default_rng(0)
    rows, levels = [], []
    for level, (text, other) in enumerate(((EASY, EASY), (EASY, HARD), (HARD, EASY), (HARD, HARD)), 1):
        for _ in range(20):
            rows.append(R.features(text * rng.integers(2, 4) + other * 2))
            levels.append(float(level))
    s = R.Scale(np.array(rows), np.array(levels))
    assert s.bounds == sorted(s.bounds) and s.levels(np.array([R.features(EASY * 4), R.features(HARD * 4)])).tolist() == [1, 4]
    assert R.Scale(np.zeros((0, 5)), np.zeros(0)).levels(np.array([R.features(EASY * 4)])).tolist() == [1]


def test_held_out_accuracy_on_labelled_documents(spark):
    """Fitted on half of the labelled documents, tested on the other half."""
    from quorumlake.io import table

    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "reading_labels")
    even, odd = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    tested = docs.join(odd.select("doc_id").distinct(), "doc_id", "left_semi")
    got = R.reading_levels(tested, even).where("pieces >= 60").join(odd.select("doc_id", "level").withColumnRenamed("level", "rated"), "doc_id").select("level", "rated").collect()
    right = np.mean([r["level"] == r["rated"] for r in got])
    assert len(got) > 100 and right > 0.85 and np.mean([abs(r["level"] - r["rated"]) <= 1 for r in got]) > 0.98


def test_tables(spark):
    docs = spark.createDataFrame([(1, EASY * 8, "en", 9), (2, HARD * 8, "en", 9), (3, None, "en", 9), (4, "", "en", 9), (5, EASY * 8, "es", 9), (6, EASY * 8, None, 9), (7, "short", "en", 9), (8, EASY * 8, "en", 9), (8, EASY * 8, "en", 9)], "doc_id bigint, text string, lang string, level int")
    labels = spark.createDataFrame([(1, 1, "r"), (1, 2, "s"), (99, 3, "r"), (None, 1, "r"), (2, None, "r")], "doc_id bigint, level int, rater string")
    rows = {r["doc_id"]: r for r in R.reading_levels(docs, labels).collect()}
    assert rows[1]["level"] == 1 and rows[2]["level"] == 4 and rows[3]["level"] is None and rows[4]["grade"] is None
    assert sorted(tuple(r) for r in R.found(docs, labels).collect()) == [(8, 1)]
    assert R.found(docs.limit(0), labels.limit(0)).count() == 0
