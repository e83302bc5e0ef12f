import numpy as np
import pytest

from quorumlake.llm import turns as T

VOICES = [("A", "Joseph Haskholm"), ("B", "Mayor Anthony Aldermire"), ("C", "Pamela Zimlakn (City Attorney)"), ("D", "Rosa Woldfield-Clavbury"), ("E", None)]


@pytest.mark.parametrize(
    "line, label, ms, said",
    [
        ("Speaker A: [1:35] Thank uh, you.", "Speaker A", 95_000, "Thank you."), ("[00:01:16] Odette Rendmore: Within (long pause) six", "Odette Rendmore", 76_000, "Within six"),
        ("Speaker C (00:02:05.281): Old  friends like er, it", "Speaker C", 125_281, "Old friends like it"), ("(4:50) >> CM Kellcombe: clinic ((door closes)) now", "CM Kellcombe", 290_000, "clinic now"),
        ("4:39 PRIYA CRODLAKE: ♪ music ♪ More", "PRIYA CRODLAKE", 279_000, "More"), ("00:02:16,596 --> 00:02:20,816", None, 136_596, ""), ("Speaker_F: {pause} *coughs* <laughter> Mm.", "Speaker_F", None, ""),
        ("Second. The motion: approve it.", None, None, "Second. The motion: approve it."), ("cost of $1,200 at 70 homes", None, None, "cost of $1,200 at 70 homes"), ("Board members (two of them never came", None, None, "Board members (two of them never came"), ("Uh—", None, None, ""), ("", None, None, ""),
    ],
)
def test_tags(line, label, ms, said):
    got = T.tag_lines([line])[0]
    assert (got[0], got[1], got[3], got[2]) == (label, ms, said, len([w for w in said.split() if any(map(str.isalnum, w))]))


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(30):
        kinds = rng.integers(0, len(T.KINDS), (1, 4))
        best = max(np.ndindex(*[T.STATES] * 4), key=lambda p: T.STEP[T.START, p[0]] + sum(T.EMIT[s, k] for s, k in zip(p, kinds[0])) + sum(T.STEP[a, b] for a, b in zip(p, p[1:])))
        score = lambda p: T.STEP[T.START, p[0]] + sum(T.EMIT[s, k] for s, k in zip(p, kinds[0])) + sum(T.STEP[a, b] for a, b in zip(p, p[1:]))  # noqa: E731, B023
        assert abs(score(T.viterbi(kinds, np.array([4]))[0]) - score(best)) < 1e-9


def test_letters():
    labels = {"speaker b": "B", "Spk. C": "C", "D": "D", "ANTHONY ALDERMIRE": "B", "Mr. Haskholm": "A", "Ms. Zimlake": "C", "Clavbury": "D", "Nobody Else": None, "": None}
    assert {x: T.letter_of(x, VOICES) for x in labels} == labels


LINES = [
    "[0:10] Speaker A: One two", "[0:10] Speaker A: One two", "three", "[0:20] Mayor Aldermire: Um.", "[0:30] Speaker A: four", "[0:50] Speaker B: six", "[0:40] Speaker A: five", "[applause]", "more of five", "[1:00] Stranger Unknown: who", None, "",
]


def test_turns(spark, monkeypatch):
    lines = spark.createDataFrame([(1, n, x, "extra") for n, x in enumerate(LINES)] + [(2, 0, "nobody speaks", "")] + [(3, 1, "Speaker C: no time", "")], "meeting_id bigint, line_no int, line string, speaker string")
    speakers = spark.createDataFrame([(1, a, b) for a, b in VOICES] * 2 + [(None, "A", "x")], "meeting_id bigint, letter string, name string")
    expected = [(1, "A", 10, 3 + 1 + 4, "One two three four five more of five"), (1, "B", 50, 1, "six"), (1, "Stranger Unknown", 60, 1, "who"), (3, "C", 0, 2, "no time")]
    for chunk_lines, chunk_ms in ((20_000, 3_600_000), (2, 15_000), (1, 1_000)):
        monkeypatch.setattr(T, "CHUNK_LINES", chunk_lines)
        monkeypatch.setattr(T, "CHUNK_MS", chunk_ms)
        got = T.speaker_turns(lines, speakers).orderBy("meeting_id", "start_ms").collect()
        assert [(r["meeting_id"], r["speaker"], r["start_ms"] // 1000, r["n_words"], r["text"]) for r in got] == expected
    assert T.found(lines.limit(0), speakers.limit(0)).count() == 0


def cues(*texts, step=5):
    """Lines of a subtitle file: number, time line, text lines, blank."""
    out = []
    for n, text in enumerate(texts):
        out += [str(n + 1), f"00:00:{n * step + 5:02},200 --> 00:00:{n * step + 8:02},900", *text.split("\n"), ""]
    return out


@pytest.mark.parametrize(
    "lines, expected",
    [
        # a label in every cue
        (cues("Speaker A: one", "Speaker A: two", "Speaker B: three"), [("A", 5, 10, 2, "one two"), ("B", 15, 15, 1, "three")]),
        # a label in some: text without one goes on
        (cues("Speaker A: one", "two uh", "Speaker B: three", "four"), [("A", 5, 10, 2, "one two"), ("B", 15, 20, 2, "three four")]),
        # two voices in adjacent cues, and two in one cue
        (cues("Speaker A: one", "Speaker B: two", "Speaker A: three\nfour\nSpeaker B: five"), [("A", 5, 5, 1, "one"), ("B", 10, 10, 1, "two"), ("A", 15, 15, 2, "three four"), ("B", 15, 15, 1, "five")]),
        # a cue of sounds only, and a label that stands alone
        (cues("Speaker A: one", "[applause]", "Speaker B: um", "two", "Speaker C:\nthree"), [("A", 5, 10, 1, "one"), ("B", 15, 20, 1, "two"), ("C", 25, 25, 1, "three")]),
        # marks on lines of their own without an arrow, out of order
        (["[0:30]", "Speaker A: two", "(0:20)", "Speaker B: one", "more", "0:40", "three"], [("B", 20, 20, 2, "one more"), ("A", 30, 30, 1, "two"), ("B", 40, 40, 1, "three")]),
    ],
)
def test_marks_above_the_text(spark, monkeypatch, lines, expected):
    table = spark.createDataFrame([(1, n, x) for n, x in enumerate(lines)], "meeting_id bigint, line_no int, line string")
    voices = spark.createDataFrame([], "meeting_id bigint, letter string, name string")
    for chunk_lines, chunk_ms in ((20_000, 3_600_000), (3, 7_000)):
        monkeypatch.setattr(T, "CHUNK_LINES", chunk_lines)
        monkeypatch.setattr(T, "CHUNK_MS", chunk_ms)
        got = T.speaker_turns(table, voices).collect()
        assert sorted((r["start_ms"] // 1000, r["speaker"], r["end_ms"] // 1000, r["n_words"], r["text"]) for r in got) == sorted((s, v, e, n, t) for v, s, e, n, t in expected)
