import random

import pytest

from quorumlake.llm import leaks as L

VOCAB = [f"{a}{b}{c}" for a in "ba ce di fo gu la me no pi ru sa te".split() for b in "ba ce di fo gu la me no pi ru sa te".split() for c in "ba ce di fo gu la me no pi ru sa te".split()]
WORDS = lambda n, seed: [random.Random(seed * 1000 + k).choice(VOCAB) for k in range(n)]
ITEM = WORDS(60, 1)
NOISE = WORDS(400, 2)


def held(doc, items=((1, " ".join(ITEM)),)):
    return {i for i, _, _ in L.Automaton(list(items)).leaks(" ".join(doc))}


def changed(ws, *at):
    return [("zzz" if k in at else w) for k, w in enumerate(ws)]


def test_whole_and_partial_passages():
    assert held(NOISE[:50] + ITEM + NOISE[50:]) == {1}
    assert held(NOISE[:50] + ITEM[20:45] + NOISE[50:]) == {1}
    assert held(NOISE[:50] + ITEM[20:44] + NOISE[50:]) == set(), "24 words are too few"
    assert held(NOISE) == set() and held([]) == set() and held(ITEM[:10] + NOISE + ITEM[10:20] + NOISE + ITEM[20:30]) == set()


def test_changed_and_foreign_words():
    assert held(NOISE[:9] + changed(ITEM[:32], 6, 13, 20, 27) + NOISE[9:]) == {1}, "one word in eight"
    assert held(NOISE[:9] + changed(ITEM[:32], 3, 7, 11, 15, 19, 23, 27) + NOISE[9:]) == set()
    assert held(ITEM[:12] + ["x", "y", "z"] + ITEM[12:25]) == {1}, "three foreign words between two runs"
    assert held(ITEM[:12] + ["x", "y", "z", "w"] + ITEM[12:25]) == set()
    assert held(ITEM[20:32] + ITEM[:13]) == set(), "the order is the item's"


def test_case_marks_and_forms_of_letters_do_not_matter():
    words = "The ﬁnal Café offered naïve plans, low-lying land & 2,500 homes to every reader who wanted them before the Æther office closed its doors for good in May"
    other = "THE FINAL CAFE   offered naïve plans -- low lying land &amp; 2.500 homes to every­ reader who wаnted them before the aether office closed its doors for good in May!"
    assert L.words(words) == L.words(other.replace("&amp;", "&")) == L.words(other)
    found = L.Automaton([(5, words)]).leaks(f"one two. {other} three")
    assert [i for i, _, _ in found] == [5]


def test_offsets():
    text = "Zë &amp; ﬁx­ now"
    ws, begins, ends = L.words_with_offsets(text)
    assert ws == L.words(text) and [text[a:b] for a, b in zip(begins, ends)] == ["Zë", "ﬁx", "now"]


@pytest.mark.parametrize("seed", range(25))
def test_against_brute_force(seed):
    r = random.Random(seed)
    n, start = r.randint(15, 40), r.randint(0, 20)
    passage = [w if r.random() > 0.07 else "qqq" for w in ITEM[start : start + n]]
    doc = NOISE[: r.randint(0, 60)] + passage + NOISE[100 : 100 + r.randint(0, 60)]
    own = [w == "qqq" for w in passage]
    # changed words only: the passage counts if some stretch of 25 words or more has an eighth changed at most
    true = any((b - a) >= 25 and sum(own[a:b]) * 8 <= b - a and not own[a] and not own[b - 1] for a in range(len(own)) for b in range(a + 25, len(own) + 1))
    assert (1 in held(doc)) == true


def test_tables(spark):
    docs = spark.createDataFrame([(1, " ".join(NOISE[:20] + ITEM), "a"), (1, " ".join(NOISE[:20] + ITEM), "a"), (2, None, "b"), (3, "", "c"), (4, " ".join(NOISE * 100), "d")], "doc_id bigint, text string, item_id string")
    items = spark.createDataFrame([(7, " ".join(ITEM)), (8, " ".join(ITEM)), (9, "short one"), (10, None), (None, "x")], "item_id bigint, text string")
    got = L.find_leaks(docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 7), (1, 8)]
    text = " ".join(NOISE[:20] + ITEM)
    assert all(text[r["begin"] : r["end"]] == " ".join(ITEM) for r in got)
    assert L.found(docs.limit(0), items).count() == 0 and L.found(docs, items.limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.find_leaks(docs, items, max_items=1)


def test_changed_words_in_a_row():
    assert held(NOISE[:9] + changed(ITEM[:52], 24, 25, 26, 27) + NOISE[9:]) == {1}, "four of 52 words, all in a row"
    assert held(NOISE[:9] + ITEM[:20] + NOISE[20:24] + ITEM[24:30] + NOISE[9:]) == set(), "four of 30 are too many"


def test_every_text_of_an_item(spark):
    docs = spark.createDataFrame([(1, " ".join(ITEM[:30])), (2, " ".join(NOISE[:30]))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(ITEM[:30])), (7, " ".join(NOISE[:30])), (7, " ".join(NOISE[:30]))], "item_id bigint, text string")
    assert sorted(map(tuple, L.found(docs, items).collect())) == [(1, 7), (2, 7)]


@pytest.mark.parametrize("gap, true", [(3, {1}), (4, {1}), (5, {1}), (8, {1})])
def test_foreign_words_all_along(gap, true):
    for foreign in (1, 2, 3):
        passage = [x for k, w in enumerate(ITEM[:40]) for x in ([w] + ["zz"] * foreign if k % gap == gap - 1 else [w])]
        assert held(NOISE[:30] + passage + NOISE[30:60]) == true


def test_changed_and_foreign_words_in_short_runs():
    runs = [3, 4, 3, 4, 3, 4, 3, 4]
    passage, at = [], 0
    for k, n in enumerate(runs):
        passage += ITEM[at : at + n] + (["qq"] if k in (1, 3, 5) else ["zz"])
        at += n + (k in (1, 3, 5))  # after those runs a word of the item is changed, after the others one is put in
    assert held(NOISE[:30] + passage + NOISE[30:60]) == {1}


@pytest.mark.parametrize("seed", range(20))
def test_nothing_is_lost_before_the_alignment(seed):
    """What the tests before the alignment let through holds every passage with runs of three words that cover twelve."""
    r = random.Random(100 + seed)
    items = [(n, " ".join(WORDS(r.randint(20, 90), 50 + n))) for n in range(12)]
    n, text = r.choice(items)
    ws = text.split()
    start, foreign = r.randint(0, max(0, len(ws) - 25)), 0
    passage, lost = [], 0
    for k, w in enumerate(ws[start : start + 30]):
        if k % 8 == 7 and lost < 3:
            passage.append("qq")
            lost += 1
        else:
            passage.append(w)
        if k % 4 == 3 and r.random() < 0.6:
            passage += ["zz"] * r.randint(1, 3)
            foreign += 1
    doc = [x for m in range(3) for x in WORDS(r.randint(5, 60), 300 + m)] + passage + WORDS(40, 400)
    want = {n} if len(ws[start : start + 30]) >= 26 else set()
    assert {i for i, _, _ in L.Automaton(items).leaks(" ".join(doc))} >= want


def test_four_short_runs_are_enough():
    """Twelve words in four runs of three, all other words of the passage alone or in pairs."""
    passage, at = [], 0
    for n in (3, 2, 1, 3, 2, 3, 2, 2, 3, 2, 2):
        passage += ITEM[at : at + n] + ["zz"]
        at += n
    assert at == 25 and held(NOISE[:30] + passage + NOISE[30:60]) == {1}
