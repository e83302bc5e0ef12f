import itertools

import pytest

from quorumlake.llm import names as N


def linked(*names, counts=None):
    found = N.resolve([(n, (counts or {}).get(n, 1)) for n in names])
    return sorted(sorted(n for n in found if found[n] == k) for k in set(found.values()))


@pytest.mark.parametrize(
    "group",
    [
        ["Jennifer Umbwick", "Jen Umbwick", "J. Umbwick", "Umbwick, Jennifer", "UMBWICK, J.", "Board Member Umbwick", "JENNIFER UMBWICK *", "Jennifer Umbwcik", "Jennifer T. Umbwick", "Jennifer Umbwick (City Recorder)", "Jennifer Umbwick, Planner"],
        ["Zoë Niskwick", "Zoe Niskwick", "Z Niskwick", "Zëo Niskwick"],
        ["William Bramfield", "Bill Bramfield", "William Brarnfielcl", "W Bramfield", "Will1am Bramfield"],
        ["Priya Haskstead-Bracklake", "Priya Haskstead", "Priya Haskstead Bracklake", "Haskstead-Bracklake, P.", "Haskstead-Brcaklake"],
        ["Malik Immerworth Jr.", "Immerworth Jr., Malik", "Malik Immerworth JR"],
        ["Liskfield Water Company", "The Liskfield Water Company", "Water Company of Liskfield", "Liskfield Water Co.", "LISKFIELD WATER COMPANY", "LWC", "Liskfeild Water Company (applicant)", "Liskfield Water"],
        ["Arbford and Ulvcroft Engineering Group", "Arbford & Ulvcroft Engr. Group", "AaUEG", "AUEG"],
    ],
)
def test_one_entity(group):
    assert linked(*group) == [sorted(group)]


def test_persons_that_are_not_the_same():
    got = linked("Richard Skellric", "Zoë Skellric", "Z. Skellric", "Skellric", "Malik Oskby Jr.", "Malik Oskby Sr.", "M. Oskby", "Robert Plovgatn", "Alexander Plovgate", "Plovgatn", "Vannby Water Company", "Vannby Land Partners", counts={"Robert Plovgatn": 9, "Alexander Plovgate": 9})
    assert got == sorted([["Richard Skellric"], ["Z. Skellric", "Zoë Skellric"], ["Skellric"], ["Malik Oskby Jr."], ["Malik Oskby Sr."], ["M. Oskby"], ["Plovgatn", "Robert Plovgatn"], ["Alexander Plovgate"], ["Vannby Water Company"], ["Vannby Land Partners"]])


def test_entries_that_name_nobody():
    assert all(N.parse(x) is None for x in (None, "", "  ", "(illegible)", "Clerk", "name missing", "Mayor", "*", "?", "( )", ","))
    assert N.parse("x" * 5000) is not None


def test_order_does_not_matter():
    group = ["Hiro Merestead", "H. Merestead", "Merestead", "Hiro Meresead", "Merestead, Hiro"]
    assert {tuple(map(tuple, linked(*p))) for p in itertools.permutations(group)} == {(tuple(sorted(group)),)}


def test_tables(spark):
    votes = spark.createDataFrame([(1, 7, "Hiro Merestead", "a"), (1, 7, "Hiro Merestead", "a"), (2, 7, "H. Merestead", "b"), (3, 8, "H. Merestead", "c"), (4, 7, None, "d"), (5, 7, "Clerk", "e"), (6, None, "Hiro Merestead", "f")], "row_id bigint, term_id bigint, member string, name string")
    speakers = spark.createDataFrame([(7, ("Merestead, Hiro", 0.1)), (7, None), (8, ("Hiro Mereestead", 0.2))], "term_id bigint, runner_up struct<name:string,similarity:double>")
    got = sorted(tuple(r) for r in N.found(votes, speakers).collect())
    assert got == [(7, "H. Merestead", "Hiro Merestead"), (7, "H. Merestead", "Merestead, Hiro"), (7, "Hiro Merestead", "Merestead, Hiro"), (8, "H. Merestead", "Hiro Mereestead")]
    assert N.found(votes.limit(0), speakers.limit(0)).count() == 0


def test_rows_without_an_id(spark):
    votes = spark.createDataFrame([(None, 7, "Hiro Merestead"), (None, 7, "H. Merestead"), (None, 8, "Zoë Skellric"), (1, 8, "Z. Skellric"), (1, 8, "Z. Skellric")], "row_id bigint, term_id bigint, member string")
    speakers = spark.createDataFrame([], "term_id bigint, runner_up struct<name:string,similarity:double>")
    assert sorted(map(tuple, N.found(votes, speakers).collect())) == [(7, "H. Merestead", "Hiro Merestead"), (8, "Z. Skellric", "Zoë Skellric")]
