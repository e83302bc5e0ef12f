from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from quorumlake.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings meetings motions votes_by_member_raw speakers transcript_lines bodies value_list eval_items reading_labels".split()


def plain(x):
    if isinstance(x, float):
        return None if x != x else round(x, 5)
    if isinstance(x, Decimal):
        return round(float(x), 5)
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else float(x) if isinstance(x, int) else x


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, duck, name):
    mine = registry.QUERIES[name](spark, FOLDER)
    theirs = duck.sql(registry.ORACLE[name])
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    a = sorted(repr(plain(tuple(r))) for r in mine.select(*(f"`{c}`" for c in columns)).collect())
    b = sorted(repr(plain(r)) for r in duck.sql(f"SELECT {quoted} FROM ({registry.ORACLE[name]})").fetchall())
    assert a == b


def test_entry(spark):
    assert E.entry(spark).count() > 0
