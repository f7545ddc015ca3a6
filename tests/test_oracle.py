"""Every query against its SQL, over whole tables of the smallest size."""

import pytest

import __spark_entry__ as contract
from catalog import ingest, recommend, sessions, stats, streams, tables
from catalog.check import difference

OWN = (ingest, recommend, sessions, stats, streams, tables)

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    own = {name for group in OWN for name in group.QUERIES}
    assert own - set(SQL) == {"als_topk"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), SQL[name], FOLDER) is None


def test_entry_is_the_flagship(spark):
    rows = contract.entry(spark)
    assert rows.columns[:4] == ["session_id", "user_id", "window_start", "window_end"]
    assert rows.count() > 0


def test_als_recommends_to_every_user(spark):
    rows = QUERIES["als_topk"](spark, FOLDER).collect()
    users = {row.user_id for row in rows}
    assert len(users) == 15
    assert all(1 <= row["rank"] <= 10 for row in rows)
    assert len({(row.user_id, row.content_id) for row in rows}) == len(rows)
