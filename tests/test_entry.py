"""Every registered query against its SQL on the given tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


def plain(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


TEXT = re.compile(r"op\d+_|pipeline$")  # these have tests of their own
NAMES = sorted(n for n in entry.queries() if not TEXT.match(n))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, sql, name):
    got = entry.queries()[name](spark, sf).toArrow()
    names = sorted(got.column_names)
    found = sql.execute(entry.oracle_sql()[name])
    order = [d[0] for d in found.description]
    assert sorted(order) == names
    expected = [tuple(plain(r[order.index(c)]) for c in names) for r in found.fetchall()]
    rows = [tuple(plain(r[c]) for c in names) for r in got.to_pylist()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 8 and sum(r.rows for r in rows) == 1500


def test_every_query_has_sql():
    assert set(NAMES) == {n for n in entry.oracle_sql() if not TEXT.match(n)}
