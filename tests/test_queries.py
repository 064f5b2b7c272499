"""Every registered query with SQL of its own gives DuckDB's rows on the smallest tables."""

import math
import os

import duckdb
import pytest

from strandline import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{SF}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def normal(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    wanted = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    rows = [tuple(row[i] for i in order) for row in wanted.fetchall()]
    assert normal(map(tuple, found.select(*[f"`{c}`" for c in columns]).collect())) == normal(rows)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_flagship_is_registered():
    assert queries.FLAGSHIP in queries.QUERIES
