"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import contextlib
import io
import math

import duckdb
import pytest

import __spark_entry__ as entry
from cliqueflow.plans import catalog, oracle

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN"}


def test_every_query_of_the_graph_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cur.description}
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == types
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "EvalPython" not in buf.getvalue()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["name", "influencers", "size"]
