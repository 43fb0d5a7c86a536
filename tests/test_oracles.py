import datetime
import decimal

import duckdb
import pytest
from colloquy.plans import catalog

TABLES = "documents embeddings pages benchmark labels conversations events".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 9)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    result = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    key = lambda row: [(x is None, str(x)) for x in row]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=key)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_scores_fall_and_results_ignore_partitioning(spark, sf):
    from colloquy.operators import search
    from colloquy.plans import stand_ins as S

    rows = catalog.search_pipeline(spark, sf).collect()
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    again = search.search(S.index(spark, sf).repartition(7), S.files(spark, sf).repartition(3), S.QUERY, S.query_vector(spark, sf)).collect()
    assert rows == again
    assert search.search(S.index(spark, sf), S.files(spark, sf), " ", S.query_vector(spark, sf)).count() == 0


def test_plans_push_filters_and_prune_columns(spark, sf):
    text = catalog.QUERIES["token_estimate"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text and "Exchange" not in text
    listed = catalog.QUERIES["cosine_topk"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in listed and "Exchange" not in listed
