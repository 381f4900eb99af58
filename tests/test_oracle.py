"""Every registered query with an oracle matches DuckDB on the small tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.15g}")
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, int):
        return float(v)
    try:
        return float(v)
    except (TypeError, ValueError):
        return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    """Queries without SQL give rows of their declared columns; their own tests hold the values."""
    df = entry.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and all(any(v is not None for v in r) for r in rows)
    assert len(set(df.columns)) == len(df.columns)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"feature", "statistic", "prod_value", "new_value", "lower", "upper", "direction"}
    df.collect()


RANGED = ["summary_stats", "summary_drift", "box_stats", "levene_stat", "ks_stat", "chi2_paired_stat",
          "stratified_split", "impute_median", "roc_auc", "records_payload", "split_payload"]


@pytest.mark.parametrize("name", RANGED)
def test_many_ranges_match_oracle(spark, con, monkeypatch, name):
    """The same answers when every group is cut into many ranges (the path
    large inputs take)."""
    from tidemark.operators import ranking
    monkeypatch.setattr(ranking, "TARGET_ROWS_PER_RANGE", 300)
    monkeypatch.setattr(ranking, "MIN_ROWS_PER_RANGE", 50)
    test_query_matches_oracle(spark, con, name)
