import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neighbours


def exact(rows, k):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], float)
    out = {}
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((v - v[list(ids).index(q)]) ** 2).sum(axis=1))
        own = ids != q
        best = np.lexsort((ids[own], d[own]))[:k]
        out[int(q)] = list(zip(ids[own][best].tolist(), d[own][best].tolist()))
    return out


def search(spark, rows, k=10):
    df = spark.createDataFrame([(i, x, 1, 0.0) for i, x in rows], "vec_id long, embedding array<double>, rank int, score double")
    found = neighbours.nearest(df, F.col("vec_id") % 100 == 0, k).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


@pytest.mark.parametrize("shard,block", [(20_000, 1000), (300, 3)])
def test_recall_and_exact_scores(spark, monkeypatch, shard, block):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", block)
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((10, 48))
    v = centre[rng.integers(0, 10, 1200)] * 0.4 + rng.standard_normal((1200, 48))
    rows = [(i, x.tolist()) for i, x in enumerate(v / np.linalg.norm(v, axis=1, keepdims=True))]
    want, got = exact(rows, 10), search(spark, rows)
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    known = dict(rows)
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        for _, i, s in found:
            assert s == pytest.approx(np.linalg.norm(np.subtract(known[i], known[q])), rel=1e-12)


def test_many_equal_vectors_give_the_smallest_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400, 0, -1)] + [(1000, [1.0, 2.0, 4.0])]
    got = search(spark, rows)
    assert [i for _, i, _ in got[100]] == list(range(1, 11)) and all(s == 0 for _, _, s in got[100])


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0]), (100, None), (None, [1.0, 1.0])]
    assert search(spark, rows) == {0: [(1, 1, pytest.approx(0.141421356))]}


def test_empty_table(spark):
    assert search(spark, []) == {}


def test_queries_meet_every_shard_however_tasks_are_dealt(spark, monkeypatch):
    """Small partitions are merged into one by adaptive execution; kept apart, each pair of blocks must still meet."""
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 2)
    v = np.random.default_rng(5).standard_normal((700, 16))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = search(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = exact(rows, 10)
    assert set(got) == set(want)
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
