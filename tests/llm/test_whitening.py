import math

import numpy as np
import pytest

from tidemark.llm import catalog, whitening


def plain(vectors):
    """n, sums, deviations, eigenvalues and whitened entries of plain lists, by the library's solver."""
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = fit - sums / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, sums)) for r in x]
    return n, sums, deviation, values, (x - sums / n) @ axes / np.sqrt(np.maximum(values, 1e-300)), np.trace(z.T @ z / n)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1) for i, v in rows], "vec_id long, embedding array<double>, whitened string, n int")


def test_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 12 * 7)
    monkeypatch.setattr(whitening, "FAN", 2)
    r = np.random.default_rng(3)
    v = r.normal(size=(400, 12)) * np.linspace(5, 0.1, 12) + r.normal(size=12)
    v = np.vstack([v, v[:50], np.repeat(v[:1], 200, axis=0), v[60:70] + 1e-5])
    df = frame(spark, [(i, x.tolist()) for i, x in enumerate(v)]).repartition(9)
    model = whitening.fit(df)
    n, sums, deviation, values, w, trace = plain(v)
    assert model.n == n and list(model.sums) == sums.tolist()
    assert np.allclose(model.values, values[:4], rtol=1e-12) and math.isclose(model.trace, trace, rel_tol=1e-12)
    got = whitening.transform(df, model).collect()
    assert len(got) == len(v) and all(deviation[g.vec_id] == g.deviation for g in got)
    mine = np.array([g.whitened for g in sorted(got, key=lambda g: g.vec_id)])
    sign = np.sign((mine * w[:, :4]).sum(axis=0))
    assert np.abs(mine - w[:, :4] * sign).max() < 1e-10 and model.identity_error < 1e-10


def matrices():
    r = np.random.default_rng(7)
    for d, values in ((1, [3.0]), (2, [1, 1]), (5, [4, 4, 4, 1, 0]), (40, [1 + 1e-9 * k for k in range(40)]), (64, r.random(64)),
                      (64, [1] * 32 + [1 + 1e-6] * 32), (30, [10.0 ** -k for k in range(30)]), (48, [2] * 3 + [1] * 45),
                      (50, 1e12 * (1 + 1e-7 * r.random(50))), (40, [1.0] * 10 + [0.0] * 30), (3, [0, 0, 0]),
                      (60, np.concatenate([1 + 1e-8 * np.arange(20), 1 + 1e-4 * np.arange(20), r.random(20)]))):
        q = np.linalg.qr(r.normal(size=(d, d)))[0]
        a = q @ np.diag(values) @ q.T
        yield (a + a.T) / 2


@pytest.mark.parametrize("a", list(matrices()), ids=range(12))
def test_eigenvectors_to_double_precision(a):
    """Backward errors as small as those of a double-precision solver, also in clusters."""
    values, x = whitening.eigen(a)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ x - x * values).max() < 2e-14 * len(a) * scale
    assert (np.diff(values) <= 0).all() and np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-14 * len(a) * scale)


def test_a_start_in_float32_is_not_enough():
    a = list(matrices())[4]
    low = np.linalg.eigh(a.astype(np.float32))
    assert np.abs(a @ low[1] - low[1] * low[0]).max() > 1e-8


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (None, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0]), (7, []),
            (8, [-0.0, 1e-9]), (8, [-0.0, 1e-9]), (9, [3.0, -4.0]), (10, [1e300, 0.0]), (11, [1.0, 2.0 + 1e-4])]
    df = frame(spark, rows)
    model = whitening.fit(df)
    assert (model.n, model.sums, len(model.values)) == (3, (256 + 768, 512 - 1024), 2)
    got = {(g.vec_id, tuple(g.embedding)): g for g in whitening.transform(df, model).collect()}
    assert sorted(str(k[0]) for k in got) == ["1", "11", "8", "9", "None"] and got[(1, (1.0, 2.0))].deviation == got[(11, (1.0, 2.0001))].deviation
    want = plain([[1.0, 2.0], [0.0, 0.0], [3.0, -4.0]])
    assert got[(9, (3.0, -4.0))].deviation == want[2][2] and math.isclose(sum(model.explained), 1)
    assert whitening.fit(frame(spark, [(1, None), (2, [])])) is None
    assert whitening.transform(frame(spark, [(1, [1.0])]), None).collect() == []
    one = frame(spark, [(1, [5.0, 5.0]), (2, [5.0, 5.0])])
    model = whitening.fit(one)
    assert model.n == 1 and [(g.whitened, g.deviation) for g in whitening.transform(one, model).collect()] == [([], 0), ([], 0)]
    flat = frame(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)])
    assert len(whitening.fit(flat).values) == 1


def test_large_entries_stay_exact(spark):
    big = [2.0**40, -(2.0**50), 3.0, 2.0**54 - 1024]
    df = frame(spark, [(i, [b, 1.0]) for i, b in enumerate(big)])
    model = whitening.fit(df)
    x = [math.floor(256 * b) for b in big]
    assert model.sums == (sum(x), 256 * 4)
    got = {g.vec_id: g.deviation for g in whitening.transform(df, model).collect()}
    exact = {i: (4 * v - sum(x)) ** 2 for i, v in enumerate(x)}
    assert got == {i: v if v < 2**63 else None for i, v in exact.items()}


def test_query(spark, sf_small):
    got = catalog.QUERIES["op13_whitening"](spark, sf_small).collect()
    rows = spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, _, deviation, values, w, trace = plain([r.embedding for r in rows])
    at = {r.vec_id: i for i, r in enumerate(rows)}
    assert len(got) == 4 * len(rows)
    sign = {k: np.sign(sum(g.whitened * w[at[g.vec_id], k - 1] for g in got if g.component == k)) for k in range(1, 5)}
    for g in got:
        assert g.n == n and g.deviation == deviation[at[g.vec_id]] and g.identity_error < 1e-10
        assert math.isclose(g.explained, values[g.component - 1] / trace, rel_tol=1e-11)
        assert abs(g.whitened - sign[g.component] * w[at[g.vec_id], g.component - 1]) < 1e-9
