import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import pvalues
from tidemark.operators import drift, stats


def _frame(spark, values, col="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{col} double")


def _cat(spark, values, col="c"):
    return spark.createDataFrame([(v,) for v in values], f"{col} string")


# ------------------------------------------------------------- p-values against textbook quantiles

def test_chi2_sf_textbook():
    assert pvalues.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert pvalues.chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert pvalues.chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)


def test_f_sf_textbook():
    assert pvalues.f_sf(4.9646027437307145, 1, 10) == pytest.approx(0.05, abs=1e-9)
    assert pvalues.f_sf(3.8853, 2, 12) == pytest.approx(0.05, abs=1e-4)


def test_kolmogorov_textbook(spark):
    df = spark.createDataFrame([(1.3580986393225505,), (0.0,), (3.0,)], "lam double")
    got = [r[0] for r in df.select(pvalues.kolmogorov_sf(F.col("lam"))).collect()]
    assert got[0] == pytest.approx(0.05, abs=1e-6)
    assert got[1] == 1.0
    assert got[2] == pytest.approx(2 * math.exp(-18), rel=1e-3)


# ------------------------------------------------------------- statistics against brute force

def _levene(a, b):
    za = np.abs(a - np.median(a))
    zb = np.abs(b - np.median(b))
    z = np.concatenate([za, zb])
    n = len(z)
    num = len(za) * (za.mean() - z.mean()) ** 2 + len(zb) * (zb.mean() - z.mean()) ** 2
    den = ((za - za.mean()) ** 2).sum() + ((zb - zb.mean()) ** 2).sum()
    return (n - 2) * num / den


def _ks(a, b):
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return max(0, (fa - fb).max()), max(0, (fb - fa).max())


def test_levene_and_ks_match_brute_force(spark):
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(0, 1, 400), 2)
    b = np.round(rng.normal(0.3, 1.5, 300), 2)
    ref, new = _frame(spark, a), _frame(spark, b)
    lv = drift.levene(ref, new, ["x"]).collect()[0]
    assert lv["statistic"] == pytest.approx(_levene(a, b), rel=1e-9)
    assert lv["p_value"] == pytest.approx(pvalues.f_sf(_levene(a, b), 1, 698), rel=1e-9)
    ks = drift.ks_statistics(ref, new, ["x"]).collect()[0]
    dp, dm = _ks(a, b)
    assert ks["d_plus"] == pytest.approx(dp) and ks["d_minus"] == pytest.approx(dm)
    assert ks["d"] == pytest.approx(max(dp, dm))
    t = drift.ks_test(ref, new, ["x"], 0.05, "greater").collect()[0]
    assert t["statistic"] == pytest.approx(dp) and t["test"] == "ks_greater"


def test_ks_identical_samples(spark):
    ref = _frame(spark, [1, 2, 3, 3, 4])
    r = drift.ks_test(ref, ref, ["x"], 0.05).collect()[0]
    assert r["statistic"] == 0.0 and r["p_value"] == 1.0 and not r["drifted"]


def test_nulls_are_dropped_and_counted(spark):
    ref = _frame(spark, [1, 2, 3, None, 5, 6])
    new = _frame(spark, [1, None, None, 9, 10, 11])
    r = drift.levene(ref, new, ["x"]).collect()[0]
    assert r["dropped"] == 3 and r["n_ref"] == 5 and r["n_new"] == 4


# ------------------------------------------------------------- chi-square

def _table(spark, counts):
    rows = [("ref" if i == 0 else "new", lvl) for i, row in enumerate(counts)
            for lvl, n in zip("ab", row) for _ in range(n)]
    return spark.createDataFrame(rows, "side string, c string")


def test_chi2_homogeneity_yates_and_plain(spark):
    df = _table(spark, [[10, 20], [20, 10]])
    ref, new = df.where("side = 'ref'"), df.where("side = 'new'")
    y = drift.chi2_homogeneity(ref, new, ["c"]).collect()[0]
    p = drift.chi2_homogeneity(ref, new, ["c"], yates=False).collect()[0]
    assert p["statistic"] == pytest.approx(20 / 3)
    assert y["statistic"] == pytest.approx(4 * 4.5 ** 2 / 15)
    assert y["p_value"] == pytest.approx(pvalues.chi2_sf(5.4, 1))


def test_chi2_zero_cell_level_only_in_one_period(spark):
    ref = _cat(spark, ["a"] * 5 + ["b"] * 5 + ["c"] * 4)
    new = _cat(spark, ["a"] * 6 + ["b"] * 6)
    r = drift.chi2_homogeneity_table(ref, new, ["c"]).collect()[0]
    obs = np.array([[5, 5, 4], [6, 6, 0]], dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert r["statistic"] == pytest.approx(((obs - exp) ** 2 / exp).sum())
    assert r["dof"] == 2


def test_chi2_zero_cell_2x2_yates(spark):
    ref = _cat(spark, ["a"] * 7 + ["b"] * 3)
    new = _cat(spark, ["a"] * 9)
    r = drift.chi2_homogeneity_table(ref, new, ["c"]).collect()[0]
    obs = np.array([[7, 3], [9, 0]], dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    adj = obs + np.minimum(0.5, np.abs(exp - obs)) * np.sign(exp - obs)
    assert r["statistic"] == pytest.approx(((adj - exp) ** 2 / exp).sum())


def test_chi2_one_level_has_no_dof(spark):
    ref, new = _cat(spark, ["a", "a"]), _cat(spark, ["a"])
    r = drift.chi2_homogeneity(ref, new, ["c"]).collect()[0]
    assert r["statistic"] == 0.0 and r["p_value"] == 1.0


def test_chi2_paired_pairs_rows_by_order(spark):
    ref = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(20)], "k long, c string")
    new = spark.createDataFrame([(100 + i, "a" if i % 2 else "b") for i in range(25)], "k long, c string")
    r = drift.chi2_paired_table(ref, new, ["c"], "k", yates=False).collect()[0]
    assert r["N"] == 20 and r["statistic"] == pytest.approx(20.0) and r["dof"] == 1


# ------------------------------------------------------------- summary drift and gate

def test_summary_drift_negative_prod(spark):
    prod = spark.createDataFrame([("x", "mean", -10.0), ("y", "mean", 10.0)], "feature string, statistic string, value double")
    new = spark.createDataFrame([("x", "mean", -10.0), ("y", "mean", 12.0)], "feature string, statistic string, value double")
    fixed = drift.summary_drift(new, prod, ["x", "y"], 0.1, ["mean"]).collect()
    assert [(r["feature"], r["direction"]) for r in fixed] == [("y", "higher")]
    literal = {r["feature"] for r in drift.summary_drift(new, prod, ["x", "y"], 0.1, ["mean"], strict_reference=True).collect()}
    assert literal == {"x", "y"}  # crossed bounds flag an unchanged negative value
    with pytest.raises(ValueError):
        drift.summary_drift(new, prod, ["x"], 1.5)


def test_promotion_gate(spark):
    df = spark.createDataFrame([(1.10, 1.0), (1.01, 1.0), (0.99999, 1.0), (0.9, 1.0), (1.0, -1.0), (1.0, None)],
                               "staging double, prod double")
    got = [r["verdict"] for r in drift.promotion_gate(df, "staging", "prod", 0.05).collect()]
    assert got == ["PROCEED", "CAUTION", "CAUTION", "ALERT", "INVALID", "INVALID"]
    with pytest.raises(ValueError):
        drift.promotion_gate(df, "staging", "prod", -0.1)


def test_mode_drift_tie_goes_to_smallest(spark):
    ref, new = _cat(spark, ["b", "a", "a", "b"]), _cat(spark, ["b", "b", "a"])
    r = drift.mode_drift(ref, new, ["c"]).collect()[0]
    assert r["ref_mode"] == "a" and r["new_mode"] == "b" and r["changed"]


# ------------------------------------------------------------- profiles

def test_null_proportions_threshold_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b"), (4.0, "c")], "x double, c string")
    got = {r["feature"]: r["null_fraction"] for r in stats.null_proportions(df, 0.5).collect()}
    assert got == {"x": 0.5}
    assert stats.null_proportions(df.limit(0), 0.0).count() == 0
    with pytest.raises(ValueError):
        stats.null_proportions(df, 1.2)


def test_summary_stats_match_pandas(spark):
    import pandas as pd
    vals = [3.0, 1.0, None, 7.0, 7.0, 2.5]
    df = _frame(spark, vals)
    got = {r["statistic"]: r["value"] for r in stats.summary_stats(df, ["x"]).collect()}
    s = pd.Series(vals, dtype="float64")
    d = s.describe()
    for k in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
        assert got[k] == pytest.approx(d[k])
    assert got["median"] == pytest.approx(s.median()) and got["null_count"] == 1


def test_categorical_stats(spark):
    df = _cat(spark, ["x", "y", "y", None, "x", "z"])
    got = {r["statistic"]: (r["value"], r["text"]) for r in stats.categorical_stats(df, ["c"]).collect()}
    assert got["count"][0] == 5 and got["unique"][0] == 3 and got["top"][1] == "x" and got["freq"][0] == 2


def test_box_stats(spark):
    vals = list(range(1, 21)) + [100]
    r = stats.box_stats({"a": _frame(spark, vals)}, ["x"]).collect()[0]
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert r["q1"] == q1 and r["q3"] == q3 and r["whisker_hi"] == 20 and r["n_outliers"] == 1


def test_roc_auc_matches_pairwise_count(spark):
    from tidemark.operators import metrics
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.normal(0, 1, 300) + y * 0.7, 1)  # rounded: many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    got = metrics.roc_auc(df, "y", "s").collect()[0]
    pos, neg = s[y == 1], s[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    assert got["auc"] == pytest.approx(pairs / (len(pos) * len(neg)), rel=1e-12)
    assert got["n_pos"] == len(pos) and got["n_neg"] == len(neg)


def test_hot_value_with_many_ranges(spark, monkeypatch):
    """A value holding a third of all rows, groups cut into many ranges:
    KS and Levene still equal the brute-force answers."""
    from tidemark.operators import ranking
    monkeypatch.setattr(ranking, "TARGET_ROWS_PER_RANGE", 40)
    monkeypatch.setattr(ranking, "MIN_ROWS_PER_RANGE", 10)
    rng = np.random.default_rng(7)
    a = np.round(rng.normal(5, 2, 600), 1)
    b = np.round(rng.normal(5.3, 2.5, 450), 1)
    a[:200] = 5.0
    b[:150] = 5.0
    ref, new = _frame(spark, a), _frame(spark, b)
    ks = drift.ks_statistics(ref, new, ["x"]).collect()[0]
    dp, dm = _ks(a, b)
    assert ks["d_plus"] == pytest.approx(dp) and ks["d_minus"] == pytest.approx(dm)
    assert drift.levene(ref, new, ["x"]).collect()[0]["statistic"] == pytest.approx(_levene(a, b), rel=1e-9)


def test_paired_summary_equals_separate_profiles(spark):
    a = _frame(spark, [1.0, 2.0, 2.0, None, 9.0])
    b = _frame(spark, [4.0, 4.0, 5.0, 7.5])
    pa, pb = stats.paired_summary_stats(a, b, ["x"])
    for paired, single in ((pa, stats.summary_stats(a, ["x"])), (pb, stats.summary_stats(b, ["x"]))):
        got = {r["statistic"]: r["value"] for r in paired.collect()}
        want = {r["statistic"]: r["value"] for r in single.collect()}
        assert got == pytest.approx(want)


def test_kolmogorov_near_zero_is_one(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.001, 0.005, 0.01, 0.2, 0.999999, 1.0, 1.36, 5.0)], "lam double")
    got = [r[0] for r in df.select(pvalues.kolmogorov_sf(F.col("lam"))).collect()]
    assert got[:4] == [1.0] * 4 and abs(got[4] - 1.0) < 1e-9 and abs(got[5] - got[6]) < 1e-5
    assert abs(got[7] - 0.0494858) < 1e-6 and got[8] < 1e-20


def test_one_changed_value_in_many_is_no_drift(spark):
    ref = spark.range(0, 200_000).select(F.col("id").cast("double").alias("x"))
    new = ref.withColumn("x", F.when(F.col("x") == 7, -1.0).otherwise(F.col("x")))
    row = drift.ks_test(ref, new, ["x"]).first()
    assert row["p_value"] == 1.0 and not row["drifted"]


@pytest.mark.parametrize("stat,dof,want", [(3.841458820694124, 1, 0.05), (10, 10, 0.440493285), (0.5, 2, 0.778800783), (1e9, 1e9, 0.5), (1e10, 1e10, 0.5), (200, 3, 0)])
def test_chi2_tail(stat, dof, want):
    assert abs(pvalues.chi2_sf(stat, dof) - want) < 1e-5


@pytest.mark.parametrize("stat,d1,d2,want", [(4, 1, 10, 0.0733880), (2, 1, 1e14, 0.1572992), (161.4476, 1, 1, 0.05), (1, 1e8, 1e8, 0.5), (0.5, 3, 7, 0.6940364)])
def test_f_tail(stat, d1, d2, want):
    assert abs(pvalues.f_sf(stat, d1, d2) - want) < 1e-6


def test_feature_without_values_stays(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "g string, e string")
    out = {r["feature"]: r for r in drift.chi2_homogeneity(df, df, ["g", "e"]).collect()}
    assert out["e"]["p_value"] is None and out["e"]["dropped"] == 4 and not out["e"]["drifted"]
    prof = {(r["feature"], r["statistic"]): r["value"] for r in stats.categorical_stats(df, ["g", "e"]).collect()}
    assert prof["e", "count"] == 0 and prof["e", "null_count"] == 2 and prof["g", "unique"] == 2


def test_paired_test_counts_dropped_pairs(spark):
    ref = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(10)] + [(10, None)], "k int, g string")
    new = spark.createDataFrame([(i, "ab"[i // 5]) for i in range(10)] + [(10, "a")], "k int, g string")
    row = drift.chi2_paired(ref, new, ["g"], "k").first()
    assert row["dropped"] == 1 and row["n_ref"] == 10


def test_whisker_never_lies_inside_the_box(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 100)], "x double")
    row = stats.box_stats({"d": df}, ["x"]).first()
    assert row["q3"] == 27.25 and row["whisker_hi"] == 27.25 and row["whisker_lo"] == 1


# ------------------------------------------------------------- KS laws at finite n

def test_one_sample_law_known_values():
    """A published value of the matrix method, and 5 % points of printed tables."""
    assert 1 - pvalues.two_sided_sf(0.274, 10) == pytest.approx(0.6284796154565, abs=1e-12)
    for n, d in ((5, 0.56328), (10, 0.40925), (20, 0.29408), (50, 0.18841)):
        assert pvalues.two_sided_sf(d, n) == pytest.approx(0.05, abs=2e-5)


def test_one_sample_law_against_uniform_order_statistics():
    """n = 2 by hand: the area of 0 < u < v < 1 outside the band."""
    def outside(d):
        k = 1500
        g = (np.arange(k) + 0.5) / k
        u, v = np.meshgrid(g, g)
        u, v = np.minimum(u, v), np.maximum(u, v)
        stat = np.maximum.reduce([np.abs(u), np.abs(u - 0.5), np.abs(v - 0.5), np.abs(v - 1)])
        return (stat >= d).mean()
    for d in (0.3, 0.4, 0.55, 0.7):
        assert pvalues.two_sided_sf(d, 2) == pytest.approx(outside(d), abs=3e-3)


def test_one_sample_law_is_smooth_where_methods_meet(monkeypatch):
    n = 2000
    for d in (0.01, 0.015, 0.02, 0.03, 0.04, 0.0447):
        assert pvalues._inside_series(d, n) == pytest.approx(pvalues._inside_matrix(d, n), abs=5e-7)
    for n in (30, 500, 2000):
        d = 2.0 / math.sqrt(n)
        assert 2 * pvalues.one_sided_sf(d, n) == pytest.approx(1 - pvalues._inside_matrix(d, n), rel=1e-8)
    n, d = 10**6, 0.0025
    whole = pvalues.one_sided_sf(d, n)
    monkeypatch.setattr(pvalues, "SUM_TERMS", 10)
    assert pvalues.one_sided_sf(d, n) == pytest.approx(whole, rel=1e-4)
    assert pvalues.two_sided_sf(1e-9, 50) == 1.0 and pvalues.two_sided_sf(1.0, 50) == 0.0 and math.isnan(pvalues.two_sided_sf(0.5, 0))


def test_exact_two_sample_law_by_counting_orders():
    from itertools import combinations
    for m, n in ((1, 1), (2, 3), (4, 4), (3, 6), (5, 4)):
        stats_ = []
        for places in combinations(range(m + n), m):
            i = j = top = 0
            for s in range(m + n):
                i, j = (i + 1, j) if s in places else (i, j + 1)
                top = max(top, abs(i * n - j * m))
            stats_.append(top)
        for t in sorted(set(stats_)):
            want = sum(x >= t for x in stats_) / len(stats_)
            assert pvalues.exact_two_sample_sf(t / (m * n), m, n) == pytest.approx(want, rel=1e-12)
    assert pvalues.exact_two_sample_sf(0.0, 4, 4) == 1.0
    # both laws agree for larger samples
    assert pvalues.ks_law(0.12, 300, 280, "exact") == pytest.approx(pvalues.ks_law(0.12, 300, 280, "finite"), rel=0.1)


def test_ks_by_groups(spark):
    rng = np.random.default_rng(8)
    rows = [(str(g) if g else None, s, float(round(v, 1))) for g in range(3) for s in (0, 1) for v in rng.normal(g * s, 1, 25 + g)]
    rows += [("only", 0, 1.0), ("1", 0, None)]
    df = spark.createDataFrame(rows, "g string, s int, x double")
    got = {r["g"]: r for r in drift.ks_by(df.where("s = 0"), df.where("s = 1"), "g", ["x"]).collect()}
    assert set(got) == {None, "1", "2", "only"}
    for g in (None, "1", "2"):
        a, b = (np.array([v for h, t, v in rows if h == g and t == s and v is not None]) for s in (0, 1))
        d = max(_ks(a, b))
        assert got[g]["statistic"] == pytest.approx(d) and got[g]["p_value"] == pytest.approx(pvalues.exact_two_sample_sf(d, len(a), len(b)))
    assert got["only"]["p_value"] is None and got["1"]["dropped"] == 1 and not got["only"]["drifted"]


def test_law_names_are_checked(spark):
    ref = _frame(spark, [1, 2, 3])
    with pytest.raises(ValueError):
        drift.ks_test(ref, ref, ["x"], law="other")
