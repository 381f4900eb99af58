import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ranking
from tidemark.operators.ranking import exact_quantiles, row_numbers, running_totals


def _values(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(10, 3, n), 1)
    v[: n // 3] = 7.0  # a hot value holding a third of all rows
    return v


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_exact_quantiles_match_numpy(spark, buckets):
    v = _values()
    df = spark.createDataFrame([("a", float(x)) for x in v] + [("b", float(x) * 2) for x in v[:101]],
                               "feature string, value double")
    probs = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r["feature"]: r for r in exact_quantiles(df, ["feature"], probs, buckets=buckets).collect()}
    for feat, data in (("a", v), ("b", v[:101] * 2)):
        for name, p in probs.items():
            assert got[feat][name] == pytest.approx(np.quantile(data, p), abs=1e-9)
        assert got[feat]["n"] == len(data)


def test_quantiles_ignore_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0)], "feature string, value double")
    r = exact_quantiles(df, ["feature"], {"m": 0.5}).collect()[0]
    assert r["m"] == 2.0 and r["n"] == 2


def test_running_totals_exact_with_few_buckets(spark):
    df = spark.range(0, 1000).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"),
                                     (F.col("id") % 3).alias("w"))
    out = running_totals(df, ["g"], "v", ["w"], buckets=7).orderBy("v").collect()
    cum = np.cumsum([i % 3 for i in range(1000)])
    assert [r["cum_w"] for r in out] == cum.tolist()
    assert {r["total_w"] for r in out} == {int(cum[-1])}


def test_row_numbers_global(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("k"))
    out = row_numbers(df, [], "k", buckets=5).collect()
    assert sorted(r["row_number"] for r in out) == list(range(1, 501))
    assert all(r["row_number"] == r["k"] + 1 for r in out)


def test_range_count_sized_from_rows(spark, monkeypatch):
    """With a small per-range bound the profile runs through many ranges and
    still matches numpy exactly."""
    from tidemark.operators import ranking, stats
    monkeypatch.setattr(ranking, "TARGET_ROWS_PER_RANGE", 97)
    v = _values(2000, seed=5)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = {r["statistic"]: r["value"] for r in stats.summary_stats(df, ["x"]).collect()}
    for name, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        assert got[name] == pytest.approx(np.quantile(v, p), abs=1e-9)
    assert got["std"] == pytest.approx(np.std(v, ddof=1), rel=1e-9)
    assert ranking._n_buckets(df, None) == 21  # 2000 rows / 97 per range


def test_row_numbers_by_string_key(spark):
    keys = [f"k{(i * 37) % 500:05d}" for i in range(500)] + ["été", "a", "ab", "abcdefghij", "abcdefghik"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    out = {r["k"]: r["row_number"] for r in row_numbers(df, [], "k", buckets=6).collect()}
    expected = {k: i + 1 for i, k in enumerate(sorted(keys, key=lambda s: s.encode("utf-8")))}
    assert out == expected


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-50, 50), min_size=1, max_size=200), buckets=st.integers(1, 9),
       p=st.floats(0, 1))
def test_quantiles_property(spark, values, buckets, p):
    df = spark.createDataFrame([("f", float(v)) for v in values], "feature string, value double")
    got = exact_quantiles(df, ["feature"], {"q": p}, buckets=buckets).collect()[0]["q"]
    assert got == pytest.approx(float(np.quantile(np.array(values, dtype=float), p)), abs=1e-9)


def test_string_keys_with_a_long_common_prefix_spread_over_ranges(spark):
    df = spark.range(0, 20_000).select(F.format_string("Customer#%09d", "id").alias("k"))
    ranged = ranking.range_buckets(ranking.materialize(df), [], "k", buckets=8)
    sizes = [r["count"] for r in ranged.groupBy("_tm_bucket").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_null_group_keeps_its_rows(spark):
    df = spark.createDataFrame([(None, i, 1) for i in range(50)] + [("a", i, 1) for i in range(50)], "g string, v int, w int")
    out = ranking.running_totals(df, ["g"], "v", ["w"], buckets=4)
    assert out.count() == 100 and {r["total_w"] for r in out.collect()} == {50}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.none(), st.integers(-30, 30), st.floats(-5, 5)), min_size=1, max_size=300), accuracy=st.sampled_from([5, 20, 10_000]))
def test_bracketed_quantiles_equal_numpy(spark, values, accuracy):
    from tidemark.operators import stats
    stats_accuracy, stats.SKETCH_ACCURACY = stats.SKETCH_ACCURACY, accuracy
    try:
        df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")
        row = stats.quantiles(df, ["x"], {"a": 0.25, "b": 0.5, "c": 0.97}).first()
    finally:
        stats.SKETCH_ACCURACY = stats_accuracy
    own = [float(v) for v in values if v is not None]
    assert row["count"] == len(own) and row["null_count"] == len(values) - len(own)
    for name, p in (("a", 25), ("b", 50), ("c", 97)):
        assert row[name] == (pytest.approx(np.percentile(own, p), abs=1e-12) if own else None)


def test_profile_shuffles_no_table(spark, sf_small):
    from tidemark.operators import stats
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    moments, counts = stats.bracketed(li, ["l_extendedprice", "l_quantity"], {"m": 0.5})
    assert moments.count() == 2 and counts.groupBy("feature").count().where("count > 50").count() == 0


def test_rows_with_one_order_value_spread_over_ranges(spark):
    """Half of the rows share one order value, some have none, many are alike in all columns."""
    df = spark.range(0, 12_000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).cast("long").alias("k"),
                                       (F.col("id") % 5).alias("v"))
    base = ranking.materialize(df.withColumn("_tm_tie", F.xxhash64("k", "v"))).withColumn("_tm_at", F.monotonically_increasing_id())
    ranged = ranking.range_buckets(base, [], ["k", "_tm_tie", "_tm_at"], target_rows=1000)
    sizes = [r["count"] for r in ranged.groupBy("_tm_bucket").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 1000
    out = row_numbers(df, [], "k", buckets=8).collect()
    assert sorted(r["row_number"] for r in out) == list(range(1, 12_001))
    got = [(r["k"] is not None, r["k"]) for r in sorted(out, key=lambda r: r["row_number"])]
    assert got == sorted(got, key=lambda x: (x[0], x[1] or 0))
    again = row_numbers(df.repartition(5), [], "k", buckets=3).collect()
    assert set(map(tuple, out)) == set(map(tuple, again)) and len(out) == len(again)


def test_missed_brackets_are_widened(spark, monkeypatch):
    from tidemark.operators import stats
    widths, right = [], stats._ends

    def wrong(probs, accuracy, widen):
        widths.append(widen)
        return [0.9, 0.91] * len(probs) if widen < 256 else right(probs, accuracy, widen)
    monkeypatch.setattr(stats, "_ends", wrong)
    v = _values(2000, seed=9)
    row = stats.quantiles(spark.createDataFrame([(float(x),) for x in v], "x double"), ["x"], {"a": 0.25, "b": 0.5}).first()
    assert widths[:3] == [1, 16, 256] and row["a"] == pytest.approx(np.quantile(v, 0.25)) and row["b"] == pytest.approx(np.quantile(v, 0.5))
    monkeypatch.setattr(stats, "_ends", lambda probs, accuracy, widen: [0.9, 0.91] * len(probs))  # never right: all values counted
    row = stats.quantiles(spark.createDataFrame([(float(x),) for x in v], "x double"), ["x"], {"a": 0.25}).first()
    assert row["a"] == pytest.approx(np.quantile(v, 0.25))


def test_large_integers_and_decimals_keep_their_digits(spark):
    from decimal import Decimal

    from tidemark.operators import drift, stats
    top = 2**62
    rows = [(top + i, Decimal(f"1000000000000000000000000.00000{i}"), i, float(i)) for i in range(9)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "a long, b decimal(38,6), c int, d double")
    got = {(r.feature, r.statistic): r for r in stats.summary_stats(df, ["a", "b", "c", "d"], exact=True).collect()}
    assert [got["a", s].exact for s in ("min", "25%", "median", "max", "mean")] == [str(top), str(top + 2), str(top + 4), str(top + 8), None]
    assert got["b", "75%"].exact == "1000000000000000000000000.000006" and got["c", "max"].exact is None and got["d", "50%"].value == 4.0
    even = spark.createDataFrame([(top + i,) for i in range(4)], "a long")
    assert [r.exact for r in stats.summary_stats(even, ["a"], exact=True).where("statistic = 'median'").collect()] == [f"{top + 1}.5"]
    a, b = (spark.createDataFrame([(top + i,) for i in r], "a long") for r in (range(0, 40), range(40, 80)))
    assert drift.ks_statistics(a, b, ["a"]).first().d == 1.0
    a, b = (spark.createDataFrame([(str(top + i),) for i in r], "a string").selectExpr("cast(a as decimal(38,3)) a") for r in (range(0, 40), range(40, 80)))
    assert drift.ks_statistics(a, b, ["a"]).first().d == 1.0
