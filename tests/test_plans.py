"""Plan-shape checks: the properties the scale design relies on."""

import re

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import drift, ranking, stats


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def _windows_have_partition_keys(plan: str) -> bool:
    # "Window [exprs], [partition keys], [order keys]": keys must be non-empty
    return all(not re.match(r".*?\], \[\], \[", line) for line in plan.splitlines() if "Window [" in line)


def test_global_row_numbers_never_use_an_unpartitioned_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"))
    plan = _plan(ranking.row_numbers(df, [], "k", buckets=4))
    assert "Window [" in plan and _windows_have_partition_keys(plan)


def test_drift_summary_windows_are_partitioned(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    a = C.period_filter(li, "l_shipdate", "1996-01-01", "1997-01-01")
    b = C.period_filter(li, "l_shipdate", "1997-01-01", "1998-01-01")
    counts = drift.side_counts(a, b, ["l_quantity", "l_tax"])
    ranked = ranking.running_totals(counts.where("value is not null"), ["feature"], "value", ["c_ref", "c_new"],
                                    buckets=3, materialized=True)
    assert _windows_have_partition_keys(_plan(ranked))


def test_period_filter_and_pruning_reach_the_scan(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    df = C.period_filter(li, "l_shipdate", "1996-01-01", "1997-01-01").select("l_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>", plan)


def test_profile_scans_the_source_once(spark, sf_small):
    """All statistics read the checkpointed counts, so the final plan holds
    no scan of the source file."""
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    plan = _plan(stats.summary_stats(li, ["l_quantity", "l_tax"]))
    assert "lineitem.parquet" not in plan


def test_levene_shuffles_no_table(spark, sf_small):
    """Medians from brackets and one aggregate: what is shuffled is a few rows per task."""
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    a = C.period_filter(li, "l_shipdate", "1996-01-01", "1997-01-01")
    b = C.period_filter(li, "l_shipdate", "1997-01-01", "1998-01-01")
    df = drift.levene(a, b, ["l_quantity", "l_extendedprice"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:  # partial results by side and feature only
            assert re.search(r"hashpartitioning\((ds#\d+, )?feature#\d+(, ds#\d+)?, \d+\)", line)
    assert "Window" not in plan and "rangepartitioning" not in plan
    one = drift.side_counts(a, b, ["l_quantity", "l_extendedprice"])
    from_counts = {r.feature: r for r in drift.levene_from(one, drift.side_summary(one)).collect()}
    for r in df.collect():
        assert abs(r.statistic - from_counts[r.feature].statistic) < 1e-9 and (r.n_ref, r.n_new, r.dropped) == (
            from_counts[r.feature].n_ref, from_counts[r.feature].n_new, from_counts[r.feature].dropped)


def test_payload_ranges_hold_tied_orders(spark, monkeypatch):
    from tidemark.functions import payloads
    monkeypatch.setattr(ranking, "TARGET_ROWS_PER_RANGE", 500)
    df = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, 1).cast("long").alias("k"), F.col("id").alias("v"))
    got = payloads.records_payload(df, "k", ["v"], 100).collect()
    assert sorted(r.batch for r in got) == list(range(40)) and {r.n_rows for r in got} == {100}
