"""The monthly monitoring job: compare a new period with the production
period and decide on a promotion.

One long report (check, feature, statistic, value, p_value, threshold,
flagged) gathers the null check, the summary-statistics check and the
distribution tests, so a run writes one table and a dashboard reads one
table. The gate returns a verdict; ``promote_if`` appends the stage move
to the registry event log only when the verdict allows it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import drift, runs, stats
from tidemark.plans import registry
from tidemark.sources import io

REPORT_COLUMNS = ["check", "feature", "statistic", "value", "p_value", "threshold", "flagged"]


def period_report(production: DataFrame, new: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  null_threshold: float = 0.5, stats_limit: float = 0.1, p_threshold: float = 0.05,
                  statistics: Sequence[str] = drift.DRIFT_STATISTICS, ks_law: str = "finite") -> DataFrame:
    """All checks of one monthly run in one long table."""
    numeric, categorical = list(numeric), list(categorical)
    nulls = stats.null_proportions(new, null_threshold, numeric + categorical, flagged_only=False).select(
        F.lit("nulls").alias("check"), "feature", F.lit("null_fraction").alias("statistic"),
        F.col("null_fraction").alias("value"), F.lit(None).cast("double").alias("p_value"),
        F.lit(float(null_threshold)).alias("threshold"), F.col("flagged"))
    parts = [nulls]
    if numeric:
        prod_stats, new_stats = stats.paired_summary_stats(production, new, numeric)
        moved = drift.summary_drift(new_stats, prod_stats, numeric, stats_limit, statistics)
        parts.append(moved.select(
            F.lit("summary").alias("check"), "feature", "statistic", F.col("new_value").alias("value"),
            F.lit(None).cast("double").alias("p_value"), F.lit(float(stats_limit)).alias("threshold"),
            F.lit(True).alias("flagged")))
    tests = drift.drift_report(production, new, numeric, categorical, p_threshold, ks_law=ks_law)
    parts.append(tests.select(
        F.col("test").alias("check"), "feature", F.lit("statistic").alias("statistic"),
        F.col("statistic").alias("value"), "p_value", F.col("alpha").alias("threshold"),
        F.col("drifted").alias("flagged")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*REPORT_COLUMNS)


def production_baseline(events: DataFrame, details_path: str, stats_path: str, model: str,
                        period_col: str | None = None) -> tuple[str, DataFrame, DataFrame]:
    """Where a monthly comparison starts: the run behind the version of ``model`` in
    production, the data as it was at the version that run was trained on, and the
    statistics stored with the run. Returns (run_id, data, stats)."""
    spark = events.sparkSession
    prod = runs.runs_in_stage(events, "Production").where(F.col("model") == model).first()  # one row per model
    if prod is None or prod["run_id"] is None:
        raise ValueError(f"{model} has no version in production with a run")
    run = spark.read.parquet(details_path).where(F.col("run_id") == prod["run_id"]).first()  # one row per run
    if run is None:
        raise ValueError(f"run {prod['run_id']} left no details")
    data = io.read_as_of(spark.read.parquet(run["data_path"]), run["data_version"], period_col)
    return run["run_id"], data, io.load_stats(spark, stats_path, run["run_id"])


def baseline_of(spark: SparkSession, store: str, events_path: str, model: str, period_col: str | None = None) -> tuple[Row, DataFrame, DataFrame]:
    """As ``production_baseline`` for runs kept in a ``registry`` store: (the run's record, its data
    as of its version, its statistics)."""
    run_id = registry.run_in_stage(registry.stage_log(spark, events_path), model, "Production")
    run = registry.run_record(spark, store, run_id).first()  # one row
    data = io.read_as_of(spark.read.parquet(run["data_path"]), run["data_version"], period_col)
    return run, data, registry.run_profile(spark, store, run_id)


def promote_if(gate: DataFrame, events_path: str, model: str, version: int,
               stage: str = "Production", allow=("PROCEED",), run_id: str | None = None) -> bool:
    """Append (model, version, stage, archive_existing=True, now) to the
    stage event log when the gate's verdict is allowed. ``gate`` is the
    one-row result of ``drift.promotion_gate``; only that row is read."""
    row = gate.select("verdict").first()
    if row is None or row["verdict"] not in set(allow):
        return False
    spark = gate.sparkSession
    event = spark.createDataFrame([(model, int(version), stage, True, run_id)],
                                  "model string, version int, stage string, archive_existing boolean, run_id string")
    event.withColumn("at", F.current_timestamp().cast("timestamp_ntz")).write.mode("append").parquet(events_path)
    return True
