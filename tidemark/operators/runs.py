"""Queries over run and model-stage tables (the tracking and registry
bookkeeping kept as plain tables).

runs:         experiment, run_id, start_time, metric, value
stage_events: model, version, stage, archive_existing, at, run_id
run_details:  run_id, data_path, data_version, period, n_rows, n_train, n_test, parameters, signature
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Registry stage names.
STAGES = ("None", "Staging", "Production", "Archived")


def latest_run(runs: DataFrame) -> DataFrame:
    """Latest run per experiment by start time (ties to the larger run_id)."""
    per_run = runs.groupBy("experiment", "run_id").agg(F.max("start_time").alias("start_time"))
    return per_run.groupBy("experiment").agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"),
        F.max("start_time").alias("start_time"))


def latest_experiment(runs: DataFrame) -> DataFrame:
    """The experiment with the most recent run (one row)."""
    return runs.agg(F.max_by("experiment", F.struct("start_time", "experiment")).alias("experiment"),
                    F.max("start_time").alias("last_update"))


def best_run(runs: DataFrame, metric: str, higher_is_better: bool = True) -> DataFrame:
    """Best run per experiment on ``metric``; ties go to the smaller run_id.
    A grouped min_by (partial aggregation), not a sort of all runs."""
    r = runs.where((F.col("metric") == metric) & F.col("value").isNotNull())
    v = F.col("value")
    key = F.struct((-v if higher_is_better else v).alias("v"), F.col("run_id").alias("r"))
    return r.groupBy("experiment").agg(F.min_by("run_id", key).alias("run_id"),
                                       (F.max(v) if higher_is_better else F.min(v)).alias("value"))


def current_stages(events: DataFrame) -> DataFrame:
    """Stage of every model version after replaying the event log.

    An event moves (model, version) to ``stage``; with archive_existing, a
    move into Staging or Production archives the versions that held that
    stage before it (a later archiving move into the stage a version holds
    archives it). Result: model, version, stage. Both steps are grouped
    aggregates; no event is paired with every other event of its model."""
    last = events.groupBy("model", "version").agg(
        F.max_by(F.struct("stage", "at"), F.struct("at", "stage")).alias("_last"))
    cur = last.select("model", "version", F.col("_last.stage").alias("stage"), F.col("_last.at").alias("since"))
    # Archiving moves: per (model, stage) the latest archiving entry.
    arch = (events.where(F.col("archive_existing") & F.col("stage").isin("Staging", "Production"))
            .groupBy("model", "stage").agg(F.max("at").alias("_arch_at")))
    j = cur.join(arch, ["model", "stage"], "left")
    archived = F.col("_arch_at").isNotNull() & (F.col("_arch_at") > F.col("since"))
    return j.select("model", "version",
                    F.when(archived, F.lit("Archived")).otherwise(F.col("stage")).alias("stage"))


def model_in_stage(events: DataFrame, stage: str) -> DataFrame:
    """Latest version per model currently in ``stage``."""
    if stage not in STAGES:
        raise ValueError(f"stage {stage!r} is none of {STAGES}")
    cur = current_stages(events).where(F.col("stage") == stage)
    return cur.groupBy("model").agg(F.max("version").alias("version"))


def latest_model_version(events: DataFrame) -> DataFrame:
    """Highest version per model regardless of stage."""
    return events.groupBy("model").agg(F.max("version").alias("latest_version"))


def version_runs(events: DataFrame) -> DataFrame:
    """(model, version, run_id): the run each model version was registered from, that of its first event."""
    first = F.min_by("run_id", F.struct("at", "run_id"))
    return events.where(F.col("run_id").isNotNull()).groupBy("model", "version").agg(first.alias("run_id"))


def runs_in_stage(events: DataFrame, stage: str) -> DataFrame:
    """(model, version, run_id) of the latest version of each model in ``stage``."""
    return model_in_stage(events, stage).join(version_runs(events), ["model", "version"], "left")


def log_details(record: DataFrame, path: str, data_path: str, data_version: int, period: str, parameters: dict,
                signature: dict) -> None:
    """Append what a training run used to the run_details table at ``path``; ``record``
    is the one-row result of ``ml.train_run`` (run_id and row counts)."""
    import json
    record.select("run_id", F.lit(data_path).alias("data_path"), F.lit(int(data_version)).alias("data_version"), F.lit(period).alias("period"),
                  "n_rows", "n_train", "n_test", F.lit(json.dumps(parameters, sort_keys=True)).alias("parameters"),
                  F.lit(json.dumps(signature, sort_keys=True)).alias("signature")).write.mode("append").parquet(path)
