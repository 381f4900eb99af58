"""Training runs and models kept as folders, found again by run or by (model, stage).

``<store>/<run_id>/`` holds the fitted pipeline (``model``), the profile of its input
(``profile``) and, written last, one row that says what the run used and reached
(``record``). A run counts as there once its record is: the record is one file that Spark's
writer moves into place when it is whole, so a run that dies half-way is never listed, and
the next attempt under its id writes over what it left.

The stage of a model's versions is the event log of ``operators.runs``; a version names its
run, and the run's folder holds the model. Everything is read back from the store, so any
session that sees the folder can score."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import drift, runs

RECORD = ("experiment string, run_id string, finished timestamp_ntz, data_path string, data_version long, period string, n_rows long, "
          "n_train long, n_test long, metrics map<string,double>, parameters string, signature string")
EVENT = "model string, version int, stage string, archive_existing boolean, run_id string, at timestamp_ntz"
_ID = re.compile(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")

#: Types that a wider one takes without loss.
WIDENS = {"tinyint": ("smallint", "int", "bigint", "float", "double"), "smallint": ("int", "bigint", "float", "double"),
          "int": ("bigint", "double"), "float": ("double",)}


class SchemaMismatch(ValueError):
    """The input lacks a column of the model's signature, or holds another type."""


def folder(store: str, run_id: str) -> str:
    if not _ID.match(run_id):
        raise ValueError(f"run id {run_id!r} is no folder name")
    return f"{store.rstrip('/')}/{run_id}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def published_runs(spark: SparkSession, store: str) -> DataFrame:
    """The records of all runs that were published whole, one row each."""
    return _read(spark, f"{store.rstrip('/')}/*/record", RECORD)


def run_record(spark: SparkSession, store: str, run_id: str) -> DataFrame:
    return _read(spark, f"{folder(store, run_id)}/record", RECORD)


def run_profile(spark: SparkSession, store: str, run_id: str) -> DataFrame:
    """The statistics stored with a run: feature, statistic, value, text."""
    return spark.read.parquet(f"{folder(store, run_id)}/profile").select("feature", "statistic", "value", "text")


def publish_run(store: str, run_id: str, model: PipelineModel, profile: DataFrame, record: DataFrame, *, experiment: str,
                metrics: list[str], signature: dict, parameters: dict, data_path: str | None = None, data_version: int | None = None,
                period: str | None = None) -> DataFrame:
    """Write a run's folder, the record last, and return the record as stored.

    ``record`` is one row with n_rows, n_train, n_test and the ``metrics``. A published run
    is never written over."""
    spark, place = profile.sparkSession, folder(store, run_id)
    if run_record(spark, store, run_id).count():
        raise ValueError(f"run {run_id} is published")
    model.write().overwrite().save(f"{place}/model")
    profile.write.mode("overwrite").parquet(f"{place}/profile")
    pairs = [x for m in metrics for x in (F.lit(m), F.col(m).cast("double"))]
    whole = record.select(
        F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"), F.current_timestamp().cast("timestamp_ntz").alias("finished"),
        F.lit(data_path).cast("string").alias("data_path"), F.lit(data_version).cast("long").alias("data_version"), F.lit(period).cast("string").alias("period"),
        *[F.col(c).cast("long").alias(c) for c in ("n_rows", "n_train", "n_test")], F.create_map(*pairs).alias("metrics"),
        F.lit(json.dumps(parameters, sort_keys=True)).alias("parameters"), F.lit(json.dumps(signature, sort_keys=True)).alias("signature"))
    whole.coalesce(1).write.mode("overwrite").parquet(f"{place}/record")
    return run_record(spark, store, run_id)


def run_values(records: DataFrame) -> DataFrame:
    """Records as rows of the ``runs`` table: experiment, run_id, start_time, metric, value."""
    return records.select("experiment", "run_id", F.col("finished").alias("start_time"), F.explode("metrics").alias("metric", "value"))


# ---------------------------------------------------------------- versions and stages

def stage_log(spark: SparkSession, events_path: str) -> DataFrame:
    return _read(spark, events_path, EVENT)


def move(spark: SparkSession, events_path: str, model: str, version: int, stage: str, run_id: str | None = None,
         archive_existing: bool = True) -> None:
    """Append one event: ``version`` of ``model`` goes to ``stage``."""
    if stage not in runs.STAGES:
        raise ValueError(f"stage {stage!r} is none of {runs.STAGES}")
    event = spark.createDataFrame([(model, int(version), stage, archive_existing, run_id)], ", ".join(EVENT.split(", ")[:-1]))
    event.withColumn("at", F.current_timestamp().cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(events_path)


def register(spark: SparkSession, store: str, events_path: str, model: str, run_id: str, stage: str = "None") -> int:
    """The next version of ``model``, from a published run. Returns its number. (One writer at a time:
    two at once would take the same number.)"""
    if not run_record(spark, store, run_id).count():
        raise ValueError(f"run {run_id} is not published")
    row = stage_log(spark, events_path).where(F.col("model") == model).agg(F.max("version").alias("v")).first()
    version = int(row["v"] or 0) + 1
    move(spark, events_path, model, version, stage, run_id)
    return version


@dataclass(frozen=True)
class StoredModel:
    """A pipeline as it was published, with the input and output it was registered for."""

    run_id: str
    pipeline: PipelineModel
    inputs: T.StructType
    output: T.DataType

    def conform(self, df: DataFrame) -> DataFrame:
        """``df`` with the signature's types; columns beyond the signature stay.

        A missing column or another type is an error; a narrower number is widened."""
        have = {f.name: f.dataType for f in df.schema.fields}
        wrong, casts = [], {}
        for f in self.inputs.fields:
            got, want = have.get(f.name), f.dataType
            if got is None:
                wrong.append(f"{f.name} is missing")
            elif got != want:
                if want.simpleString() in WIDENS.get(got.simpleString(), ()):
                    casts[f.name] = F.col(f.name).cast(want)
                else:
                    wrong.append(f"{f.name} is {got.simpleString()}, not {want.simpleString()}")
        if wrong:
            raise SchemaMismatch("; ".join(wrong))
        return df.withColumns(casts) if casts else df

    def score(self, df: DataFrame, keep: list[str] | None = None, prediction: str = "prediction") -> DataFrame:
        """Batch or stream: the kept columns (all by default) and the prediction in the output type."""
        out = self.pipeline.transform(self.conform(df))
        value: Column = F.col("prediction").cast(self.output)
        return out.select(*(df.columns if keep is None else keep), value.alias(prediction))


def load_run(spark: SparkSession, store: str, run_id: str) -> StoredModel:
    row = run_record(spark, store, run_id).select("signature").first()
    if row is None:
        raise ValueError(f"run {run_id} is not published")
    signature = json.loads(row["signature"])
    output = T.StructType.fromJson({"type": "struct", "fields": [
        {"name": "prediction", "type": signature["output"], "nullable": True, "metadata": {}}]}).fields[0].dataType
    return StoredModel(run_id, PipelineModel.load(f"{folder(store, run_id)}/model"), T.StructType.fromJson(signature["inputs"]), output)


def run_in_stage(events: DataFrame, model: str, stage: str) -> str:
    """The run behind the newest version of ``model`` in ``stage``."""
    row = runs.runs_in_stage(events, stage).where(F.col("model") == model).first()
    if row is None or row["run_id"] is None:
        raise ValueError(f"{model} has no version with a run in stage {stage}")
    return row["run_id"]


def load_stage(spark: SparkSession, store: str, events_path: str, model: str, stage: str = "Production") -> StoredModel:
    """The model of a stage, ready to score."""
    return load_run(spark, store, run_in_stage(stage_log(spark, events_path), model, stage))


def gate(spark: SparkSession, store: str, events_path: str, model: str, metric: str, min_gain: float) -> DataFrame:
    """One row comparing the runs behind the model's Staging and Production versions on ``metric``:
    staging_run, production_run, staging, production, gain_percent, verdict."""
    events = stage_log(spark, events_path)
    staging, production = (run_record(spark, store, run_in_stage(events, model, s)).select("run_id", F.col("metrics")[metric].alias("value"))
                           for s in ("Staging", "Production"))
    both = staging.select(F.col("run_id").alias("staging_run"), production.select("run_id").scalar().alias("production_run"),
                          F.col("value").alias("staging"), production.select("value").scalar().alias("production"))
    return drift.promotion_gate(both, "staging", "production", min_gain)
