"""Runs and models kept as folders."""

import json
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import ROOT
from tidemark.plans import ml, monitoring, registry, scoring


def data(spark, n=400):
    return spark.range(n).select("id", (F.col("id") % 9).cast("double").alias("x"), F.when(F.col("id") % 7 != 0, F.col("id") % 4).cast("double").alias("z"),
                                 F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("c")).withColumn("y", F.col("x") * 2 + (F.col("c") == "a").cast("int"))


def train(spark, store, run_id, depth=4, **more):
    return ml.train_run(data(spark), "y", ["c"], ["x", "z"], ["id"], run_id, estimator=ml.tree_regressor("y", max_depth=depth), store=store, **more)


def test_publish_load_and_score_in_another_process(spark, tmp_path):
    store, events = str(tmp_path / "runs"), str(tmp_path / "stages")
    model, profile, record = train(spark, store, "r1", experiment="e", data_path="/data/x", data_version=3, period="jan")
    row = registry.published_runs(spark, store).first()
    assert (row.experiment, row.run_id, row.data_path, row.data_version, row.period, row.n_rows) == ("e", "r1", "/data/x", 3, "jan", 400)
    assert row.metrics["r2_test"] == record.first().r2_test > 0.9 and json.loads(row.parameters)["maxDepth"] == 4
    assert profile.where("feature = 'c' and statistic = 'top'").first().text == "a"
    assert registry.register(spark, store, events, "m", "r1", "Production") == 1
    want = {r.id: r.prediction for r in scoring.score(data(spark), model, keep=["id"]).collect()}
    data(spark).write.parquet(str(tmp_path / "in"))
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from tidemark.session import get_session
from tidemark.plans import registry
spark = get_session(master="local[2]", shuffle_partitions=2)
model = registry.load_stage(spark, {store!r}, {events!r}, "m")
model.score(spark.read.parquet({str(tmp_path / "in")!r}), keep=["id"]).write.parquet({str(tmp_path / "out")!r})
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)
    assert {r.id: r.prediction for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want


def test_wrong_inputs_are_refused_and_narrow_ones_widened(spark, tmp_path):
    store = str(tmp_path / "runs")
    train(spark, store, "r1")
    model = registry.load_run(spark, store, "r1")
    df = data(spark, 20)
    for bad, what in ((df.drop("z"), "z is missing"), (df.withColumn("x", F.col("x").cast("string")), "x is string, not double"),
                      (df.withColumn("c", F.lit(1)), "c is int, not string"), (df.withColumn("x", F.col("x").cast("decimal(9,2)")), "not double")):
        with pytest.raises(registry.SchemaMismatch, match=what):
            model.score(bad)
    narrow = df.withColumn("x", F.col("x").cast("int")).withColumn("z", F.col("z").cast("float"))
    assert [r.prediction for r in model.score(narrow).orderBy("id").collect()] == [r.prediction for r in model.score(df).orderBy("id").collect()]
    assert model.score(df, keep=["id"]).columns == ["id", "prediction"] and model.score(df.limit(0)).collect() == []


class Stop(Exception):
    pass


def test_a_run_that_dies_half_way_is_never_listed(spark, tmp_path, monkeypatch):
    store, events = str(tmp_path / "runs"), str(tmp_path / "stages")
    assert registry.published_runs(spark, store).collect() == []
    kept = registry.F.create_map

    def dies(*args):
        raise Stop
    monkeypatch.setattr(registry.F, "create_map", dies)  # model and profile are written by then
    with pytest.raises(Stop):
        train(spark, store, "r1")
    monkeypatch.setattr(registry.F, "create_map", kept)
    assert (tmp_path / "runs/r1/model").is_dir() and registry.published_runs(spark, store).collect() == []
    with pytest.raises(ValueError):
        registry.register(spark, store, events, "m", "r1")
    with pytest.raises(ValueError):
        registry.load_run(spark, store, "r1")
    train(spark, store, "r1")  # the next attempt
    assert [r.run_id for r in registry.published_runs(spark, store).collect()] == ["r1"]
    with pytest.raises(ValueError, match="published"):
        train(spark, store, "r1")
    with pytest.raises(ValueError):
        registry.folder(store, "../r1")


def test_gate_between_two_runs_and_promotion(spark, tmp_path):
    store, events = str(tmp_path / "runs"), str(tmp_path / "stages")
    with pytest.raises(ValueError):
        registry.load_stage(spark, store, events, "m")
    data(spark).write.parquet(str(tmp_path / "rows"))
    train(spark, store, "weak", depth=1)
    train(spark, store, "good", depth=5)
    rows = data(spark).withColumn("ingest_version", F.when(F.col("id") < 300, 1).otherwise(2))
    rows.write.parquet(str(tmp_path / "versioned"))
    train(spark, store, "old", depth=1, data_path=str(tmp_path / "versioned"), data_version=1)
    assert registry.register(spark, store, events, "m", "old", "Production") == 1
    assert registry.register(spark, store, events, "m", "good", "Staging") == 2
    run, then, stored = monitoring.baseline_of(spark, store, events, "m")
    assert run.run_id == "old" and then.count() == 300 and stored.where("statistic = 'mean'").count() == 3
    row = registry.gate(spark, store, events, "m", "r2_test", 0.05)
    got = row.first()
    metrics = {r.run_id: r.metrics["r2_test"] for r in registry.published_runs(spark, store).collect()}
    assert (got.staging_run, got.production_run, got.staging, got.production) == ("good", "old", metrics["good"], metrics["old"])
    assert got.verdict == "PROCEED" and monitoring.promote_if(row, events, "m", 2, run_id="good")
    assert registry.run_in_stage(registry.stage_log(spark, events), "m", "Production") == "good"
    registry.move(spark, events, "m", 1, "Staging", "weak")
    assert registry.gate(spark, store, events, "m", "r2_test", 0.05).first().verdict == "ALERT"
    with pytest.raises(ValueError):
        registry.move(spark, events, "m", 1, "Live")


class Fixed(Transformer):
    """A model whose prediction is an expression of x."""

    def __init__(self, expr):
        super().__init__()
        self.expr = expr

    def _transform(self, df):
        return df.withColumn("prediction", self.expr)


def test_smoke_test_runs_the_model(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    want = T.StructType([T.StructField("x", T.DoubleType())])
    row = scoring.validate_model(df, PipelineModel([Fixed(F.col("x") + 1)]), want, T.DoubleType()).first()
    assert row.passed and (row.min_prediction, row.max_prediction) == (1.0, 10.0)
    nan = scoring.validate_model(df, PipelineModel([Fixed(F.when(F.col("x") == 4, float("nan")).otherwise(F.col("x")))]), want, T.DoubleType()).first()
    assert not nan.passed and nan.n_nan == 1 and nan.n_null == 0
    null = scoring.validate_model(df, PipelineModel([Fixed(F.when(F.col("x") != 4, F.col("x")))]), want, T.DoubleType()).first()
    assert not null.passed and null.n_null == 1
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    @F.udf("double")
    def fails(x):
        raise ValueError("broken model")
    with pytest.raises(Exception, match="broken model"):
        scoring.validate_model(df, PipelineModel([Fixed(fails("x"))]), want, T.DoubleType()).collect()


class Counting:
    """Two outputs, and the number of this load."""

    loads = 0

    def __init__(self):
        Counting.loads += 1
        self.load = Counting.loads

    def predict(self, frame):
        import pandas as pd
        return pd.DataFrame({"label": ["hi" if v > 4 else "lo" for v in frame["x"]], "twice": frame["x"] * 2, "load": self.load}, index=frame.index)


def test_python_model_with_several_outputs(spark):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    outputs = T.StructType([T.StructField("label", T.StringType()), T.StructField("twice", T.DoubleType()), T.StructField("load", T.LongType())])
    df = data(spark, 5000).coalesce(1).withColumn("label", F.lit("old"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        out = scoring.score_with_python_struct(df, Counting, ["x"], outputs, keep=["id", "x", "label"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == 5000 and all(r.twice == 2 * r.x and r.label == ("hi" if r.x > 4 else "lo") for r in out)
    assert len({r.load for r in out}) == 1  # fifty batches, one load
