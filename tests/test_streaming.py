import os
import tempfile

from pyspark.sql import functions as F

from tidemark.streaming import streams


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_small):
    src = spark.read.parquet(f"{sf_small}/events.parquet")
    base = tempfile.mkdtemp(prefix="tm-stream-")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    s = streams.read_stream(spark, f"{sf_small}/events*.parquet", src.schema, max_files_per_trigger=1, drop=["props"])
    s = s.withColumn("value_f", F.col("value") * 9 / 5 + 32)
    streams.run_to_end(streams.write_stream(s, out, ckpt, name="tm_events"), timeout=600)
    first = spark.read.parquet(out)
    batch = src.drop("props").withColumn("value_f", F.col("value") * 9 / 5 + 32)
    assert first.count() == batch.count()
    assert first.subtract(batch).count() == 0
    # Restart from the same checkpoint: the file was already processed.
    streams.run_to_end(streams.write_stream(s, out, ckpt, name="tm_events"), timeout=600)
    assert spark.read.parquet(out).count() == batch.count()


def test_preview_and_stop_by_name(spark, sf_small):
    src = spark.read.parquet(f"{sf_small}/events.parquet")
    s = streams.read_stream(spark, f"{sf_small}/events*.parquet", src.schema)
    q = streams.preview_stream(s, "tm_preview")
    other = streams.preview_stream(s, "tm_other")
    q.processAllAvailable()
    assert spark.sql("select count(*) from tm_preview").collect()[0][0] == src.count()
    assert streams.await_stream(spark, "tm_preview", timeout=1, poll=0.1) is not None
    assert streams.stop_stream(spark, "tm_preview")
    assert streams.find_stream(spark, "tm_other") is not None
    other.stop()
    assert not streams.stop_stream(spark, "tm_missing")


def test_progress_of_every_batch_and_of_a_restart(spark, tmp_path):
    src, out, ckpt, log = (str(tmp_path / n) for n in ("src", "out", "ckpt", "log"))
    for k in range(5):
        spark.range(k + 1).coalesce(1).write.mode("append").parquet(src)
    progress = streams.Progress(spark, log)
    progress.KEEP = 2
    schema = spark.read.parquet(src).schema

    def run(name):
        s = streams.read_stream(spark, src, schema, max_files_per_trigger=1)
        return streams.run_to_end(streams.write_stream(s, out, ckpt, name=name), timeout=300, progress=progress)
    first = run("p1")
    rows = [tuple(r) for r in progress.table().select("name", "batch", "n_rows").orderBy("batch").collect()]
    assert rows == [("p1", k, k + 1) for k in range(5)]  # as many batches as files
    spark.range(10).coalesce(1).write.mode("append").parquet(src)
    second = run("p2")
    assert first.id == second.id and first.runId != second.runId
    assert [tuple(r) for r in progress.table().where("name = 'p2'").select("batch", "n_rows").collect()] == [(5, 10)]
    assert spark.read.parquet(out).count() == 15 + 10 and progress.rows == []


def test_await_list_and_stop(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(4).coalesce(1).write.mode("append").parquet(src)
    s = streams.read_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
    q = streams.preview_stream(s, "tm_listed")
    progress = streams.Progress(spark)
    assert streams.await_batches(q, progress, 1, timeout=60)
    assert not streams.await_batches(q, progress, 2, timeout=0.5)
    spark.range(3).coalesce(1).write.mode("append").parquet(src)
    assert streams.await_batches(q, progress, 2, timeout=60)
    row = streams.list_streams(spark).where("name = 'tm_listed'").first()
    assert row.run_id == str(q.runId) and row.state
    assert [r.n_rows for r in progress.table().orderBy("batch").collect()] == [4, 3]
    assert streams.stop_stream(spark, "tm_listed") and not q.isActive
    assert streams.list_streams(spark).where("name = 'tm_listed'").count() == 0
    assert not streams.await_batches(q, progress, 3, timeout=60)  # ended: no need to wait


def test_a_forest_on_bins_scores_a_stream_as_a_batch(spark, monkeypatch, tmp_path):
    from pyspark.sql import types as T

    from tidemark.plans import ml, scoring
    monkeypatch.setattr(ml, "GROUPS_FROM_ROWS", 1000)
    df = spark.range(6000).select("id", (F.col("id") % 97).cast("double").alias("x"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), F.col("id") % 2)).alias("c"))
    df = df.withColumn("y", F.col("x") * 2 + F.when(F.col("c") == "c1", 50).otherwise(0))
    model = ml.fit_regressor(df, "y", ["c"], ["x"], ml.rf_regressor("y", 8, 4))
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    df.repartition(3).write.parquet(src)
    s = scoring.score(streams.read_stream(spark, src, df.schema, max_files_per_trigger=2), model, keep=["id"], partitions=4)
    streams.run_to_end(streams.write_stream(s, out, ckpt), timeout=300)
    both = spark.read.parquet(out).join(model.transform(df).select("id", F.col("prediction").alias("p")), "id")
    assert both.where("p = prediction").count() == 6000 and both.select("p").distinct().count() > 10
    wanted = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("c", T.StringType())])
    row = scoring.validate_model(df.select("x", "c"), model, wanted, T.DoubleType(), partitions=4).first()
    ends = model.transform(df).agg(F.min("prediction"), F.max("prediction")).first()
    assert row["passed"] and row["n_rows"] == 6000 and (row["min_prediction"], row["max_prediction"]) == tuple(ends)
    whole = scoring.validate_model(df.select("x", "c"), model, wanted, T.IntegerType()).first()
    assert not whole["passed"] and whole["n_not_castable"] > 0
    plan = scoring.score(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "follow" in plan  # once per cell, not once per row
