import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import payloads
from tidemark.plans import ml, scoring


def _data(spark, n=400):
    df = spark.range(0, n).select(
        "id", (F.col("id") % 7).cast("double").alias("x"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 3).cast("double")).alias("z"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.when(F.col("id") % 2 == 0, "even").otherwise("odd")).alias("c"))
    return df.withColumn("y", F.when(F.col("x") > 3, "hi").otherwise("lo"))


def test_pipeline_imputes_and_scores(spark):
    df = _data(spark)
    data, indexer = ml.index_label(df, "y")
    model = ml.build_pipeline(["c"], ["x", "z"], ml.tree_classifier("label_idx")).fit(data)
    scored = scoring.score_proba(data, model, indexer.labels, keep=["id", "y"])
    assert set(scored.columns) == {"id", "y", "prob_hi", "prob_lo", "prediction"}
    acc = scored.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).collect()[0][0]
    assert acc > 0.95
    # unknown level at scoring time gives zeros instead of failing
    new = spark.createDataFrame([(1, 5.0, 1.0, "never-seen")], "id long, x double, z double, c string")
    assert scoring.score(new, model).count() == 1


def test_mode_imputer_and_importances(spark):
    df = _data(spark)
    m = ml.ModeImputer(inputCols=["c"]).fit(df)
    assert m.transform(df).where(F.col("c").isNull()).count() == 0
    data, _ = ml.index_label(df, "y")
    model = ml.build_pipeline(["c"], ["x", "z"], ml.rf_classifier("label_idx", num_trees=5)).fit(data)
    imp = {r["feature"]: r["importance"] for r in ml.feature_importances(model, data).collect()}
    assert max(imp, key=imp.get) == "x__imp"


def test_validate_model_and_signature(spark):
    df = _data(spark).withColumn("target", F.col("x") * 2)
    model = ml.build_pipeline([], ["x"], ml.rf_regressor("target", num_trees=3, max_depth=3)).fit(df)
    ok = scoring.validate_model(df.select("x"), model, T.StructType([T.StructField("x", T.DoubleType())]),
                                dtype=T.DoubleType()).collect()[0]
    assert ok["passed"]
    sig = ml.signature(df, ["x", "c"], T.IntegerType())
    assert [f["name"] for f in sig["inputs"]["fields"]] == ["x", "c"]
    a = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    b = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.IntegerType())])
    c = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType())])
    assert ml.schema_matches(a, b) and not ml.schema_matches(a, c)


def test_train_run_records(spark):
    df = _data(spark, 300).withColumn("target", F.col("x") * 3 + F.coalesce(F.col("z"), F.lit(0.0)))
    model, profile, record = ml.train_run(df, "target", ["c"], ["x", "z"], ["id"], "r1", num_trees=10, max_depth=4)
    r = record.collect()[0]
    assert r["n_rows"] == 300 and r["n_train"] + r["n_test"] == 300 and r["r2_test"] > 0.8
    assert profile.where("feature = 'c' and statistic = 'top'").count() == 1


def test_payloads_parse_back(spark):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, 'q"x'), (3, 1.0, "b")], "k long, v double, s string")
    rec = {r["batch"]: json.loads(r["payload"]) for r in payloads.records_payload(df, "k", ["k", "v", "s"], 2).collect()}
    assert rec[0]["dataframe_records"][0] == {"k": 1, "v": 2.5, "s": "a"}
    spl = {r["batch"]: json.loads(r["payload"]) for r in payloads.split_payload(df, "k", ["k", "v", "s"], 2).collect()}
    assert spl[0]["dataframe_split"] == {"columns": ["k", "v", "s"], "index": [1, 2], "data": [[1, 2.5, "a"], [2, None, 'q"x']]}


def test_search_respects_budget_and_logs_runs(spark):
    data, _ = ml.index_label(_data(spark, 200), "y")
    best, trials = ml.search_classifier(data, "label_idx", ["c"], ["x", "z"], ["id"], max_trials=6, folds=2,
                                        parallelism=2, time_limit=0)
    assert trials.count() == 2  # one round only: the budget was spent
    assert best is not None
    rec = spark.createDataFrame([("r1", 1.0, 2.0, 1.4, 0.9)], "run_id string, mae double, mse double, rmse double, r2_test double")
    rows = {r["metric"]: r["value"] for r in ml.run_metrics(rec, "exp").collect()}
    assert rows == {"mae": 1.0, "mse": 2.0, "rmse": 1.4, "r2_test": 0.9}


class _Doubler:
    """A plain Python model with a pandas predict (stand-in for any library)."""

    def predict(self, frame):
        return frame["x"] * 2 + frame["z"].fillna(0)


def test_score_with_python_model(spark):
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests
    df = _data(spark, 50)
    out = scoring.score_with_python(df, _Doubler, ["x", "z"]).collect()
    for r in out:
        assert r["prediction"] == r["x"] * 2 + (r["z"] or 0)


def test_unknown_level_is_all_zeros(spark):
    train = spark.createDataFrame([(v,) for v in "aabbc"], "g string")
    model = ml.Pipeline(stages=ml.preprocessing_stages(["g"], [])).fit(train)
    out = {r["g"]: r["features"].toArray().tolist() for r in model.transform(spark.createDataFrame([("a",), ("c",), ("new",)], "g string")).collect()}
    assert out == {"a": [1, 0, 0], "c": [0, 0, 1], "new": [0, 0, 0]}


def test_pipeline_median_is_exact(spark):
    train = spark.createDataFrame([(float(v),) for v in range(1, 1002)] + [(None,)], "x double")
    model = ml.Pipeline(stages=ml.preprocessing_stages([], ["x"])).fit(train)
    row = model.transform(spark.createDataFrame([(None,), (float("nan"),), (3.0,)], "x double")).collect()
    assert [r["features"][0] for r in row] == [501.0, 501.0, 3.0]


def test_model_does_not_depend_on_partitions(spark):
    df = _data(spark, 300)
    cols = [c for c in df.columns if c != "id"]
    seen = {tuple(map(tuple, ml.stable_input(df.repartition(n), ["id"], 4).select("id", *cols, F.spark_partition_id()).sort("id").collect())) for n in (1, 3, 7)}
    assert len(seen) == 1


def test_validate_model_reports_a_bad_schema(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, z double")
    model = ml.build_pipeline([], ["x"], ml.rf_regressor("z", 2, 2)).fit(df)
    want = T.StructType([T.StructField("x", T.DoubleType())])
    for bad in (df, df.select("z")):
        row = scoring.validate_model(bad, model, want, T.DoubleType()).first()
        assert row["schema_ok"] is False and row["passed"] is False and row["n_rows"] is None
    assert scoring.validate_model(df.select("x"), model, want, T.DoubleType()).first()["passed"] is True


def test_search_over_families_halves_and_grows(spark):
    data, _ = ml.index_label(_data(spark, 600), "y")
    best, trials = ml.search_models(data, "label_idx", ["c"], ["x", "z"], ["id"])
    rows = trials.collect()
    assert [sum(r["rung"] == k for r in rows) for k in range(3)] == [12, 6, 3] and {r["family"] for r in rows} == {"forest", "logistic", "boosted"}
    assert len({r["n_rows"] for r in rows}) == 3 and max(r["f1"] for r in rows) > 0.95
    for k in (0, 1):  # the kept ones are the better half and go on
        here = [r for r in rows if r["rung"] == k]
        worst = min(r["f1"] for r in here if r["kept"])
        assert all(r["f1"] <= worst for r in here if not r["kept"])
        assert {(r["family"], r["setting"]) for r in here if r["kept"]} == {(r["family"], r["setting"]) for r in rows if r["rung"] == k + 1}
    scored = scoring.score(data, best, keep=["label_idx"])
    assert scored.where("prediction = label_idx").count() > 570
    _, one = ml.search_models(data, "label_idx", ["c"], ["x", "z"], ["id"], time_limit=0)
    assert {r["rung"] for r in one.collect()} == {0}
    three = data.withColumn("k", (F.col("x") % 3).cast("double"))
    best, _ = ml.search_models(three, "k", [], ["x"], ["id"], families=ml.model_families("k", 3)[-1:], rungs=(1.0,))
    assert scoring.score(three, best, keep=["k"]).where("prediction = k").count() > 550


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_split_by_few_strata_moves_no_stratum_into_one_task(spark):
    from tidemark.operators import splits
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table too large to be guessed small
    try:
        split = splits.stratified_split(_data(spark, 1000), ["id"], "y")
        plan = _plan(split)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        counts = {(r["y"], r["split"]): r["count"] for r in split.groupBy("y", "split").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sizes = {r["y"]: r["count"] for r in _data(spark, 1000).groupBy("y").count().collect()}
    assert {y: counts[y, "test"] for y in sizes} == {y: round(n * 0.2) for y, n in sizes.items()}


def test_a_large_forest_grows_in_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ml, "TREES_PER_FIT", 4)
    data, indexer = ml.index_label(_data(spark, 600).withColumn("target", F.col("x") * 2), "y")
    model = ml.build_pipeline(["c"], ["x", "z"], ml.rf_regressor("target", num_trees=10, max_depth=4)).fit(data)
    forests = [s for s in model.stages if hasattr(s, "featureImportances")]
    assert [s.getNumTrees for s in forests] == [4, 3, 3] and len({s.trees[0].toDebugString for s in forests}) == 3
    path = f"{tmp_path}/m"
    model.write().save(path)
    again = ml.PipelineModel.load(path)
    # the mean of the ten trees, tree by tree
    ready = data
    for s in model.stages[:-len(forests) - 1]:
        ready = s.transform(ready)
    rows = ready.select("id", ml.FEATURES).limit(20).collect()
    scored = {r["id"]: r["prediction"] for r in again.transform(data).select("id", "prediction").collect()}
    for r in rows:
        mean = sum(t.predict(r[ml.FEATURES]) for s in forests for t in s.trees) / 10
        assert abs(scored[r["id"]] - mean) < 1e-9
    assert again.transform(data).columns == [*ready.columns, "prediction"]
    assert abs(sum(r["importance"] for r in ml.feature_importances(model, data).collect()) - 1) < 1e-9

    vote = ml.build_pipeline(["c"], ["x", "z"], ml.rf_classifier("label_idx", num_trees=10, max_depth=4)).fit(data)
    out = scoring.score_proba(data, vote, indexer.labels, keep=["id", "y"]).collect()
    assert all(abs(r["prob_hi"] + r["prob_lo"] - 1) < 1e-9 for r in out)
    assert all(r["prediction"] == max(("hi", "lo"), key=lambda k: r[f"prob_{k}"]) for r in out)
    assert sum(r["y"] == r["prediction"] for r in out) > 590


def test_only_deep_forests_keep_node_ids_of_rows():
    for est in (ml.rf_regressor("y", 500, 5), ml.rf_classifier("y", 20, 6), ml.tree_regressor("y"), ml.tree_classifier("y")):
        assert not any(s.getCacheNodeIds() for s in ml.forest_stages(est) if not isinstance(s, ml.ForestVote))
    *parts, vote = ml.forest_stages(ml.rf_classifier("y", 120, 10))
    assert all(s.getCacheNodeIds() and s.getCheckpointInterval() == -1 and s.getNumTrees() <= ml.TREES_PER_FIT for s in parts)
    assert vote.getOrDefault("trees") == [40, 40, 40] and len({s.getSeed() for s in parts}) == 3


def _labelled(spark, n):
    """Real-valued numbers that do not repeat, a category with nulls and a label that follows from both."""
    r = F.rand(3)
    df = spark.range(n).select("id", (r * 1000).alias("x"), F.when(F.col("id") % 9 > 0, F.rand(4)).alias("z"),
                               F.when(F.col("id") % 4 > 0, F.concat(F.lit("c"), (F.col("id") % 3).cast("string"))).alias("c"))
    return df.withColumn("y", F.when(F.col("x") < 300, "a").when((F.col("c") == "c1") & (F.col("x") < 800), "b").otherwise("d")).localCheckpoint()


def test_trees_are_fitted_on_row_groups_that_count_every_row(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ml, "GROUPS_FROM_ROWS", 20_000)
    df = _labelled(spark, 20_000)
    data, indexer = ml.index_label(df, "y")
    seen, fit_groups = [], ml.fit_groups
    monkeypatch.setattr(ml, "fit_groups", lambda e, g: seen.append(g) or fit_groups(e, g))
    model = ml.fit_classifier(data, "label_idx", ["c"], ["x", "z"], ml.rf_classifier("label_idx", num_trees=12, max_depth=6))
    groups = seen[0].agg(F.count("*").alias("n"), F.sum(ml.WEIGHT).alias("w")).first()
    assert groups["w"] == 20_000 and groups["n"] <= 20_000 // ml.ROWS_PER_GROUP
    forest = model.stages[-1]
    assert forest.getNumTrees == 12 and len({t.toDebugString for t in forest.trees}) > 1
    scored = scoring.score_proba(data, model, indexer.labels, keep=["y"])
    assert scored.where("prediction = y").count() > 19_000
    path = f"{tmp_path}/m"
    model.write().save(path)
    again = ml.PipelineModel.load(path).transform(data).select("id", F.col("probability").alias("p"))
    assert model.transform(data).join(again, "id").where("p = probability").count() == 20_000
    slots = [r["feature"] for r in ml.feature_importances(model, data).collect()]
    assert slots == ["x__imp", "z__imp", "c__ohe_c0", "c__ohe_c1", "c__ohe_c2"]


def test_a_group_is_drawn_as_often_as_its_rows(spark):
    groups = spark.range(400).select("id", F.lit(50.0).alias(ml.WEIGHT))
    draws = [ml.bootstrap_weights(groups.repartition(n), ["id"], 2, 42).sort("id").collect() for n in (1, 3)]
    assert draws[0] == draws[1]  # a group's draws do not depend on where it lies
    drawn = [v for r in draws[0] for v in r["_tm_drawn"]]
    mean = sum(drawn) / len(drawn)
    assert len(drawn) == 400 * ml.TREES_PER_DRAW and abs(mean - 50) < 1
    assert 40 < sum((v - mean) ** 2 for v in drawn) / len(drawn) < 60  # Poisson(50)


def test_boosted_trees_on_groups_are_those_on_rows(spark):
    df = _labelled(spark, 8000).withColumn("k", (F.col("y") == "b").cast("double"))
    steps = ml.Pipeline(stages=ml.preprocessing_stages(["c"], ["x", "z"], ml.MAX_BINS)).fit(df)
    ready, groups = steps.transform(df), ml.row_groups(df, steps, "k", ["c"], ["x", "z"], least=0)
    boosted = ml.GBTClassifier(labelCol="k", featuresCol=ml.BINNED, maxIter=3, maxDepth=3, seed=1)
    on_rows, on_groups = boosted.fit(ready), ml.fit_groups(boosted, groups)
    same = on_rows.transform(ready).select("id", F.col("prediction").alias("p")).join(on_groups.transform(ready).select("id", "prediction"), "id")
    assert same.where("p = prediction").count() == 8000


def test_bins_hold_their_upper_end_and_keep_few_values_apart(spark):
    df = spark.createDataFrame([(float(i % 2 if i < 20 else 0), float(i)) for i in range(2000)], "rare double, x double")
    bins = ml.FeatureBins(inputCols=["rare", "x"], outputCols=["r", "b"], maxBins=4).fit(df)
    out = bins.transform(df)
    assert {(v["rare"], v["r"]) for v in out.select("rare", "r").distinct().collect()} == {(0.0, 0.0), (1.0, 1.0)}
    ends = [v["e"] for v in out.groupBy("b").agg(F.max("x").alias("e")).sort("b").collect()]
    assert len(ends) == 4 and all(abs(e - t) <= 2 for e, t in zip(ends, (499, 999, 1499, 1999)))


def test_settings_that_differ_in_trees_share_them(spark, monkeypatch):
    monkeypatch.setattr(ml, "GROUPS_FROM_ROWS", 20_000)
    data, _ = ml.index_label(_labelled(spark, 20_000), "y")
    grown, grow = [], ml.grow_trees
    monkeypatch.setattr(ml, "grow_trees", lambda e, g, first, n: grown.append(max(n, 0)) or grow(e, g, first, n))
    steps = ml.Pipeline(stages=ml.preprocessing_stages(["c"], ["x", "z"], ml.MAX_BINS)).fit(data)
    shared = ml.SharedTrees(ml.row_groups(data, steps, "label_idx", ["c"], ["x", "z"]))
    small, large = (shared.forest(ml.rf_classifier("label_idx", n, 3)) for n in (4, 6))
    assert sum(grown) == 6
    assert [t.toDebugString.split("\n", 1)[1] for t in small.trees] == [t.toDebugString.split("\n", 1)[1] for t in large.trees[:4]]
    again = ml.grow_trees(ml.rf_classifier("label_idx", 6, 3), shared.groups, 0, 6)
    assert [f.trees[0].toDebugString.split("\n", 1)[1] for f in again] == [t.toDebugString.split("\n", 1)[1] for t in large.trees]


def _priced(spark, n):
    """Numbers that do not repeat, with nulls, a category, and a target that follows from them up to noise; one cell of many rows."""
    df = _labelled(spark, n)
    return df.select("id", F.when(F.col("id") % 3 > 0, F.col("x")).otherwise(7.0).alias("x"), F.when(F.col("id") % 3 > 0, F.col("z")).otherwise(0.5).alias("z"),
                     F.when(F.col("id") % 3 > 0, F.col("c")).otherwise("c0").alias("c")).withColumn("y", F.col("x") * 3 + F.when(F.col("c") == "c1", 500).otherwise(0) + F.rand(9)).localCheckpoint()


def _lists(spark, n, monkeypatch, most=1000):
    monkeypatch.setattr(ml, "TARGETS_PER_ROW", most)
    df = _priced(spark, n)
    steps = ml.Pipeline(stages=ml.preprocessing_stages(["c"], ["x", "z"], ml.MAX_BINS)).fit(df)
    return df, steps, ml.target_lists(df, steps, "y", ["c"], ["x", "z"], least=0)


def test_lists_hold_every_target_and_a_large_cell_is_dealt_out(spark, monkeypatch):
    df, _, lists = _lists(spark, 12_000, monkeypatch)
    kept = lists.select(F.explode(ml.TARGETS).alias("y")).agg(F.count("y").alias("n"), F.sum("y").alias("s")).first()
    assert kept["n"] == 12_000 and abs(kept["s"] - df.agg(F.sum("y")).first()[0]) < 1e-3
    cells = lists.groupBy(*lists.columns[:3]).agg(F.count("*").alias("rows"), F.sum(F.size(ml.TARGETS)).alias("n")).collect()
    assert max(r["n"] for r in cells) >= 4000 and all(r["rows"] == 1 for r in cells if r["n"] <= 1000)
    assert max(r["rows"] for r in cells) >= 4 and lists.agg(F.max(F.size(ml.TARGETS))).first()[0] < 1500
    steps = ml.Pipeline(stages=ml.preprocessing_stages(["c"], ["x", "z"], ml.MAX_BINS)).fit(df)
    assert ml.target_lists(df.withColumn("y", F.when(F.col("id") > 0, F.col("y"))), steps, "y", ["c"], ["x", "z"], least=0) is None  # a missing target


def test_a_tree_on_lists_knows_number_sum_and_squares_of_its_draws(spark, monkeypatch):
    import numpy as np
    _, _, lists = _lists(spark, 6000, monkeypatch)
    keys = [c for c in lists.columns if c not in (ml.BINNED, ml.TARGETS)]
    n, seen = ml.TREES_PER_DRAW, [[], [], []]
    for r in ml.draw_targets(lists, [*keys], 3, 42).select(F.xxhash64(*keys).alias("k"), ml.TARGETS, "_tm_drawn").collect():
        y, got = np.array(r[ml.TARGETS]), np.array(r["_tm_drawn"]).reshape(3, n)
        times = np.random.default_rng([42, 3, r["k"] % 2 ** 64]).poisson(1.0, (n, len(y)))
        assert np.allclose(got[0], times.sum(axis=1))
        drawn = got[0] > 0
        assert np.allclose((got[0] * got[1])[drawn], (times @ y)[drawn]) and np.allclose((got[0] * (got[1] ** 2 + got[2] ** 2))[drawn], (times @ y ** 2)[drawn])
        seen[0].append(times.sum()), seen[1].append(len(y) * n)
    assert abs(sum(seen[0]) / sum(seen[1]) - 1) < 0.02  # as many draws as rows


def test_a_regression_forest_on_lists_is_as_good_as_on_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ml, "GROUPS_FROM_ROWS", 10_000)
    df = _priced(spark, 20_000)
    rows = ml.build_pipeline(["c"], ["x", "z"], ml.rf_regressor("y", 12, 5)).fit(df)
    fits, fit_groups = [], ml.fit_groups
    monkeypatch.setattr(ml, "fit_groups", lambda e, g: fits.append(g) or fit_groups(e, g))
    model, _, record = ml.train_run(df, "y", ["c"], ["x", "z"], ["id"], "r", num_trees=12, max_depth=5, store=f"{tmp_path}/store")
    forest = model.stages[-1]
    assert len(fits) == 1 and forest.getNumTrees == 12 and len({t.toDebugString for t in forest.trees}) == 12
    root = [t._java_obj.rootNode().prediction() for t in forest.trees]
    assert len(set(root)) == 12 and abs(sum(root) / 12 - df.agg(F.avg("y")).first()[0]) < 20  # each on draws of its own
    r = record.first()
    own = ml.metrics.regression_metrics(rows.transform(df), "y", "prediction").first()
    assert r["n_rows"] == 20_000 and abs(r["r2_test"] - own["r2"]) < 0.03 and r["r2_test"] > 0.9
    from tidemark.plans import registry
    again = registry.load_run(spark, f"{tmp_path}/store", "r")
    both = model.transform(df).select("id", F.col("prediction").alias("p")).join(again.score(df, keep=["id"]), "id")
    assert both.where("p = prediction").count() == 20_000


def test_a_forest_followed_once_per_cell_gives_the_same_predictions(spark, monkeypatch):
    monkeypatch.setattr(ml, "CELLS_KEPT", 50)  # and begins anew
    df, steps, lists = _lists(spark, 12_000, monkeypatch)
    model = ml.PipelineModel(stages=[*steps.stages, ml.fit_groups(ml.rf_regressor("y", 12, 5), lists)])
    new = df.unionByName(spark.createDataFrame([(-1, None, float("nan"), "never"), (-2, 1e9, -5.0, None)], "id long, x double, z double, c string").withColumn("y", F.lit(0.0)))
    fast = ml.predict(model, new.repartition(3))
    assert "follow" in _plan(fast) and fast.columns == model.transform(new).columns
    both = fast.select("id", "prediction").join(model.transform(new).select("id", F.col("prediction").alias("p")), "id")
    assert both.where("p = prediction").count() == 12_002 and both.select("p").distinct().count() > 100
    assert scoring.score(new, model, keep=["id"]).where("prediction is null").count() == 0
    plain = ml.build_pipeline(["c"], ["x", "z"], ml.rf_regressor("y", 3, 3)).fit(df)  # splits at categories
    assert "follow" not in _plan(ml.predict(plain, df))


def test_a_search_on_groups_writes_no_vectors_of_rows_and_keeps_nothing(spark, monkeypatch):
    monkeypatch.setattr(ml, "GROUPS_FROM_ROWS", 1000)
    data, _ = ml.index_label(_data(spark, 6000), "y")
    families = [f for f in ml.model_families("label_idx") if f[:2] in (("logistic", "reg=0.0,mix=0.0"), ("boosted", "rounds=5,depth=2"))]
    written, kind = [], type(data)
    old = kind.checkpoint
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, **b: written.append(self.columns) or old(self, *a, **b))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    best, trials = ml.search_models(data, "label_idx", ["c"], ["x", "z"], ["id"], families=families, rungs=(0.5, 1.0))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    assert not any(ml.FEATURES in c for c in written)
    rows = trials.collect()
    assert [r["rung"] for r in rows] == [0, 0, 1] and max(r["f1"] for r in rows) > 0.9
    assert scoring.score(data, best, keep=["label_idx"]).where("prediction = label_idx").count() > 5400


def test_bins_of_few_values_are_found_in_one_scan(spark):
    df = spark.range(3000).select((F.col("id") % 5).cast("double").alias("a"), F.when(F.col("id") % 2 > 0, (F.col("id") % 7).cast("double")).alias("b"), F.col("id").cast("double").alias("c"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("bins", "")
    try:
        bins = ml.FeatureBins(inputCols=["a", "b", "c"], outputCols=["x", "y", "z"], maxBins=ml.MAX_BINS).fit(df.coalesce(1))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("bins")) <= 4  # two aggregates, of a stage or two each
    assert [len(s) - 1 for s in bins.getSplitsArray()[:2]] == [5, 7] and len(bins.getSplitsArray()[2]) == ml.MAX_BINS + 1


def test_sketches_of_many_partitions_are_joined_from_few(spark):
    df = spark.range(40_000).select(F.col("id").cast("double").alias("x")).repartition(300)
    assert ml.in_few_parts(df.checkpoint()).rdd.getNumPartitions() == ml.SKETCH_PARTITIONS and ml.in_few_parts(df.coalesce(9).checkpoint()).rdd.getNumPartitions() == 9
    few = ml.in_few_parts(df)
    assert few.count() == 40_000 and few.agg(F.sum("x")).first() == df.agg(F.sum("x")).first()
    model = ml.Pipeline(stages=ml.preprocessing_stages([], ["x"], ml.MAX_BINS)).fit(df)
    assert json.loads(model.stages[0].getOrDefault("fills")) == {"x": 19999.5}
    sizes = [r["count"] for r in model.transform(df).groupBy("x__bin").count().collect()]
    assert len(sizes) == ml.MAX_BINS and max(sizes) - min(sizes) < 40
