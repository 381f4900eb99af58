import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import features, impute, splits


def test_training_set_lookup_and_unmatched(spark):
    spine = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "k long, y int")
    feats = spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b")], "id long, f1 double, f2 string")
    out = features.training_set(spine, [features.FeatureLookup(feats, ["id"], ["k"])], label="y")
    assert out.columns == ["k", "f1", "f2", "y"]
    rows = {r["k"]: r for r in out.collect()}
    assert rows[3]["f1"] is None and rows[1]["f2"] == "a"
    with pytest.raises(ValueError):
        features.training_set(out, [features.FeatureLookup(feats, ["id"], ["k"])])


def test_composite_key_and_override(spark):
    spine = spark.createDataFrame([(1, "x", None), (2, "y", 5.0)], "a long, b string, f1 double")
    feats = spark.createDataFrame([(1, "x", 1.0, 7), (2, "y", 2.0, 8)], "a long, b string, f1 double, f2 int")
    out = features.lookup_missing(spine, [features.FeatureLookup(feats, ["a", "b"])])
    rows = {r["a"]: r for r in out.collect()}
    assert rows[1]["f1"] is None  # a supplied null stays null
    assert rows[2]["f1"] == 5.0 and rows[2]["f2"] == 8


def test_merge_features_upserts(spark):
    cur = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    upd = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k long, v double")
    got = sorted(tuple(r) for r in features.merge_features(cur, upd, ["k"]).collect())
    assert got == [(1, 1.0), (2, 20.0), (3, 30.0)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    got = {(r["k"], r["reason"]) for r in features.key_violations(df, ["k"]).collect()}
    assert got == {(1, "duplicate_key"), (None, "null_key")}


def test_one_hot_drops_first_and_null_is_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "g string")
    out = features.one_hot(df, ["g"], max_levels=10)
    assert out.columns == ["g_b", "g_c"]
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    with pytest.raises(ValueError):
        features.one_hot(df, ["g"], max_levels=2)


def test_clean_names_and_concat(spark):
    df = spark.createDataFrame([(1, 2)], "`Credit Score (raw)` int, `Age)` int")
    assert C.clean_names(df).columns == ["CreditScore-raw", "Age"]
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert sorted(tuple(r) for r in features.concat_periods([a, b]).collect()) == [(1, "x"), (2, "y")]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(0.0, 2.0, "R"), (4.0, 0.0, "A")], "a double, b double, f string")
    r = df.select(C.zero_flag("a").alias("z"), C.ratio("a", "b").alias("r"),
                  C.celsius_to_fahrenheit("a").alias("t"),
                  C.null_where("a", F.col("f") == "R").alias("m"),
                  C.linear_score(0.5, [(1.0, F.col("f") == "R"), (1.0, F.col("a"))]).alias("s")).collect()
    assert [tuple(x) for x in r] == [(1, 0.0, 32.0, None, 2), (0, None, 39.2, 4.0, 4)]


def test_period_filter_inclusive_dates_half_open_timestamps(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2023, 2, 28), dt.datetime(2023, 2, 28, 12))], "d date, t timestamp_ntz")
    assert C.period_filter(df, "d", "2023-02-01", "2023-02-28").count() == 1
    assert C.period_filter(df, "t", "2023-02-01", "2023-03-01").count() == 1
    assert C.period_filter(df, "t", "2023-02-01", "2023-02-28").count() == 0


def test_column_roles(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 3, "m")], "c string, i int, d double, y int, month string")
    assert C.column_roles(df, target="y", exclude=["month"]) == {"categorical": ["c"], "numeric": ["i", "d"]}


def test_stratified_split_exact_counts(spark):
    df = spark.range(0, 1003).select("id", F.when(F.col("id") < 700, "big").otherwise("small").alias("s"))
    out = splits.stratified_split(df, ["id"], "s", 0.2, 7, bits=4)
    got = {(r["s"], r["split"]): r["count"] for r in out.groupBy("s", "split").count().collect()}
    assert got[("big", "test")] == 140 and got[("small", "test")] == round(303 * 0.2)
    again = splits.stratified_split(df.repartition(5), ["id"], "s", 0.2, 7, bits=9)
    assert out.where("split = 'test'").select("id").subtract(again.where("split = 'test'").select("id")).count() == 0


def test_hash_split_is_reproducible(spark):
    df = spark.range(0, 2000)
    a = splits.hash_split(df, ["id"], 0.3, 1)
    b = splits.hash_split(df.repartition(7), ["id"], 0.3, 1)
    assert a.subtract(b).count() == 0
    n = a.where("split = 'test'").count()
    assert 500 < n < 700


def test_imputation_fit_on_train_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (10.0, "b"), (None, None)], "x double, c string")
    other = spark.createDataFrame([(None, None), (5.0, "z")], "x double, c string")
    med = impute.impute_median(train, other, ["x"]).collect()
    mode = impute.impute_mode(train, other, ["c"]).collect()
    assert [r["x"] for r in med] == [3.0, 5.0]
    assert [r["c"] for r in mode] == ["b", "z"]


def test_write_features_checks_key_and_merges(spark, tmp_path):
    cur = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    v1, v2 = str(tmp_path / "v1"), str(tmp_path / "v2")
    features.write_features(cur, v1, ["k"])
    upd = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k long, v double")
    features.write_features(upd, v2, ["k"], mode="merge", current_path=v1)
    assert sorted(tuple(r) for r in spark.read.parquet(v2).collect()) == [(1, 1.0), (2, 20.0), (3, 30.0)]
    dup = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, v double")
    with pytest.raises(ValueError):
        features.write_features(dup, str(tmp_path / "bad"), ["k"])
    with pytest.raises(ValueError):
        features.write_features(upd, v1, ["k"], mode="merge", current_path=v1)


def test_stratified_split_keeps_null_stratum(spark):
    df = spark.range(0, 1000).select("id", F.when(F.col("id") % 4 > 0, "x").alias("s"))
    got = {(r["s"], r["split"]): r["count"] for r in splits.stratified_split(df, ["id"], "s", 0.2, 7).groupBy("s", "split").count().collect()}
    assert got == {("x", "test"): 150, ("x", "train"): 600, (None, "test"): 50, (None, "train"): 200}


def test_stratified_split_leaves_the_table_in_place(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    plan = splits.stratified_split(o, ["o_orderkey"], "o_orderstatus")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_totalprice") and "Window" in plan
    assert all("o_totalprice" not in line for line in plan.split("\n") if "Window" in line or "Aggregate" in line)


def test_merge_rejects_what_it_would_lose(spark):
    cur = spark.createDataFrame([(1, "a")], "k int, v string")
    for bad in (spark.createDataFrame([(1, "b", 2)], "k int, v string, w int"), spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string"),
                spark.createDataFrame([(None, "b")], "k int, v string")):
        with pytest.raises(ValueError):
            features.merge_features(cur, bad, ["k"])


def test_levels_of_all_columns_in_one_job(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), (None, None)], "g string, n int")
    assert features.discover_levels(df, ["g", "n"], 5) == {"g": ["a", "b"], "n": ["1", "2"]}
    with pytest.raises(ValueError):
        features.one_hot(df, ["g"])


# ------------------------------------------------------------- named feature tables

import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators import features  # noqa: E402
from tidemark.sources import io  # noqa: E402


@pytest.fixture
def database(spark, tmp_path):
    name = "tm_" + tmp_path.name.replace("-", "_")
    io.ensure_database(spark, name, location=str(tmp_path / "db"))
    yield name
    spark.sql(f"drop database {name} cascade")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_named_table_keeps_key_description_and_snapshots(spark, database):
    name = f"{database}.people"
    df = spark.createDataFrame([(1, "x", 1.0, "a"), (1, "y", 2.0, "b"), (2, "x", 3.0, None)], "id long, part string, v double, c string")
    features.create_features(df, name, ["id", "part"], "It's a \\ test")
    about = features.describe_features(spark, name).first()
    assert (about.primary_key, about.description, about.snapshot, about.features) == (["id", "part"], "It's a \\ test", 1, ["v", "c"])
    up = spark.createDataFrame([("x", 2, "new", 9.0), ("z", 3, "c", 5.0)], "part string, id long, c string, v double")
    assert features.update_features(up, name) == 2
    want = [(1, "x", 1.0, "a"), (1, "y", 2.0, "b"), (2, "x", 9.0, "new"), (3, "z", 5.0, "c")]
    assert _rows(features.read_features(spark, name)) == want
    spine = spark.createDataFrame([(2, "x"), (7, "x"), (None, "x")], "who long, p string")
    got = features.training_set(spine, [features.FeatureLookup(name, lookup_key=["who", "p"], features=["v"])])
    assert _rows(got.where("who = 2")) == [(2, "x", 9.0)] and got.where("v is null").count() == 2
    with pytest.raises(ValueError, match="key of"):
        features.FeatureLookup(name, ["id"])
    assert features.update_features(df, name, "overwrite") == 3 and _rows(features.read_features(spark, name).where("c is not null")) == [(1, "x", 1.0, "a"), (1, "y", 2.0, "b")]


def test_named_table_refuses_bad_rows_and_names(spark, database):
    name = f"{database}.t"
    df = spark.createDataFrame([(1, 1.0), (1, 2.0)], "id long, v double")
    for keys in (["id"], [], ["nope"]):
        with pytest.raises(ValueError):
            features.create_features(df, name, keys)
    features.create_features(df.limit(0), name, ["id"])
    assert features.read_features(spark, name).collect() == []
    with pytest.raises(ValueError, match="exists"):
        features.create_features(df.limit(1), name, ["id"])
    with pytest.raises(ValueError):
        features.update_features(df, name)
    with pytest.raises(ValueError):
        features.update_features(df.limit(1).withColumn("w", F.lit(1)), name, "overwrite")
    with pytest.raises(ValueError):
        features.update_features(df.limit(1), name, "append")
    spark.range(3).write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError, match="no feature table"):
        features.FeatureLookup(f"{database}.plain")
    with pytest.raises(ValueError):
        features.FeatureLookup(df)


def test_a_write_that_dies_leaves_the_table_as_it_was(spark, database, monkeypatch):
    name = f"{database}.t"
    features.create_features(spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, v double"), name, ["id"])
    right = features._quoted

    def dies(text):
        if text == features.SNAPSHOT_PROPERTY:
            raise RuntimeError("lost driver")
        return right(text)
    monkeypatch.setattr(features, "_quoted", dies)
    with pytest.raises(RuntimeError):  # rows of snapshot 2 are written, the property not moved
        features.update_features(spark.createDataFrame([(9, 9.0)], "id long, v double"), name)
    monkeypatch.setattr(features, "_quoted", right)
    assert _rows(features.read_features(spark, name)) == [(1, 1.0), (2, 2.0)]
    features.update_features(spark.createDataFrame([(2, 5.0)], "id long, v double"), name)
    assert _rows(features.read_features(spark, name)) == [(1, 1.0), (2, 5.0)]


def test_versions_without_opening_files(spark, database, tmp_path):
    name = f"{database}.v"
    io.save_table(spark.range(20).withColumn("ingest_version", (F.col("id") % 12 + 1).cast("int")), name, partition_by=["ingest_version"])
    df = io.table_versions(spark, name)
    assert sorted(r.version for r in df.collect()) == list(range(1, 13))
    assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()
    path = str(tmp_path / "periods")
    for v, p in ((3, "jan"), (11, "feb"), (3, "feb")):
        io.append_period(spark.range(2), path, "period", p, v)
    found = io.path_versions(spark, path)
    assert sorted(r.version for r in found.collect()) == [3, 11]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "ReadSchema: struct<>" in plan  # names only, no content


def test_reading_as_of_moves_no_period_into_one_task(spark):
    from tidemark.sources import io
    rows = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, None, 1), (5, "b", 3)], "id long, period string, ingest_version int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = io.read_as_of(rows, 2, "period")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {r["id"] for r in found.collect()} == {2, 3, 4}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quantile_counts_sort_no_table(spark, monkeypatch):
    from tidemark.operators import stats
    seen, write = [], stats.materialize
    monkeypatch.setattr(stats, "materialize", lambda df: seen.append(df) or write(df))
    big = 2 ** 53
    df = spark.range(2000).select((F.col("id") + big).alias("k"), (F.col("id") * 0.5).alias("x"))
    got = {r["feature"]: r for r in stats.quantiles(df, ["k", "x"], {"50%": 0.5}, texts=True).collect()}
    moments, counts = (d._jdf.queryExecution().executedPlan().toString() for d in seen[:2])  # those that read the table
    assert "SortAggregate" not in moments + counts and "HashAggregate" in counts
    assert got["k"]["50%__text"] == f"{big + 999}.5" and got["k"]["max__text"] == str(big + 1999) and got["x"]["50%"] == 499.75
