"""Three monthly periods: a clean month passes, the faulty month (Fahrenheit
temperatures, traffic lost for two promotion types) is flagged."""

from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import drift, stats

NUM = ["Temperature", "Website_Traffic"]
CAT = ["Weather_Condition", "Promotion_Type", "Device_Type"]


def month(spark, start, days, shift=0):
    d = spark.range(0, days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("Date"),
        ((F.col("id") + shift) % days).alias("i"))
    weather = F.element_at(F.array(*[F.lit(x) for x in ("sunny", "cloudy", "rainy")]), (F.col("i") % 3 + 1).cast("int"))
    promo = F.element_at(F.array(*[F.lit(x) for x in ("discount", "free_gift", "bundle_deal")]), (F.col("i") % 3 + 1).cast("int"))
    device = F.element_at(F.array(*[F.lit(x) for x in ("mobile", "desktop", "tablet")]), ((F.col("i") / 3).cast("int") % 3 + 1))
    return d.select("Date", (F.lit(15.0) + F.col("i") % 10).alias("Temperature"), weather.alias("Weather_Condition"),
                    promo.alias("Promotion_Type"), (F.lit(500) + (F.col("i") * 37) % 400).cast("int").alias("Website_Traffic"),
                    device.alias("Device_Type"))


def test_clean_month_passes_faulty_month_flags(spark):
    ref = month(spark, "2023-01-01", 28)
    clean = month(spark, "2023-02-01", 28, shift=5)
    faulty = clean.select(
        "Date", C.celsius_to_fahrenheit("Temperature").alias("Temperature"), "Weather_Condition", "Promotion_Type",
        C.null_where("Website_Traffic", F.col("Promotion_Type").isin("bundle_deal", "free_gift")).alias("Website_Traffic"),
        "Device_Type")
    ok = drift.drift_report(ref, clean, NUM, CAT)
    assert ok.where("drifted").count() == 0
    assert stats.null_proportions(clean, 0.5).count() == 0

    bad = drift.drift_report(ref, faulty, NUM, CAT)
    flagged = {(r["test"], r["feature"]) for r in bad.where("drifted").collect()}
    assert ("ks_two-sided", "Temperature") in flagged
    nulls = {r["feature"] for r in stats.null_proportions(faulty, 0.5).collect()}
    assert nulls == {"Website_Traffic"}
    moved = {r["feature"] for r in drift.summary_drift(stats.summary_stats(faulty, NUM), stats.summary_stats(ref, NUM),
                                                         NUM, 0.1).collect()}
    assert "Temperature" in moved


def test_date_period_filter_is_inclusive(spark):
    m = month(spark, "2023-02-01", 28)
    assert C.period_filter(m, "Date", "2023-02-01", "2023-02-28").count() == 28


def test_period_report_and_promotion(spark, tmp_path):
    from tidemark.operators import runs
    from tidemark.plans import monitoring
    ref = month(spark, "2023-01-01", 28)
    faulty = month(spark, "2023-02-01", 28, shift=5).withColumn(
        "Website_Traffic", C.null_where("Website_Traffic", F.col("Promotion_Type").isin("bundle_deal", "free_gift")))
    rep = monitoring.period_report(ref, faulty, NUM, CAT)
    flagged = {(r["check"], r["feature"]) for r in rep.where("flagged").collect()}
    assert ("nulls", "Website_Traffic") in flagged
    assert set(rep.columns) == set(monitoring.REPORT_COLUMNS)
    path = str(tmp_path / "events")
    ok = spark.createDataFrame([(0.9, 0.8)], "staging double, prod double")
    bad = spark.createDataFrame([(0.7, 0.8)], "staging double, prod double")
    assert monitoring.promote_if(drift.promotion_gate(ok, "staging", "prod", 0.05), path, "sales", 2)
    assert not monitoring.promote_if(drift.promotion_gate(bad, "staging", "prod", 0.05), path, "sales", 3)
    cur = runs.model_in_stage(spark.read.parquet(path), "Production").collect()
    assert [(r["model"], r["version"]) for r in cur] == [("sales", 2)]
