"""Evaluation metrics as single aggregates over (label, prediction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import running_totals


def _confusion(df: DataFrame, label: str, prediction: str, positive=1) -> list:
    y = F.col(label) == F.lit(positive)
    p = F.col(prediction) == F.lit(positive)
    return [F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")]


def classification_metrics(df: DataFrame, label: str, prediction: str, positive=1) -> DataFrame:
    """One row: n, accuracy, precision, recall, f1 and the hard-label AUC
    (TPR + TNR) / 2 (what a ROC AUC on 0/1 predictions reduces to)."""
    c = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        *_confusion(df, label, prediction, positive))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    tnr = F.try_divide(tn, tn + fp)
    f1 = F.when(tp + fp + fn > 0, F.lit(2.0) * tp / (F.lit(2.0) * tp + fp + fn))
    return c.select(n.cast("long").alias("n"), "tp", "fp", "fn", "tn",
                    F.try_divide(tp + tn, n).alias("accuracy"), precision.alias("precision"),
                    recall.alias("recall"), f1.alias("f1"),
                    ((recall + tnr) / F.lit(2.0)).alias("auc_hard"))


def multiclass_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n, accuracy, auc_hard (mean over the classes of (TPR + TNR) / 2, one
    class against the rest) and f1_weighted (by class size). One grouped count
    of (label, prediction); everything else reads its few rows."""
    cells = (df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
             .groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).agg(F.count(F.lit(1)).alias("c")))
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("y").alias("k"), F.col("c").alias("own"), F.lit(0).cast("long").alias("said"), F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("own"), F.col("c").alias("said"), F.lit(0).cast("long").alias("tp")))).alias("s")).select("s.*")
    per = sides.groupBy("k").agg(*[F.sum(c).cast("double").alias(c) for c in ("own", "said", "tp")])
    whole = per.agg(F.sum("own").alias("n")).select("n")
    j = per.crossJoin(F.broadcast(whole)).where("own > 0")  # one row beside one row per class
    tnr = F.coalesce(F.try_divide(F.col("n") - F.col("own") - F.col("said") + F.col("tp"), F.col("n") - F.col("own")), F.lit(0.0))
    return j.agg(F.max("n").cast("long").alias("n"), (F.sum("tp") / F.max("n")).alias("accuracy"),
                 F.avg((F.col("tp") / F.col("own") + tnr) / 2).alias("auc_hard"),
                 (F.sum(F.col("own") * 2 * F.col("tp") / (F.col("own") + F.col("said"))) / F.max("n")).alias("f1_weighted"))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows where prediction equals label (any label type)."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n, mae, mse, rmse, r2. R2 = 1 - SSE/SST, with SST = n times
    the population variance of the label (Spark's variance aggregate merges
    partial moments stably, so this stays one pass); null when the label is
    constant."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    clean = df.where(y.isNotNull() & p.isNotNull())
    base = clean.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(y - p)).alias("mae"),
                     F.avg(F.pow(y - p, 2)).alias("mse"), F.sum(F.pow(y - p, 2)).alias("_sse"),
                     (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"))
    return base.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"),
                       F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"))


def roc_auc(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """Exact ROC AUC of a continuous score (Mann-Whitney U, ties count one
    half): sum over positives of the negatives scored below them, divided
    by P * N. Counts per distinct score, then running totals by score range,
    so no task sees more than one range of scores."""
    y = F.col(label) == F.lit(positive)
    counts = (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
              .groupBy(F.col(score).cast("double").alias("_s"))
              .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))
    cum = running_totals(counts, [], "_s", ["neg", "pos"])
    below = F.col("cum_neg") - F.col("neg")
    u = F.col("pos") * (below + F.col("neg") / F.lit(2.0))
    agg = cum.agg(F.sum(u).alias("_u"), F.first("total_pos").alias("n_pos"), F.first("total_neg").alias("n_neg"))
    return agg.select("n_pos", "n_neg", F.try_divide(F.col("_u"), F.col("n_pos") * F.col("n_neg")).alias("auc"))
