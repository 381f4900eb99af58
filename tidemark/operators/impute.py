"""Imputation fitted on one frame (train) and applied to another.

Fitted values are a one-row DataFrame (a scalar subquery at apply time), so
nothing but that row is computed before the apply job and no rows move to
the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import materialize
from tidemark.operators.stats import melt, quantiles


def fit_median(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, fill) exact medians per numeric column."""
    return quantiles(train, columns, {"fill": 0.5}).select("feature", "fill")


def fit_mode(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, fill) most frequent non-null level, ties to the smallest."""
    long = melt(train, columns, value_type="string").where(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("cnt"), F.col("value"))).alias("fill"))


def apply_fill(df: DataFrame, fills: DataFrame, columns: Sequence[str]) -> DataFrame:
    """coalesce(col, fitted value) for each column; the fitted table has one row
    per column and is written once, so the training table is read once however
    many columns are filled."""
    fills = materialize(fills)
    wide = fills.agg(*[F.max(F.when(F.col("feature") == c, F.col("fill"))).alias(c) for c in columns])
    out = df
    for c in columns:
        fill = wide.select(F.col(c).cast(df.schema[c].dataType)).scalar()
        out = out.withColumn(c, F.coalesce(F.col(c), fill))
    return out


def impute_median(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_fill(df, fit_median(train, columns), columns)


def impute_mode(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_fill(df, fit_mode(train, columns), columns)
