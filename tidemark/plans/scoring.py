"""Batch and streaming scoring with one function.

``score`` is the ``transform`` of a fitted ``PipelineModel``,
partition-parallel, and the same call works on a batch or a streaming
DataFrame; regression forests on bins are followed once per cell (``ml.predict``). ``score_with_python`` covers arbitrary Python models through an
iterator pandas UDF that loads the model once per task, and
``score_with_python_struct`` those that give several outputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.features import FeatureLookup, lookup_missing
from tidemark.plans.ml import predict, schema_matches


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str] | None = None,
          prediction: str = "prediction", partitions: int | None = None) -> DataFrame:
    """Adds ``prediction``; keeps the input columns (or ``keep``). With ``partitions`` the rows are
    dealt out first: a costly model over few input splits then uses all cores."""
    out = predict(model, df.repartition(partitions) if partitions else df)
    cols = list(keep) if keep is not None else list(df.columns)
    return out.select(*cols, F.col("prediction").alias(prediction))


def score_batch(spine: DataFrame, lookups: Sequence[FeatureLookup], model: PipelineModel,
                keep: Sequence[str] | None = None) -> DataFrame:
    """Score from keys: look up the features the caller did not supply
    (supplied values win, a supplied null stays null), then score."""
    full = lookup_missing(spine, lookups)
    return score(full, model, keep if keep is not None else spine.columns)


def score_proba(df: DataFrame, model: PipelineModel, labels: Sequence[str], keep: Sequence[str] | None = None,
                prefix: str = "prob_") -> DataFrame:
    """Class probabilities as ``prob_<label>`` columns plus the predicted
    label as a string (``IndexToString`` over the fitted label levels)."""
    out = model.transform(df)
    arr = vector_to_array(F.col("probability"))
    to_label = IndexToString(inputCol="prediction", outputCol="_label", labels=list(labels))
    out = to_label.transform(out)
    cols = list(keep) if keep is not None else list(df.columns)
    return out.select(*cols, *[arr[i].alias(f"{prefix}{lab}") for i, lab in enumerate(labels)],
                      F.col("_label").alias("prediction"))


def score_with_python(df: DataFrame, load_model: Callable[[], object], inputs: Sequence[str],
                      return_type: T.DataType = T.DoubleType(), name: str = "prediction") -> DataFrame:
    """Score with any Python model exposing ``predict(pandas.DataFrame)``.
    Arrow batches; ``load_model`` runs once per task, not per row."""
    inputs = list(inputs)

    @F.pandas_udf(return_type)
    def _predict(it: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in it:
            yield pd.Series(model.predict(batch[inputs]))

    return df.withColumn(name, _predict(F.struct(*[F.col(c) for c in inputs])))


def score_with_python_struct(df: DataFrame, load_model: Callable[[], object], inputs: Sequence[str], outputs: T.StructType,
                             keep: Sequence[str] | None = None) -> DataFrame:
    """Score with a Python model of several outputs: ``predict(pandas.DataFrame)`` gives a
    DataFrame with the columns of ``outputs`` (probabilities and a label, say), which become
    columns beside ``keep`` (all columns by default). The model is loaded once per task and
    sees whole Arrow batches."""
    inputs, names = list(inputs), outputs.names

    @F.pandas_udf(outputs)
    def _predict(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in it:
            yield model.predict(batch[inputs])[names]

    cols = [c for c in (df.columns if keep is None else keep) if c not in names]
    out = df.withColumn("_tm_out", _predict(F.struct(*[F.col(c) for c in inputs])))
    return out.select(*cols, *[F.col("_tm_out")[n].alias(n) for n in names])


def check_predictions(scored: DataFrame, prediction: str = "prediction", dtype: T.DataType = T.IntegerType()) -> DataFrame:
    """One row: n_rows, n_null, n_nan, n_not_castable (values that do not survive a
    cast to ``dtype`` unchanged), and the smallest and largest prediction. The last two need
    every prediction's value, so the model runs over every row whatever ``dtype`` is."""
    p = F.col(prediction)
    x = p.cast("double")
    cast_back = p.try_cast(dtype).cast("double") if hasattr(p, "try_cast") else p.cast(dtype).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(p.isNull()).alias("n_null"), F.count_if(F.isnan(x)).alias("n_nan"),
                      F.count_if(p.isNotNull() & (cast_back.isNull() | (cast_back != x))).alias("n_not_castable"),
                      F.min(F.when(~F.isnan(x), x)).alias("min_prediction"), F.max(F.when(~F.isnan(x), x)).alias("max_prediction"))


def validate_model(df: DataFrame, model: PipelineModel, expected: T.StructType,
                   dtype: T.DataType = T.IntegerType(), partitions: int | None = None) -> DataFrame:
    """Model smoke test over a table: the whole input schema is compared first
    (order ignored); only if it is the expected one is the table scored and every
    prediction checked: no null, no NaN, and of ``dtype``. One result row with ``passed``; a
    wrong schema is reported, with null counts, not raised. A model that fails on a row fails the job."""
    counts = ("n_rows", "n_null", "n_nan", "n_not_castable")
    if not schema_matches(df.schema, expected):
        none = [F.lit(None).cast("long").alias(c) for c in counts]
        ends = [F.lit(None).cast("double").alias(c) for c in ("min_prediction", "max_prediction")]
        return df.sparkSession.range(1).select(F.lit(False).alias("schema_ok"), *none, *ends, F.lit(False).alias("passed"))
    checked = check_predictions(score(df, model, partitions=partitions), dtype=dtype)
    good = (F.col("n_null") == 0) & (F.col("n_nan") == 0) & (F.col("n_not_castable") == 0) & (F.col("n_rows") > 0)
    return checked.select(F.lit(True).alias("schema_ok"), *counts, "min_prediction", "max_prediction", good.alias("passed"))
