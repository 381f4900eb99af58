"""Scoring request payloads built from table rows, one JSON document per
batch: the "records" form (a list of row objects) and the "split" form
(column names once, the row index, rows as arrays).

Batches are consecutive runs of ``batch_size`` rows in ``order`` (row numbers
from range offsets), so a document is bounded by the batch size whatever the
key distribution, and never by the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import row_numbers


def _value_json(c: str) -> Column:
    """JSON text of one value of any type (null -> null)."""
    text = F.to_json(F.struct(F.col(c).alias("v")))
    raw = F.regexp_extract(text, r'^\{"v":(.*)\}$', 1)
    return F.when(F.col(c).isNull(), F.lit("null")).otherwise(raw)


def batches(df: DataFrame, order: str, batch_size: int) -> DataFrame:
    """Adds ``batch`` = (row number in ``order`` - 1) div batch_size and
    ``_pos``, the row's number. Rows with the same ``order`` value follow the hash of their columns."""
    if batch_size < 1:
        raise ValueError("batch_size must be >= 1")
    rn = row_numbers(df, [], order, name="_pos")  # callers pass only the columns they need
    return rn.withColumn("batch", F.floor((F.col("_pos") - 1) / F.lit(int(batch_size))).cast("long"))


def records_payload(df: DataFrame, order: str, columns: Sequence[str], batch_size: int = 1000) -> DataFrame:
    """(batch, n_rows, payload) with payload = {"dataframe_records": [{...}, ...]}
    in ``order`` within the batch."""
    cols = list(columns)
    b = batches(df.select(*dict.fromkeys([order, *cols])), order, batch_size)
    g = b.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("_o"), F.struct(*cols).alias("_r")))).alias("_rows"))
    recs = F.transform("_rows", lambda x: x["_r"])
    return g.select("batch", F.size("_rows").alias("n_rows"),
                    F.to_json(F.struct(recs.alias("dataframe_records")), {"ignoreNullFields": "false"}).alias("payload"))


def split_payload(df: DataFrame, order: str, columns: Sequence[str], batch_size: int = 1000) -> DataFrame:
    """(batch, n_rows, payload) with payload =
    {"dataframe_split": {"columns": [...], "index": [...], "data": [[...], ...]}};
    the index is the ``order`` value; mixed-type rows are written as JSON
    arrays of each value's own JSON."""
    cols = list(columns)
    b = batches(df.select(*dict.fromkeys([order, *cols])), order, batch_size)
    row_json = F.concat(F.lit("["), F.concat_ws(",", *[_value_json(c) for c in cols]), F.lit("]"))
    g = b.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct(
        F.col("_pos").alias("_p"), F.col(order).alias("_o"), row_json.alias("_j")))).alias("_rows"))
    names = F.to_json(F.array(*[F.lit(c) for c in cols]))
    index = F.to_json(F.transform("_rows", lambda x: x["_o"]))
    data = F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda x: x["_j"]), ","), F.lit("]"))
    payload = F.concat(F.lit('{"dataframe_split":{"columns":'), names, F.lit(',"index":'), index,
                       F.lit(',"data":'), data, F.lit("}}"))
    return g.select("batch", F.size("_rows").alias("n_rows"), payload.alias("payload"))
