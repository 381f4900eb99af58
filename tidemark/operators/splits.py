"""Reproducible splits and samples keyed by a hash of the row key.

A row's side depends only on its key and the seed, never on partitioning or
task order, so a re-run after an executor loss puts every row on the same
side. The hash is md5 (same digest in any SQL engine)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BITS = 60  # first 15 hex digits of the digest


def hash_bits(keys: Sequence[str], seed: int) -> Column:
    """First 60 bits of md5("k1:k2:...:seed") as a non-negative bigint.
    Null key parts are skipped, so rows whose keys are all null hash alike
    (they land on one side together); split on a non-null key."""
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_unit(keys: Sequence[str], seed: int) -> Column:
    """Uniform value in [0, 1) from the key hash."""
    return hash_bits(keys, seed) / F.lit(float(2 ** _BITS))


def hash_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42,
               name: str = "split") -> DataFrame:
    """Adds ``split`` = 'test' where hash_unit < test_fraction else 'train'."""
    if not 0 < test_fraction < 1:
        raise ValueError("test_fraction must be in (0, 1)")
    return df.withColumn(name, F.when(hash_unit(keys, seed) < F.lit(float(test_fraction)), F.lit("test"))
                         .otherwise(F.lit("train")))


def sample_rows(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """Deterministic Bernoulli sample by key hash (same bucket function as
    ``hash_split``): estimates statistics without a driver collect."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return df.where(hash_unit(keys, seed) < F.lit(float(fraction)))


def stratified_split(df: DataFrame, keys: Sequence[str], stratum: str, test_fraction: float = 0.2,
                     seed: int = 42, name: str = "split", bits: int = 16) -> DataFrame:
    """Exact per-stratum test counts: the round-half-even(n * test_fraction) rows
    with the smallest key hashes of each stratum go to test. Null is a stratum
    like any other. Rows with one key share a side, so counts are exact for
    unique keys.

    The table itself is not moved: rows are counted per (stratum, first ``bits``
    bits of the hash), which finds the bucket that holds the cut; only that
    bucket's hashes (one in 2**bits) are ranked; then every row compares its hash
    with its stratum's cut."""
    if not 0 < test_fraction < 1:
        raise ValueError("test_fraction must be in (0, 1)")
    h = hash_bits(keys, seed)
    slim = df.select(F.col(stratum).alias("_tm_s"), h.alias("_tm_h"))
    top = F.shiftright("_tm_h", _BITS - bits)
    counts = slim.groupBy("_tm_s", top.alias("_tm_b")).agg(F.count(F.lit(1)).alias("_tm_c"))
    upto = Window.partitionBy("_tm_s").orderBy("_tm_b").rowsBetween(Window.unboundedPreceding, 0)
    run = counts.select("_tm_s", "_tm_b", "_tm_c", F.sum("_tm_c").over(upto).alias("_tm_u"),
                        F.sum("_tm_c").over(Window.partitionBy("_tm_s")).alias("_tm_n"))
    goal = F.bround(F.col("_tm_n") * F.lit(float(test_fraction)), 0)
    cut = (run.where((F.col("_tm_u") >= goal) & (F.col("_tm_u") - F.col("_tm_c") < goal))
           .select(F.col("_tm_s").alias("_tm_cs"), F.col("_tm_b").alias("_tm_cb"), (goal - F.col("_tm_u") + F.col("_tm_c")).alias("_tm_need")))
    inside = slim.join(F.broadcast(cut), slim["_tm_s"].eqNullSafe(F.col("_tm_cs")) & (top == F.col("_tm_cb")))
    rank = F.row_number().over(Window.partitionBy("_tm_cs").orderBy("_tm_h"))
    last = (inside.withColumn("_tm_r", rank).where(F.col("_tm_r") == F.col("_tm_need"))
            .select("_tm_cs", F.col("_tm_h").alias("_tm_last")))
    staged = df.withColumn("_tm_h", h)
    # One row per stratum. Dealt by stratum, a whole stratum would be one task.
    out = staged.join(F.broadcast(last), staged[stratum].eqNullSafe(F.col("_tm_cs")), "left")
    test = F.coalesce(F.col("_tm_h") <= F.col("_tm_last"), F.lit(False))
    return out.withColumn(name, F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_tm_h", "_tm_cs", "_tm_last")


def split_counts(df: DataFrame, split: str = "split") -> DataFrame:
    """One row: total, train and test counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(split) == "train").alias("n_train"),
                  F.count_if(F.col(split) == "test").alias("n_test"))
