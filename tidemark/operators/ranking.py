"""Exact running totals and quantiles without a one-task window.

``Window.partitionBy(feature).orderBy(value)`` sends a whole feature (or, with
no partition key, the whole table) to one task. Here each group is first cut
into ranges at sampled boundaries (a range partitioning); the running total inside a
range comes from a window over (group, range) and the range offsets from a
small table with one row per (group, range). The result is exact; only the
range sizes are approximate, which bounds the work of any single task.

Inputs used by several branches of a plan are materialised once with a
reliable ``checkpoint()`` in the shared checkpoint folder: the branches read
the compact checkpoint instead of recomputing the source, and a lost
executor does not send the job back to the source scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

_BUCKET = "_tm_bucket"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    (The write job re-runs only the last stage: earlier stages' shuffle
    output is reused, which measured faster than persisting first.)"""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Rows one range (one window task) may hold; ranges are added as data grows.
TARGET_ROWS_PER_RANGE = 2_000_000
# Ranges are not cut smaller than this just to use more tasks.
MIN_ROWS_PER_RANGE = 20_000


def _n_buckets(df: DataFrame, buckets: int | None, target_rows: int | None = None,
               by: Sequence[str] = ()) -> int:
    """Number of ranges per group: given, or sized from ``df`` (a checkpoint,
    so this is one cheap aggregate returning one row): enough ranges that the
    largest group's ranges hold about ``target_rows`` rows, and, for small
    groups, enough to give every shuffle partition work (never below
    ``MIN_ROWS_PER_RANGE`` rows per range)."""
    if buckets:
        return max(1, int(buckets))
    target = int(target_rows or TARGET_ROWS_PER_RANGE)
    by = list(by)
    if by:
        row = df.groupBy(*by).count().agg(F.count(F.lit(1)).alias("g"), F.max("count").alias("m")).first()
        groups, largest = int(row["g"] or 0), int(row["m"] or 0)
    else:
        groups, largest = 1, df.count()
    if largest == 0:
        return 1
    for_size = -(-largest // target)
    parallelism = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    for_tasks = min(-(-parallelism // max(1, groups)), largest // MIN_ROWS_PER_RANGE)
    return int(max(1, for_size, for_tasks))


def range_buckets(df: DataFrame, by: Sequence[str], order: str | Sequence[str], buckets: int | None = None,
                  target_rows: int | None = None) -> DataFrame:
    """Add ``_tm_bucket``: the range of ``order`` (one column or several) within ``by`` that a row lies in.

    Ranges are the partitions of a range partitioning by (by, order), whose
    boundaries Spark samples from the values themselves, so they hold about the
    same number of rows for any type and distribution, long common prefixes of
    strings included, and no row is compared with all boundaries. Rows equal in all
    of ``order`` share a range. Written once: everything that reads the ranges later sees the
    stored ids."""
    by = list(by)
    n = _n_buckets(df, buckets, target_rows, by)
    if n == 1:
        return df.withColumn(_BUCKET, F.lit(0))
    if by:  # n is for the largest group; all groups together take as many of that size
        sizes = df.groupBy(*by).count().agg(F.sum("count").alias("t"), F.max("count").alias("m")).first()
        n = -(-n * int(sizes["t"]) // int(sizes["m"]))
    columns = [order] if isinstance(order, str) else list(order)
    return materialize(df.repartitionByRange(n, *by, *columns).withColumn(_BUCKET, F.spark_partition_id()))


def running_totals(df: DataFrame, by: Sequence[str], order: str | Sequence[str], weights: Sequence[str],
                   buckets: int | None = None,
                   bucket_col: Callable[[int], Column] | None = None, materialized: bool = False,
                   target_rows: int | None = None) -> DataFrame:
    """For every row add ``cum_<w>`` (sum of ``w`` over rows of the same group
    that sort at or before this row) and ``total_<w>`` (sum over the group).

    ``order`` (a column or several, all of them ranged) should be unique within
    each group; group values first when it is not.
    ``bucket_col(n)`` may give an order-preserving range id in [0, n)
    directly (for uniformly spread keys such as hashes) and skips the
    boundary sketch. ``materialized=True`` says ``df`` is already a
    checkpoint. The number of ranges is ``buckets`` or sized from the data
    (see ``TARGET_ROWS_PER_RANGE``)."""
    by = list(by)
    weights = list(weights)
    order_cols = [order] if isinstance(order, str) else list(order)
    base = df if materialized else materialize(df)
    if bucket_col is None:
        staged = range_buckets(base, by, order_cols, buckets, target_rows)
    else:
        staged = base.withColumn(_BUCKET, bucket_col(_n_buckets(base, buckets, target_rows, by)))
    keys = by + [_BUCKET]

    # Small side: one row per (group, range) with the sum of all earlier ranges.
    per_range = staged.groupBy(*keys).agg(*[F.sum(w).alias(f"_tm_rs_{w}") for w in weights])
    earlier = Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = per_range.select(
        *keys,
        *[F.coalesce(F.sum(f"_tm_rs_{w}").over(earlier), F.lit(0)).alias(f"_tm_off_{w}") for w in weights],
        *[F.sum(f"_tm_rs_{w}").over(whole).alias(f"total_{w}") for w in weights],
    )

    # Large side: running sum inside each range, one window task per range.
    inside = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.select("*", *[F.sum(w).over(inside).alias(f"_tm_loc_{w}") for w in weights])

    # null groups are groups like others, so keys are compared null-safely
    right = offsets.select(*[F.col(k).alias(f"_tm_r_{k}") for k in keys], *[c for c in offsets.columns if c not in keys])
    same = [local[k].eqNullSafe(right[f"_tm_r_{k}"]) for k in keys]
    out = local.join(right, same, "inner").drop(*[f"_tm_r_{k}" for k in keys])
    for w in weights:
        out = out.withColumn(f"cum_{w}", F.col(f"_tm_loc_{w}") + F.col(f"_tm_off_{w}"))
    drop = [_BUCKET] + [f"_tm_loc_{w}" for w in weights] + [f"_tm_off_{w}" for w in weights]
    return out.drop(*drop)


def value_counts(long_df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """(by..., value, _cnt) for non-null values; combines map-side first."""
    return (long_df.where(F.col(value).isNotNull())
            .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_cnt")))


def quantile_aggs(value: str, weight: str, probs: dict[str, float], prefix: str = "") -> tuple[list, dict]:
    """Aggregate expressions over a ``running_totals`` result (weights
    ``weight``) that pick the two neighbouring order statistics of each
    quantile, and the finishing expressions that interpolate between them
    (numpy "linear", SQL ``percentile_cont``). Returns (aggs, finals)."""
    first = F.col(f"cum_{weight}") - F.col(weight)  # 0-based rank of the first copy
    last = F.col(f"cum_{weight}") - F.lit(1)
    n = F.col(f"total_{weight}")
    aggs, finals = [], {}
    for name, p in probs.items():
        h = (n - F.lit(1)) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        tag = f"_{prefix}{name}"
        aggs.append(F.max(F.when((F.col(weight) > 0) & (first <= lo) & (lo <= last), F.col(value))).alias(f"_lo{tag}"))
        aggs.append(F.max(F.when((F.col(weight) > 0) & (first <= hi) & (hi <= last), F.col(value))).alias(f"_hi{tag}"))
        aggs.append(F.max(h - lo).alias(f"_fr{tag}"))
        lo_v, hi_v = F.col(f"_lo{tag}").cast("double"), F.col(f"_hi{tag}").cast("double")
        finals[f"{prefix}{name}"] = lo_v + (hi_v - lo_v) * F.col(f"_fr{tag}")
    return aggs, finals


def exact_quantiles(long_df: DataFrame, by: Sequence[str], probs: dict[str, float],
                    value: str = "value", buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation per group of ``by``.

    Returns one row per group with one double column per entry of ``probs``
    plus ``n`` (non-null count). Work is one shuffle of the distinct
    (group, value) pairs, written once; no group is gathered into one task."""
    by = list(by)
    counts = materialize(value_counts(long_df, by, value))
    ranked = running_totals(counts, by, value, ["_cnt"], buckets=buckets, materialized=True)
    aggs, finals = quantile_aggs(value, "_cnt", probs)
    grouped = ranked.groupBy(*by).agg(F.max("total__cnt").alias("n"), *aggs)
    return grouped.select(*by, "n", *[expr.alias(name) for name, expr in finals.items()])


def row_numbers(df: DataFrame, by: Sequence[str], order: str | Sequence[str], buckets: int | None = None,
                name: str = "row_number", target_rows: int | None = None) -> DataFrame:
    """1-based row number per group by ``order``, computed with range offsets
    instead of one window over the group.

    Rows with the same order value (nulls among them, which come first) follow the hash of
    their columns, so the numbers depend on the rows alone; only rows alike in every column
    may swap. However many share one value, they spread over ranges like any others."""
    order_cols = [order] if isinstance(order, str) else list(order)
    base = materialize(df.withColumn("_tm_one", F.lit(1)).withColumn("_tm_tie", F.xxhash64(*df.columns)))
    base = base.withColumn("_tm_at", F.monotonically_increasing_id())  # of the written rows, so the same in every attempt
    out = running_totals(base, by, [*order_cols, "_tm_tie", "_tm_at"], ["_tm_one"], buckets=buckets, materialized=True, target_rows=target_rows)
    return out.withColumnRenamed("cum__tm_one", name).drop("_tm_one", "total__tm_one", "_tm_tie", "_tm_at")
