"""Profiles and summary statistics, in long form (feature, statistic, value).

A numeric profile is two aggregates over its source that combine map-side: the
moments with a sketch, then counts that give the exact quantiles inside the
sketch's brackets. Categorical profiles are one grouped count of
(feature, value). Nothing row-level reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import column_roles
from tidemark.operators.ranking import materialize, running_totals

# Statistic labels of a numeric profile, in pandas ``describe``
# order followed by the two extra rows the reference adds.
NUMERIC_STATISTICS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max", "median", "null_count"]

_QUANTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}


def _clean(df: DataFrame, c: str) -> Column:
    """Numeric column as double with NaN read as null (pandas semantics)."""
    dtype = df.schema[c].dataType
    x = F.col(c).cast("double")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        x = F.when(~F.isnan(F.col(c)), x)
    return x


def melt(df: DataFrame, columns: Sequence[str], value_type: str = "double",
         keep: Sequence[str] = (), feature: str = "feature", value: str = "value",
         nan_as_null: bool = True) -> DataFrame:
    """Long form (keep..., feature, value) of several columns in one pass."""
    items = []
    for c in columns:
        v = _clean(df, c) if (value_type == "double" and nan_as_null) else F.col(c).cast(value_type)
        items.append(F.struct(F.lit(c).alias(feature), v.alias(value)))
    exploded = df.select(*keep, F.explode(F.array(*items)).alias("_tm_kv"))
    return exploded.select(*keep, f"_tm_kv.{feature}", f"_tm_kv.{value}")


def exact_type(df: DataFrame, columns: Sequence[str]) -> str | None:
    """The type that holds the values of those columns that a double may not (bigint, decimal), if there are any."""
    kinds = [df.schema[c].dataType for c in columns]
    decimals = [k for k in kinds if isinstance(k, T.DecimalType)]
    if decimals:
        return f"decimal(38,{max(k.scale for k in decimals)})"
    return "bigint" if any(isinstance(k, T.LongType) for k in kinds) else None


def melt_exact(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``melt`` with ``exact`` beside the double value: the value itself for bigint and decimal
    columns, else null. (value, exact) sorts as the values do, and tells values apart that are one as doubles."""
    kind = exact_type(df, columns) or "bigint"
    items = []
    for c in columns:
        own = isinstance(df.schema[c].dataType, (T.LongType, T.DecimalType))
        items.append(F.struct(F.lit(c).alias("feature"), _clean(df, c).alias("value"),
                              (F.col(c).try_cast(kind) if own else F.lit(None).cast(kind)).alias("exact")))
    exploded = df.select(*keep, F.explode(F.array(*items)).alias("_tm_kv"))
    return exploded.select(*keep, "_tm_kv.feature", "_tm_kv.value", "_tm_kv.exact")


# Rank error of the quantile sketch is below 1 / SKETCH_ACCURACY of the rows.
SKETCH_ACCURACY = 10_000


def _ends(probs: dict[str, float], accuracy: int, widen: int) -> list[float]:
    """Both ends, as shares of the rows, of the bracket of each quantile: twice the sketch's rank
    error to either side, times ``widen``."""
    return [min(max(p + side * 2.0 * widen / accuracy, 0.0), 1.0) for p in probs.values() for side in (-1, 1)]


def bracketed(df: DataFrame, columns: Sequence[str], probs: dict[str, float], keep: Sequence[str] = (),
              accuracy: int | None = None, widen: int = 1) -> tuple[DataFrame, DataFrame]:
    """(moments, counts) per (keep..., feature) of numeric columns, from two scans
    that combine map-side and shuffle no table.

    The first scan gives count, mean, std, min, max, null_count and, from a
    mergeable sketch, a bracket of two values around each quantile (``_ends``).
    The second counts rows by place: every value inside a bracket for itself, all values
    between two brackets together, with the smallest and the largest of them (a quantile may
    need the neighbour of its bracket). ``_gap`` marks such a row of several values, of which
    only the largest is known: a rank that falls before it was missed by its bracket.
    bigint and decimal values are kept beside their doubles (``exact``). Groups are few:
    one row each is broadcast."""
    by = [*keep, "feature"]
    accuracy = int(accuracy or SKETCH_ACCURACY)
    long = melt_exact(df, columns, keep=keep)
    v = F.col("value")
    pair = F.when(v.isNotNull(), F.struct("value", "exact"))
    ends = _ends(probs, accuracy, widen)
    moments = materialize(long.groupBy(*by).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(pair).alias("_min"), F.max(pair).alias("_max"),
        F.count_if(v.isNull()).alias("null_count"), F.percentile_approx(v, ends, accuracy).alias("_cuts")))
    cuts = moments.select(*[F.col(c).alias(f"_tm_{c}") for c in by], "_cuts")
    same = None
    for c in by:
        same = long[c].eqNullSafe(cuts[f"_tm_{c}"]) if same is None else same & long[c].eqNullSafe(cuts[f"_tm_{c}"])
    placed = long.where(v.isNotNull()).join(F.broadcast(cuts), same)
    inside = F.lit(2.0 * widen >= accuracy)  # brackets as wide as the table: every value for itself
    for i in range(0, len(ends), 2):
        inside = inside | v.between(F.col("_cuts")[i], F.col("_cuts")[i + 1])
    below = sum(((F.col("_cuts")[i] < v).cast("int") for i in range(len(ends))), F.lit(0))
    # Plain columns, no structs: Spark aggregates these in a hash table, but sorts whole partitions for the smallest struct.
    # A value's own kind rises with its double, so the ends of both belong together (null where that kind cannot hold it).
    x, no_x = F.col("exact"), F.col("exact").isNull()
    low_x = F.when(~F.min_by(no_x, v), F.min(x))
    top_x = F.when(~F.max_by(no_x, v), F.max(x))
    counts = (placed.groupBy(*by, below.alias("_place"), F.when(inside, v).alias("_at"), F.when(inside, x).alias("_at_exact"))
              .agg(F.count(F.lit(1)).alias("_n"), F.min(v).alias("_low_v"), low_x.alias("_low_x"), F.max(v).alias("_top_v"), top_x.alias("_top_x")))

    def entry(end, n, gap):
        return F.struct(F.col(f"{end}_v").alias("value"), F.col(f"{end}_x").alias("exact"), n.alias("_cnt"), gap.alias("_gap"))

    no, n = F.lit(False), F.col("_n")
    ends_of = F.array(entry("_low", F.lit(1).cast("long"), no), entry("_top", n - 1, n > 2))
    counts = counts.select(*by, F.explode(F.when(F.col("_at").isNull() & (n > 1), ends_of).otherwise(F.array(entry("_top", n, no)))).alias("_e")).select(*by, "_e.*")
    return moments.drop("_cuts"), materialize(counts)


def _ranked(counts: DataFrame, by: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """by..., the neighbours ``_lo_<q>`` and ``_hi_<q>`` (value, exact) and the fraction ``_fr_<q>`` of each
    quantile, and whether a rank was ``_missed``. One row per group, written once."""
    first, last = F.col("cum__cnt") - F.col("_cnt"), F.col("cum__cnt") - 1
    pair, aggs, missed = F.struct("value", "exact"), [], F.lit(False)
    for name, p in probs.items():
        h = (F.col("total__cnt") - 1) * F.lit(float(p))
        for tag, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            here = (first <= rank) & (rank <= last)
            aggs.append(F.max(F.when(here, pair)).alias(f"_{tag}_{name}"))
            missed = missed | (here & F.col("_gap") & (rank < last))
        aggs.append(F.max(h - F.floor(h)).alias(f"_fr_{name}"))
    ranked = running_totals(counts, by, ["value", "exact"], ["_cnt"], materialized=True)
    return materialize(ranked.groupBy(*by).agg(*aggs, F.max(missed).alias("_missed")))


def _short(x: Column) -> Column:
    """A number's digits without zeros at the end of its fraction."""
    text = x.cast("string")
    return F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def _text(lo: Column, hi: Column, fraction: Column, kind: str) -> Column:
    """The quantile between two exact neighbours, written out with two more places than they have (null if
    that passes 38 digits)."""
    wide = f"decimal(38,{2 if kind == 'bigint' else int(kind.split(',')[1][:-1]) + 2})"
    between = lo.try_cast(wide) + ((hi - lo).try_cast(wide) * fraction.cast("decimal(3,2)")).try_cast(wide)
    return F.when((lo == hi) | (fraction == 0), _short(lo)).otherwise(_short(between))


def quantiles(df: DataFrame, columns: Sequence[str], probs: dict[str, float], keep: Sequence[str] = (), texts: bool = False) -> DataFrame:
    """keep..., feature, the moments and one column per exact quantile (linear interpolation).

    Every rank is checked against its bracket; if one was missed, the brackets are made
    wider and the rows counted again, in the end with every value for itself. With ``texts``,
    ``<name>__text`` of min, max and the quantiles (quarters) of bigint and decimal columns keeps all digits."""
    by = [*keep, "feature"]
    widen = 1
    while True:
        moments, counts = bracketed(df, columns, probs, keep, widen=widen)
        found = _ranked(counts, by, probs)
        if 2 * widen >= SKETCH_ACCURACY or not found.where("_missed").limit(1).count():
            break
        widen *= 16

    def value(name):
        lo, hi = F.col(f"_lo_{name}.value"), F.col(f"_hi_{name}.value")
        return (lo + (hi - lo) * F.col(f"_fr_{name}")).alias(name)

    kind = exact_type(df, columns) or "bigint"
    written = [_text(F.col(f"_lo_{n}.exact"), F.col(f"_hi_{n}.exact"), F.col(f"_fr_{n}"), kind).alias(f"{n}__text") for n in probs] if texts else []
    found = found.select(*[F.col(c).alias(f"_tm_{c}") for c in by], *[value(n) for n in probs], *written)
    ends = [_short(F.col(f"_{n}.exact")).alias(f"{n}__text") for n in ("min", "max")] if texts else []
    moments = moments.select(*by, "count", "mean", "std", F.col("_min.value").alias("min"), F.col("_max.value").alias("max"), "null_count", *ends)
    same = None
    for c in by:
        one = moments[c].eqNullSafe(found[f"_tm_{c}"])
        same = one if same is None else same & one
    return moments.join(found, same, "left").drop(*[f"_tm_{c}" for c in by])


_STAT_SOURCE = {"count": "count", "mean": "mean", "std": "std", "min": "min", "25%": "25%", "50%": "50%",
                "75%": "75%", "max": "max", "median": "50%", "null_count": "null_count"}


def _stats_long(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    texts = {c.removesuffix("__text") for c in wide.columns if c.endswith("__text")}
    items = []
    for stat, col in _STAT_SOURCE.items():
        text = [(F.col(f"`{col}__text`") if col in texts else F.lit(None).cast("string")).alias("exact")] if texts else []
        items.append(F.struct(F.lit(stat).alias("statistic"), F.col(f"`{col}`").cast("double").alias("value"), *text))
    return wide.select(*keys, F.explode(F.array(*items)).alias("_r")).select(*keys, "_r.*")


def summary_stats(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Numeric profile: (feature, statistic, value) with the statistics in
    ``NUMERIC_STATISTICS``. ``median`` equals ``50%`` (both exact). bigint and decimal values
    are ranked as they are; with ``exact``, that column holds all digits of their min, max
    and quantiles (a double has 15 to 17), null for other columns and statistics."""
    if columns is None:
        columns = column_roles(df)["numeric"]
    columns = list(columns)
    if not columns:
        raise ValueError("no numeric columns to profile")
    return _stats_long(quantiles(df, columns, _QUANTILES, texts=exact), ["feature"])


def paired_summary_stats(reference: DataFrame, new: DataFrame,
                         columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``summary_stats`` of two periods from one grouped pass over both
    (one counts table keyed by period, one ranking job), as two long tables."""
    columns = list(columns)
    both = (reference.select(*columns).withColumn("_period", F.lit(0))
            .unionByName(new.select(*columns).withColumn("_period", F.lit(1))))
    wide = quantiles(both, columns, _QUANTILES, keep=["_period"])
    long = materialize(_stats_long(wide, ["_period", "feature"]))  # small: periods x features x 10
    return (long.where(F.col("_period") == 0).drop("_period"),
            long.where(F.col("_period") == 1).drop("_period"))


def categorical_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Categorical profile: (feature, statistic, value, text) with count, unique,
    top, freq and null_count; ``top`` is the most frequent value with the smallest
    value winning ties, in ``text``. A column without any value keeps its rows:
    count and unique 0, top and freq null."""
    if columns is None:
        columns = column_roles(df)["categorical"]
    columns = list(columns)
    counts = melt(df, columns, value_type="string").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    held, cnt = F.col("value").isNotNull(), F.col("cnt")
    per = counts.groupBy("feature").agg(
        F.sum(F.when(held, cnt).otherwise(0)).alias("count"), F.count_if(held).alias("unique"),
        F.min_by("value", F.when(held, F.struct(-cnt, F.col("value")))).alias("top"),
        F.max(F.when(held, cnt)).alias("freq"), F.sum(F.when(~held, cnt).otherwise(0)).alias("null_count"))
    no_text, no_value = F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("value")
    items = [F.struct(F.lit(name).alias("statistic"), *((no_value, F.col(name).alias("text")) if name == "top"
                                                       else (F.col(name).cast("double").alias("value"), no_text)))
             for name in ("count", "unique", "top", "freq", "null_count")]
    return per.select("feature", F.explode(F.array(*items)).alias("_r")).select("feature", "_r.*")


def profile(df: DataFrame, numeric: Sequence[str] | None = None,
            categorical: Sequence[str] | None = None) -> DataFrame:
    """Numeric and categorical profiles in one long table (feature,
    statistic, value, text)."""
    roles = column_roles(df)
    numeric = roles["numeric"] if numeric is None else list(numeric)
    categorical = roles["categorical"] if categorical is None else list(categorical)
    parts = []
    if numeric:
        parts.append(summary_stats(df, numeric).withColumn("text", F.lit(None).cast("string")))
    if categorical:
        parts.append(categorical_stats(df, categorical))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_proportions(df: DataFrame, threshold: float, columns: Sequence[str] | None = None,
                     flagged_only: bool = True) -> DataFrame:
    """(feature, null_fraction, flagged): fraction of nulls (NaN counts as
    null) per column, flagged when >= threshold. Empty input flags nothing."""
    if threshold < 0 or threshold > 1:
        raise ValueError(f"threshold is a fraction of rows, from 0 to 1, not {threshold}")
    columns = list(df.columns if columns is None else columns)
    aggs = []
    for c in columns:
        dtype = df.schema[c].dataType
        missing = F.col(c).isNull()
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            missing = missing | F.isnan(F.col(c))
        aggs.append(F.avg(missing.cast("double")).alias(c))
    wide = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("null_fraction")) for c in columns]
    out = (wide.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")
           .where(F.col("null_fraction").isNotNull())
           .withColumn("flagged", F.col("null_fraction") >= F.lit(float(threshold))))
    return out.where("flagged") if flagged_only else out


def distinct_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct rows over ``columns``, null counted as a value
    (``select(...).distinct().count()`` semantics), as a one-row DataFrame."""
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("distinct_count"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, distinct_count) per column, null counted as one value."""
    long = melt(df, columns, value_type="string", nan_as_null=False)
    return (long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_c"))
            .groupBy("feature").agg(F.count(F.lit(1)).alias("distinct_count")))


def box_stats(datasets: dict[str, DataFrame], columns: Sequence[str], whis: float = 1.5) -> DataFrame:
    """Box-plot numbers per (feature, dataset): quartiles, the furthest values
    inside [q1 - whis*IQR, q3 + whis*IQR] (never inside the box) and the count of
    values outside.
    Quartiles by brackets, then one aggregate against the fences; no table is shuffled."""
    parts = None
    for name, df in datasets.items():
        part = df.select(*columns).withColumn("dataset", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    q = quantiles(parts, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keep=["dataset"]).where(F.col("count") > 0)
    counts = melt(parts, columns, keep=["dataset"]).where(F.col("value").isNotNull())
    fences = materialize(q.select("feature", "dataset", "q1", "median", "q3",
                                  (F.col("q1") - F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("_lo"),
                                  (F.col("q3") + F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("_hi")))
    # One row per (feature, dataset): bounded by the number of columns.
    j = counts.join(F.broadcast(fences), ["feature", "dataset"])
    inside = (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
    return j.groupBy("feature", "dataset").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.least(F.min(F.when(inside, F.col("value"))), F.first("q1")).alias("whisker_lo"),
        F.greatest(F.max(F.when(inside, F.col("value"))), F.first("q3")).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a fixed order, so the preview is repeatable.
    Spark plans this as a per-partition top-n then one small merge."""
    return df.orderBy(*order).limit(int(n))
