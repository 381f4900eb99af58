"""Drift tests between a reference (production) period and a new period.

Every test is a few aggregates over the two inputs stacked in long form
(feature, dataset, value): one pass for many features instead of a loop per
feature, and one small result row per feature. Statistics and p-values are
DataFrame columns; the driver never holds rows.

Result schema of the tests: feature, test, statistic, p_value, alpha,
n_ref, n_new, dropped, drifted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.pvalues import chi2_sf_udf, f_sf_udf, ks_pvalue
from tidemark.operators.ranking import materialize, quantile_aggs, row_numbers, running_totals
from tidemark.operators.stats import categorical_stats, melt, melt_exact, quantiles

REF, NEW = 0, 1
# Accepted alternatives of the KS test.
KS_ALTERNATIVES = ("two-sided", "less", "greater")
KS_LAWS = ("finite", "exact", "limit")


# Numeric statistics that summary drift compares.
DRIFT_STATISTICS = ("mean", "median", "std", "min", "max")


def _check_p(p: float, name: str = "p_threshold") -> None:
    if p < 0 or p > 1:
        raise ValueError(f"{name} is a fraction from 0 to 1, not {p}")


def stack_datasets(reference: DataFrame, new: DataFrame, columns: Sequence[str],
                   value_type: str = "double") -> DataFrame:
    """(feature, ds, value) with ds 0 for the reference rows and 1 for new.
    Nulls are kept so the tests can report how many they dropped."""
    a = melt(reference.select(*columns), columns, value_type).withColumn("ds", F.lit(REF))
    b = melt(new.select(*columns), columns, value_type).withColumn("ds", F.lit(NEW))
    return a.unionByName(b)


# ---------------------------------------------------------------- summary drift

def summary_drift(new_stats: DataFrame, prod_stats: DataFrame, columns: Sequence[str],
                  limit: float, statistics: Sequence[str] = DRIFT_STATISTICS,
                  strict_reference: bool = False) -> DataFrame:
    """Statistics of the new data outside prod * (1 -/+ limit).

    Inputs are long statistics tables (feature, statistic, value). Returns
    (feature, statistic, prod_value, new_value, lower, upper, direction) for
    flagged pairs only. With a negative prod value the two bounds cross; by
    default the band is [min, max] of them. ``strict_reference=True`` keeps
    the literal comparisons (new < prod*(1-t) is low, new > prod*(1+t) high)."""
    _check_p(limit, "limit")
    p = prod_stats.select("feature", "statistic", F.col("value").alias("prod_value"))
    n = new_stats.select("feature", "statistic", F.col("value").alias("new_value"))
    j = (p.join(n, ["feature", "statistic"])
         .where(F.col("feature").isin(list(columns)) & F.col("statistic").isin(list(statistics))))
    a = F.col("prod_value") * F.lit(1.0 - limit)
    b = F.col("prod_value") * F.lit(1.0 + limit)
    lower, upper = (a, b) if strict_reference else (F.least(a, b), F.greatest(a, b))
    nv = F.col("new_value")
    direction = F.when(nv < lower, F.lit("lower")).when(nv > upper, F.lit("higher"))
    return (j.select("feature", "statistic", "prod_value", "new_value",
                     lower.alias("lower"), upper.alias("upper"), direction.alias("direction"))
            .where(F.col("direction").isNotNull()))


# ---------------------------------------------------------------- shared numeric pass

def side_counts(reference: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, exact, c_ref, c_new): one scan of each input grouped by
    distinct value (null kept as a value so drops can be counted; bigint and decimal
    values as they are, in ``exact``), written once. Levene, KS and the medians are all computed from this table."""
    columns = list(columns)
    sides = reference.select(*columns).withColumn("ds", F.lit(REF)), new.select(*columns).withColumn("ds", F.lit(NEW))
    return _side_counts(melt_exact(sides[0].unionByName(sides[1]), columns, keep=["ds"]))


def _side_counts(long: DataFrame) -> DataFrame:
    return materialize(long.groupBy("feature", "value", "exact").agg(
        F.count_if(F.col("ds") == REF).alias("c_ref"), F.count_if(F.col("ds") == NEW).alias("c_new")))


def side_summary(counts: DataFrame) -> DataFrame:
    """Per feature from ``side_counts``: n_ref, n_new, dropped, D+ and D-
    of the two empirical CDFs (ties grouped), and the exact median of each
    side. One ranking pass (range offsets) and one aggregate; the one-row-
    per-feature result is written once because several tests read it."""
    vals = counts.where(F.col("value").isNotNull())
    ranked = running_totals(vals, ["feature"], ["value", "exact"], ["c_ref", "c_new"], materialized=True)
    diff = F.try_divide(F.col("cum_c_ref"), F.col("total_c_ref")) - F.try_divide(F.col("cum_c_new"), F.col("total_c_new"))
    med_r, fin_r = quantile_aggs("value", "c_ref", {"med": 0.5}, "ref_")
    med_n, fin_n = quantile_aggs("value", "c_new", {"med": 0.5}, "new_")
    g = ranked.groupBy("feature").agg(
        F.max("total_c_ref").alias("n_ref"), F.max("total_c_new").alias("n_new"),
        F.greatest(F.max(diff), F.lit(0.0)).alias("d_plus"), F.greatest(-F.min(diff), F.lit(0.0)).alias("d_minus"),
        *med_r, *med_n)
    g = g.select("feature", "n_ref", "n_new", "d_plus", "d_minus", F.greatest("d_plus", "d_minus").alias("d"),
                 fin_r["ref_med"].alias("med_ref"), fin_n["new_med"].alias("med_new"))
    dropped = counts.groupBy("feature").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("c_ref") + F.col("c_new")).otherwise(0)).alias("dropped"))
    return materialize(dropped.join(g, "feature", "left"))


# ---------------------------------------------------------------- Levene

def _levene_w(t: DataFrame, p_threshold: float) -> DataFrame:
    """W, p-value and flag from n, sum z and sum z^2 of each side."""
    nr, nn = F.col("n_ref").cast("double"), F.col("n_new").cast("double")
    N = nr + nn
    k = (nr > 0).cast("double") + (nn > 0).cast("double")
    zbar = (F.col("s1r") + F.col("s1n")) / N
    num = nr * F.pow(F.try_divide(F.col("s1r"), nr) - zbar, 2) + nn * F.pow(F.try_divide(F.col("s1n"), nn) - zbar, 2)
    den = (F.col("s2r") - F.try_divide(F.col("s1r") * F.col("s1r"), nr)) + (F.col("s2n") - F.try_divide(F.col("s1n") * F.col("s1n"), nn))
    w = F.when(k == 2, F.try_divide((N - k) * num, (k - F.lit(1.0)) * den))
    out = t.select("feature", "n_ref", "n_new", "dropped", w.alias("statistic"), k.alias("k"), N.alias("N"))
    out = out.withColumn("p_value", f_sf_udf(F.col("statistic"), F.col("k") - F.lit(1.0), F.col("N") - F.col("k")))
    return _finish(out, "levene", p_threshold)


def levene_from(counts: DataFrame, summary: DataFrame, p_threshold: float = 0.05) -> DataFrame:
    """Levene's W from the shared counts and medians: with z = |x - median|,
    one aggregate of sum z and sum z^2 per side (weighted by the counts)
    gives W = (N-k)/(k-1) * sum n_i (zbar_i - zbar)^2 / sum_i (S2_i - S1_i^2/n_i);
    p = P(F(k-1, N-k) >= W)."""
    meds = summary.select("feature", "med_ref", "med_new")
    # One row per feature: bounded by the number of columns.
    j = counts.where(F.col("value").isNotNull()).join(F.broadcast(meds), "feature")
    zr, zn = F.abs(F.col("value") - F.col("med_ref")), F.abs(F.col("value") - F.col("med_new"))
    sums = j.groupBy("feature").agg(
        F.sum(F.col("c_ref") * zr).alias("s1r"), F.sum(F.col("c_ref") * zr * zr).alias("s2r"),
        F.sum(F.col("c_new") * zn).alias("s1n"), F.sum(F.col("c_new") * zn * zn).alias("s2n"))
    t = summary.join(sums, "feature", "left")
    return _levene_w(t, p_threshold)


def levene(reference: DataFrame, new: DataFrame, columns: Sequence[str], p_threshold: float = 0.05) -> DataFrame:
    """Brown-Forsythe / Levene test (center = median) per feature, flagged
    when p <= p_threshold.

    The medians of both periods come from brackets, and one more scan adds up |x - median|
    and its square by side: three scans that combine map-side, no table is shuffled."""
    _check_p(p_threshold)
    columns = list(columns)
    both = reference.select(*columns).withColumn("ds", F.lit(REF)).unionByName(new.select(*columns).withColumn("ds", F.lit(NEW)))
    med = materialize(quantiles(both, columns, {"med": 0.5}, keep=["ds"]).select("ds", "feature", "count", "null_count", "med"))
    v = F.col("value")
    # One row per side and feature: bounded by the number of columns.
    z = F.abs(v - F.col("med"))
    sums = (melt(both, columns, keep=["ds"]).where(v.isNotNull()).join(F.broadcast(med.select("ds", "feature", "med")), ["ds", "feature"])
            .groupBy("ds", "feature").agg(F.sum(z).alias("s1"), F.sum(z * z).alias("s2")))
    both_sides = med.join(sums, ["ds", "feature"], "left")

    def of(side, column):
        return F.coalesce(F.max(F.when(F.col("ds") == side, F.col(column))), F.lit(0))

    wide = both_sides.groupBy("feature").agg(
        of(REF, "count").alias("n_ref"), of(NEW, "count").alias("n_new"), (of(REF, "null_count") + of(NEW, "null_count")).alias("dropped"),
        *[of(side, c).alias(f"{c}{tag}") for side, tag in ((REF, "r"), (NEW, "n")) for c in ("s1", "s2")])
    return _levene_w(wide, p_threshold)


def _finish(df: DataFrame, test: str, alpha: float | Column) -> DataFrame:
    alpha_c = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return df.select(
        "feature", F.lit(test).alias("test"), F.col("statistic").cast("double").alias("statistic"),
        F.col("p_value").cast("double").alias("p_value"), alpha_c.cast("double").alias("alpha"),
        F.col("n_ref").cast("long").alias("n_ref"), F.col("n_new").cast("long").alias("n_new"),
        F.coalesce(F.col("dropped"), F.lit(0)).cast("long").alias("dropped"),
        F.coalesce(F.col("p_value") <= alpha_c, F.lit(False)).alias("drifted"))


# ---------------------------------------------------------------- KS

def ks_statistics(reference: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_ref, n_new, d_plus, d_minus, d) of the two-sample KS test,
    ties grouped. Cumulative counts come from range offsets over the distinct
    values, so a feature with billions of values is split over many tasks."""
    s = side_summary(side_counts(reference, new, columns))
    return s.select("feature", "n_ref", "n_new", "d_plus", "d_minus", "d")


def ks_from(summary: DataFrame, columns: Sequence[str], p_threshold: float = 0.05,
            alternative: str = "two-sided", bonferroni: bool = True, law: str = "finite") -> DataFrame:
    if alternative not in KS_ALTERNATIVES:
        raise ValueError(f"alternative must be one of {KS_ALTERNATIVES}")
    if law not in KS_LAWS:
        raise ValueError(f"law must be one of {KS_LAWS}")
    d = {"two-sided": F.col("d"), "greater": F.col("d_plus"), "less": F.col("d_minus")}[alternative]
    out = summary.withColumn("statistic", d).withColumn(
        "p_value", ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_new"), alternative, law))
    alpha = p_threshold / len(list(columns)) if bonferroni else p_threshold
    return _finish(out, f"ks_{alternative}", alpha)


def ks_test(reference: DataFrame, new: DataFrame, columns: Sequence[str], p_threshold: float = 0.05,
            alternative: str = "two-sided", bonferroni: bool = True, law: str = "finite") -> DataFrame:
    """Two-sample KS per feature, alpha = p_threshold / len(columns)
    (Bonferroni). ``greater`` uses D+ = max(F_ref - F_new), ``less`` D-.
    ``law`` is that of the two-sided p-value: "finite" (one sample of the rounded effective
    size), "exact" (all orders of the rows counted, for small samples) or "limit"."""
    _check_p(p_threshold)
    columns = list(columns)
    return ks_from(side_summary(side_counts(reference, new, columns)), columns, p_threshold, alternative, bonferroni, law)


def ks_by(reference: DataFrame, new: DataFrame, by: str, columns: Sequence[str], p_threshold: float = 0.05,
          alternative: str = "two-sided", law: str = "exact") -> DataFrame:
    """The test inside every group of ``by`` (a month, a store), all groups in one job: the
    columns of ``ks_test`` with ``by`` first. Each group is tested at p_threshold / len(columns).
    A group that only one period holds has no statistic; a null group is a group."""
    _check_p(p_threshold)
    columns = list(columns)
    sides = [df.select(by, *columns).withColumn("ds", F.lit(ds)) for ds, df in ((REF, reference), (NEW, new))]
    long = melt_exact(sides[0].unionByName(sides[1]), columns, keep=[by, "ds"])
    label = F.to_json(F.struct(F.col(by).cast("string").alias("g"), F.col("feature").alias("f")))
    counts = _side_counts(long.select(label.alias("feature"), "ds", "value", "exact"))
    done = ks_from(side_summary(counts), columns, p_threshold, alternative, True, law)
    group = F.get_json_object("feature", "$.g").cast(reference.schema[by].dataType)
    return done.select(group.alias(by), F.get_json_object("feature", "$.f").alias("feature"), *done.columns[1:])


# ---------------------------------------------------------------- chi-square

def contingency_chi2(cells: DataFrame, by: Sequence[str], row: str, col: str, count: str = "O",
                     yates: bool = True) -> DataFrame:
    """Pearson chi-square of independence per group from the non-zero cells
    (by..., row, col, count). Zero cells are never materialised:
    sum over all cells of (O-E)^2/E = sum over non-zero cells + (N - sum of
    their E). With ``yates`` and dof == 1 (2x2) each cell moves by
    min(0.5, |O-E|) towards E, as scipy's ``chi2_contingency`` does.
    Returns (by..., statistic, dof, N, p_value)."""
    by = list(by)
    # Non-zero cells only (at most levels x levels per feature); written once
    # because the margins and the cell pass all read them.
    cells = materialize(cells)
    rowm = cells.groupBy(*by, row).agg(F.sum(count).alias("_rsum"))
    colm = cells.groupBy(*by, col).agg(F.sum(count).alias("_csum"))
    tr = rowm.groupBy(*by).agg(F.sum("_rsum").alias("_ntot"), F.count(F.lit(1)).alias("_nrows"),
                               F.min("_rsum").alias("_rmin"), F.max("_rsum").alias("_rmax"))
    tc = colm.groupBy(*by).agg(F.count(F.lit(1)).alias("_ncols"), F.min("_csum").alias("_cmin"),
                               F.max("_csum").alias("_cmax"))
    j = (cells.join(rowm, by + [row]).join(colm, by + [col]).join(tr, by).join(tc, by))
    N = F.col("_ntot").cast("double")
    E = F.col("_rsum") * F.col("_csum") / N
    O = F.col(count).cast("double")
    dof1 = (F.col("_nrows") == 2) & (F.col("_ncols") == 2)
    corr = F.lit(yates) & dof1
    dev = F.abs(O - E)
    dev_c = F.when(corr, dev - F.least(F.lit(0.5), dev)).otherwise(dev)

    def zero_cell(e: Column) -> Column:  # contribution of a zero cell with expectation e
        return F.when(corr, h_e(e)).otherwise(e)

    per = j.groupBy(*by).agg(
        F.sum(F.pow(dev_c, 2) / E).alias("_nz"), F.sum(E).alias("_sumE"), F.sum(zero_cell(E)).alias("_sumH"),
        F.first("_ntot").alias("N"), F.first("_nrows").alias("_nrows"), F.first("_ncols").alias("_ncols"),
        F.first("_rmin").alias("_rmin"), F.first("_rmax").alias("_rmax"),
        F.first("_cmin").alias("_cmin"), F.first("_cmax").alias("_cmax"))
    N = F.col("N").cast("double")
    c_dof1 = F.lit(yates) & (F.col("_nrows") == 2) & (F.col("_ncols") == 2)
    all4 = sum((h_e(F.col(a) * F.col(b) / N) for a in ("_rmin", "_rmax") for b in ("_cmin", "_cmax")), F.lit(0.0))
    zero_part = F.when(c_dof1, all4 - F.col("_sumH")).otherwise(N - F.col("_sumE"))
    dof = (F.col("_nrows") - 1) * (F.col("_ncols") - 1)
    stat = F.when(dof == 0, F.lit(0.0)).otherwise(F.col("_nz") + zero_part)
    out = per.select(*by, stat.alias("statistic"), dof.cast("long").alias("dof"), F.col("N"))
    return out.withColumn("p_value", F.when(F.col("dof") == 0, F.lit(1.0))
                          .otherwise(chi2_sf_udf(F.col("statistic"), F.col("dof").cast("double"))))


def h_e(e: Column) -> Column:
    """Yates-corrected contribution of a zero cell with expectation e (2x2)."""
    return F.pow(e - F.least(F.lit(0.5), e), 2) / e


def chi2_homogeneity_table(reference: DataFrame, new: DataFrame, columns: Sequence[str],
                           yates: bool = True) -> DataFrame:
    """(feature, statistic, dof, N, p_value, n_ref, n_new, dropped) of the
    homogeneity test: table levels x {reference, new}. The inputs are read once, into
    one small table of cells with null as a level; a feature without any value in
    either period stays, with null statistic and p-value."""
    cells = materialize(stack_datasets(reference, new, columns, value_type="string")
                        .groupBy("feature", "value", "ds").agg(F.count(F.lit(1)).alias("O")))
    held = F.col("value").isNotNull()
    res = contingency_chi2(cells.where(held), ["feature"], "value", "ds", "O", yates)

    def total(condition):
        return F.sum(F.when(condition, F.col("O")).otherwise(0))

    sides = cells.groupBy("feature").agg(total(held & (F.col("ds") == REF)).alias("n_ref"), total(held & (F.col("ds") == NEW)).alias("n_new"),
                                         total(~held).alias("dropped"))
    return sides.join(res, "feature", "left")


def chi2_homogeneity(reference: DataFrame, new: DataFrame, columns: Sequence[str],
                     p_threshold: float = 0.05, yates: bool = True) -> DataFrame:
    """Are the level frequencies of each categorical feature the same in both
    periods? Table levels x {reference, new}; dof = (levels - 1)."""
    _check_p(p_threshold)
    return _finish(chi2_homogeneity_table(reference, new, columns, yates), "chi2_homogeneity", p_threshold)


def chi2_paired_table(reference: DataFrame, new: DataFrame, columns: Sequence[str], order: str,
                      yates: bool = True) -> DataFrame:
    """(feature, statistic, dof, N, p_value, dropped) of the paired crosstab test;
    ``dropped`` counts pairs with a null on either side."""
    columns = list(columns)
    a = row_numbers(reference.select(order, *columns), [], order, name="_rn")
    b = row_numbers(new.select(order, *columns), [], order, name="_rn")
    a = a.select("_rn", F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("_a"))
    b = b.select("_rn", F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("_b"))
    pairs = a.join(b, "_rn")
    long = pairs.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_a.{c}").alias("ref_level"), F.col(f"_b.{c}").alias("new_level"))
        for c in columns])).alias("_p")).select("_p.*")
    cells = materialize(long.groupBy("feature", "ref_level", "new_level").agg(F.count(F.lit(1)).alias("O")))
    held = F.col("ref_level").isNotNull() & F.col("new_level").isNotNull()
    res = contingency_chi2(cells.where(held), ["feature"], "ref_level", "new_level", "O", yates)
    lost = cells.groupBy("feature").agg(F.sum(F.when(~held, F.col("O")).otherwise(0)).alias("dropped"))
    return lost.join(res, "feature", "left")


def chi2_paired(reference: DataFrame, new: DataFrame, columns: Sequence[str], order: str,
                p_threshold: float = 0.05, yates: bool = True) -> DataFrame:
    """The categorical test as the reference writes it: row i of the
    reference (by ``order``) is paired with row i of the new data, the pairs
    are cross-tabulated per feature and tested for independence. Rows beyond
    the shorter side are unpaired and left out, as in a crosstab on a shared
    index. Row numbers come from range offsets, not one global window; rows with the same
    ``order`` value follow the hash of the compared columns."""
    _check_p(p_threshold)
    res = chi2_paired_table(reference, new, columns, order, yates)
    res = res.withColumn("n_ref", F.col("N")).withColumn("n_new", F.col("N"))
    return _finish(res, "chi2_paired", p_threshold)


# ---------------------------------------------------------------- mode check

def mode_drift(reference: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, ref_mode, new_mode, ref_freq, new_freq, changed) per
    categorical feature; mode ties go to the smallest level."""
    def top(df: DataFrame, side: str) -> DataFrame:
        s = categorical_stats(df, columns)
        return s.groupBy("feature").agg(
            F.max(F.when(F.col("statistic") == "top", F.col("text"))).alias(f"{side}_mode"),
            F.max(F.when(F.col("statistic") == "freq", F.col("value"))).cast("long").alias(f"{side}_freq"))
    j = top(reference, "ref").join(top(new, "new"), "feature", "full")
    return j.withColumn("changed", ~F.coalesce(F.col("ref_mode") == F.col("new_mode"), F.lit(False)))


# ---------------------------------------------------------------- promotion gate

def promotion_gate(df: DataFrame, staging: str, prod: str, min_gain: float) -> DataFrame:
    """Adds ``gain_percent`` and ``verdict`` (PROCEED / CAUTION / ALERT /
    INVALID) comparing a staging metric with the production one (higher is
    better). percent = round-half-even((staging/prod - 1) * 100, 2);
    PROCEED when percent >= 0 and staging/prod - 1 >= min_gain, CAUTION when
    only percent >= 0, ALERT otherwise. A prod metric <= 0 or null makes the
    ratio meaningless: INVALID."""
    if min_gain < 0:
        raise ValueError(f"min_gain can't be negative ({min_gain})")
    s, p = F.col(staging).cast("double"), F.col(prod).cast("double")
    frac = s / p
    pct = F.bround((frac - F.lit(1.0)) * F.lit(100.0), 2)
    valid = p.isNotNull() & s.isNotNull() & (p > 0)
    verdict = (F.when(~valid, F.lit("INVALID"))
               .when((pct >= 0) & (frac - F.lit(1.0) >= F.lit(float(min_gain))), F.lit("PROCEED"))
               .when(pct >= 0, F.lit("CAUTION"))
               .otherwise(F.lit("ALERT")))
    return df.withColumn("gain_percent", F.when(valid, pct)).withColumn("verdict", verdict)


def drift_report(reference: DataFrame, new: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 p_threshold: float = 0.05, ks_alternative: str = "two-sided", ks_law: str = "finite") -> DataFrame:
    """Levene, KS (Bonferroni) and chi-square homogeneity in one long table.
    The numeric tests share one scan of each input and one ranking pass."""
    _check_p(p_threshold)
    parts = []
    if numeric:
        counts = side_counts(reference, new, numeric)
        summary = side_summary(counts)
        parts += [levene_from(counts, summary, p_threshold), ks_from(summary, numeric, p_threshold, ks_alternative, law=ks_law)]
    if categorical:
        parts.append(chi2_homogeneity(reference, new, categorical, p_threshold))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
