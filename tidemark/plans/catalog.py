"""Registered queries: each runs one operator (or one composed job) over the
driver tables and has, where SQL can express it, an equivalent DuckDB query.

Every query reads whole tables (or tables Spark derives from them); the
periods compared by the drift tests are adjacent years of the same table.
Computed doubles are rounded in both engines (4 places, or the data's own
precision for sums of prices, or significant digits for large sums), since
float sums differ in the last digits between engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions import payloads
from tidemark.functions.pvalues import ks_pvalue
from tidemark.operators import drift, features, impute, metrics, runs, splits, stats
from tidemark.operators.ranking import materialize as ranking_materialize
from tidemark.plans import ml, monitoring, registry, scoring
from tidemark.plans import sqlgen as S
from tidemark.session import scratch_path, written_out
from tidemark.sources import io
from tidemark.streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r4(c):
    return F.round(c, 4)


def r_sig(c, digits: int = 10):
    """Round to ``digits`` significant digits (large sums: 4 decimals would
    keep more digits than two engines' float summation agrees on)."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c / scale, digits - 1) * scale)


def sql_sig(expr: str, digits: int = 10) -> str:
    scale = f"power(10.0, floor(log10(abs({expr}))))"
    return f"(case when {expr} = 0 then 0.0 else round({expr} / {scale}, {digits - 1}) * {scale} end)"


# Periods compared by the drift queries: two adjacent years.
REF_LO, REF_HI, NEW_HI = "1996-01-01", "1997-01-01", "1998-01-01"
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_CAT = ["l_returnflag", "l_linestatus"]
O_CAT = ["o_orderstatus", "o_orderpriority"]


def li_periods(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return (C.period_filter(li, "l_shipdate", REF_LO, REF_HI),
            C.period_filter(li, "l_shipdate", REF_HI, NEW_HI))


def o_periods(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return (C.period_filter(o, "o_orderdate", REF_LO, REF_HI),
            C.period_filter(o, "o_orderdate", REF_HI, NEW_HI))


LI_REF_SQL = S.period("lineitem", "l_shipdate", REF_LO, REF_HI)
LI_NEW_SQL = S.period("lineitem", "l_shipdate", REF_HI, NEW_HI)
O_REF_SQL = S.period("orders", "o_orderdate", REF_LO, REF_HI)
O_NEW_SQL = S.period("orders", "o_orderdate", REF_HI, NEW_HI)


# ------------------------------------------------------------------ sources

@query("read_table", "select * from orders")
def q_read_table(spark, sf_dir):
    return io.read_table(spark, f"{sf_dir}/orders.parquet")


@query("sql_on_path", "select * from customer")
def q_sql_on_path(spark, sf_dir):
    return io.sql_on_path(spark, f"{sf_dir}/customer.parquet")


_VERSIONED_SQL = "(select *, (year(o_orderdate) - 1994)::int as ingest_version from orders)"


def _versioned_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return io.with_versions(o, F.year("o_orderdate") - F.lit(1994))


@query("latest_version", f"select max(ingest_version) as latest_version from {_VERSIONED_SQL}")
def q_latest_version(spark, sf_dir):
    return io.latest_version(_versioned_orders(spark, sf_dir))


@query("read_as_of", f"""
select ingest_version, count(*) as n_rows, round(sum(o_totalprice), 2) as total_price
from {_VERSIONED_SQL} where ingest_version <= 3 group by ingest_version""")
def q_read_as_of(spark, sf_dir):
    v = io.read_as_of(_versioned_orders(spark, sf_dir), 3)
    return v.groupBy("ingest_version").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.round(F.sum("o_totalprice"), 2).alias("total_price"))


# ------------------------------------------------------------------ projection, filter, scalar

@query("exclude_columns", "select l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, "
       "l_returnflag, l_linestatus, l_shipdate from lineitem")
def q_exclude_columns(spark, sf_dir):
    return C.exclude_columns(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey", "l_linenumber"])


@query("period_filter", LI_REF_SQL)
def q_period_filter(spark, sf_dir):
    return li_periods(spark, sf_dir)[0]


YEARS = range(1995, 2002)  # the first and the last one open


def order_years(spark, sf_dir):
    """The orders of each year, all rows in one of them."""
    o, year = table(spark, sf_dir, "orders"), F.year("o_orderdate")
    return {f"y{y}": o.where((year <= y) if y == YEARS[0] else (year >= y) if y == YEARS[-1] else year == y) for y in YEARS}


_YEAR_SQL = f"'y' || least(greatest(year(o_orderdate), {YEARS[0]}), {YEARS[-1]})"


@query("concat_periods", f"select o_orderkey, o_totalprice, o_orderstatus, {_YEAR_SQL} as period from orders")
def q_concat_periods(spark, sf_dir):
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    frames = [C.tag(df.select(*(columns if i % 2 else columns[::-1])), "period", p)
              for i, (p, df) in enumerate(order_years(spark, sf_dir).items())]
    return features.concat_periods(frames)


@query("clean_names", """
select o_orderkey as "OrderKey", o_totalprice as "TotalPrice-USD", o_orderpriority as "Priority-level"
from orders""")
def q_clean_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    messy = o.select(F.col("o_orderkey").alias("Order Key"), F.col("o_totalprice").alias("Total Price (USD)"),
                     F.col("o_orderpriority").alias("Priority (level)"))
    return C.clean_names(messy)


@query("zero_flag", """
select l_orderkey, l_linenumber, (l_discount = 0)::int as discount_is_zero, (l_tax = 0)::int as tax_is_zero
from lineitem""")
def q_zero_flag(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.zero_flag("l_discount").alias("discount_is_zero"),
                     C.zero_flag("l_tax").alias("tax_is_zero"))


@query("ratio", """
select l_orderkey, l_linenumber, l_extendedprice / l_quantity as unit_price,
       case when l_tax = 0 then null else l_discount / l_tax end as discount_per_tax
from lineitem""")
def q_ratio(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.ratio("l_extendedprice", "l_quantity").alias("unit_price"),
                     C.ratio("l_discount", "l_tax").alias("discount_per_tax"))


@query("affine", "select event_id, value * 9.0::double / 5.0::double + 32.0::double as value_f, "
       "value * 2.5::double + -1.0::double as value_scaled from events")
def q_affine(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", C.celsius_to_fahrenheit("value").alias("value_f"),
                     C.affine("value", 2.5, -1.0).alias("value_scaled"))


_MASKED_ORDERS_SQL = """(select o_orderkey, o_custkey, o_orderstatus,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then null else o_totalprice end as o_totalprice,
  o_orderdate,
  case when o_totalprice < 100000 then null else o_orderpriority end as o_orderpriority
  from orders)"""


def masked_orders(spark, sf_dir):
    """Orders with faults injected: price null for two priorities, priority
    null for cheap orders (the bad-file scenario, on the driver data)."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    C.null_where("o_totalprice", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("o_totalprice"),
                    "o_orderdate",
                    C.null_where("o_orderpriority", F.col("o_totalprice") < 100000).alias("o_orderpriority"))


@query("null_where", f"select * from {_MASKED_ORDERS_SQL}")
def q_null_where(spark, sf_dir):
    return masked_orders(spark, sf_dir)


@query("linear_score", """
select l_orderkey, l_linenumber,
  round_even(3 + 2 * l_quantity + 10 * (l_returnflag = 'R')::int - 5 * (l_linestatus = 'F')::int + 100 * l_tax, 0)::int as score,
  round_even(round_even(3 + 2 * l_quantity + 10 * (l_returnflag = 'R')::int - 5 * (l_linestatus = 'F')::int + 100 * l_tax, 0)::int * 1.3, 0)::int as score_scaled
from lineitem""")
def q_linear_score(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    terms = [(2.0, F.col("l_quantity")), (10.0, F.col("l_returnflag") == "R"),
             (-5.0, F.col("l_linestatus") == "F"), (100.0, F.col("l_tax"))]
    return li.select("l_orderkey", "l_linenumber", C.linear_score(3.0, terms).alias("score"),
                     C.linear_score(3.0, terms, scale=1.3).alias("score_scaled"))


@query("parse_events", """
select event_id, event_type, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def q_parse_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return C.parse_json_fields(ev.select("event_id", "event_type", "props"), "props", {"k": "bigint"}).drop("props")


# ------------------------------------------------------------------ joins

@query("training_set", """
select o.o_orderkey, o.o_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_regionkey, o.o_orderstatus
from orders o left join customer c on o.o_custkey = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey""")
def q_training_set(spark, sf_dir):
    spine = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    cust = features.FeatureLookup(table(spark, sf_dir, "customer"), ["c_custkey"], ["o_custkey"],
                                  ["c_nationkey", "c_acctbal", "c_mktsegment"])
    nat = features.FeatureLookup(table(spark, sf_dir, "nation"), ["n_nationkey"], ["c_nationkey"], ["n_regionkey"])
    return features.training_set(spine, [cust, nat], label="o_orderstatus")


@query("training_set_unmatched", """
select d.doc_id, d.lang, d.n_chars, l.toxic, l.quality from documents d left join labels l on d.doc_id = l.doc_id""")
def q_training_set_unmatched(spark, sf_dir):
    spine = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    lab = features.FeatureLookup(table(spark, sf_dir, "labels"), ["doc_id"])
    return features.training_set(spine, [lab], label="quality")


@query("lookup_override", """
select o.o_orderkey, o.o_custkey,
  case when o.o_orderstatus = 'F' then null else o.o_totalprice / 10 end as c_acctbal, c.c_mktsegment
from orders o left join customer c on o.o_custkey = c.c_custkey""")
def q_lookup_override(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    spine = o.select("o_orderkey", "o_custkey",
                     F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice") / 10).alias("c_acctbal"))
    cust = features.FeatureLookup(table(spark, sf_dir, "customer"), ["c_custkey"], ["o_custkey"],
                                  ["c_acctbal", "c_mktsegment"])
    return features.lookup_missing(spine, [cust])


@query("merge_features", """
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer where c_mktsegment <> 'BUILDING'
union all select c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment from customer
where c_mktsegment = 'BUILDING'""")
def q_merge_features(spark, sf_dir):
    cur = table(spark, sf_dir, "customer")
    upd = cur.where(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    return features.merge_features(cur, upd, ["c_custkey"])


# ------------------------------------------------------------------ aggregation, profile

@query("distinct_count", f"""
select 'o_orderpriority' as feature, count(distinct coalesce(o_orderpriority, '<null>')) as distinct_count
from {_MASKED_ORDERS_SQL}
union all select 'o_orderstatus', count(distinct coalesce(o_orderstatus, '<null>')) from {_MASKED_ORDERS_SQL}""")
def q_distinct_count(spark, sf_dir):
    return stats.distinct_counts(masked_orders(spark, sf_dir), ["o_orderpriority", "o_orderstatus"])


@query("distinct_rows", f"select count(*) as distinct_count from (select distinct o_orderstatus, o_orderpriority "
       f"from {_MASKED_ORDERS_SQL})")
def q_distinct_rows(spark, sf_dir):
    return stats.distinct_count(masked_orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"])


_HASH_SQL = "(('0x' || substr(md5(concat_ws(':', {keys}, '{seed}')), 1, 15))::BIGINT / 1152921504606846976.0)"


def hash_sql(keys: list[str], seed: int = 42) -> str:
    return _HASH_SQL.format(keys=", ".join(f"cast({k} as varchar)" for k in keys), seed=seed)


@query("split_counts", f"""
select count(*) as n_rows, count(*) filter (where {hash_sql(['l_orderkey', 'l_linenumber'])} >= 0.2) as n_train,
       count(*) filter (where {hash_sql(['l_orderkey', 'l_linenumber'])} < 0.2) as n_test from lineitem""")
def q_split_counts(spark, sf_dir):
    li = splits.hash_split(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 0.2, 42)
    return splits.split_counts(li)


@query("summary_stats", f"select * from {S.numeric_profile('lineitem', LI_NUM)}")
def q_summary_stats(spark, sf_dir):
    s = stats.summary_stats(table(spark, sf_dir, "lineitem"), LI_NUM)
    return s.select("feature", "statistic", r4(F.col("value")).alias("value"))


def _cat_profile_sql(source: str, columns: list[str]) -> str:
    m = S.melt(source, columns, cast="varchar")
    return f"""(with long_ as ({m}),
 c as (select feature, v, count(*) as cnt from long_ where v is not null group by feature, v),
 per as (select feature, count(v) as n, count(distinct v) as u, count(*) - count(v) as z from long_ group by feature),
 t as (select per.feature, (select v from c where c.feature = per.feature order by cnt desc, v limit 1) as top,
         (select max(cnt) from c where c.feature = per.feature) as f from per)
 select feature, 'count' as statistic, n::double as value, null::varchar as text from per
 union all select feature, 'unique', u::double, null from per
 union all select feature, 'null_count', z::double, null from per
 union all select feature, 'top', null::double, top from t
 union all select feature, 'freq', f::double, null from t)"""


@query("categorical_stats", f"select * from {_cat_profile_sql('orders', O_CAT)}")
def q_categorical_stats(spark, sf_dir):
    return stats.categorical_stats(table(spark, sf_dir, "orders"), O_CAT)


_HOLES_SQL = f"(select *, null::varchar as empty_col from {_MASKED_ORDERS_SQL})"


@query("categorical_nulls", f"select * from {_cat_profile_sql(_HOLES_SQL, ['o_orderpriority', 'empty_col'])}")
def q_categorical_nulls(spark, sf_dir):
    """Profile of a column with nulls and of one without any value."""
    holes = masked_orders(spark, sf_dir).withColumn("empty_col", F.lit(None).cast("string"))
    return stats.categorical_stats(holes, ["o_orderpriority", "empty_col"])


@query("profile", f"""
select feature, statistic, value, null::varchar as text from {S.numeric_profile(_MASKED_ORDERS_SQL, ['o_totalprice'])}
union all select * from {_cat_profile_sql(_MASKED_ORDERS_SQL, O_CAT)}""")
def q_profile(spark, sf_dir):
    p = stats.profile(masked_orders(spark, sf_dir), ["o_totalprice"], O_CAT)
    return p.withColumn("value", r4(F.col("value")))


@query("null_proportions", f"""
select feature, round(null_fraction, 4) as null_fraction, flagged from (
  select 'o_totalprice' as feature, avg((o_totalprice is null)::int::double) as null_fraction from {_MASKED_ORDERS_SQL}
  union all select 'o_orderpriority', avg((o_orderpriority is null)::int::double) from {_MASKED_ORDERS_SQL}
  union all select 'o_orderstatus', avg((o_orderstatus is null)::int::double) from {_MASKED_ORDERS_SQL}
) t, (select true as flagged) f where null_fraction >= 0.3""")
def q_null_proportions(spark, sf_dir):
    out = stats.null_proportions(masked_orders(spark, sf_dir), 0.3,
                                 ["o_totalprice", "o_orderpriority", "o_orderstatus"])
    return out.withColumn("null_fraction", r4(F.col("null_fraction")))


_BOX_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("box_stats", f"""
with long_ as (select *, 'reference' as dataset from ({S.melt('(' + LI_REF_SQL + ')', _BOX_COLS)})
  union all select *, 'new' from ({S.melt('(' + LI_NEW_SQL + ')', _BOX_COLS)})),
q as (select feature, dataset, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as med,
        quantile_cont(v, 0.75) as q3 from long_ where v is not null group by all),
f as (select *, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from q)
select f.feature, f.dataset, round(q1, 4) as q1, round(med, 4) as median, round(q3, 4) as q3,
  round(least(min(case when v >= lo and v <= hi then v end), q1), 4) as whisker_lo,
  round(greatest(max(case when v >= lo and v <= hi then v end), q3), 4) as whisker_hi,
  count(*) filter (where not (v >= lo and v <= hi)) as n_outliers
from long_ l join f using (feature, dataset) where v is not null
group by f.feature, f.dataset, q1, med, q3""")
def q_box_stats(spark, sf_dir):
    ref, new = li_periods(spark, sf_dir)
    b = stats.box_stats({"reference": ref, "new": new}, _BOX_COLS)
    return b.select("feature", "dataset", *[r4(F.col(c)).alias(c) for c in ("q1", "median", "q3", "whisker_lo", "whisker_hi")],
                    "n_outliers")


@query("head_rows", "select * from orders order by o_totalprice desc, o_orderkey limit 10")
def q_head_rows(spark, sf_dir):
    return stats.head_rows(table(spark, sf_dir, "orders"), 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("sample_rows", f"select * from lineitem where {hash_sql(['l_orderkey', 'l_linenumber'], 7)} < 0.1")
def q_sample_rows(spark, sf_dir):
    return splits.sample_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 0.1, seed=7)


# ------------------------------------------------------------------ drift

_DRIFT_LIMIT = 0.01


def summary_drift_job(spark, sf_dir, limit=_DRIFT_LIMIT):
    ref, new = li_periods(spark, sf_dir)
    prod_stats, new_stats = stats.paired_summary_stats(ref, new, LI_NUM)
    out = drift.summary_drift(new_stats, prod_stats, LI_NUM, limit)
    return out.select("feature", "statistic", *[r4(F.col(c)).alias(c) for c in ("prod_value", "new_value", "lower", "upper")],
                      "direction")


@query("summary_drift", f"""
with sr as {S.numeric_profile_raw('(' + LI_REF_SQL + ')', LI_NUM)},
sn as {S.numeric_profile_raw('(' + LI_NEW_SQL + ')', LI_NUM)},
j as (select sr.feature, sr.statistic, sr.value as prod_value, sn.value as new_value,
        least(sr.value * {repr(1.0 - _DRIFT_LIMIT)}, sr.value * {repr(1.0 + _DRIFT_LIMIT)}) as lower,
        greatest(sr.value * {repr(1.0 - _DRIFT_LIMIT)}, sr.value * {repr(1.0 + _DRIFT_LIMIT)}) as upper
      from sr join sn on sr.feature = sn.feature and sr.statistic = sn.statistic)
select feature, statistic, round(prod_value, 4) as prod_value, round(new_value, 4) as new_value,
  round(lower, 4) as lower, round(upper, 4) as upper,
  case when new_value < lower then 'lower' when new_value > upper then 'higher' end as direction
from j where new_value < lower or new_value > upper""")
def q_summary_drift(spark, sf_dir):
    return summary_drift_job(spark, sf_dir)


_LI_LONG_SQL = f"""long_ as (select *, 0 as ds from ({S.melt('(' + LI_REF_SQL + ')', LI_NUM)})
  union all select *, 1 from ({S.melt('(' + LI_NEW_SQL + ')', LI_NUM)}))"""


@query("levene_stat", f"""
with {_LI_LONG_SQL},
v as (select * from long_ where v is not null),
med as (select feature, ds, quantile_cont(v, 0.5) as m from v group by all),
z as (select v.feature, v.ds, abs(v.v - med.m) as z from v join med using (feature, ds)),
g as (select feature, ds, count(*) as n, avg(z) as zi from z group by all),
a as (select feature, avg(z) as zbar, count(*) as big_n from z group by feature),
num as (select g.feature, sum(g.n * (g.zi - a.zbar) ^ 2) as num from g join a using (feature) group by g.feature),
den as (select z.feature, sum((z.z - g.zi) ^ 2) as den from z join g using (feature, ds) group by z.feature)
select a.feature, round((a.big_n - 2) * num.num / den.den, 4) as statistic,
  (select n from g where g.feature = a.feature and ds = 0) as n_ref,
  (select n from g where g.feature = a.feature and ds = 1) as n_new
from a join num using (feature) join den using (feature)""")
def q_levene_stat(spark, sf_dir):
    ref, new = li_periods(spark, sf_dir)
    lv = drift.levene(ref, new, LI_NUM)
    return lv.select("feature", r4(F.col("statistic")).alias("statistic"), "n_ref", "n_new")


def exact_stat_sql(name: str) -> str:
    """The statistic's SQL without its rounding, for p-values."""
    import re
    return re.sub(r"round\((.*), 4\) as statistic", r"(\1) as statistic", ORACLE[name], flags=re.S)


@query("levene_drift", f"""
with r as ({exact_stat_sql('levene_stat')}),
d as (select *, (n_ref + n_new - 2)::double as n from r),
p as (select *, (select sum(case when i = 0 or i = 20000 then 1 when i % 2 = 1 then 4 else 2 end
        * exp(-(n + 1) / 2 * ln(1 + (sqrt(statistic) + i * 0.002) ^ 2 / n))) * 0.002 / 3 * 2
        * exp(lgamma((n + 1) / 2) - lgamma(n / 2)) / sqrt(n * pi()) from range(0, 20001) q(i)) as p from d)
select feature, 'levene' as test, round(statistic, 4) as statistic, round(p, 4) as p_value, 0.05::double as alpha, n_ref, n_new,
  0::bigint as dropped, p <= 0.05 as drifted from p""")
def q_levene_drift(spark, sf_dir):
    """With two periods F(1, n) is the square of Student's t, whose tail the SQL integrates."""
    ref, new = li_periods(spark, sf_dir)
    lv = drift.levene(ref, new, LI_NUM, 0.05)
    return lv.withColumn("statistic", r4(F.col("statistic"))).withColumn("p_value", r4(F.col("p_value")))


_KS_CORE_SQL = f"""
with {_LI_LONG_SQL},
c as (select feature, v, count(*) filter (where ds = 0) as c0, count(*) filter (where ds = 1) as c1
      from long_ where v is not null group by feature, v),
cum as (select feature, v,
          sum(c0) over (partition by feature order by v) / sum(c0) over (partition by feature) as f0,
          sum(c1) over (partition by feature order by v) / sum(c1) over (partition by feature) as f1,
          sum(c0) over (partition by feature) as n0, sum(c1) over (partition by feature) as n1 from c),
d as (select feature, max(n0)::bigint as n_ref, max(n1)::bigint as n_new,
        greatest(max(f0 - f1), 0) as d_plus, greatest(-min(f0 - f1), 0) as d_minus from cum group by feature),
dd as (select *, greatest(d_plus, d_minus) as d, greatest(d_plus, d_minus) * sqrt(n_ref * n_new / (n_ref + n_new)) as lam from d),
p as (select feature, case when lam <= 0 then 1.0 when lam < 1 then
        1 - sqrt(2 * pi()) / lam * sum(exp(-((2 * k - 1) ^ 2) * pi() ^ 2 / (8 * lam * lam)))
        else least(1.0, greatest(0.0, 2 * sum(power(-1.0, k - 1) * exp(-2.0 * k * k * lam * lam)))) end as p_value
      from dd, range(1, 21) r(k) group by feature, lam)"""


@query("ks_stat", _KS_CORE_SQL + """
select feature, n_ref, n_new, round(d_plus, 6) as d_plus, round(d_minus, 6) as d_minus, round(d, 6) as d,
  round(p_value, 6) as p_value from dd join p using (feature)""")
def q_ks_stat(spark, sf_dir):
    ref, new = li_periods(spark, sf_dir)
    ks = drift.ks_statistics(ref, new, LI_NUM)
    ks = ks.withColumn("p_value", ks_pvalue(F.col("d"), F.col("n_ref"), F.col("n_new")))
    return ks.select("feature", "n_ref", "n_new", *[F.round(c, 6).alias(c) for c in ("d_plus", "d_minus", "d", "p_value")])


@query("ks_drift", _KS_CORE_SQL + f"""
select feature, 'ks_two-sided' as test, round(d, 6) as statistic, round(p_value, 6) as p_value,
  {0.05 / len(LI_NUM)!r}::double as alpha, n_ref, n_new, 0::bigint as dropped, p_value <= {0.05 / len(LI_NUM)!r} as drifted
from dd join p using (feature)""")
def q_ks_drift(spark, sf_dir):
    ref, new = li_periods(spark, sf_dir)
    ks = drift.ks_test(ref, new, LI_NUM, 0.05, law="limit")
    return ks.withColumn("statistic", F.round("statistic", 6)).withColumn("p_value", F.round("p_value", 6))


_KS_MONTHS_SQL = f"""
with recursive long_ as (select month(o_orderdate) as m, o_totalprice as v, 0 as ds from ({O_REF_SQL})
  union all select month(o_orderdate), o_totalprice, 1 from ({O_NEW_SQL})),
c as (select m, v, count(*) filter (where ds = 0) as c0, count(*) filter (where ds = 1) as c1 from long_ group by m, v),
cum as (select m, sum(c0) over w as f0, sum(c1) over w as f1, sum(c0) over (partition by m) as n0, sum(c1) over (partition by m) as n1
        from c window w as (partition by m order by v)),
-- the statistic as a whole number: it is a multiple of 1 / (n0 n1)
d as (select m, max(n0)::bigint as n0, max(n1)::bigint as n1, max(abs(f0 * n1 - f1 * n0))::bigint as top from cum group by m),
-- share of the orders of both samples' rows that stay inside, diagonal by diagonal
walk as (
  select m, 0::bigint as s, 0::bigint as i, 1.0::double as p from d
  union all
  select m, s, i, sum(p) from (
    select w.m, w.s + 1 as s, w.i + e.e as i, w.p * (case when e.e = 1 then w.i + 1 else w.s - w.i + 1 end) / (w.s + 1)::double as p
    from walk w join d using (m), (values (0), (1)) e(e)
    where w.i + e.e <= d.n0 and w.s + 1 - w.i - e.e <= d.n1 and abs((w.i + e.e) * d.n1 - (w.s + 1 - w.i - e.e) * d.n0) < d.top)
  group by m, s, i),
p as (select d.*, 1 - coalesce(walk.p, 0) as p_value from d left join walk on walk.m = d.m and walk.s = d.n0 + d.n1)"""


@query("ks_small", _KS_MONTHS_SQL + """
select m as month, 'o_totalprice' as feature, n0 as n_ref, n1 as n_new, round(top / (n0 * n1)::double, 6) as statistic,
  round(p_value, 6) as p_value, p_value <= 0.05 as drifted from p""")
def q_ks_small(spark, sf_dir):
    """Each month of a year against the same month of the next, with the exact law for small samples."""
    ref, new = (df.withColumn("month", F.month("o_orderdate")) for df in o_periods(spark, sf_dir))
    ks = drift.ks_by(ref, new, "month", ["o_totalprice"])
    return ks.select("month", "feature", "n_ref", "n_new", F.round("statistic", 6).alias("statistic"), F.round("p_value", 6).alias("p_value"), "drifted")


@query("ks_finite", _KS_CORE_SQL + """,
e as (select feature, d, n_ref, n_new, round_even(n_ref * n_new / (n_ref + n_new)::double, 0) as n from dd),
z as (select *, d * sqrt(n) as z, case when n * d * d >= 4 then 1 else 0 end as far from e),
k as (select *, pi() ^ 2 * (k + 0.5) ^ 2 as a, pi() ^ 2 * k ^ 2 as b, exp(-(pi() ^ 2) * (k + 0.5) ^ 2 / (2 * z * z)) as ea,
        exp(-(pi() ^ 2) * k ^ 2 / (2 * z * z)) as eb from z, range(-40, 41) r(k)),
q as (select feature, d, n_ref, n_new, n, z, far,
        sqrt(2 * pi()) / z * sum(ea) / 2 + sqrt(pi() / 2) / (6 * z ^ 4) * sum((a - z ^ 2) * ea) / sqrt(n)
        + (sqrt(pi() / 2) / (72 * z ^ 7) * sum((6 * z ^ 6 + 2 * z ^ 4 + (2 * z ^ 4 - 5 * z ^ 2) * a + (1 - 2 * z ^ 2) * a * a) * ea)
           - sqrt(pi() / 2) / (36 * z ^ 3) * sum(b * eb)) / n as inside
      from k group by feature, d, n_ref, n_new, n, z, far),
-- far out the sum over single values, each term as a product of logarithms
f as (select feature, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + (j - 1) * ln(d + j / n) + (n - j) * ln(1 - d - j / n) + ln(d))) as one
      from q, range(0, 2000000) r(j) where far = 1 and d + j / n < 1 group by feature)
select feature, n_ref, n_new, round(d, 6) as statistic, round(case when far = 1 then least(1.0, 2 * one) else 1 - inside end, 4) as p_value
from q left join f using (feature)""")
def q_ks_finite(spark, sf_dir):
    """Two years of lineitem under the law of the rounded effective size."""
    ref, new = li_periods(spark, sf_dir)
    ks = drift.ks_test(ref, new, LI_NUM, 0.05, law="finite")
    return ks.select("feature", "n_ref", "n_new", F.round("statistic", 6).alias("statistic"), F.round("p_value", 4).alias("p_value"))


_LI_CAT_LONG_SQL = f"""long_ as (select *, 0 as ds from ({S.melt('(' + LI_REF_SQL + ')', LI_CAT, 'varchar')})
  union all select *, 1 from ({S.melt('(' + LI_NEW_SQL + ')', LI_CAT, 'varchar')}))"""



def chi_tail_sql(stat: str, dof: str) -> str:
    """P(chi-square(dof) >= stat) by Simpson's rule over the density of its square root."""
    return f"""(select case when {dof} = 0 then 1.0 else sum(case when i = 0 or i = 20000 then 1 when i % 2 = 1 then 4 else 2 end
      * exp(({dof} - 1) * ln(greatest(sqrt({stat}) + i * 0.002, 1e-300)) - (sqrt({stat}) + i * 0.002) ^ 2 / 2)) * 0.002 / 3
      * exp((1 - {dof} / 2.0) * ln(2) - lgamma({dof} / 2.0)) end from range(0, 20001) r(i))"""


@query("chi2_homogeneity_stat", f"""
with {_LI_CAT_LONG_SQL},
g as (select feature, v, count(*) filter (where ds = 0) as o0, count(*) filter (where ds = 1) as o1
      from long_ where v is not null group by feature, v),
m as (select feature, sum(o0) as c0, sum(o1) as c1, sum(o0 + o1) as n, count(*) as levels from g group by feature),
e as (select g.feature, o0, o1, (o0 + o1) * c0 / n as e0, (o0 + o1) * c1 / n as e1, levels, n from g join m using (feature)),
s as (select feature, levels - 1 as dof, sum(
   case when levels = 2 then (abs(o0 - e0) - least(0.5, abs(o0 - e0))) ^ 2 / e0 + (abs(o1 - e1) - least(0.5, abs(o1 - e1))) ^ 2 / e1
        else (o0 - e0) ^ 2 / e0 + (o1 - e1) ^ 2 / e1 end) as statistic, max(n) as n from e group by feature, levels)
select feature, round(statistic, 4) as statistic, dof::bigint as dof from s""")
def q_chi2_homogeneity_stat(spark, sf_dir):
    ref, new = li_periods(spark, sf_dir)
    res = drift.chi2_homogeneity_table(ref, new, LI_CAT)
    return res.select("feature", r4(F.col("statistic")).alias("statistic"), "dof")


@query("chi2_homogeneity", f"""
with r as ({exact_stat_sql('chi2_homogeneity_stat')}),
n as (select feature, count(*) filter (where ds = 0) as n_ref, count(*) filter (where ds = 1) as n_new
      from (with {_LI_CAT_LONG_SQL} select * from long_) where v is not null group by feature),
p as (select *, {chi_tail_sql('statistic', 'dof')} as p from r)
select feature, 'chi2_homogeneity' as test, round(statistic, 4) as statistic, round(p, 4) as p_value, 0.05::double as alpha, n_ref, n_new,
  0::bigint as dropped, p <= 0.05 as drifted from p join n using (feature)""")
def q_chi2_homogeneity(spark, sf_dir):
    ref, new = li_periods(spark, sf_dir)
    res = drift.chi2_homogeneity(ref, new, LI_CAT, 0.05)
    return res.withColumn("statistic", r4(F.col("statistic"))).withColumn("p_value", r4(F.col("p_value")))


@query("chi2_paired_stat", f"""
with a as (select row_number() over (order by o_orderkey) as rn, * from ({O_REF_SQL})),
b as (select row_number() over (order by o_orderkey) as rn, * from ({O_NEW_SQL})),
p as (select 'o_orderstatus' as feature, a.o_orderstatus as r, b.o_orderstatus as c from a join b using (rn)
      union all select 'o_orderpriority', a.o_orderpriority, b.o_orderpriority from a join b using (rn)),
cells as (select feature, r, c, count(*) as o from p where r is not null and c is not null group by all),
rows_ as (select feature, r, sum(o) as rr from cells group by all),
cols_ as (select feature, c, sum(o) as cc from cells group by all),
tot as (select feature, sum(o) as n, (select count(*) from rows_ x where x.feature = cells.feature) as nr,
          (select count(*) from cols_ y where y.feature = cells.feature) as nc from cells group by feature),
grid as (select rows_.feature, r, c, rr * cc / n as e, nr, nc from rows_ join cols_ using (feature) join tot using (feature)),
full_ as (select grid.*, coalesce(cells.o, 0) as o from grid left join cells using (feature, r, c))
select feature, round(sum(case when nr = 2 and nc = 2 then (abs(o - e) - least(0.5, abs(o - e))) ^ 2 / e
                               else (o - e) ^ 2 / e end), 4) as statistic,
       ((max(nr) - 1) * (max(nc) - 1))::bigint as dof from full_ group by feature""")
def q_chi2_paired_stat(spark, sf_dir):
    ref, new = o_periods(spark, sf_dir)
    res = drift.chi2_paired_table(ref, new, O_CAT, "o_orderkey")
    return res.select("feature", r4(F.col("statistic")).alias("statistic"), "dof")


@query("chi2_paired", f"""
with r as ({exact_stat_sql('chi2_paired_stat')}),
n as (select least((select count(*) from ({O_REF_SQL})), (select count(*) from ({O_NEW_SQL}))) as n),
p as (select *, {chi_tail_sql('statistic', 'dof')} as p from r)
select feature, 'chi2_paired' as test, round(statistic, 4) as statistic, round(p, 4) as p_value, 0.05::double as alpha, n as n_ref, n as n_new,
  0::bigint as dropped, p <= 0.05 as drifted from p, n""")
def q_chi2_paired(spark, sf_dir):
    ref, new = o_periods(spark, sf_dir)
    res = drift.chi2_paired(ref, new, O_CAT, "o_orderkey", 0.05)
    return res.withColumn("statistic", r4(F.col("statistic"))).withColumn("p_value", r4(F.col("p_value")))


def _mode_sql(source: str) -> str:
    m = S.melt(source, O_CAT, cast="varchar")
    return f"""(with long_ as ({m}),
 c as (select feature, v, count(*) as cnt from long_ where v is not null group by feature, v),
 t as (select feature, v, cnt, row_number() over (partition by feature order by cnt desc, v) as rn from c)
 select feature, v as mode, cnt as freq from t where rn = 1)"""


@query("mode_drift", f"""
select r.feature, r.mode as ref_mode, r.freq as ref_freq, n.mode as new_mode, n.freq as new_freq,
  r.mode <> n.mode as changed
from {_mode_sql('(' + O_REF_SQL + ')')} r join {_mode_sql('(' + O_NEW_SQL + ')')} n using (feature)""")
def q_mode_drift(spark, sf_dir):
    ref, new = o_periods(spark, sf_dir)
    return drift.mode_drift(ref, new, O_CAT)


# ------------------------------------------------------------------ runs and registry (derived from events)

_RUNS_SQL = """(select event_type as experiment, cast(event_id as varchar) as run_id, ts as start_time,
   'value' as metric, value from events
 union all select event_type, cast(event_id as varchar), ts, 'k',
   cast(json_extract_string(props, '$.k') as double) from events)"""


def runs_table(spark, sf_dir):
    """Run log derived from the event table: one run per event, two metrics."""
    ev = table(spark, sf_dir, "events")
    base = ev.select(F.col("event_type").alias("experiment"), F.col("event_id").cast("string").alias("run_id"),
                     F.col("ts").alias("start_time"), "value", "props")
    a = base.select("experiment", "run_id", "start_time", F.lit("value").alias("metric"), "value")
    b = base.select("experiment", "run_id", "start_time", F.lit("k").alias("metric"),
                    F.get_json_object("props", "$.k").cast("double").alias("value"))
    return a.unionByName(b)


_STAGE_SQL = """(select event_type as model, cast(user_id as integer) as version,
   case when value < 100 then 'Staging' when value < 250 then 'Production' when value < 400 then 'None'
        else 'Archived' end as stage,
   cast(json_extract_string(props, '$.k') as integer) >= 50 as archive_existing, ts as "at",
   cast(event_id as varchar) as run_id from events)"""


def stage_events(spark, sf_dir):
    """Registry event log derived from the event table."""
    ev = table(spark, sf_dir, "events")
    stage = (F.when(F.col("value") < 100, "Staging").when(F.col("value") < 250, "Production")
             .when(F.col("value") < 400, "None").otherwise("Archived"))
    return ev.select(F.col("event_type").alias("model"), F.col("user_id").cast("int").alias("version"),
                     stage.alias("stage"),
                     (F.get_json_object("props", "$.k").cast("int") >= 50).alias("archive_existing"),
                     F.col("ts").alias("at"), F.col("event_id").cast("string").alias("run_id"))


@query("latest_run", f"""
select experiment, arg_max(run_id, (start_time, run_id)) as run_id, max(start_time) as start_time
from (select experiment, run_id, max(start_time) as start_time from {_RUNS_SQL} group by all) group by experiment""")
def q_latest_run(spark, sf_dir):
    return runs.latest_run(runs_table(spark, sf_dir))


@query("latest_experiment", f"""
select experiment, start_time as last_update from {_RUNS_SQL}
order by start_time desc, experiment desc limit 1""")
def q_latest_experiment(spark, sf_dir):
    return runs.latest_experiment(runs_table(spark, sf_dir))


@query("best_run", f"""
select experiment, run_id, value from (
  select experiment, run_id, value, row_number() over (partition by experiment order by value desc, run_id) as rn
  from {_RUNS_SQL} where metric = 'value' and value is not null) where rn = 1""")
def q_best_run(spark, sf_dir):
    return runs.best_run(runs_table(spark, sf_dir), "value")


_CURRENT_SQL = f"""(with ev as {_STAGE_SQL},
last_ as (select model, version, stage, "at" as since from (
  select *, row_number() over (partition by model, version order by "at" desc, stage desc) as rn from ev) where rn = 1),
arch as (select model, stage, max("at") as arch_at from ev where archive_existing and stage in ('Staging', 'Production')
         group by model, stage)
select l.model, l.version, case when a.arch_at > l.since then 'Archived' else l.stage end as stage
from last_ l left join arch a on l.model = a.model and l.stage = a.stage)"""


@query("current_stages", f"select * from {_CURRENT_SQL}")
def q_current_stages(spark, sf_dir):
    return runs.current_stages(stage_events(spark, sf_dir))


@query("model_in_stage", f"""
select model, max(version) as version from {_CURRENT_SQL} where stage = 'Production' group by model""")
def q_model_in_stage(spark, sf_dir):
    return runs.model_in_stage(stage_events(spark, sf_dir), "Production")


@query("runs_in_stage", f"""
with p as (select model, max(version) as version from {_CURRENT_SQL} where stage = 'Production' group by model),
f as (select model, version, arg_min(run_id, ("at", run_id)) as run_id from {_STAGE_SQL} group by model, version)
select model, version, run_id, r.value from p join f using (model, version)
join (select run_id, value from {_RUNS_SQL} where metric = 'value') r using (run_id)""")
def q_runs_in_stage(spark, sf_dir):
    """The run and its metric behind each production version."""
    metric = runs_table(spark, sf_dir).where(F.col("metric") == "value").select("run_id", "value")
    return runs.runs_in_stage(stage_events(spark, sf_dir), "Production").join(metric, "run_id").select("model", "version", "run_id", "value")


@query("latest_model_version", f"select model, max(version) as latest_version from {_STAGE_SQL} group by model")
def q_latest_model_version(spark, sf_dir):
    return runs.latest_model_version(stage_events(spark, sf_dir))


@query("promotion_gate", f"""
with r as (select * from {_RUNS_SQL} where metric = 'value'),
m as (select experiment, arg_max(value, (start_time, run_id)) as staging, arg_min(value, (start_time, run_id)) as prod
      from r group by experiment)
select experiment, staging, prod,
  case when prod > 0 then round_even((staging / prod - 1) * 100, 2) end as gain_percent,
  case when prod is null or staging is null or prod <= 0 then 'INVALID'
       when round_even((staging / prod - 1) * 100, 2) >= 0 and staging / prod - 1 >= 0.05 then 'PROCEED'
       when round_even((staging / prod - 1) * 100, 2) >= 0 then 'CAUTION' else 'ALERT' end as verdict
from m""")
def q_promotion_gate(spark, sf_dir):
    r = runs_table(spark, sf_dir).where(F.col("metric") == "value")
    m = r.groupBy("experiment").agg(F.max_by("value", F.struct("start_time", "run_id")).alias("staging"),
                                    F.min_by("value", F.struct("start_time", "run_id")).alias("prod"))
    return drift.promotion_gate(m, "staging", "prod", 0.05)


# ------------------------------------------------------------------ feature preparation

@query("one_hot", """
select o_orderkey,
  (o_orderpriority = '2-HIGH')::int as "o_orderpriority_2-HIGH",
  (o_orderpriority = '3-MEDIUM')::int as "o_orderpriority_3-MEDIUM",
  (o_orderpriority = '4-NOT SPECIFIED')::int as "o_orderpriority_4-NOT SPECIFIED",
  (o_orderpriority = '5-LOW')::int as "o_orderpriority_5-LOW",
  (o_orderstatus = 'O')::int as "o_orderstatus_O", (o_orderstatus = 'P')::int as "o_orderstatus_P"
from orders""")
def q_one_hot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return features.one_hot(o, ["o_orderpriority", "o_orderstatus"], max_levels=1000)


@query("key_violations", """
select l_orderkey, count(*) as n_rows, 'duplicate_key' as reason from lineitem group by l_orderkey having count(*) > 1""")
def q_key_violations(spark, sf_dir):
    return features.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("stratified_split", f"""
select o_orderkey, o_orderstatus,
  case when rn <= round_even(n * 0.2, 0) then 'test' else 'train' end as split
from (select o_orderkey, o_orderstatus,
        row_number() over (partition by o_orderstatus order by ('0x' || substr(md5(concat_ws(':', cast(o_orderkey as varchar), '42')), 1, 15))::BIGINT) as rn,
        count(*) over (partition by o_orderstatus) as n from orders)""")
def q_stratified_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_split(o, ["o_orderkey"], "o_orderstatus", 0.2, 42)


@query("stratified_split_nulls", f"""
select o_orderkey, o_orderpriority,
  case when rn <= round_even(n * 0.2, 0) then 'test' else 'train' end as split
from (select o_orderkey, o_orderpriority,
        row_number() over (partition by o_orderpriority order by ('0x' || substr(md5(concat_ws(':', cast(o_orderkey as varchar), '42')), 1, 15))::BIGINT) as rn,
        count(*) over (partition by o_orderpriority) as n from {_MASKED_ORDERS_SQL})""")
def q_stratified_split_nulls(spark, sf_dir):
    m = masked_orders(spark, sf_dir).select("o_orderkey", "o_orderpriority")
    return splits.stratified_split(m, ["o_orderkey"], "o_orderpriority", 0.2, 42)


@query("hash_split", f"""
select l_orderkey, l_linenumber, case when {hash_sql(['l_orderkey', 'l_linenumber'])} < 0.2 then 'test' else 'train' end as split
from lineitem""")
def q_hash_split(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return splits.hash_split(li, ["l_orderkey", "l_linenumber"], 0.2, 42)


@query("impute_median", f"""
with m as {_MASKED_ORDERS_SQL},
fill as (select quantile_cont(o_totalprice, 0.5) as f from m where {hash_sql(['o_orderkey'])} >= 0.2)
select o_orderkey, round(coalesce(o_totalprice, (select f from fill)), 4) as o_totalprice from m""")
def q_impute_median(spark, sf_dir):
    m = masked_orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    train = splits.hash_split(m, ["o_orderkey"], 0.2, 42).where(F.col("split") == "train")
    out = impute.impute_median(train, m, ["o_totalprice"])
    return out.withColumn("o_totalprice", r4(F.col("o_totalprice")))


@query("impute_mode", f"""
with m as {_MASKED_ORDERS_SQL},
c as (select o_orderpriority as v, count(*) as cnt from m
      where {hash_sql(['o_orderkey'])} >= 0.2 and o_orderpriority is not null group by 1),
fill as (select v from c order by cnt desc, v limit 1)
select o_orderkey, coalesce(o_orderpriority, (select v from fill)) as o_orderpriority from m""")
def q_impute_mode(spark, sf_dir):
    m = masked_orders(spark, sf_dir).select("o_orderkey", "o_orderpriority")
    train = splits.hash_split(m, ["o_orderkey"], 0.2, 42).where(F.col("split") == "train")
    return impute.impute_mode(train, m, ["o_orderpriority"])


# ------------------------------------------------------------------ metrics

@query("accuracy", "select avg((quality = toxic)::int::double) as accuracy from labels")
def q_accuracy(spark, sf_dir):
    return metrics.accuracy(table(spark, sf_dir, "labels"), "quality", "toxic")


@query("classification_metrics", """
with c as (select count(*) filter (where quality = 1 and toxic = 1) as tp,
                  count(*) filter (where quality = 0 and toxic = 1) as fp,
                  count(*) filter (where quality = 1 and toxic = 0) as fn,
                  count(*) filter (where quality = 0 and toxic = 0) as tn from labels)
select (tp + fp + fn + tn)::bigint as n, tp, fp, fn, tn,
  round((tp + tn) / (tp + fp + fn + tn)::double, 4) as accuracy, round(tp / (tp + fp)::double, 4) as precision,
  round(tp / (tp + fn)::double, 4) as recall, round(2.0 * tp / (2 * tp + fp + fn), 4) as f1,
  round((tp / (tp + fn)::double + tn / (tn + fp)::double) / 2, 4) as auc_hard from c""")
def q_classification_metrics(spark, sf_dir):
    m = metrics.classification_metrics(table(spark, sf_dir, "labels"), "quality", "toxic")
    return m.select("n", "tp", "fp", "fn", "tn",
                    *[r4(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1", "auc_hard")])


@query("regression_metrics", f"""
with p as (select l.l_extendedprice as y, l.l_quantity * p.p_retailprice as yhat
           from lineitem l join part p on l.l_partkey = p.p_partkey),
m as (select avg(y) as my from p)
select count(*) as n, round(avg(abs(y - yhat)), 4) as mae, {sql_sig("avg((y - yhat) ^ 2)")} as mse,
  round(sqrt(avg((y - yhat) ^ 2)), 4) as rmse,
  round(1 - sum((y - yhat) ^ 2) / sum((y - (select my from m)) ^ 2), 4) as r2 from p""")
def q_regression_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    pred = li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("yhat"))
    m = metrics.regression_metrics(pred, "y", "yhat")
    return m.select("n", r4(F.col("mae")).alias("mae"), r_sig(F.col("mse")).alias("mse"),
                    *[r4(F.col(c)).alias(c) for c in ("rmse", "r2")])


# ------------------------------------------------------------------ sinks that round-trip through files

@query("read_csv", "select * from orders")
def q_read_csv(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    io.write_csv(o, path)
    return written_out(io.read_csv(spark, path, schema=o.schema), path)


@query("append_period", f"""
select {_YEAR_SQL} as period, count(*) as n_rows, round(sum(o_totalprice), 2) as total_price from orders group by 1""")
def q_append_period(spark, sf_dir):
    path = scratch_path(spark, "orders-periods")
    for v, (period, df) in enumerate(order_years(spark, sf_dir).items(), 1):
        io.append_period(df, path, "period", period, version=v)
    io.append_period(df, path, "period", period, version=v)  # re-run: replaces, does not duplicate
    t = spark.read.parquet(path)
    return written_out(t.groupBy("period").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total_price")), path)


@query("period_history", f"""
select v.version, {_YEAR_SQL} as period, count(*) as n_rows,
  round(sum(case when v.version = 8 and year(o_orderdate) <= {YEARS[0]} then o_totalprice + 1 else o_totalprice end), 2) as total_price
from orders, (values (7), (8)) v(version) group by all""")
def q_period_history(spark, sf_dir):
    """A period written again as a new version: the table as of the version before shows the old rows."""
    path = scratch_path(spark, "orders-history")
    years = order_years(spark, sf_dir)
    for v, (period, df) in enumerate(years.items(), 1):
        io.append_period(df, path, "period", period, version=v)
    first = next(iter(years))
    io.append_period(years[first].withColumn("o_totalprice", F.col("o_totalprice") + 1), path, "period", first, version=8)
    t = spark.read.parquet(path)
    seen = [io.read_as_of(t, v, "period").withColumn("version", F.lit(v)) for v in (7, 8)]
    return written_out(seen[0].unionByName(seen[1]).groupBy("version", "period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("o_totalprice"), 2).alias("total_price")), path)


@query("save_table", "select c_mktsegment, count(*) as n_rows from customer group by c_mktsegment")
def q_save_table(spark, sf_dir):
    db = "tidemark_features"
    location = scratch_path(spark, "warehouse")
    io.ensure_database(spark, db, comment="feature tables", location=location)
    name = f"{db}.customer_features"
    io.drop_feature_table(spark, name)
    io.save_table(table(spark, sf_dir, "customer"), name, comment="customer features keyed by c_custkey")
    out = written_out(io.read_table(spark, name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows")))
    io.drop_feature_table(spark, name)
    if spark.catalog.tableExists(name):
        raise RuntimeError(f"{name} was not dropped")
    return out


@query("load_stats", f"select * from {S.numeric_profile('lineitem', LI_NUM)}")
def q_load_stats(spark, sf_dir):
    path = scratch_path(spark, "run-stats")
    io.save_stats(stats.summary_stats(table(spark, sf_dir, "lineitem"), LI_NUM), path, "run-1")
    s = io.load_stats(spark, path, "run-1")
    return written_out(s.select("feature", "statistic", r4(F.col("value")).alias("value")), path)


# ------------------------------------------------------------------ payloads

@query("records_payload", """
with b as (select (row_number() over (order by o_orderkey) - 1) // 1000 as batch, o_orderkey, o_totalprice, o_orderpriority
           from orders)
select batch, count(*) as n_rows,
  to_json({'dataframe_records': list({'o_orderkey': o_orderkey, 'o_totalprice': o_totalprice,
                                      'o_orderpriority': o_orderpriority} order by o_orderkey)})::varchar as payload
from b group by batch""")
def q_records_payload(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return payloads.records_payload(o, "o_orderkey", ["o_orderkey", "o_totalprice", "o_orderpriority"], 1000)


@query("records_payload_nulls", f"""
with b as (select (row_number() over (order by o_orderkey) - 1) // 500 as batch, o_orderkey, o_totalprice, o_orderpriority
           from {_MASKED_ORDERS_SQL})
select batch, count(*) as n_rows,
  to_json({{'dataframe_records': list({{'o_orderkey': o_orderkey, 'o_totalprice': o_totalprice,
                                      'o_orderpriority': o_orderpriority}} order by o_orderkey)}})::varchar as payload
from b group by batch""")
def q_records_payload_nulls(spark, sf_dir):
    m = masked_orders(spark, sf_dir)
    return payloads.records_payload(m, "o_orderkey", ["o_orderkey", "o_totalprice", "o_orderpriority"], 500)


@query("split_payload", """
with b as (select (row_number() over (order by o_orderkey) - 1) // 1000 as batch, * from orders)
select batch, count(*) as n_rows,
  '{"dataframe_split":{"columns":["o_orderkey","o_totalprice","o_orderpriority"],"index":'
  || to_json(list(o_orderkey order by o_orderkey))::varchar || ',"data":['
  || string_agg('[' || to_json(o_orderkey)::varchar || ',' || to_json(o_totalprice)::varchar || ','
                || to_json(o_orderpriority)::varchar || ']', ',' order by o_orderkey) || ']}}' as payload
from b group by batch""")
def q_split_payload(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return payloads.split_payload(o, "o_orderkey", ["o_orderkey", "o_totalprice", "o_orderpriority"], 1000)


# ------------------------------------------------------------------ training, scoring, streaming (rows-only)

ORDER_CAT = ["c_mktsegment", "o_orderpriority"]
ORDER_NUM = ["c_acctbal", "o_totalprice"]
LI_TARGET = "l_extendedprice"
LI_FEATS_CAT = ["l_returnflag", "l_linestatus"]
LI_FEATS_NUM = ["l_quantity", "l_discount", "l_tax"]


def order_features(spark, sf_dir):
    spine = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                                  "o_orderstatus")
    cust = features.FeatureLookup(table(spark, sf_dir, "customer"), ["c_custkey"], ["o_custkey"],
                                  ["c_acctbal", "c_mktsegment"])
    return features.training_set(spine, [cust], label="o_orderstatus")


_FITTED: dict = {}


def _cores(spark) -> int:
    """Tasks that run at once: what a costly model over few files is dealt out to."""
    return spark.sparkContext.defaultParallelism


def _once(spark, sf_dir, kind, fit):
    """A model that several queries of one session share, fitted once per input."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def _classifier(spark, sf_dir):
    return _once(spark, sf_dir, "classifier", lambda: ml.train_classifier(
        order_features(spark, sf_dir), "o_orderstatus", ORDER_CAT, ORDER_NUM,
        estimator=ml.rf_classifier("label_idx", num_trees=100), keys=["o_orderkey"]))


def _share(c: str):
    return F.col(c).between(0, 1).alias(f"{c}_is_share")


@query("train_classifier", """
select cast(sum(t) as bigint) as n, true as accuracy_is_share, true as auc_hard_is_share, true as f1_weighted_is_share
from (select round_even(count(*) * 0.2, 0) as t from orders group by o_orderstatus)""")
def q_train_classifier(spark, sf_dir):
    """Size of the stratified test side, and that the metrics are shares (their values are the model's)."""
    return _classifier(spark, sf_dir)[3].select("n", _share("accuracy"), _share("auc_hard"), _share("f1_weighted"))


@query("feature_importances", """
select feature, true as importance_is_share, true as sum_is_one from (
  select 'c_mktsegment__ohe_' || c_mktsegment as feature from (select distinct c_mktsegment from customer)
  union all select 'o_orderpriority__ohe_' || o_orderpriority from (select distinct o_orderpriority from orders)
  union all select unnest(['c_acctbal__imp', 'o_totalprice__imp']))""")
def q_feature_importances(spark, sf_dir):
    """One row per slot of the vector: the numbers and the known levels, none for unknown ones."""
    imp = ml.feature_importances(_classifier(spark, sf_dir)[0], order_features(spark, sf_dir))
    whole = imp.agg(F.round(F.sum("importance"), 6).alias("s")).select("s").scalar()
    return imp.select("feature", F.col("importance").between(0, 1).alias("importance_is_share"), (whole == 1).alias("sum_is_one"))


@query("search_classifier", """
select t as "numTrees", d as "maxDepth", f as "featureSubsetStrategy", true as f1_is_share
from (values (20), (50), (100)) a(t), (values (3), (5), (7)) b(d), (values ('sqrt'), ('log2')) c(f)""")
def q_search_classifier(spark, sf_dir):
    data, _ = ml.index_label(order_features(spark, sf_dir), "o_orderstatus")
    _, trials = ml.search_classifier(data, "label_idx", ORDER_CAT, ORDER_NUM, ["o_orderkey"], folds=2)
    return trials.select("numTrees", "maxDepth", "featureSubsetStrategy", _share("f1"))


@query("score_proba", """
select o_orderkey, o_orderstatus, true as label_known, true as sum_is_one from orders""")
def q_score_proba(spark, sf_dir):
    data, indexer = ml.index_label(order_features(spark, sf_dir), "o_orderstatus")
    model = ml.build_pipeline(ORDER_CAT, ORDER_NUM, ml.tree_classifier("label_idx")).fit(ml.stable_input(data, ["o_orderkey"]))
    out = scoring.score_proba(data, model, indexer.labels, keep=["o_orderkey", "o_orderstatus"])
    total = sum((F.col(f"prob_{lab}") for lab in indexer.labels), F.lit(0.0))
    return out.select("o_orderkey", "o_orderstatus", F.col("prediction").isin(*indexer.labels).alias("label_known"),
                      (F.round(total, 6) == 1).alias("sum_is_one"))


@query("score_batch", "select o_orderkey, true as label_known from orders")
def q_score_batch(spark, sf_dir):
    model, indexer = _classifier(spark, sf_dir)[:2]
    spine = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    cust = features.FeatureLookup(table(spark, sf_dir, "customer"), ["c_custkey"], ["o_custkey"],
                                  ["c_acctbal", "c_mktsegment"])
    out = scoring.score_batch(spine, [cust], model, keep=["o_orderkey"])
    return out.select("o_orderkey", F.col("prediction").isin(*range(len(indexer.labels))).alias("label_known"))


def _regressor(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return _once(spark, sf_dir, "regressor", lambda: ml.train_run(
        li, LI_TARGET, LI_FEATS_CAT, LI_FEATS_NUM, ["l_orderkey", "l_linenumber"], "lineitem-run", num_trees=500, max_depth=5))


@query("train_run", f"""
select 'lineitem-run' as run_id, count(*) as n_rows, count(*) filter (where {hash_sql(['l_orderkey', 'l_linenumber'])} >= 0.2) as n_train,
  count(*) filter (where {hash_sql(['l_orderkey', 'l_linenumber'])} < 0.2) as n_test, true as r2_is_bounded, true as best_is_this from lineitem""")
def q_train_run(spark, sf_dir):
    """The monthly training job; its record is also written to a runs table
    and the best run read back from there."""
    model, profile, record = _regressor(spark, sf_dir)
    record = ranking_materialize(record)
    runs_path = scratch_path(spark, "runs")
    ml.run_metrics(record, "lineitem-price").write.mode("append").parquet(runs_path)
    best = runs.best_run(spark.read.parquet(runs_path), "r2_test")
    both = record.join(best.select("run_id", F.col("value").alias("best_r2")), "run_id", "left")
    return written_out(both.select("run_id", "n_rows", "n_train", "n_test", (F.col("r2_test") <= 1).alias("r2_is_bounded"),
                                   (F.col("best_r2") == F.col("r2_test")).alias("best_is_this")), runs_path)


# The schema that the regressor was registered with, written out: a test against
# the table's own schema could not fail.
_SERVED = T.StructType([T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
                        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType())])


@query("validate_model", """
select true as schema_ok, count(*) as n_rows, 0::bigint as n_null, 0::bigint as n_nan, 0::bigint as n_not_castable,
  true as between_the_targets, true as passed from lineitem""")
def q_validate_model(spark, sf_dir):
    """The model's test as it should pass: the served inputs, a double prediction. A forest's
    predictions are means of targets, so they lie between the smallest and the largest one."""
    model = _regressor(spark, sf_dir)[0]
    li = table(spark, sf_dir, "lineitem")
    done = scoring.validate_model(li.select(*LI_FEATS_CAT, *LI_FEATS_NUM), model, _SERVED, T.DoubleType(), partitions=_cores(spark))
    low, high = (li.agg(f(LI_TARGET).alias("v")).select("v").scalar() for f in (F.min, F.max))
    between = (F.col("min_prediction") >= low) & (F.col("max_prediction") <= high) & (F.col("min_prediction") < F.col("max_prediction"))
    return done.select("schema_ok", "n_rows", "n_null", "n_nan", "n_not_castable", between.alias("between_the_targets"), "passed")


@query("validate_model_fails", """
select 'extra column' as case_name, false as schema_ok, null::bigint as n_rows, false as passed
union all select 'missing column', false, null, false
union all select 'not whole numbers', true, count(*), false from lineitem""")
def q_validate_model_fails(spark, sf_dir):
    """The same test on a table with one column more, on one with one less, and for an integer signature."""
    model = _regressor(spark, sf_dir)[0]
    li = table(spark, sf_dir, "lineitem")
    good = li.select(*LI_FEATS_CAT, *LI_FEATS_NUM)
    cases = {"extra column": (li.select(*LI_FEATS_CAT, *LI_FEATS_NUM, "l_linenumber"), T.DoubleType()),
             "missing column": (good.drop("l_tax"), T.DoubleType()), "not whole numbers": (good, T.IntegerType())}
    out = None
    for name, (df, kind) in cases.items():
        row = scoring.validate_model(df, model, _SERVED, kind, partitions=_cores(spark)).select(F.lit(name).alias("case_name"), "schema_ok", "n_rows", "passed")
        out = row if out is None else out.unionAll(row)
    return out


@query("stream_score", "select l_orderkey, l_linenumber, l_extendedprice, true as scored from lineitem")
def q_stream_score(spark, sf_dir):
    model = _regressor(spark, sf_dir)[0]
    li = table(spark, sf_dir, "lineitem")
    src = streams.read_stream(spark, f"{sf_dir}/lineitem*.parquet", li.schema, max_files_per_trigger=1,
                              drop=["l_partkey", "l_suppkey"])
    scored = scoring.score(src, model, keep=["l_orderkey", "l_linenumber", LI_TARGET], partitions=_cores(spark))
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    streams.run_to_end(streams.write_stream(scored, out, ckpt, name=None))
    scored = spark.read.parquet(out).select("l_orderkey", "l_linenumber", LI_TARGET, F.col("prediction").isNotNull().alias("scored"))
    return written_out(scored, out, ckpt)


# ------------------------------------------------------------------ more operators

_AUTO_NUM = ["o_orderkey", "o_custkey", "o_totalprice"]


@query("profile_auto", f"""
select feature, statistic, value, null::varchar as text from {S.numeric_profile('orders', _AUTO_NUM)}
union all select * from {_cat_profile_sql('orders', O_CAT)}""")
def q_profile_auto(spark, sf_dir):
    p = stats.profile(table(spark, sf_dir, "orders"))  # column roles from the schema
    return p.withColumn("value", r4(F.col("value")))


@query("write_features", """
select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer where c_mktsegment <> 'BUILDING'
union all select c_custkey, c_name, c_nationkey, c_acctbal + 100, c_mktsegment from customer
where c_mktsegment = 'BUILDING'""")
def q_write_features(spark, sf_dir):
    cur = table(spark, sf_dir, "customer")
    v1, v2 = scratch_path(spark, "customer-features-v1"), scratch_path(spark, "customer-features-v2")
    features.write_features(cur, v1, ["c_custkey"])
    upd = cur.where(F.col("c_mktsegment") == "BUILDING").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    features.write_features(upd, v2, ["c_custkey"], mode="merge", current_path=v1)
    return written_out(spark.read.parquet(v2), v1, v2)


@query("ks_one_sided", _KS_CORE_SQL + """,
h as (select *, sqrt(n_ref * n_new / (n_ref + n_new)::double) as se, greatest(n_ref, n_new)::double as mm,
        least(n_ref, n_new)::double as nn from dd)
select feature, round(d_plus, 6) as d_plus, round(d_minus, 6) as d_minus,
  round(least(1.0, exp(-2 * (se * d_plus) ^ 2 - 2 * (se * d_plus) * (mm + 2 * nn) / sqrt(mm * nn * (mm + nn)) / 3)), 6) as p_greater,
  round(least(1.0, exp(-2 * (se * d_minus) ^ 2 - 2 * (se * d_minus) * (mm + 2 * nn) / sqrt(mm * nn * (mm + nn)) / 3)), 6) as p_less
from h""")
def q_ks_one_sided(spark, sf_dir):
    ref, new = li_periods(spark, sf_dir)
    summary = drift.side_summary(drift.side_counts(ref, new, LI_NUM))  # shared by both alternatives
    g = drift.ks_from(summary, LI_NUM, 0.05, "greater").select("feature", F.col("statistic").alias("d_plus"),
                                                                F.col("p_value").alias("p_greater"))
    le = drift.ks_from(summary, LI_NUM, 0.05, "less").select("feature", F.col("statistic").alias("d_minus"),
                                                            F.col("p_value").alias("p_less"))
    j = g.join(le, "feature")
    return j.select("feature", *[F.round(c, 6).alias(c) for c in ("d_plus", "d_minus", "p_greater", "p_less")])


@query("roc_auc", """
with d as (select l.quality as y, d.n_chars::double as s from labels l join documents d on l.doc_id = d.doc_id),
r as (select y, rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 as rk from d),
c as (select count(*) filter (where y = 1) as p, count(*) filter (where y <> 1) as n,
        sum(case when y = 1 then rk else 0 end) as sr from r)
select p as n_pos, n as n_neg, round((sr - p * (p + 1) / 2.0) / (p * n), 6) as auc from c""")
def q_roc_auc(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    m = metrics.roc_auc(lab.join(docs, "doc_id"), "quality", "n_chars")
    return m.withColumn("auc", F.round("auc", 6))


_REPORT_SQL = f"""select * from ({ORACLE['levene_drift']}) union all select * replace (round(statistic, 4) as statistic, round(p_value, 4) as p_value) from ({ORACLE['ks_drift']})
union all select * from ({ORACLE['chi2_homogeneity']})"""


@query("drift_report", _REPORT_SQL)
def q_drift_report(spark, sf_dir):
    """The monthly check end to end on two years of lineitem: Levene and KS
    share one scan of each period; chi-square on the flags."""
    ref, new = li_periods(spark, sf_dir)
    res = drift.drift_report(ref, new, LI_NUM, LI_CAT, 0.05, ks_law="limit")
    return res.withColumn("statistic", r4(F.col("statistic"))).withColumn("p_value", r4(F.col("p_value")))


@query("period_report", f"""
select 'nulls' as "check", feature, 'null_fraction' as statistic, round(avg((v is null)::int), 4) as value,
  null::double as p_value, 0.5::double as threshold, avg((v is null)::int) >= 0.5 as flagged
from ({S.melt('(' + LI_NEW_SQL + ')', LI_NUM + LI_CAT, 'varchar')}) group by feature
union all select 'summary', feature, statistic, new_value, null, {_DRIFT_LIMIT}, true from ({ORACLE['summary_drift']})
union all select test, feature, 'statistic', statistic, p_value, alpha, drifted from ({_REPORT_SQL})""")
def q_period_report(spark, sf_dir):
    """Every check of a monthly run (nulls, summary statistics, Levene, KS,
    chi-square) on two years of lineitem, as one long report."""
    ref, new = li_periods(spark, sf_dir)
    report = monitoring.period_report(ref, new, LI_NUM, LI_CAT, null_threshold=0.5, stats_limit=_DRIFT_LIMIT, ks_law="limit")
    return report.withColumn("value", r4(F.col("value"))).withColumn("p_value", r4(F.col("p_value")))


# ------------------------------------------------------------------ trees that SQL can follow

TREE_NUM = ["l_quantity", "l_discount", "l_tax"]
LI_KEYS = ["l_orderkey", "l_linenumber"]
KEPT = "l_quantity * (1 - l_discount)"
_FIT_SQL = f"{hash_sql(LI_KEYS)} >= 0.2"


def tree_table(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LI_KEYS, *TREE_NUM, F.expr(KEPT).alias("kept"), F.year("l_shipdate").alias("y"))


def _tree_run(spark, sf_dir):
    """A published run with a tree of depth 2 on the train rows, and its version in production: (store, events)."""
    def fit():
        store, events = scratch_path(spark, "runs"), scratch_path(spark, "stages")
        ml.train_run(tree_table(spark, sf_dir), "kept", [], TREE_NUM, LI_KEYS, "tree-1", estimator=ml.tree_regressor("kept", max_depth=2),
                     store=store, experiment="kept", data_path=f"{sf_dir}/lineitem.parquet", data_version=1, period="all")
        registry.register(spark, store, events, "kept", "tree-1", "Production")
        return store, events
    return _once(spark, sf_dir, "tree", fit)


_TREE_SQL = S.regression_tree("lineitem", TREE_NUM, KEPT, _FIT_SQL, 2)
_R2_SQL = "(select 1 - sum((_y - prediction) ^ 2) / (sum(_y * _y) - sum(_y) ^ 2 / count(*)) from {p}_out where not _fit)"


@query("score_stage", f"with {_TREE_SQL} select l_orderkey, l_linenumber, round(prediction, 6) as prediction from t_out")
def q_score_stage(spark, sf_dir):
    """Load the model in production from its folder and score the whole table; SQL grows the same tree."""
    model = registry.load_stage(spark, *_tree_run(spark, sf_dir), "kept")
    scored = model.score(table(spark, sf_dir, "lineitem"), keep=LI_KEYS)
    return scored.withColumn("prediction", F.round("prediction", 6))


@query("tree_importances", f"""
with {_TREE_SQL}
select f.feature || '__imp' as feature, round(coalesce(sum(gain), 0) / (select sum(gain) from t_gain), 6) as importance
from (select unnest({TREE_NUM!r}) as feature) f left join t_gain using (feature) group by f.feature""")
def q_tree_importances(spark, sf_dir):
    """Share of the variance that each feature's splits take away."""
    model = registry.load_stage(spark, *_tree_run(spark, sf_dir), "kept")
    imp = ml.feature_importances(model.pipeline, tree_table(spark, sf_dir))
    return imp.select("feature", F.round("importance", 6).alias("importance"))


@query("run_record", f"""
with {_TREE_SQL}
select 'kept' as experiment, 'tree-1' as run_id, 1::bigint as data_version, count(*) as n_rows, count(*) filter (where _fit) as n_train,
  count(*) filter (where not _fit) as n_test, round(avg(abs(_y - prediction)) filter (where not _fit), 6) as mae,
  round({_R2_SQL.format(p="t")}, 6) as r2_test, 'double' as output, 'DecisionTreeRegressor' as estimator, 30 as n_statistics from t_out""")
def q_run_record(spark, sf_dir):
    """What the published run stored: its data's version, counts, metrics, signature and statistics."""
    store = _tree_run(spark, sf_dir)[0]
    m, profile = F.col("metrics"), registry.run_profile(spark, store, "tree-1").where(F.col("feature") != "kept")
    return registry.published_runs(spark, store).select(
        "experiment", "run_id", "data_version", "n_rows", "n_train", "n_test", F.round(m["mae"], 6).alias("mae"), F.round(m["r2_test"], 6).alias("r2_test"),
        F.get_json_object("signature", "$.output").alias("output"), F.get_json_object("parameters", "$.estimator").alias("estimator"),
        profile.agg(F.count(F.lit(1)).cast("int").alias("n")).select("n").scalar().alias("n_statistics"))


@query("forest_accuracy", f"""
with d as (select case when {KEPT} > 22 then 'large' else 'small' end as size from lineitem),
t as (select size, round_even(count(*) * 0.2, 0) as n from d group by size)
select cast(sum(n) as bigint) as n, round(max(n) / sum(n), 6) as majority_share, true as beats_majority, true as f1_above_nine_tenths from t""")
def q_forest_accuracy(spark, sf_dir):
    """A forest on a label that depends on its features must do better than the largest class."""
    size = F.when(F.col("kept") > 22, "large").otherwise("small")
    data = tree_table(spark, sf_dir).select(*LI_KEYS, *TREE_NUM, size.alias("size"))
    _, _, predicted, row = ml.train_classifier(data, "size", [], TREE_NUM, ml.rf_classifier("label_idx", num_trees=20, max_depth=6),
                                                keys=[*LI_KEYS, *TREE_NUM])  # lines repeat their numbers
    share = predicted.groupBy("size").count().agg((F.max("count") / F.sum("count")).alias("s")).select("s").scalar()
    return row.select("n", F.round(share, 6).alias("majority_share"), (F.col("accuracy") > share + 0.1).alias("beats_majority"),
                      (F.col("f1_weighted") > 0.9).alias("f1_above_nine_tenths"))


class _Softmax:
    """A fixed linear model with probabilities and a label (it stands for any Python library's)."""

    WEIGHTS = {"high": (0.8, -0.5, 0.1), "mid": (0.0, 0.0, 0.6), "low": (-0.7, 0.4, 0.2)}

    def predict(self, frame):
        import numpy as np
        import pandas as pd
        x = np.stack([frame["o_totalprice"].to_numpy() / 250000.0 - 1.0, frame["c_acctbal"].to_numpy() / 5000.0 - 1.0, np.ones(len(frame))], axis=1)
        z = x @ np.array(list(self.WEIGHTS.values())).T
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        out = pd.DataFrame(p, columns=[f"prob_{k}" for k in self.WEIGHTS], index=frame.index)
        out["label"] = np.array(list(self.WEIGHTS))[p.argmax(axis=1)]
        return out


@query("score_python_struct", f"""
with x as (select o_orderkey, o_totalprice / 250000.0 - 1.0 as a, c_acctbal / 5000.0 - 1.0 as b from orders join customer on o_custkey = c_custkey),
z as (select o_orderkey, {", ".join(f"exp({w[0]} * a + {w[1]} * b + {w[2]}) as {k}" for k, w in _Softmax.WEIGHTS.items())} from x)
select o_orderkey, {", ".join(f"round({k} / (high + mid + low), 6) as prob_{k}" for k in _Softmax.WEIGHTS)},
  case when high >= mid and high >= low then 'high' when mid >= low then 'mid' else 'low' end as label from z""")
def q_score_python_struct(spark, sf_dir):
    """A Python model with several outputs over the looked-up features of every order."""
    outputs = T.StructType([T.StructField(f"prob_{k}", T.DoubleType()) for k in _Softmax.WEIGHTS] + [T.StructField("label", T.StringType())])
    data = order_features(spark, sf_dir).where(F.col("c_acctbal").isNotNull()).select("o_orderkey", "o_totalprice", "c_acctbal")
    out = scoring.score_with_python_struct(data, _Softmax, ["o_totalprice", "c_acctbal"], outputs, keep=["o_orderkey"])
    return out.select("o_orderkey", *[F.round(f"prob_{k}", 6).alias(f"prob_{k}") for k in _Softmax.WEIGHTS], "label")


_LOOP_SQL = {side: S.numeric_profile_raw(f"(select * from lineitem where year(l_shipdate) {cond})", ["l_quantity"])
             for side, cond in (("sr", f"< {YEARS[-1]}"), ("sn", f">= {YEARS[-1]}"))}
_LOOP_TREES = (S.regression_tree(f"(select * from lineitem where year(l_shipdate) < {YEARS[-1]})", TREE_NUM, KEPT, _FIT_SQL, 1, "p") + ",\n"
               + S.regression_tree("lineitem", TREE_NUM, KEPT, _FIT_SQL, 2, "g"))


@query("monthly_loop", f"""
with {_LOOP_TREES},
sr as {_LOOP_SQL['sr']}, sn as {_LOOP_SQL['sn']},
n as (select count(*) as n_data from lineitem where year(l_shipdate) < {YEARS[-1]}),
j as (select sr.statistic, round(sr.value, 4) as prod_value, round(sn.value, 4) as new_value,
        sn.value < sr.value * 0.999 or sn.value > sr.value * 1.001 as moved from sr join sn using (statistic)),
r as (select {_R2_SQL.format(p="p")} as p, {_R2_SQL.format(p="g")} as g),
v as (select round(p, 6) as production_r2, round(g, 6) as staging_r2,
        case when p <= 0 then 'INVALID' when round((g / p - 1) * 100, 2) < 0 then 'ALERT' when g / p - 1 >= 0.05 then 'PROCEED' else 'CAUTION' end as verdict from r)
select 'run-6' as run_id, 6::bigint as data_version, n_data, statistic, prod_value, new_value, moved, production_r2, staging_r2, verdict,
  case when verdict = 'PROCEED' then 2 else 1 end as in_production from j, n, v""")
def q_monthly_loop(spark, sf_dir):
    """One month: the production version leads to its run, the run to the data as of its version
    and to its statistics; the new period is compared with them, a new run is trained and staged,
    and takes over if its held-out metric beats that of the run in production."""
    data, store, events = (scratch_path(spark, f"loop-{n}") for n in ("data", "store", "events"))
    li, year = table(spark, sf_dir, "lineitem").select(*LI_KEYS, *TREE_NUM, F.expr(KEPT).alias("kept"), "l_shipdate"), F.year("l_shipdate")
    last = len(YEARS)

    def append(v):
        y = YEARS[v - 1]
        io.append_period(li.where((year <= y) if v == 1 else (year >= y) if v == last else year == y).drop("l_shipdate"), data, "period", f"y{y}", version=v)

    def train(v, depth, stage):
        rows = io.read_as_of(spark.read.parquet(data), v, "period")
        ml.train_run(rows, "kept", [], TREE_NUM, LI_KEYS, f"run-{v}", estimator=ml.tree_regressor("kept", max_depth=depth), store=store,
                     experiment="kept", data_path=data, data_version=v, period=f"y{YEARS[v - 1]}")
        return registry.register(spark, store, events, "kept", f"run-{v}", stage)

    for v in range(1, last):
        append(v)
    train(last - 1, 1, "Production")
    append(last)  # the new month
    run, before, stored = monitoring.baseline_of(spark, store, events, "kept", "period")
    new = stats.summary_stats(spark.read.parquet(data).where(F.col(io.VERSION_COL) == last), ["l_quantity"])
    moved = drift.summary_drift(new, stored, ["l_quantity"], 0.001)
    version = train(last, 2, "Staging")
    gate = ranking_materialize(registry.gate(spark, store, events, "kept", "r2_test", 0.05))
    monitoring.promote_if(gate, events, "kept", version, run_id=f"run-{last}")
    held = runs.model_in_stage(registry.stage_log(spark, events), "Production").select("version").scalar()
    both = stored.select("feature", "statistic", F.col("value").alias("prod_value")).join(
        new.select("feature", "statistic", F.col("value").alias("new_value")), ["feature", "statistic"])
    result = (both.where(F.col("statistic").isin(*drift.DRIFT_STATISTICS)).join(moved.select("statistic", F.lit(True).alias("moved")), "statistic", "left")
              .select(F.lit(run["run_id"]).alias("run_id"), F.lit(run["data_version"]).cast("long").alias("data_version"),
                      before.agg(F.count(F.lit(1)).alias("n")).select("n").scalar().alias("n_data"),
                      "statistic", r4(F.col("prod_value")).alias("prod_value"), r4(F.col("new_value")).alias("new_value"),
                      F.coalesce("moved", F.lit(False)).alias("moved"), gate.select(F.round("production", 6)).scalar().alias("production_r2"),
                      gate.select(F.round("staging", 6)).scalar().alias("staging_r2"), gate.select("verdict").scalar().alias("verdict"), held.alias("in_production")))
    return written_out(result, data, store, events)


@query("stream_events", """
select event_id, user_id, event_type, value, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def q_stream_events(spark, sf_dir):
    """The event table as a stream: fixed schema, rate-limited file source,
    JSON fields parsed per micro-batch, Parquet sink with a checkpoint; the
    sink is read back as a table."""
    ev = table(spark, sf_dir, "events")
    src = streams.read_stream(spark, f"{sf_dir}/events*.parquet", ev.schema, max_files_per_trigger=1, drop=["ts"])
    parsed = C.parse_json_fields(src, "props", {"k": "bigint"}).drop("props")
    out, ckpt = scratch_path(spark, "events-out"), scratch_path(spark, "events-ckpt")
    streams.run_to_end(streams.write_stream(parsed, out, ckpt, name=None))
    return written_out(spark.read.parquet(out), out, ckpt)


# ------------------------------------------------------------------ named feature tables, versions, progress, search

def _database(spark) -> str:
    """A database of this call's own, in the shared folder."""
    location = scratch_path(spark, "warehouse")
    name = "tidemark_" + location[-12:]
    io.ensure_database(spark, name, location=location)
    return name


@query("feature_table", """
with f as (select c_custkey, case when c_mktsegment = 'BUILDING' then c_acctbal + 100 else c_acctbal end as c_acctbal, c_mktsegment from customer)
select o_orderkey, o_custkey, round(c_acctbal, 2) as c_acctbal, c_mktsegment, o_orderstatus, 'c_custkey' as primary_key, 'Customer''s balance' as description,
  2 as snapshot from orders left join f on o_custkey = c_custkey""")
def q_feature_table(spark, sf_dir):
    """A feature table by name: created with key and description, updated by key, looked up from its name alone."""
    db = _database(spark)
    name = f"{db}.customer_features"
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    features.create_features(cust, name, ["c_custkey"], "Customer's balance")
    features.update_features(cust.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100), name)
    spine = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    rows = features.training_set(spine, [features.FeatureLookup(name, lookup_key=["o_custkey"])], label="o_orderstatus")
    about = ranking_materialize(features.describe_features(spark, name))
    out = written_out(rows.withColumn("c_acctbal", F.round("c_acctbal", 2)).select(
        "*", about.select(F.concat_ws(",", "primary_key")).scalar().alias("primary_key"), about.select("description").scalar().alias("description"),
        about.select("snapshot").scalar().alias("snapshot")))
    spark.sql(f"drop database {db} cascade")
    return out


@query("stored_versions", f"""
select v as version, v = max(v) over () as latest from (select distinct ingest_version as v from {_VERSIONED_SQL})""")
def q_stored_versions(spark, sf_dir):
    """Versions of a written table from the catalog's partitions, and the same from its files' names."""
    db = _database(spark)
    name = f"{db}.orders"
    io.save_table(_versioned_orders(spark, sf_dir), name, partition_by=[io.VERSION_COL])
    listed = io.table_versions(spark, name)
    place = spark.sql(f"describe formatted {name}").where("col_name = 'Location'").first()["data_type"]
    named = io.path_versions(spark, place)
    out = written_out(listed.join(named, "version").select("version", (F.col("version") == listed.agg(F.max("version")).scalar()).alias("latest")))
    spark.sql(f"drop database {db} cascade")
    return out


@query("exact_stats", """
with x as (select 4611686018427387904 + o_orderkey as v from orders),
r as (select v, row_number() over (order by v) - 1 as k, count(*) over () as n from x),
q as (select s, p, (max(n) - 1) * p as h, max(case when k = floor((n - 1) * p) then v end) as lo, max(case when k = ceil((n - 1) * p) then v end) as hi
      from r, (values ('min', 0.0), ('25%', 0.25), ('50%', 0.5), ('75%', 0.75), ('median', 0.5), ('max', 1.0)) t(s, p) group by s, p)
select s as statistic, case when lo = hi or h = floor(h) then lo::varchar
  else regexp_replace((lo::decimal(38,2) + ((hi - lo)::decimal(18,2) * (h - floor(h))::decimal(3,2))::decimal(38,2))::varchar, '\\.?0+$', '') end as exact from q""")
def q_exact_stats(spark, sf_dir):
    """A profile of whole numbers above 2**53, digit by digit."""
    big = table(spark, sf_dir, "orders").select((F.lit(4611686018427387904) + F.col("o_orderkey")).alias("v"))
    return stats.summary_stats(big, ["v"], exact=True).where(F.col("exact").isNotNull()).select("statistic", "exact")


def _dealt(spark, frames, path):
    """One file per frame, in order."""
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(path)


@query("stream_progress", f"""
select case when y < 1999 then 1 else 2 end as run, (y - {YEARS[0]})::bigint as batch, count(*) as n_rows
from (select least(greatest(year(o_orderdate), {YEARS[0]}), {YEARS[-1]}) as y from orders) group by y""")
def q_stream_progress(spark, sf_dir):
    """Seven files, one per micro-batch: a stream reads four, stops, and goes on with the rest after a restart."""
    src, out, ckpt = (scratch_path(spark, f"progress-{n}") for n in ("src", "out", "ckpt"))
    years, progress = list(order_years(spark, sf_dir).values()), streams.Progress(spark)
    parts = []
    for run, some in ((1, years[:4]), (2, years[4:])):
        _dealt(spark, some, src)
        s = streams.read_stream(spark, src, years[0].schema, max_files_per_trigger=1)
        q = streams.run_to_end(streams.write_stream(s, out, ckpt, name=f"progress-{run}"), progress=progress)
        parts.append((run, str(q.runId)))
    number = F.when(F.col("run_id") == parts[0][1], parts[0][0]).otherwise(parts[1][0])
    return written_out(progress.table().select(number.alias("run"), "batch", "n_rows"), src, out, ckpt)


@query("stream_stage", f"with {_TREE_SQL} select l_orderkey, l_linenumber, round(prediction, 6) as prediction from t_out")
def q_stream_stage(spark, sf_dir):
    """The stored model of the production stage over a stream of many files, two per micro-batch."""
    src, out, ckpt = (scratch_path(spark, f"stage-{n}") for n in ("src", "out", "ckpt"))
    li = table(spark, sf_dir, "lineitem").select(*LI_KEYS, *TREE_NUM)
    li.repartition(6).write.parquet(src)
    model = registry.load_stage(spark, *_tree_run(spark, sf_dir), "kept")
    s = model.score(streams.read_stream(spark, src, li.schema, max_files_per_trigger=2), keep=LI_KEYS)
    streams.run_to_end(streams.write_stream(s, out, ckpt))
    return written_out(spark.read.parquet(out).withColumn("prediction", F.round("prediction", 6)), src, out, ckpt)


@query("search_models", f"""
with d as (select ({hash_sql(LI_KEYS)} - 0.2) / 0.8 as u from lineitem)
select rung, n_settings, n_kept, (select count(*) from d where u >= 0 and u < part) as n_rows, true as best_above_nine_tenths
from (values (0, 12::bigint, 6::bigint, 0.25), (1, 6, 3, 0.5), (2, 3, 2, 1.0)) r(rung, n_settings, n_kept, part)""")
def q_search_models(spark, sf_dir):
    """Successive halving over three families: rows and settings of each rung, and that the best one learned."""
    data = tree_table(spark, sf_dir).select(*LI_KEYS, *TREE_NUM, (F.col("kept") > 22).cast("double").alias("large"))
    _, trials = ml.search_models(data, "large", [], TREE_NUM, LI_KEYS)
    return trials.groupBy("rung").agg(F.count(F.lit(1)).alias("n_settings"), F.count_if("kept").alias("n_kept"), F.first("n_rows").alias("n_rows"),
                                      (F.max("f1") > 0.9).alias("best_above_nine_tenths"))


# ------------------------------------------------------------------ values of learned models, previews, inferred schemas

_KEYS_SOURCE = "(select o_orderkey, c_nationkey, o_orderpriority, c_nationkey * 100 + case when o_orderpriority = '1-URGENT' then 40 else 0 end as cost from orders join customer on o_custkey = c_custkey)"


@query("score_keys", f"""
with {S.regression_tree(_KEYS_SOURCE, ["c_nationkey"], "cost", f"{hash_sql(['o_orderkey'])} >= 0.2", 3)}
select o_orderkey, round(prediction, 6) as prediction from t_out""")
def q_score_keys(spark, sf_dir):
    """Score orders from their keys: the model's feature is looked up in the customer table; values against SQL's own tree."""
    cust = features.FeatureLookup(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("c_nationkey")), ["c_custkey"], ["o_custkey"])
    spine = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cost = F.col("c_nationkey") * 100 + F.when(F.col("o_orderpriority") == "1-URGENT", 40).otherwise(0)
    data = features.training_set(spine, [cust]).where(F.col("c_nationkey").isNotNull()).withColumn("cost", cost.cast("double"))
    split = ml.stable_input(splits.hash_split(data, ["o_orderkey"], 0.2, 42), ["o_orderkey"])
    model = ml.build_pipeline([], ["c_nationkey"], ml.tree_regressor("cost", max_depth=3)).fit(split.where("split = 'train'"))
    known = spine.join(data.select("o_orderkey"), "o_orderkey", "left_semi")
    return scoring.score_batch(known, [cust], model, keep=["o_orderkey"]).withColumn("prediction", F.round("prediction", 6))


# For two classes the split that lowers the Gini impurity most is the one that lowers the variance of the 0/1 label
# most. Two leaves of one node that name the same class are one leaf.
@query("tree_proba", f"""
with {S.regression_tree("lineitem", TREE_NUM, f"({KEPT} > 22)::int", _FIT_SQL, 2)},
up as (select node // 2 as node, avg(_y) as mean from t_r2 where _fit group by node // 2),
one as (select node // 2 as node, count(distinct prediction > 0.5) = 1 as merged from t_leaf group by node // 2),
p as (select l_orderkey, l_linenumber, case when merged then mean else prediction end as p from t_out o join up on up.node = o.node // 2 join one on one.node = o.node // 2)
select l_orderkey, l_linenumber, round(1 - p, 6) as prob_no, round(p, 6) as prob_yes, case when p > 0.5 then 'yes' else 'no' end as prediction from p""")
def q_tree_proba(spark, sf_dir):
    """Class probabilities and label of a classification tree for every row, value by value."""
    data = tree_table(spark, sf_dir).withColumn("large", F.when(F.col("kept") > 22, "yes").otherwise("no"))
    indexed, indexer = ml.index_label(data, "large")
    split = ml.stable_input(splits.hash_split(indexed, LI_KEYS, 0.2, 42), LI_KEYS)
    tree = ml.tree_classifier("label_idx", max_depth=2).setMaxBins(64)
    model = ml.build_pipeline([], TREE_NUM, tree).fit(split.where("split = 'train'"))
    out = scoring.score_proba(indexed, model, indexer.labels, keep=LI_KEYS)
    return out.select(*LI_KEYS, F.round("prob_no", 6).alias("prob_no"), F.round("prob_yes", 6).alias("prob_yes"), "prediction")


@query("forest_regression", f"""
select count(*) as n_rows, count(*) filter (where not {_FIT_SQL}) as n_test, true as explains_nine_tenths, true as better_than_the_mean from lineitem""")
def q_forest_regression(spark, sf_dir):
    """A regression forest on a target that follows from its features: most of the variance, and errors far below those of the mean."""
    data = tree_table(spark, sf_dir)
    _, _, record = ml.train_run(data, "kept", [], TREE_NUM, LI_KEYS, "forest", num_trees=50, max_depth=6)
    spread = data.agg(F.stddev_pop("kept").alias("s")).select("s").scalar()
    return record.select("n_rows", "n_test", (F.col("r2_test") > 0.9).alias("explains_nine_tenths"), (F.col("rmse") < spread / 3).alias("better_than_the_mean"))


@query("read_csv_inferred", "select c_custkey, c_name, c_nationkey, round(c_acctbal, 2) as c_acctbal, c_mktsegment, 'bigint,string,bigint,double,string' as types from customer")
def q_read_csv_inferred(spark, sf_dir):
    """A CSV file with a header whose column types Spark infers."""
    path = scratch_path(spark, "csv")
    io.write_csv(table(spark, sf_dir, "customer"), path)
    df = io.read_csv(spark, path)
    kinds = ["bigint" if t == "int" else t for _, t in df.dtypes]  # whole numbers by the size that the file needs
    out = df.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("long").alias("c_nationkey"),
                    F.round("c_acctbal", 2).alias("c_acctbal"), "c_mktsegment", F.lit(",".join(kinds)).alias("types"))
    return written_out(out, path)


@query("stream_preview", """
select event_type, count(*) as n, round(sum(value), 4) as total, true as listed, true as stopped from events group by event_type""")
def q_stream_preview(spark, sf_dir):
    """A running total by event type kept in memory, awaited, listed, read as a table and stopped by name."""
    name = "tidemark_preview_" + scratch_path(spark, "p")[-12:]
    ev = table(spark, sf_dir, "events")
    src = streams.read_stream(spark, f"{sf_dir}/events*.parquet", ev.schema, drop=["props"])
    q = streams.preview_stream(src.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")), name, mode="complete")
    found = streams.await_stream(spark, name, timeout=60, poll=0.2)
    q.processAllAvailable()
    listed = streams.list_streams(spark).where(F.col("name") == name).count() == 1 and found is not None
    rows = ranking_materialize(spark.table(name))
    stopped = streams.stop_stream(spark, name) and streams.find_stream(spark, name) is None
    spark.catalog.dropTempView(name)
    return rows.select("event_type", "n", "total", F.lit(listed).alias("listed"), F.lit(stopped).alias("stopped"))
