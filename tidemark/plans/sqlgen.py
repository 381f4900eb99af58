"""Small builders for the DuckDB oracle SQL of the catalog queries (the
independent check of each Spark plan). Only used to write reference SQL."""

from __future__ import annotations

from collections.abc import Sequence


def ts(value: str) -> str:
    return f"TIMESTAMP '{value}'"


def period(table: str, column: str, lo: str, hi: str) -> str:
    return f"select * from {table} where {column} >= {ts(lo)} and {column} < {ts(hi)}"


def melt(source: str, columns: Sequence[str], cast: str = "double", extra: str = "") -> str:
    parts = [f"select '{c}' as feature, cast({c} as {cast}) as v{extra} from {source}" for c in columns]
    return "\n union all ".join(parts)


def numeric_profile(source: str, columns: Sequence[str], digits: int = 4) -> str:
    """(feature, statistic, value) like ``stats.summary_stats`` over a CTE name."""
    m = melt(source, columns)
    r = lambda e: f"round({e}, {digits})"
    stats = [("count", "count(v)::double"), ("mean", "avg(v)"), ("std", "stddev_samp(v)"),
             ("min", "min(v)"), ("25%", "quantile_cont(v, 0.25)"), ("50%", "quantile_cont(v, 0.5)"),
             ("75%", "quantile_cont(v, 0.75)"), ("max", "max(v)"), ("median", "quantile_cont(v, 0.5)"),
             ("null_count", "(count(*) - count(v))::double")]
    sel = "\n union all ".join(
        f"select feature, '{name}' as statistic, {r(expr)} as value from long_ group by feature"
        for name, expr in stats)
    return f"(with long_ as ({m}) {sel})"


def numeric_profile_raw(source: str, columns: Sequence[str]) -> str:
    m = melt(source, columns)
    stats = [("mean", "avg(v)"), ("std", "stddev_samp(v)"), ("min", "min(v)"), ("max", "max(v)"),
             ("median", "quantile_cont(v, 0.5)")]
    sel = "\n union all ".join(
        f"select feature, '{name}' as statistic, {expr} as value from long_ group by feature"
        for name, expr in stats)
    return f"(with long_ as ({m}) {sel})"


def regression_tree(source: str, features: Sequence[str], target: str, train: str, depth: int, prefix: str = "t", needs: Sequence[str] = ()) -> str:
    """CTEs of a regression tree grown to ``depth`` on the rows of ``source`` where ``train`` holds: at each
    node the split (feature, midpoint of two neighbouring values) that lowers the variance most.
    ``{prefix}_out`` is the source with ``node`` and ``prediction``, ``{prefix}_gain`` one row per split:
    feature, gain (rows of the node times the variance taken away). ``needs`` are CTEs that go first."""
    ctes = [*needs, f"{prefix}_r0 as (select *, 1::bigint as node, ({target})::double as _y, ({train}) as _fit from {source})"]
    for k in range(depth):
        long = "\n    union all ".join(f"select node, {i} as f, {c}::double as v, _y from {prefix}_r{k} where _fit" for i, c in enumerate(features))
        value = "case b.f " + " ".join(f"when {i} then {c}" for i, c in enumerate(features)) + " end"
        ctes += [
            f"{prefix}_s{k} as (select node, f, v, count(*)::double as n, sum(_y) as s, sum(_y * _y) as q from ({long}) group by node, f, v)",
            f"""{prefix}_c{k} as (
  select node, f, v, (v + lead(v) over w) / 2 as cut, sum(n) over w as ln, sum(s) over w as ls, sum(q) over w as lq,
         sum(n) over g as n, sum(s) over g as s, sum(q) over g as q
  from {prefix}_s{k} window w as (partition by node, f order by v rows unbounded preceding), g as (partition by node, f))""",
            f"""{prefix}_b{k} as (
  select node, f, cut, gain from (
    select *, row_number() over (partition by node order by gain desc, f, cut) as pick from (
      select node, f, cut, (q - s * s / n) - (lq - ls * ls / ln) - ((q - lq) - (s - ls) * (s - ls) / (n - ln)) as gain
      from {prefix}_c{k} where cut is not null)) where pick = 1)""",
            f"{prefix}_r{k + 1} as (select r.* replace (r.node * 2 + (({value}) > b.cut)::int as node) from {prefix}_r{k} r join {prefix}_b{k} b using (node))"]
    gains = " union all ".join(f"select f, gain from {prefix}_b{k}" for k in range(depth))
    names = "case f " + " ".join(f"when {i} then '{c}'" for i, c in enumerate(features)) + " end"
    ctes += [f"{prefix}_gain as (select {names} as feature, gain from ({gains}))",
             f"{prefix}_leaf as (select node, avg(_y) as prediction from {prefix}_r{depth} where _fit group by node)",
             f"{prefix}_out as (select r.*, leaf.prediction from {prefix}_r{depth} r join {prefix}_leaf leaf using (node))"]
    return ",\n".join(ctes)
