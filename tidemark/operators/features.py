"""Keyed feature tables: lookup joins, upserts, one-hot columns, key checks.

A feature table may be a plain DataFrame or a named table in the catalog. A named one keeps
its key and description as table properties and its rows as numbered snapshots (partitions);
the property ``tidemark.snapshot`` says which one holds. A write adds a snapshot and moves
the property last, so readers see the old rows or the new ones, and a write that dies leaves
the table as it was."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.io import _ident

SNAPSHOT = "_tm_snapshot"
# Properties of a named feature table.
KEY_PROPERTY, SNAPSHOT_PROPERTY = "tidemark.primary_key", "tidemark.snapshot"


@dataclass
class FeatureLookup:
    """Features of ``table`` (a DataFrame, or the name of a feature table) joined on its
    primary key ``keys``; the spine columns holding the key are ``lookup_key`` (same names
    when omitted). A named table knows its key. ``features=None`` means every non-key column
    of the table."""

    table: DataFrame | str
    keys: Sequence[str] | None = None
    lookup_key: Sequence[str] | None = None
    features: Sequence[str] | None = None
    rename: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if isinstance(self.table, str):
            spark = SparkSession.getActiveSession()
            if spark is None:
                raise ValueError("no active session to find the table in")
            own = primary_key(spark, self.table)
            if self.keys is not None and set(self.keys) != set(own):
                raise ValueError(f"the key of {self.table} is {own}, not {list(self.keys)}")
            self.keys, self.table = list(self.keys or own), read_features(spark, self.table)
        elif self.keys is None:
            raise ValueError("a DataFrame's lookup needs its keys")

    def columns(self) -> list[str]:
        if self.features is not None:
            return list(self.features)
        return [c for c in self.table.columns if c not in set(self.keys)]


def training_set(spine: DataFrame, lookups: Sequence[FeatureLookup], label: str | None = None,
                 exclude: Sequence[str] = ()) -> DataFrame:
    """Left-join each feature table onto the spine (labels + keys).

    Only the needed feature columns are selected before each join, so the
    scans prune columns; unmatched keys give null features. Joins are plain
    equi-joins: AQE broadcasts a small feature table and splits skewed spine
    keys. Duplicate output names are an error rather than a silent shadow."""
    out = spine
    for lk in lookups:
        spine_keys = list(lk.lookup_key or lk.keys)
        if len(spine_keys) != len(lk.keys):
            raise ValueError("lookup_key and keys differ in length")
        feats = lk.columns()
        right = lk.table.select(*[F.col(t).alias(s) for s, t in zip(spine_keys, lk.keys)],
                                *[F.col(c).alias(lk.rename.get(c, c)) for c in feats])
        new_names = [lk.rename.get(c, c) for c in feats]
        clash = sorted(set(new_names) & set(out.columns))
        if clash:
            raise ValueError(f"feature names already present: {clash}")
        out = out.join(right, spine_keys, "left")
    if exclude:
        out = out.drop(*exclude)
    if label is not None:
        if label not in out.columns:
            raise ValueError(f"label {label!r} missing")
        out = out.select(*[c for c in out.columns if c != label], label)
    return out


def lookup_missing(spine: DataFrame, lookups: Sequence[FeatureLookup]) -> DataFrame:
    """Scoring-time lookup: features the caller already supplies in ``spine``
    are kept as given (a supplied null stays null); only absent ones are
    looked up."""
    trimmed = []
    for lk in lookups:
        feats = [c for c in lk.columns() if lk.rename.get(c, c) not in spine.columns]
        if feats:
            trimmed.append(FeatureLookup(lk.table, lk.keys, lk.lookup_key, feats, lk.rename))
    return training_set(spine, trimmed)


def concat_periods(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name (not position)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def merge_features(current: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert: rows of ``updates`` replace rows of ``current`` with the same
    key, other rows are kept. Write the result to a new snapshot, never over
    the path ``current`` is read from. Columns must agree, and the update's keys
    must be unique and not null; anything else is an error, not a silent loss."""
    keys = list(keys)
    extra, absent = set(updates.columns) - set(current.columns), set(current.columns) - set(updates.columns)
    if extra or absent:
        raise ValueError(f"columns differ: only in the update {sorted(extra)}, missing there {sorted(absent)}")
    if key_violations(updates, keys).limit(1).count() > 0:
        raise ValueError(f"update keys {keys} repeat or are null")
    kept = current.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.select(*current.columns))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: duplicated or containing a null.
    (keys..., n_rows, reason)."""
    keys = list(keys)
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else (any_null | F.col(k).isNull())
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return (g.withColumn("reason", F.when(any_null, F.lit("null_key"))
                         .when(F.col("n_rows") > 1, F.lit("duplicate_key")))
            .where(F.col("reason").isNotNull()))


def write_features(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite",
                   current_path: str | None = None) -> None:
    """Write a feature table after checking its primary key (no duplicate or
    null keys). ``mode="merge"`` upserts ``df`` into the snapshot at
    ``current_path`` and writes the result as a new snapshot at ``path``
    (a job never overwrites the files it is reading)."""
    if key_violations(df, keys).limit(1).count() > 0:
        raise ValueError(f"primary key {list(keys)} is not unique or has nulls")
    if mode == "merge":
        if not current_path or current_path.rstrip("/") == path.rstrip("/"):
            raise ValueError("merge needs the current snapshot path and a different new path")
        current = df.sparkSession.read.parquet(current_path)
        merge_features(current, df, keys).write.mode("errorifexists").parquet(path)
    elif mode in ("overwrite", "errorifexists"):
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unsupported mode {mode}")


# ---------------------------------------------------------------- named feature tables

def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """A table's properties (a bounded list)."""
    return {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {_ident(name)}").collect()}


def _held(spark: SparkSession, name: str) -> dict[str, str]:
    found = _properties(spark, name)
    if KEY_PROPERTY not in found:
        raise ValueError(f"{name} is no feature table")
    return found


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def primary_key(spark: SparkSession, name: str) -> list[str]:
    return json.loads(_held(spark, name)[KEY_PROPERTY])


def create_features(df: DataFrame, name: str, keys: Sequence[str], description: str = "") -> None:
    """A new feature table ``name`` with its rows, primary key and description. The key is checked
    first: it must be unique and without nulls. An existing table is an error."""
    spark, keys = df.sparkSession, list(keys)
    if spark.catalog.tableExists(_ident(name)):
        raise ValueError(f"{name} exists")
    if not keys or set(keys) - set(df.columns):
        raise ValueError(f"key {keys} is not in the table")
    if key_violations(df, keys).limit(1).count() > 0:
        raise ValueError(f"primary key {keys} is not unique or has nulls")
    df.withColumn(SNAPSHOT, F.lit(1)).write.format("parquet").partitionBy(SNAPSHOT).saveAsTable(name)
    spark.sql(f"comment on table {name} is {_quoted(description)}")
    spark.sql(f"alter table {name} set tblproperties ({_quoted(KEY_PROPERTY)} = {_quoted(json.dumps(keys))}, {_quoted(SNAPSHOT_PROPERTY)} = '1')")


def read_features(spark: SparkSession, name: str) -> DataFrame:
    """The rows of the snapshot that holds; the filter prunes the other partitions."""
    held = _held(spark, name)
    return spark.table(name).where(F.col(SNAPSHOT) == int(held[SNAPSHOT_PROPERTY])).drop(SNAPSHOT)


def describe_features(spark: SparkSession, name: str) -> DataFrame:
    """One row: table, primary_key (list), description, snapshot, features (list)."""
    held = _held(spark, name)
    keys = json.loads(held[KEY_PROPERTY])
    own = [c for c in spark.table(name).columns if c not in (*keys, SNAPSHOT)]
    row = (name, keys, spark.catalog.getTable(name).description or "", int(held[SNAPSHOT_PROPERTY]), own)
    return spark.createDataFrame([row], "table string, primary_key array<string>, description string, snapshot int, features array<string>")


def update_features(df: DataFrame, name: str, mode: str = "merge") -> int:
    """Write ``df`` into a named feature table and return the new snapshot's number: "merge"
    upserts by the table's key, "overwrite" replaces all rows. One writer at a time."""
    spark, held = df.sparkSession, _held(df.sparkSession, name)
    keys, now = json.loads(held[KEY_PROPERTY]), int(held[SNAPSHOT_PROPERTY])
    current = read_features(spark, name)
    if mode == "merge":
        rows = merge_features(current, df, keys)
    elif mode == "overwrite":
        if set(df.columns) != set(current.columns):
            raise ValueError(f"columns differ: {sorted(set(df.columns) ^ set(current.columns))}")
        if key_violations(df, keys).limit(1).count() > 0:
            raise ValueError(f"primary key {keys} is not unique or has nulls")
        rows = df
    else:
        raise ValueError(f"unsupported mode {mode}")
    # The snapshot's folder is written over: what a write that died left there must not be added to.
    place = spark.sql(f"describe formatted {name}").where("col_name = 'Location'").first()["data_type"]
    rows.select(*current.columns).write.mode("overwrite").parquet(f"{place}/{SNAPSHOT}={now + 1}")
    spark.sql(f"alter table {name} add if not exists partition ({SNAPSHOT} = {now + 1})")
    spark.catalog.refreshTable(name)
    spark.sql(f"alter table {name} set tblproperties ({_quoted(SNAPSHOT_PROPERTY)} = '{now + 1}')")
    return now + 1


def discover_levels(df: DataFrame, columns: Sequence[str], max_levels: int) -> dict[str, list]:
    """Sorted distinct non-null levels of each column, found in one grouped job.
    A column with more than ``max_levels`` is an error, so that it can't explode
    the schema; at most that many per column (and one) reach the driver."""
    sets = None
    for c in columns:
        own = df.select(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")).where(F.col(c).isNotNull())
        sets = own if sets is None else sets.unionAll(own)
    ranked = F.row_number().over(Window.partitionBy("feature").orderBy("level"))
    rows = (sets.distinct().withColumn("_tm_r", ranked).where(F.col("_tm_r") <= max_levels + 1)
            .orderBy("feature", "_tm_r").collect())
    found: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        found[r["feature"]].append(r["level"])
    wide = [c for c, v in found.items() if len(v) > max_levels]
    if wide:
        raise ValueError(f"{wide} have more than {max_levels} levels")
    return found


def one_hot(df: DataFrame, columns: Sequence[str], levels: dict[str, Sequence] | None = None,
            drop_first: bool = True, max_levels: int | None = None, keep_original: bool = False) -> DataFrame:
    """Indicator columns ``<col>_<level>`` (int 0/1), first sorted level
    dropped; null gives all zeros. Levels are fixed at fit time: passed in, or
    discovered once from ``df`` within the caller's ``max_levels``."""
    levels = dict(levels or {})
    unknown = [c for c in columns if c not in levels]
    if unknown:
        if max_levels is None:
            raise ValueError(f"pass the levels of {unknown}, or max_levels to discover them")
        levels |= discover_levels(df, unknown, max_levels)
    out = df
    for c in columns:
        lv = list(levels[c])[1:] if drop_first else list(levels[c])
        out = out.select("*", *[F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                                for v in lv])
        if not keep_original:
            out = out.drop(c)
    return out
