"""Sources, sinks and catalog operations.

Tables are Parquet (or catalog tables). Versioned tables are append-only
with an ``ingest_version`` column: the latest version is a max, reading as of
a version is a filter that Parquet pushes down (and partition pruning skips
whole folders when the table is partitioned by version)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_COL = "ingest_version"
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    for part in name.split("."):
        if not _IDENT.match(part):
            raise ValueError(f"bad identifier {name!r}")
    return name


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with a fixed schema. Without one, the schema is inferred (an
    extra pass over the files; avoid on large inputs)."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row and no index column, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(_ident(name_or_path))


def sql_on_path(spark: SparkSession, path: str, fmt: str = "parquet", where: str | None = None) -> DataFrame:
    """``select * from <fmt>.`<path>``` — SQL straight over files."""
    if fmt not in ("parquet", "orc", "json", "csv"):
        raise ValueError(f"unsupported format {fmt}")
    if "`" in path:
        raise ValueError("path may not contain a backtick")
    q = f"select * from {fmt}.`{path}`"
    if where:
        q += f" where {where}"
    return spark.sql(q)


def ensure_database(spark: SparkSession, name: str, comment: str | None = None, location: str | None = None) -> None:
    ddl = f"create database if not exists {_ident(name)}"
    if comment:
        ddl += " comment '" + comment.replace("'", "") + "'"
    if location:
        if "'" in location:
            raise ValueError("location may not contain a quote")
        ddl += f" location '{location}'"
    spark.sql(ddl)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
               comment: str | None = None) -> None:
    """Managed table (Parquet) in the catalog."""
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(_ident(name))
    if comment:
        df.sparkSession.sql(f"comment on table {_ident(name)} is '" + comment.replace("'", "") + "'")


def drop_feature_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"drop table if exists {_ident(name)}")


def append_period(df: DataFrame, path: str, period_col: str, period: str, version: int) -> None:
    """Write one period as ``version`` into a table partitioned by period and version.

    Earlier versions of the period stay, so the table can be read as it was;
    running the same (period, version) again replaces its own rows only (dynamic
    partition overwrite) instead of doubling them."""
    out = df.withColumn(period_col, F.lit(period)).withColumn(VERSION_COL, F.lit(int(version)))
    (out.write.partitionBy(period_col, VERSION_COL).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def latest_version(df: DataFrame) -> DataFrame:
    """One row: the highest ``ingest_version`` present."""
    return df.agg(F.max(VERSION_COL).alias("latest_version"))


def table_versions(spark: SparkSession, name: str) -> DataFrame:
    """(version) of a catalog table partitioned by ``ingest_version``, from the catalog's list of
    partitions: no file is opened."""
    found = spark.sql(f"show partitions {_ident(name)}")
    return found.select(F.regexp_extract("partition", rf"(?:^|/){VERSION_COL}=(\d+)(?:/|$)", 1).cast("int").alias("version")).distinct()


def path_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version) of a folder partitioned by ``ingest_version``, from the names of its files: they are
    listed by Spark, and none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col(VERSION_COL).cast("int").alias("version")).distinct()


def read_as_of(df: DataFrame, version: int, period_col: str | None = None) -> DataFrame:
    """The table as it was after ``version`` was written. With ``period_col`` each
    period shows its newest version up to then (a period written again replaces
    its older rows); without, rows of all versions up to then. Both filters prune
    partitions; the newest versions are one small row per period."""
    upto = df.where(F.col(VERSION_COL) <= F.lit(int(version)))
    if period_col is None:
        return upto
    newest = upto.groupBy(F.col(period_col).alias("_tm_p")).agg(F.max(VERSION_COL).alias("_tm_v"))
    same = upto[period_col].eqNullSafe(newest["_tm_p"]) & (upto[VERSION_COL] == newest["_tm_v"])
    return upto.join(F.broadcast(newest), same, "left_semi")  # dealt by period, a whole period would be one task


def with_versions(df: DataFrame, version: "F.Column") -> DataFrame:
    """Stamp rows with a derived ingest version (for example the year an
    order was loaded in a yearly append)."""
    return df.withColumn(VERSION_COL, version.cast("int"))


def save_stats(stats: DataFrame, path: str, run_id: str, mode: str = "append") -> None:
    """Store a long statistics table (feature, statistic, value[, text])
    under a run id, partitioned by run."""
    out = stats
    if "text" not in out.columns:
        out = out.withColumn("text", F.lit(None).cast("string"))
    out.withColumn("run_id", F.lit(run_id)).write.mode(mode).partitionBy("run_id").parquet(path)


def load_stats(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Statistics stored for one run; the run filter prunes partitions."""
    return (spark.read.parquet(path).where(F.col("run_id") == F.lit(run_id))
            .select("feature", "statistic", "value", "text"))
