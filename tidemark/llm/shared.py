"""Helpers of the operators: cut lineage in the shared folder, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` written once to the folder in spark.checkpoint.dir and read from there, by tasks of
    about ``rows`` rows if that makes them fewer (for narrow rows: many small tasks cost more
    than they do)."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    return out if rows is None else out.coalesce(max(1, -(-out.count() // rows)))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


#: Narrow rows (a few numbers) of one task.
NARROW = 200_000
#: Links up to which a round is one task's work; more are dealt out by id.
ONE_TASK = 200_000


def _with_least(edges: DataFrame, few: bool) -> DataFrame:
    """The edges (a, b) with the smallest b of their a as ``m``. Few edges lie in one task, where a window needs no
    shuffle; else the minima are grouped, which combines them map-side, and joined back."""
    if few:
        return edges.withColumn("m", F.min("b").over(Window.partitionBy("a")))
    return edges.join(edges.groupBy("a").agg(F.min("b").alias("m")), "a")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a long, b long); component is the smallest id reachable.

    Alternating large-star and small-star rounds: each id keeps one link to the
    smallest id it knows. A round is two grouped minima, joined back; an id with
    very many links is one hot join key, which adaptive execution splits, and
    its minimum is combined before the shuffle. The links never reach the driver. A round over
    few links is one task without any shuffle; the same steps, only not dealt out."""
    edges = cut(links.filter("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state["n"] == 0 or (state["n"], state["s"]) == before:
            break
        before = (state["n"], state["s"])
        few = state["n"] <= ONE_TASK
        if few:
            edges = edges.coalesce(1)
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        large = _with_least(both, few).withColumn("m", F.least("m", "a")).filter("b > a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        small = _with_least(large, few).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = cut(small.filter("a <> b").distinct())
    roots = edges.select("b").distinct().select(F.col("b").alias("id"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots)
