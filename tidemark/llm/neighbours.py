"""Nearest neighbours by collision counting over single projections.

1. Every vector is projected on ``PROJECTIONS`` random lines. Vectors are dealt to
   shards by a hash of their id; a shard keeps one sorted array per line.
2. A query's window on a line is centred at its own projection. Virtual rehashing
   widens all windows step by step (half width ``START`` * ``GROWTH`` ** step, in
   units of the query's length / sqrt(dimensions)), and the entries that a step
   adds are counted per vector.
3. A vector that lies in at least ``THRESHOLD`` of the windows is verified: its
   exact distance is computed. All such vectors of a step are verified, without a
   cap, before a query may stop: when its k-th best distance is within ``RATIO``
   times the half width * sqrt(dimensions), or when the windows hold the whole shard.
4. The best k of every shard are merged; ties go to the smaller id.

Queries go in blocks against shards, one task each: a task holds ``SHARD_ROWS``
vectors and ``BLOCK_QUERIES`` queries at most, whatever the tables hold. Equal
vectors collide in every window at once and are all verified, so ties are right.

Cases: null and empty vectors, vectors of another length than most, zero vectors
and vectors with null or non-finite components take no part, as queries or as
candidates; null ids take no part; repeated ids are candidates each; a query with
fewer candidates gets them all; an empty table gives an empty result; other
columns are not read."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 64
#: Share of the windows that a vector must lie in.
THRESHOLD = 0.6
START, GROWTH, RATIO = 0.6, 1.2, 1.0
SHARD_ROWS = 20_000
BLOCK_QUERIES = 10_000
SEED = 5


def lines(dims: int) -> np.ndarray:
    """Random unit directions, as columns."""
    a = np.random.default_rng(SEED).standard_normal((dims, PROJECTIONS))
    return a / np.linalg.norm(a, axis=0)


class Shard:
    """Vectors of a shard with their projections, sorted on each line."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.lines = lines(vectors.shape[1])
        shadow = vectors @ self.lines
        self.order = np.argsort(shadow, axis=0, kind="stable")
        self.sorted = np.take_along_axis(shadow, self.order, axis=0)
        self.need = max(1, math.ceil(THRESHOLD * PROJECTIONS))

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, nearest first."""
        n = len(self.ids)
        shadow = query @ self.lines
        centre = [int(np.searchsorted(self.sorted[:, j], shadow[j])) for j in range(PROJECTIONS)]
        low, high = list(centre), list(centre)
        count = np.zeros(n, np.int64)
        verified = np.zeros(n, bool)
        places, distances = np.zeros(0, np.int64), np.zeros(0)
        scale = float(np.linalg.norm(query)) / math.sqrt(len(query)) or 1.0
        half = START * scale
        while True:
            added = []
            for j in range(PROJECTIONS):
                line = self.sorted[:, j]
                a, b = int(np.searchsorted(line, shadow[j] - half, "left")), int(np.searchsorted(line, shadow[j] + half, "right"))
                a, b = min(a, low[j]), max(b, high[j])
                added += [self.order[a:low[j], j], self.order[high[j]:b, j]]
                low[j], high[j] = a, b
            count += np.bincount(np.concatenate(added), minlength=n)
            fresh = np.flatnonzero((count >= self.need) & ~verified)
            verified[fresh] = True
            fresh = fresh[self.ids[fresh] != query_id]
            if len(fresh):
                difference = self.vectors[fresh] - query
                places = np.append(places, fresh)
                distances = np.append(distances, np.sqrt((difference * difference).sum(axis=1)))
                best = np.lexsort((self.ids[places], distances))[:k]
                places, distances = places[best], distances[best]
            # a vector at distance d projects within d / sqrt(dims) of the query on most lines
            full = len(distances) == k and distances[-1] <= RATIO * half * math.sqrt(len(query))
            if full or all(a == 0 and b == n for a, b in zip(low, high)):
                return self.ids[places], distances
            half *= GROWTH


def usable(vector: Column) -> Column:
    """True for vectors with finite components, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest rows of each row that meets ``queries`` (a condition on the id)."""
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dims", F.size("v"))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).orderBy(F.desc("n"), "dims").limit(1).collect()
    schema = "query_id long, id long, score double"
    n, asked = (sizes[0]["n"], sizes[0]["q"]) if sizes else (0, 0)
    rows = rows.filter(F.col("dims") == (sizes[0]["dims"] if sizes else 0))
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-asked // BLOCK_QUERIES))
    hashed = F.xxhash64("id")

    def numbers(count):  # both sides' keys are longs: equal numbers of different types are dealt to different tasks
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    # a query block meets every shard: vectors go to each block, queries to each shard
    held = rows.select(F.pmod(hashed, F.lit(shards)).cast("long").alias("shard"), numbers(blocks).alias("block"), "id", "v")
    asking = rows.filter("asks").select(numbers(shards).alias("at"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("long").alias("of"),
                                        F.col("id").alias("q"), F.col("v").alias("qv"))

    def matrix(column) -> np.ndarray:
        column = column.combine_chunks()
        return column.flatten().to_numpy().reshape(len(column), -1)

    def search(key: tuple[pa.Scalar, ...], own: pa.Table, asks: pa.Table) -> pa.Table:
        out = []
        if own.num_rows and asks.num_rows:
            shard = Shard(own.column("id").to_numpy(), matrix(own.column("v")))
            for q, v in zip(asks.column("q").to_pylist(), matrix(asks.column("qv"))):
                ids, distances = shard.search(q, v, k)
                out += [(q, int(i), float(d)) for i, d in zip(ids, distances)]
        return pa.table({c: pa.array([r[j] for r in out], t) for j, (c, t) in enumerate((("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())))})

    found = held.groupBy("shard", "block").cogroup(asking.groupBy("at", "of")).applyInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy("score", "id")  # k rows per shard
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), F.col("id").alias(id), "score"))
