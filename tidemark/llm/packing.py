"""Packing documents into sequences of at most CAPACITY tokens.

1. Tasks tokenize each document, add the end id and cut longer ones into pieces
   of CAPACITY tokens, the shorter piece first.
2. The piece lengths are counted (at most CAPACITY numbers, whatever the corpus).
3. On the driver, patterns of up to three lengths that fill a sequence exactly
   get repeat counts by non-negative least squares on the histogram (accelerated
   projected gradient over the patterns' sparse columns). Counts are rounded, the
   most used patterns first, never beyond the pieces there are. What is left is
   packed best fit, longest first, on the histogram: sequences with the same room
   are filled together, so the work does not grow with the corpus either.
4. The plan gives, for each length, ranges of ranks with sequence and place. A
   piece's rank within its length is its place in a hash bucket plus the pieces of
   that length in earlier buckets, so no task holds all pieces of one length.

Cases: null and empty texts have the end id alone; rows with one id are packed
each; a null id is kept; an empty table gives an empty result; other columns are
not read."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textbuf, vocabulary
from tidemark.llm.shared import cut

#: Fixed by the task: tokens in a sequence, and the id after each document.
CAPACITY = 1024
END_ID = 2
#: Steps of the least-squares fit, and pieces in a rank bucket.
STEPS = 300
BUCKET_PIECES = 100_000


def split(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str = vocabulary.DEFAULT) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of the pieces of each row of (doc_id, text)."""
    def run(batches):
        ids_of = vocabulary.reader(path)
        for part in textbuf.chunks(batches):
            out = []
            row = []
            for i, text in enumerate(part.column("text").to_pylist()):
                ids = np.append(ids_of(text or ""), np.uint32(end_id)).astype("<u4")
                for j, (start, length) in enumerate(split(len(ids), capacity)):
                    row.append(i)
                    out.append((j, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            columns = np.array(out, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(columns[:, 0].astype(np.int32)), *(pa.array(columns[:, j].copy()) for j in (1, 2, 3))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of three lengths, longest first and 0 for none, that fill a sequence exactly."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    a, b = np.meshgrid(lengths, np.append(0, lengths), indexing="ij")
    c = capacity - a - b
    good = (b <= a) & (c >= 0) & (c <= b) & ((c == 0) | there[np.maximum(c, 0)]) & ((b > 0) | (c == 0))
    return np.stack([a[good], b[good], c[good]], axis=1)


def fit(rows: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts >= 0 of the patterns whose lengths come closest to the histogram in least squares."""
    if not len(rows):
        return np.zeros(0)

    def lengths(x):
        out = np.zeros(len(histogram))
        for j in range(3):
            out += np.bincount(rows[:, j], weights=x, minlength=len(histogram))
        out[0] = 0
        return out

    def slopes(miss):
        miss[0] = 0
        return miss[rows].sum(axis=1)

    x = np.ones(len(rows))
    for _ in range(20):  # largest eigenvalue, for the step
        x = slopes(lengths(x))
        top = np.linalg.norm(x)
        x /= top
    x = np.zeros(len(rows))
    ahead, speed = x, 1.0
    for _ in range(steps):
        new = np.maximum(ahead - slopes(lengths(ahead) - histogram) / (1.02 * top), 0)
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        ahead, x, speed = new + (speed - 1) / faster * (new - x), new, faster
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences), all pieces of the histogram placed."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    rows = patterns(np.flatnonzero(left), capacity)
    repeats = fit(rows, left.astype(float))
    out = []
    for i in np.argsort(-repeats, kind="stable"):
        if repeats[i] <= 1e-3:
            break
        own = [int(v) for v in rows[i] if v]
        room = min(int(left[v]) // own.count(v) for v in own)
        times = min(int(np.ceil(repeats[i])), room)
        if times:
            for v in own:
                left[v] -= times
            out.append((tuple(own), times))
    # best fit, longest first; open[r] has the groups of sequences with room r
    open_: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for length in range(capacity, 0, -1):
        count = int(left[length])
        for room in range(length, capacity):
            while count and open_[room]:
                own, times = open_[room].pop()
                used = min(times, count)
                if times > used:
                    open_[room].append((own, times - used))
                open_[room - length].append((own + (length,), used))
                count -= used
            if not count:
                break
        each = capacity // length
        if count // each:
            open_[capacity - each * length].append(((length,) * each, count // each))
        if count % each:
            open_[capacity - (count % each) * length].append(((length,) * (count % each), 1))
    return out + [group for groups in open_ for group in groups]


def slots(packed: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[str, np.ndarray]:
    """Per length, ranges of ranks in order: their first rank, sequence and place in it."""
    next_rank = [0] * (capacity + 1)
    rows, sequence = [], 0
    for own, times in packed:
        offset = 0
        for length in own:
            rows.append((length, next_rank[length], sequence, offset))
            next_rank[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {k: table[:, j].copy() for j, k in enumerate(("length", "rank", "sequence", "offset"))}


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
         path: str = vocabulary.DEFAULT) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of ``docs``."""
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = cut(pieces(slim, capacity, end_id, path))
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    place = slots(plan(counts, capacity), capacity)
    n = max(1, -(-total // BUCKET_PIECES))
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    # pieces of a length in the buckets before: a window over n numbers per length
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
             .select(F.col("length").alias("of"), F.col("bucket").alias("at"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))

    def seat(key: tuple[pa.Scalar, ...], own: pa.Table, ahead: pa.Table) -> pa.Table:
        own = own.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "start", "ids_crc32")])
        length = own.column("length").to_numpy()
        base = np.zeros(capacity + 1, np.int64)
        base[ahead.column("of").to_numpy()] = ahead.column("ahead").to_numpy()
        first = np.searchsorted(length, length, side="left")
        rank = base[length] + np.arange(len(length)) - first
        lo = np.searchsorted(place["length"], length, side="left")
        hi = np.searchsorted(place["length"], length, side="right")
        at = np.empty(len(length), np.int64)
        for v in np.unique(length):
            mine = np.flatnonzero(length == v)
            a, b = lo[mine[0]], hi[mine[0]]
            at[mine] = a + np.searchsorted(place["rank"][a:b], rank[mine], side="right") - 1
        return own.drop_columns(["bucket"]).append_column(
            "sequence_id", pa.array(place["sequence"][at] + rank - place["rank"][at])).append_column("offset", pa.array(place["offset"][at]))

    return (dealt.groupBy("bucket").cogroup(ahead.groupBy("at")).applyInArrow(
        seat, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").withColumnRenamed("doc_id", id))
