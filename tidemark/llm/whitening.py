"""Whitening of vectors: eigenvectors of a distributed covariance, found in float32 and
corrected in double precision by Ogita-Aishima iterations, which are matrix products.

Entries are read on a grid, x = floor(SCALE * c). The fit list is each distinct vector
once; its number, sums and covariance (centred first, divisor n) are added up by Spark:

1. Tasks pack vectors to 2, 4 or 8 bytes an entry, whichever the vector needs, and Spark
   keeps one of each (equal ones meet inside tasks first, so a hot vector is one row each).
2. Each task adds up its part of the sums, then of the products of centred vectors, as
   d rows of a d x d matrix; two rounds of grouped sums join the parts row by row.
3. The driver holds one d x d matrix, whatever the number of vectors, and solves it.
   ``eigen`` starts from a float32 solution. A round corrects all vectors by products:
   with R = I - X'X and S = X'AX, E_ij = (S_ij + l_j R_ij) / (l_j - l_i) for separated
   values and R_ij / 2 for values closer than the present error, and X becomes X + XE.
   Values that stay closer than the float32 solution could tell apart form a cluster: the
   matrix, shifted by the cluster's mean and projected on its vectors, is solved alone in
   double precision and rotates them; the rounds then go on.
4. Another scan of the fit list measures the covariance of the whitened vectors.

Cases: rows whose vector is null or holds null, NaN or infinite entries, or entries beyond
64 bits on the grid, take no part, nor do vectors of another length than most (ties: the
longer). Repeated rows each get a result, and a null id is kept. Directions in which the fit
list does not vary (eigenvalue 0 within rounding) are no components: one distinct vector has
none. deviation is null where it passes 64 bits. An empty table gives no rows; other columns
pass through, and one called ``whitened`` or ``deviation`` is replaced."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import cut

SCALE = 256
COMPONENTS = 4
#: Bytes of vectors handled at once in a task.
BLOCK_BYTES = 1 << 22
#: Parts of a sum that meet in one task of the first round.
FAN = 64
ROUNDS = 30
_LIMIT = 2.0**63


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    a = np.asarray(a, np.float64)
    d, norm = len(a), float(np.abs(a).max(initial=0.0))
    if norm == 0.0:
        return np.zeros(d), np.eye(d)
    a = a / norm
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    near = 4 * d * float(np.finfo(np.float32).eps)  # values closer than this were one to the float32 solution
    eye, best, tried = np.eye(d), np.inf, 0
    for _ in range(ROUNDS):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
        error = 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(r))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > min(error, near)
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1.0), r / 2)
        size = float(np.abs(e).max())
        if size > 0.1:  # too close for a correction of first order: solve the clusters alone
            x = _solve_clusters(a, x, values, max(near, error))
            tried += 1
            if tried > ROUNDS // 2:
                break
            continue
        x = x + x @ e
        if size < 4 * d * np.finfo(np.float64).eps or size >= best / 2 and size < 1e-10:
            break
        best = size
    x = _solve_clusters(a, x, np.einsum("ij,ij->j", x, a @ x), near)
    x = x + x @ (eye - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * norm, x[:, order]


def _solve_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, near: float) -> np.ndarray:
    """Rotate the vectors of each run of values with gaps below ``near`` to the eigenvectors of
    the shifted matrix on their span."""
    order = np.argsort(-values, kind="stable")
    x, values, d = x[:, order].copy(), values[order], len(values)
    cuts = np.flatnonzero(values[:-1] - values[1:] > near) + 1
    for part in np.split(np.arange(d), cuts):
        if len(part) > 1:
            span, _ = np.linalg.qr(x[:, part])
            middle = values[part].mean()
            small = span.T @ (a @ span - middle * span)
            turn = np.linalg.eigh((small + small.T) / 2)[1][:, ::-1]
            x[:, part] = span @ turn
    return x


@dataclass(frozen=True)
class Whitening:
    """What a fit keeps: bounded by the length of the vectors."""

    dim: int
    n: int
    sums: tuple[int, ...]  # of every entry over the fit list
    values: np.ndarray  # eigenvalues, falling, of the components
    vectors: np.ndarray  # one column for each component
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def _grid(column, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their entries on the grid."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(fits)
    flat = pc.list_flatten(column.take(pa.array(rows))) if len(rows) else pa.array([], pa.float64())
    c = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(len(rows), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(SCALE * c)
        good = ((x >= -_LIMIT) & (x < _LIMIT)).all(axis=1)
    return rows[good], x[good].astype(np.int64)


def _slices(batches, dim: int):
    step = max(1, BLOCK_BYTES // (8 * dim))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _pack(x: np.ndarray) -> pa.Array:
    """Each vector as little-endian integers of the narrowest width that holds it."""
    top = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1))
    wide = np.select([top < 2**15, top < 2**31], [2, 4], 8)
    off = np.concatenate([[0], np.cumsum(wide * x.shape[1])])
    raw = np.empty(off[-1], np.uint8)
    for w in (2, 4, 8):
        mine = np.flatnonzero(wide == w)
        if len(mine):
            raw[(off[mine][:, None] + np.arange(w * x.shape[1])).ravel()] = x[mine].astype(f"<i{w}").view(np.uint8).ravel()
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())


def _unpack(column, dim: int) -> np.ndarray:
    size = pc.binary_length(column).to_numpy(zero_copy_only=False) // dim
    out = np.empty((len(column), dim), np.int64)
    for w in (2, 4, 8):
        mine = np.flatnonzero(size == w)
        if len(mine):
            out[mine] = np.frombuffer(b"".join(column.take(pa.array(mine)).to_pylist()), f"<i{w}").reshape(-1, dim)
    return out


def _exact_sums(x: np.ndarray) -> list[int]:
    if len(x) and max(abs(int(x.min())), abs(int(x.max()))) > 2**62 // len(x):
        return [sum(map(int, col)) for col in x.T]
    return x.sum(axis=0).tolist()


def _added(parts: DataFrame, width: int, rows: int) -> np.ndarray:
    """Sum of (i int, part int, row array<double>) by i, in two rounds, as a matrix."""
    schema = "i int, part int, row array<double>"

    def total(table: pa.Table) -> pa.Table:
        flat = pc.list_flatten(table.column("row").combine_chunks()).to_numpy(zero_copy_only=False)
        s = flat.reshape(-1, width).sum(axis=0)
        return pa.table({"i": table.column("i").slice(0, 1), "part": pa.array([0], pa.int32()),
                         "row": pa.array([s.tolist()], pa.list_(pa.float64()))})

    some = parts.groupBy("i", "part").applyInArrow(total, schema)
    out = np.zeros((rows, width))
    for r in some.groupBy("i").applyInArrow(total, schema).collect():
        out[r["i"]] = r["row"]
    return out


def _products(vectors: DataFrame, dim: int, project) -> DataFrame:
    """(i, part, row) of every task: the products of ``project(x)`` with itself, row by row."""
    def add(batches):
        from pyspark import TaskContext
        whole = None
        for batch in _slices(batches, dim):
            z = project(_unpack(batch.column("x"), dim))
            whole = z.T @ z if whole is None else whole + z.T @ z
        if whole is not None:
            part = TaskContext.get().partitionId() // FAN
            yield pa.RecordBatch.from_pydict({
                "i": pa.array(range(len(whole)), pa.int32()), "part": pa.array([part] * len(whole), pa.int32()),
                "row": pa.array(whole.tolist(), pa.list_(pa.float64()))})

    return vectors.mapInArrow(add, "i int, part int, row array<double>")


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors of ``column``; None if no vector takes part."""
    top = df.select(F.size(column).alias("d")).filter("d > 0").groupBy("d").count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if top is None:
        return None
    dim = top["d"]

    def pack(batches):
        for batch in _slices(batches, dim):
            _, x = _grid(batch.column(0), dim)
            if len(x):
                yield pa.RecordBatch.from_arrays([_pack(x)], names=["x"])

    vectors = cut(df.select(column).mapInArrow(pack, "x binary").distinct())

    def sums(batches):
        n, whole = 0, [0] * dim
        for batch in _slices(batches, dim):
            x = _unpack(batch.column("x"), dim)
            n, whole = n + len(x), [a + b for a, b in zip(whole, _exact_sums(x))]
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(-1, dim), pa.int32()), "s": pa.array([str(v) for v in [n, *whole]])})

    found = vectors.mapInArrow(sums, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by = {r["i"]: int(r["s"]) for r in found}
    if not by:
        return None
    n = by[-1]
    whole = tuple(by[i] for i in range(dim))
    mean = np.array([s / n for s in whole])
    covariance = _added(_products(vectors, dim, lambda x: x - mean), dim, dim) / n
    values, axes = eigen((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    varies = values > max(values[0], 0.0) * dim * 2.0**-46
    k = min(components, int(varies.sum()))
    values, axes = values[:k], axes[:, :k]
    turn = axes / np.sqrt(values)
    error = 0.0
    if k:
        # one more column of ones gives the means of the whitened entries
        m = _added(_products(vectors, dim, lambda x: np.hstack([(x - mean) @ turn, np.ones((len(x), 1))])), k + 1, k + 1) / n
        error = float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max())
    return Whitening(dim, n, whole, values, axes, trace, error)


def transform(df: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """Rows of ``df`` whose vector takes part, with ``whitened`` (an entry for each component) and
    ``deviation`` (sum of (n x - sum)**2 over the entries, exact)."""
    out = [T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())]
    kept = [c for c in df.columns if c not in ("whitened", "deviation")]
    schema = T.StructType([df.schema[c] for c in kept] + out)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    dim, n, sums = model.dim, model.n, model.sums
    mean, turn = np.array([s / n for s in sums]), model.vectors / np.sqrt(model.values)

    def deviations(x: np.ndarray) -> list[int | None]:
        far = max((max(abs(n * int(hi) - s), abs(n * int(lo) - s)) for hi, lo, s in zip(x.max(axis=0), x.min(axis=0), sums)), default=0)
        if far * far * dim < 2**63 and max(map(abs, sums)) < 2**62:
            move = n * x - np.array(sums, np.int64)
            return (move * move).sum(axis=1).tolist()
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        return [v if v < 2**63 else None for v in exact]

    def read(batches):
        for batch in _slices(batches, dim):
            rows, x = _grid(batch.column(column), dim)
            if len(rows):
                some = batch.take(pa.array(rows))
                w = ((x - mean) @ turn).tolist()
                yield pa.RecordBatch.from_arrays(
                    [some.column(c) for c in kept] + [pa.array(w, pa.list_(pa.float64())), pa.array(deviations(x), pa.int64())],
                    names=kept + ["whitened", "deviation"])

    return df.select(*dict.fromkeys([*kept, column])).mapInArrow(read, schema)
