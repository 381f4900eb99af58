"""Quality classifier: a linear hinge-loss model on n-gram indicators that are
scaled by naive Bayes log-count ratios (NBSVM).

1. Features of a text are indicators, hashed to ``DIMS`` places: its words, and
   the n-grams (1 to ``SHAPE_ORDER``) of word shapes. A shape tells the kind of a
   word's characters, what it ends with, its rough length and whether it repeats
   one of the two words before. Nothing but the text is read.
2. The fit takes at most ``MAX_PER_CLASS`` labelled rows of each class, those with
   the smallest hash of their id: a bounded sample, small enough to broadcast the
   ids and to fit in one task. Labels other than 0 and 1 are not used, and a
   document with both counts as 0.
3. The log-count ratio of a feature compares its smoothed shares in both classes.
   Rows are scaled to length 1, so long texts are not surer than short ones.
   Dual coordinate descent changes one row's multiplier at a time.
4. Every text is scored where it is read; the weights (two arrays of DIMS) go out
   with the job.

Cases: null and empty texts have no feature and get the score of the bias; a null
id is scored and not held out; repeated rows are scored each; without rows of both
classes every score is 0.5; an empty table gives an empty result; other columns
pass through ``score`` and are not read otherwise."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbuf

DIMS = 1 << 18
SHAPE_ORDER = 3
MAX_PER_CLASS = 10_000
#: Cost of a margin violation, passes over the sample, and slope of the score.
COST, PASSES, SLOPE = 1.0, 12, 4.0
U64 = np.uint64

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LOWER = ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_DIGIT = (_B >= 48) & (_B <= 57)
_MARK = ~(_UPPER | _LOWER | _DIGIT)


def shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Small code of each word's shape."""
    def among(kind):
        total = np.append(0, np.cumsum(kind[data]))
        return total[end] - total[start]

    upper, lower, digit = among(_UPPER), among(_LOWER), among(_DIGIT)
    kind = np.select([digit > 0, upper + lower == 0, (lower == 0) & (upper > 1), upper == 0, (upper == 1) & _UPPER[data[start]]], [0, 1, 2, 3, 4], 5)
    last = data[end - 1]
    tail = np.where(_MARK[last], 2, 0)
    tail[(last == 46) | (last == 44)] = 1
    double = (end - start > 1) & _MARK[last] & _MARK[data[np.maximum(end - 2, 0)]]
    tail[double] = 3
    again = np.zeros(len(word), np.int64)
    for back in (2, 1):
        if len(word) > back:
            same = (word[back:] == word[:-back]) & (row[back:] == row[:-back])
            again[back:][same] = back
    size = np.searchsorted([4, 13, 26], end - start, side="right")
    return ((kind * 4 + tail) * 3 + again) * 4 + size


def features(part: pa.RecordBatch) -> list[np.ndarray]:
    """Distinct feature places of each row of a batch with a text column."""
    data, off = textbuf.buffers(part.column("text"))
    start, end, row, word = textbuf.words(data, off)
    n = part.num_rows
    sets = [(word, np.searchsorted(row, np.arange(n + 1)))]
    if len(word):
        code = textbuf.mix(shapes(data, start, end, row, word).astype(U64) + U64(1))
        sets += [textbuf.shingles(row, code, n, k) for k in range(1, SHAPE_ORDER + 1)]
    out = []
    places = [((h * U64(textbuf.BASE)) >> U64(64 - 18), o) for h, o in sets]
    for i in range(n):
        out.append(np.unique(np.concatenate([h[o[i]:o[i + 1]] for h, o in places])).astype(np.int32))
    return out


class Model:
    """Weights of the features (already times their ratio), squared ratios, and the bias."""

    def __init__(self, weight: np.ndarray, square: np.ndarray, bias: float):
        self.weight, self.square, self.bias = weight, square, bias

    def score(self, places: np.ndarray) -> float:
        length = float(self.square[places].sum()) ** 0.5
        margin = self.bias + (float(self.weight[places].sum()) / length if length else 0.0)
        return 1.0 / (1.0 + np.exp(-SLOPE * margin))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """NBSVM of the sample: labels 0 and 1."""
    sign = np.where(labels == 1, 1.0, -1.0)
    if not (sign > 0).any() or not (sign < 0).any():
        return Model(np.zeros(DIMS), np.zeros(DIMS), 0.0)
    shares = []
    for s in (1.0, -1.0):
        own = [r for r, y in zip(rows, sign) if y == s]
        count = 1.0 + np.bincount(np.concatenate(own), minlength=DIMS) if own else np.ones(DIMS)
        shares.append(count / count.sum())
    ratio = np.log(shares[0] / shares[1])
    values = [ratio[r] for r in rows]
    values = [v / (np.sqrt((v * v).sum()) or 1.0) for v in values]
    # the rarer class weighs as much as the other
    cost = COST * len(sign) / 2 / np.where(sign > 0, (sign > 0).sum(), (sign < 0).sum())
    weight, bias, alpha = np.zeros(DIMS), 0.0, np.zeros(len(sign))
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(sign)):
            v, at = values[i], rows[i]
            slope = sign[i] * (float(weight[at] @ v) + bias) - 1.0
            new = min(max(alpha[i] - slope / (1.0 + float(v @ v)), 0.0), cost[i])
            if new != alpha[i]:
                change = (new - alpha[i]) * sign[i]
                weight[at] += change * v
                bias += change
                alpha[i] = new
    return Model(weight * ratio, ratio * ratio, bias)


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", seen=None) -> Model:
    """Fit on a bounded sample of the labelled documents; ``seen`` is a condition on ``id`` that they must meet."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull())
    if seen is not None:
        known = known.filter(seen)
    known = known.groupBy(F.col(id).alias("id")).agg(F.min(label).cast("int").alias("label"))
    sample = None
    for k in (0, 1):  # each task and the result hold MAX_PER_CLASS ids at most
        own = known.filter(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(MAX_PER_CLASS)
        sample = own if sample is None else sample.unionAll(own)

    def extract(batches):
        for part in textbuf.chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array(features(part), pa.list_(pa.int32()))], ["id", "label", "places"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")  # the same order, and so the same model, however rows arrive
        rows = [np.asarray(x.values, np.int32) for x in table.column("places")]
        model = fit(rows, table.column("label").to_numpy())
        return pa.table({"weight": [model.weight.tobytes()], "square": [model.square.tobytes()], "bias": [model.bias]})

    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    one = (texts.mapInArrow(extract, "id long, label int, places array<int>").withColumn("sample", F.lit(0)).groupBy("sample").applyInArrow(
        learn, "weight binary, square binary, bias double").first())
    if one is None:
        return fit([], np.zeros(0))
    return Model(np.frombuffer(one["weight"]), np.frombuffer(one["square"]), one["bias"])


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: probability-like score of label 1."""
    keep = [c for c in docs.columns if c != out]

    def run(batches):
        for part in textbuf.chunks(batches, text):
            only = pa.RecordBatch.from_arrays([part.column(text)], ["text"])
            scores = [model.score(places) for places in features(only)]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(scores, pa.float64())], keep + [out])

    kinds = dict(docs.dtypes)
    return docs.select(*keep).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", `{out}` double")
