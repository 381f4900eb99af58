import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality


def corpus(words, n):
    rows = []
    for i in range(n):
        text = words.text(60)
        if i % 4 == 0:
            text = " ".join(w + words.random.choice(["###", "$$$", "%%"]) for w in text.split()) if i % 8 else text.upper().replace(" ", "!! ")
        rows.append((i, text))
    return rows


def test_held_out_accuracy(spark, documents, words):
    docs = documents(corpus(words, 400))
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, seen=F.col("doc_id") % 3 != 1)
    rows = quality.score(docs, model, out="q").filter("doc_id % 3 = 1").collect()
    right = np.mean([(r.q >= 0.5) == (r.doc_id % 4 > 0) for r in rows])
    assert right >= 0.95 and all(0 <= r.q <= 1 for r in rows)


def test_same_model_however_rows_arrive(spark, documents, words):
    docs = documents(corpus(words, 60))
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(60)], "doc_id long, quality int")
    one, two = (quality.train(docs.repartition(n), labels.repartition(n)) for n in (1, 5))
    assert np.array_equal(one.weight, two.weight) and one.bias == two.bias


def test_sample_is_bounded_by_class(spark, documents, words, monkeypatch):
    monkeypatch.setattr(quality, "MAX_PER_CLASS", 5)
    docs = documents(corpus(words, 60))
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(60)], "doc_id long, quality int")
    assert quality.score(docs, quality.train(docs, labels), out="q").filter("q is not null").count() == 60


def test_odd_rows_and_labels(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "a b"), (3, "x " * 50_000), (3, "y")])
    labels = spark.createDataFrame([(1, 1), (2, None), (3, 7), (None, 0)], "doc_id long, quality int")
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(rows) == 5 and all(r.score == 0.5 for r in rows)  # one class only
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1)], "doc_id long, quality int")
    assert quality.score(docs, quality.train(docs, labels)).filter("score between 0 and 1").count() == 5
    assert quality.score(documents([]), quality.train(documents([]), labels)).count() == 0


def test_fit_equals_a_plain_version(words):
    """Log-count ratios, scaling to length 1 and dual coordinate descent with dictionaries, on the same features."""
    import math

    import pyarrow as pa

    texts = corpus(words, 60)
    rows = quality.features(pa.RecordBatch.from_arrays([pa.array([t for _, t in texts])], ["text"]))
    labels = np.array([int(i % 4 > 0) for i, _ in texts])
    model = quality.fit(rows, labels)
    held = [set(r.tolist()) for r in rows]
    totals = {}
    for y in (0, 1):
        counts = {}
        for h, label in zip(held, labels):
            for f in h if label == y else ():
                counts[f] = counts.get(f, 0) + 1
        totals[y] = counts, quality.DIMS + sum(counts.values())
    used = sorted(set().union(*held))
    ratio = {f: math.log((1 + totals[1][0].get(f, 0)) / totals[1][1]) - math.log((1 + totals[0][0].get(f, 0)) / totals[0][1]) for f in used}
    scaled = []
    for h in held:
        length = math.sqrt(sum(ratio[f] ** 2 for f in h))
        scaled.append({f: ratio[f] / length for f in h})
    n, ones = len(labels), int(labels.sum())
    cost = [quality.COST * n / 2 / (ones if y else n - ones) for y in labels]
    weight, bias, alpha, order = dict.fromkeys(used, 0.0), 0.0, [0.0] * n, np.random.default_rng(7)
    for _ in range(quality.PASSES):
        for i in order.permutation(n).tolist():
            y = 1 if labels[i] else -1
            gradient = y * (sum(weight[f] * v for f, v in scaled[i].items()) + bias) - 1
            norm = 1 + sum(v * v for v in scaled[i].values())
            new = min(max(alpha[i] - gradient / norm, 0.0), cost[i])
            for f, v in scaled[i].items():
                weight[f] += (new - alpha[i]) * y * v
            bias += (new - alpha[i]) * y
            alpha[i] = new
    assert abs(model.bias - bias) < 1e-9
    assert max(abs(model.weight[f] - weight[f] * ratio[f]) for f in used) < 1e-9
    assert not np.delete(model.weight, used).any()
    for h, r in zip(held, rows):
        margin = bias + sum(weight[f] * ratio[f] for f in h) / math.sqrt(sum(ratio[f] ** 2 for f in h))
        assert abs(model.score(r) - 1 / (1 + math.exp(-quality.SLOPE * margin))) < 1e-9
