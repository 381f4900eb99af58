"""Near-duplicate documents by b-bit MinHash.

1. A task turns each text into hashed word shingles, their number, a 128-bit
   digest of the set, ``PERMUTATIONS`` minima, the keys of ``BANDS`` bands of
   them, and a signature that keeps ``BITS`` low bits of each minimum.
2. Documents with the same set are one class; its smallest id goes on.
3. Members of a band bucket are compared with the bucket's smallest id, never
   all with all. The signature's equal bits, corrected for chance collisions,
   estimate the similarity inside the join (``bit_count``); pairs far below the
   threshold stop there, and the rest are confirmed on the full sets.
4. Where a bucket still holds several components, links between them may be
   missing. The documents of such buckets are dealt to groups, connected sets of
   buckets of at most ``GROUP`` documents; larger sets go bucket by bucket, a larger
   bucket by pairs of its blocks. A task holds the full sets of one group, counts
   common shingles where components differ and the estimate allows it, and hands
   on only links that join components. No pairs are emitted or shuffled.

A pair at the threshold 0.8 shares no bucket with probability below 1e-7, and
the estimate cuts ``SLACK`` standard deviations below the threshold.

Cases: null or empty texts have no shingles and no links; a null id takes part
in no link and gets a null component; rows with one id are one document; equal
texts share a class; other columns are not read; an empty table gives an empty
result."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbuf
from tidemark.llm.shared import NARROW, components, cut

PERMUTATIONS = 128
BANDS = 32
BITS = 2
SLACK = 5.0
#: Documents whose sets one task compares, and candidate pairs up to which it takes them one by one.
GROUP = 4096
SINGLE_PAIRS = 20_000
#: Sketches that one task reads.
SKETCHES = 50_000
U64 = np.uint64

_PER_LONG = 64 // BITS
LONGS = PERMUTATIONS // _PER_LONG
SIGNATURE = [f"s{j}" for j in range(LONGS)]


def _factors() -> np.ndarray:
    return textbuf.mix(np.arange(1, PERMUTATIONS + 1, dtype=U64) * U64(textbuf.BASE)) | U64(1)


def sketch(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """Set size, digest, signature and band keys of each row of (id, text)."""
    data, off = textbuf.buffers(batch.column(1))
    _, _, row, word = textbuf.words(data, off)
    n = batch.num_rows
    hashes, first = textbuf.shingles(row, word, n, k)
    count = np.zeros(n, np.int64)
    digest = np.zeros((n, 2), U64)
    for i in range(n):
        own = np.unique(hashes[first[i]:first[i + 1]])
        count[i] = len(own)
        digest[i] = own.sum(), textbuf.mix(own ^ U64(textbuf.BASE)).sum()
    minima = np.full((n, PERMUTATIONS), np.iinfo(U64).max, U64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        for j, a in enumerate(_factors()):
            minima[full, j] = np.minimum.reduceat(hashes * a, first[full])
    low = textbuf.mix(minima) & U64((1 << BITS) - 1)
    shift = (np.arange(_PER_LONG) * BITS).astype(U64)
    packed = (low.reshape(n, LONGS, _PER_LONG) << shift).sum(axis=2, dtype=U64)
    rows = PERMUTATIONS // BANDS
    weight = textbuf.mix(np.arange(1, rows + 1, dtype=U64)) | U64(1)
    keys = textbuf.mix((minima.reshape(n, BANDS, rows) * weight).sum(axis=2, dtype=U64) + np.arange(BANDS, dtype=U64))
    bands = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
    columns = [batch.column(0), pa.array(count), *(pa.array(digest[:, j].copy().view(np.int64)) for j in range(2)),
               *(pa.array(packed[:, j].copy().view(np.int64)) for j in range(LONGS)), bands]
    return pa.RecordBatch.from_arrays(columns, ["id", "n", "d1", "d2", *SIGNATURE, "bands"])


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """One sketch per row of ``docs`` (id long, text string)."""
    def run(batches):
        for part in textbuf.chunks(batches):
            yield sketch(part, k)

    schema = "id long, n long, d1 long, d2 long, " + ", ".join(f"{s} long" for s in SIGNATURE) + ", bands array<long>"
    return docs.mapInArrow(run, schema)


def equal_minima(left: str, right: str) -> Column:
    """Number of signature fields that two aliased sketches share."""
    odd = (1 << 64) // 3  # 0101...
    differ = None
    for s in SIGNATURE:
        x = F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))
        folded = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(odd))
        differ = F.bit_count(folded) if differ is None else differ + F.bit_count(folded)
    return F.lit(PERMUTATIONS) - differ


def least_equal(percent: int) -> int:
    """Equal fields below which the similarity is not ``percent``, by SLACK standard deviations.

    Fields of different minima agree by chance with 2**-BITS, so at similarity j
    a field agrees with j + (1 - j) * 2**-BITS."""
    chance = 2.0 ** -BITS
    agree = percent / 100 * (1 - chance) + chance
    return math.floor(PERMUTATIONS * agree - SLACK * math.sqrt(PERMUTATIONS * agree * (1 - agree)))


def confirm(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full shingle sets reach the similarity."""
    def run(batches):
        for part in textbuf.chunks(batches, "text_a"):
            sets = []
            for name in ("text_a", "text_b"):
                data, off = textbuf.buffers(part.column(name))
                _, _, row, word = textbuf.words(data, off)
                sets.append(textbuf.shingles(row, word, part.num_rows, k))
            (x, x_off), (y, y_off) = sets
            same = np.zeros(part.num_rows, bool)
            for i in range(part.num_rows):
                one, two = np.unique(x[x_off[i]:x_off[i + 1]]), np.unique(y[y_off[i]:y_off[i + 1]])
                common = len(np.intersect1d(one, two, assume_unique=True))
                union = len(one) + len(two) - common
                same[i] = union > 0 and 100 * common >= percent * union
            yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(same)), part.column("b").filter(pa.array(same))], ["a", "b"])

    a = docs.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = docs.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _close(percent: int) -> Column:
    """What two sketches x and y must fulfil to be compared on full sets."""
    sizes = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    return sizes & (equal_minima("x", "y") >= least_equal(percent))


def _joins(table: pa.Table, k: int, percent: int) -> list[tuple[int, int]]:
    """Links that join components of a group: rows with id, component, text and sketch."""
    table = table.sort_by([("id", "ascending"), ("n", "ascending"), ("d1", "ascending"), ("d2", "ascending")])
    ids = table.column("id").to_numpy()
    names, label = np.unique(table.column("component").to_numpy(), return_inverse=True)
    data, off = textbuf.buffers(table.column("text"))
    _, _, row, word = textbuf.words(data, off)
    hashes, first = textbuf.shingles(row, word, len(ids), k)
    sets = [np.unique(hashes[first[i]:first[i + 1]]) for i in range(len(ids))]
    n = np.array([len(x) for x in sets], np.int64)
    del data, row, word, hashes
    packed = np.stack([table.column(s).to_numpy().view(U64) for s in SIGNATURE], axis=1)
    least, odd = least_equal(percent), U64((1 << 64) // 3)
    candidates = []
    for i in range(len(ids) - 1):
        x = packed[i + 1:] ^ packed[i]
        equal = PERMUTATIONS - np.bitwise_count((x | (x >> U64(1))) & odd).sum(axis=1, dtype=np.int64)
        size = 100 * np.minimum(n[i + 1:], n[i]) >= percent * np.maximum(n[i + 1:], n[i])
        j = np.flatnonzero((equal >= least) & size & (label[i + 1:] != label[i])) + i + 1
        candidates.append(np.stack([np.full(len(j), i), j]))
    one, two = np.concatenate(candidates, axis=1) if candidates else np.zeros((2, 0), np.int64)
    if len(one) <= SINGLE_PAIRS:
        common = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(one, two)], np.int64)
    else:  # many alike: products of the incidence matrix, some columns at a time
        own = np.unique(np.concatenate([one, two]))
        value = np.concatenate([sets[i] for i in own])
        holder = np.repeat(np.arange(len(own)), [len(sets[i]) for i in own])
        _, column, times = np.unique(value, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        holder, column = holder[shared], np.unique(column[shared], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        holder, column = holder[order], column[order]
        total = np.zeros((len(own), len(own)), np.float32)
        for c in range(0, int(column.max(initial=-1)) + 1, 2048):
            a, b = np.searchsorted(column, [c, c + 2048])
            part = np.zeros((len(own), 2048), np.float32)
            part[holder[a:b], column[a:b] - c] = 1
            total += part @ part.T
        common = total[np.searchsorted(own, one), np.searchsorted(own, two)].astype(np.int64)
    good = 100 * common >= percent * (n[one] + n[two] - common)
    root = np.arange(len(names))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(one[good], two[good]):
        a, b = find(label[i]), find(label[j])
        if a != b:
            root[a] = b
            out.append((int(ids[i]), int(ids[j])))
    return out


def _groups(mixed: DataFrame) -> DataFrame:
    """(g, i, j, id): groups in which the documents of the buckets (key, id, lead) meet."""
    sets = cut(components(mixed.select(F.col("id").alias("a"), F.col("lead").alias("b"))))
    large = sets.groupBy("component").agg(F.count("*").alias("size")).filter(F.col("size") > GROUP).select("component")
    none = F.lit(0).cast("long")
    small = sets.join(large, "component", "left_anti").select(F.col("component").alias("g"), none.alias("i"), none.alias("j"), "id")
    rest = mixed.join(sets.join(large, "component").select("id"), "id").select("key", "id").distinct()
    blocks = rest.groupBy("key").agg(F.ceil(F.count("*") / (GROUP // 2)).alias("blocks")).withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = (rest.join(blocks, "key").select("key", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
    return small.unionAll(dealt.select(F.col("key").alias("g"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id").distinct())


def links(docs: DataFrame, sketched: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b) links whose components are those of all pairs with the similarity."""
    own = sketched.filter("id is not null and n > 0")
    classes = own.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"))
    copies = cut(own.join(classes, ["n", "d1", "d2"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct(), NARROW)
    # The class goes on under its smallest id; another text of a copied id is a class of its own.
    reps = own.join(classes.select("n", "d1", "d2", F.col("rep").alias("id")), ["n", "d1", "d2", "id"], "left_semi").dropDuplicates(["id", "n", "d1", "d2"])
    reps = cut(reps, SKETCHES)
    slim = reps.select("id", "n", "d1", "d2", *SIGNATURE)
    rows = reps.select("id", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("far")).filter("far > lead").select("key", "lead")
    members = cut(rows.join(shared, "key"), NARROW)
    body = cut(docs.join(members.select("id").distinct(), "id", "left_semi"))
    pairs = members.filter("id <> lead").select("id", "lead").distinct()
    tried = (pairs.join(slim, "id").alias("x").join(slim.alias("y"), F.col("x.lead") == F.col("y.id")).filter(_close(percent))
             .select(F.col("y.id").alias("a"), F.col("x.id").alias("b")).distinct())
    found = cut(copies.unionAll(confirm(tried, body, k, percent)).distinct(), NARROW)
    parts = components(found)
    split = cut(members.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id")), NARROW)
    keys = split.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    groups = _groups(cut(split.join(keys, "key").select("key", "id", "lead"), NARROW))
    labels = parts.withColumnRenamed("id", "of")
    full = (groups.join(body, "id").join(slim, "id").join(labels, F.col("id") == F.col("of"), "left").drop("of")
            .withColumn("component", F.coalesce("component", "id")))

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = _joins(table, k, percent)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return found.unionAll(full.groupBy("g", "i", "j").applyInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``: documents that share
    ``percent`` of their shingles of ``words`` words are linked."""
    slim = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    sketched = cut(sketches(slim, words), SKETCHES)
    parts = components(links(slim, sketched, words, percent))
    return (sketched.select("id", "n").join(parts, "id", "left")
            .select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")))
