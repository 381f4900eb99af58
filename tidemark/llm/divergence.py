"""How the sources of a language differ in their words, on exact integers.

Words (runs of letters and of characters beyond ASCII, A-Z in lower case) that stand in
at least MIN_DOCS documents of a language are its vocabulary. With V words, a group with
N of their occurrences gives a word that it holds c times the share
p = 1 + floor(SCALE * (c + 1) / (N + V)); two shares diverge by floor((p - q)**2 / q).

* **Counts.** Tasks count the words of a chunk of texts in numpy; Spark adds them up by
  (language, source, word), so a frequent word is one row per task before the shuffle.
* **Pairs of sources.** Words with the same counts in all sources diverge alike: the
  vocabulary is reordered so that they stand together (one row with its number of words),
  cut into blocks, and ordered inside a block by the counts of the sources with most words.
  Each source's column of a block is run-length encoded; a pair of columns is intersected
  at its run boundaries, and each piece adds f times its length. Blocks hold about ENTRIES
  counts whatever the size of the vocabulary; a language with many sources is dealt to
  stripes of them.
* **Top words.** A rank filter that Spark applies inside tasks before the shuffle.

Cases: null text, language and source are ''; an empty text, and a group without
vocabulary, still has its pairs (value 0 if the language has no vocabulary); repeated rows
are documents of their own; ties go to the smaller item by UTF-8 bytes; an empty table
gives no rows; other columns are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textbuf
from tidemark.llm.shared import cut

MIN_DOCS = 3
SCALE = 10**9
TOP = 200
#: Bytes of text counted at once.
CHUNK_BYTES = 1 << 22
#: Counts in a block of the reordered vocabulary, and sources in a stripe.
ENTRIES = 250_000
STRIPE = 256
#: Tables of groups and of blocks are broadcast up to this number of rows, else joined by a shuffle.
SMALL = 20_000
#: Sources whose counts order a block.
ORDERED = 16

_CODES = np.arange(256)
_LETTER = ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)


def _terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word in lower-case bytes."""
    solid = _LETTER[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    full = off[1:] > off[:-1]
    before[off[:-1][full]] = False
    after[off[1:][full] - 1] = False
    start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans as strings."""
    off = np.concatenate([[0], np.cumsum(end - start)])
    raw = data[np.repeat(start - off[:-1], end - start) + np.arange(off[-1])]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(raw)).cast(pa.string())


def _count_words(batches):
    """(lang, source, term, n, docs) of each chunk of rows."""
    for batch in textbuf.chunks(batches, limit=CHUNK_BYTES):
        data, off = textbuf.buffers(batch.column("text"))
        data = textbuf.LOWER[data]
        start, end, row = _terms(data, off)
        if not len(start):
            continue
        group = batch.column("lang").dictionary_encode()
        other = batch.column("source").dictionary_encode()
        code = group.indices.to_numpy().astype(np.int64) * len(other.dictionary) + other.indices.to_numpy()
        word = textbuf.span_hash(data, start, end)
        # one entry per word and row, then per word and group
        _, first, times = np.unique(textbuf.mix(word + textbuf.mix(row.astype(textbuf.U64))), return_index=True, return_counts=True)
        owner = code[row[first]]
        _, lead, where = np.unique(textbuf.mix(word[first] + textbuf.mix(owner.astype(textbuf.U64))), return_index=True, return_inverse=True)
        n = np.bincount(where, weights=times).astype(np.int64)
        docs = np.bincount(where)
        at = first[lead]
        pick = pa.array(row[at])
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").take(pick), batch.column("source").take(pick), _strings(data, start[at], end[at]), pa.array(n),
             pa.array(docs.astype(np.int64))], names=["lang", "source", "term", "n", "docs"])


def _clean(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, counts) of the kept words; counts is (source, n) by source."""
    found = _clean(docs).mapInArrow(_count_words, "lang string, source string, term string, n long, docs long")
    each = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = each.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"))
    return cut(whole.filter(F.col("docs") >= min_docs).drop("docs"))


def _beside(small: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has at most SMALL rows."""
    return F.broadcast(small) if small.count() <= SMALL else small


def group_totals(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, size) of every group; size is the language's vocabulary."""
    groups = _clean(docs).select("lang", "source").distinct()
    mine = words.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    whole = words.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("size"))
    out = groups.join(mine, ["lang", "source"], "left").join(whole, "lang", "left")
    return cut(out.fillna(0, ["total", "lang_total", "size"]))


def share(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + size))."""
    up = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", up, (total + size).cast("decimal(20,0)")) + 1


def _shares(count: np.ndarray, total: int, size: int) -> np.ndarray:
    """As ``share``: long division by three digits a step, so nothing passes 64 bits."""
    out, rest = np.zeros(len(count), np.int64), count.astype(np.int64) + 1
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total + size)
        out = out * 1000 + digit
    return out + 1


def _columns(counts: pa.Array, weight: np.ndarray, sources: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Run-length column (end of each run in words, count) of every source over one block."""
    n = len(weight)
    flat = pc.list_flatten(counts)
    row = pc.list_parent_indices(counts).to_numpy()
    which = pc.index_in(pc.struct_field(flat, "source"), pa.array(sources)).to_numpy(zero_copy_only=False)
    value = pc.struct_field(flat, "n").to_numpy()
    order = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[order], np.arange(len(sources) + 1))

    def dense(s: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        mine = order[cuts[s]:cuts[s + 1]]
        out[row[mine]] = value[mine]
        return out

    widest = np.argsort(-(cuts[1:] - cuts[:-1]), kind="stable")[:ORDERED].tolist()
    place = np.lexsort([dense(s) for s in reversed(widest)]) if n else np.zeros(0, np.int64)
    ends = np.cumsum(weight[place])
    runs = []
    for s in range(len(sources)):
        column = dense(s)[place]
        last = np.append(np.flatnonzero(column[1:] != column[:-1]), n - 1) if n else np.zeros(0, np.int64)
        runs.append((ends[last], column[last]))
    return runs


def _pair_sums(key, block: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of one block for the pairs of a stripe's sources with all later ones, in both directions."""
    names = sorted(zip(groups.column("source").to_pylist(), groups.column("total").to_pylist()), key=lambda g: g[0].encode())
    size = groups.column("size")[0].as_py()
    sources = [s for s, _ in names]
    column = block.column("counts").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], block.schema.field("counts").type)
    runs = _columns(column, block.column("words").to_numpy().astype(np.int64), sources)
    runs = [(end, _shares(value, total, size) if len(value) else value) for (end, value), (_, total) in zip(runs, names)]
    out_a, out_b, out_v = [], [], []
    stripe = key[2].as_py()
    for i in range(stripe * STRIPE, min((stripe + 1) * STRIPE, len(sources))):
        end_i, p_i = runs[i]
        for j in range(i + 1, len(sources)):
            end_j, p_j = runs[j]
            ends = np.concatenate([end_i, end_j])
            ends.sort(kind="stable")
            ends = ends[np.append(ends[1:] != ends[:-1], True)] if len(ends) else ends
            length = np.diff(ends, prepend=0)
            p, q = p_i[np.searchsorted(end_i, ends)], p_j[np.searchsorted(end_j, ends)]
            square = (p - q) * (p - q)
            out_a += [sources[i], sources[j]]
            out_b += [sources[j], sources[i]]
            out_v += [int((square // q * length).sum()), int((square // p * length).sum())]
    return pa.table({"lang": pa.array([key[0].as_py()] * len(out_a), pa.string()), "source": pa.array(out_a, pa.string()),
                     "item": pa.array(out_b, pa.string()), "value": pa.array(out_v, pa.int64())})


def pair_divergence(words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value): divergence of every group from each other source of its language."""
    alike = cut(words.groupBy("lang", "counts").agg(F.count("*").alias("words")))
    size = alike.agg(F.sum(F.size("counts").cast("long")).alias("n")).first()["n"] or 0
    parts = -(-size // ENTRIES)
    if parts > 1:
        alike = cut(alike.repartitionByRange(parts, "lang", "counts").withColumn("block", F.spark_partition_id()))
    else:
        alike = alike.withColumn("block", F.lit(0))
    stripes = totals.groupBy("lang").agg(F.explode(F.sequence(F.lit(0), F.floor((F.count("*") - 1) / STRIPE).cast("int"))).alias("stripe"))
    tasks = stripes.join(alike.select("lang", "block").distinct(), "lang", "left").fillna(-1, ["block"])
    tasks = cut(tasks)
    held = alike.join(_beside(tasks), ["lang", "block"])
    groups = totals.join(tasks, "lang").select(*[F.col(c).alias(c) for c in ("lang", "block", "stripe", "source", "total", "size")])
    key = ["lang", "block", "stripe"]
    sums = held.groupBy(*key).cogroup(groups.groupBy(*key)).applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_divergence(words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the words that a group holds more often than its language."""
    each = words.select("lang", "term", F.col("total").alias("whole"), F.explode("counts").alias("c"))
    each = each.select("lang", "term", "whole", F.col("c.source").alias("source"), F.col("c.n").alias("n")).join(_beside(totals), ["lang", "source"])
    each = each.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("size")).alias("p"),
                       share(F.col("whole"), F.col("lang_total"), F.col("size")).alias("q"))
    return each.filter("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and the ``top`` words of each group."""
    words = vocabulary(docs, min_docs)
    totals = group_totals(docs, words)
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pair_divergence(words, totals).withColumn("rank", place)
    terms = term_divergence(words, totals).withColumn("rank", place).filter(F.col("rank") <= top)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*cols).unionAll(terms.withColumn("part", F.lit("term")).select(*cols))
