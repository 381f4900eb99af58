"""Interpolated modified Kneser-Ney n-gram model of any order from 2 on.

Counting is Spark work: tasks number the words and count the n-grams of the full
order, merge equal ones before the shuffle, and one task per key range adds them
up. A range hands on the n-grams without their first word; these are the n-grams
of the next lower level, counted by how many different words stood before them,
and so on down to single words. Each range of a level is stored as arrays in the
shared folder: sorted 64-bit hashes of n-grams with counts, and sorted hashes of
contexts with their totals and numbers of followers seen once, twice and more. Of
words, sorted hashes (the place of a hash is the word's id), counts and
continuation counts are stored. Scoring tasks memory-map these files and search
them, so the model takes no heap and no driver memory.

N-grams are dealt out by their context. One whose context has only very frequent
words (so the context may alone fill a range) is dealt out by its own hash, and
the parts of that context's totals are added up in one more grouping.

If the shared folder is no mounted path, the files are shipped once to each
executor with ``addFile`` and mapped there.

Cases: null and empty texts are one end mark; a null id counts as training text;
repeated rows count and score each; words before the first of a text are begin
marks; without training text every probability is that of the uniform
distribution over the unknown word, log 0; an empty table gives an empty result;
other columns are not read. N-grams and contexts are identified by 64-bit
hashes."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import textbuf
from tidemark.llm.shared import cut
from tidemark.session import shared_dir

U64 = np.uint64
#: Tokens per key range (of word pairs; of longer n-grams fewer, by their words), and keys that a task holds
#: before it hands them on.
RANGE_TOKENS = 6_000_000
HELD_KEYS = 3_000_000
#: Words of an n-gram, and the number of distinct words from which on ids take 64 bits.
ORDER, WIDE_FROM = 2, 1 << 32
#: Keys of the marks at the end of a text and before its first word (fixed values).
END, BEGIN = U64(0x1F0E1D2C3B4A5968), U64(0x0123456789ABCDEF)


class _Tally:
    """Columns of n-grams with counts, equal ones added up whenever many have come together."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, columns, counts):
        self.held.append((columns, counts))
        self.size += len(counts)

    def take(self):
        columns = [np.concatenate(c) for c in zip(*(h[0] for h in self.held))]
        counts = np.concatenate([h[1] for h in self.held])
        self.held, self.size = [], 0
        return _add_up(columns, counts)


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of each n-gram, read from its first word on; that of its context is a step on the way."""
    h = np.full(len(columns[0]), textbuf.BASE, U64)
    for c in columns:
        h = textbuf.mix(h ^ c.astype(U64))
    return h


def _key(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit number of each n-gram: exact where the columns fit in it, else a hash."""
    if len(columns) == 1:
        return columns[0]
    if len(columns) == 2 and columns[0].dtype == columns[1].dtype == np.uint32:
        return (columns[0].astype(U64) << U64(32)) | columns[1]
    return _hash(columns)


def _add_up(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    if not len(counts):
        return columns, counts
    keys = _key(columns)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return [c[order[first]] for c in columns], np.add.reduceat(counts[order], first)


def _by_part(part: np.ndarray, n: int):
    """(part, places) of the values in each part that has some."""
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(n + 1))
    for p in range(n):
        if edge[p + 1] > edge[p]:
            yield p, order[edge[p]:edge[p + 1]]


def _range_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of each row with one end mark after them, and the offsets of the rows."""
    data, off = textbuf.buffers(part.column("text"))
    _, _, row, word = textbuf.words(data, off)
    n = part.num_rows
    count = np.bincount(row, minlength=n) + 1
    ends = np.cumsum(count)
    keys = np.full(ends[-1], END, U64)
    inside = np.ones(ends[-1], bool)
    inside[ends - 1] = False
    keys[inside] = word
    return keys, np.append(0, ends)


def _store(uri: str, name: str, values: np.ndarray) -> None:
    """One array as a file, visible only when whole, so that a repeated task does no harm."""
    where, base = fs.FileSystem.from_uri(uri)
    mine = f"{base}/{name}.{uuid.uuid4().hex}"
    with where.open_output_stream(mine) as out:
        out.write(np.ascontiguousarray(values).tobytes())
    where.move(mine, f"{base}/{name}")


def _store_counts(uri: str, name: str, values: np.ndarray) -> None:
    """Counts in the narrowest type that holds them all; ``_load_counts`` tells it by the file's size."""
    _store(uri, name, values.astype(np.min_scalar_type(int(values.max()) if values.size else 0)))


def _load(uri: str, name: str, kind) -> np.ndarray:
    where, base = fs.FileSystem.from_uri(uri)
    path = f"{base}/{name}" if isinstance(where, fs.LocalFileSystem) else SparkFiles.get(name)
    try:
        return np.memmap(path, kind, mode="r")
    except ValueError:  # an empty file can't be mapped
        return np.zeros(0, kind)


def _load_counts(uri: str, name: str, rows: int) -> np.ndarray:
    data = _load(uri, name, np.uint8)
    return data.view(f"u{len(data) // rows}") if rows else data


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted key in sorted keys, -1 where it is missing."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


class _Words:
    """The stored words: ids, counts and, later, continuation counts."""

    def __init__(self, uri: str, sizes: list[int], full: bool):
        self.n = len(sizes)
        self.base = np.append(0, np.cumsum(sizes))
        self.keys = [_load(uri, f"words-{p}", U64) for p in range(self.n)]
        self.counts = [_load(uri, f"counts-{p}", np.int64) for p in range(self.n)]
        self.before = [_load(uri, f"before-{p}", np.int64) for p in range(self.n)] if full else []

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Id of each key, -1 for unknown ones."""
        distinct, back = np.unique(keys, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        edge = np.searchsorted(_range_of(distinct, self.n), np.arange(self.n + 1))
        for p in range(self.n):
            place = _find(self.keys[p], distinct[edge[p]:edge[p + 1]])
            out[edge[p]:edge[p + 1]] = np.where(place >= 0, place + self.base[p], -1)
        return out[back]

    def look(self, arrays: list, ids: np.ndarray) -> np.ndarray:
        """Rows of the arrays at known ids."""
        out = np.zeros(len(ids), np.int64)
        for p, at in _by_part(np.searchsorted(self.base, ids, side="right") - 1, self.n):
            out[at] = arrays[p][ids[at] - self.base[p]]
        return out


def _deal(columns: list[np.ndarray], hot: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(range, context's hash, whether the context may be hot) of each n-gram.

    The range is that of the context, or of the n-gram itself if all words of the context are hot."""
    context = _hash(columns[:-1])
    spread = np.full(len(context), len(hot) > 0)
    for c in columns[:-1]:
        spread[spread] = _find(hot, c[spread].astype(U64)) >= 0
    by = context.copy()
    by[spread] = textbuf.mix(context[spread] ^ columns[-1][spread].astype(U64))
    return _range_of(by, n), context, spread


def _ngrams(ids: np.ndarray, off: np.ndarray, begin: int, order: int) -> list[np.ndarray]:
    """Columns of the n-gram that ends in each token, its first word first; -1 stays visible."""
    place = np.arange(len(ids)) - np.repeat(off[:-1], np.diff(off))
    columns = [ids]
    for back in range(1, order):
        before = np.full(len(ids), begin, np.int64)
        inside = place >= back
        before[inside] = ids[np.flatnonzero(inside) - back]
        columns.insert(0, before)
    return columns


def discounts(n: list[int]) -> list[float]:
    """Discounts of counts 0, 1, 2 and from 3 on, by the numbers of keys with counts 1 to 4.

    Where one of these numbers is 0 the estimate does not exist: 0.5, 1 and 1.5 then."""
    if min(n) == 0:
        return [0.0, 0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [0.0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), float(k)) for k in (1, 2, 3)]


class Model:
    """A stored model: place, order, sizes of its ranges and a few totals.

    ``discounts[j]`` are those of level j; ``parts`` is the number of ranges of every level,
    ``hot`` the ids of very frequent words."""

    def __init__(self, uri, order, sizes, hot, begin, tokens, distinct, discounts, continuations, spread):
        self.uri, self.order, self.sizes, self.parts, self.hot, self.begin = uri, order, sizes, len(sizes), hot, begin
        self.tokens, self.distinct, self.discounts = tokens, distinct, discounts
        self.continuations, self.spread = continuations, spread

    def delete(self) -> None:
        where, base = fs.FileSystem.from_uri(self.uri)
        where.delete_dir(base)


class _Level:
    """The stored n-grams of one level: counts, and totals of their contexts."""

    def __init__(self, model: Model, level: int):
        def context(name):
            keys = _load(model.uri, f"{name}-{level}-{p}", U64)
            return keys, _load_counts(model.uri, f"{name}totals-{level}-{p}", 4 * len(keys)).reshape(-1, 4)

        self.model, self.keys, self.counts, self.contexts, self.spread = model, [], [], [], []
        for p in range(model.parts):
            keys = _load(model.uri, f"ngrams-{level}-{p}", U64)
            self.keys.append(keys)
            self.counts.append(_load_counts(model.uri, f"ngramcounts-{level}-{p}", len(keys)))
            self.contexts.append(context("contexts"))
            self.spread.append(context("spread"))

    def look(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(count, context's total and followers by kind) of each n-gram, 0 where it is not stored."""
        n = self.model.parts
        part, context, hot = _deal(columns, self.model.hot, n)
        whole = textbuf.mix(context ^ columns[-1].astype(U64))
        distinct, first, back = np.unique(whole, return_index=True, return_inverse=True)
        count = np.zeros(len(distinct), np.int64)
        for p, at in _by_part(part[first], n):
            place = _find(self.keys[p], distinct[at])
            count[at[place >= 0]] = self.counts[p][place[place >= 0]]
        distinct, first, again = np.unique(context, return_index=True, return_inverse=True)
        total = np.zeros((len(distinct), 4), np.int64)
        hot = hot[first]
        for kind, stored in ((False, self.contexts), (True, self.spread)):
            own = np.flatnonzero(hot == kind)
            for p, at in _by_part(_range_of(distinct[own], n), n):
                at = own[at]
                place = _find(stored[p][0], distinct[at])
                total[at[place >= 0]] = stored[p][1][place[place >= 0]]
        return count[back], total[again]


def _ship(spark: SparkSession, uri: str, names: list[str]) -> None:
    if not isinstance(fs.FileSystem.from_uri(uri)[0], fs.LocalFileSystem):
        for name in names:
            spark.sparkContext.addFile(f"{uri}/{name}")


def _packed(columns: list[np.ndarray], counts: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes]:
    return b"".join(c[at].tobytes() for c in columns), counts[at].astype(np.int64).tobytes()


def _rows(level: int, rows) -> pa.Table:
    """Rows (part, level, keys, counts) of (part, keys, counts)."""
    rows = list(rows)
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([level] * len(rows), pa.int64()),
                     *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))], ["part", "level", "keys", "counts"])


_COUNTED = "part long, level long, keys binary, counts binary"


def _counted(batches, columns_of, level: int, parts: int, part_of):
    """Rows (part, level, keys, counts) of the n-grams that ``columns_of`` finds in the texts."""
    tally = _Tally()

    def hand_on():
        columns, counts = tally.take()
        if len(columns) > 2:  # neighbours that begin alike compress better
            near = np.argsort(_key(columns[:2]), kind="stable")
            columns, counts = [c[near] for c in columns], counts[near]
        rows = _rows(level, ((p, *_packed(columns, counts, at)) for p, at in _by_part(part_of(columns), parts)))
        return rows.combine_chunks().to_batches()

    for part in textbuf.chunks(batches):
        columns = columns_of(part)
        tally.add(*_add_up(columns, np.ones(len(columns[0]), np.int64)))
        if tally.size > HELD_KEYS:
            yield from hand_on()
    if tally.size:
        yield from hand_on()


def _merged(table: pa.Table, kinds: list) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of the given types and counts of all rows, equal n-grams added up."""
    held, width = _Tally(), sum(np.dtype(k).itemsize for k in kinds)
    for data, counts in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist()):
        n, at, columns = len(data) // width, 0, []
        for k in kinds:
            columns.append(np.frombuffer(data, k, n, at))
            at += n * np.dtype(k).itemsize
        held.add(columns, np.frombuffer(counts, np.int64))
    return held.take() if held.held else ([np.zeros(0, k) for k in kinds], np.zeros(0, np.int64))


def _of_level(table: pa.Table, level: int) -> pa.Table:
    return table.filter(pc.equal(table.column("level"), level))


def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their rows of values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(values[order], first, axis=0)


def _totals(counts: np.ndarray) -> np.ndarray:
    """Rows (count, seen once, seen twice, seen more often)."""
    return np.stack([counts] + [(np.minimum(counts, 3) == k).astype(np.int64) for k in (1, 2, 3)], axis=1)


def _few(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64)


#: Levels below 0 mark rows that go along: parts of hot contexts' totals, and numbers of counts 1 to 4.
_SPREAD, _FEW = -1, -1000
#: Names of a range's files.
_STORED = ["ngrams", "ngramcounts", "contexts", "contextstotals"]
_SPREAD_STORED = ["spread", "spreadtotals"]


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """Count ``docs`` and store the model of this order (2 or more) in the shared folder."""
    if order < 2:
        raise ValueError(f"a model of order {order} has no context; 2 is the least")
    spark = docs.sparkSession
    uri = f"{shared_dir(spark).rstrip('/')}/tidemark-lm-{uuid.uuid4().hex[:12]}"
    where, base = fs.FileSystem.from_uri(uri)
    where.create_dir(base)
    slim = docs.select(F.col(text).alias("text"))
    size = slim.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 6).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / 6 * order / 2 / RANGE_TOKENS))

    def word_keys(part):
        keys, _ = _tokens(part)
        return [np.append(keys, np.full(part.num_rows, BEGIN, U64))]

    def store_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        (keys,), counts = _merged(table, [U64])
        p = key[0].as_py()
        _store(uri, f"words-{p}", keys)
        _store(uri, f"counts-{p}", counts)
        begin = np.flatnonzero(keys == BEGIN)
        top = np.flatnonzero(counts > RANGE_TOKENS // 10)
        return pa.table({"part": [p], "size": [len(keys)], "total": [int(counts.sum())],
                         "begin": pa.array([int(begin[0]) if len(begin) else None], pa.int64()),
                         "texts": [int(counts[begin].sum())], "top": [top.astype(np.int64).tobytes()]})

    counted = slim.mapInArrow(lambda b: _counted(b, word_keys, 1, n, lambda k: _range_of(k[0], n)), _COUNTED)
    stored = {r["part"]: r for r in counted.groupBy("part").applyInArrow(
        store_words, "part long, size long, total long, begin long, texts long, top binary").collect()}
    for p in set(range(n)) - set(stored):
        for name in ("words", "counts"):
            _store(uri, f"{name}-{p}", np.zeros(0, np.int64))
    sizes = [stored[p]["size"] if p in stored else 0 for p in range(n)]
    bases = np.append(0, np.cumsum(sizes))
    _ship(spark, uri, [f"{x}-{p}" for p in range(n) for x in ("words", "counts")])
    texts = sum(r["texts"] for r in stored.values())
    tokens = sum(r["total"] for r in stored.values()) - texts
    begin = next((int(bases[p]) + r["begin"] for p, r in stored.items() if r["begin"] is not None), 0)
    # words that alone would fill a tenth of a range: at most ten for each range of tokens
    hot = [bases[p] + np.frombuffer(r["top"], np.int64) for p, r in stored.items()]
    hot = np.sort(np.concatenate(hot)).astype(U64) if hot else np.zeros(0, U64)
    kind = np.uint32 if bases[-1] < WIDE_FROM else U64

    def tasks(batches):
        words = _Words(uri, sizes, False)

        def columns(part):
            keys, off = _tokens(part)
            return [c.astype(kind) for c in _ngrams(words.ids(keys), off, begin, order)]

        yield from _counted(batches, columns, order, n, lambda c: _deal(c, hot, n)[0])

    def store_spread(table: pa.Table, level: int, p: int) -> None:
        """Totals of the hot contexts of a level, from the parts that its ranges hold."""
        own = _of_level(table, _SPREAD - level)
        keys = np.frombuffer(b"".join(own.column("keys").to_pylist()), U64)
        keys, totals = _grouped(keys, np.frombuffer(b"".join(own.column("counts").to_pylist()), np.int64).reshape(-1, 4))
        _store(uri, f"spread-{level}-{p}", keys)
        _store_counts(uri, f"spreadtotals-{level}-{p}", totals)

    def going_on(table: pa.Table) -> pa.Table:
        return table.filter(pc.less_equal(table.column("level"), _FEW))

    def store_level(level: int):
        def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            p = key[0].as_py()
            if level < order:
                store_spread(table, level + 1, p)
            along = going_on(table)
            columns, counts = _merged(_of_level(table, level), [kind] * level)
            _, context, spread = _deal(columns, hot, n)
            whole = textbuf.mix(context ^ columns[-1].astype(U64))
            by = np.argsort(whole)
            _store(uri, f"ngrams-{level}-{p}", whole[by])
            _store_counts(uri, f"ngramcounts-{level}-{p}", counts[by])
            keys, totals = _grouped(context[~spread], _totals(counts[~spread]))
            _store(uri, f"contexts-{level}-{p}", keys)
            _store_counts(uri, f"contextstotals-{level}-{p}", totals)
            keys, totals = _grouped(context[spread], _totals(counts[spread]))
            few = _few(counts)
            shorter, before = _add_up(columns[1:], np.ones(len(counts), np.int64))
            if level > 2:
                to = _deal(shorter, hot, n)[0]
            else:
                to = np.searchsorted(bases, shorter[0].astype(np.int64), side="right") - 1
            return pa.concat_tables([
                _rows(level - 1, ((q, *_packed(shorter, before, at)) for q, at in _by_part(to, n))),
                _rows(_SPREAD - level, ((q, keys[at].tobytes(), totals[at].tobytes()) for q, at in _by_part(_range_of(keys, n), n))),
                _rows(_FEW - level, [(p, None, few.tobytes())]), along])
        return store

    def store_before(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        p = key[0].as_py()
        store_spread(table, 2, p)
        (ids,), before = _merged(_of_level(table, 1), [kind])
        total = np.zeros(sizes[p], np.int64)
        total[ids.astype(np.int64) - bases[p]] = before
        _store(uri, f"before-{p}", total)
        numbers = np.concatenate([_few(total), _totals(total).sum(axis=0)])
        return pa.concat_tables([_rows(_FEW - 1, [(p, None, numbers.tobytes())]), going_on(table)])

    grouped = slim.mapInArrow(tasks, _COUNTED)
    for level in range(order, 1, -1):
        grouped = grouped.groupBy("part").applyInArrow(store_level(level), _COUNTED)
    few = {level: {} for level in range(1, order + 1)}
    for r in grouped.groupBy("part").applyInArrow(store_before, _COUNTED).collect():
        few[_FEW - r["level"]][r["part"]] = np.frombuffer(r["counts"], np.int64)
    for p in range(n):
        if p not in few[1]:
            _store(uri, f"before-{p}", np.zeros(sizes[p], np.int64))
        for level in range(2, order + 1):
            names = [] if p in few[level] else [f"{x}-{level}-{p}" for x in _STORED]
            for name in names + ([] if p in few[level - 1] else [f"{x}-{level}-{p}" for x in _SPREAD_STORED]):
                _store(uri, name, np.zeros(0, np.int64))
    _ship(spark, uri, [f"{x}-{level}-{p}" for x in _STORED + _SPREAD_STORED for level in range(2, order + 1) for p in range(n)]
          + [f"before-{p}" for p in range(n)])
    number = {level: sum(rows.values()) if rows else np.zeros(8, np.int64) for level, rows in few.items()}
    cuts = {level: discounts(number[level][:4].tolist()) for level in few}
    every, kinds = int(number[1][4]), number[1][5:]
    spread = sum(d * int(k) for d, k in zip(cuts[1][1:], kinds)) / every if every else 1.0
    return Model(uri, order, sizes, hot, begin, tokens, max(0, int(bases[-1]) - (1 if texts else 0)), cuts, every, spread)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, extra columns of ``docs`` but text, n_tokens, n_known, base_score, score) of every row."""
    keep = [c for c in docs.columns if c != "text"]

    def run(batches):
        words = _Words(model.uri, model.sizes, True)
        levels = {level: _Level(model, level) for level in range(2, model.order + 1)}
        cuts = {level: np.array(d) for level, d in model.discounts.items()}
        floor = model.spread / (model.distinct + 1)
        for part in textbuf.chunks(batches):
            keys, off = _tokens(part)
            ids = words.ids(keys)
            columns = _ngrams(ids, off, model.begin if model.tokens else -1, model.order)
            known = ids >= 0
            seen, chance = np.zeros(len(ids), np.int64), np.full(len(ids), floor)
            seen[known] = words.look(words.counts, ids[known])
            if model.continuations:
                c = words.look(words.before, ids[known])
                chance[known] += np.maximum(c - cuts[1][np.minimum(c, 3)], 0) / model.continuations
            for level, stored in levels.items():
                own = columns[-level:]
                at = np.flatnonzero(np.logical_and.reduce([c >= 0 for c in own[:-1]]))
                count, total = stored.look([c[at] for c in own])
                there = total[:, 0] > 0
                at, count, total = at[there], count[there], total[there]
                cut_off = cuts[level]
                chance[at] = (np.maximum(count - cut_off[np.minimum(count, 3)], 0) + total[:, 1:] @ cut_off[1:] * chance[at]) / total[:, 0]
            base = np.log10((seen + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
            first = off[:-1]
            out = {c: part.column(c) for c in keep} | {
                "n_tokens": pa.array(np.diff(off)), "n_known": pa.array(np.add.reduceat((seen > 0).astype(np.int64), first)),
                "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(np.add.reduceat(np.log10(chance), first))}
            yield pa.RecordBatch.from_pydict(out)

    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != "text")
    return docs.mapInArrow(run, f"{kinds}, n_tokens long, n_known long, base_score double, score double")


def held_out(id: str, folds: int, fold: int):
    """True for rows whose crc32 of the id as text leaves ``fold``; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % folds == fold, F.lit(False))


def score_held_out(docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Score every row by a model of those that are not held out (one in five by id)."""
    rows = docs.select(F.col(id), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("held_out", held_out(id, 5, 1))
    model = train(rows.filter(~F.col("held_out")), order=order)
    try:
        scored = cut(score(rows, model))
    finally:
        model.delete()
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
