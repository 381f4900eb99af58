"""Removal of byte strings of ``LENGTH`` that also start in an earlier document.

Suffixes are compared in shards, each with its own suffix array, and shards are
merged by binary search on sorted keys:

1. Documents are dealt to blocks. In a block, each string of LENGTH bytes has a
   key: the smallest hash of the GRAM-byte strings in it. Neighbouring strings
   share keys, so a block of n bytes has about n / 16 of them.
2. Keys are merged per key range: the sorted keys of all blocks, a key once per
   block, give those that occur in two documents (binary search per block).
3. A block sends the runs of strings under such keys, each text once with its
   smallest document, to the shard of the key. Equal strings have equal keys, so
   they meet in one shard. Of a key with HEAVY runs (a frequent phrase among
   differing neighbours), each string goes by its own hash, so the key spreads over
   all shards.
4. A shard builds the suffix array of its runs by Larsson-Sadakane refinement:
   ranks of 5, 10, 20, 40 bytes by doubling, then LENGTH; only positions that still
   share a rank are sorted again. Neighbours with a common prefix of LENGTH
   bytes form a group, whose smallest document goes back to the blocks.
5. Blocks mark the strings with a smaller document and cut the bytes they cover.

Every message is per block, not per document: a passage that a third of all
documents hold is one entry per block. Documents are shuffled once; the three
steps that read them share that exchange.

Cases: null text is empty; a null id neither removes nor loses bytes; rows with
one id never remove each other's bytes; texts under LENGTH bytes stay whole; a
document longer than a chunk is handled alone; an empty table stays empty; other
columns are not read."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbuf

LENGTH = 50
GRAM = 20
#: Text bytes that one block should hold.
BLOCK_BYTES = 12 << 20
#: Shards per block, so that the arrays of a shard stay within some 100 MB.
SHARDS = 16
#: Runs of one key from which its strings are dealt one by one.
HEAVY = 1 << 15
U64 = np.uint64


def runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of strings, key and row of each run of strings with one key.

    A run of m strings covers m + LENGTH - 1 bytes and stays in its row."""
    n = len(data) - LENGTH + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none.astype(U64), none
    low = textbuf.window_hash(data, GRAM)
    span, size = LENGTH - GRAM + 1, 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[:len(low) - (span - size)], low[span - size:])
    inside = np.zeros(n + 1, np.int8)  # strings that do not cross the end of their row
    size_of = np.diff(off)
    long = size_of >= LENGTH
    np.add.at(inside, off[:-1][long], 1)
    np.add.at(inside, off[1:][long] - LENGTH + 1, -1)
    inside = np.cumsum(inside[:n], dtype=np.int8).astype(bool)
    begin = inside.copy()
    begin[1:] &= (low[1:] != low[:-1]) | ~inside[:-1]
    begin[off[:-1][long]] = True
    start = np.flatnonzero(begin)
    row = np.searchsorted(off, start, side="right") - 1
    stop = np.append(start[1:], n)
    stop = np.minimum(stop, off[row + 1] - LENGTH + 1)
    return start, stop - start, textbuf.mix(low[start] ^ U64(textbuf.BASE)), row


def _least(key: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Each key once, with its smallest and largest id and the place of one occurrence."""
    if not len(key):
        return key, low, high, np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first), order[first]


def _route(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> U64(32)) * U64(n)) >> U64(32)


def _u64(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), U64)


def _pieces(table: pa.Table):
    for part in textbuf.chunks(table.to_batches()):
        data, off = textbuf.buffers(part.column("text"))
        yield np.asarray(part.column("doc_id")), data, off


TWO = 128


def _block_keys(n: int):
    """Step 1: the keys of a block, sorted, per key range, with a byte each: TWO if two documents of the block
    hold it, and the power of two in its number of runs."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = []
        for ids, data, off in _pieces(table):
            _, _, keys, row = runs(data, off)
            every = np.sort(keys)
            edge = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
            parts.append((*_least(keys, ids[row], ids[row])[:3], np.diff(np.append(edge, len(every)))))
        every, low, high, times = (np.concatenate([p[j] for p in parts]) for j in range(4))
        keys, low, high, _ = _least(every, low, high)
        runs_of = np.bincount(np.searchsorted(keys, every), times, len(keys)).astype(np.int64)
        to = _route(keys, n)
        cut = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
        ends = np.append(cut[1:], len(to))
        two = (np.where(high > low, TWO, 0) + np.floor(np.log2(np.maximum(runs_of, 1)))).astype(np.uint8)
        return pa.table({"part": pa.array(to[cut].astype(np.int64)), "block": pa.array(np.full(len(cut), key[0].as_py(), np.int64)),
                         "keys": pa.array([keys[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
                         "two": pa.array([two[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())})
    return run


def _merge_keys(table: pa.Table) -> pa.Table:
    """Step 2: of each block's keys in this range, those that two documents hold, and which of them are heavy."""
    lists = [np.frombuffer(x, U64) for x in table.column("keys").to_pylist()]
    every = np.concatenate(lists)
    two = np.frombuffer(b"".join(table.column("two").to_pylist()), np.uint8)
    found = every.copy()
    every.sort()
    again = every[1:][every[1:] == every[:-1]]
    again = np.unique(np.concatenate([again, found[two >= TWO]]))
    at = np.searchsorted(again, found)
    at[at == len(again)] = 0
    held = again[at] == found if len(again) else np.zeros(len(found), bool)
    heavy = np.bincount(at[held], 2.0 ** (two[held] % TWO), len(again)) >= HEAVY
    blocks, kept, split = [], [], []
    for block, keys in zip(table.column("block").to_pylist(), lists):
        at = np.searchsorted(keys, again)
        at[at == len(keys)] = 0
        own = keys[at] == again if len(keys) else np.zeros(len(again), bool)
        mine = again[own]
        if len(mine):
            blocks.append(block)
            kept.append(mine.tobytes())
            split.append(again[own & heavy].tobytes())
    return pa.table({"block": pa.array(blocks, pa.int64()), "keys": pa.array(kept, pa.binary()), "heavy": pa.array(split, pa.binary())})


def _block_runs(n: int):
    """Step 3: texts of the runs under shared keys, each once per block, by shard."""
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, shared: pa.Table) -> pa.Table:
        wanted = np.sort(_u64(shared.column("keys"))) if shared.num_rows else np.zeros(0, U64)
        heavy = np.sort(_u64(shared.column("heavy"))) if shared.num_rows else np.zeros(0, U64)
        parts, bodies, at = [], [], 0
        for ids, data, off in _pieces(docs) if len(wanted) else ():
            start, many, keys, row = runs(data, off)
            hit = np.searchsorted(wanted, keys)
            hit[hit == len(wanted)] = 0
            use = np.flatnonzero(wanted[hit] == keys)
            start, many, keys, row = start[use], many[use], keys[use], row[use]
            single = np.isin(keys, heavy)
            if single.any():  # strings of heavy keys become runs of one string
                each = np.where(single, many, 1)
                one = np.repeat(np.arange(len(start)), each)
                start = start[one] + np.arange(len(one)) - np.repeat(np.cumsum(each) - each, each)
                many, keys, row, single = np.where(single, 1, many)[one], keys[one], row[one], single[one]
            size = many + LENGTH - 1
            name = textbuf.span_hash(data, start, start + size)
            keys = np.where(single, textbuf.mix(name ^ U64(textbuf.BASE)), keys)
            name, low, high, first = _least(name, ids[row], ids[row])
            size, begin, keys = size[first], start[first], keys[first]
            place = np.cumsum(size) - size
            bodies.append(data[np.repeat(begin - place, size) + np.arange(size.sum())])
            parts.append((name, low, high, keys, size, place + at))
            at += int(size.sum())
        out = {"shard": [], "sizes": [], "low": [], "two": [], "body": []}
        if parts:
            name, low, high, keys, size, place = (np.concatenate([p[j] for p in parts]) for j in range(6))
            body = np.concatenate(bodies)
            name, low, high, first = _least(name, low, high)
            keys, size, place = keys[first], size[first], place[first]
            to = _route(keys, n)
            order = np.argsort(to, kind="stable")
            edge = np.flatnonzero(np.append(True, to[order][1:] != to[order][:-1])) if len(order) else []
            for group in np.split(order, edge[1:]) if len(order) else ():
                own = size[group]
                shift = np.cumsum(own) - own
                out["shard"].append(int(to[group[0]]))
                out["sizes"].append(own.astype(np.int32).tobytes())
                out["low"].append(low[group].astype(np.int64).tobytes())
                out["two"].append((high[group] > low[group]).astype(np.uint8).tobytes())
                out["body"].append(body[np.repeat(place[group] - shift, own) + np.arange(own.sum())].tobytes())
        kinds = {"shard": pa.int64()}
        table = {k: pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()}
        return pa.table(table | {"block": pa.array(np.full(len(out["shard"]), key[0].as_py(), np.int64))})
    return run


def _sorted(key: np.ndarray, bits: int) -> np.ndarray:
    """Places of the keys (of at most ``bits`` bits) in order; key and place sort as one number if they fit."""
    place = len(key).bit_length()
    if bits + place > 64:
        return np.argsort(key)
    packed = np.sort((key << U64(place)) | np.arange(len(key), dtype=U64))
    return (packed & U64((1 << place) - 1)).astype(np.int64)


def refine(data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions with LENGTH bytes left in their run that share them with another, in suffix order,
    and where a new group of equal strings begins."""
    end = np.cumsum(size)
    left = (np.repeat(end, size) - np.arange(len(data))).astype(np.int32)  # bytes to the end of the run
    have = 5  # bytes that one sort takes at first: 40 bits leave room for the place
    padded = np.concatenate([data, np.zeros(have, np.uint8)])
    word = np.zeros(len(data), U64)
    for j in range(have):
        word = (word << U64(8)) | padded[j:j + len(data)]
    order = np.flatnonzero(left >= have)
    word = word[order]
    sort = _sorted(word, 8 * have)
    order, word = order[sort], word[sort]
    new = np.append(True, word[1:] != word[:-1]) if len(order) else np.zeros(0, bool)
    del word, sort
    rank = np.zeros(len(data), np.int32)
    bits = len(data).bit_length()

    def settle(order, new, base):
        """Ranks are places of groups in the whole order; members of groups of one leave."""
        first = np.flatnonzero(new)
        rank[order] = np.repeat(base[first], np.diff(np.append(first, len(order))))
        alone = new & np.append(new[1:], True)
        return order[~alone], new[~alone], base[~alone]

    order, new, base = settle(order, new, np.arange(len(order), dtype=np.int32))
    while have < LENGTH and len(order):
        step = min(have, LENGTH - have)  # the last step overlaps
        longer = left[order] >= have + step
        order, base = order[longer], base[longer]
        key = (rank[order].astype(U64) << U64(bits)) | rank[order + step].astype(U64)
        sort = _sorted(key, 2 * bits)
        order, key = order[sort], key[sort]  # groups stay where they are, so their places do
        new = np.append(True, key[1:] != key[:-1]) if len(order) else np.zeros(0, bool)
        have += step
        order, new, base = settle(order, new, base)
    if have < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    return order, new


def _shard(table: pa.Table) -> pa.Table:
    """Step 4: smallest document of each string, as stretches of each run that needs them."""
    sizes = [np.frombuffer(x, np.int32) for x in table.column("sizes").to_pylist()]
    size = np.concatenate(sizes).astype(np.int64)
    low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.int64)
    two = np.frombuffer(b"".join(table.column("two").to_pylist()), np.uint8).astype(bool)
    data = np.frombuffer(b"".join(table.column("body").to_pylist()), np.uint8)
    block = np.repeat(np.array(table.column("block").to_pylist(), np.int64), [len(x) for x in sizes])
    run_of = np.repeat(np.arange(len(size), dtype=np.int32), size)
    least = low[run_of]
    order, new = refine(data, size)
    if len(order):
        first = np.flatnonzero(new)
        group = np.minimum.reduceat(least[order], first)
        least[order] = np.repeat(group, np.diff(np.append(first, len(order))))
    begin = np.cumsum(size) - size
    inside = (np.arange(len(data)) - begin[run_of]).astype(np.int32)
    string = inside <= size[run_of] - LENGTH
    need = string & (two[run_of] | (least < low[run_of]))
    edge = need.copy()
    edge[1:] &= ~need[:-1] | (run_of[1:] != run_of[:-1]) | (least[1:] != least[:-1])
    at = np.flatnonzero(edge)
    stop = need.copy()
    stop[:-1] &= ~need[1:] | edge[1:]
    until = np.flatnonzero(stop) + 1
    of = run_of[at]
    sort = np.argsort(block[of], kind="stable")
    at, until, of = at[sort], until[sort], of[sort]
    cut = np.flatnonzero(np.append(True, block[of][1:] != block[of][:-1])) if len(of) else np.zeros(0, np.int64)
    columns = {"names": textbuf.span_hash(data, begin[of], begin[of] + size[of]), "first": inside[at].astype(np.int64), "many": (until - at).astype(np.int64), "low": least[at].astype(np.int64)}
    ends = np.append(cut[1:], len(of))
    return pa.table({"block": pa.array(block[of][cut])} | {
        k: pa.array([v[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()) for k, v in columns.items()})


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _clean(docs: pa.Table, found: pa.Table) -> pa.Table:
    """Step 5: the bytes of each document of the block that no marked string covers."""
    heavy = _u64(found.column("heavy").drop_null()) if found.num_rows else np.zeros(0, U64)
    found = found.filter(found.column("names").is_valid())
    if found.num_rows:
        name = _u64(found.column("names"))
        first, many, low = (np.frombuffer(b"".join(found.column(c).to_pylist()), np.int64) for c in ("first", "many", "low"))
        order = np.argsort(name, kind="stable")
        name, first, many, low = name[order], first[order], many[order], low[order]
    else:
        name, first = np.zeros(0, U64), np.zeros(0, np.int64)
    out = []
    for ids, data, off in _pieces(docs):
        cover = np.zeros(len(data) + 1, np.int32)
        if len(name):
            start, count, key, row = runs(data, off)
            own = textbuf.span_hash(data, start, start + count + LENGTH - 1)
            a, b = np.searchsorted(name, own, "left"), np.searchsorted(name, own, "right")
            hit = np.flatnonzero(b > a)
            each = (b - a)[hit]
            at = np.repeat(a[hit], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            run = np.repeat(hit, each)
            mark = low[at] < ids[row[run]]
            at, run = at[mark], run[mark]
            inner = np.flatnonzero((count > 1) & np.isin(key, heavy))
            if len(inner):
                each = count[inner]
                place = np.repeat(start[inner] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                own = textbuf.span_hash(data, place, place + LENGTH)
                hit = np.searchsorted(name, own)
                hit[hit == len(name)] = 0
                place = place[(name[hit] == own) & (low[hit] < ids[np.repeat(row[inner], each)])]
                np.add.at(cover, place, 1)
                np.add.at(cover, place + LENGTH, -1)
            np.add.at(cover, start[run] + first[at], 1)
            np.add.at(cover, start[run] + first[at] + many[at] + LENGTH - 1, -1)
        gone = np.cumsum(cover[:-1]) > 0
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        begins = off[:-1][off[:-1] < off[1:]]
        edge[begins] = gone[begins]
        removed = np.append(0, np.cumsum(gone))
        spans = np.append(0, np.cumsum(edge))
        kept, to = data[~gone], off - removed[off]
        out.append(pa.table({
            "doc_id": pa.array(ids), "n_bytes": pa.array(np.diff(off)), "n_removed": pa.array(np.diff(removed[off])),
            "n_spans": pa.array(np.diff(spans[off])),
            "kept": pa.array([kept[a:b].tobytes() for a, b in zip(to[:-1], to[1:])], pa.binary())}))
    return pa.concat_tables(out)


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` holds the bytes that stay."""
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    known = slim.filter("doc_id is not null").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n)))
    blocks = known.groupBy("block")
    keys = blocks.applyInArrow(_block_keys(n), "part long, block long, keys binary, two binary")
    shared = keys.groupBy("part").applyInArrow(_merge_keys, "block long, keys binary, heavy binary")
    sent = blocks.cogroup(shared.groupBy("block")).applyInArrow(
        _block_runs(n * SHARDS), "shard long, sizes binary, low binary, two binary, body binary, block long")
    found = sent.groupBy("shard").applyInArrow(_shard, "block long, names binary, first binary, many binary, low binary")
    none = F.lit(None).cast("binary")
    marks = found.withColumn("heavy", none).unionAll(shared.filter(F.octet_length("heavy") > 0).select(
        "block", *(none.alias(c) for c in ("names", "first", "many", "low")), "heavy"))
    clean = blocks.cogroup(marks.groupBy("block")).applyInArrow(_clean, _RESULT)
    whole = slim.filter("doc_id is null").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                                 F.lit(0).cast("long").alias("n_spans"), F.encode("text", "utf-8").alias("kept"))
    return clean.unionAll(whole).withColumnRenamed("doc_id", id)
