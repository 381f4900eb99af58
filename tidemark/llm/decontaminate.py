"""Benchmark passages in documents, with a bounded number of edits.

1. Texts and items are normalized: lower case, runs of white space as one blank.
2. Documents' q-grams are looked up in the sorted q-gram hashes of the benchmark
   (a bitmap first). A hit is an item and a diagonal, its place in the document
   less its place in the item.
3. Diagonals are counted in overlapping bands, each twice as wide as the edit
   budget. By the q-gram lemma an occurrence with k edits keeps at least
   m + 1 - q (k + 1) of the item's m + 1 - q q-grams, all within k diagonals and so
   inside one band. Bands with that many distinct item positions are kept.
4. A kept region is verified by banded alignment: the item against the best
   substring of the region, only within the band's diagonals.

The budget is ``RATE`` of the item's length, rounded down, so items under 20 characters
must occur as they are. q is 12; for the shortest items with an edit, of 20 to 23
characters, the bound would not be positive, and q is 8.

Q-grams that more than ``COMMON`` places of the benchmark share are left out as long as the
item's bound stays positive without them, the most frequent first, and the bound is lowered
by their number: an occurrence keeps the rest of them all the same.

The benchmark's items go to the tasks with the job while they have at most
``BLOCK_CHARS`` characters together; this size is counted first. A larger benchmark
is written by Spark in blocks of about that size, by a hash of its items, to the
shared folder, where it stays as long as checkpoints do. Tasks hold up to
``HELD_BYTES`` of documents and take these through block after block, so the
documents are read once, a task holds one block's index and the driver no items.

Cases: null and empty texts and items contain nothing and match nothing; a null
item id or document id stays null in the result; repeated rows match each; an
item longer than a document can't occur in it; an empty table gives an empty
result; other columns are not read."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbuf
from tidemark.session import shared_dir

Q = 12
SMALL_Q = 8
RATE = 0.05
COMMON = 32
BLOCK_CHARS = 4_000_000
HELD_BYTES = 32 << 20
_BITS = 22
U64 = np.uint64
SCHEMA = "doc_id long, item_id long, start long, end long, edits long"


def normalize(text: str | None) -> str:
    """Lower case with single blanks."""
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    """Edits that an occurrence of an item may have."""
    return int(RATE * length)


def gram(length: int) -> int:
    """Length of an item's q-grams, such that an occurrence within the budget keeps at least one."""
    return Q if length + 1 - Q * (budget(length) + 1) > 0 else SMALL_Q


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best substring of ``text`` for ``item``, over the diagonals
    low..high (text place less item place); None beyond ``limit`` edits."""
    width = high - low + 1
    far = np.int32(1 << 20)
    slots = np.arange(width, dtype=np.int32)
    n, m = len(text), len(item)
    place = low + slots  # text place of each slot before the first item character
    cost = np.where((place >= 0) & (place <= n), 0, far).astype(np.int32)
    start = place.astype(np.int32)
    for i in range(m):
        at = place + i  # text character that a match on each diagonal uses
        good = (at >= 0) & (at < n)
        char = text[np.clip(at, 0, max(n - 1, 0))] if n else np.zeros(width, text.dtype)
        match = np.where(good, cost + (char != item[i]), far)
        skip = np.append(cost[1:], far) + 1  # item character without partner
        took = skip < match
        new = np.where(took, skip, match).astype(np.int32)
        begin = np.where(took, np.append(start[1:], 0), start)
        # text characters without partner: the smallest cost to the left plus the distance
        level = new - slots
        low_level = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == low_level, slots, 0))
        new, begin = low_level + slots, begin[source]
        new[(at + 1 > n) | (at + 1 < 0)] = far
        cost, start = new, begin
        if cost.min() > limit:
            return None
    best = int(cost.argmin())
    return int(cost[best]), int(start[best]), int(place[best] + m)


class Index:
    """Sorted q-gram hashes of a block of items, with item and place of each."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q):
        self.q = q
        self.ids = [i for i, _ in items]
        self.texts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for _, t in items]
        self.plain = [t for _, t in items]
        self.budget = np.array([budget(len(t)) for t in self.texts], np.int64)
        self.length = np.array([len(t) for t in self.texts], np.int64)
        hashes = [textbuf.window_hash(t, q) for t in self.texts]
        item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.zeros(0, np.int64)
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, U64)
        order = np.argsort(hashes, kind="stable")
        self.hash, self.item, self.place = hashes[order], item[order], place[order]
        self.need = np.maximum(self.length + 1 - q * (self.budget + 1), 1)
        self._leave_out()
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[self.hash >> U64(64 - _BITS)] = True
        self.short = [(j, t) for j, t in enumerate(self.plain) if 0 < len(t) < q]

    def _leave_out(self) -> None:
        """Drop common q-grams, the most frequent of each item first, while its bound stays at one or more."""
        if not len(self.hash):
            return
        first = np.flatnonzero(np.append(True, self.hash[1:] != self.hash[:-1]))
        many = np.repeat(np.diff(np.append(first, len(self.hash))), np.diff(np.append(first, len(self.hash))))
        order = np.lexsort((-many, self.item))
        item = self.item[order]
        begin = np.searchsorted(item, np.arange(len(self.need)))
        out = (many[order] > COMMON) & (np.arange(len(order)) - begin[item] < self.need[item] - 1)
        self.need = self.need - np.bincount(item[out], minlength=len(self.need))
        keep = np.ones(len(order), bool)
        keep[order[out]] = False
        self.hash, self.item, self.place = self.hash[keep], self.item[keep], self.place[keep]

    def regions(self, codes: np.ndarray, off: np.ndarray):
        """(row, item, lowest diagonal) of bands with enough shared q-grams; codes of rows one after another."""
        hashes = textbuf.window_hash(codes, self.q)
        at = np.flatnonzero(self.bitmap[hashes >> U64(64 - _BITS)])
        if not len(at):
            return []
        lo, hi = np.searchsorted(self.hash, hashes[at], "left"), np.searchsorted(self.hash, hashes[at], "right")
        each = hi - lo
        at = np.repeat(at, each)
        entry = np.repeat(lo - (np.cumsum(each) - each), each) + np.arange(each.sum())
        row = np.searchsorted(off, at, side="right") - 1
        inside = at + self.q <= off[row + 1]
        at, entry, row = at[inside], entry[inside], row[inside]
        item, place = self.item[entry], self.place[entry]
        diagonal = at - off[row] - place + (1 << 20)
        width = 2 * self.budget[item] + 1  # bands begin every k + 1 diagonals and are 2k + 1 wide
        step = self.budget[item] + 1
        band = diagonal // step
        both = diagonal - (band - 1) * step < width
        row, item = np.append(row, row[both]), np.append(item, item[both])
        band, place = np.append(band, band[both] - 1), np.append(place, place[both])
        order = np.lexsort((place, band, item, row))
        row, item, band, place = row[order], item[order], band[order], place[order]
        new = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])) if len(row) else np.zeros(0, bool)
        other = new | np.append(True, place[1:] != place[:-1]) if len(row) else new
        first = np.flatnonzero(new)
        count = np.add.reduceat(other.astype(np.int64), first) if len(first) else first
        keep = first[count >= self.need[item[first]]]
        return [(int(r), int(j), int(b * (self.budget[j] + 1) - (1 << 20))) for r, j, b in zip(row[keep], item[keep], band[keep])]


def _indexes(items: list[tuple[int | None, str]]) -> list[Index]:
    """One index for each length of q-grams that the items have."""
    sizes = sorted({gram(len(t)) for _, t in items})
    return [Index([x for x in items if gram(len(x[1])) == q], q) for q in sizes]


def _matches(index: Index, texts: list[str]):
    """(row, item, start, end, edits) of verified occurrences, the best of each row, item and place."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    off = np.append(0, np.cumsum([len(c) for c in codes]))
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for row, j, low in index.regions(np.concatenate(codes) if codes else np.zeros(0, "<u4"), off):
        k, m = int(index.budget[j]), int(index.length[j])
        at = texts[row].find(index.plain[j], max(0, low), max(0, low + 2 * k) + m)
        best = (0, at, at + m) if at >= 0 else align(index.texts[j], codes[row], low - k, low + 3 * k, k)
        if best:
            found.setdefault((row, j), []).append(best)
    for j, item in index.short:
        for row, text in enumerate(texts):
            at = text.find(item)
            while at >= 0:
                found.setdefault((row, j), []).append((0, at, at + len(item)))
                at = text.find(item, at + len(item))
    for (row, j), hits in found.items():
        taken: list[tuple[int, int]] = []
        for edits, start, end in sorted(hits):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                yield row, j, start, end, edits


class _Blocks:
    """The items of a benchmark, normalized, in blocks that fit a task: one that goes with the job,
    or several in files of the shared folder."""

    def __init__(self, benchmark: DataFrame, item: str, item_text: str):
        items = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).alias("text")).filter("length(trim(text)) > 0").distinct()
        size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
        self.n = -(-size // BLOCK_CHARS)
        self.own = [tuple(r) for r in items.orderBy("item_id", "text").collect()] if self.n == 1 else None
        self.held = HELD_BYTES if self.n > 1 else 0
        if self.n > 1:
            self.uri = f"{shared_dir(benchmark.sparkSession).rstrip('/')}/tidemark-items-{uuid.uuid4().hex[:12]}"
            block = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n))
            items.withColumn("block", block).repartition(F.col("block")).write.partitionBy("block").parquet(self.uri)

    def _items(self, block: int) -> list[tuple[int | None, str]]:
        if self.own is not None:
            return self.own
        where, base = fs.FileSystem.from_uri(self.uri)
        folder = f"{base}/block={block}"
        if where.get_file_info(folder).type == fs.FileType.NotFound:  # no item has this hash
            return []
        files = [f.path for f in where.get_file_info(fs.FileSelector(folder)) if f.path.endswith(".parquet")]
        rows = [r for f in files for r in pq.ParquetFile(where.open_input_file(f)).read(["item_id", "text"]).to_pylist()]
        return sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r))

    def indexes(self, block: int) -> list[Index]:
        return _indexes([(i, normalize(t)) for i, t in self._items(block)])

    def matches(self, batches, column: str):
        """(rows of documents, matches in them as (row, item id, start, end, edits)), in the order of the rows."""
        ready = self.indexes(0) if self.n == 1 else None
        for held in _held(batches, column, self.held):
            texts = [[normalize(t) for t in part.column(column).to_pylist()] for part in held]
            found = [[] for _ in held]
            for block in range(self.n):
                for index in ready or self.indexes(block):
                    for own, of_part in zip(found, texts):
                        own.extend((r, index.ids[j], *place) for r, j, *place in _matches(index, of_part))
            yield from zip(held, found)


def _held(batches, column: str, limit: int):
    """Lists of chunks of rows with about ``limit`` bytes of text, one chunk at least."""
    held, size = [], 0
    for part in textbuf.chunks(batches, column):
        held.append(part)
        size += part.column(column).nbytes
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def occurrences(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
                item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end, edits) of each occurrence; places count characters of the normalized text."""
    blocks = _Blocks(benchmark, item, item_text)

    def run(batches):
        for part, found in blocks.matches(batches, "text"):
            if found:
                ids = part.column("doc_id").to_pylist()
                rows = [(ids[r], *rest) for r, *rest in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "item_id", "start", "end", "edits"])

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows of ``docs`` in which no benchmark item occurs, with all their columns; no shuffle."""
    blocks = _Blocks(benchmark, item, item_text)

    def run(batches):
        for part, found in blocks.matches(batches, text):
            dirty = np.zeros(part.num_rows, bool)
            dirty[[r for r, *_ in found]] = True
            yield part.filter(pa.array(~dirty))

    return docs.mapInArrow(run, docs.schema)
