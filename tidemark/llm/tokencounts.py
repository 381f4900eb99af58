"""Token counts that survive edits without counting the whole text again.

A document is kept as leaves, stretches of whole pre-tokens, under a segment
tree that sums their characters and tokens. A leaf starts at a blank or line
break after a visible character: there the pre-tokenizer always begins a new
piece, whatever stands around, so the tokens of a text are the sum over its
leaves. An edit finds its leaves by the character sums, takes the neighbours in
whose first or last character it touches as context, encodes that stretch anew
into as many leaves as before, and updates the sums on the way to the root. Only
when a stretch has outgrown its leaves is the tree built anew.

State and edits are columns of one row per document, so counting and editing
need no shuffle; ``with_edits`` joins edits that come as a table.

Cases: null and empty texts have no leaf and 0 tokens; edits of one document
apply in their order, each to the text as the ones before left it, with places
beyond the end moved to the end; null edits, places and strings count as none,
0 and empty; rows with one id have their own state; an empty table stays empty;
other columns pass through ``count_tokens`` and are not read otherwise."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbuf, vocabulary

#: Characters that a leaf should have; twice as many make the tree grow.
LEAF = 512

EDITS = "array<struct<pos:int,remove:int,insert:string>>"
STATE = "leaves array<string>, chars array<long>, tokens array<long>"


def cuts(text: str) -> list[int]:
    """Places of ``text`` where a leaf may begin, besides 0."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(c) < 2:
        return []
    before, at = c[:-1], c[1:]
    visible = ((before >= 33) & (before < 127)) | ((before >= 0xC0) & (before < 0x1680)) | ((before >= 0x3001) & (before < 0xD800))
    return (np.flatnonzero(visible & ((at == 32) | (at == 10))) + 1).tolist()


def pieces(text: str, size: int = LEAF, number: int | None = None) -> list[str]:
    """``text`` in leaves of about ``size`` characters, or in exactly ``number`` leaves (empty ones last)."""
    places = cuts(text)
    if number is not None:
        size = max(1, -(-len(text) // number))
    out, begin, at = [], 0, 0
    while places and (number is None or len(out) < number - 1):
        at = int(np.searchsorted(places, begin + size))
        if at >= len(places):
            break
        out.append(text[begin:places[at]])
        begin = places[at]
        places = places[at:]
    if begin < len(text) or (number and len(out) < number):
        out.append(text[begin:])
    return out + [""] * ((number or 0) - len(out))


class Tree:
    """Leaves with their sums of characters and tokens; node 1 is the root, node i has 2i and 2i + 1."""

    def __init__(self, leaves: list[str], count, sums: tuple[list[int], list[int]] | None = None):
        self.leaves, self.count, self.encoded = leaves, count, 0
        if sums:
            self.chars, self.tokens = sums
        else:
            self.build()

    def build(self):
        n = len(self.leaves)
        self.chars = [0] * n + [len(x) for x in self.leaves]
        self.tokens = [0] * n + [self.encode(x) for x in self.leaves]
        for i in range(n - 1, 0, -1):
            self.add(i)

    def encode(self, text: str) -> int:
        self.encoded += len(text)
        return self.count(text)

    def add(self, i: int):
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def total(self) -> int:
        return sum(self.tokens[i] for i in self.roots())

    def length(self) -> int:
        return sum(self.chars[i] for i in self.roots())

    def roots(self) -> list[int]:
        return [1] if len(self.leaves) > 1 else [len(self.leaves)] if self.leaves else []

    def order(self) -> list[int]:
        """Nodes whose leaves, one after another, are all leaves in text order (the heap wraps around)."""
        n = len(self.leaves)
        left, right, lo, hi = [], [], n, 2 * n
        while lo < hi:
            if lo & 1:
                left.append(lo)
                lo += 1
            if hi & 1:
                hi -= 1
                right.append(hi)
            lo, hi = lo >> 1, hi >> 1
        return left + right[::-1]

    def find(self, pos: int) -> tuple[int, int]:
        """Leaf that holds character ``pos`` and the character at which it begins."""
        n, begin = len(self.leaves), 0
        for node in self.order():
            if pos < begin + self.chars[node]:
                while node < n:
                    node *= 2
                    if pos >= begin + self.chars[node]:
                        begin += self.chars[node]
                        node += 1
                return node - n, begin
            begin += self.chars[node]
        return n - 1, begin - len(self.leaves[-1])

    def edit(self, pos: int, remove: int, insert: str):
        length = self.length()
        pos = min(max(pos, 0), length)
        end = min(pos + max(remove, 0), length)
        if not self.leaves:
            self.leaves = pieces(insert)
            return self.build()
        first, begin = self.find(max(pos - 1, 0))  # context: the characters next to the edit
        last = self.find(min(end, length - 1))[0] if length else first
        whole = "".join(self.leaves[first:last + 1])
        text = whole[:pos - begin] + insert + whole[end - begin:]
        number = last - first + 1
        if len(text) > 2 * LEAF * number:
            new = pieces(text)
            self.leaves[first:last + 1] = new
            return self.grow(first, len(new), number)
        for i, leaf in enumerate(pieces(text, number=number)):
            self.leaves[first + i] = leaf
            self.chars[len(self.leaves) + first + i] = len(leaf)
            self.tokens[len(self.leaves) + first + i] = self.encode(leaf)
        nodes = {len(self.leaves) + i for i in range(first, last + 1)}
        while nodes := {i >> 1 for i in nodes if i > 1} - {0}:
            for i in nodes:
                self.add(i)

    def grow(self, first: int, new: int, old: int):
        """A new tree with ``new`` leaves in place of ``old`` ones; sums of all other leaves are kept."""
        n = len(self.leaves)
        before = n - new + old
        counts = self.tokens[before:]
        counts[first:first + old] = [self.encode(x) for x in self.leaves[first:first + new]]
        self.chars = [0] * n + [len(x) for x in self.leaves]
        self.tokens = [0] * n + counts
        for i in range(n - 1, 0, -1):
            self.add(i)


def _tree(text: str | None, count) -> Tree:
    return Tree(pieces(text) if text else [], count)


def _counter(path: str):
    ids = vocabulary.reader(path)
    return lambda text: len(ids(text)) if text else 0


def _column(docs: DataFrame, names: list[str]) -> str:
    kinds = dict(docs.dtypes)
    return "".join(f"`{c}` {kinds[c]}, " for c in names)


def build(docs: DataFrame, text: str = "text", path: str = vocabulary.DEFAULT) -> DataFrame:
    """``docs`` without ``text``, with its state (leaves and the two sums per node) and n_tokens."""
    keep = [c for c in docs.columns if c != text and c not in ("leaves", "chars", "tokens", "n_tokens")]

    def run(batches):
        count = _counter(path)
        for part in textbuf.chunks(batches, text):
            trees = [_tree(x, count) for x in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in keep} | {
                "leaves": pa.array([t.leaves for t in trees], pa.list_(pa.string())), "chars": pa.array([t.chars for t in trees], pa.list_(pa.int64())),
                "tokens": pa.array([t.tokens for t in trees], pa.list_(pa.int64())), "n_tokens": pa.array([t.total() for t in trees], pa.int64())})

    return docs.select(*keep, text).mapInArrow(run, _column(docs, keep) + STATE + ", n_tokens long")


def _slices(batches):
    """Slices of the batches with at most CHUNK_BYTES of leaves, or one row."""
    for batch in batches:
        leaves = batch.column("leaves")
        size = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(leaves.values), 0).to_numpy(zero_copy_only=False)))
        ends = size[leaves.offsets.to_numpy()]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + textbuf.CHUNK_BYTES, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def apply_edits(state: DataFrame, edits: str = "edits", path: str = vocabulary.DEFAULT) -> DataFrame:
    """``state`` after the edits of its array column (pos, remove, insert), with n_tokens and the
    number of characters that were encoded again."""
    fixed = ("leaves", "chars", "tokens", "n_tokens", "n_encoded", edits)
    keep = [c for c in state.columns if c not in fixed]

    def run(batches):
        count = _counter(path)
        for batch in _slices(batches):
            out = {k: [] for k in ("leaves", "chars", "tokens", "n_tokens", "n_encoded")}
            for leaves, chars, tokens, own in zip(*(batch.column(c).to_pylist() for c in ("leaves", "chars", "tokens", edits))):
                tree = Tree(leaves or [], count, (chars or [], tokens or []))
                for e in own or ():
                    if e:
                        tree.edit(e["pos"] or 0, e["remove"] or 0, e["insert"] or "")
                for k, v in zip(out, (tree.leaves, tree.chars, tree.tokens, tree.total(), tree.encoded)):
                    out[k].append(v)
            kinds = {"leaves": pa.list_(pa.string()), "chars": pa.list_(pa.int64()), "tokens": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in keep} | {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})

    return state.select(*keep, "leaves", "chars", "tokens", edits).mapInArrow(run, _column(state, keep) + STATE + ", n_tokens long, n_encoded long")


def with_edits(state: DataFrame, edits: DataFrame, id: str = "doc_id") -> DataFrame:
    """``state`` with the rows (id, seq, pos, remove, insert) of ``edits`` as its array column, in order of seq."""
    own = edits.groupBy(id).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "pos", "remove", "insert"))), lambda e: F.struct(
        e["pos"].cast("int").alias("pos"), e["remove"].cast("int").alias("remove"), e["insert"].alias("insert"))).alias("edits"))
    return state.join(own, id, "left")
