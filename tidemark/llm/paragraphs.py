"""Passages that repeat across documents, by paragraph MinHash banding.

Paragraphs are the lines of a text that have words. A passage may also stand inside longer lines, so texts have inner paragraphs too: windows of
``WINDOW_WORDS`` words before and after each anchor. Anchors are the smallest hash
of ``GRAM_WORDS`` words in every ``PASSAGE_WORDS`` words, so any two texts that
share that many words in a row share an anchor and a window at it.

1. Tasks give each paragraph a digest of its words. Occurrences of one digest are
   compared by document id: all but the smallest document's are repeats. A task
   settles what it holds itself and hands on the occurrences in the smallest document
   per digest, so a line that a third of all documents hold is one document's entries
   per task.
2. Lines with a shingle of five words also get keys. Up to ``PREFIX`` shingles these
   are the smallest hashes of the set, as many as it takes for any two sets of the
   similarity to share one (prefix filter, no misses). Longer lines get MinHash bands,
   as many as ``tune`` says for the wanted recall; lines of sizes that can be similar
   across the limit get both. Lines of different words that share a key are candidates.
3. Candidates are verified by exact Jaccard similarity of their five-word shingles
   and clustered by components (minhash.links); of a cluster, the lines of the
   smallest document stay.
4. Inner windows grow, word by word to both sides, to the whole run of words that the
   document shares with the window's smallest document. For this the smallest
   documents' texts are sent once to each part of the documents that repeat them.
5. A document's repeats are merged into spans (bytes of the UTF-8 text), and
   documents are classed by components over shared repeats. An earlier document counts as a
   link if it repeats something that still smaller documents' repeats do not cover, so the
   number depends on what the texts share and not on which windows are anchored where.

A paragraph that repeats only within one document stays. Cases: null and empty
texts have no paragraph; a null id has none that count; rows with one id are one
document; an empty table gives an empty result; other columns are not read."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import minhash, textbuf
from tidemark.llm.shared import NARROW, components, cut

PASSAGE_WORDS = 50
GRAM_WORDS = 8
WINDOW_WORDS = 24
SHINGLE_WORDS = 5
#: Shingles up to which a line's keys are its smallest hashes.
PREFIX = 40
ROWS = 4
MISS = 1e-4
#: Entries that a task holds before it settles them and hands on the rest.
HELD = 1_000_000
PART_BYTES = 48 << 20
U64 = np.uint64


def tune(percent: int, miss: float = MISS, rows: int = ROWS) -> int:
    """Bands of ``rows`` minima with which a pair at the similarity shares none with at most ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _slide(values: np.ndarray, size: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of each ``size`` neighbours."""
    have = 1
    while have * 2 <= size:
        values = best(values[:-have], values[have:])
        have *= 2
    return best(values[:len(values) - (size - have)], values[size - have:]) if size > have else values


def anchors(row: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Places of words where the smallest gram of some PASSAGE_WORDS words of one row begins."""
    if len(word) < PASSAGE_WORDS:
        return np.zeros(0, np.int64)
    gram = textbuf.window_hash(word, GRAM_WORDS) | U64(1)
    span = PASSAGE_WORDS - GRAM_WORDS + 1
    low = _slide(gram, span, np.minimum)
    low = np.where(row[:len(low)] == row[PASSAGE_WORDS - 1:], low, U64(0))
    edge = np.zeros(span - 1, U64)
    return np.flatnonzero(_slide(np.concatenate([edge, low, edge]), span, np.maximum) == gram)


def _lines(data, off, start, row) -> tuple[np.ndarray, np.ndarray]:
    """First word and one past the last of the lines that have words."""
    breaks = np.append(0, np.cumsum(data == 10))
    line = breaks[start]
    new = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (row[1:] != row[:-1]))) if len(start) else np.zeros(0, np.int64)
    return new, np.append(new[1:], len(start)) if len(new) else new


def units(data: np.ndarray, off: np.ndarray):
    """First word, one past the last and whether it is a line, of every paragraph; and the words."""
    start, end, row, word = textbuf.words(data, off)
    a, b = _lines(data, off, start, row)
    at = anchors(row, word)
    after = at[at + WINDOW_WORDS <= len(word)]
    before = at + GRAM_WORDS - WINDOW_WORDS
    before = before[before >= 0]
    w = np.unique(np.concatenate([after, before]))
    w = w[row[w] == row[np.minimum(w + WINDOW_WORDS, len(row)) - 1]] if len(w) else w
    w = w[w + WINDOW_WORDS <= len(word)]
    first, last = np.concatenate([a, w]), np.concatenate([b, w + WINDOW_WORDS])
    return first, last, np.arange(len(first)) < len(a), (start, end, row, word)


def _keys(word, first, last, bands: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the keys of the lines, on shingles of SHINGLE_WORDS words; shorter lines have none."""
    wide = np.flatnonzero(last - first >= SHINGLE_WORDS)
    if not len(wide):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    size = last[wide] - first[wide]
    own = np.repeat(np.arange(len(wide)), size)
    at = np.repeat(first[wide] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    hashes, edge = textbuf.shingles(own, word[at], len(wide), SHINGLE_WORDS)
    line = np.repeat(np.arange(len(wide)), np.diff(edge))
    order = np.lexsort((hashes, line))
    hashes, line = hashes[order], line[order]
    new = np.append(True, (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1]))
    hashes, line = hashes[new], line[new]
    n = np.bincount(line, minlength=len(wide))
    begin = np.cumsum(n) - n
    some = n - (n * percent + 99) // 100 + 1
    short = (n * percent <= PREFIX * 100)[line] & (np.arange(len(line)) - begin[line] < some[line])
    lines, keys = [line[short]], [textbuf.mix(hashes[short] ^ U64(textbuf.BASE))]
    long = np.flatnonzero(n > PREFIX)
    if len(long):
        hashes = hashes[(n > PREFIX)[line]]
        begin = np.cumsum(n[long]) - n[long]
        weight = textbuf.mix(np.arange(1, ROWS + 1, dtype=U64)) | U64(1)
        for j in range(bands):
            total = np.full(len(long), j, U64)
            for r in range(ROWS):
                factor = textbuf.mix(np.array([j * ROWS + r + 1], U64) * U64(textbuf.BASE))[0] | U64(1)
                total += np.minimum.reduceat(hashes * factor, begin) * weight[r]
            lines.append(long)
            keys.append(textbuf.mix(total))
    return wide[np.concatenate(lines)], np.concatenate(keys)


def _part(key: np.ndarray, n: int) -> np.ndarray:
    return (((key >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


#: Record kinds: an occurrence to be settled, a repeat, a band entry, a candidate line,
#: or a digest's smallest document over all tasks.
SEEN, REPEAT, BAND, CANDIDATE, LOW = range(5)
_SCHEMA = "kind int, part long, body binary"
_OCCURRENCE = np.dtype([("digest", "u8"), ("doc", "i8"), ("start", "i4"), ("end", "i4"), ("inner", "?")])
#: digest is 0 for near lines, whose smallest document is known.
_REPEAT = np.dtype([("digest", "u8"), ("doc", "i8"), ("start", "i4"), ("end", "i4"), ("inner", "?"), ("low", "i8")])
_LOW = np.dtype([("digest", "u8"), ("low", "i8")])
_ENTRY = np.dtype([("key", "u8"), ("digest", "u8"), ("doc", "i8"), ("met", "?")])
_LINE = np.dtype([("digest", "u8"), ("doc", "i8")])


def _settle(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all occurrences in the smallest document of each digest; repeats in later documents)."""
    seen = seen[np.lexsort((seen["start"], seen["doc"], seen["digest"]))]
    first = np.append(True, seen["digest"][1:] != seen["digest"][:-1]) if len(seen) else np.zeros(0, bool)
    low = seen["doc"][first][np.cumsum(first) - 1] if len(seen) else seen["doc"]
    again = seen["doc"] > low
    out = np.empty(int(again.sum()), _REPEAT)
    for c in _OCCURRENCE.names:
        out[c] = seen[c][again]
    out["low"] = low[again]
    return seen[~again], out


def _meet(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one entry per band key, marked where different lines met; the lines that met)."""
    entries = entries[np.lexsort((entries["doc"], entries["digest"], entries["key"]))]
    if not len(entries):
        return entries, np.zeros(0, _LINE)
    first = np.flatnonzero(np.append(True, entries["key"][1:] != entries["key"][:-1]))
    size = np.diff(np.append(first, len(entries)))
    met = np.maximum.reduceat(entries["digest"], first) != np.minimum.reduceat(entries["digest"], first)
    met |= np.logical_or.reduceat(entries["met"], first)
    inside = np.repeat(met, size)
    lines = np.empty(int(inside.sum()), _LINE)
    lines["digest"], lines["doc"] = entries["digest"][inside], entries["doc"][inside]
    left = entries[first].copy()
    left["met"] = met
    return left, _first(lines)


def _first(lines: np.ndarray) -> np.ndarray:
    """Each line once, with its smallest document."""
    lines = lines[np.lexsort((lines["doc"], lines["digest"]))]
    return lines[np.append(True, lines["digest"][1:] != lines["digest"][:-1])] if len(lines) else lines


def _rows(kind: int, part: np.ndarray, records: np.ndarray):
    """(kind, part, body) rows of the records, together by part."""
    order = np.argsort(part, kind="stable")
    part, records = part[order], records[order]
    edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
    for a, b in zip(edge, np.append(edge[1:], len(part)) if len(part) else ()):
        yield kind, int(part[a]), records[a:b].tobytes()


def _batch(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], ["kind", "part", "body"])


def _by_id(ids: np.ndarray, n: int) -> np.ndarray:
    return _part(textbuf.mix(ids.view(U64) + U64(textbuf.BASE)), n)


def _scan(n: int, bands: int, percent: int):
    """Steps 1 and 2 in a task."""
    def run(batches):
        seen, entries, size = [], [], 0

        def hand_on():
            left, repeats = _settle(np.concatenate(seen))
            keys, lines = _meet(np.concatenate(entries))
            seen.clear()
            entries.clear()
            yield from _rows(SEEN, _part(textbuf.mix(left["digest"]), n), left)
            yield from _rows(REPEAT, _by_id(repeats["doc"], n), repeats)
            yield from _rows(BAND, _part(keys["key"], n), keys)
            yield from _rows(CANDIDATE, _part(textbuf.mix(lines["digest"]), n), lines)

        for part in textbuf.chunks(batches):
            part = part.filter(part.column("doc_id").is_valid())
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            data, off = textbuf.buffers(part.column("text"))
            first, last, line, (start, end, row, word) = units(data, off)
            if not len(first):
                continue
            own = np.empty(len(first), _OCCURRENCE)
            own["digest"], own["doc"] = textbuf.span_hash(word, first, last), ids[row[first]]
            own["start"], own["end"] = start[first] - off[row[first]], end[last - 1] - off[row[first]]
            own["inner"] = ~line
            seen.append(own)
            of, keys = _keys(word, first[line], last[line], bands, percent)
            held = np.zeros(len(keys), _ENTRY)
            held["key"], held["digest"], held["doc"] = keys, own["digest"][line][of], own["doc"][line][of]
            held = held[np.lexsort((held["doc"], held["digest"], held["key"]))]  # one entry per key and line
            entries.append(held[np.append(True, (held["key"][1:] != held["key"][:-1]) | (held["digest"][1:] != held["digest"][:-1]))] if len(held) else held)
            size += len(own) + len(entries[-1])
            if size > HELD:
                yield _batch(hand_on())
                size = 0
        if size:
            yield _batch(hand_on())
    return run


def _merge(n: int):
    """Steps 1 and 2 over all tasks: the records of one kind and key range."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kind, body = key[0].as_py(), b"".join(table.column("body").to_pylist())
        if kind == SEEN:
            repeats = _settle(np.frombuffer(body, _OCCURRENCE))[1]
            rows = _rows(REPEAT, _by_id(repeats["doc"], n), repeats)
        else:
            lines = _meet(np.frombuffer(body, _ENTRY))[1]
            rows = _rows(CANDIDATE, _part(textbuf.mix(lines["digest"]), n), lines)
        return pa.Table.from_batches([_batch(rows)])
    return run


def _text(batches):
    """The candidate lines of each document: (id, doc_id, start, end, text)."""
    for part in textbuf.chunks(batches):
        data, off = textbuf.buffers(part.column("text"))
        start, end, row, word = textbuf.words(data, off)
        first, last = _lines(data, off, start, row)
        digest = textbuf.span_hash(word, first, last)
        wanted = [np.array(x, np.int64).view(U64) for x in part.column("ids").to_pylist()]
        raw = data.tobytes()
        out = []
        for a, b, h in zip(first, last, digest):
            r = row[a]
            if h in wanted[r]:
                out.append((int(h.view(np.int64)), part.column("doc_id")[r].as_py(), int(start[a] - off[r]), int(end[b - 1] - off[r]), raw[start[a]:end[b - 1]].decode()))
        if out:
            kinds = (pa.int64(),) * 4 + (pa.string(),)
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate(kinds)], ["id", "doc_id", "start", "end", "text"])


def _ends(digest: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which windows are the first or last of a chain of equal ones that overlap; sorted by digest, row and place.

    Within a chain the text is periodic, so its inner windows meet no run that its ends do not."""
    near = (digest[1:] == digest[:-1]) & (row[1:] == row[:-1]) & (at[1:] - at[:-1] < WINDOW_WORDS)
    return ~(np.append(False, near) & np.append(near, False))


def _grow(word: np.ndarray, p: np.ndarray, q: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """Number of equal words, at most ``most``, from the places p and q on, in the direction of ``step``."""
    size, k = np.zeros(len(p), np.int64), 0
    alive = np.flatnonzero(most > 0)
    while len(alive):
        alive = alive[word[p[alive] + step * k] == word[q[alive] + step * k]]
        k += 1
        size[alive] = k
        alive = alive[most[alive] > k]
    return size


def extend(inner: np.ndarray, low: np.ndarray, texts: pa.Table) -> np.ndarray:
    """Repeats of whole runs of words around the ``inner`` repeats; ``low`` names the smallest
    document of their digests (sorted), ``texts`` has the documents of both sides."""
    asked, own = np.unique(inner["digest"]), np.unique(inner["doc"])
    word, start, end, sizes, ids, digest, at = [], [], [], [], [], [], []
    base = 0
    for part in textbuf.chunks(texts.to_batches()):
        data, off = textbuf.buffers(part.column("text"))
        a, b, row, w = textbuf.words(data, off)
        sizes.append(np.bincount(row, minlength=part.num_rows))
        ids.append(part.column("doc_id").to_numpy(zero_copy_only=False))
        word.append(w)
        start.append((a - off[row]).astype(np.int32))
        end.append((b - off[row]).astype(np.int32))
        if len(w) >= WINDOW_WORDS:
            first = np.flatnonzero(row[:len(row) - WINDOW_WORDS + 1] == row[WINDOW_WORDS - 1:])
            h = textbuf.span_hash(w, first, first + WINDOW_WORDS)
            hit = np.isin(h, asked)
            digest.append(h[hit])
            at.append(first[hit] + base)
        base += len(w)
    if not digest:
        return np.empty(0, _REPEAT)
    word, start, end, ids, digest, at = (np.concatenate(x) for x in (word, start, end, ids, digest, at))
    edge = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    row = np.searchsorted(edge, at, side="right") - 1
    order = np.lexsort((at, row, digest))
    digest, row, at = digest[order], row[order], at[order]
    keep = _ends(digest, row, at)
    digest, row, at = digest[keep], row[keep], at[keep]
    least = low["low"][np.searchsorted(low["digest"], digest)]
    ours, theirs = np.flatnonzero((ids[row] > least) & np.isin(ids[row], own)), np.flatnonzero(ids[row] == least)
    ours = ours[np.argsort(row[ours], kind="stable")]
    lo, hi = (np.searchsorted(digest[theirs], digest[ours], side=x) for x in ("left", "right"))
    done, out = np.cumsum(hi - lo), []
    cuts = np.flatnonzero(np.append(True, row[ours][1:] != row[ours][:-1])) if len(ours) else np.zeros(0, np.int64)
    i = 0
    while i < len(cuts):  # documents of about HELD pairs at once
        have = done[cuts[i] - 1] if cuts[i] else 0
        to = max(i + 1, int(np.searchsorted(done[np.append(cuts[i + 1:], len(ours)) - 1], have + HELD, side="right")) + i)
        a, b = cuts[i], cuts[to] if to < len(cuts) else len(ours)
        i = to
        n = hi[a:b] - lo[a:b]
        x = np.repeat(ours[a:b], n)
        y = theirs[np.repeat(lo[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        order = np.lexsort((at[x], at[x] - at[y], row[y], row[x]))
        x, y = x[order], y[order]
        p, q, r, t = at[x], at[y], row[x], row[y]
        # windows of one run need to grow only to the next of them
        same = (r[1:] == r[:-1]) & (t[1:] == t[:-1]) & (p[1:] - q[1:] == p[:-1] - q[:-1])
        gap = np.where(same, np.maximum(p[1:] - p[:-1] - WINDOW_WORDS, 0), len(word))
        left = np.minimum(np.minimum(p - edge[r], q - edge[t]), np.append(len(word), gap)[:len(p)])
        right = np.minimum(np.minimum(edge[r + 1] - p, edge[t + 1] - q) - WINDOW_WORDS, np.append(gap, len(word))[:len(p)])
        left = _grow(word, p - 1, q - 1, left, -1)
        right = _grow(word, p + WINDOW_WORDS, q + WINDOW_WORDS, right, 1)
        grown = np.zeros(len(p), _REPEAT)
        grown["doc"], grown["low"] = ids[r], ids[t]
        grown["start"], grown["end"] = start[p - left], end[p + WINDOW_WORDS + right - 1]
        out.append(grown)
    return np.concatenate(out) if out else np.empty(0, _REPEAT)


def _needed(start: np.ndarray, end: np.ndarray, low: np.ndarray) -> int:
    """Number of documents, smallest first, with a repeat that those before do not cover whole."""
    order = np.lexsort((end, start, low))
    starts: list[int] = []  # what is covered so far: apart from each other, in order
    ends: list[int] = []
    count, i = 0, 0
    while i < len(order):
        to = i
        new = []
        while to < len(order) and low[order[to]] == low[order[i]]:
            s, e = int(start[order[to]]), int(end[order[to]])
            k = bisect_right(starts, s) - 1
            if k < 0 or ends[k] < e:
                new.append((s, e))
            to += 1
        count += bool(new)
        for s, e in new:
            a, b = bisect_left(ends, s), bisect_right(starts, e)
            if a < b:
                s, e = min(s, starts[a]), max(e, ends[b - 1])
            starts[a:b], ends[a:b] = [s], [e]
        i = to
    return count


def _spans(key: tuple[pa.Scalar, ...], texts: pa.Table, table: pa.Table) -> pa.Table:
    """Repeats of a range of documents, grown and merged per document, with the documents they repeat."""
    kind = table.column("kind").to_numpy()
    bodies = table.column("body").to_pylist()
    own = np.frombuffer(b"".join(x for x, k in zip(bodies, kind) if k == REPEAT), _REPEAT).copy()
    low = np.frombuffer(b"".join(x for x, k in zip(bodies, kind) if k == LOW), _LOW)
    low = low[np.argsort(low["digest"])]
    exact = own["digest"] != 0
    own["low"][exact] = low["low"][np.searchsorted(low["digest"], own["digest"][exact])]
    if own["inner"].any():
        own = np.concatenate([own, extend(own[own["inner"]], low, texts)])
    own = own[np.lexsort((own["end"], own["start"], own["doc"]))]
    out = []
    edge = np.flatnonzero(np.append(True, own["doc"][1:] != own["doc"][:-1])) if len(own) else []
    for a, b in zip(edge, np.append(edge[1:], len(own)) if len(own) else ()):
        spans = []
        for s, e in zip(own["start"][a:b].tolist(), own["end"][a:b].tolist()):
            if spans and s <= spans[-1]["end"]:
                spans[-1]["end"] = max(e, spans[-1]["end"])
            else:
                spans.append({"start": s, "end": e})
        out.append((int(own["doc"][a]), spans, np.unique(own["low"][a:b]).tolist(), _needed(own["start"][a:b], own["end"][a:b], own["low"][a:b])))
    return pa.table({"doc": pa.array([x[0] for x in out], pa.int64()),
                     "spans": pa.array([x[1] for x in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     "low": pa.array([x[2] for x in out], pa.list_(pa.int64())), "links": pa.array([x[3] for x in out], pa.int64())})


def repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """(id, component_id, n_links, spans) of every document: the smallest id of its class, the number
    of earlier documents that repeat what no smaller one does, and the byte spans that repeat them."""
    slim = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = slim.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(total / PART_BYTES))
    found = slim.mapInArrow(_scan(n, tune(percent), percent), _SCHEMA)
    keyed = found.filter(F.col("kind").isin(SEEN, BAND)).groupBy("kind", "part").applyInArrow(_merge(n), _SCHEMA)
    settled = cut(found.filter(~F.col("kind").isin(SEEN, BAND)).unionAll(keyed))

    def unpack(batches):
        for batch in batches:
            own = _first(np.frombuffer(b"".join(batch.column("body").to_pylist()), _LINE))
            yield pa.RecordBatch.from_arrays([pa.array(own["digest"].view(np.int64)), pa.array(own["doc"].copy())], ["id", "doc_id"])

    wanted = (settled.filter(F.col("kind") == CANDIDATE).mapInArrow(unpack, "id long, doc_id long").groupBy("id").agg(F.min("doc_id").alias("doc_id"))
              .groupBy("doc_id").agg(F.collect_list("id").alias("ids")))  # lines of one document
    lines = cut(slim.join(wanted, "doc_id").mapInArrow(_text, "id long, doc_id long, start long, end long, text string").dropDuplicates(["id", "doc_id", "start", "end"]))
    body = lines.select("id", "text").dropDuplicates(["id"])
    parts = components(minhash.links(body, cut(minhash.sketches(body, SHINGLE_WORDS), minhash.SKETCHES), SHINGLE_WORDS, percent))
    class_ = lines.join(parts, "id").select("component", "doc_id", "start", "end")
    low = class_.groupBy("component").agg(F.min("doc_id").alias("low"))
    near = class_.join(low, "component").filter("doc_id > low").select("doc_id", "start", "end", "low")

    def pack(batches):
        for batch in batches:
            own = np.zeros(batch.num_rows, _REPEAT)
            for c, name in zip(("doc", "start", "end", "low"), ("doc_id", "start", "end", "low")):
                own[c] = batch.column(name).to_numpy()
            yield _batch(_rows(REPEAT, _by_id(own["doc"].copy(), n), own))

    every = settled.filter(F.col("kind") == REPEAT).unionAll(near.mapInArrow(pack, _SCHEMA))

    def ask(batches):
        for batch in batches:
            for part, body in zip(batch.column("part").to_pylist(), batch.column("body").to_pylist()):
                own = np.frombuffer(body, _REPEAT)
                own = own[np.lexsort((own["low"], ~own["inner"], own["digest"]))]
                first = np.append(True, own["digest"][1:] != own["digest"][:-1])
                inner = own["inner"][first]
                least = np.minimum.reduceat(own["low"], np.flatnonzero(first))
                yield pa.RecordBatch.from_arrays([pa.array(own["digest"][first].view(np.int64)), pa.array(np.full(len(inner), part)), pa.array(least), pa.array(inner)],
                                                 ["id", "part", "low", "inner"])

    def holders(batches):
        for batch in batches:
            for part, body in zip(batch.column("part").to_pylist(), batch.column("body").to_pylist()):
                own = np.frombuffer(body, _REPEAT)
                own = np.unique(own["doc"][own["inner"]])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), part)), pa.array(own)], ["part", "doc_id"])

    def pack_low(batches):
        for batch in batches:
            own = np.empty(batch.num_rows, _LOW)
            own["digest"], own["low"] = batch.column("id").to_numpy().view(U64), batch.column("low").to_numpy()
            yield _batch(_rows(LOW, batch.column("part").to_numpy(), own))

    exact = settled.filter(F.col("kind") == REPEAT)
    asks = exact.mapInArrow(ask, "id long, part long, low long, inner boolean").groupBy("id", "part").agg(F.min("low").alias("low"), F.max("inner").alias("inner"))
    asks = cut(asks, NARROW)
    least = asks.groupBy("id").agg(F.min("low").alias("low"))  # of all tasks
    named = cut(asks.select("id", "part", "inner").join(least, "id"), NARROW)
    need = named.filter("inner").select("part", F.col("low").alias("doc_id")).unionAll(exact.mapInArrow(holders, "part long, doc_id long")).distinct()
    texts = slim.join(need, "doc_id").select("part", "doc_id", "text")
    every = every.unionAll(named.select("id", "part", "low").mapInArrow(pack_low, _SCHEMA))
    merged = cut(texts.groupBy("part").cogroup(every.groupBy("part")).applyInArrow(_spans, "doc long, spans array<struct<start:long,end:long>>, low array<long>, links long"))
    classes = components(merged.select(F.col("doc").alias("a"), F.explode("low").alias("b"))).withColumnRenamed("id", "of")
    none = F.array().cast("array<struct<start:long,end:long>>")
    return (slim.select("doc_id").join(merged, F.col("doc_id") == F.col("doc"), "left").join(classes, F.col("doc_id") == F.col("of"), "left")
            .select(F.col("doc_id").alias(id), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("spans", none).alias("spans")))


def cut_spans(docs: DataFrame, found: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the byte spans that ``found`` (of ``repeats``) names."""
    body = F.encode(F.col(text), "utf-8")
    begin = F.struct(F.lit(0).cast("long").alias("pos"), F.expr("X''").alias("out"))

    def piece(start, end):
        return F.substr(body, (start + 1).cast("int"), (end - start).cast("int"))

    left = F.aggregate("__spans", begin, lambda acc, s: F.struct(s["end"].alias("pos"), F.concat(acc.out, piece(acc.pos, s["start"])).alias("out")),
                       lambda acc: F.decode(F.concat(acc.out, piece(acc.pos, F.octet_length(F.col(text)).cast("long"))), "utf-8"))
    spans = found.select(F.col(id).alias("__id"), F.col("spans").alias("__spans")).dropDuplicates(["__id"])
    return (docs.join(spans, F.col(id) == F.col("__id"), "left").withColumn(text, F.when(F.size("__spans") > 0, left).otherwise(F.col(text)))
            .drop("__id", "__spans"))
