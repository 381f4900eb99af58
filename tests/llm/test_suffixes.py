import numpy as np
import pytest

from tidemark.llm import suffixes


def plain(rows, length=50):
    rows = [(i, (t or "").encode()) for i, t in rows]
    low = {}
    for i, b in rows:
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            low[s] = min(low.get(s, i), i)
    out = []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if low[b[p:p + length]] < i:
                gone[p:p + length] = True
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 24, 3000])
def test_equals_plain_search(documents, words, monkeypatch, block):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", block)
    passage, other = words.text(20), "é" * 40 + words.text(10)
    texts = [words.text(60), passage, words.text(20) + " " + passage + words.text(5), "x" + passage[3:60], None, "", "short", "ab" * 100, "ba" * 80,
             passage + passage, other + passage[:49], other, words.text(400), "z" * 500, "z" * 120, "z" * 49]
    texts += [words.edited(texts[12], 20) for _ in range(5)] + [texts[12]] * 3
    rows = list(enumerate(texts))
    words.random.shuffle(rows)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(documents(rows)).collect())
    assert got == plain(rows)


def test_null_and_repeated_ids(documents, words):
    text = words.text(40)
    got = sorted(((r.doc_id, r.n_removed) for r in suffixes.remove_repeats(documents([(4, text), (4, text), (None, text), (7, text)])).collect()), key=str)
    assert got == sorted([(4, 0), (4, 0), (None, 0), (7, len(text))], key=str)


def test_empty_table(documents):
    assert suffixes.remove_repeats(documents([])).count() == 0


def test_refinement_finds_equal_strings():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    data[300:400] = data[20:120]
    size = np.array([250, 350])
    order, new = suffixes.refine(data, size)
    text = data.tobytes()
    starts = [p for b, e in ((0, 250), (250, 600)) for p in range(b, e - 49)]
    groups = {}
    for p in starts:
        groups.setdefault(text[p:p + 50], []).append(p)
    shared = {tuple(g) for g in groups.values() if len(g) > 1}
    assert {tuple(sorted(g)) for g in np.split(order, np.flatnonzero(new)[1:])} == shared
    firsts = [text[p:p + 50] for p in order]
    assert firsts == sorted(firsts)


def test_a_heavy_key_spreads_over_shards(words, monkeypatch):
    import pyarrow as pa
    import pyarrow.compute as pc

    monkeypatch.setattr(suffixes, "HEAVY", 64, raising=False)
    phrase = words.text(14)[:60]
    rows = [(i, words.text(15) + phrase + words.text(15)) for i in range(300)] + [(300 + i, words.text(30)) for i in range(5)]
    n = 3
    docs = [pa.table({"doc_id": pa.array([i for i, _ in rows[b::n]], pa.int64()), "text": [t for _, t in rows[b::n]]}) for b in range(n)]

    def of(table, name, value):
        return table.filter(pc.equal(table.column(name), value))

    keys = pa.concat_tables([suffixes._block_keys(n)((pa.scalar(b),), docs[b]) for b in range(n)])
    shared = pa.concat_tables([suffixes._merge_keys(of(keys, "part", p)) for p in range(n) if of(keys, "part", p).num_rows])
    sent = pa.concat_tables([suffixes._block_runs(n * suffixes.SHARDS)((pa.scalar(b),), docs[b], of(shared, "block", b)) for b in range(n)])
    size = sent.append_column("n", pc.binary_length(sent.column("body"))).group_by("shard").aggregate([("n", "sum")]).column("n_sum").to_pylist()
    assert max(size) < sum(size) / 10 and max(size) < 300 * 30
    found = pa.concat_tables([suffixes._shard(of(sent, "shard", s)) for s in sent.column("shard").unique()])
    found = found.append_column("heavy", pa.nulls(found.num_rows, pa.binary()))
    marks = pa.concat_tables([found, shared.select(["block", "heavy"])], promote_options="default")
    got = []
    for b in range(n):
        got += suffixes._clean(docs[b], of(marks, "block", b)).to_pylist()
    assert sorted(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")) for r in got) == plain(rows)


def steps(rows, n):
    """The steps over ``n`` blocks of the rows: bytes per shard, heavy keys and the result."""
    import pyarrow as pa
    import pyarrow.compute as pc

    docs = [pa.table({"doc_id": pa.array([i for i, _ in rows[b::n]], pa.int64()), "text": [t for _, t in rows[b::n]]}) for b in range(n)]

    def of(table, name, value):
        return table.filter(pc.equal(table.column(name), value))

    keys = pa.concat_tables([suffixes._block_keys(n)((pa.scalar(b),), docs[b]) for b in range(n)])
    shared = pa.concat_tables([suffixes._merge_keys(of(keys, "part", p)) for p in range(n) if of(keys, "part", p).num_rows])
    sent = pa.concat_tables([suffixes._block_runs(n * suffixes.SHARDS)((pa.scalar(b),), docs[b], of(shared, "block", b)) for b in range(n)])
    size = sent.append_column("n", pc.binary_length(sent.column("body"))).group_by("shard").aggregate([("n", "sum")]).column("n_sum").to_pylist()
    found = pa.concat_tables([suffixes._shard(of(sent, "shard", s)) for s in sent.column("shard").unique()])
    found = found.append_column("heavy", pa.nulls(found.num_rows, pa.binary()))
    marks = pa.concat_tables([found, shared.select(["block", "heavy"])], promote_options="default")
    got = []
    for b in range(n):
        got += suffixes._clean(docs[b], of(marks, "block", b)).to_pylist()
    heavy = {x for h in shared.column("heavy").to_pylist() for x in np.frombuffer(h, np.uint64).tolist()}
    return size, heavy, sorted(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")) for r in got)


def test_a_heavy_key_of_long_documents_is_counted(words, monkeypatch):
    """One document in each block, each with the phrase among differing words many times; and two in each."""
    monkeypatch.setattr(suffixes, "HEAVY", 64, raising=False)
    phrase = words.text(14)[:60]
    for count in (3, 6):
        rows = [(i, " ".join(words.text(6) + phrase for _ in range(100))) for i in range(count)]
        size, heavy, got = steps(rows, 3)
        assert heavy and max(size) < sum(size) / 4
        assert got == plain(rows)
