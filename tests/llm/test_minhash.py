import itertools
import re

import pytest

from tidemark.llm import minhash, shared


def sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def classes(rows, k, percent):
    own = {i: sets(t, k) for i, t in rows if i is not None}
    root = {i: i for i in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(own, 2):
        x, y = own[a], own[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: (len(own[i]), find(i)) for i in own}


def family(words, n, size, edits):
    core = words.text(size)
    return [words.edited(core, words.random.randint(0, edits)) for _ in range(n)]


@pytest.mark.parametrize("group,single", [(4096, 20_000), (8, 0), (4096, 0)])
def test_components_equal_all_pairs(documents, words, monkeypatch, group, single):
    monkeypatch.setattr(minhash, "GROUP", group)
    monkeypatch.setattr(minhash, "SINGLE_PAIRS", single)
    texts = family(words, 60, 80, 8) + family(words, 25, 40, 3) + [words.text(30) for _ in range(30)]
    texts += [texts[3], texts[3].upper(), "", None, " \n", "one two", "One  two", "a"]
    rows = list(enumerate(texts))
    words.random.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(documents(rows), words=4).collect()}
    assert got == classes(rows, 4, 80)


def test_null_ids_and_repeated_rows(documents, words):
    text = words.text(30)
    rows = [(5, text), (5, text), (3, text), (None, text), (9, words.text(20))]
    got = sorted(((r.doc_id, r.component_id) for r in minhash.near_duplicates(documents(rows)).collect()), key=str)
    assert got == sorted([(5, 3), (5, 3), (3, 3), (None, None), (9, 9)], key=str)


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([])).count() == 0


def test_long_text_and_copies(documents, words):
    long = words.text(30_000)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents([long, words.edited(long, 100), words.text(50)] + ["x y z"] * 40)).collect()}
    assert got == {0: 0, 1: 0, 2: 2} | {i: 3 for i in range(3, 43)}


def test_components_of_chains_and_stars(spark, words):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in shared.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


def test_every_text_of_a_repeated_id_is_searched(documents, words):
    """5 has two texts: one is a copy of 3's, the other is near 9's and equal to 7's."""
    one, two = words.text(80), words.text(80)
    rows = [(5, one), (5, two), (3, one), (9, words.edited(two, 1)), (7, two), (8, words.text(40))]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(rows)).collect()}
    assert got == {3: 3, 5: 3, 7: 3, 9: 3, 8: 8}


@pytest.mark.parametrize("few", [0, 10**6])
def test_components_dealt_out_or_in_one_task(spark, words, monkeypatch, few):
    monkeypatch.setattr(shared, "ONE_TASK", few)
    links = [(words.random.randint(0, 300), words.random.randint(0, 300)) for _ in range(200)]
    root = {i: i for p in links for i in p}
    for a, b in links * 2:
        lo, hi = sorted((root[a], root[b]))
        root = {k: lo if v == hi else v for k, v in root.items()}
    got = {r.id: r.component for r in shared.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: c for i, c in root.items() if i in {x for a, b in links if a != b for x in (a, b)}}
