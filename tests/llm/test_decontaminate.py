import pytest

from tidemark.llm import decontaminate as D


def distance(item, text):
    """Edits between an item and the best substring of a text."""
    before = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        now = [i + 1]
        for j, d in enumerate(text):
            now.append(min(before[j] + (c != d), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def typos(words, text, n):
    s = list(text)
    for _ in range(n):
        at = words.random.randrange(len(s))
        words.random.choice([lambda: s.insert(at, "x"), lambda: s.pop(at), lambda: s.__setitem__(at, "y")])()
    return "".join(s)


@pytest.fixture
def benchmark(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [4_000_000, 500])
def test_occurrences_equal_plain_edit_distance(documents, benchmark, words, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_CHARS", block)
    items = [(i, words.text(n)) for i, n in enumerate((3, 6, 12, 30, 60))]
    rows = []
    for i in range(60):
        _, t = items[i % 5]
        rows.append((i, words.text(words.random.randint(0, 30)) + "  " + typos(words, t, words.random.randint(0, D.budget(len(t)) + 2)).title() + "\n" + words.text(10)))
    got = {(r.doc_id, r.item_id): r for r in D.occurrences(documents(rows), benchmark(items)).collect()}
    for i, text in rows:
        for j, item in items:
            best = distance(D.normalize(item), D.normalize(text))
            if best <= D.budget(len(D.normalize(item))):
                r = got[i, j]
                assert r.edits == best and distance(D.normalize(item), D.normalize(text)[r.start:r.end]) == best
            else:
                assert (i, j) not in got


def test_clean_documents_stay_with_all_columns(documents, benchmark, words):
    item = words.text(20)
    docs = documents([(1, words.text(40)), (2, "a " + item + " b"), (None, item), (3, None), (4, ""), (1, words.text(5))])
    kept = D.remove_contaminated(docs, benchmark([(1, item), (2, None), (3, " ")]))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 3, 4]


def test_short_items_and_empty_tables(documents, benchmark):
    docs = documents(["one abc two abc", "ab c", "ABC"])
    found = [(r.doc_id, r.start, r.end) for r in D.occurrences(docs, benchmark([(1, "abc")])).collect()]
    assert sorted(found) == [(0, 4, 7), (0, 12, 15), (2, 0, 3)]
    assert D.occurrences(docs, benchmark([])).count() == 0
    assert D.occurrences(documents([]), benchmark([(1, "abc")])).count() == 0
    assert D.remove_contaminated(docs, benchmark([])).count() == 3


@pytest.mark.parametrize("held", [1, 2_000, 32 << 20])
def test_a_benchmark_of_many_blocks_reads_the_documents_once(spark, documents, benchmark, words, monkeypatch, held):
    items = [(i, words.text(words.random.randint(1, 20))) for i in range(50)] + [(None, words.text(9)), (0, words.text(9)), (99, "\t\n")]
    rows = [(i, words.text(5) + " " + typos(words, items[i % 52][1], i % 3) + " " + words.text(5)) for i in range(150)] + [(None, ""), (7, None)]
    want = sorted(map(tuple, D.occurrences(documents(rows), benchmark(items)).collect()), key=str)
    clean = sorted(map(tuple, D.remove_contaminated(documents(rows), benchmark(items)).collect()), key=str)
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    monkeypatch.setattr(D, "HELD_BYTES", held)
    found = D.occurrences(documents(rows), benchmark(items))
    kept = D.remove_contaminated(documents(rows), benchmark(items))
    assert want and sorted(map(tuple, found.collect()), key=str) == want
    assert sorted(map(tuple, kept.collect()), key=str) == clean
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_long_text(documents, benchmark, words):
    item = words.text(40)
    text = words.text(20_000) + " " + item + " " + words.text(20_000)
    rows = D.occurrences(documents([text]), benchmark([(7, item)])).collect()
    assert len(rows) == 1 and rows[0].edits == 0


def test_every_length_gets_the_edits_of_the_rate():
    for m in range(1, 400):
        k, q = D.budget(m), D.gram(m)
        assert k == m // 20 and (k == 0 or m + 1 - q * (k + 1) > 0)


def test_items_of_twenty_characters_may_have_an_edit(documents, benchmark):
    items = [(1, "abcdefghij klmnopqrs"), (2, "abcdefghij klmnopqrstu"), (3, "short item 12 chars")]
    rows = [(1, "x abcdefghij klmnXpqrs y"), (2, "x abcdeghij klmnopqrstu y"), (3, "short itXm 12 chars"), (4, "abcXefghij klmnXpqrs"), (5, "a short item 12 chars b")]
    found = {(r.doc_id, r.item_id): r.edits for r in D.occurrences(documents(rows), benchmark(items)).collect()}
    assert found == {(1, 1): 1, (2, 2): 1, (2, 1): 1, (5, 3): 0}


def test_common_q_grams_lose_nothing(documents, benchmark, words, monkeypatch):
    """Items that share a long beginning, and some that are alike: the same result whatever is left out."""
    head = words.text(12)
    items = [(i, head + " " + words.text(8)) for i in range(40)] + [(100 + i, head) for i in range(5)] + [(200, words.text(30))]
    rows = [(i, words.text(5) + " " + typos(words, items[i % len(items)][1], words.random.randint(0, 4)) + " " + words.text(5)) for i in range(60)]
    seen = []
    for common in (10**9, 32, 0):
        monkeypatch.setattr(D, "COMMON", common)
        seen.append(sorted(map(tuple, D.occurrences(documents(rows), benchmark(items)).collect())))
        index = D.Index([(i, D.normalize(t)) for i, t in items])
        assert (index.need >= 1).all()
    assert seen[0] == seen[1] == seen[2] and seen[0]
    monkeypatch.setattr(D, "COMMON", 32)
    index = D.Index([(i, D.normalize(t)) for i, t in items])
    assert len(index.hash) < sum(len(t) - D.Q + 1 for _, t in items) * 0.8
