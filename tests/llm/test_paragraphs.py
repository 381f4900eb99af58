import re

import numpy as np

from tidemark.llm import paragraphs


def found(documents, rows):
    return {r.doc_id: r for r in paragraphs.repeats(documents(rows)).collect()}


def test_tuned_bands_keep_the_miss_rate():
    bands = paragraphs.tune(80)
    assert (1 - 0.8 ** paragraphs.ROWS) ** bands <= paragraphs.MISS < (1 - 0.8 ** paragraphs.ROWS) ** (bands - 1)


def test_every_passage_of_fifty_words_is_found_and_clean_texts_stay(documents, words):
    passages = [words.text(n) for n in (50, 60, 75, 120)]
    rows = [(i, words.text(words.random.randint(30, 200))) for i in range(0, 20)]
    want = set()
    for j, p in enumerate(passages):
        for c in range(3):
            i = 100 + 10 * j + c
            rows.append((i, words.text(words.random.randint(0, 40)) + " " + p.upper() + "\t" + words.text(words.random.randint(0, 40))))
            if c:
                want.add(i)
    got = found(documents, rows)
    assert {i for i, r in got.items() if r.spans} == want
    for i in want:
        assert got[i].component_id == i // 10 * 10 and got[i].n_links == 1


def test_near_lines_form_one_class(documents, words):
    line = words.text(60)
    near = line.rsplit(" ", 1)[0] + " other"
    got = found(documents, [(4, words.text(30) + "\n" + line), (2, near + "\n" + words.text(25)), (9, "\n".join([words.text(40), line, "end"]))])
    assert [got[i].component_id for i in (2, 4, 9)] == [2, 2, 2]
    assert not got[2].spans and got[4].spans and got[9].spans


def test_handed_on_in_small_batches(documents, words, monkeypatch):
    monkeypatch.setattr(paragraphs, "HELD", 50)
    monkeypatch.setattr(paragraphs, "PART_BYTES", 2000)
    line = words.text(45)
    rows = [(i, words.text(25) + "\n" + line + "\n" + words.text(25)) for i in range(30)]
    got = found(documents, rows)
    assert {i for i, r in got.items() if r.spans} == set(range(1, 30))
    assert {r.component_id for r in got.values()} == {0}


def test_cut_spans_removes_the_repeats(documents, words):
    line = "é" + words.text(30)
    rows = [(1, line + "\nfirst end"), (2, "second\n" + line + "\nsecond é end"), (3, None), (4, "")]
    docs = documents(rows)
    clean = {r.doc_id: r.text for r in paragraphs.cut_spans(docs, paragraphs.repeats(docs)).collect()}
    assert clean == {1: rows[0][1], 2: "second\n\nsecond é end", 3: None, 4: ""}


def test_odd_rows(documents, words):
    line = words.text(55)
    got = [(r.doc_id, bool(r.spans)) for r in paragraphs.repeats(documents([(5, line), (5, line), (None, line), (7, line + "\n" + line), (8, "word " * 3000)])).collect()]
    assert sorted(got, key=str) == sorted([(5, False), (5, False), (None, False), (7, True), (8, False)], key=str)
    assert paragraphs.repeats(documents([])).count() == 0


def test_all_occurrences_are_repeats_for_any_partitions(documents, words, monkeypatch):
    line, near = words.text(45), words.text(60)
    other = near.rsplit(" ", 1)[0] + " other"
    rows = [(1, line), (2, near), (5, line + "\n" + words.text(22) + "\n" + line), (6, "\n".join([other, words.text(21), other])), (7, line)]
    rows = [rows[j] for j in (2, 3, 0, 1, 4)]  # the later documents in earlier partitions

    def end(text, line):
        return [(a, a + len(line)) for a in range(len(text)) if text.startswith(line, a)]

    texts = dict(rows)
    want = {1: [], 2: [], 5: end(texts[5], line), 6: end(texts[6], other), 7: end(texts[7], line)}
    for held, n in ((1_000_000, 1), (1_000_000, 5), (1, 5)):
        monkeypatch.setattr(paragraphs, "HELD", held)
        got = {r.doc_id: [tuple(s) for s in r.spans] for r in paragraphs.repeats(documents(rows).repartitionByRange(n, "doc_id")).collect()}
        assert got == want


def test_whole_passages_inside_lines_are_covered(documents, words):
    rows, want = [], {}
    for j, n in enumerate((50, 53, 60, 75, 98, 120)):
        p = words.text(n)
        for c in range(2):
            i = 10 * j + c
            a = words.text(words.random.randint(25, 40)) + " %d " % i
            rows.append((i, a + p + " %d " % i + words.text(words.random.randint(25, 40))))
            want[i] = [(len(a), len(a) + len(p))] if c else []
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in paragraphs.repeats(documents(rows).repartition(3)).collect()}
    assert got == want


def test_short_lines_are_paragraphs(documents, words):
    nine, near = words.text(9), words.text(16)
    other = near.rsplit(" ", 1)[0] + " other"
    rows = [(1, "\n".join([words.text(12), nine, near, "Terms apply"])), (2, "\n".join([words.text(11), nine.upper(), words.text(10), other])),
            (3, "Terms apply\n" + words.text(8)), (4, words.text(7) + "\n\n" + words.text(9)), (5, words.text(6) + "\n" + nine)]
    got = {r.doc_id: [rows[r.doc_id - 1][1][s.start:s.end] for s in r.spans] for r in paragraphs.repeats(documents(rows)).collect()}
    assert got == {1: [], 2: [nine.upper(), other], 3: ["Terms apply"], 4: [], 5: [nine]}


def test_keys_of_similar_short_lines_meet(words):
    import numpy as np

    for n in range(1, 60):
        for gone in range(0, n // 5 + 2):
            one, two = np.arange(n + 4, dtype=np.uint64) * np.uint64(2654435761) + np.uint64(n), None
            two = one[gone:]
            if len(two) < 5 or 100 * (len(two) - 4) < 80 * n or n > paragraphs.PREFIX and len(two) - 4 > paragraphs.PREFIX:
                continue
            word = np.concatenate([one, two])
            line, key = paragraphs._keys(word, np.array([0, len(one)]), np.array([len(one), len(word)]), 18, 80)
            assert set(key[line == 0]) & set(key[line == 1])


def test_needed_documents_against_plain_sets():
    import random

    import numpy as np
    r = random.Random(4)
    for _ in range(300):
        runs = [(s, s + r.randint(1, 12), r.randint(0, 5)) for s in (r.randint(0, 40) for _ in range(r.randint(0, 12)))]
        covered, want = [], 0
        for low in sorted({x[2] for x in runs}):
            # neighbouring spans that touch are one
            merged = []
            for s, e in sorted(covered):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(e, merged[-1][1])
                else:
                    merged.append([s, e])
            mine = [(s, e) for s, e, w in runs if w == low]
            want += any(not any(a <= s and e <= b for a, b in merged) for s, e in mine)
            covered += mine
        a = np.array(runs, np.int64).reshape(-1, 3)
        assert paragraphs._needed(a[:, 0], a[:, 1], a[:, 2]) == want


def plain(rows):
    """Exact lines and shared runs of 50 words or more, by comparing every document with every smaller one."""
    words = {i: [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^ \t\n\r\f\v]+", t.lower())] for i, t in rows}
    lines = {}
    for i, t in rows:
        at = 0
        for line in t.split("\n"):
            ws = [w for w in words[i] if at <= w[0] < at + len(line)]
            if ws:
                lines.setdefault(i, []).append((ws[0][0], ws[-1][1], tuple(w[2] for w in ws)))
            at += len(line) + 1
    out = {}
    for i in words:
        runs = []
        for a, b, ws in lines.get(i, []):
            low = min(j for j in lines if any(x[2] == ws for x in lines[j]))
            if low < i:
                runs.append((a, b, low))
        for j in sorted(k for k in words if k < i):
            mine, theirs = [w[2] for w in words[i]], [w[2] for w in words[j]]
            before = [0] * (len(theirs) + 1)
            for p, w in enumerate(mine):
                now = [0] * (len(theirs) + 1)
                for q, v in enumerate(theirs):
                    if w == v:
                        now[q + 1] = before[q] + 1
                        last = p + 1 == len(mine) or q + 1 == len(theirs) or mine[p + 1] != theirs[q + 1]
                        if last and now[q + 1] >= 50:
                            runs.append((words[i][p - now[q + 1] + 1][0], words[i][p][1], j))
                before = now
        out[i] = runs
    return out


def test_equals_plain_version_for_any_partitions(documents, words, monkeypatch):
    """Spans, links and classes of lines and passages, with several documents per passage and per line."""
    passages = [words.text(n) for n in (50, 55, 70, 90)]
    lines = [words.text(n) for n in (2, 6, 12, 30)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(words.random.randint(1, 4)):
            kind = words.random.random()
            if kind < 0.4:
                parts.append(words.text(words.random.randint(5, 30)) + " " + words.random.choice(passages).upper() + " " + words.text(words.random.randint(5, 30)))
            elif kind < 0.7:
                parts.append(words.random.choice(lines))
            else:
                parts.append(words.text(words.random.randint(5, 40)))
        rows.append((i, "\n".join(parts)))
    want = {}
    links, spans = {}, {}
    for i, runs in plain(rows).items():
        merged = []
        for a, b, _ in sorted(runs):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        want[i] = [tuple(m) for m in merged]
        a = np.array(runs, np.int64).reshape(-1, 3)
        links[i], spans[i] = paragraphs._needed(a[:, 0], a[:, 1], a[:, 2]), {x[2] for x in runs}
    classes = {i: i for i in want}
    for i in sorted(want):
        for j in spans[i]:
            old, new = max(classes[i], classes[j]), min(classes[i], classes[j])
            classes = {k: new if c == old else c for k, c in classes.items()}
    for n, size in ((1, 48 << 20), (7, 2000)):
        monkeypatch.setattr(paragraphs, "PART_BYTES", size)
        got = {r.doc_id: r for r in paragraphs.repeats(documents(rows).repartition(n)).collect()}
        assert {i: [tuple(s) for s in r.spans] for i, r in got.items()} == want
        assert {i: r.n_links for i, r in got.items()} == links
        assert {i: r.component_id for i, r in got.items()} == classes
