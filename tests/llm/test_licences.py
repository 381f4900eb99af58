import random
import re

import pytest

from tidemark.llm import catalog, licences

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, templates, phrases):
    """Words, places and spans by comparing every word with every word of every template."""
    ws = split(text)
    bodies = [split(t) for _, t in templates]
    every = bodies + [split(t) for _, t in phrases]
    longest = [0] * (len(ws) + 1)  # longest passage of any template that ends at each word
    for body in every:
        before = [0] * (len(body) + 1)
        for i, w in enumerate(ws):
            now = [0] * (len(body) + 1)
            for j, b in enumerate(body):
                if w == b:
                    now[j + 1] = before[j] + 1
                    longest[i + 1] = max(longest[i + 1], now[j + 1])
            before = now
    matches = [(i - longest[i], i) for i in range(1, len(ws) + 1)
               if longest[i] >= licences.MIN_MATCH and (i == len(ws) or longest[i + 1] != longest[i] + 1)]
    places = sorted((s, k) for k, (_, t) in enumerate(phrases) for p in [split(t)]
                    for s in range(len(ws) - len(p) + 1) if ws[s:s + len(p)] == p)
    spans = []
    for t, body in enumerate(bodies):
        nodes = []
        for a, b in matches:
            for e in range(b - a, len(body) + 1):
                if body[e - (b - a):e] != ws[a:b]:
                    continue
                options = [(b - a, None)]
                for k, n in enumerate(nodes):
                    if n["b"] < b and n["e"] < e and a - n["b"] <= licences.GAP and e - (b - a) - n["e"] <= licences.GAP:
                        options.append((n["c"] + min(b - max(a, n["b"]), e - max(e - (b - a), n["e"])), k))
                best = max(c for c, _ in options)
                nodes.append({"b": b, "e": e, "c": best, "all": options})
        spans.append(max((n["c"] for n in nodes), default=0))
    return len(ws), [(phrases[k][0], s) for s, k in places], spans


def check(spark, rows, templates, phrases):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, spans int")
    got = licences.scan(df, templates=templates, phrases=phrases).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "text", "n_words", "places", "spans"]
    sizes = [len(split(t)) for _, t in templates]
    for r in got:
        n, places, best = plain(r.text, templates, phrases)
        assert r.n_words == n and [tuple(p) for p in r.places] == places
        for t, size in enumerate(sizes):
            mine = [s for s in r.spans if s.template == t]
            need = min(licences.COVER * size, licences.ENOUGH)
            assert bool(mine) == (best[t] >= need)
            assert max((s.covered for s in mine), default=0) == (best[t] if best[t] >= need else 0)
            assert all(a.end <= b.start for a, b in zip(mine, mine[1:]))
            assert all(s.label == templates[t][0] and s.coverage == s.covered / size and 0 <= s.start < s.end <= n for s in mine)


def test_random_words_match_plain_version(spark):
    """Few different words, so passages overlap, repeat and stand in several templates."""
    r = random.Random(5)
    make = lambda n, k: " ".join(r.choice("abcdefgh"[:k]) for _ in range(n))
    templates = [("x", make(30, 8)), ("y", make(12, 8)), ("z", make(20, 3)), ("x", make(6, 8))]
    templates.append(("y", templates[0][1][:30] + " " + templates[1][1]))
    phrases = [("p", "a b"), ("q", "b a b"), ("p", "c"), ("r", templates[3][1])]
    rows = []
    for i in range(150):
        parts = [make(r.randint(0, 15), 8)]
        for _ in range(r.randint(0, 3)):
            ws = r.choice(templates)[1].split()
            for _ in range(r.randint(0, 3)):
                ws[r.randrange(len(ws))] = r.choice(["zz", "a", "b c"])
            parts += [" ".join(ws[r.randint(0, 4):]), make(r.randint(0, 12), 8)]
        rows.append((i, " ".join(parts)))
    check(spark, rows, templates, phrases)


def test_licence_texts_with_edits(spark):
    r = random.Random(6)
    rows = []
    for i, (_, text) in enumerate(licences.TEMPLATES * 4):
        ws = text.upper().split()
        for _ in range(i % 4):
            ws[r.randrange(len(ws))] = r.choice(["foo", "", "of the"])
        rows.append((i, "some words\tbefore " + "\n* ".join(ws) + " and after " + "x " * r.randint(0, 9)))
    check(spark, rows, licences.TEMPLATES, licences.PHRASES)


def test_odd_rows(spark):
    mit = licences.TEMPLATES[0][1]
    rows = [(None, mit), (1, None), (2, ""), (2, ""), (3, " \t\n"), (4, "MIT"), (5, "mit-LICENSE"), (6, "Émit licenseЖ"),
            (7, "mit license " * 400 + "general public license apache license"), (7, mit), (7, mit), (8, (mit + " so ") * 300)]
    got = licences.scan(spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string"), keep=["doc_id"]).collect()
    assert [(r.doc_id, r.n_words, len(r.places), len(r.spans)) for r in got] == [
        (None, 87, 0, 1), (1, 0, 0, 0), (2, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 1, 0, 0), (5, 2, 1, 0), (6, 2, 0, 0),
        (7, 805, 402, 0), (7, 87, 0, 1), (7, 87, 0, 1), (8, 300 * 88, 0, 300)]
    assert licences.scan(spark.createDataFrame([], "text string")).collect() == []
    with pytest.raises(ValueError):
        licences.scan(spark.createDataFrame([], "text string"), templates=[("x", "a " * 100_001)])
    assert licences.scan(spark.createDataFrame([(1, "a b")], "k int, text string"), templates=[], phrases=[]).first().n_words == 2


def test_query_base_columns(spark, sf_small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()}
    got = catalog.QUERIES["op11_licences"](spark, sf_small).collect()
    assert {r.doc_id for r in got} == set(docs) and any(r.n_base for r in got)
    for r in got:
        n, places, best = plain(docs[r.doc_id], licences.TEMPLATES, licences.PHRASES)
        starts = [s for _, s in places]
        base = {label for label, _ in places}
        share = [b / len(split(t)) for b, (_, t) in zip(best, licences.TEMPLATES) if b >= min(licences.COVER * len(split(t)), licences.ENOUGH)]
        more = {label for b, (label, t) in zip(best, licences.TEMPLATES) if b >= min(licences.COVER * len(split(t)), licences.ENOUGH)}
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(starts), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted(base)) and r.labels == ",".join(sorted(base | more))
        assert r.score == max(share + [0.5 if base else 0.0])
