import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import divergence

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, min_docs=3, top=200):
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in [tuple(x or "" for x in r) for r in rows]:
        ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        counts[lang, source].update(ws)
        docs[lang].update(set(ws))
    out = set()
    kept = {lang: sorted((w for w, n in c.items() if n >= min_docs)) for lang, c in docs.items()}
    for lang, source in counts:
        words = kept.get(lang, [])

        def shares(groups):
            c = sum((counts[g] for g in groups), Counter())
            total = sum(c[w] for w in words) + len(words)
            return {w: 1 + 10**9 * (c[w] + 1) // total for w in words}

        f = lambda p, q: (p - q) ** 2 // q
        mine, of_lang = shares([(lang, source)]), shares([g for g in counts if g[0] == lang])
        pairs = []
        for _, other in [g for g in counts if g[0] == lang and g[1] != source]:
            theirs = shares([(lang, other)])
            pairs.append((-sum(f(mine[w], theirs[w]) for w in words), other.encode(), other))
        terms = [(-f(mine[w], of_lang[w]), w.encode(), w) for w in words if counts[lang, source][w] and mine[w] > of_lang[w]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out |= {(lang, source, part, w, -v, i + 1) for i, (v, _, w) in enumerate(items)}
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, 7, *r, 1.0) for i, r in enumerate(rows)], "doc_id long, rank int, lang string, source string, text string, value double")
    got = [tuple(r) for r in divergence.audit(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def sample(words, n):
    common = [words.word() for _ in range(30)] + ["Äpfel", "naïve", "日本"]
    rows = []
    for i in range(n):
        text = " ".join(words.random.choice(common) for _ in range(words.random.randint(0, 40))) + " " + words.text(3) + " x1y2"
        rows.append((f"l{i % 2}", "hot" if i % 3 == 0 else f"s{words.random.randint(0, 5)}", text))
    return rows


@pytest.mark.parametrize("entries,stripe,chunk,small", [(10**6, 256, 1 << 21, 20_000), (40, 2, 300, 0)])
def test_equals_plain_version(spark, monkeypatch, words, entries, stripe, chunk, small):
    """One block and one stripe, or many small ones."""
    monkeypatch.setattr(divergence, "SMALL", small)
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    monkeypatch.setattr(divergence, "STRIPE", stripe)
    monkeypatch.setattr(divergence, "CHUNK_BYTES", chunk)
    rows = sample(words, 150)
    assert found(spark, rows) == plain(rows)


def test_odd_rows_and_ties(spark, words):
    rows = sample(words, 20) + [
        (None, None, None), (None, "a", "one"), ("", "", "one ONE"), ("xx", "a", "rare"), ("xx", None, "words"), ("xx", "b", ""),
        ("yy", "only", "same same"), ("yy", "only", "same same"), ("yy", "only", "same same"),
        ("zz", "a", "t u v"), ("zz", "a", "t u v"), ("zz", "é", "t u v"), ("zz", "Z", "t u v"), ("zz", "z", "1 2 3"),
        ("l0", "long", "many " * 50_000 + "w" * 30_000)]
    got = found(spark, rows)
    assert got == plain(rows)
    assert {r[3:] for r in got if r[:3] == ("xx", "a", "pair")} == {("", 0, 1), ("b", 0, 2)}
    assert found(spark, rows, min_docs=1, top=2) == plain(rows, 1, 2)
    assert found(spark, []) == set()


def test_shares_of_large_counts():
    """Counts beyond 2**63 / 10**9 stay exact, in SQL as in numpy."""
    counts = [0, 1, 10**12, 4 * 10**14]
    total, size = 5 * 10**14, 10**9 + 7
    assert divergence._shares(np.array(counts), total, size).tolist() == [1 + 10**9 * (c + 1) // (total + size) for c in counts]


def test_sql_shares_of_large_counts(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(c, 5 * 10**14, 10**9 + 7) for c in (0, 1, 10**12, 4 * 10**14)], "c long, n long, v long")
    assert [r[0] for r in df.select(divergence.share(F.col("c"), F.col("n"), F.col("v")), "c").orderBy("c").collect()] == [
        1 + 10**9 * (c + 1) // (5 * 10**14 + 10**9 + 7) for c in (0, 1, 10**12, 4 * 10**14)]
