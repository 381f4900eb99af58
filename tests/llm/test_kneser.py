import math
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import kneser


def plain(rows, order=2):
    """Scores by dictionaries, the model built from rows that are not held out."""
    rows = [(i, (t or "").encode().lower().split()) for i, t in rows]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    marks = ["<s>"] * (order - 1)

    def grams(w):
        s = [*marks, *w, "</s>"]
        return [tuple(s[j:j + order]) for j in range(len(w) + 1)]

    one, levels = Counter(), {order: Counter()}
    for i, w in rows:
        if not held[i]:
            one.update([*w, "</s>"])
            levels[order].update(grams(w))
    for k in range(order, 1, -1):
        levels[k - 1] = Counter(g[1:] for g in levels[k])
    n, v = sum(one.values()), len(one)
    cuts, total, kinds = {}, Counter(), defaultdict(lambda: [0, 0, 0])
    for k, counts in levels.items():
        c = Counter(counts.values())
        cuts[k] = kneser.discounts([c[j] for j in (1, 2, 3, 4)])
        for g, c in counts.items():
            total[k, g[:-1]] += c
            kinds[k, g[:-1]][min(c, 3) - 1] += 1

    def chance(g):
        k, context = len(g), (len(g), g[:-1])
        shorter = chance(g[1:]) if k > 1 else 1 / (v + 1)
        if not total[context]:
            return shorter
        c = levels[k][g]
        left = sum(cuts[k][j + 1] * kinds[context][j] for j in range(3))
        return (max(c - cuts[k][min(c, 3)], 0) + left * shorter) / total[context]

    words = [*one, "<unknown>"]
    for k, context in list(total)[:5] + list(total)[-5:]:
        assert sum(chance((*context, w)) for w in words) == pytest.approx(1.0)
    return sorted(((i, held[i], len(w) + 1, sum(one[x] > 0 for x in [*w, "</s>"]), n,
                    sum(math.log10((one[x] + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, "</s>"]),
                    sum(math.log10(chance(g)) for g in grams(w))) for i, w in rows), key=str)


def spark_scores(documents, rows, **options):
    found = kneser.score_held_out(documents(rows), **options).collect()
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found), key=str)


@pytest.mark.parametrize("order,tokens,held,wide", [(2, 6_000_000, 3_000_000, 1 << 32), (2, 400, 100, 1 << 32), (2, 400, 100, 10),
                                                    (3, 6_000_000, 3_000_000, 1 << 32), (3, 400, 100, 10), (4, 100, 50, 1 << 32)])
def test_scores_equal_plain_counting(documents, words, monkeypatch, order, tokens, held, wide):
    monkeypatch.setattr(kneser, "RANGE_TOKENS", tokens)
    monkeypatch.setattr(kneser, "HELD_KEYS", held)
    monkeypatch.setattr(kneser, "WIDE_FROM", wide)
    pool = [words.word() for _ in range(80)]
    rows = [(i, " ".join(words.random.choices(pool + pool[:2] * 20, k=words.random.randint(0, 60)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "Une  ÉCOLE\x0bune école the THE"), (None, pool[0]), (5, pool[1]), (5, pool[1])]
    got, want = spark_scores(documents, rows, order=order), plain(rows, order)
    assert len(got) == len(want)
    by = lambda x: (str(x[0]), x[1:5], round(x[5], 6))
    for a, b in zip(sorted(got, key=by), sorted(want, key=by)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-12) and a[6] == pytest.approx(b[6], rel=1e-12)


def test_a_longer_context_foretells_the_next_word_better(documents, words):
    """Texts of one cycle of words in which only the two words before tell the next."""
    first, second, third, last = (words.word() for _ in range(4))
    rows = [(i, " ".join([first, second, third, second, last] * 20)) for i in range(40)]
    by_order = {k: {r[0]: r[6] for r in spark_scores(documents, rows, order=k)} for k in (2, 3)}
    assert all(by_order[3][i] > by_order[2][i] / 2 for i in range(40))


def test_an_order_below_two_is_refused(documents):
    with pytest.raises(ValueError, match="order 1"):
        kneser.train(documents([(1, "a")]), order=1)


def test_files_are_gone_afterwards(documents, words, spark):
    import glob

    from tidemark.session import shared_dir
    rows = [(i, words.text(10)) for i in range(10)]
    one = spark_scores(documents, rows)
    assert not glob.glob(shared_dir(spark).removeprefix("file:") + "/tidemark-lm-*")
    assert all(r[6] < 0 for r in one)


def test_without_training_text(documents):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    for order in (2, 3):
        assert spark_scores(documents, [(held, "a b")], order=order) == [(held, True, 3, 0, 0, 0.0, 0.0)]
        assert spark_scores(documents, [], order=order) == []
