import random

import pytest

#: Syllables for invented words.
SYLLABLES = "the an er on re ha es ti le qu vi mo da se".split()


class Words:
    """Invented texts, the same for the same seed."""

    def __init__(self, seed):
        self.random = random.Random(seed)

    def word(self):
        return "".join(self.random.choice(SYLLABLES) for _ in range(self.random.randint(2, 5)))

    def text(self, n):
        return " ".join(self.word() for _ in range(n))

    def edited(self, text, n):
        words = text.split(" ")
        for _ in range(n):
            words[self.random.randrange(len(words))] = self.word()
        return " ".join(words)


@pytest.fixture
def words():
    return Words(11)


@pytest.fixture
def documents(spark):
    """Table of documents from texts or (doc_id, text) pairs, with columns that clash with results."""
    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", "s", 0, 1.0, True) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean")
    return make
