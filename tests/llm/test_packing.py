import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, vocabulary

ODD = ["", None, "plain text", "<|endoftext|> inside <|x|>", "é漢字😀́   x", "'ll 've\t\n  \r\n 12345", "a" * 6000, " " * 3000, "﻿x\x00y"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary.locate(vocabulary.DEFAULT))


def test_ids_equal_the_tokenizers_library(tokenizer, words):
    ids = vocabulary.reader()
    for text in ODD + [words.text(300)] + ["".join(map(chr, words.random.choices(range(32, 0x2FFF), k=200))) for _ in range(50)]:
        assert ids(text or "").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bucket", [100_000, 20])
def test_pieces_fill_sequences_without_gaps(documents, words, tokenizer, monkeypatch, bucket):
    monkeypatch.setattr(packing, "BUCKET_PIECES", bucket)
    rows = list(enumerate(ODD + [words.text(words.random.randint(1, 900)) for _ in range(120)])) + [(None, "no id"), (3, "again"), (3, "again")]
    texts = Counter()
    for i, t in rows:
        texts[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])] += 1
    found = packing.pack(documents(rows)).collect()
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    want = Counter()
    for (i, ids), n in texts.items():
        for j, (s, length) in enumerate(packing.split(len(ids), 1024)):
            want[i, j, s, length, zlib.crc32(np.array(ids[s:s + length], "<u4").tobytes())] += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    total = sum(len(ids) * n for (_, ids), n in texts.items())
    assert len(sequences) <= 1.05 * total / 1024 + 2


@pytest.mark.parametrize("lengths", [[600] * 50, [1] * 5000, [1024] * 7, [1023, 1, 512, 512, 341, 341, 342], list(range(1, 1025)), []])
def test_plan_places_every_piece(lengths):
    counts = Counter(lengths)
    placed = Counter()
    for own, times in packing.plan(counts):
        assert sum(own) <= 1024
        for v in own:
            placed[v] += times
    assert placed == counts


def test_plan_is_close_to_the_bound_and_does_not_grow():
    rng = np.random.default_rng(1)
    counts = Counter(np.clip(rng.lognormal(5.5, 1, 20_000).astype(int), 1, 1024).tolist())
    big = {k: v * 100_000 for k, v in counts.items()}
    for c in (counts, big):
        assert sum(n for _, n in packing.plan(c)) <= 1.01 * sum(k * v for k, v in c.items()) / 1024 + 1


def test_empty_table(documents):
    assert packing.pack(documents([])).count() == 0
