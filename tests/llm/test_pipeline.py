import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import distance
from tests.llm.test_minhash import classes
from tests.llm.test_pii import base
from tidemark.llm import catalog, decontaminate, kneser, quality, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def tables(spark, words, tmp_path):
    item = words.text(30)
    rows = []
    for i in range(120):
        text = words.text(words.random.randint(20, 80))
        if i % 6 == 0:
            text = " ".join(w + "###" for w in text.split())
        if i % 10 == 3:
            text += " mail a.b@c-d.org or 4111111111111111, +1 415 555 0000 from 10.0.0.1"
        rows.append([i, text])
    rows += [[200 + i, words.edited(rows[7][1], 1)] for i in range(6)] + [[300, rows[8][1]], [301, rows[20][1] + " " + item + " " + rows[21][1]], [302, ""], [303, None], [None, rows[9][1]]]
    data = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 > 0), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), item


def test_stages_equal_plain_python(spark, tables):
    sf_dir, item = tables
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), seen=~kneser.held_out("doc_id", 3, 1))
    want = [(r.doc_id, r.text) for r in quality.score(docs, model, out="q").collect() if r.q >= 0.5]
    assert {i for i, _ in want if i is not None and i < 120} == {i for i in range(120) if i % 6}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{sf_dir}/{name}")
        docs = spark.read.parquet(f"{sf_dir}/{name}")
        assert docs.columns == COLUMNS
        got = {r.doc_id: r for r in docs.collect()}
        if name == "near_dedup":
            keep = {i for i, (_, c) in classes(want, 5, 80).items() if i == c} | {None}
            want = [(i, t) for i, t in want if i in keep]
            assert 300 not in keep and not {200, 201, 202, 203, 204, 205} & keep
        elif name == "decontamination":
            clean = decontaminate.normalize(item)
            want = [(i, t) for i, t in want if distance(clean, decontaminate.normalize(t)) > decontaminate.budget(len(clean))]
            assert 301 not in dict(want)
        elif name == "pii":
            for i, t in want:
                assert not base(got[i].text) and got[i].n_chars == (len(got[i].text) if t is not None else None)
                if not base(t):
                    assert got[i].text == t
        assert set(got) == {i for i, _ in want}
        if name != "pii":
            assert {(i, r.text) for i, r in got.items()} == set(want)
    tokenizer = Tokenizer.from_file(vocabulary.locate(vocabulary.DEFAULT))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    pieces = Counter()
    for r in packed:
        ids = np.array(tokenizer.encode(got[r.doc_id].text or "", add_special_tokens=False).ids + [2], "<u4")
        assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
        pieces[r.doc_id] += r.length
    assert set(pieces) == set(got)
    key = lambda r: (str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(key, packed))


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def test_empty_documents(spark, tables, tmp_path):
    sf_dir, _ = tables
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
