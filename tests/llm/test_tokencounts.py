import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import tokencounts, vocabulary

ALPHABET = " \n\t  '  abcdefgzé漢ł 123,.!?  'll're😀"


@pytest.fixture(scope="module")
def count():
    tokenizer = Tokenizer.from_file(vocabulary.locate(vocabulary.DEFAULT))
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def edited(text, edits):
    for pos, remove, insert in edits:
        pos = min(pos, len(text))
        text = text[:pos] + insert + text[min(pos + remove, len(text)):]
    return text


@pytest.mark.parametrize("leaf", [4, 32])
def test_counts_after_edits_equal_full_encoding(documents, spark, words, count, monkeypatch, leaf):
    monkeypatch.setattr(tokencounts, "LEAF", leaf)
    monkeypatch.setattr(tokencounts.pieces, "__defaults__", (leaf, None))
    pick = words.random

    def text(n):
        return "".join(pick.choice(ALPHABET) for _ in range(n))

    rows = [(i, text(pick.choice([0, 1, 5, 60, 400]))) for i in range(60)] + [(60, None)]
    edits = {i: [(pick.randint(0, 420), pick.choice([0, 1, 3, 10, 500]), text(pick.choice([0, 0, 1, 2, 10, 300]))) for _ in range(pick.randint(0, 6))] for i, _ in rows}
    table = spark.createDataFrame([(i, n, *e) for i, own in edits.items() for n, e in enumerate(own)], "doc_id long, seq int, pos int, remove int, insert string")
    state = tokencounts.build(documents(rows).select("doc_id", "text"))
    assert {r.doc_id: r.n_tokens for r in state.collect()} == {i: count(t or "") for i, t in rows}
    done = tokencounts.apply_edits(tokencounts.with_edits(state, table)).collect()
    for r in done:
        final = edited(dict(rows)[r.doc_id] or "", edits[r.doc_id])
        assert "".join(r.leaves) == final and r.n_tokens == count(final)


def test_only_the_touched_part_is_encoded(documents, words):
    docs = documents([words.text(5000)]).select("doc_id", "text", F.array(F.struct(F.lit(9000).alias("pos"), F.lit(4).alias("remove"), F.lit("new").alias("insert"))).alias("edits"))
    row = tokencounts.apply_edits(tokencounts.build(docs)).first()
    assert 0 < row.n_encoded <= 4 * tokencounts.LEAF


def test_null_edits_and_empty_table(documents):
    docs = documents(["some text", None, ""]).select("doc_id", "text", F.lit(None).cast(tokencounts.EDITS).alias("edits"))
    assert sorted(r.n_tokens for r in tokencounts.apply_edits(tokencounts.build(docs)).collect()) == [0, 0, 2]
    empty = documents([]).select("doc_id", "text", F.lit(None).cast(tokencounts.EDITS).alias("edits"))
    assert tokencounts.apply_edits(tokencounts.build(empty)).count() == 0


def test_rows_are_edited_in_slices_of_bounded_size(documents, words, monkeypatch):
    import pyarrow as pa

    from tidemark.llm import textbuf
    monkeypatch.setattr(textbuf, "CHUNK_BYTES", 100)
    leaves = pa.array([["a" * 60], [], None, ["b" * 30, "c" * 20], ["d" * 500], ["é"]], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([leaves, pa.array(range(6))], ["leaves", "n"])
    assert [s.column("n").to_pylist() for s in tokencounts._slices([batch])] == [[0, 1, 2], [3], [4], [5]]
    assert [s.column("n").to_pylist() for s in tokencounts._slices([batch.slice(3)])] == [[3], [4], [5]]
    assert list(tokencounts._slices([batch.slice(0, 0)])) == []
