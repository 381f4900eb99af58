"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, divergence, kneser, licences, minhash, neighbours, oracles, packing, paragraphs, pii, quality, suffixes, tokencounts, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, "text", "pii")

    def of(*kinds):
        return F.filter("pii", lambda s: s.kind.isin(*kinds))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.digest(of(*pii.BASE)), 256).alias("base_sha256"), pii.digest(F.col("pii")).alias("spans"))


@query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every vector whose id is divisible by 100."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, matches and repeated spans of every document."""
    found = paragraphs.repeats(table(spark, sf_dir, "documents"))
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))))
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "component_id", "n_links", F.size("spans").cast("long").alias("n_spans"), size.alias("n_removed"), spans.alias("spans"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of benchmark items in documents, with up to a twentieth of edits."""
    return decontaminate.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = quality.train(docs, table(spark, sf_dir, "labels"), seen=~held)
    scored = quality.score(docs, model).select("doc_id", held.alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after three edits: the first line goes, the
    source is put in the middle, and a stretch at the first quarter turns to capitals."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "source")
    quarter = F.floor(F.length("text") / 4).cast("int")
    edits = F.array(*[F.struct(pos.alias("pos"), remove.alias("remove"), insert.alias("insert")) for pos, remove, insert in (
        (quarter, F.lit(20), F.upper(F.substring("text", quarter + 1, F.lit(20)))),
        (F.floor(F.length("text") / 2).cast("int"), F.lit(0), F.concat(F.lit(" "), F.coalesce("source", F.lit("")))),
        (F.lit(0), F.instr("text", "\n"), F.lit("")))])
    state = tokencounts.build(docs.select("doc_id", "text", edits.alias("edits"))).withColumnRenamed("n_tokens", "n_tokens_before")
    done = tokencounts.apply_edits(state)
    return done.select("doc_id", "n_tokens_before", F.col("n_tokens").alias("n_tokens_after"), F.size("leaves").alias("n_leaves"), "n_encoded")


@query
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under a model of four fifths of them."""
    found = kneser.score_held_out(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that no earlier document's string of 50 bytes covers."""
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document, on shingles of four words."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query
def op11_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template spans of every document. The score is the largest share of
    a template that was found; a phrase alone counts a half."""
    found = licences.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base, more = F.array_distinct("places.label"), F.array_distinct("spans.label")
    n = F.size("places").cast("long")
    return found.select(
        "doc_id", "n_words", n.alias("n_base"), F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        F.concat_ws(",", F.array_sort(base)).alias("base_labels"), F.concat_ws(",", F.array_sort(F.array_union(base, more))).alias("labels"),
        F.greatest(F.when(n > 0, 0.5).otherwise(0.0), F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))).alias("score"))


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its 200 most typical words."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every vector."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    done = whitening.transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(v) for v in (model.explained if model else [])]).cast("array<double>")
    return done.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"))


ORACLE: dict[str, str] = oracles.SQL
