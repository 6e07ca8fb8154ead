"""The operators applied to whole tables, with the columns their contracts name."""

from functools import cache

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.llm import (
    byte_bpe,
    clustering,
    divergence,
    embedding_dedup,
    frames,
    language,
    minhash,
    nearest,
    oracle,
    packing,
    pii,
    quality,
    sampling,
    secret_scan,
    token_count,
    toxicity,
)

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@cache
def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def _text_of(spans: Column, name) -> Column:
    """kind:start:end of each span, joined by commas."""
    written = F.transform(
        spans,
        lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(written, ",")


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(frames.table(spark, folder, "embeddings"))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(frames.table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "live")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]],
        _digest(_text_of(base, lambda s: s["kind"])).alias("base_sha256"),
        _text_of(F.col("spans"), lambda s: s["kind"]).alias("spans"),
        number("live").alias("n_live"),
        F.size(F.filter("spans", lambda s: s["verdict"] == "example")).alias("n_examples"),
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(frames.table(spark, folder, "documents"))
    names = F.array(*[F.lit(kind) for kind in pii.KINDS])
    base = F.filter("spans", lambda s: s["kind"] < pii.FOUND)

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def name(span: Column) -> Column:
        return F.element_at(names, span["kind"] + 1)

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS[:4])],
        _digest(_text_of(base, name)).alias("base_sha256"),
        _text_of(F.col("spans"), name).alias("spans"),
        number(pii.FOUND).alias("n_found"),
    )


def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(frames.table(spark, folder, "documents"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select("doc_id", sampling.held_out().alias("held_out"), "lang_pred", "score")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    model = quality.learn(docs, frames.table(spark, folder, "labels"))
    return quality.score(docs, model).select(
        "doc_id",
        sampling.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def packed(docs: DataFrame) -> DataFrame:
    """Pieces of whole documents with their places, without the ids themselves."""
    pieces = packing.tokenised_pieces(docs, vocabulary(WORD_VOCABULARY), digest=True)
    return packing.pack(frames.staged(pieces, "pieces"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(frames.table(spark, folder, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(
        frames.table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20
    )


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary(BYTE_VOCABULARY)
    coded = byte_bpe.decode(byte_bpe.encode(frames.table(spark, folder, "documents"), path), path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        _digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_token_count(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    return token_count.over_limit(token_count.token_counts(docs, vocabulary(WORD_VOCABULARY)))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = frames.table(spark, folder, "documents")
    model = toxicity.learn(docs, frames.table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        sampling.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op12_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    found = clustering.cluster(frames.table(spark, folder, "embeddings"))
    written = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.withColumn("centroid_sha256", _digest(written)).drop("centroid")


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(frames.table(spark, folder, "documents"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    function.__name__: function
    for function in (
        op1_embedding_near_dedup,
        op2_secret_scan,
        op3_pii,
        op4_minhash_near_dedup,
        op5_language,
        op6_quality,
        op7_packing,
        op8_nearest,
        op9_byte_bpe,
        op10_token_count,
        op11_toxicity,
        op12_centroid_clustering,
        op13_source_divergence,
        pipeline,
    )
}

#: SQL for an independent engine; what is missing here is tested against brute force.
ORACLE: dict[str, str] = oracle.SQL
