"""Documents to training sequences, stage by stage, each written and read again."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfold.llm import frames, language, minhash, pii, quality, queries

#: No stage can be told in SQL: two learn models, one redacts by a graph, one hashes, one
#: packs.  The rows are tested against a brute-force version.
ORACLE_SQL = None

MIN_QUALITY = 0.5
#: On held-out rows one in a thousand scores less, a few short texts; texts in languages that
#: no row was learned from all do.
MIN_LANGUAGE_SCORE = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored likelier good than bad; the model learns from the labelled ones."""
    model = quality.learn(docs, frames.table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).where(F.col("score") >= MIN_QUALITY).select("rest.*")


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is likelier right than not, at both levels together."""
    found = language.identified(docs, language.learn(docs))
    clear = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(clear).select("rest.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the least document.

    Rows are told apart by a number of their own, so a document that shares its identifier
    with another one, or has none, is judged by its own text.  Rows without words stay."""
    rows = docs.withColumn("__row", F.monotonically_increasing_id())
    rows = frames.staged(rows, "numbered")
    found = minhash.near_duplicates(rows, id_col="__row").select(
        F.col("doc_id").alias("__row"), "component_id"
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    least = (
        found.join(rows.select("__row", "doc_id"), "__row")
        .groupBy("component_id")
        .agg(F.min(order).alias("least"))
        .select("least.__row")
    )
    return rows.join(least, "__row", "left_semi").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in brackets; n_chars follows the new text."""
    redacted = pii.redact(docs)
    if "n_chars" in redacted.columns:
        kind = redacted.schema["n_chars"].dataType
        redacted = redacted.withColumn("n_chars", F.char_length("text").cast(kind))
    return redacted


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's tokens stand in sequences of at most 4096."""
    return queries.packed(docs).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences made from the whole documents table."""
    docs = frames.table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = frames.staged(docs, f"after-{name}")
    return docs
