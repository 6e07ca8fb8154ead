"""Bounded, repeatable samples of labelled rows, and the split they come from."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: those whose crc32 of the identifier as text is 1 modulo 3.

    A null identifier counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def bounded(labelled: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id and label of at most ``most`` distinct identifiers of each label, those with
    the least hash; an identifier under several labels counts for the least one.

    Hashes spread evenly, so identifiers whose hash is far above the expected cut go first;
    what is shuffled and ranked is then about twice the bound and no share of the table,
    however often an identifier is repeated.  A null identifier is one like any other."""
    place = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    counts = labelled.groupBy(label).agg(F.approx_count_distinct(known).alias("__count"))
    near = (
        labelled.select("doc_id", label)
        .withColumn("__place", place)
        .join(F.broadcast(counts), label)
        .where(F.col("__place") * F.col("__count") <= 2 * most + 100)
    )
    once = near.groupBy("doc_id", "__place").agg(F.min(label).alias(label))
    order = Window.partitionBy(label).orderBy("__place", "doc_id")
    ranked = once.withColumn("__rank", F.row_number().over(order))
    return ranked.where(F.col("__rank") <= most).select("doc_id", label)


def one_row_each(rows: DataFrame) -> DataFrame:
    """One row of each identifier, the least by its other columns; each task hands on at
    most one row of an identifier, so repeated ones cost no more than distinct ones."""
    others = [c for c in rows.columns if c != "doc_id"]
    least = rows.groupBy("doc_id").agg(F.min(F.struct(*others)).alias("least"))
    return least.select("doc_id", *[F.col(f"least.{c}").alias(c) for c in others])


def agreed(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """doc_id and label (0 or 1), one row of each identifier that may be learned from.

    Other labels, held-out rows and contradicting labels teach nothing."""
    marks = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label"))
    return (
        marks.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").cast("int").alias("label"), F.max("label").alias("most"))
        .where(F.col("label") == F.col("most"))
        .drop("most")
    )
