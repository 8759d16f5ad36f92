"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned from: crc32(id as text) mod 4 is 2."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, most_bytes: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """text and label (0 or 1) of at most `rows` labelled documents that are not held out.

    The sample is chosen by a hash of the id, among texts of at most `most_bytes` bytes, so it
    needs no more memory than `rows` times `most_bytes`, at any size of the tables. Of
    several labels of a document the largest counts; null labels and ids do not.
    """
    usable = (
        labels.select(labels[id_col].alias("id"), labels[label].cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    # Some chosen labels have no document or one that is too long: those are left out.
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text")).where(
        F.octet_length("text") <= most_bytes)
    return texts.join(chosen, texts["doc"] == chosen["id"]).dropDuplicates(["id"]).orderBy(
        F.xxhash64("id"), "id").limit(rows).select("text", "label")
