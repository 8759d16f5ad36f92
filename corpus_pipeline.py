"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelhouse.llm.common import prepared, shared_path, table
from parcelhouse.llm.decontamination import without_contaminated
from parcelhouse.llm.exact_dedup import exact_dedup
from parcelhouse.llm.packing import pack
from parcelhouse.llm.quality import fit_quality, keep_good
from parcelhouse.llm.simhash import near_dedup

LEAST_QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, scores LEAST_QUALITY or higher."""
    net = fit_quality(docs, table(spark, sf_dir, "labels"))
    return keep_good(docs, net, LEAST_QUALITY)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest doc_id."""
    prepared(spark)
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at most 2 bits apart the one with the smallest doc_id."""
    prepared(spark)
    return near_dedup(docs, shingle=3, radius=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item and no edited copy of one."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of at most 4096."""
    prepared(spark)
    return pack(docs, keep_chunks=False)  # its workers rest beside other stages


STAGES = [
    ("quality", quality), ("exact dedup", exact), ("near dedup", near),
    ("decontamination", decontaminate), ("packing", packing),
]

# The classifier, fingerprints and tokens have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over documents."""
    folder = shared_path(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
