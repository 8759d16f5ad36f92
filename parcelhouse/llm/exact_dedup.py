"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import ascii_lower, id_and_text, table, written

FILTER_BITS = 1 << 23
BUCKET_BITS = 32_768


def key_filter(keys: DataFrame) -> bytes:
    """A bit set of fixed size (1 MB) over 64-bit `key` values: no key is missed, few others pass.

    Whatever the number of keys, the driver receives at most FILTER_BITS / 8 bytes.
    """
    place = F.pmod("key", F.lit(FILTER_BITS))
    parts = (
        keys.select(place.alias("place"))
        .select(
            F.expr(f"cast(place div {BUCKET_BITS} as int)").alias("bucket"),
            F.expr(f"place % {BUCKET_BITS}").alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    bits = bytearray(FILTER_BITS // 8)
    width = BUCKET_BITS // 8
    for row in parts.collect():
        bits[row["bucket"] * width:row["bucket"] * width + len(row["bits"])] = row["bits"]
    return bytes(bits)


def may_hold(bits: bytes, keys: np.ndarray) -> np.ndarray:
    """For each 64-bit key, whether the filter lets it pass."""
    place = np.mod(keys, FILTER_BITS)
    return (np.frombuffer(bits, np.uint8)[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def passes(bits: bytes, key: Column) -> Column:
    """The same as may_hold, as a column expression."""
    place = F.pmod(key, F.lit(FILTER_BITS))
    byte = F.substring(F.lit(bits), F.shiftright(place, 3).cast("int") + 1, F.lit(1))
    return F.getbit(
        F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 64,
    digest_all: bool = False,
) -> DataFrame:
    """Which document stays of each group of equal texts (A-Z lower-cased).

    Texts are grouped by length, those that share one by the hash of their first characters,
    and only those that share both are read whole and hashed (SHA-256). What is shuffled is
    an id, a length and hashes. Groups are pre-aggregated, so a group that holds a third of
    the rows costs no task more than its share.

    Returns one row per input row: id, keep_id, group_size, kept, digest, n_bytes. digest is
    null where no full hash was needed, unless `digest_all` asks for it.

    Null texts are empty texts. The largest id stays; ids may be null and lose against any
    other. Of rows that repeat an id and its text, one is kept. An empty table gives an empty
    one. Extra columns are ignored.
    """
    prefix = F.xxhash64(ascii_lower(F.substring("text", 1, prefix_chars)), "n_bytes")
    rows = id_and_text(docs, id_col, text_col).withColumn(
        "n_bytes", F.octet_length("text").cast("bigint"))

    def shared(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")

    lengths = key_filter(shared(rows.select("n_bytes"), "n_bytes").select(
        F.xxhash64("n_bytes").alias("key")))

    def in_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = may_hold(lengths, batch.column("key").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(mask)) for c in batch.columns[:-1]], ["n_bytes", "prefix"])

    by_length = rows.select("n_bytes", prefix.alias("prefix"), F.xxhash64("n_bytes").alias("key"))
    by_length = by_length.mapInArrow(in_lengths, "n_bytes long, prefix long")
    prefixes = key_filter(shared(by_length, "n_bytes", "prefix").select(
        F.col("prefix").alias("key")))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            surviving = may_hold(prefixes, batch.column("prefix").to_numpy())
            texts = batch.column("text")
            found = [
                hashlib.sha256(texts[i].as_buffer().to_pybytes().lower()).hexdigest()
                if digest_all or surviving[i] else None
                for i in range(len(texts))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), batch.column("prefix"),
                 pa.array(found, pa.string()), pa.array(surviving)],
                ["id", "n_bytes", "prefix", "digest", "surviving"])

    id_type = rows.schema["id"].dataType.simpleString()
    hashed = rows.withColumn("prefix", prefix).mapInArrow(
        digests, f"id {id_type}, n_bytes long, prefix long, digest string, surviving boolean")
    # Rows no other row can equal need no group; their key is their id, so that they spread.
    hashed = hashed.withColumn(
        "alone", F.when(F.col("surviving"), F.lit(None)).otherwise(F.xxhash64("id", "prefix")))
    keys = ["n_bytes", "prefix", "digest", "alone"]
    counted = written(hashed.groupBy("id", *keys).agg(F.count(F.lit(1)).alias("copies")))
    # Written, so that the join has its own exchanges and Spark can split a hot group there.
    groups = written(
        counted.where("alone is null").groupBy("n_bytes", "prefix", "digest")
        .agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    )
    grouped = counted.where("alone is null").join(groups, ["n_bytes", "prefix", "digest"])
    single = counted.where("alone is not null").select(
        "n_bytes", "prefix", "digest", "id", "alone", "copies",
        F.col("id").alias("keep_id"), F.col("copies").alias("group_size"))
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return grouped.unionByName(single).select("*", each.alias("copy")).select(
        "id", "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "digest", "n_bytes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without exact duplicates, all their columns kept.

    Of each group of equal texts the largest id stays, with one row.
    """
    groups = exact_groups(docs, id_col, text_col)
    lost = written(groups.where("not kept").select(
        F.col("id").alias("__pc_id"), F.col("digest").alias("__pc_digest"), "keep_id"))
    digest = F.sha2(ascii_lower(F.coalesce(docs[text_col], F.lit(""))), 256)
    same = docs[id_col].eqNullSafe(F.col("__pc_id")) & (digest == F.col("__pc_digest"))
    kept = docs.join(lost.where("not (__pc_id <=> keep_id)"), same, "left_anti")
    # Rows that repeat both the id and the text of the one that stays: one of them is left.
    repeated = lost.where("__pc_id <=> keep_id").distinct()
    if repeated.isEmpty():
        return kept
    first = (
        kept.join(repeated, same, "left_semi").withColumn("__pc_copy", digest)
        .dropDuplicates([id_col, "__pc_copy"]).drop("__pc_copy")
    )
    return kept.join(repeated, same, "left_anti").unionByName(first)


def op4_exact_dedup(spark, folder: str) -> DataFrame:
    groups = exact_groups(table(spark, folder, "documents"), digest_all=True)
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"), "n_bytes")


OP4_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept,
       sha256(t.norm) AS text_sha256, CAST(strlen(t.norm) AS BIGINT) AS n_bytes
FROM t JOIN g ON t.norm = g.norm
"""
