"""Reproducible shuffle of documents into shards of equal row counts.

Every row has a global number: its place in the order of id, text checksum and size. A
Feistel network permutes these numbers, and the permuted number says shard and slot. So the
place of any row can be computed from its number alone, and the row at any place from the
place, without a table of the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import table, written

SHARDS = 40
SEED = 13
ROUNDS = 8
FRAME_BYTES = 16
ROWS_PER_TASK = 1_000_000
ROWS_PER_FILE = 250_000


class Permutation:
    """A permutation of 0 .. rows - 1, chosen by the seed.

    A balanced Feistel network permutes the numbers of the smallest even count of bits that
    holds all rows, fewer than four times as many as there are rows. A number it sends
    outside is sent on until it comes back inside (cycle walking), which it must, as its own
    cycle starts inside.
    """

    def __init__(self, rows: int, seed: int = SEED):
        self.rows = rows
        bits = max(1, -(-(max(rows, 2) - 1).bit_length() // 2))
        self.bits, self.mask = np.uint64(bits), np.uint64((1 << bits) - 1)
        self.keys = [
            np.uint64(int.from_bytes(
                hashlib.sha256(f"{seed}/{k}".encode()).digest()[:8], "little"))
            for k in range(ROUNDS)
        ]

    def _mixed(self, half: np.ndarray, key: np.uint64) -> np.ndarray:
        """Half of a number, hashed with a round's key; arithmetic is modulo 2**64."""
        x = (half + key) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return x & self.mask

    def _once(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        left, right = numbers >> self.bits, numbers & self.mask
        for key in reversed(self.keys) if back else self.keys:
            if back:
                left, right = right ^ self._mixed(left, key), left
            else:
                left, right = right, left ^ self._mixed(right, key)
        return left << self.bits | right

    def _walked(self, numbers: np.ndarray, back: bool) -> np.ndarray:
        numbers = np.asarray(numbers)
        found = self._once(numbers.astype(np.uint64).reshape(-1), back)
        outside = np.flatnonzero(found >= self.rows)
        while outside.size:
            found[outside] = self._once(found[outside], back)
            outside = outside[found[outside] >= self.rows]
        return found.astype(np.int64).reshape(numbers.shape)

    def forth(self, numbers: np.ndarray) -> np.ndarray:
        return self._walked(numbers, False)

    def back(self, numbers: np.ndarray) -> np.ndarray:
        return self._walked(numbers, True)


def place(numbers: np.ndarray, rows: int, shards: int = SHARDS, seed: int = SEED):
    """(shards, slots) of global row numbers."""
    permuted = Permutation(rows, seed).forth(numbers)
    return permuted % shards, permuted // shards


def row_at(shard: np.ndarray, slot: np.ndarray, rows: int, shards: int = SHARDS, seed: int = SEED):
    """The global row numbers at (shard, slot): the inverse of `place`."""
    return Permutation(rows, seed).back(np.asarray(slot) * shards + np.asarray(shard))


def _ranges(keyed: DataFrame, rows_per_task: int) -> tuple[DataFrame, dict[int, int], int]:
    """Rows in global order, in ranges; the first number of each range; and how many rows.

    Equal rows are told apart by where they were read, so that a range never holds more than
    its share, whatever repeats. The ranges are written before they are counted: a boundary
    that moved between two uses would give wrong numbers. Only one count per range comes to
    the driver.
    """
    rows = keyed.count()
    order = ("key.id", "key.crc", "key.size", "tie")
    ranged = written(
        keyed.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(max(1, -(-rows // rows_per_task)), *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )
    sizes = {r["part"]: r["n"] for r in ranged.groupBy("part").agg(F.count("part").alias("n")).collect()}
    starts, at = {}, 0
    for part in sorted(sizes):
        starts[part], at = at, at + sizes[part]
    return ranged, starts, rows


def _keys(docs: DataFrame, id_col: str, text_col: str):
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return F.struct(
        docs[id_col].alias("id"),
        (F.octet_length(text) + F.lit(FRAME_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    ).alias("key")


def _placed(ranged: DataFrame, starts: dict[int, int], rows: int, shards: int, seed: int) -> DataFrame:
    """Ranged rows with number, shard and slot; nothing is shuffled."""
    carried = [c for c in ranged.columns if c not in ("tie", "part")]
    types = ", ".join(f"`{c}` {ranged.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutation, at = Permutation(rows, seed), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            first = at.get(part, starts[part])
            numbers = np.arange(first, first + batch.num_rows, dtype=np.int64)
            at[part] = first + batch.num_rows
            permuted = permutation.forth(numbers)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in carried]
                + [pa.array(numbers), pa.array((permuted % shards).astype(np.int32)),
                   pa.array(permuted // shards)],
                [*carried, "number", "shard", "slot"])

    return ranged.mapInArrow(run, f"{types}, number long, shard int, slot long")


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
    text_col: str = "text", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """id, size, crc, number, shard, slot of every row; texts are read once and not moved.

    Shards differ by one row at most, and the slots of a shard run from 0 without gaps. The
    result depends on the rows, `shards` and `seed` only, not on files or partitions. Size is
    the text's UTF-8 bytes plus 16, crc its CRC-32.

    Null texts count as empty. Rows with a null id come first and are placed like others.
    Rows equal in id, checksum and size get different numbers; which of them gets which makes
    no difference here. An empty table gives no row. Extra columns are ignored.
    """
    keyed = written(docs.select(_keys(docs, id_col, text_col)))
    placed = _placed(*_ranges(keyed, rows_per_task), shards, seed)
    return placed.select("key.id", "key.size", "key.crc", "number", "shard", "slot")


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id",
    text_col: str = "text", rows_per_task: int = ROWS_PER_TASK, rows_per_file: int = ROWS_PER_FILE,
) -> int:
    """Write whole rows below `path` in shuffled order; returns how many there are.

    The row at (shard, slot) lies in shard=<shard>/part=<slot // rows_per_file>, sorted by
    slot; its own columns are the struct `row`, so that no name can clash. A file holds
    `rows_per_file` rows at most, so no task writes a whole shard. Null, repeated and empty
    inputs are treated as in assign_shards; of rows equal in id, checksum and size but not
    in other columns, the order among themselves is open.
    """
    keyed = docs.select(_keys(docs, id_col, text_col), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    ranged, starts, rows = _ranges(keyed, rows_per_task)
    placed = _placed(ranged, starts, rows, shards, seed).select(
        "shard", F.expr(f"slot div {rows_per_file}").alias("part"), "slot", "row")
    files = shards * max(1, -(-rows // (shards * rows_per_file)))
    (
        placed.repartition(files, "shard", "part").sortWithinPartitions("shard", "part", "slot")
        .write.partitionBy("shard", "part").parquet(path)
    )
    return rows


def op13_sharding(spark, folder: str) -> DataFrame:
    """Law `rows`: counts at most one apart. Equal texts are spread like any other rows."""
    placed = assign_shards(table(spark, folder, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "number")
