"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelhouse.session import checkpointed, shared_dir, tuned

ROWS_PER_FILE = 100_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings for whole texts: small Arrow batches, as texts may be very long."""
    tuned(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; null texts are empty.

    Other columns, whatever they are called, are left behind here.
    """
    return docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def tokens(text: str) -> list[bytes]:
    """A-Z lower-cased runs of anything but ASCII white space (bytes.split's white space)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator], schema: str):
    return df.mapInArrow(function, schema)


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(function: Callable[[Iterator[pa.RecordBatch]], Iterator]) -> Callable:
    """The same function for mapInArrow; its worker, which lives on beside the executor's heap
    and waits for other tasks, keeps nothing that was freed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return run


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(name).to_pylist() for name in names]


def written(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write a frame to the shared folder once; a lost executor never recomputes it.

    With `rows`, the most it may hold, a small frame is written by fewer tasks: as many as
    the cluster runs at a time, or one for ROWS_PER_FILE rows. Each file costs an executor
    several processes of its own (Hadoop sets the rights of local files by calling chmod).
    """
    if rows is not None:
        running = df.sparkSession.sparkContext.defaultParallelism
        df = df.coalesce(shards_for(rows, ROWS_PER_FILE, running))
    return checkpointed(df)


def shards_for(rows: int, rows_per_shard: int, least: int = 8) -> int:
    return max(least, -(-rows // rows_per_shard))


# Files that executors write for one another. They lie in the shared folder only.

def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one, as a URI or local path."""
    return f"{shared_dir(spark).rstrip('/')}/parcelhouse/{purpose}-{uuid.uuid4().hex}"


def is_local(uri: str) -> bool:
    return urlparse(uri).scheme in ("", "file")


def local_path(uri: str) -> str:
    return urlparse(uri).path if urlparse(uri).scheme else uri


def store_bytes(uri: str, data: bytes) -> None:
    """Write a file so that readers see it whole or not at all, also if the task runs twice."""
    from pyarrow import fs

    if is_local(uri):
        path = local_path(uri)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            out.write(data)
        os.replace(part, path)
        return
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, path)


def mapped(uri: str) -> np.ndarray:
    """The bytes of a shared file, memory-mapped.

    A file that is no local one is first copied to a nameless temporary file, which goes
    when the mapping does.
    """
    if is_local(uri):
        return np.memmap(local_path(uri), np.uint8, "r")
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    copy = tempfile.TemporaryFile()
    with store.open_input_stream(path) as source:
        shutil.copyfileobj(source, copy)
    copy.flush()
    return np.memmap(copy, np.uint8, "r")
