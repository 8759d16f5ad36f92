"""Small files in the shared folder, written by the driver: claims and records of versions.

They go through the Hadoop file system that Spark itself uses. Creating a file only if it is
not there yet must be atomic: it is on local disks (hard link) and on HDFS (a rename never
replaces a file). On object stores it needs a connector that refuses to overwrite.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def put_if_absent(spark: SparkSession, path: str, records: Iterable[dict]) -> bool:
    """Write JSON lines to a new file, whole or not at all; False if the file exists."""
    data = "".join(json.dumps(r, default=str) + "\n" for r in records).encode()
    folder, name = path.rsplit("/", 1)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    system, target = _located(spark, path)
    _, source = _located(spark, part)
    system.mkdirs(target.getParent())
    if system.getUri().getScheme() == "file":
        source, target = (p.toUri().getPath() for p in (source, target))
        with open(source, "wb") as out:
            out.write(data)
        try:
            os.link(source, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(source)
        return True
    out = system.create(source, False)
    try:
        out.write(data)
    finally:
        out.close()
    if not system.exists(target) and system.rename(source, target):
        return True
    system.delete(source, False)
    return False


def listed(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(name, size, time of change) of what lies in a folder; nothing if there is none."""
    system, location = _located(spark, folder)
    if not system.exists(location):
        return []
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime())
             for s in system.listStatus(location)]
    return sorted(f for f in found if not f[0].startswith("."))


def data_files(spark: SparkSession, folder: str) -> int:
    """How many files lie below a folder; 0 if there is none."""
    system, location = _located(spark, folder)
    return system.getContentSummary(location).getFileCount() if system.exists(location) else 0


def remove(spark: SparkSession, path: str) -> None:
    system, location = _located(spark, path)
    system.delete(location, True)
