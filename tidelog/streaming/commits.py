"""What a writer has finished: small files that appear by one rename, so that a reader sees all of a
batch or nothing of it, whatever is being written beside it."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def put(spark: SparkSession, folder: str, name: str, entry: dict[str, Any]) -> None:
    """Add an entry under a name that the folder does not have yet; it is there whole or not at all."""
    system, target = _system(spark, f"{folder}/{name}")
    _, draft = _system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    if not system.rename(draft, target):
        system.delete(draft, False)
        raise RuntimeError(f"{folder}/{name} was written by another writer")


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of all entries, in order."""
    system, at = _system(spark, folder)
    if not system.exists(at):
        return []
    found = [status.getPath().getName() for status in system.listStatus(at)]
    return sorted(n for n in found if not n.startswith("."))


def get(spark: SparkSession, folder: str, name: str) -> dict[str, Any]:
    system, at = _system(spark, f"{folder}/{name}")
    stream = system.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


#: Entries that the driver reads by itself.
FEW = 32


def entries(spark: SparkSession, folder: str) -> list[dict[str, Any]]:
    """All entries, in order of their names; many small files are read by Spark's tasks."""
    found = names(spark, folder)
    if len(found) <= FEW:
        return [get(spark, folder, n) for n in found]
    rows = spark.read.text([f"{folder}/{n}" for n in found], wholetext=True)
    texts = rows.select("value", rows["_metadata.file_name"].alias("name")).collect()
    return [json.loads(r["value"]) for r in sorted(texts, key=lambda r: r["name"])]


def make_folder(spark: SparkSession, path: str) -> None:
    system, at = _system(spark, path)
    system.mkdirs(at)


def delete(spark: SparkSession, path: str) -> None:
    system, at = _system(spark, path)
    system.delete(at, True)
