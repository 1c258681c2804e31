"""Small numbered JSON documents beside a table: which files are live, what time it is.

A version is written under another name and renamed, so a reader finds it whole
or not at all. It is the one commit of whatever was written before it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: Versions that are kept: a batch that runs again reads the one before its own.
KEPT = 10


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that the caller's job has made; nothing happens if it is not there."""
    files, where = _files(spark, path)
    files.delete(where, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly under a folder; nothing if it is not there."""
    files, where = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def write_json(spark: SparkSession, path: str, value) -> None:
    """Replace the document at ``path`` in one step."""
    files, target = _files(spark, path)
    _, aside = _files(spark, f"{path}.{uuid.uuid4().hex[:8]}.new")
    out = files.create(aside, True)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    overwrite = spark._sc._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    overwrite[0] = getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, target, overwrite)


def read_json(spark: SparkSession, path: str):
    files, where = _files(spark, path)
    stream = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in names(spark, folder) if n.endswith(".json") and n[:1].isdigit())


def read_version(spark: SparkSession, folder: str, before: int | None = None):
    """(number, document) of the newest version, or of the newest below ``before``; (None, None) if there is none."""
    known = [v for v in versions(spark, folder) if before is None or v < before]
    return (known[-1], read_json(spark, f"{folder}/{known[-1]:012d}.json")) if known else (None, None)


def write_version(spark: SparkSession, folder: str, number: int, value) -> None:
    """Write a version and forget those that no replay can need."""
    write_json(spark, f"{folder}/{number:012d}.json", value)
    for old in versions(spark, folder)[:-KEPT]:
        remove(spark, f"{folder}/{old:012d}.json")
