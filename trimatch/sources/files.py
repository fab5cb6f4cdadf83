"""Where a row came from: file identity and a position that all runs agree on.

A position is the struct (ordinal of the input path in the list given, path of
the file if that input is a folder, block start inside the file, running
number).  Comparing positions compares files first, in the order the caller
listed them and by name inside a folder, then the place in the file, however
Spark cuts and orders its splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def qualified(spark: SparkSession, path: str) -> str:
    """The path as file listings show it, scheme included."""
    fs, p = _path(spark, path)
    return fs.makeQualified(p).toUri().toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an output folder that this job has just written."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def file_path() -> Column:
    """Full path of the row's file: two files of one base name stay apart."""
    return F.col("_metadata.file_path")


def ordinal(spark: SparkSession, paths: Sequence[str]) -> Column:
    """Index in ``paths`` of the input (a file or a folder) the row is from."""
    if len(paths) == 1:
        return F.lit(0)
    listed = F.array(*[F.regexp_replace(F.lit(qualified(spark, p)), SCHEME, "") for p in paths])
    here = F.regexp_replace(file_path(), SCHEME, "")
    return (F.array_position(F.transform(listed, lambda p: (here == p) | here.startswith(F.concat(p, F.lit("/")))), True) - 1).cast("int")


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def data_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The files under the given files, folders and patterns that a read sees
    (names that begin with ``_`` or ``.`` are hidden)."""
    out = []

    def visit(fs, status) -> None:
        if not status.isDirectory():
            out.append(status.getPath().toString())
            return
        for s in fs.listStatus(status.getPath()):
            if not s.getPath().getName().startswith(("_", ".")):
                visit(fs, s)
    for path in paths:
        fs, p = _path(spark, path)
        for status in fs.globStatus(p) or ():
            visit(fs, status)
    return out


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        found = [stream.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in found if b >= 0)


def position(spark: SparkSession, paths: Sequence[str]) -> Column:
    inside = file_path() if any(is_folder(spark, p) for p in paths) else F.lit("")
    return F.struct(ordinal(spark, paths).alias("file_no"), inside.alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def inputs_digest(spark: SparkSession, paths: Sequence[str], *params) -> str:
    """Digest of what a job reads: the files under ``paths`` (names, sizes,
    modification times) and ``params``.  New extracts give a new digest."""
    h = hashlib.sha256(repr(params).encode())
    for path in paths:
        fs, p = _path(spark, path)
        found = fs.listFiles(p, True) if fs.getFileStatus(p).isDirectory() else None
        status = []
        if found is None:
            status.append(fs.getFileStatus(p))
        else:
            while found.hasNext():
                status.append(found.next())
        for line in sorted(f"{s.getPath()}|{s.getLen()}|{s.getModificationTime()}" for s in status):
            h.update(line.encode())
    return h.hexdigest()[:16]
