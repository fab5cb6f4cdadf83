"""Incremental staging (A7): every source file is parsed once, whatever lands
beside it later.

``<stage>/data/<digest>`` holds the parsed rows of one file; the digest is of
its name, size, time and the parse parameters.  ``<stage>/manifest/v=<n>``
lists the files of a version in order.  A version counts once Spark has put
``_SUCCESS`` beside its rows, so a run that is killed leaves the version
before it as it was, and the next run takes up the files that were finished.
A changed file has a new digest and is parsed again; a file that is no longer
listed is left out of the new version (its rows stay for the old one).  One
writer at a time.

File order is that of the list given, and by name inside a folder.  A file
without rows stays in the manifest; no file at all is an error.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trimatch.sources.files import _path, data_files, exists, inputs_digest
from trimatch.sources.invoices import align_union
from trimatch.sources.staging import stage_path

MANIFEST = "file_no int, path string, digest string, schema string"


def committed(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished ``v=<n>`` folders, oldest first."""
    fs, p = _path(spark, folder)
    if not fs.exists(p):
        return []
    names = (re.fullmatch(r"v=(\d+)", s.getPath().getName()) for s in fs.listStatus(p))
    return sorted(int(m[1]) for m in names if m and exists(spark, f"{folder}/{m[0]}/_SUCCESS"))


@dataclass(frozen=True)
class StagedFiles:
    """A version of a staged set of files; ``added`` were parsed by this run."""
    root: str
    version: int
    files: tuple[tuple[int, str, str, str], ...]
    added: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, one scan for each layout that the files have; the file's
        place in the version is the first part of ``src_pos``."""
        layouts: dict[str, list[tuple[int, str]]] = {}
        for no, _, digest, schema in self.files:
            layouts.setdefault(schema, []).append((no, digest))
        frames = []
        for schema, members in layouts.items():
            rows = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*[f"{self.root}/data/{d}" for _, d in members])
            digest = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            numbers = F.create_map(*[F.lit(x) for no, d in members for x in (d, no)])
            frames.append(rows.withColumn("src_pos", F.col("src_pos").withField("file_no", F.element_at(numbers, digest))))
        return align_union(frames)


def latest(spark: SparkSession, name: str, base: str | None = None) -> StagedFiles | None:
    """The newest finished version, if there is one."""
    root = stage_path(spark, name, base)
    versions = committed(spark, f"{root}/manifest")
    if not versions:
        return None
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v={versions[-1]}").collect()
    return StagedFiles(root, versions[-1], tuple(sorted(tuple(r) for r in rows)))


def stage_files(spark: SparkSession, name: str, paths: Sequence[str], parse: Callable[[str], DataFrame],
                params: Sequence = (), base: str | None = None, parallel: int = 4) -> StagedFiles:
    """Bring the staged set ``name`` up to the files under ``paths``: parse
    those it doesn't have (concurrent jobs, each split across tasks) and commit
    a new version, unless nothing changed.  ``parse`` gives the rows of one
    file with ``src_pos``; ``params`` name what else its result depends on."""
    root = stage_path(spark, name, base)
    listed = list(dict.fromkeys(f for p in paths for f in sorted(data_files(spark, [p]))))
    if not listed:
        raise ValueError(f"{name}: no files under {list(paths)}")
    digests = {f: inputs_digest(spark, [f], *params) for f in listed}
    old = latest(spark, name, base)
    known = {digest: schema for _, _, digest, schema in old.files} if old else {}

    def add(path: str) -> str:
        rows, folder = parse(path), f"{root}/data/{digests[path]}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            rows.write.mode("overwrite").parquet(folder)
        return rows.schema.json()

    new = [f for f in listed if digests[f] not in known]
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(new) or 1))) as pool:
        known |= {digests[f]: schema for f, schema in zip(new, pool.map(add, new), strict=True)}
    files = tuple((i, f, digests[f], known[digests[f]]) for i, f in enumerate(listed))
    if old and old.files == files:
        return old
    version = old.version + 1 if old else 1
    spark.createDataFrame(list(files), MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v={version}")
    return StagedFiles(root, version, files, tuple(new))
