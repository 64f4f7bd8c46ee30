"""Numbered commits that are put only if absent, over any file system Spark reads.

What a commit holds is written to a file of its own first and then given the version's name in one step
that fails if the name is taken, so a version is there whole or not at all: a killed writer leaves
nothing that others could meet, and of two writers of one version one gets it. The step is a hard link
on a local folder and a rename without overwriting elsewhere, which HDFS and stores with such a rename
do atomically.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer has committed since the version this one is based on."""


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path; there is no public Spark API for it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, in order."""
    files, where = _files(spark, f"{path}/{COMMITS}/version=*")
    return sorted(int(s.getPath().getName().rsplit("=", 1)[1]) for s in files.globStatus(where) or [])


def read_commit(spark: SparkSession, path: str, version: int) -> dict:
    files, where = _files(spark, f"{path}/{COMMITS}/version={version}")
    stream = files.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, version: int, content: dict) -> bool:
    """Make ``content`` the given version; False if there is one."""
    files, draft = _files(spark, f"{path}/{COMMITS}/.draft-{uuid.uuid4().hex}")
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/version={version}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    try:
        if files.getScheme() == "file":
            return _link(draft.toUri().getPath(), final.toUri().getPath())
        return _rename(spark, draft, final)
    finally:
        files.delete(draft, False)


def _link(draft: str, final: str) -> bool:
    try:
        os.link(draft, final)
    except FileExistsError:
        return False
    return True


def _rename(spark: SparkSession, draft, final) -> bool:
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, final, options)
    except Exception as e:  # the JVM's exception arrives as a general one
        if "AlreadyExists" in str(e):
            return False
        raise
    return True


def commit_next(
    spark: SparkSession, path: str, build: Callable[[int | None, dict | None], dict], attempts: int = 10
) -> int:
    """Commit what ``build`` makes of the newest version and its content (None: none), rebased on conflict."""
    for _ in range(attempts):
        known = versions(spark, path)
        base = known[-1] if known else None
        content = build(base, None if base is None else read_commit(spark, path, base))
        version = 0 if base is None else base + 1
        if publish(spark, path, version, content):
            return version
    raise CommitConflict(f"{attempts} other commits to {path} came first")
