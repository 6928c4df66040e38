"""Folders and files in whatever store Spark is set up for, by its own file systems; names and sizes only."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, store = _at(spark, path)
    return store.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    target, store = _at(spark, path)
    store.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    target, store = _at(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(target)) if store.exists(target) else []


def digest(spark: SparkSession, path: str) -> str | None:
    """Of names, sizes and times of the files that a path or glob names; none if it names nothing."""
    target, store = _at(spark, path)
    found = store.globStatus(target) or []
    said = []
    for top in found:
        files = store.listFiles(top.getPath(), True)
        while files.hasNext():
            f = files.next()
            said.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(said)).encode()).hexdigest() if said else None
