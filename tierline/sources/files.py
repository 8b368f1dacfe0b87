"""Folder listings through the Hadoop file system Spark itself uses.

Only names are handled here, never file contents.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a glob, sorted."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return sorted(str(s.getPath().toString()) for s in found) if found else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, in a folder that exists."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)
