"""Path tests, removals and replacements through Hadoop's file system, on any store Spark can reach."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

# Folders beside a table's own that readers skip: results not yet in place, and what they replace.
STAGED, OLD = "_staged", "_old"


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _locate(spark, path)
    return fs.exists(p)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    fs, p = _locate(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Names of the files directly below ``path`` that end so."""
    fs, p = _locate(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []
    return sorted(name for name in names if name.endswith(suffix))


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since the folder or file was last changed."""
    fs, p = _locate(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _locate(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _locate(spark, target)
    fs.mkdirs(p.getParent())
    if not fs.rename(_locate(spark, source)[1], p):
        raise OSError(f"cannot move {source} to {target}")


def split(path: str) -> tuple[str, str]:
    parent, name = path.rstrip("/").rsplit("/", 1)
    return parent, name


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a completely written folder in place of ``path``.

    The old folder is moved aside first and deleted last, so at every moment one of the two
    is whole under a name that :func:`recover` knows. Where a rename copies, as on object
    stores, this costs a copy of both.
    """
    parent, name = split(path)
    aside = f"{parent}/{OLD}/{name}"
    if exists(spark, path):
        move(spark, path, aside)
    move(spark, staged, path)
    remove(spark, aside)
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo what an interrupted job left of table ``path``; every job begins with it.

    A folder that is in place was swapped in, so what it replaced goes. One that is missing
    gets its old content back. Staged folders go: their job runs again.
    """
    parent, name = split(path)
    for base, names in ((parent, {name}), (path, None)):
        for child in subfolders(spark, f"{base}/{OLD}"):
            if names is not None and child not in names:
                continue
            if exists(spark, f"{base}/{child}"):
                remove(spark, f"{base}/{OLD}/{child}")
            else:
                move(spark, f"{base}/{OLD}/{child}", f"{base}/{child}")
    remove(spark, f"{parent}/{STAGED}/{name}")
    remove(spark, f"{path}/{STAGED}")
