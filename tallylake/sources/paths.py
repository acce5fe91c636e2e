"""Files and folders on whatever file system a path names."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, path = _located(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(path) or []]


def file_stamps(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change of the files a pattern names, hidden ones too.

    One line per file on the driver, as in Spark's own listing of an input folder.
    """
    fs, path = _located(spark, pattern)
    return [
        (s.getPath().getName(), s.getLen(), s.getModificationTime())
        for s in fs.globStatus(path) or []
        if s.isFile()
    ]


def is_hidden(name: str) -> bool:
    """Whether Spark passes over a file of this name."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def literal_path(path: str) -> str:
    """Escape the characters a Hadoop glob would interpret."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path.rstrip("/"))


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, path = _located(spark, old)
    if not fs.rename(path, _located(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def create_empty(spark: SparkSession, path: str) -> None:
    fs, located = _located(spark, path)
    fs.create(located).close()


def delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Have a folder that exists deleted when the driver ends; until then plans may read it."""
    fs, path = _located(spark, folder)
    fs.deleteOnExit(path)


def delete_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _located(spark, folder)
    if not fs.delete(path, True) and fs.exists(path):
        raise OSError(f"cannot delete {folder}")
