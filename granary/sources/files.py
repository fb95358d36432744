"""Listing, testing and writing files through the file system API of the cluster, so that any path it knows will do."""

from __future__ import annotations

import fnmatch

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _plain(path: str) -> str:
    """Local paths come back from the API with a scheme; they are known without it here."""
    return path[len("file:"):] if path.startswith("file:/") else path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def find_files(spark: SparkSession, folder: str, patterns: list[str]) -> list[str]:
    """All files below ``folder`` that match a pattern, sorted, each once; none where there is no such folder."""
    fs, p = _at(spark, folder)
    if not fs.exists(p):
        return []
    hits, it = set(), fs.listFiles(p, True)
    while it.hasNext():
        f = it.next().getPath()
        if any(fnmatch.fnmatch(f.getName(), x) for x in patterns):
            hits.add(_plain(f.toString()))
    return sorted(hits)


def find_folders(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Folders below ``folder`` whose name matches, sorted; they are not searched themselves."""
    fs, p = _at(spark, folder)
    if not fs.exists(p):
        return []
    out, todo = [], [p]
    while todo:
        for s in fs.listStatus(todo.pop()):
            if s.isDirectory():
                if fnmatch.fnmatch(s.getPath().getName(), pattern):
                    out.append(_plain(s.getPath().toString()))
                else:
                    todo.append(s.getPath())
    return sorted(out)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in UTF-8; an earlier one is replaced, folders above it are made."""
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file in UTF-8; None where there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    s = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(s, "UTF-8")
    finally:
        s.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
