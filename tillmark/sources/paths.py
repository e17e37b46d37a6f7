"""Paths through the Hadoop file system, so that any storage Spark reads will do."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

from tillmark.config import RAW_COLUMNS


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    located = context._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(context._jsc.hadoopConfiguration()), located


def path_exists(spark: SparkSession, path: str) -> bool:
    files, located = _file_system(spark, path)
    return files.exists(located)


def remove_path(spark: SparkSession, path: str) -> None:
    files, located = _file_system(spark, path)
    files.delete(located, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none, if it isn't there."""
    files, located = _file_system(spark, path)
    if not files.exists(located):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(located))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    files, located = _file_system(spark, path)
    return files.getContentSummary(located).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    files, located = _file_system(spark, path)
    stream = files.open(located)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, path: str, to: str) -> bool:
    """One rename; False, if there is something already."""
    files, source = _file_system(spark, path)
    _, target = _file_system(spark, to)
    return not files.exists(target) and files.rename(source, target)


def replace_file(spark: SparkSession, path: str, to: str) -> None:
    """One rename that takes the place of whatever file is there."""
    context = spark.sparkContext
    java = context._jvm
    files = java.org.apache.hadoop.fs.FileContext.getFileContext(
        java.org.apache.hadoop.fs.Path(to).toUri(), context._jsc.hadoopConfiguration()
    )
    options = context._gateway.new_array(java.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = java.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(java.org.apache.hadoop.fs.Path(path), java.org.apache.hadoop.fs.Path(to), options)


def join_files(spark: SparkSession, first: str, parts: list[str], to: str) -> None:
    """Writes a text and after it the parts, one after the other, a buffer at a time."""
    java = spark.sparkContext._jvm
    files, located = _file_system(spark, to)
    out = files.create(located, True)
    try:
        out.write(bytearray(first.encode()))
        for part in parts:
            source = files.open(java.org.apache.hadoop.fs.Path(part))
            try:
                java.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            finally:
                source.close()
    finally:
        out.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file aside and puts it in place by one rename; False, if one is there."""
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    files, located = _file_system(spark, aside)
    stream = files.create(located, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if move(spark, aside, path):
        return True
    remove_path(spark, aside)
    return False


def export_path(raw_dir: str, table: str) -> str:
    return f"{raw_dir.rstrip('/')}/{table}.csv"


def check_arrival(
    spark: SparkSession, raw_dir: str, tables: Iterable[str] = tuple(RAW_COLUMNS)
) -> None:
    """Raises unless every export has arrived, naming those that have not."""
    missing = [f"{t}.csv" for t in tables if not path_exists(spark, export_path(raw_dir, t))]
    if missing:
        raise FileNotFoundError(f"Missing source files: {missing}")
