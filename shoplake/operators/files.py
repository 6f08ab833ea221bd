"""Directory operations on whatever file system a path is on (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to this directory finished."""
    return exists(spark, f"{path}/_SUCCESS")


def text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """Write a small file, whole or not at all: it is written aside and moved."""
    fs, p = _open(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_{p.getName()}.new")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"cannot write {path}")


def make(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a directory in place of another."""
    fs, src = _open(spark, source)
    _, dst = _open(spark, target)
    fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories in a directory; empty if it does not exist."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
