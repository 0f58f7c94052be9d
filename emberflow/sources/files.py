"""Small file operations on whatever file system a path names, by Spark's own Hadoop client.

Only the driver calls these, for single names: what a table consists of, or
whether a batch was written. Data goes through Spark's readers and writers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another name in one step; there must be nothing of that name."""
    fs, p = _at(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(to):
        raise FileExistsError(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears under its name complete, and only if that is free."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}.tmp"
    fs, p = _at(spark, hidden)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, hidden, path)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
