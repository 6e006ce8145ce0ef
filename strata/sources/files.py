"""Files of the shared storage, through the file system API that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _place(spark, path)
    return fs.exists(at)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file; an existing one stays."""
    fs, at = _place(spark, path)
    if not fs.exists(at):
        fs.create(at, True).close()


def listed(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Names of the entries of a folder that match the pattern, sorted; none if there is no folder."""
    fs, at = _place(spark, path)
    if not fs.exists(at):
        return []
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(at, pattern))
    return sorted(f.getPath().getName() for f in found or [])


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder; one that is not there is no error."""
    fs, at = _place(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename within a file system; the target must not exist."""
    fs, at = _place(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{source} could not be renamed to {target}")
