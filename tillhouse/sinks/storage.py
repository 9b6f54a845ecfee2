"""Files and folders of the storage that Spark reads and writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    files, p = _at(spark, path)
    return files.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names below a folder, in order; none if it is not there."""
    files, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(p)) if files.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    files, p = _at(spark, path)
    files.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    files, p = _at(spark, path)
    files.delete(p, True)


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet; an error if it is. Where a write
    breaks off, an empty file may be left."""
    files, p = _at(spark, path)
    out = files.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()

