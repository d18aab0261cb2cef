"""Small files on whatever storage Spark is set up with, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a file, '' where there is none."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return ""
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` at one stroke; False, and nothing changed, where it already exists.
    Readers see the whole text or no file, and of several writers one succeeds."""
    sc = spark.sparkContext
    folder, name = path.rsplit("/", 1)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, temporary, text)
    fs, source = file_system(spark, temporary)
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), options)
        return True
    except Exception:  # noqa: BLE001 - the gateway has one exception type for all of Java's
        if not fs.exists(target):
            raise
        fs.delete(source, False)
        return False


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder without those that Spark hides, [] where there is none."""
    fs, p = file_system(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if not n.startswith((".", "_")))


def size(spark: SparkSession, path: str) -> int:
    fs, p = file_system(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
