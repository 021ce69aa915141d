"""Path operations on whatever file system Spark is configured with."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, sorted by name."""
    found = _file_system(spark, pattern).globStatus(_path(spark, pattern)) or []
    return sorted(status.getPath().toString() for status in found)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small file."""
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str, temporary: str) -> bool:
    """Publish one small file under a name that must be new; False if the name is taken.

    The text is written aside and renamed without overwriting. On file systems with a true rename that is one step, and of two
    writers one wins.
    """
    stream = _file_system(spark, path).create(_path(spark, temporary), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, temporary), _path(spark, path), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        delete(spark, temporary)
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under a path; 0 if there is none."""
    if not exists(spark, path):
        return 0
    return _file_system(spark, path).getContentSummary(_path(spark, path)).getLength()
