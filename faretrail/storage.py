"""Small file operations on whatever store a path names, through Spark's Hadoop client."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; a missing folder has none."""
    p, fs = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; a missing one is no error."""
    p, fs = _at(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, read alone and unpacked by the ending of its name, as Spark's
    readers do; empty for an empty file."""
    p, fs = _at(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    if codec is not None and fs.getFileStatus(p).getLen() == 0:  # no codec takes a file without a byte
        return ""
    stream = fs.open(p)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def move(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename unless ``dst`` exists; whether it was done.  One step on stores that rename."""
    sc = spark.sparkContext
    (a, fs), (b, _) = _at(spark, src), _at(spark, dst)
    kind = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = sc._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(a), fs.makeQualified(b), options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file that doesn't exist yet, in one step; False if it does."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    p, fs = _at(spark, draft)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if move(spark, draft, path):
        return True
    fs.delete(p, False)
    return False


def literal(path: str) -> str:
    """``path`` as a pattern that means itself alone, for readers that take patterns."""
    return "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in path)


def listing(spark: SparkSession, folder: str, suffix: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, length, modificationTime, partition columns) of the files under ``folder``, without
    opening any; ``recursive`` takes nested folders as they are, without partition columns.
    A missing folder has no files."""
    reader = spark.read.format("binaryFile")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    try:
        return reader.load(folder).drop("content")
    except PySparkException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition() or ""):
            raise
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long")
