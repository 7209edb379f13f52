"""Small files and listings through Spark's own file systems, so that any path that Spark reads will do."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

POINTER = "_current"


def _open(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(conf)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole text of a small file, or none if it is absent."""
    jvm, where, system = _open(spark, path)
    if not system.exists(where):
        return None
    stream = system.open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside and rename it over: readers find the old text or the new one, never a part."""
    jvm, where, system = _open(spark, path)
    system.mkdirs(where.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(where.getParent(), f"{where.getName()}.{uuid4().hex}")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(beside), system.makeQualified(where), options)


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change (ms) of the file at a path, or of the files in the folder there; empty if absent."""
    _, where, system = _open(spark, path)
    if not system.exists(where):
        return []
    found = system.listStatus(where)
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found if f.isFile())


def folders(spark: SparkSession, path: str) -> list[str]:
    _, where, system = _open(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(where) if f.isDirectory()) if system.exists(where) else []


def drop_folder(spark: SparkSession, path: str) -> None:
    _, where, system = _open(spark, path)
    system.delete(where, True)


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table lie: the version its pointer names, or the path itself for a table without one."""
    name = read_text(spark, f"{path.rstrip('/')}/{POINTER}")
    return f"{path.rstrip('/')}/{name.strip()}" if name else path
