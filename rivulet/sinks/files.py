"""Small files and folder names in the shared file system, by Spark's own
Hadoop client (whatever store a path names)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it does not exist."""
    _, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, over what is there."""
    _, p, fs = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder in one step; False if the target exists."""
    jvm, src, fs = _fs(spark, source)
    _, dst, _ = _fs(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    never = spark.sparkContext._gateway.new_array(kind, 1)
    never[0] = kind.NONE
    try:
        context.rename(src, dst, never)
    except Exception as e:  # py4j wraps the file system's exception
        if "FileAlreadyExistsException" in str(e) or fs.exists(dst):
            return False
        raise
    return True


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that readers see whole or not at all; False if it exists."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/_draft-{name}-{uuid.uuid4().hex[:8]}"
    write_text(spark, draft, text)
    done = rename_new(spark, draft, path)
    if not done:
        delete(spark, draft)
    return done


def names(spark: SparkSession, path: str, folders_only: bool = False) -> list[str]:
    """Names in a folder (none if it does not exist)."""
    _, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() or not folders_only]


def folders(spark: SparkSession, path: str) -> list[str]:
    return names(spark, path, folders_only=True)


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        _, p, fs = _fs(spark, path)
        fs.delete(p, True)
