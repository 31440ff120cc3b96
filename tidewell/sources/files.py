"""Small files that steer a run: created whole or not at all, listed by name, read as text."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """The path and the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content; ``False``, and nothing changed, where it exists already.

    The content goes to a file of another name first, which then takes the name in one step that fails if the name is taken:
    a hard link on a local disk, a rename that must not overwrite elsewhere. So of any number of
    writers one succeeds, and no reader sees half a file. The file system must rename atomically, as HDFS does.
    """
    jvm = spark._jvm
    target, files = _open(spark, path)
    draft, _ = _open(spark, f"{target.getParent()}/_{uuid.uuid4().hex}.draft")
    out = files.create(draft, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    try:
        if files.getScheme() == "file":
            local = [jvm.java.nio.file.Paths.get(files.makeQualified(p).toUri()) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            rename_new(spark, draft, target)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    finally:
        files.delete(draft, False)
    return True


def rename_new(spark: SparkSession, source, target) -> None:
    """Rename, or raise ``FileAlreadyExistsException`` where the name is taken."""
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def names(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder with their time of change in milliseconds; none where there is no folder."""
    path, files = _open(spark, folder)
    if not files.exists(path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(path)}


def read_text(spark: SparkSession, path: str) -> str:
    target, files = _open(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that it holds."""
    target, files = _open(spark, path)
    files.delete(target, True)
