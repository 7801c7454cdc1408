"""The few things a store does with files themselves: exclusive creation, removal, existence.

Local paths use the operating system, whose hard links create a name only if it is new. Other
file systems go through Hadoop's `FileContext`, whose rename refuses an existing target; HDFS
does that in one step.
"""

from __future__ import annotations

import os
import shutil
import uuid
from urllib.parse import urlparse
from urllib.request import url2pathname

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def _default_scheme(spark: SparkSession) -> str:
    return urlparse(spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")).scheme


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the local file system, None if it lies elsewhere."""
    parsed = urlparse(path)
    if (parsed.scheme or _default_scheme(spark)) != "file":
        return None
    return url2pathname(parsed.path) if parsed.scheme else path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at the path."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).schema
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_ends(spark: SparkSession, path: str, n_bytes: int) -> tuple[int, bytes, bytes]:
    """(size, the first and the last ``n_bytes`` of a file); what lies between is not read."""
    local = local_path(spark, path)
    if local is not None:
        size = os.path.getsize(local)
        with open(local, "rb") as source:
            head = source.read(n_bytes)
            source.seek(max(0, size - n_bytes))
            return size, head, source.read(n_bytes)
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(context._jsc.hadoopConfiguration())
    size = fs.getFileStatus(target).getLen()
    source = fs.open(target)
    try:
        head = bytes(source.readNBytes(n_bytes))
        source.seek(max(0, size - n_bytes))
        return size, head, bytes(source.readNBytes(n_bytes))
    finally:
        source.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a content, or return False if there is one of that name.

    Of several writers at once exactly one succeeds, and nobody sees half a file.
    """
    local = local_path(spark, path)
    if local is None:
        return put_by_rename(spark, path, text)
    os.makedirs(os.path.dirname(local), exist_ok=True)
    draft = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
    with open(draft, "w", encoding="utf-8") as out:
        out.write(text)
        out.flush()
        os.fsync(out.fileno())
    try:
        os.link(draft, local)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


def put_by_rename(spark: SparkSession, path: str, text: str) -> bool:
    """`put_if_absent` for file systems that Hadoop reaches."""
    context = spark.sparkContext
    fs = context._jvm.org.apache.hadoop.fs
    target = fs.Path(path)
    draft = fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    files = fs.FileSystem.get(target.toUri(), context._jsc.hadoopConfiguration())
    out = files.create(draft, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    options = context._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.NONE
    try:
        fs.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration()).rename(
            files.makeQualified(draft), files.makeQualified(target), options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        files.delete(draft, False)
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds; nothing happens if there is none."""
    local = local_path(spark, path)
    if local is not None:
        if os.path.isdir(local):
            shutil.rmtree(local)
        elif os.path.exists(local):
            os.unlink(local)
        return
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
