"""Numbered records that exactly one writer can create.

A record is a small text file named by its number. It is written under another name first and then
linked or renamed to its own, which fails where the number is taken; so a reader never
sees half a record, and of two writers one has to go on to the next number.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    return system.makeQualified(target), system


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, without temporary ones; none where there is no folder."""
    target, system = _path(spark, folder)
    if not system.exists(target):
        return []
    found = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def read(spark: SparkSession, path: str) -> str:
    target, system = _path(spark, path)
    size = system.getFileStatus(target).getLen()
    stream = system.open(target)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def _write(system, target, text: str) -> None:
    stream = system.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def claim(spark: SparkSession, folder: str, number: int, text: str) -> bool:
    """Create record ``number`` with ``text``; False where it exists."""
    jvm = spark.sparkContext._jvm
    final, system = _path(spark, f"{folder}/{number:012d}")
    system.mkdirs(final.getParent())
    if final.toUri().getScheme() == "file":  # the local rename would replace the other's record
        own = os.path.join(final.getParent().toUri().getPath(), f".{uuid.uuid4().hex}")
        with open(own, "w") as out:
            out.write(text)
        try:
            os.link(own, final.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
    own = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4().hex}")
    _write(system, own, text)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(own, final, options)
        return True
    except Py4JJavaError as taken:
        if "FileAlreadyExistsException" not in taken.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(own, False)


def newest(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and text of the last record; (0, None) where there is none."""
    numbers = [int(n) for n in names(spark, folder) if n.isdigit()]
    if not numbers:
        return 0, None
    return max(numbers), read(spark, f"{folder}/{max(numbers):012d}")


def append(spark: SparkSession, folder: str, text: str) -> int:
    """Create the next free record, after that of any other writer, and return its number."""
    number = newest(spark, folder)[0] + 1
    while not claim(spark, folder, number, text):
        number += 1
    return number
