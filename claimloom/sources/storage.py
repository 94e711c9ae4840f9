"""Folder listings through the file system that the path names (local, HDFS or object store)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def _names(spark: SparkSession, folder: str, directories: bool) -> list[str]:
    system, target = _open(spark, folder)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory() == directories)


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    return _names(spark, folder, directories=True)


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    return [n for n in _names(spark, folder, directories=False) if n.endswith(suffix)]


def remove_folder(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.delete(target, True)


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file."""
    system, target = _open(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, content: str) -> bool:
    """Make a small text file in one step; False if there is one of this name.

    It is written beside its place first. A local file is linked to its name, elsewhere it is renamed to it;
    both fail if the name is taken.
    """
    jvm = spark._jvm
    system, target = _open(spark, path)
    folder = target.getParent()
    system.mkdirs(folder)
    beside = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
    stream = system.create(beside, False)
    stream.write(bytearray(content.encode()))
    stream.close()
    try:
        if system.getUri().getScheme() == "file":
            files, local = jvm.java.nio.file.Files, lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            files.createLink(local(target), local(beside))
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(beside, False)
    return True
