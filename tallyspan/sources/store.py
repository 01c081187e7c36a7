"""Small files and whole folders on any store that Spark reaches, by Hadoop's file
systems: the same paths that readers and writers take, with or without a scheme.
Reports, manifests and exports are written by these; tables never pass here.

With no session, paths are of the local disk, for checks that read only files.
Edge cases: a missing file is an error to read, and none to delete; a file that is
written over is replaced at once, so a reader sees the old one or the new one."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def join(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def _at(spark: SparkSession, path: str):
    """(file system, path); on the local disk without a checksum file beside it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getScheme() == "file" and fs.getClass().getSimpleName() != "RawLocalFileSystem":
        fs = fs.getRawFileSystem()
    return fs, where


def exists(path: str, spark: SparkSession | None = None) -> bool:
    if spark is None:
        return os.path.exists(path)
    fs, where = _at(spark, path)
    return fs.exists(where)


def read(path: str, spark: SparkSession | None = None) -> bytes:
    if spark is None:
        with open(path, "rb") as f:
            return f.read()
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write(path: str, data: bytes, spark: SparkSession | None = None) -> None:
    """A whole file by way of a temporary one beside it and a rename."""
    if spark is None:
        folder = os.path.dirname(path) or "."
        os.makedirs(folder, exist_ok=True)
        fd, temporary = tempfile.mkstemp(dir=folder, suffix=".tmp")
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        os.replace(temporary, path)
        return
    fs, where = _at(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    _replace(spark, fs, temporary, where)


def _replace(spark: SparkSession, fs, source, target) -> None:
    """A rename over what is there. A local one does that by itself; elsewhere the
    store's FileContext is asked to."""
    if fs.getClass().getSimpleName() == "RawLocalFileSystem":
        if not fs.rename(source, target):
            raise OSError(f"could not write {target}")
        return
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(source), fs.makeQualified(target), options)


def delete(path: str, spark: SparkSession) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def move(source: str, target: str, spark: SparkSession) -> None:
    fs, where = _at(spark, target)
    fs.mkdirs(where.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), where):
        raise OSError(f"could not move {source}")


def swap_folder(new: str, path: str, spark: SparkSession) -> None:
    """A folder takes another's place, whose own content goes last; if the first
    can't be moved, the other is put back."""
    fs, target = _at(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(new)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    there = fs.exists(target)
    if there and not fs.rename(target, old):
        raise OSError(f"could not move {path}")
    if not fs.rename(source, target):
        if there:
            fs.rename(old, target)
        raise OSError(f"could not move {new}")
    if there:
        fs.delete(old, True)
