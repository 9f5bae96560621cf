"""Names and small texts in the shared folder, through Spark's own file systems."""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    path: str
    folder: bool
    modified: int


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _open(spark, path)
    return system.exists(place)


def listing(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder, by name; nothing if there is no such folder."""
    system, place = _open(spark, path)
    if not system.exists(place):
        return []
    found = [Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getModificationTime()) for s in system.listStatus(place)]
    return sorted(found)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False, and nothing written, if there is one already."""
    system, place = _open(spark, path)
    if system.exists(place):
        return False
    try:
        out = system.create(place, False)
    except Exception as error:  # another writer was faster
        if "AlreadyExists" in str(error):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read(spark: SparkSession, path: str) -> str:
    system, place = _open(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder, replacing what has that name."""
    system, place = _open(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    system.mkdirs(target.getParent())
    system.delete(target, True)
    if not system.rename(place, target):
        raise OSError(f"cannot rename {path} to {to}")


def touch(spark: SparkSession, path: str, modified: int) -> None:
    """Set a file's modification time in milliseconds. Stores without it have the time of the rename."""
    system, place = _open(spark, path)
    try:
        system.setTimes(place, modified, -1)
    except spark._jvm.java.lang.UnsupportedOperationException:  # pragma: no cover
        pass


def plain(path: str) -> str:
    """One spelling of a path: local ones without scheme, no escapes."""
    path = unquote(path)
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def qualified(spark: SparkSession, path: str) -> str:
    """The full path in that spelling."""
    system, place = _open(spark, path)
    return plain(system.makeQualified(place).toUri().toString())
