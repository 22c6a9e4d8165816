"""Folder operations on whatever file system a path is on, through the Hadoop client Spark carries."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, creating the folder it goes to."""
    fs, p = _open(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path``."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)


class Entry(NamedTuple):
    path: str
    name: str
    is_folder: bool
    modified_ms: int
    size: int


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in ``path``."""
    fs, p = _open(spark, path)
    out = []
    for s in fs.listStatus(p):
        where = s.getPath()
        out.append(Entry(where.toString(), where.getName(), s.isDirectory(), s.getModificationTime(), s.getLen()))
    return out


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether a job has written the folder to its end."""
    return path_exists(spark, f"{folder.rstrip('/')}/_SUCCESS")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, p = _open(spark, path)
    fs.create(p, True).close()


def stored_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``, from the file system alone."""
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; one of that name that is there already stays."""
    fs, p = _open(spark, path)
    if fs.exists(p):
        return
    fs.mkdirs(p.getParent())
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, p) and not fs.exists(p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """What :func:`write_text` wrote, or None."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
