"""Folders every executor can see, through Hadoop's file system API."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, or the folder given to ``setCheckpointDir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and from the root."""
    fs, place = _at(spark, path.rstrip("/"))
    return place.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it does not exist."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(place) if entry.isDirectory()]


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``; none if it does not exist."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(place) if entry.isFile()]


def modified(spark: SparkSession, path: str) -> int:
    """When the file was written, in milliseconds."""
    fs, place = _at(spark, path)
    return fs.getFileStatus(place).getModificationTime()


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, place = _at(spark, path)
    if not fs.rename(place, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def read_texts(spark: SparkSession, path: str) -> list[str]:
    """Contents of the files directly under a folder of a few small ones; none if it does not exist."""
    return [read_text(spark, f"{path}/{name}") for name in names(spark, path)]


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, place = _at(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; one that is there already is an error."""
    fs, place = _at(spark, path)
    out = fs.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)
