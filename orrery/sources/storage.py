"""Small text files in any store that Spark reaches."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    hadoop, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def delete(spark: SparkSession, path: str) -> None:
    """A file or a folder with all in it; nothing if there is none."""
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None if there is none."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return None
    stream = fs.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of change of a file, or of the files of a folder (not deeper), by path; none if there is nothing."""
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted((str(s.getPath().toString()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(hadoop) if s.isFile())


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that the cluster names in ``spark.checkpoint.dir``, deleted when the JVM ends.

    Only a local session without that setting, as in tests, gets one of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="orrery-")
    out = f"{base.rstrip('/')}/orrery/{name}-{uuid.uuid4().hex}"
    hadoop, fs = _path(spark, out)
    fs.deleteOnExit(hadoop)
    return out


def write_text(spark: SparkSession, path: str, parts: Iterable[str]) -> None:
    """Writes to a temporary name and renames it over the target, so that readers see the old text or the new one, whole."""
    target, fs = _path(spark, path)
    temporary = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    stream = fs.create(temporary, True)
    try:
        for part in parts:
            stream.write(bytearray(part.encode()))
    finally:
        stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(temporary), fs.makeQualified(target), options)
