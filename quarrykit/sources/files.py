"""Files by pattern, and files written from tasks, on any file system that Spark's paths name."""

from __future__ import annotations

import posixpath
import re
import uuid

from pyspark.sql import SparkSession


def paths_like(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern names, in order; none where nothing is there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(s.getPath().toString() for s in found or [])


def path_there(spark: SparkSession, path: str) -> str | None:
    """The full form of a path, if there is such a file or folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(at).getPath().toString() if fs.exists(at) else None


def escaped(spark: SparkSession, path: str) -> str:
    """A path as ``_metadata.file_path`` gives it."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def put(folder: str, name: str, data: bytes) -> None:
    """Write ``folder/name`` whole or not at all: under a passing name first, so a task that runs twice leaves one file."""
    from pyarrow import fs

    at, root = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder)) if re.match(r"^\w+:/", folder) else (fs.LocalFileSystem(), folder)
    path = posixpath.join(root, name)
    where = posixpath.dirname(path)
    at.create_dir(where, recursive=True)
    part = posixpath.join(where, f".{uuid.uuid4().hex}.part")
    with at.open_output_stream(part, compression=None) as out:
        out.write(data)
    at.move(part, path)
