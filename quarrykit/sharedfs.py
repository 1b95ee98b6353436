"""Written tables in the folder that every executor shares.

Long plans are cut by writing a table and reading it again, so that a lost
executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Of local mode without that setting: a folder for each application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="quarrykit-")
    return _LOCAL[app]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table, which goes when it is dropped or the application ends."""
    path = new_path(df.sparkSession, tag)
    df.write.format(fmt).save(path)
    _delete_on_exit(df.sparkSession, path)
    made = df.sparkSession.read.schema(df.schema).format(fmt).load(path)
    made._written_at = path
    return made


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``cut`` that nothing reads any more."""
    for t in tables:
        drop_path(t.sparkSession, t._written_at)


def _delete_on_exit(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
