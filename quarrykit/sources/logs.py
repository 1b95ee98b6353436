"""Line-based readers and writers: JSON logs, id lists, nested label files.

Line numbers come from the reader's order within each file; files are ranked by the driver, so
``pos`` orders rows across files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.operators.keyed_logs import position
from quarrykit.sources.files import escaped, path_there, paths_like


def worker_files(folder: str, tag: str, stem: str = "edit_results") -> list[str]:
    """Result files of workers: ``_gpu*``, then ``_w*``, then ``_nongpu``, each by name, each once."""
    found: list[str] = []
    for pattern in (f"{stem}_{tag}_gpu*.jsonl", f"{stem}_{tag}_w*.jsonl", f"{stem}_{tag}_nongpu.jsonl"):
        found += [p for p in paths_like(SparkSession.active(), f"{folder}/{pattern}") if p not in found]
    return found


def read_log(spark: SparkSession, paths: list[str], schema: str, strict: bool = False) -> DataFrame:
    """Rows of JSON-lines files with ``pos``, ``file``, ``line`` and ``bad`` (a line that is no object). Missing files are empty; blank lines count for numbering only. Strict: a bad line raises."""
    there = [full for full in (path_there(spark, p) for p in paths) if full]
    if not there:
        return spark.createDataFrame([], f"{schema}, file string, line long, pos long, bad boolean")
    alike = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    ranks = spark.createDataFrame([(i, escaped(spark, p)) for i, p in enumerate(there)], "file_rank int, path string").withColumn("path", alike("path"))
    lines = spark.read.text(there).select("value", alike(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"))
    numbered = lines.withColumn("line", F.row_number().over(W.partitionBy("path").orderBy("block", "i")).cast("long"))
    rows = numbered.where(F.trim("value") != "").join(F.broadcast(ranks), "path")
    if strict:
        rows = rows.withColumn("r", F.from_json("value", schema, {"mode": "FAILFAST"})).withColumn("bad", F.lit(False))
    else:
        whole = F.try_parse_json("value")
        rows = rows.withColumn("bad", whole.isNull() | (F.schema_of_variant(whole).startswith("OBJECT") == F.lit(False))).withColumn("r", F.when(~F.col("bad"), F.from_json("value", schema)))
    return rows.select("r.*", "file", "line", position(F.col("file_rank"), F.col("line")).alias("pos"), "bad")


def good_rows(log: DataFrame) -> DataFrame:
    return log.where(~F.col("bad")).drop("bad", "file", "line")


def read_counts(log: DataFrame, key: str) -> DataFrame:
    named = F.length(F.coalesce(F.col(key).cast("string"), F.lit(""))) > 0
    return log.agg(F.count_if("bad").alias("bad_lines"), F.count_if(~F.col("bad") & ~named).alias("missing_id_rows"), F.count("*").alias("total_rows"))


def bad_lines(log: DataFrame) -> DataFrame:
    """``file:line`` of each line that is no record."""
    return log.where("bad").select(F.concat("file", F.lit(":"), F.col("line").cast("string")).alias("place"))


def read_ids(spark: SparkSession, path: str, name: str = "edit_id", comments: bool = True) -> DataFrame:
    rows = spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "")
    return rows.where(~F.col(name).startswith("#")) if comments else rows


def listed(values: list[str] | None) -> list[str]:
    """Names given with commas or blanks between them."""
    return [x for v in values or [] for x in re.split(r"[,\s]+", v) if x]


def read_category_labels(spark: SparkSession, path: str) -> DataFrame:
    """(category, obj_id, labels) from a nested JSON object of categories and objects."""
    text = spark.read.text(path, wholetext=True)
    by = text.select(F.explode(F.from_json("value", "map<string,map<string,array<string>>>")).alias("category", "m"))
    return by.select("category", F.explode("m").alias("obj_id", "labels"))


def read_object_json(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame | None:
    """``shard_*/<object>/<name>`` with shard and object from the path; None where there is no such file."""
    if not paths_like(spark, f"{root}/shard_*/*/{name}"):
        return None
    df = spark.read.schema(schema).json(f"{root}/shard_*/*/{name}", multiLine=True).withColumn("__f", F.col("_metadata.file_path"))
    place = "shard_([^/]*)/([^/]*)/[^/]*$"
    return df.withColumns({"shard": F.regexp_extract("__f", place, 1), "obj_id": F.regexp_extract("__f", place, 2)}).drop("__f")


def write_log(df: DataFrame, path: str, order: str | None = None) -> None:
    """JSON lines; with an order the lines follow it across part files."""
    (df.orderBy(order) if order else df).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_stage_summary(spark: SparkSession, path: str, stage: str, payload: dict) -> None:
    import json

    spark.createDataFrame([(stage, json.dumps(payload, sort_keys=True))], "stage string, payload string").write.mode("overwrite").json(path)
