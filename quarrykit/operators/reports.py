"""Counts and summaries of stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrykit.operators.selection import top_counts


def stage_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct ids, and rows beyond the first of each id."""
    return df.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("ids")).withColumn("duplicates", F.col("rows") - F.col("ids"))


def counts_by(df: DataFrame, what: Column, name: str = "value") -> DataFrame:
    return df.groupBy(F.coalesce(what, F.lit("unknown")).alias(name)).agg(F.count("*").alias("n"))


def failure_reasons(df: DataFrame, length: int = 120, n: int = 20) -> DataFrame:
    """The most frequent reasons of rows that are no success, cut to a length."""
    return top_counts(df.where("status <> 'success'"), F.substring("reason", 1, length), n, name="reason")


def missing_ids(expected: DataFrame, actual: DataFrame, key: str, show: int = 50) -> DataFrame:
    """(n, first ids in order): how many expected ids there are not."""
    gone = expected.select(key).distinct().join(actual.select(key).distinct(), key, "left_anti")
    return gone.agg(F.count("*").alias("n")).crossJoin(gone.orderBy(key).limit(show).agg(F.array_sort(F.collect_list(key)).alias("ids")))


def category_summary(parts: DataFrame, n: int = 20) -> DataFrame:
    made = parts.groupBy("category").agg(F.count("*").alias("parts"), F.count_distinct("obj_id").alias("objects"))
    return made.orderBy(F.desc("parts"), "category").limit(n)


def type_counts(edits: DataFrame, types, by: str = "obj_id") -> DataFrame:
    """One row for each object with a column for each type, of a fixed list, so that no pass is needed to find them."""
    return edits.groupBy(by).agg(*[F.count_if(F.col("edit_type") == t).alias(t) for t in types])


def match_report(assets: DataFrame, found: DataFrame, key: str) -> DataFrame:
    have = found.select(key).distinct().withColumn("__have", F.lit(1))
    return assets.join(have, key, "left").groupBy("category").agg(F.count("*").alias("n"), F.count("__have").alias("matched")).withColumn("unmatched", F.col("n") - F.col("matched"))


def stage_costs(counts: DataFrame, prices: dict[str, float]) -> DataFrame:
    """(stage, n) with unit price and cost."""
    price = F.lit(0.0)
    for stage, p in prices.items():
        price = F.when(F.col("stage") == stage, F.lit(float(p))).otherwise(price)
    return counts.withColumn("unit", price).withColumn("cost", F.round(F.col("n") * F.col("unit"), 6))


def slimming(files: DataFrame) -> DataFrame:
    """What keeping some views saves: size after = floor(size * kept / all)."""
    new = F.floor(F.try_divide(F.col("size") * F.col("kept"), F.col("views"))).cast("long")
    made = files.agg(F.sum("size").cast("long").alias("old"), F.sum(new).cast("long").alias("new"))
    return made.withColumn("percent", F.round(100 * F.try_divide(F.col("old") - F.col("new"), F.col("old").cast("double")), 2))


def totals(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.sum(c).cast("long").alias(c) for c in columns])


def listing_progress(files: DataFrame) -> DataFrame:
    """Of a file listing: folders, files named after.*, edited pictures, and other files."""
    name = F.substring_index("path", "/", -1)
    return files.agg(
        F.count_distinct(F.regexp_replace("path", "/[^/]*$", "")).alias("folders"), F.count_if(name.rlike("^after\\.")).alias("after_files"),
        F.count_if(name.rlike("_edited\\.png$")).alias("edited_images"), F.count("*").alias("files"),
    )
