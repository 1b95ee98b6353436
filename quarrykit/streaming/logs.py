"""Streams of result rows: append with exactly-once files, and the latest row by key as a table.

The only order is the log's own position, so there is no watermark: progress is the checkpoint, state is
an upsert by key, and a batch that runs twice changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrykit.sharedfs import drop_path
from quarrykit.sources.files import paths_like


def stream_log(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def append(stream: DataFrame, out: str, checkpoint: str):
    """Rows to Parquet files, each exactly once."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class LatestTable:
    """The row of greatest ``pos`` for each key, in ``buckets`` by the key's hash. Each batch writes anew the buckets that it touches, beside the last ones and
    under its number; a bucket is read where it was written last. A batch that is run again finds its version or writes it anew."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, pos: str = "pos", buckets: int = 64):
        self.spark, self.root, self.schema, self.key, self.pos, self.buckets = spark, root, schema, key, pos, buckets

    def _folders(self, pattern: str) -> list[tuple[int, ...]]:
        """The numbers in the names of what a pattern below the root finds, in order."""
        return sorted(tuple(int(n) for n in re.findall(r"/(?:v|bucket)=(\d+)", p)[-pattern.count("=") :]) for p in paths_like(self.spark, f"{self.root}/{pattern}"))

    def _versions(self) -> list[int]:
        return [v for (v,) in self._folders("v=*/_SUCCESS")]

    def _latest(self) -> dict[int, int]:
        """Of each bucket the version that holds it."""
        done = set(self._versions())
        return {b: v for v, b in self._folders("v=*/bucket=*") if v in done}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _of(self, where: dict[int, int]) -> DataFrame:
        if not where:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/v={v}/bucket={b}" for b, v in sorted(where.items())])

    def read(self) -> DataFrame:
        return self._of(self._latest())

    def upsert(self, batch: DataFrame, number: int) -> None:
        have = self._versions()
        if have and have[-1] >= number:
            return
        latest, columns = self._latest(), self.spark.createDataFrame([], self.schema).columns
        new = batch.select(*columns).where(F.length(F.col(self.key).cast("string")) > 0)
        touched = {r.b for r in new.select(self._bucket().alias("b")).distinct().collect()}
        both = self._of({b: v for b, v in latest.items() if b in touched}).unionByName(new)
        row = F.struct(*[F.col(c) for c in columns])
        rows = both.groupBy(self.key).agg(F.max_by(row, self.pos).alias("r")).select("r.*").withColumn("bucket", self._bucket())
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/v={number}")
        for v, b in self._folders("v=*/bucket=*"):
            # the version before this one stays: a reader may be at it
            if b in touched and v < latest.get(b, -1):
                drop_path(self.spark, f"{self.root}/v={v}/bucket={b}")


def keep_latest(stream: DataFrame, table: LatestTable, checkpoint: str):
    return stream.writeStream.foreachBatch(table.upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def per_object(stream: DataFrame, steps: list[tuple[str, Callable[[DataFrame], DataFrame]]], sink: Callable[[str, DataFrame, int], None], checkpoint: str):
    """Each batch of objects through a chain of stages; every stage's rows go to the sink, failures as rows with a status."""

    def run(batch: DataFrame, number: int) -> None:
        rows = batch
        for name, step in steps:
            rows = step(rows)
            sink(name, rows, number)
            if "status" in rows.columns:
                rows = rows.where(F.coalesce(F.col("status"), F.lit("success")) == "success")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
