"""Steps over named tables: each reads what earlier ones wrote, and its table is written before it is checked."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Step:
    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    check: Callable[[DataFrame], None] | None = None


@dataclass
class Run:
    """Tables under one root; a step that is not asked for is read from an earlier run."""

    spark: SparkSession
    root: str
    steps: list[Step] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path(name), "_SUCCESS")
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def go(self, only: list[str] | None = None, resume: bool = False) -> dict[str, str]:
        """Status of each step: made, kept or skipped. A missing input raises before anything runs."""
        asked = [s for s in self.steps if only is None or s.name in only]
        made = {s.name for s in asked}
        for s in asked:
            for n in s.needs:
                if n not in made and not self.exists(n):
                    raise FileNotFoundError(f"step {s.name} needs {n}")
        status = {s.name: "skipped" for s in self.steps}
        for s in asked:
            if resume and self.exists(s.name):
                status[s.name] = "kept"
                continue
            s.make(*[self.table(n) for n in s.needs]).write.mode("overwrite").parquet(self.path(s.name))
            status[s.name] = "made"
            if s.check:
                s.check(self.table(s.name))
        return status
