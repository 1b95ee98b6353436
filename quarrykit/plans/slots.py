"""Places for model calls, with deterministic stand-ins.

A slot maps a frame to a frame with ``status`` and ``reason``; it never raises for a row. A real client is made
once for each partition inside ``call``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrykit.operators.labels import by_rules


def called(df: DataFrame, make_client: Callable[[], Callable[[dict], str]], out: str = "answer", tries: int = 3, wait: float = 1.0) -> DataFrame:
    """Each row to a client made once for each task; retried, after ``wait`` seconds that double each time, then failed as a row."""
    columns = df.columns

    def run(batches):
        client = make_client()
        for b in batches:
            made = []
            for row in b.to_dict("records"):
                got, why = None, ""
                for k in range(tries):
                    try:
                        if k:
                            time.sleep(wait * 2 ** (k - 1))
                        got = client(row)
                        break
                    except Exception as e:  # noqa: BLE001 - any failure of a service becomes a row
                        why = f"{type(e).__name__}: {e}"
                made.append((got, "success" if got is not None else "failed", "" if got is not None else why))
            yield pd.concat([b[columns].reset_index(drop=True), pd.DataFrame(made, columns=[out, "status", "reason"])], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{kinds}, {out} string, status string, reason string")


def enriched(objects: DataFrame, *models: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Records by the first model that answers for an object, by rules where none does."""
    left, made = objects, None
    for model in models:
        got = model(left)
        made = got if made is None else made.unionByName(got)
        left = left.join(got.select("obj_id"), "obj_id", "left_anti")
    rest = by_rules(left)
    return rest if made is None else made.unionByName(rest)


def judged_by_digest(pairs: DataFrame) -> DataFrame:
    """A stand-in judge: its verdict is read off the digest of the edit's id."""
    n = F.conv(F.substring(F.md5("edit_id"), 1, 4), 16, 10).cast("int")
    return pairs.select("edit_id", (n % 10 > 0).alias("executed"), (n % 7 > 0).alias("region"), (n % 5 > 0).alias("preserved"), (1 + n % 5).alias("quality"), (n % 3 > 0).alias("clean"), F.lit(False).alias("rejected"))


def remembered(todo: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, key: str = "edit_id", sound: str = "status = 'success'") -> DataFrame:
    """``compute`` of the rows that no earlier run has kept under ``path``, and the kept rows of the others. Kept rows that are not ``sound`` are made again."""
    from quarrykit.sharedfs import cut
    from quarrykit.sources.files import path_there

    spark = todo.sparkSession
    if path_there(spark, path) is None:
        new = cut(compute(todo), "remembered")
        new.write.mode("append").parquet(path)
        return new
    kept = spark.read.parquet(path).where(sound).join(todo.select(key).distinct(), key, "left_semi").dropDuplicates([key])
    new = cut(compute(todo.join(kept.select(key), key, "left_anti")), "remembered")
    old = cut(kept, "kept")
    new.write.mode("append").parquet(path)
    return old.unionByName(new)
