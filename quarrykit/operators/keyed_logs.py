"""Append logs with keys: last wins, resume, reconciliation.

A row's place in the log is a number ``pos`` that rises over files in their order and over lines
in each, so "first" and "last" mean the same for any layout. A merge is one grouped
aggregate (partial on the map side), not a window over the whole log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def position(file_rank: Column, line: Column) -> Column:
    return F.shiftleft(file_rank.cast("long"), 40) + line


def ids_first_seen(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """(key, first_pos, n) for each id."""
    return df.groupBy(key).agg(F.min(pos).alias("first_pos"), F.count("*").alias("n"))


def first_rows(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """The first row of each key that is not empty."""
    rows = F.struct(*[F.col(c) for c in df.columns])
    return df.where(F.length(F.col(key).cast("string")) > 0).groupBy(key).agg(F.min_by(rows, pos).alias("r")).select("r.*")


def last_wins(df: DataFrame, key: str, pos: str = "pos", empty_keys: bool = False) -> DataFrame:
    """The last row of each key, with ``first_pos``, where the key first stood, to order by."""
    kept = df.where(F.col(key).isNotNull() if empty_keys else F.length(F.col(key).cast("string")) > 0)
    rows = F.struct(*[F.col(c) for c in df.columns])
    return kept.groupBy(key).agg(F.max_by(rows, pos).alias("r"), F.min(pos).alias("first_pos")).select("r.*", "first_pos")


def conflicts(df: DataFrame, key: str, pos: str = "pos") -> DataFrame:
    """Keys with rows that differ in more than their place."""
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != pos]))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(body).alias("versions")).where("versions > 1")


def union_right_wins(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of both, the right one where both have the key."""
    return left.join(right.select(key).distinct(), key, "left_anti").unionByName(right, allowMissingColumns=True)


def not_succeeded(specs: DataFrame, log: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Specs of which no row in the log, at any place, was a success."""
    return specs.join(log.where(F.col(status) == "success").select(key).distinct(), key, "left_anti")


def succeeded_last(log: DataFrame, key: str, status: str = "status", pos: str = "pos") -> DataFrame:
    """Keys whose last row is a success: a failure after a success takes it back."""
    return last_wins(log, key, pos).where(F.col(status) == "success").select(key)


def not_existing(specs: DataFrame, log: DataFrame, key: str) -> DataFrame:
    return specs.join(log.select(key).distinct(), key, "left_anti")


def not_done(specs: DataFrame, key: str, *done: DataFrame) -> DataFrame:
    """Specs that none of the tables of finished keys has (a manifest, a listing of files)."""
    found = done[0].select(key)
    for d in done[1:]:
        found = found.unionByName(d.select(key))
    return specs.join(found.distinct(), key, "left_anti")


def cross_check(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, problem) with ``missing`` and ``unexpected`` keys. Both sides are read and grouped once, as one table.

    A null key is found on neither side, so it is reported where it stands."""
    both = expected.select(key, F.lit(True).alias("__want")).unionByName(actual.select(key, F.lit(False).alias("__want")))
    sides = both.groupBy(key).agg(F.max("__want").alias("__w"), F.min("__want").alias("__h"))
    problems = F.array_compact(F.array(F.when(F.col("__w") & (F.col("__h") | F.col(key).isNull()), F.lit("missing")), F.when(~F.col("__h") & (~F.col("__w") | F.col(key).isNull()), F.lit("unexpected"))))
    return sides.select(key, F.explode(problems).alias("problem"))


def worker_outputs(pending: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, problem, n) with missing, duplicate and unexpected keys of the workers' rows. Both sides are read and grouped once, as one table."""
    both = pending.select(key, F.lit(True).alias("p"), F.lit(0).alias("n")).unionByName(rows.where(F.col(key).isNotNull()).select(key, F.lit(False).alias("p"), F.lit(1).alias("n")))
    sides = both.groupBy(key).agg(F.max("p").alias("p"), F.sum("n").alias("n"))
    n = F.col("n")
    problem = F.array_compact(F.array(F.when(n == 0, F.lit("missing")), F.when(n > 1, F.lit("duplicate")), F.when(~F.col("p"), F.lit("unexpected"))))
    return sides.select(key, F.explode(problem).alias("problem"), n.cast("long").alias("n"))


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def overlapping_dispatch(assigned: DataFrame, key: str, bucket: str) -> DataFrame:
    """Keys given to more than one bucket."""
    return assigned.groupBy(key).agg(F.count_distinct(bucket).alias("buckets")).where("buckets > 1")


def assert_disjoint(assigned: DataFrame, key: str, bucket: str) -> None:
    clash = overlapping_dispatch(assigned, key, bucket).orderBy(key).limit(5).collect()
    if clash:
        raise ValueError(f"dispatched more than once: {[r[0] for r in clash]}")


def reconcile(canonical: DataFrame, workers: DataFrame, expected: DataFrame, key: str = "edit_id", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(merged rows, one row of statistics). Both inputs come with ``pos`` and ``bad`` (true for a line that is no record).

    The canonical log comes first, then workers in order. Strict: bad lines, then rows without a key,
    then unexpected keys raise.
    """
    rows = canonical.unionByName(workers, allowMissingColumns=True)
    good = rows.where(~F.col("bad"))
    merged = last_wins(good.drop("bad"), key)
    work = good.join(workers.select("pos"), "pos", "left_semi")
    named = F.length(F.coalesce(F.col(key).cast("string"), F.lit(""))) > 0
    per_key = work.where(named).groupBy(key).agg(F.count("*").alias("n"))
    want = expected.select(key).distinct().withColumn("want", F.lit(1))
    checked = merged.select(key, "status").withColumn("have", F.lit(1)).join(want, key, "full")
    a = rows.agg(F.count_if("bad").alias("bad_lines"), F.count_if(~F.col("bad") & ~named).alias("missing_id_rows"), F.count("*").alias("total_rows"))
    b = checked.agg(
        F.count_if(F.col("want").isNull()).alias("unexpected_ids"),
        F.count_if(F.col("have").isNull()).alias("missing_expected_ids"),
        F.count_if(F.col("status") == "success").alias("done_success_ids"),
        F.count("have").alias("merged_ids"),
    )
    c = per_key.agg(F.count_if(F.col("n") > 1).alias("duplicate_ids"))
    stats = a.crossJoin(b).crossJoin(c)
    if strict:
        s = stats.first()
        for name in ("bad_lines", "missing_id_rows", "unexpected_ids"):
            if s[name]:
                raise ValueError(f"{name}: {s[name]}")
    return merged, stats


def status_counts(df: DataFrame, status: str = "status", bad: str | None = None) -> DataFrame:
    """Rows by status; ``?`` without one, ``<bad json>`` for lines that are no record."""
    label = F.coalesce(F.col(status), F.lit("?"))
    if bad:
        label = F.when(F.col(bad), "<bad json>").otherwise(label)
    return df.groupBy(label.alias("status")).agg(F.count("*").alias("n"))


def first_filled(df: DataFrame, key: str, value: str, pos: str = "pos") -> DataFrame:
    """The first value of each key that is not empty."""
    return df.where(F.length(value) > 0).groupBy(key).agg(F.min_by(value, pos).alias(value))


def sequence_numbers(df: DataFrame, keys: list[str], pos: str = "pos", name: str = "seq") -> DataFrame:
    """Numbers from 0 along ``pos`` for each key."""
    return df.withColumn(name, (F.row_number().over(W.partitionBy(*keys).orderBy(pos)) - 1).cast("int"))
