"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled by the digest of its doc_ids, with ``seed`` before them. A document's virtual
finish time is its source's tokens so far, itself included, divided by the
source's weight. Documents in the order of finish time draw on every source
in proportion to its weight for as long as the source lasts; the order is cut
where the token budget is used up.

Both running sums are over all data and neither runs in one task. The shuffle digests of a source are
evenly spread, so equal ranges of them are slices of about ``SLICE`` documents; finish times are cut into
slices by range partitioning, whose bounds follow their quantiles. A slice's sum starts from the total of the
slices before it, and those totals are a table of one row a slice, itself
summed by a window over its slices. A source of any size thus spreads over as
many tasks as it has slices. Texts are read once, for their token counts, and are never shuffled by the
sums.

The units kept are the first ones of each source's shuffle, so ``mix`` compares each row with the last kept unit of its
source, a table of one row a source; the rows themselves are not shuffled while sources number at most 10,000 (beyond, they join it).

Tokens are runs of characters other than space, tab, line feed, carriage
return and form feed.

Defined results: rows that repeat a doc_id within a source are one unit, with
their tokens together. A null text has no tokens. A null source is a source of
its own. Sources without a stated weight have ``OTHER``. A budget under the first
document's tokens keeps nothing. Ties in finish time go by source, then
digest, then doc_id. doc_ids keep their type; of a null one the digest is that of the seed. Other columns are not looked at, and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.sharedfs import cut

WEIGHTS, OTHER = {"src0": 6.0, "src1": 2.0, "src2": 2.0, "src3": 0.5}, 1.0
#: The budget as a fraction (numerator, denominator) of all tokens.
BUDGET = (7, 10)
SLICE = 200_000


def _weight(source, weights: dict[str, float], other: float):
    if any(w <= 0 for w in [*weights.values(), other]):
        raise ValueError("weights must be positive")
    made = F.lit(float(other))
    for name, w in weights.items():
        made = F.when(source == F.lit(name), F.lit(float(w))).otherwise(made)
    return made


def _running(df: DataFrame, group: list[str], slice_: str, order: list, amount: str, out: str) -> DataFrame:
    """``df`` with the running sum of ``amount`` along (slice, order) within ``group``."""
    total = df.groupBy(*group, slice_).agg(F.sum(amount).alias("__total"))
    before = W.partitionBy(*group).orderBy(slice_).rowsBetween(W.unboundedPreceding, -1) if group else W.orderBy(slice_).rowsBetween(W.unboundedPreceding, -1)
    starts = total.select(*[F.col(c).alias(f"__{c}") for c in [*group, slice_]], F.coalesce(F.sum("__total").over(before), F.lit(0).cast("long")).alias("__start"))
    same = [df[c].eqNullSafe(starts[f"__{c}"]) for c in [*group, slice_]]
    joined = df.join(starts, same, "left").drop(*[f"__{c}" for c in [*group, slice_]])
    inside = W.partitionBy(*group, slice_).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return joined.withColumn(out, F.col("__start") + F.sum(amount).over(inside)).drop("__start")


def mixed_units(docs: DataFrame, weights: dict[str, float] | None = None, other: float = OTHER, budget: tuple[int, int] | int = BUDGET, slice_docs: int = SLICE, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "") -> DataFrame:
    """(source, doc_id, tokens, finish, total): the units within the budget, with finish time and tokens up to and with each."""
    weights = WEIGHTS if weights is None else weights
    tokens = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit("[^ \t\n\r\f]+")), F.lit(0)).cast("long")
    rows = docs.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("doc_id"), tokens.alias("tokens"))
    units = rows.groupBy("source", "doc_id").agg(F.sum("tokens").alias("tokens")).withColumn("digest", _digest(F.col("doc_id"), seed))
    units = cut(units, "units")
    # digests are spread evenly, so equal ranges of them hold about as many documents
    sizes = units.groupBy("source").agg(F.ceil(F.count("*") / F.lit(slice_docs)).cast("long").alias("__slices")).withColumnRenamed("source", "__source")
    part = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    sliced = units.join(F.broadcast(sizes) if _few(sizes) else sizes, F.col("source").eqNullSafe(F.col("__source")), "left").withColumn("slice", F.floor(part * F.col("__slices") / F.lit(2**32)).cast("long")).drop("__source", "__slices")
    queued = _running(sliced, ["source"], "slice", ["digest", "doc_id"], "tokens", "upto")
    timed = cut(queued.select("source", "doc_id", "tokens", "digest", (F.col("upto").cast("double") / _weight(F.col("source"), weights, other)).alias("finish")), "timed")
    all_tokens = timed.agg(F.sum("tokens")).first()[0]
    limit = int(budget) if not isinstance(budget, tuple) else (all_tokens or 0) * budget[0] // budget[1]
    order = ["finish", F.col("source").asc_nulls_first(), "digest", "doc_id"]
    cutinto = cut(timed.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "slices")
    whole = _running(cutinto, [], "slice", order, "tokens", "total")
    return whole.where(F.col("total") <= F.lit(limit)).select("source", "doc_id", "tokens", "finish", "total")


def _digest(doc_id, seed: str):
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _few(sizes: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is small enough to send to every executor."""
    return sizes.select("__source").limit(most + 1).count() <= most


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: str = "", **more) -> DataFrame:
    """The rows of ``docs`` whose units are within the budget, with all their columns."""
    kept = mixed_units(docs, id_col=id_col, source_col=source_col, seed=seed, **more)
    place = lambda c: F.struct(_digest(c, seed).alias("digest"), c.alias("id"))
    last = cut(kept.groupBy(F.col("source").alias("__source")).agg(F.max(place(F.col("doc_id"))).alias("__last")), "last")
    same = docs[source_col].cast("string").eqNullSafe(F.col("__source"))
    return docs.join(F.broadcast(last) if _few(last) else last, same & (place(docs[id_col]) <= F.col("__last")), "left_semi")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture in its order, range-sorted by finish time."""
    return mixed_units(spark.read.parquet(f"{sf_dir}/documents.parquet")).orderBy("total", "finish", "source", "doc_id")


_SQL = f"""
WITH rows_ AS (
  SELECT source, doc_id, CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')), 0) AS BIGINT) AS tokens FROM documents
), units AS (
  SELECT source, doc_id, CAST(sum(tokens) AS BIGINT) AS tokens, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM rows_ GROUP BY source, doc_id
), timed AS (
  SELECT *, CAST(sum(tokens) OVER (PARTITION BY source ORDER BY digest, doc_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) /
    CASE source {" ".join(f"WHEN '{s}' THEN CAST({w} AS DOUBLE)" for s, w in WEIGHTS.items())} ELSE CAST({OTHER} AS DOUBLE) END AS finish FROM units
), whole AS (
  SELECT *, CAST(sum(tokens) OVER (ORDER BY finish, source NULLS FIRST, digest, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM timed
)
SELECT source, doc_id, tokens, finish, total FROM whole
WHERE total <= (SELECT sum(tokens) * {BUDGET[0]} // {BUDGET[1]} FROM units)
"""

QUERIES = {"op1_mixing": op1_mixing}
ORACLE = {"op1_mixing": _SQL}
