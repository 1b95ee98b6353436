"""Discovery, resolution and packing of training pairs, as relations of listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.functions import domain as D
from quarrykit.operators.keyed_logs import last_wins
from quarrykit.operators.pairing import by_source
from quarrykit.operators.selection import numbered


def flat_pairs(files: DataFrame) -> DataFrame:
    """(pair, before, after) of a listing (pair, side, kind, path): each side's archive, else its legacy folder; both sides must be there."""
    rank = F.when(F.col("kind") == "npz", 0).otherwise(1)
    side = lambda s: F.min_by("path", F.when(F.col("side") == s, rank)).alias(s)
    return files.repartition("pair").groupBy("pair").agg(side("before"), side("after")).where("before is not null and after is not null")


def resolved_entries(edits: DataFrame, files: DataFrame) -> DataFrame:
    """(edit_id, before, after): an addition reads its source deletion's sides the other way round, an identity the same side twice."""
    own = edits.join(files, "edit_id", "left")
    src = files.select(F.col("edit_id").alias("source_del_id"), F.col("before_path").alias("sb"), F.col("after_path").alias("sa"))
    both = by_source(own, src)
    kind = F.col("edit_type")
    before = F.when(kind == "addition", F.col("sa")).otherwise(F.col("before_path"))
    after = F.when(kind == "addition", F.col("sb")).when(kind == "identity", F.col("before_path")).otherwise(F.col("after_path"))
    return both.select("edit_id", before.alias("before"), after.alias("after"))


def discovered(edits: DataFrame, quality: DataFrame | None, tier: str | None = None, types=None, shards=None, per_type: int | None = None) -> DataFrame:
    """Edits of objects by shard, type and tier, and of each type at most so many, in order of the id."""
    rows = edits
    if shards:
        rows = rows.where(F.col("shard").isin(*shards))
    if types:
        rows = rows.where(F.col("edit_type").isin(*types))
    if quality is not None and tier:
        rows = rows.join(quality.where(D.tier_at_least(F.col("tier"), tier)).select("edit_id"), "edit_id", "left_semi")
    if per_type:
        rows = rows.withColumn("__r", F.row_number().over(W.partitionBy("edit_type").orderBy("edit_id"))).where(F.col("__r") <= per_type).drop("__r")
    return rows


def prompt_map(results: DataFrame) -> DataFrame:
    """(edit_id, prompt) of successes with a prompt, the last one of each edit."""
    return last_wins(results.where("status = 'success' and length(prompt) > 0").select("edit_id", "prompt", "pos"), "edit_id").select("edit_id", "prompt")


def missing_before(pairs: DataFrame, arrays: DataFrame, types=("modification", "global")) -> DataFrame:
    """(edit_id, path, status): pairs of some types without a before-array get their object's, by the object in the id."""
    lack = pairs.where(F.col("edit_type").isin(*types) & F.col("before_path").isNull()).withColumn("obj_id", D.object_of_id(F.col("edit_id")))
    return lack.join(arrays.select("obj_id", "path"), "obj_id", "left").select("edit_id", "path", F.when(F.col("path").isNull(), "no_source").otherwise("fixed").alias("status"))


def migrated(edits: DataFrame) -> DataFrame:
    """(edit_id, status, shared): how each legacy edit converts; the object's first before-side is shared by all its edits."""
    first = F.first(F.col("before_path"), ignorenulls=True).over(W.partitionBy("obj_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    status = F.when(F.col("edit_type").isin("addition", "identity"), "linked").when(F.col("after_path").isNull(), "no_after").when(F.col("shared").isNull(), "no_before").otherwise("converted")
    return edits.withColumn("shared", first).select("edit_id", status.alias("status"), "shared")


def metadata_entries(specs: DataFrame) -> DataFrame:
    """An edit's entry in its object's record; fields that its type has not are null."""
    kind = F.col("edit_type")
    only = lambda c, *types: F.when(kind.isin(*types), F.col(c))
    return specs.select(
        "obj_id", "edit_id", "edit_type", "seq",
        only("source_seq", "addition").alias("source_seq"), only("part", "deletion", "addition", "modification", "scale", "material").alias("part"),
        only("prompt", "modification", "scale", "material", "global").alias("prompt"), F.when(kind == "identity", F.lit(True)).alias("same"),
    )


def conditioning(edits: DataFrame, cached: DataFrame, rendered: DataFrame, live: bool = True) -> DataFrame:
    """(edit_id, source, path): a cached image, else a call if they are allowed, else a render, else none."""
    both = edits.select("edit_id").join(cached.select("edit_id", F.col("path").alias("c")), "edit_id", "left").join(rendered.select("edit_id", F.col("path").alias("r")), "edit_id", "left")
    source = F.when(F.col("c").isNotNull(), "cache").when(F.lit(live), "call").when(F.col("r").isNotNull(), "render").otherwise("none")
    return both.select("edit_id", source.alias("source"), F.coalesce("c", F.when(F.lit(not live), F.col("r"))).alias("path"))


def pending(edits: DataFrame, cached: DataFrame) -> DataFrame:
    """Edits without a sound cached result; a broken one counts as none."""
    return edits.join(cached.where("valid").select("edit_id").distinct(), "edit_id", "left_anti")


def packed_status(objects: DataFrame) -> DataFrame:
    """(obj_id, status) of objects to pack, from the numbers of their views and parts."""
    status = F.when(F.col("views") == 0, "no_views").when(F.col("parts") == 0, "no_parts").when(F.col("parts") < 2, "too_few_parts").otherwise("ok")
    return objects.select("obj_id", status.alias("status"), "views", "parts")


def reencoded(deletions: DataFrame, passed: DataFrame, meshes: DataFrame) -> DataFrame:
    """Counts by status of passed deletions that can be encoded again."""
    rows = deletions.join(passed.select("edit_id").distinct(), "edit_id", "left_semi").join(meshes.select("edit_id", F.lit(1).alias("m")).distinct(), "edit_id", "left")
    return rows.groupBy(F.when(F.col("m").isNull(), "no_ply").otherwise("encoded").alias("status")).agg(F.count("*").alias("n"))


def collated(cells: DataFrame, batch: int, key: str = "edit_id") -> DataFrame:
    """The layout of batches: (key, batch, item, n, start), items in order of the key, ``start`` being an item's first row in its batch. Items are numbered over range partitions."""
    items = numbered(cells.groupBy(key).agg(F.count("*").alias("n")), [key], "i")
    items = items.withColumn("batch", F.floor(F.col("i") / batch).cast("int")).withColumn("item", (F.col("i") % batch).cast("int"))
    before = F.sum("n").over(W.partitionBy("batch").orderBy("item").rowsBetween(W.unboundedPreceding, -1))
    return items.select(key, "batch", "item", "n", F.coalesce(before, F.lit(0)).cast("long").alias("start"))


def batched_cells(cells: DataFrame, batch: int, key: str = "edit_id") -> DataFrame:
    """The cells with their batch, and the item's number in it as first coordinate."""
    return cells.join(collated(cells, batch, key).select(key, "batch", "item"), key)


def merged_back(scores: DataFrame, entries: DataFrame) -> DataFrame:
    """Score rows with their manifest entry, the last one of each edit; without an entry a row drops."""
    return scores.join(last_wins(entries, "edit_id").drop("first_pos", "pos"), "edit_id")
