"""Forward and reverse edits: links, inheritance, packing order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.functions.domain import filled
from quarrykit.functions.text import reversed_prompt


def by_source(edits: DataFrame, source: DataFrame, key: str = "source_del_id") -> DataFrame:
    """``edits`` with the columns of their source, nulls where they have none.

    Most edits name no source. They would all go to one task, so each goes by its own id instead, beside a mark that no source bears."""
    named = F.length(key) > 0
    left = edits.withColumns({"__own": ~F.coalesce(named, F.lit(False)), "__at": F.when(named, F.col(key)).otherwise(F.col("edit_id"))})
    right = source.where(named).withColumns({"__own": F.lit(False), "__at": F.col(key)}).drop(key)
    return left.join(right, ["__own", "__at"], "left").drop("__own", "__at")


def with_source_seq(edits: DataFrame) -> DataFrame:
    """Additions get the ``seq`` of their source deletion in the same object, -1 where it is missing."""
    source = edits.where("edit_type = 'deletion'").select("obj_id", F.col("edit_id").alias("source_del_id"), F.col("seq").alias("source_seq"))
    return edits.join(source, ["obj_id", "source_del_id"], "left").withColumn("source_seq", F.when(F.col("edit_type") == "addition", F.coalesce("source_seq", F.lit(-1))))


def addition_files(edits: DataFrame) -> DataFrame:
    """(edit_id, source_id, status): the deletion an addition reads its arrays from, by shard, object and sequence."""
    adds = edits.where("edit_type = 'addition'").select("shard", "obj_id", "edit_id", F.col("source_seq").alias("seq"))
    dels = edits.where("edit_type = 'deletion'").select("shard", "obj_id", "seq", F.col("edit_id").alias("source_id"))
    return adds.join(dels, ["shard", "obj_id", "seq"], "left").select("edit_id", "source_id", F.when(F.col("source_id").isNull(), "error").otherwise("ok").alias("status"))


def with_quality(edits: DataFrame, quality: DataFrame) -> DataFrame:
    return edits.join(quality.select("shard", "obj_id", "edit_id", "tier", "score"), ["shard", "obj_id", "edit_id"], "left")


def inherited_scores(edits: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows that additions take over from the score of their source deletion; without one there is no row. By key, so a second run adds nothing new."""
    adds = edits.where("edit_type = 'addition'").select(F.col("edit_id").alias("add_id"), F.col("source_del_id").alias("edit_id"))
    return adds.join(scores, "edit_id").select(F.col("add_id").alias("edit_id"), "tier", "score", F.concat(F.lit("Inherited from "), F.col("edit_id")).alias("reason"))


def promoted_additions(edits: DataFrame, artefacts: DataFrame) -> DataFrame:
    """Additions succeed if their source deletion left a before-file; before and after change places."""
    adds = edits.where("edit_type = 'addition'")
    have = artefacts.where("before_path is not null").select(F.col("edit_id").alias("source_del_id"), F.col("after_path").alias("before_path"), F.col("before_path").alias("after_path"))
    return adds.join(have, "source_del_id", "left").select("edit_id", "source_del_id", "before_path", "after_path", F.when(F.col("after_path").isNull(), "failed").otherwise("success").alias("status"))


def paired_by_suffix(edits: DataFrame) -> DataFrame:
    """Deletion and addition with the same id after the prefix. A compatibility form: counters may drift apart, ``source_del_id`` does not."""
    tail = F.regexp_replace("edit_id", "^[^_]*_", "")
    dels = edits.where("edit_type = 'deletion'").select(tail.alias("tail"), F.col("edit_id").alias("del_id"))
    adds = edits.where("edit_type = 'addition'").select(tail.alias("tail"), F.col("edit_id").alias("add_id"))
    return dels.join(adds, "tail", "left").select("del_id", "add_id", F.concat(F.lit("add_"), F.col("tail")).alias("reverse_id"))


def paired_by_parts(edits: DataFrame) -> DataFrame:
    """For each deletion the first addition of the object over the same set of parts."""
    parts = F.array_sort(F.array_distinct("part_ids"))
    dels = edits.where("edit_type = 'deletion'").select("obj_id", parts.alias("parts"), F.col("edit_id").alias("del_id"))
    adds = edits.where("edit_type = 'addition'").groupBy("obj_id", parts.alias("parts")).agg(F.min_by("edit_id", "pos").alias("add_id"))
    return dels.join(adds, ["obj_id", "parts"], "left").select("del_id", "add_id")


def resolved_prompts(edits: DataFrame, results: DataFrame, specs: DataFrame) -> DataFrame:
    """Prompt of the result, else of the spec, else the source deletion's turned round."""
    res = results.where("status = 'success'").groupBy("edit_id").agg(F.max_by("prompt", "pos").alias("result_prompt"))
    own = specs.select("edit_id", F.col("prompt").alias("spec_prompt"))
    src = specs.select(F.col("edit_id").alias("source_del_id"), F.col("prompt").alias("source_prompt"))
    both = by_source(edits.join(res, "edit_id", "left").join(own, "edit_id", "left"), src)
    return both.select("edit_id", F.coalesce(filled(F.col("result_prompt")), filled(F.col("spec_prompt")), reversed_prompt(filled(F.col("source_prompt"))), F.lit("")).alias("prompt"))


def first_success(results: DataFrame) -> DataFrame:
    """The first successful pair of each object."""
    return results.where("status = 'success'").groupBy("obj_id").agg(F.min_by("edit_id", "pos").alias("edit_id"))


def deferred_identities(edits: DataFrame, results: DataFrame) -> DataFrame:
    """Identities take the first successful pair of their object; without one they fail, with a row."""
    source = first_success(results).withColumnRenamed("edit_id", "source_id")
    return edits.where("edit_type = 'identity'").join(source, "obj_id", "left").select("edit_id", "obj_id", "source_id", F.when(F.col("source_id").isNull(), "failed").otherwise("success").alias("status"))


def backfilled_additions(edits: DataFrame, pairs: DataFrame) -> DataFrame:
    """(edit_id, status): done where both sides of the source deletion's pair exist, else why not."""
    src = pairs.select(F.col("edit_id").alias("source_del_id"), "before_path", "after_path")
    adds = edits.where("edit_type = 'addition'").join(src, "source_del_id", "left")
    status = F.when(F.col("before_path").isNull() & F.col("after_path").isNull(), "no_pair").when(F.col("before_path").isNull(), "no_before").when(F.col("after_path").isNull(), "no_after").otherwise("ok")
    return adds.select("edit_id", status.alias("status"))


def both_directions(pairs: DataFrame) -> DataFrame:
    """Each deletion pair once as it is and once with its sides changed over, as the addition."""
    turned = pairs.select("obj_id", F.concat(F.lit("add_"), F.regexp_replace("edit_id", "^[^_]*_", "")).alias("edit_id"), F.lit("addition").alias("edit_type"), F.col("after_path").alias("before_path"), F.col("before_path").alias("after_path"))
    return pairs.select("obj_id", "edit_id", F.lit("deletion").alias("edit_type"), "before_path", "after_path").unionByName(turned)


def packed_object_entries(specs: DataFrame, existing: DataFrame) -> DataFrame:
    """One entry for each edit of an object in a pack: its sequence within type, the object's shared
    before-array (of the first spec that has one), and its own after-array where its type keeps a file."""
    seq = F.row_number().over(W.partitionBy("obj_id", "edit_type").orderBy("pos")) - 1
    numbered = specs.withColumn("seq", seq.cast("int")).join(existing, "edit_id", "left")
    before = numbered.where("before_path is not null").groupBy("obj_id").agg(F.min_by("before_path", "pos").alias("original_path"))
    own = F.when(F.col("edit_type").isin("addition", "identity"), F.lit(None).cast("string")).otherwise(F.col("after_path"))
    return numbered.join(before, "obj_id", "left").select("obj_id", "edit_id", "edit_type", "seq", "original_path", own.alias("file_path"))


def manifest(objects: DataFrame) -> DataFrame:
    """One row for each edit of objects with an array of edits, in order of shard, object and place."""
    return objects.select("shard", "obj_id", F.posexplode("edits").alias("edit_idx", "e")).select("shard", "obj_id", "edit_idx", "e.*").orderBy("shard", "obj_id", "edit_idx")


def training_meta(edits: DataFrame) -> DataFrame:
    """One row: objects, edits, and edits of each type as sorted (type, n)."""
    kinds = edits.groupBy("edit_type").agg(F.count("*").alias("n"))
    whole = edits.agg(F.count_distinct("obj_id").alias("objects"), F.count("*").alias("edits"))
    return whole.crossJoin(kinds.agg(F.array_sort(F.collect_list(F.struct("edit_type", "n"))).alias("by_type")))


def first_existing(candidates: DataFrame, key: str, path: str = "path", rank: str = "rank") -> DataFrame:
    """Of each key the candidate path of least rank: original array, pair's array, legacy folder, any edit that has one.

    A path is no buffer of a hash aggregate, so rows are sorted; they are brought together first, lest the task that makes them sorts them as well."""
    return candidates.repartition(key).groupBy(key).agg(F.min_by(path, rank).alias(path))
