"""Label records: from model answers, from rules, to catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrykit.functions import domain as D
from quarrykit.functions.text import human_label, normal_category

EDIT = "struct<type:string,mod_type:string,prompt:string,after_desc:string,before_part_desc:string,after_part_desc:string>"
PART = f"struct<part_id:int,label:string,core:boolean,desc:string,desc_without:string,`group`:string,edits:array<{EDIT}>>"
GROUP = f"struct<group_name:string,part_ids:array<int>,desc:string,desc_without:string,best_view:int,edits:array<{EDIT}>>"
GLOBAL = "struct<type:string,prompt:string,after_desc:string>"
RECORD = f"obj_id string, shard string, num_parts int, object_desc string, orthogonal_views array<int>, parts array<{PART}>, group_edits array<{GROUP}>, global_edits array<{GLOBAL}>"
_ASKED = "struct<prompt:string,after_desc:string,before_part_desc:string,after_part_desc:string>"
ANSWER = (
    f"struct<object_desc:string,parts:array<struct<part_id:int,label:string,is_core:boolean,desc:string,desc_without:string,deletion:{_ASKED},addition:{_ASKED},"
    f"swaps:array<{_ASKED}>,modifications:array<{_ASKED}>,materials:array<{_ASKED}>,scale:{_ASKED}>>,global_edits:array<{_ASKED}>>"
)
GROUP_ANSWER = f"struct<object_desc:string,groups:array<struct<name:string,parts:array<int>,desc:string,desc_without:string,deletion:{_ASKED},modifications:array<{_ASKED}>>>>"


def _edit(kind: str, e: Column, mod: str = "") -> Column:
    text = lambda n: F.coalesce(e[n], F.lit(""))
    return F.struct(F.lit(kind).alias("type"), F.lit(mod).alias("mod_type"), text("prompt").alias("prompt"), text("after_desc").alias("after_desc"), text("before_part_desc").alias("before_part_desc"), text("after_part_desc").alias("after_part_desc")).cast(EDIT)


def _one(kind: str, e: Column) -> Column:
    return F.when(e.isNotNull(), F.array(_edit(kind, e))).otherwise(F.array().cast(f"array<{EDIT}>"))


def _many(kind: str, es: Column, mod: str = "") -> Column:
    return F.coalesce(F.transform(es, lambda e: _edit(kind, e, mod)), F.array().cast(f"array<{EDIT}>"))


def from_part_answer(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Records from answers by part; each part's edits come as deletion, addition, swaps, modifications, materials, scale. ``df`` has obj_id, shard, labels and the parsed answer."""
    a = F.col(answer)

    def part(p: Column) -> Column:
        label = F.coalesce(D.filled(p["label"]), F.get(F.col("labels"), p["part_id"]), F.concat(F.lit("part "), p["part_id"].cast("string")))
        edits = F.concat(_one("deletion", p["deletion"]), _one("addition", p["addition"]), _many("modification", p["swaps"], "swap"), _many("modification", p["modifications"]), _many("material", p["materials"]), _one("scale", p["scale"]))
        return F.struct(p["part_id"].alias("part_id"), label.alias("label"), F.coalesce(p["is_core"], D.is_core(label)).alias("core"), F.coalesce(p["desc"], F.lit("")).alias("desc"), F.coalesce(p["desc_without"], F.lit("")).alias("desc_without"), F.lit("").alias("group"), edits.alias("edits")).cast(PART)

    return _record(df, F.coalesce(a["object_desc"], F.lit("")), F.coalesce(F.transform(a["parts"], part), F.array().cast(f"array<{PART}>")), F.array().cast(f"array<{GROUP}>"), _globals(a["global_edits"]))


def _globals(es: Column) -> Column:
    return F.coalesce(F.transform(es, lambda g: F.struct(F.lit("global").alias("type"), F.coalesce(g["prompt"], F.lit("")).alias("prompt"), F.coalesce(g["after_desc"], F.lit("")).alias("after_desc")).cast(GLOBAL)), F.array().cast(f"array<{GLOBAL}>"))


def _record(df: DataFrame, desc: Column, parts: Column, groups: Column, whole: Column) -> DataFrame:
    return df.select(F.col("obj_id").cast("string").alias("obj_id"), F.coalesce("shard", F.lit("00")).alias("shard"), F.size("labels").alias("num_parts"), desc.alias("object_desc"), F.array().cast("array<int>").alias("orthogonal_views"), parts.alias("parts"), groups.alias("group_edits"), whole.alias("global_edits"))


def from_group_answer(df: DataFrame, answer: str = "answer") -> DataFrame:
    """Records from answers by group. Indices name places in ``ids``; an addition is made of each deletion."""
    a = F.col(answer)

    def group(g: Column) -> Column:
        ids = F.filter(F.transform(g["parts"], lambda i: F.get(F.col("ids"), i)), lambda i: i.isNotNull())
        edits = F.concat(_one("deletion", g["deletion"]), _one("addition", g["deletion"]), _many("modification", g["modifications"], "swap"))
        return F.struct(g["name"].alias("group_name"), ids.alias("part_ids"), F.coalesce(g["desc"], F.lit("")).alias("desc"), F.coalesce(g["desc_without"], F.lit("")).alias("desc_without"), F.lit(0).alias("best_view"), edits.alias("edits")).cast(GROUP)

    parts = F.zip_with(F.col("labels"), F.col("ids"), lambda x, i: F.struct(i.alias("part_id"), x.alias("label"), D.is_core(x).alias("core"), F.lit("").alias("desc"), F.lit("").alias("desc_without"), F.lit("").alias("group"), F.array().cast(f"array<{EDIT}>").alias("edits")).cast(PART))
    return _record(df, F.coalesce(a["object_desc"], F.lit("")), parts, F.coalesce(F.transform(a["groups"], group), F.array().cast(f"array<{GROUP}>")), F.array().cast(f"array<{GLOBAL}>"))


def by_rules(df: DataFrame) -> DataFrame:
    """Records without a model: each part is described by its label; parts that are not core can be deleted."""
    def part(x: Column, i: Column) -> Column:
        name = human_label(x)
        cut = F.struct(F.concat(F.lit("Remove the "), name).alias("prompt"), F.lit("").alias("after_desc"), name.alias("before_part_desc"), F.lit("").alias("after_part_desc")).cast(_ASKED)
        return F.struct(i.cast("int").alias("part_id"), x.alias("label"), D.is_core(x).alias("core"), name.alias("desc"), F.lit("").alias("desc_without"), F.lit("").alias("group"), F.when(D.is_core(x), F.array().cast(f"array<{EDIT}>")).otherwise(F.array(_edit("deletion", cut))).alias("edits")).cast(PART)

    desc = F.concat(F.lit("An object with "), F.array_join(F.transform("labels", human_label), ", "))
    return _record(df, desc, F.transform("labels", part), F.array().cast(f"array<{GROUP}>"), F.array().cast(f"array<{GLOBAL}>"))


def from_annotation(df: DataFrame) -> DataFrame:
    """Records from captions of parts: the first caption that is not blank labels a part."""
    from quarrykit.functions.text import short_caption

    made = df.withColumn("labels", F.transform("captions", short_caption))
    return by_rules(made)


def catalog(records: DataFrame, categories: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """One row for each part, with its normal category and its cluster size (0 if unknown)."""
    p = records.select("obj_id", "shard", "object_desc", F.posexplode("parts").alias("place", "p")).select("obj_id", "shard", "object_desc", "place", "p.part_id", "p.label", "p.core", "p.desc")
    p = p.withColumn("category", normal_category(F.col("label")))
    if categories is not None:
        p = p.join(categories, "obj_id")  # objects without an entry drop
    if sizes is not None:
        p = p.join(sizes.select("obj_id", "part_id", F.col("cluster_size").alias("s")), ["obj_id", "part_id"], "left").withColumn("cluster_size", F.coalesce("s", F.lit(0))).drop("s")
    return p


def validated(answers: DataFrame, parts: DataFrame) -> DataFrame:
    """Labels of an answer held against an object's parts: unknown ids go, of repeated ids the first stays, missing parts come last with defaults."""
    good = answers.join(parts.select("obj_id", "part_id"), ["obj_id", "part_id"], "left_semi")
    first = good.groupBy("obj_id", "part_id").agg(F.min_by(F.struct("label", "types"), "pos").alias("r"), F.min("pos").alias("pos"))
    allowed = F.filter(F.col("r.types"), lambda t: t.isin(*D.EDIT_TYPES))
    kept = first.select("obj_id", "part_id", F.coalesce(D.filled(F.col("r.label")), F.concat(F.lit("part_"), F.col("part_id").cast("string"))).alias("label"), allowed.alias("types"), F.lit(0).alias("late"), F.col("pos").cast("long").alias("pos"))
    rest = parts.select("obj_id", "part_id").join(first.select("obj_id", "part_id"), ["obj_id", "part_id"], "left_anti")
    added = rest.select("obj_id", "part_id", F.concat(F.lit("part_"), F.col("part_id").cast("string")).alias("label"), F.array(F.lit("deletion")).alias("types"), F.lit(1).alias("late"), F.col("part_id").cast("long").alias("pos"))
    return kept.unionByName(added)


def nested_counts(records: DataFrame) -> DataFrame:
    many = lambda c: F.aggregate(F.transform(c, lambda g: F.size(g["edits"])), F.lit(0), lambda s, n: s + n)
    return records.select("obj_id", F.size("parts").alias("parts"), many("parts").alias("part_edits"), many("group_edits").alias("group_edits"), F.size("global_edits").alias("global_edits"))


def compared(a: DataFrame, b: DataFrame, key: str = "obj_id") -> DataFrame:
    """Two models' counts side by side."""
    names = [c for c in a.columns if c != key]
    return a.select(key, *[F.col(c).alias(f"a_{c}") for c in names]).join(b.select(key, *[F.col(c).alias(f"b_{c}") for c in names]), key, "full")


def summarised(records: DataFrame) -> DataFrame:
    """What a record holds, in one row: counts, its description and its labels."""
    return nested_counts(records).join(records.select("obj_id", "object_desc", F.transform("parts", lambda p: p["label"]).alias("labels"), F.filter(F.transform("parts", lambda p: F.when(p["core"], p["label"])), lambda x: x.isNotNull()).alias("core_labels")), "obj_id")


def save_catalog(records: DataFrame, path: str) -> None:
    records.write.mode("overwrite").parquet(path)


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The records as they were saved, group edits and views included."""
    return spark.read.parquet(path)
