"""From label records to numbered edits.

Each part is a row that makes its own specs, and each record one more for the edits of groups and of the whole; rows are sorted once by
object, branch, part or group and place. Numbers count those of a prefix up to there, and an addition's deletion is the last before it. Random draws are digests of object, part and template, so a plan does
not depend on layout or process.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.functions import domain as D
from quarrykit.functions.text import fill_template, part_phrase
from quarrykit.operators.selection import digest_rank

SCALE = ["Make the {part} larger", "Make the {part} smaller", "Stretch the {part} upwards", "Widen the {part}", "Double the height of the {part}", "Halve the {part} in size", "Make the {part} thinner", "Flatten the {part}"]
MATERIAL = ["Turn the {part} into wood", "Turn the {part} into brushed steel", "Give the {part} a marble surface", "Make the {part} of clear glass", "Cover the {part} with leather", "Cast the {part} in bronze", "Give the {part} a coat of matte paint", "Make the {part} of woven rattan"]
IDENTITY = ["Leave the {obj} as it is", "Change nothing about the {obj}", "Keep the {obj} unchanged", "Return the {obj} without an edit", "Do not alter the {obj}", "Let the {obj} stay the same", "Make no edit to the {obj}", "Hand back the {obj} untouched"]


def _drawn(templates: list[str], *key):
    """The template whose digest with the key is least."""
    options = F.array(*[F.struct(digest_rank(str(i), *key).alias("d"), F.lit(t).alias("t")) for i, t in enumerate(templates)])
    return F.array_min(options)["t"]


_SPEC = "edit_type string, branch int, i int, j int, k int, del_j int, remove_part_ids array<int>, keep_part_ids array<int>, old_part_id int, old_label string, edit_prompt string, after_desc string, mod_type string"
_FIELDS = [f.split()[0] for f in _SPEC.split(", ")]


_NONE_TYPE = "array<struct<" + ", ".join(f.replace(" ", ": ", 1) for f in _SPEC.split(", ")) + ">>"
_NONE = lambda: F.array().cast(_NONE_TYPE)


def _spec(kind, branch: int, i, j, k: int | Column, **more) -> Column:
    none = F.array().cast("array<int>")
    made = {"edit_type": F.lit(kind) if isinstance(kind, str) else kind, "branch": F.lit(branch), "i": i, "j": j, "k": F.lit(k) if isinstance(k, int) else k, "del_j": F.lit(None).cast("int"), "remove_part_ids": none, "keep_part_ids": none, "old_part_id": F.lit(-1), "old_label": F.lit(""), "edit_prompt": F.lit(""), "after_desc": F.lit(""), "mod_type": F.lit("")} | more
    return F.struct(*[made[f].alias(f) for f in _FIELDS]).cast(_NONE_TYPE[len("array<") : -1])


def _group_specs() -> Column:
    """Edits of each group; a group of all parts emits none, and an addition needs a deletion before it in its group."""

    def of_group(g, i):
        keep = F.filter("all_ids", lambda x: ~F.array_contains(g["part_ids"], x))

        def of_edit(e, j):
            before = F.array_max(F.filter(F.transform(g["edits"], lambda x, n: F.when(x["type"] == "deletion", n)), lambda n: n < j))
            changed = F.coalesce(D.filled(e["after_desc"]), D.filled(e["after_part_desc"]), F.when(e["type"] == "scale", F.col("object_desc")), F.lit(""))
            made = _spec(e["type"], 0, i, j, 0, del_j=before, remove_part_ids=g["part_ids"], keep_part_ids=keep, old_part_id=F.coalesce(F.get(g["part_ids"], F.lit(0)), F.lit(-1)), old_label=F.coalesce(g["group_name"], F.lit("")), edit_prompt=F.coalesce(e["prompt"], F.lit("")), after_desc=changed, mod_type=F.coalesce(e["mod_type"], F.lit("")))
            return F.when(e["type"].isin("deletion", "modification", "material", "scale") | ((e["type"] == "addition") & before.isNotNull()), made)

        return F.when(F.size(keep) > 0, F.filter(F.transform(g["edits"], of_edit), lambda x: x.isNotNull()))

    return F.flatten(F.filter(F.transform("group_edits", of_group), lambda x: x.isNotNull()))


def _part_specs(p: Column, i: Column) -> Column:
    """Edits of a part outside all groups: deletion, addition, then swaps, materials and scales each in their order."""
    one = _one(p)

    def of_edit(kind: str, k: int):
        def made(e, j):
            asked = (e["type"] == kind) & (F.length(e["prompt"]) > 0)
            if kind == "modification":
                asked = asked & (e["mod_type"] == "swap")
            return F.when(asked, _spec(kind, 1, i, j, k, **one, edit_prompt=e["prompt"], after_desc=F.coalesce(e["after_desc"], F.lit("")), mod_type=F.coalesce(e["mod_type"], F.lit(""))))

        return made

    phrase = part_phrase(p["desc"], p["label"], p["part_id"])

    def asked(kind: str, prefix: str):
        hit = F.get(F.filter(p["edits"], lambda e: (e["type"] == kind) & (F.length(e["prompt"]) > 0)), F.lit(0))
        return F.coalesce(hit["prompt"], F.concat(F.lit(prefix), phrase))

    free = ~(F.coalesce(p["core"], F.lit(False)) | F.coalesce(D.is_core(p["label"]), F.lit(False)))
    made = [F.when(free, F.array(_spec("deletion", 1, i, F.lit(0), 0, **one, edit_prompt=asked("deletion", "Remove the "), after_desc=F.coalesce(p["desc_without"], F.lit(""))), _spec("addition", 1, i, F.lit(0), 1, del_j=F.lit(0), **one, edit_prompt=asked("addition", "Add the "), after_desc=F.col("object_desc"))))]
    for k, kind in ((2, "modification"), (3, "material"), (4, "scale")):
        made.append(F.when(F.array_contains(p["edits"]["type"], kind), F.filter(F.transform(p["edits"], of_edit(kind, k)), lambda x: x.isNotNull())))
    return F.when(~F.col("in_group"), F.concat(*[F.coalesce(m, _NONE()) for m in made]))


def _one(p) -> dict[str, Column]:
    return {"remove_part_ids": F.array(p["part_id"]), "keep_part_ids": F.filter("all_ids", lambda x: x != p["part_id"]), "old_part_id": p["part_id"], "old_label": F.coalesce(p["label"], F.lit(""))}


def _whole_specs(most: int) -> Column:
    """Whole-object edits: the first few, then without empty prompts."""
    spec = lambda e, i: F.when((i < most) & (F.length(e["prompt"]) > 0), _spec("global", 2, i, F.lit(0), 0, edit_prompt=e["prompt"], after_desc=F.coalesce(e["after_desc"], F.lit(""))))
    return F.filter(F.transform("global_edits", spec), lambda x: x.isNotNull())


def _lacking_specs(p: Column, i: Column, kind: str, branch: int, templates: list[str]) -> Column:
    """A made edit of a part that was given none of this type."""
    prompt = fill_template(_drawn(templates, F.col("obj_id"), F.lit(kind), p["part_id"]), part=part_phrase(p["desc"], p["label"], p["part_id"]))
    return F.when(~F.exists(p["edits"], lambda e: (e["type"] == kind) & (F.length(e["prompt"]) > 0)), F.array(_spec(kind, branch, i, F.lit(0), 0, **_one(p), edit_prompt=prompt)))


def plan(records: DataFrame, least_parts: int = 2, most_global: int = 3, types: tuple[str, ...] | None = None) -> DataFrame:
    """Specs of all records with at least ``least_parts`` parts: edit_id, type, parts, prompt, source deletion. Where ``types`` are named, theirs alone, as they are in the whole plan.

    Records, not specs, are shuffled, once, by object.
    """
    zero = F.lit(0)
    wanted = lambda *kinds: types is None or not set(kinds).isdisjoint(types)
    r = records.where(F.size("parts") >= least_parts).withColumns({"all_ids": F.transform("parts", lambda p: p["part_id"]), "view": F.coalesce(F.get("orthogonal_views", zero), zero)})
    r = r.withColumn("grouped", F.array_distinct(F.flatten(F.transform("group_edits", lambda g: g["part_ids"])))).repartition("obj_id")
    whole = [_group_specs(), *[_whole_specs(most_global)] * wanted("global")]
    if wanted("identity"):
        same = fill_template(_drawn(IDENTITY, F.col("obj_id"), F.lit("identity")), obj=F.coalesce(D.filled(F.col("object_desc")), F.lit("object")))
        whole.append(F.array(_spec("identity", 5, zero, zero, 0, edit_prompt=same, after_desc=F.col("object_desc"))))
    part = r.schema["parts"].dataType.elementType.simpleString()
    item = f"struct<i:int,p:{part},in_group:boolean,whole:{_NONE_TYPE}>"
    of_part = lambda p, i: F.struct(i.alias("i"), p.alias("p"), F.coalesce(F.array_contains("grouped", p["part_id"]), F.lit(False)).alias("in_group"), F.lit(None).alias("whole")).cast(item)
    rest = F.struct(F.lit(-1).alias("i"), F.lit(None).alias("p"), F.lit(False).alias("in_group"), F.concat(*[F.coalesce(e, _NONE()) for e in whole]).alias("whole")).cast(item)
    items = r.select("obj_id", "shard", "object_desc", "view", "all_ids", F.concat(F.transform("parts", of_part), F.array(rest)).alias("x")).withColumn("x", F.explode_outer("x")).select("obj_id", "shard", "object_desc", "view", "all_ids", "x.*")
    p, i = F.col("p"), F.col("i")
    every = [_part_specs(p, i), *[_lacking_specs(p, i, "scale", 3, SCALE)] * wanted("scale"), *[_lacking_specs(p, i, "material", 4, MATERIAL)] * wanted("material")]
    made = F.when(i < 0, F.col("whole")).otherwise(F.concat(*[F.coalesce(e, _NONE()) for e in every]))
    # made in a projection, which is compiled; a generator's own expression is not, and an inner one would have all of it made once more, to ask for its size
    specs = items.select("obj_id", "shard", "object_desc", "view", made.alias("made")).select("obj_id", "shard", "object_desc", "view", F.posexplode_outer("made").alias("place", "s")).where("s is not null").select("obj_id", "shard", "object_desc", "view", "place", "s.*")
    if types is not None:
        specs = specs.where(F.col("edit_type").isin(*types, *["deletion"] * wanted("addition")))
    so_far = W.partitionBy("obj_id").orderBy("branch", "i", "place").rowsBetween(W.unboundedPreceding, W.currentRow)
    kinds = D.PREFIX if types is None else {k: v for k, v in D.PREFIX.items() if k in types or (k == "deletion" and wanted("addition"))}
    counts = {k: F.count_if(F.col("edit_type") == k).over(so_far) for k in kinds}
    named = specs.withColumns({f"__{k}": n for k, n in counts.items()}).withColumn("prefix", D.choose(F.col("edit_type"), D.PREFIX))
    # types that share a prefix are numbered together
    seq = D.choose(F.col("edit_type"), {k: sum((F.col(f"__{o}") for o in kinds if D.PREFIX[o] == D.PREFIX[k]), F.lit(0)) for k in kinds}, F.lit(None)) - 1
    named = named.withColumn("edit_id", F.format_string("%s_%s_%03d", "prefix", "obj_id", seq))
    # an addition is only made after a deletion of its group or part, so that one is the last before it
    linked = named.withColumn("source_del_id", F.when(F.col("edit_type") == "addition", F.format_string("%s_%s_%03d", F.lit(D.PREFIX["deletion"]), "obj_id", F.col("__deletion") - 1) if "deletion" in kinds else F.lit("")).otherwise(F.lit("")))
    if types is not None:
        linked = linked.where(F.col("edit_type").isin(*types))
    return linked.select("edit_id", "edit_type", "obj_id", "shard", "object_desc", "remove_part_ids", "keep_part_ids", "old_part_id", "old_label", "source_del_id", "edit_prompt", "after_desc", "mod_type", F.col("view").alias("best_view"))


INSTRUCTIONS = {"deletion": ["Remove the {part}", "Take the {part} off the {obj}", "The {obj} without its {part}"], "addition": ["Add a {part}", "Put a {part} on the {obj}", "The {obj} with a {part}"], "modification": ["Swap the {part}", "Replace the {part} of the {obj}"], "graft": ["Attach the {part} of {donor}"]}


def instructions(specs: DataFrame, k: int = 2) -> DataFrame:
    """``k`` phrasings of each spec whose type has templates, without repetition, by digest."""
    made = []
    for kind, templates in INSTRUCTIONS.items():
        options = F.array(*[F.struct(digest_rank(str(i), F.col("edit_id")).alias("d"), F.lit(t).alias("t")) for i, t in enumerate(templates)])
        chosen = F.slice(F.transform(F.array_sort(options), lambda o: o["t"]), 1, k)
        made.append(F.when(F.col("edit_type") == kind, chosen))
    text = fill_template(F.col("t"), part=F.coalesce(D.filled(F.col("old_label")), F.lit("part")), obj=F.coalesce(D.filled(F.col("object_desc")), F.lit("object")), donor=F.substring("obj_id", 1, 8))
    return specs.withColumn("ts", F.coalesce(*made)).where("ts is not null").select("edit_id", "old_label", "object_desc", "obj_id", F.posexplode("ts").alias("n", "t")).select("edit_id", "n", text.alias("instruction"))
