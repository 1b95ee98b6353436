"""Domains of the edit data and the column functions that read them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EDIT_TYPES = ("deletion", "addition", "modification", "scale", "material", "global", "identity")
PREFIX = {"deletion": "del", "addition": "add", "modification": "mod", "scale": "scl", "material": "mat", "global": "glb", "identity": "idt"}
LEGACY_PREFIX = {"gdel": "deletion", "gadd": "addition"}
PROCESS_ORDER = {"deletion": 0, "modification": 1, "scale": 2, "material": 3, "global": 4, "identity": 5, "addition": 6}
TWO_STAGE, ONE_STAGE, MESH_ONLY, NOTHING_TO_MAKE = ("modification", "scale"), ("material", "global"), ("deletion",), ("identity", "addition")
GPU_TYPES = TWO_STAGE + ONE_STAGE
TIERS = ("high", "medium", "low", "negative", "rejected")
CORE_WORDS = ("body", "torso", "base", "frame", "main", "head", "wall", "floor", "chassis", "hull", "trunk")


def choose(key: Column, table: dict, otherwise=None) -> Column:
    """CASE over a fixed table."""
    made = None
    for k, v in table.items():
        made = (F if made is None else made).when(key == F.lit(k), F.lit(v))
    return made.otherwise(F.lit(otherwise)) if otherwise is not None else made


def filled(c: Column) -> Column:
    """The string, or null where it is empty: what counts as missing in an or-chain."""
    return F.when(F.length(c) > 0, c)


def tier_rank(tier: Column) -> Column:
    """Place of a tier, best first; unknown and missing tiers come last."""
    return F.coalesce(choose(tier, {t: i for i, t in enumerate(TIERS)}), F.lit(len(TIERS) - 1))


def tier_at_least(tier: Column, least: str) -> Column:
    return tier_rank(tier) <= F.lit(TIERS.index(least))


def tier_at_least_or_absent(tier: Column, least: str) -> Column:
    """The lenient form: a row without a tier passes."""
    return filled(tier).isNull() | tier_at_least(tier, least)


def tier_of(quality_tier: Column, tier: Column) -> Column:
    return F.coalesce(quality_tier, tier, F.lit("rejected"))


def route(edit_type: Column) -> Column:
    """Which worker an edit goes to."""
    return F.when(edit_type.isin(*GPU_TYPES), "gpu").when(edit_type.isin(*EDIT_TYPES), "non_gpu").otherwise("unknown")


def effective_type(edit_type: Column) -> Column:
    """The generator's name for a type; anything else is handled as a modification."""
    return choose(edit_type, {"deletion": "Deletion", "addition": "Addition", "modification": "Modification", "scale": "Scale", "material": "Material", "global": "Global"}, "Modification")


def type_of_id(edit_id: Column) -> Column:
    """Type by the part of an id before its first underscore, which must be there."""
    table = {p: t for t, p in PREFIX.items()} | LEGACY_PREFIX
    return F.when(F.instr(edit_id, "_") > 0, F.coalesce(choose(F.substring_index(edit_id, "_", 1), table), F.lit("unknown"))).otherwise("unknown")


def object_of_id(edit_id: Column) -> Column:
    """The id without its first and last piece; with one underscore what follows it; without any the id."""
    return (
        F.when(F.instr(edit_id, "_") == 0, edit_id)
        .when(F.size(F.split(edit_id, "_")) == 2, F.substring_index(edit_id, "_", -1))
        .otherwise(F.regexp_extract(edit_id, "^[^_]*_(.*)_[^_]*$", 1))
    )


def zero_padded(c: Column, width: int) -> Column:
    """Left zeros; a longer string stays whole (a plain lpad would cut it)."""
    s = c.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def run_token(tag: Column, shard: Column) -> Column:
    return F.coalesce(filled(tag), F.concat(F.lit("shard"), zero_padded(shard, 2)))


def first_label(remove_labels: Column, target_labels: Column) -> Column:
    return F.coalesce(filled(F.try_element_at(remove_labels, F.lit(1))), filled(F.try_element_at(target_labels, F.lit(1))), F.lit(""))


def part_label(remove_labels: Column, old_label: Column) -> Column:
    """All labels when there are several, the one, or the old label."""
    n = F.size(remove_labels)
    return F.when(n > 1, F.array_join(remove_labels, ", ")).when(n == 1, F.try_element_at(remove_labels, F.lit(1))).otherwise(old_label)


def part_ids(edit_type: Column, remove_ids: Column, old_id: Column, grouped_types=("modification", "scale")) -> Column:
    """Ids of the parts that an edit touches. Only ``grouped_types`` may touch a group; material edits touch their one part."""
    one = F.when(old_id >= 0, F.array(old_id)).otherwise(F.array().cast("array<int>"))
    grouped = edit_type.isin(*grouped_types) & (F.size(remove_ids) > 0)
    return F.when(edit_type.isin("deletion", "addition") | grouped, remove_ids).otherwise(one)


def is_core(label: Column) -> Column:
    """Whether a word of the label names a core part."""
    return F.arrays_overlap(F.split(F.lower(label), "[_\\s-]+"), F.array(*map(F.lit, CORE_WORDS)))


def padded_labels(labels: Column, n: Column) -> Column:
    """Labels cut or filled with ``unknown_i`` to length ``n``."""
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.get(labels, i), F.concat(F.lit("unknown_"), i.cast("string"))))).otherwise(F.array().cast("array<string>"))


def node_label(name: Column) -> Column:
    return F.regexp_replace(name, "_[^_]*$", "")
