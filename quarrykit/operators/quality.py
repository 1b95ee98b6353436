"""Checks of before/after pairs: metrics, verdicts, tiers, summaries.

A check is rows (name, value, passed, weight, reason) held as an array of structs in the edit's
row, built of column expressions over per-edit numbers, so all checks of a table are one projection.
Thresholds are a dict that becomes literals. Rules over the structure latent are left out of an edit
whose number is null (no latent stored), with their weight; every other rule fails without its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrykit.functions.vectors import rounded

THRESHOLDS = {
    "min_voxels": 100, "max_voxels": 40000, "max_feat_abs": 50.0, "min_feat_std": 0.01, "max_ss_abs": 100.0, "min_ss_std": 0.001, "grid": 64,
    "deletion": {"voxel": (0.05, 0.95), "deleted": (0.02, 0.80), "iou": 0.15, "ss": (0.01, 0.90), "components": 3},
    "addition": {"voxel": (1.05, 20.0), "added": (0.02, 0.80), "iou": 0.15},
    "modification": {"voxel": (0.3, 3.0), "cosine": 0.3, "locality": (0.02, 0.70), "components": 5, "drift": 0.3, "feat": 5.0},
    "scale": {"voxel": (0.5, 2.0), "cosine": 0.5, "locality": (0.01, 0.50), "drift": 0.2, "axis": (0.7, 1.8)},
    "material": {"count": 0.01, "ss": 1e-3, "feat": (0.01, 2.0)},
    "global": {"count": 0.01, "ss": 1e-3, "feat": (0.02, 2.0), "coverage": 0.3},
}
METRIC = "struct<name:string,value:double,passed:boolean,weight:double,reason:string>"


def metric(name: str, value: Column, passed: Column, weight: float | Column = 1.0, unless: str | None = None) -> Column:
    """A row of a check; without a value it fails."""
    ok = F.coalesce(passed, F.lit(False))
    return F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"), ok.alias("passed"), _number(weight).alias("weight"), F.when(~ok, F.lit(unless or f"{name} out of bounds")).otherwise(F.lit("")).alias("reason")).cast(METRIC)


def _number(weight: float | Column) -> Column:
    return weight.cast("double") if isinstance(weight, Column) else F.lit(float(weight))


def within(name: str, value: Column, bounds: tuple[float, float], weight: float) -> Column:
    return metric(name, value, value.between(*bounds), weight)


def weighted_score(metrics: Column) -> Column:
    """Passed weight over all weight, four decimals; 0 without any weight."""
    weight = F.aggregate(metrics, F.lit(0.0), lambda s, m: s + m["weight"])
    passed = F.aggregate(metrics, F.lit(0.0), lambda s, m: s + F.when(m["passed"], m["weight"]).otherwise(F.lit(0.0)))
    return F.when(weight < 1e-12, F.lit(0.0)).otherwise(F.round(F.try_divide(passed, weight), 4))


def all_passed(metrics: Column) -> Column:
    return F.forall(metrics, lambda m: m["passed"])


def first_failure(metrics: Column) -> Column:
    return F.get(F.filter(metrics, lambda m: ~m["passed"]), F.lit(0))["name"]


def score_tier(score: Column, passed: Column, high: float = 0.8, medium: float = 0.6, low: float = 0.4) -> Column:
    """Any failed metric makes it negative; else by score."""
    return F.when(~passed, "negative").when(score >= high, "high").when(score >= medium, "medium").when(score >= low, "low").otherwise("negative")


Rule = tuple  # (name, value, passed, weight[, applies])


def _applies(r: Rule) -> Column | None:
    return r[4] if len(r) > 4 else None


def _metrics(rules: list[Rule]) -> Column:
    made = F.array(*[metric(*r[:4]) if _applies(r) is None else F.when(_applies(r), metric(*r[:4])) for r in rules])
    return F.filter(made, lambda m: m.isNotNull()) if any(_applies(r) is not None for r in rules) else made


def _bounded(name: str, value: Column, bounds: tuple[float, float], weight: float) -> Rule:
    return name, value, value.between(*bounds), weight


def _spread(name: str, most: Column, std: Column, max_abs: float, min_std: float) -> Rule:
    """Finite, not too large (weight 3 where it is not), not constant (weight 2); the value is what decided."""
    broken = F.isnan(most.cast("double")) | (F.abs(most.cast("double")) == F.lit(float("inf"))) | F.isnan(std.cast("double")) | most.isNull()
    large = most > max_abs
    value = F.when(broken, 0.0).when(large, most).when(std < min_std, std).otherwise(most)
    return name, value, ~broken & ~large & (std >= min_std), F.when(broken | large, 3.0).otherwise(2.0)


def rules_one(t: dict = THRESHOLDS, ss: bool = True, columns=()) -> list[Rule]:
    """``columns``: those of the table, where it may also have ``batch_min`` and ``coord_columns``."""
    c = F.col
    inside = (c("coord_min") >= 0) & (c("coord_max") < t["grid"])
    if "batch_min" in columns:
        inside = inside & (c("batch_min") >= 0)
    if "coord_columns" in columns:
        inside = inside & (c("coord_columns") == 4)
    made = [
        ("voxel_count", c("n_voxels"), c("n_voxels").between(t["min_voxels"], t["max_voxels"]), 2),
        _spread("feat_range", c("feat_max"), c("feat_std"), t["max_feat_abs"], t["min_feat_std"]),
        ("coords_valid", F.coalesce(inside, F.lit(False)).cast("int"), inside, 3),
        ("coords_unique", c("n_unique") / F.greatest(c("n_voxels"), F.lit(1)), c("n_unique") == c("n_voxels"), 2),
    ]
    if ss:
        made.insert(2, (*_spread("ss_range", c("ss_max"), c("ss_std"), t["max_ss_abs"], t["min_ss_std"]), c("ss_max").isNotNull()))
    return made


def rules_two(t: dict = THRESHOLDS) -> dict[str, list[Rule]]:
    """By type; ``global+`` is for a global edit whose sides have as many voxels."""
    c = F.col
    d, a, m, s, mt, g = (t[k] for k in ("deletion", "addition", "modification", "scale", "material", "global"))

    def painted(k):
        return [("voxel_count_close", c("voxel_ratio"), F.abs(c("voxel_ratio") - 1) <= k["count"], 2), ("ss_match", c("ss_diff"), c("ss_diff") < k["ss"], 3, c("ss_diff").isNotNull()), _bounded("feat_change", c("feat_change"), k["feat"], 1.5)]

    return {
        "deletion": [_bounded("voxel_ratio", c("voxel_ratio"), d["voxel"], 2), _bounded("delete_ratio", c("deleted"), d["deleted"], 2), ("bbox_iou", c("iou"), c("iou") >= d["iou"], 1.5), (*_bounded("ss_change", c("ss_l2"), d["ss"], 1), c("ss_l2").isNotNull()), ("connected_components", c("components"), c("components") <= d["components"], 1.5), ("not_degenerate", c("min_extent"), c("min_extent") > 1, 2)],
        "addition": [_bounded("voxel_ratio", c("voxel_ratio"), a["voxel"], 2), _bounded("add_ratio", c("added"), a["added"], 2), ("bbox_iou", c("iou"), c("iou") >= a["iou"], 1.5)],
        "modification": [_bounded("voxel_ratio", c("voxel_ratio"), m["voxel"], 1.5), ("ss_cosine_sim", c("ss_cosine"), c("ss_cosine") >= m["cosine"], 2, c("ss_cosine").isNotNull()), _bounded("edit_locality", c("locality"), m["locality"], 2.5), ("connected_components", c("components"), c("components") <= m["components"], 1), ("center_drift", c("drift"), c("drift") < m["drift"], 1.5), ("feat_change", c("feat_change"), c("feat_change") < m["feat"], 1)],
        "scale": [_bounded("voxel_ratio", c("voxel_ratio"), s["voxel"], 2), ("ss_cosine_sim", c("ss_cosine"), c("ss_cosine") >= s["cosine"], 2.5, c("ss_cosine").isNotNull()), _bounded("edit_locality", c("locality"), s["locality"], 2), ("center_drift", c("drift"), c("drift") < s["drift"], 1.5), ("bbox_axis_ratio", c("axis_max"), (c("axis_min") >= s["axis"][0]) & (c("axis_max") <= s["axis"][1]), 1.5)],
        "material": painted(mt),
        "global": painted(g),
        "global+": [*painted(g), ("change_coverage", c("coverage"), c("coverage") >= g["coverage"], 1.5)],
        "identity": [("identity_valid", F.lit(1.0), F.lit(True), 1)],
    }


def _by_type(rules: dict[str, list[Rule]], f, otherwise: Column) -> Column:
    kind = F.col("edit_type")
    made = F.when((kind == "global") & F.col("same_count"), f(rules["global+"]))
    for k, rs in rules.items():
        if k != "global+":
            made = made.when(kind == k, f(rs))
    return made.otherwise(otherwise)


def layer_one(t: dict = THRESHOLDS, ss: bool = True, columns=()) -> Column:
    """Array sanity, from n_voxels, feat_max, feat_std, ss_max, ss_std, coord_min, coord_max, n_unique (and batch_min, coord_columns if ``columns`` has them)."""
    return _metrics(rules_one(t, ss, columns))


def layer_two(t: dict = THRESHOLDS) -> Column:
    """Pair checks by edit_type, from voxel_ratio, deleted, added, iou, ss_l2, ss_cosine, ss_diff, components, locality, drift, feat_change, axis_min, axis_max, min_extent, coverage, same_count.

    Of an addition "before" is its deletion's after side, so the ratios are taken as they come.
    """
    return _by_type(rules_two(t), _metrics, F.array(metric("unknown_type", F.lit(0.0), F.lit(False))))


def _passed(r: Rule) -> Column:
    return F.coalesce(r[2], F.lit(False))


def _score(rules: list[Rule]) -> Column:
    """As ``weighted_score``, in plain arithmetic."""
    got = whole = F.lit(0.0)
    for r in rules:
        weight = _number(r[3])
        if (there := _applies(r)) is not None:
            weight = F.when(there, weight).otherwise(F.lit(0.0))
        got = got + F.when(_passed(r), weight).otherwise(F.lit(0.0))
        whole = whole + weight
    return F.coalesce(F.round(F.try_divide(got, whole), 4), F.lit(0.0))


def _failure(rules: list[Rule]) -> Column:
    """The first rule that fails, empty if none does."""
    made = None
    for r in rules:
        there = _applies(r)
        made = (F if made is None else made).when(~_passed(r) if there is None else there & ~_passed(r), F.lit(r[0]))
    return made.otherwise(F.lit(""))


def verdicts(edits: DataFrame, t: dict = THRESHOLDS) -> DataFrame:
    """(..., score, tier, reason) by the order of the rules: identity, missing after side, array sanity, missing original, both layers."""
    # numbers and strings only, no arrays: each edit's rules are evaluated inside generated code
    first, second = rules_one(t, columns=edits.columns), rules_two(t)
    d = edits.withColumns({"s1": _score(first), "f1": _failure(first), "s2": _by_type(second, _score, F.lit(0.0)), "f2": _by_type(second, _failure, F.lit("unknown_type"))})
    one, two, ok1, ok2 = F.col("s1"), F.col("s2"), F.col("f1") == "", F.col("f2") == ""
    both = (one + two) / 2  # tiers are of the unrounded mean
    clean = ok1 | ~F.col("has_original")  # an identity without an original has nothing that could be wrong
    kind, after, original = F.col("edit_type"), F.col("has_after"), F.col("has_original")
    score = F.when(kind == "identity", F.when(clean, 1.0).otherwise(0.5)).when(~after, 0.0).when(~ok1, one * 0.5).when(~original, 0.0).otherwise(rounded(both))
    tier = F.when(kind == "identity", F.when(clean, "high").otherwise("negative")).when(~after | ~ok1 | ~original, "rejected").otherwise(score_tier(both, ok1 & ok2))
    reason = F.when(kind == "identity", F.lit("")).when(~after, "missing after").when(~ok1, F.col("f1")).when(~original, "missing original").otherwise(F.col("f2"))
    return d.select("*", score.alias("score"), tier.alias("tier"), reason.alias("reason")).drop("s1", "s2", "f1", "f2")


def summary(rows: DataFrame, *by: str) -> DataFrame:
    """Counts by tier, type, both and none, in one pass, for each of ``by`` and over all: ``level`` tells a total from a null key."""
    keys = [*by, "tier", "edit_type"]
    sets = [[*p, *s] for p in ([[]] if not by else [[], list(by)]) for s in ([], ["tier"], ["edit_type"], ["tier", "edit_type"])]
    return rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))


def clean_counts(rows: DataFrame, least: str, *by: str) -> DataFrame:
    from quarrykit.functions.domain import tier_at_least

    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col("tier").isin("high", "medium")).alias("passed"), F.count_if(tier_at_least(F.col("tier"), least)).alias("clean"))


def quality_report(rows: DataFrame) -> DataFrame:
    n = F.greatest(F.count("*"), F.lit(1))
    return rows.agg(
        F.count("*").alias("total"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"),
        F.round(F.count_if("passed") / n, 4).alias("pass_rate"), F.round(F.avg("score"), 4).alias("mean_score"), F.round(F.median("score"), 4).alias("median_score"),
    )


def metric_pass_rates(rows: DataFrame, metrics: str = "metrics") -> DataFrame:
    return rows.select(F.explode(metrics).alias("m")).groupBy("m.name").agg(F.count("*").alias("n"), F.round(F.avg(F.col("m.passed").cast("int")), 4).alias("pass_rate"))


def tier_distribution(rows: DataFrame) -> DataFrame:
    from pyspark.sql import Window as W

    made = rows.groupBy("tier").agg(F.count("*").alias("n"))
    return made.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))), 1))


def finalised(edits: DataFrame, scores: DataFrame) -> DataFrame:
    """Quality rows of all edits: identities are high, unscored ones rejected."""
    both = edits.join(scores.select("edit_id", F.col("tier").alias("t"), F.col("score").alias("s")), "edit_id", "left")
    same = F.col("edit_type") == "identity"
    return both.select("edit_id", F.when(same, "high").otherwise(F.coalesce("t", F.lit("rejected"))).alias("tier"), F.when(same, 1.0).otherwise(F.coalesce("s", F.lit(0.0))).alias("score"))


MESH = {"volume": (0.05, 5.0), "area": (0.1, 8.0), "edited": (0.01, 0.95), "part": (0.005, 0.80), "components": 5, "vertices": 50, "extent": 1e-4, "drift": 0.3, "colour": 1.0, "overlap": 0.1, "penetration": 0.3, "gap": 0.15, "scale": 3.0}


def mesh_metrics(t: dict = MESH, swap: bool = False) -> Column:
    """Checks of a pair of meshes from their measured numbers (see ``geometry``)."""
    c = F.col
    made = [
        within("volume_ratio", c("volume_ratio"), t["volume"], 1.5), within("surface_area_ratio", c("area_ratio"), t["area"], 1), within("edit_ratio", c("edit_ratio"), t["edited"], 2), within("part_proportion", c("part_proportion"), t["part"], 1.5),
        metric("connected_components", c("components"), c("components") <= t["components"], 1), metric("has_geometry", c("min_vertices"), c("min_vertices") >= t["vertices"], 2), metric("not_degenerate", c("min_extent"), c("min_extent") >= t["extent"], 1),
        metric("center_drift", c("drift"), c("drift") < t["drift"], 1), metric("vertex_color", c("min_colour_std"), c("min_colour_std") > t["colour"], 0.5), metric("bbox_overlap", c("iou"), c("iou") >= t["overlap"], 1),
    ]
    if swap:
        made += [metric("penetration", c("penetration"), c("penetration") <= t["penetration"], 2), metric("gap_distance", c("gap"), c("gap") <= t["gap"], 1.5), metric("scale_match", c("scale_ratio"), c("scale_ratio") <= t["scale"], 1.5)]
    return F.array(*made)
