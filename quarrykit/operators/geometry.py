"""Meshes, cameras and projections as relations of vertices, faces and frames."""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.functions.domain import filled
from quarrykit.functions.vectors import azimuth, elevation
from quarrykit.operators.batched import Lists, by_batches, packed, rows_of
from quarrykit.operators.meshes import nearest_distances
from quarrykit.operators.voxels import few_pairs, span
from quarrykit.sharedfs import cut


def circular_distance(a: Column, b: Column) -> Column:
    d = F.abs(a - b) % 360
    return F.least(d, 360 - d)


def orthogonal_views(frames: DataFrame, targets=(0, 90, 180, -90), target_elevation: float = 25.0, key: str = "obj_id") -> DataFrame:
    """For each target azimuth the view whose camera (cx, cy, cz) is nearest in azimuth and elevation together; of equal ones (to 1e-9 degrees) the first.

    Where ``frames`` has a column ``has_image``, only views that have one count, unless the object has none at all.
    Cameras at the origin are nowhere; an object that has no other gets its first view.
    """
    x, y, z = F.col("cx"), F.col("cy"), F.col("cz")
    seen = F.coalesce(F.col("has_image"), F.lit(False)) if "has_image" in frames.columns else F.lit(True)
    at = frames.select(key, "view", seen.alias("seen"), (x * x + y * y + z * z >= 1e-12).alias("placed"), azimuth(x, y).alias("azimuth"), elevation(x, y, z).alias("elevation"))
    with_image = lambda c: F.min(F.when(F.col("seen"), c))

    def nearest(target: float, least) -> Column:
        da, de = circular_distance(F.col("azimuth"), F.lit(target)), F.col("elevation") - target_elevation
        return least(F.when(F.col("placed"), F.struct(F.round(F.sqrt(da * da + de * de), 9).alias("d"), "view")))

    # one row for each object, and objects brought together first, so a frame is sorted once and not in two tasks for each target
    every = [float(t) for t in targets]
    near = at.repartition(key).groupBy(key).agg(*[nearest(t, least).alias(f"{n}{i}") for i, t in enumerate(every) for n, least in (("a", with_image), ("c", F.min))], F.max("seen").alias("any"), with_image(F.col("view")).alias("b"), F.min("view").alias("d"))
    view = lambda i: F.when(F.col("any"), F.coalesce(F.col(f"a{i}")["view"], F.col("b"))).otherwise(F.coalesce(F.col(f"c{i}")["view"], F.col("d")))
    made = near.select(key, F.explode_outer(F.array(*[F.struct(F.lit(t).alias("target"), view(i).alias("view")) for i, t in enumerate(every)])).alias("t"))
    return made.select(key, "t.target", "t.view")


def orbit(views: DataFrame, n: int = 42, azimuths: int = 7, radius: float = 2.5, lowest: float = -20.0, highest: float = 80.0) -> DataFrame:
    """Camera-to-world matrices, sixteen numbers by rows, for ``views`` (a column ``view`` from 0): ``azimuths`` directions at each of n // azimuths elevations from ``lowest`` to ``highest`` degrees, y up, looking at the origin."""
    rows = n // azimuths
    step = (highest - lowest) / (rows - 1) if rows > 1 else 0.0
    placed = views.where(F.col("view") < rows * azimuths).withColumns({"elevation": lowest + step * F.floor(F.col("view") / azimuths), "azimuth": (F.col("view") % azimuths) * (360.0 / azimuths)})
    e, a, zero = F.radians("elevation"), F.radians("azimuth"), F.lit(0.0)
    se, ce, sa, ca = F.sin(e), F.cos(e), F.sin(a), F.cos(a)
    # columns: right, up, back, place
    rows_ = [[ca, -sa * se, ce * sa, radius * ce * sa], [zero, ce, se, radius * se], [-sa, -ca * se, ce * ca, radius * ce * ca], [zero, zero, zero, F.lit(1.0)]]
    return placed.withColumn("c2w", F.array(*[x for row in rows_ for x in row]))


def axes_turned(df: DataFrame, offset: float = 0.0, scale: float = 1.0) -> DataFrame:
    """(x, y, z) -> (x, -z, y), then moved and scaled."""
    move = lambda c: (c + offset) * scale
    return df.withColumns({"x": move(F.col("x")), "y": move(-F.col("z")), "z": move(F.col("y"))})


def normalised(vertices: DataFrame, key: str = "obj_id") -> DataFrame:
    """Centred on the box, its longest side from -1 to 1. No half of a sum is taken, so a coordinate meets as few roundings as it can."""
    axes = ("x", "y", "z")
    box = vertices.groupBy(key).agg(*[f(c).alias(f"{c}_{n}") for c in axes for f, n in ((F.min, "lo"), (F.max, "hi"))])
    side = F.greatest(*[F.col(f"{c}_hi") - F.col(f"{c}_lo") for c in axes])
    both = vertices.join(box.withColumn("side", side), key)
    return both.select(*[c for c in vertices.columns if c not in axes], *[F.coalesce(F.try_divide(2 * F.col(c) - F.col(f"{c}_lo") - F.col(f"{c}_hi"), F.col("side")), F.lit(0.0)).alias(c) for c in axes])


def projected(vertices: DataFrame, frames: DataFrame, width: int, height: int, key: str = "obj_id") -> DataFrame:
    """Pixels of vertices in each frame of their object. ``w2c`` is the frame's inverse pose, sixteen numbers by rows. Points behind or outside the image are
    dropped; pixels are rounded to even, and those that round to the far edge are the last ones."""
    both = vertices.join(frames, key)
    m = lambda i: F.element_at("w2c", i + 1)
    cam = [m(4 * r) * F.col("x") + m(4 * r + 1) * F.col("y") + m(4 * r + 2) * F.col("z") + m(4 * r + 3) for r in range(3)]
    placed = both.withColumns({"u": cam[0], "v": cam[1], "depth": -cam[2]}).where("depth > 0")
    at = placed.withColumns({"u": F.col("focal") * F.col("u") / F.col("depth") + width / 2, "v": height / 2 - F.col("focal") * F.col("v") / F.col("depth")})
    inside = at.where((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height))
    return inside.withColumns({"px": F.least(F.bround("u", 0).cast("int"), F.lit(width - 1)), "py": F.least(F.bround("v", 0).cast("int"), F.lit(height - 1))}).drop("u", "v")


def visible(points: DataFrame, pixels: DataFrame, key: str = "obj_id", least: float = 0.5) -> DataFrame:
    """Projected points whose pixel (px, py, r, g, b, alpha from 0 to 1) is more opaque than ``least``, with its colour."""
    seen = pixels.where(F.col("alpha") > least).select(key, "view", "px", "py", "r", "g", "b")
    return points.join(seen, [key, "view", "px", "py"])


def vertex_colours(samples: DataFrame, vertices: DataFrame, key: str = "vertex", open_above: str = "") -> DataFrame:
    """Mean of the visible samples, cut to a byte; 128 grey where none sees the vertex. Channels of ``open_above`` keep what is over a byte."""
    cut_off = lambda c, mean: mean if c in open_above else F.least(F.lit(255.0), mean)
    mean = samples.groupBy(key).agg(*[F.floor(cut_off(c, F.greatest(F.lit(0.0), F.avg(c)))).cast("int").alias(c) for c in "rgb"])
    return vertices.select(key).join(mean, key, "left").select(key, *[F.coalesce(c, F.lit(128)).alias(c) for c in "rgb"])


def pixel_counts(pixels: DataFrame, key: str = "obj_id") -> DataFrame:
    return pixels.where("part >= 0").groupBy(key, "view", "part").agg(F.count("*").alias("n"))


def best_views(counts: DataFrame, parts: DataFrame, default: int = 0, skip=(), key: str = "obj_id") -> DataFrame:
    """For each part the view with most pixels, the first on a tie, the default where it is not seen."""
    seen = counts.where((F.col("n") > 0) & ~F.col("view").isin(*skip)) if skip else counts.where("n > 0")
    top = seen.groupBy(key, "part").agg(F.max_by("view", F.struct("n", -F.col("view"))).alias("view"))
    return parts.select(key, "part").distinct().join(top, [key, "part"], "left").select(key, "part", F.coalesce("view", F.lit(default)).alias("view"))


def best_view_of_set(counts: DataFrame, wanted: DataFrame, default: int = 0, skip=(), key: str = "obj_id") -> DataFrame:
    """The view in which a set of parts has most pixels together."""
    kept = counts.where(~F.col("view").isin(*skip)) if skip else counts
    total = kept.join(wanted.select(key, "part").distinct(), [key, "part"], "left_semi").groupBy(key, "view").agg(F.sum("n").alias("n")).where("n > 0")
    top = total.groupBy(key).agg(F.max_by("view", F.struct("n", -F.col("view"))).alias("view"))
    return wanted.select(key).distinct().join(top, key, "left").select(key, F.coalesce("view", F.lit(default)).alias("view"))


def majority_labels(votes: DataFrame, key: str, label: str) -> DataFrame:
    """The label with most votes, the least on a tie."""
    n = votes.groupBy(key, label).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias(label))


def kept_faces(faces: DataFrame, removed: DataFrame, key: str = "obj_id") -> DataFrame:
    """Faces of the parts that stay: deletion of parts from a mesh."""
    return faces.join(removed.select(key, "part").distinct(), [key, "part"], "left_anti")


def assembled(parts: DataFrame, wanted: DataFrame, key: str = "obj_id") -> DataFrame:
    """The listed parts joined to one mesh: each with the offset of its vertices in it."""
    chosen = parts.join(wanted.select(key, "part").distinct(), [key, "part"], "left_semi")
    before = F.sum("n_vertices").over(W.partitionBy(key).orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return chosen.withColumn("offset", F.coalesce(before, F.lit(0)).cast("long"))


def split_faces(faces: DataFrame, key: str = "obj_id") -> DataFrame:
    """Faces (a, b, c, part) with their vertices numbered anew from 0 within each part."""
    kind, part = (faces.schema[c].dataType.simpleString() for c in (key, "part"))
    names = ["part", "a", "b", "c"]

    def run(b: pa.RecordBatch):
        f = Lists(b, *names)
        values = f.numpy(np.int64)
        within = np.unique(values[0], return_inverse=True)[1] if len(values[0]) else values[0]
        mesh, v = np.tile(f.row * (within.max(initial=0) + 1) + within, 3), np.concatenate(values[1:])
        order = np.lexsort((v, mesh))
        new = np.append(True, mesh[order][1:] != mesh[order][:-1])[: len(order)]
        rank = np.cumsum(new | np.append(True, v[order][1:] != v[order][:-1])[: len(order)])
        anew = np.empty(len(order), np.int64)
        anew[order] = rank - np.maximum.accumulate(np.where(new, rank, 0))
        a, b_, c = np.split(anew.astype(np.int32), 3)
        yield rows_of(b, key, f.row, part=f.values[0], a=pa.array(a), b=pa.array(b_), c=pa.array(c))

    return by_batches(packed(key, f=(faces, {n: F.col(n) for n in names})), run, f"{key} {kind}, part {part}, a int, b int, c int")


def lower_tenth(d: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Tenth percentile of each run of ``n`` sorted numbers from ``start``, between two of them in proportion, as numpy's."""
    at = (n - 1) * 0.1
    low = np.floor(at).astype(np.int64)
    a, b, t = d[start + low], d[start + np.minimum(low + 1, n - 1)], at - low
    return np.where(t >= 0.5, b - (b - a) * (1 - t), a + (b - a) * t)


def gap_distance(part: DataFrame, body: DataFrame, key: str = "obj_id") -> DataFrame:
    """Tenth percentile of the distances from a part's distinct vertices to the nearest of the body; objects that lack one of the two are left out.

    The two meshes of an object meet in one task, where a search along the body's longest axis stops at what cannot be nearer."""
    kind = part.schema[key].dataType.simpleString()
    side = lambda s: {f"{s}{c}": F.col(c).cast("double") for c in "xyz"}

    def run(b: pa.RecordBatch):
        p, k = Lists(b, "px", "py", "pz"), Lists(b, "bx", "by", "bz")
        points, known = np.stack(p.numpy(float), axis=1), np.stack(k.numpy(float), axis=1)
        order = np.lexsort((*points.T[::-1], p.row))
        points, row = points[order], p.row[order]
        first = np.append(True, (points[1:] != points[:-1]).any(axis=1) | (row[1:] != row[:-1]))[: len(points)]  # distinct vertices, those of an object in its place
        d = np.zeros(len(points))
        for pairs, at in few_pairs(p, k):
            if pairs is None:
                d[span(p, at)] = nearest_distances(points[span(p, at)], known[span(k, at)])
            else:
                left, i, j, begin = pairs
                d[left] = np.sqrt(np.minimum.reduceat(((points[i] - known[j]) ** 2).sum(axis=1), begin))
        has = (p.size > 0) & (k.size > 0)
        keep = first & has[row]
        d, row = d[keep], row[keep]
        d, n = d[np.lexsort((d, row))], np.bincount(row, minlength=b.num_rows)
        at = np.flatnonzero(n)
        start = (np.cumsum(n) - n)[at]
        yield rows_of(b, key, at, gap=pa.array(lower_tenth(d, start, n[at])))

    return by_batches(packed(key, p=(part, side("p")), b=(body, side("b"))), run, f"{key} {kind}, gap double")


def contact_points(distances: DataFrame, threshold: float, key: str = "obj_id", least: int = 10) -> DataFrame:
    """Points within the threshold, or the closest tenth where those are fewer than ``least``."""
    w = W.partitionBy(key)
    d = distances.withColumns({"near": F.count_if(F.col("d") <= threshold).over(w), "n": F.count("*").over(w), "r": F.row_number().over(w.orderBy("d", "v"))})
    return d.where(F.when(F.col("near") >= least, F.col("d") <= threshold).otherwise(F.col("r") <= F.greatest(F.lit(1), F.floor(F.col("n") / 10)))).select(key, "v", "d")


def aligned_scale(source: list[Column], target: list[Column]) -> tuple[Column, Column]:
    """(scale that fits, reported ratio) from the sides of two boxes: the least and the greatest ratio."""
    r = [F.coalesce(F.try_divide(t, s), F.lit(1.0)) for s, t in zip(source, target)]
    return F.least(*r), F.greatest(*r)


def graft_scale(donor: list[Column], target: list[Column], share: float = 0.4) -> Column:
    """Scale of a grafted part: at most ``share`` of the target's longest side, never larger than it is."""
    return F.least(F.lit(1.0), F.coalesce(F.try_divide(F.lit(share) * F.greatest(*target), F.greatest(*donor)), F.lit(1.0)))


def swap_candidates(catalog: DataFrame, n: int = 5, faces: float = 5.0, aspect: float = 2.0, heads=(256, 4096)) -> DataFrame:
    """For each part of a catalogue up to ``n`` others of its category: another object, the same coarse type
    where both are known, face counts and aspects within a ratio where both are known; in catalogue order.

    Parts that are alike in all of that share one list, so likes are paired and not parts. Of one object ``n`` and in all ``2 n``
    of a list are enough for every member, whose own object is then left out. A list is sought among the first rows of a category, as many as ``heads`` say; only
    one that is not full there is held against the whole category, so the cost is near the first head times the likes.
    """
    c = lambda s: F.col(s)
    traits = ("category", "object_type", "cluster_size", "aspect")
    parts = catalog.where("category is not null and obj_id is not null").select("idx", "obj_id", "category", filled(c("object_type")).alias("object_type"), "cluster_size", "aspect")

    def enough(rows: DataFrame, *by: str) -> DataFrame:
        rows = rows.withColumn("r", F.row_number().over(W.partitionBy(*by, "obj_id").orderBy("idx"))).where(c("r") <= n)
        return rows.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy("idx"))).where(c("r") <= 2 * n).drop("r")

    def lists(likes: DataFrame, rows: DataFrame) -> DataFrame:
        a, b = likes.alias("a"), rows.alias("b")
        like = (c("a.category") == c("b.category")) & F.coalesce(c("a.object_type") == c("b.object_type"), F.lit(True))
        for name, most in (("cluster_size", faces), ("aspect", aspect)):
            x, y = c(f"a.{name}"), c(f"b.{name}")
            like = like & F.coalesce((x <= 0) | (y <= 0) | (F.greatest(x, y) <= F.lit(most) * F.least(x, y)), F.lit(True))
        found = enough(a.join(b, like).select(*[c(f"a.{t}").alias(t) for t in traits], c("b.idx").alias("idx"), c("b.obj_id").alias("obj_id")), *traits)
        return found.groupBy(*traits).agg(F.array_sort(F.collect_list(F.struct("idx", "obj_id"))).alias("found"))

    same = lambda a, b: reduce(and_, [c(f"{a}.{t}").eqNullSafe(c(f"{b}.{t}")) for t in traits])
    offered = cut(enough(parts, *traits), "offered")
    open_, closed = offered.select(*traits).distinct(), []
    for head in heads:
        first = offered.withColumn("r", F.row_number().over(W.partitionBy("category").orderBy("idx"))).where(c("r") <= head).drop("r")
        large = offered.groupBy("category").count().where(c("count") > head).select("category")
        near = cut(lists(open_, first), "near")
        full = near.where(F.size("found") == 2 * n).join(large, "category", "left_semi")
        closed += [near.join(large, "category", "left_anti"), full]
        open_ = cut(open_.join(large, "category", "left_semi").alias("l").join(full.alias("f"), same("l", "f"), "left_anti"), "open")
    done = reduce(DataFrame.unionByName, [*closed, lists(open_, offered)])
    others = F.slice(F.filter("found", lambda o: o["obj_id"] != c("p.obj_id")), 1, n)
    ranked = parts.alias("p").join(done.alias("d"), same("p", "d")).select(c("p.idx").alias("idx"), F.posexplode(others).alias("k", "o"))
    return ranked.select("idx", c("o.idx").alias("candidate"), (c("k") + 1).alias("rank"))
