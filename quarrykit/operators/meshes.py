"""Numbers of meshes and of pairs of meshes, measured from their vertices and faces.

``vertices`` has (obj_id, side, v, x, y, z) and, for colours, (r, g, b); ``faces`` has (obj_id, side, a, b, c), rows of vertex
numbers. Sides are ``before`` and ``after``. Boxes, areas, vertex sets and colours are grouped aggregates; what needs a whole
mesh at once (components, points inside) runs once for each mesh, over arrays.
"""

from __future__ import annotations

import decimal
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrykit.operators.batched import Lists, by_batches, number, packed, rows_of
from quarrykit.operators.quality import all_passed, first_failure, mesh_metrics, weighted_score
from quarrykit.operators.voxels import least_labels

XYZ = ["x", "y", "z"]


def mesh_boxes(vertices: DataFrame, *by: str) -> DataFrame:
    """Vertices, box and colour deviation (population, over all channels together) for each of ``by``."""
    ends = [f(c).alias(f"{c}_{n}") for c in XYZ for f, n in ((F.min, "lo"), (F.max, "hi"))]
    colour = []
    if "r" in vertices.columns:
        channels = [F.col(c).cast("double") for c in "rgb"]
        n = F.count("*") * 3
        mean = sum((F.sum(c) for c in channels[1:]), F.sum(channels[0])) / n
        squares = sum((F.sum(c * c) for c in channels[1:]), F.sum(channels[0] * channels[0])) / n
        colour = [F.sqrt(F.greatest(F.lit(0.0), squares - mean * mean)).alias("colour_std")]
    return vertices.groupBy(*by).agg(F.count("*").alias("n_vertices"), *ends, *colour)


def _rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """To even by the decimal digits of the number as it is written, as ``bround``; zeros are positive."""
    scaled = x * 10.0**digits
    made = np.rint(scaled) / 10.0**digits
    with np.errstate(invalid="ignore"):
        tie = np.isfinite(scaled) & (np.abs(scaled - np.floor(scaled) - 0.5) < 1e-9 * (1 + np.abs(scaled)))
    big = np.isfinite(x) & (np.abs(scaled) >= 2.0**50)
    made[big] = x[big]
    unit = decimal.Decimal(1).scaleb(-digits)
    for i in np.flatnonzero(tie & ~big):
        made[i] = float(decimal.Decimal(repr(float(x[i]))).quantize(unit, decimal.ROUND_HALF_EVEN))
    return np.where(np.isnan(made), np.nan, made) + 0.0


class _Corners:
    """Vertices of all meshes of a batch by (mesh, number): where the corners of faces are found. Of equal numbers the greatest (x, y, z) counts."""

    def __init__(self, mesh: np.ndarray, v: np.ndarray, xyz: np.ndarray):
        order = np.lexsort((*xyz.T[::-1], v, mesh))
        mesh, v, self.xyz = mesh[order], v[order], xyz[order]
        self.numbers = np.unique(v)
        code = mesh * (len(self.numbers) + 1) + np.searchsorted(self.numbers, v)
        last = np.append(code[1:] != code[:-1], True)[: len(code)]
        self.code, self.at = code[last], np.flatnonzero(last)
        self.times = np.diff(np.append(-1, self.at))

    def find(self, mesh: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``code``, whether it is there)."""
        if not len(self.code):
            return np.zeros(len(v), np.int64), np.zeros(len(v), bool)
        known = np.minimum(np.searchsorted(self.numbers, v), len(self.numbers) - 1)
        code = mesh * (len(self.numbers) + 1) + known
        to = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return to, (self.numbers[known] == v) & (self.code[to] == code)


def _faces(mesh: np.ndarray, abc: list[np.ndarray], corners: _Corners) -> tuple[np.ndarray, np.ndarray]:
    """(mesh, area) of the faces whose corners are all there."""
    found = [corners.find(mesh, v) for v in abc]
    whole = found[0][1] & found[1][1] & found[2][1]
    p, q, r = (corners.xyz[corners.at[to[whole]]] if len(corners.at) else np.empty((0, 3)) for to, _ in found)
    u, w = q - p, r - p
    cross = [u[:, i] * w[:, j] - u[:, j] * w[:, i] for i, j in ((1, 2), (2, 0), (0, 1))]
    return mesh[whole], np.sqrt(cross[0] * cross[0] + cross[1] * cross[1] + cross[2] * cross[2]) / 2


_SIDES, _ENDS = ("b", "a"), [f"{c}_{n}" for c in XYZ for n in ("lo", "hi")]


def _measured_sides(vertices: DataFrame, faces: DataFrame, key: str, digits: int, components: bool) -> DataFrame:
    """One row for each key with vertices: of both sides (``b_``, ``a_``) the vertices, box, colour deviation (population, over all channels together),
    faces and area, nulls where a side has no vertices; the (rounded) vertices that differ and those of each side; closed components after.

    Vertices and faces of a key travel together once, as lists, and are measured for many meshes side by side."""
    colour = "r" in vertices.columns
    code = F.when(F.col("side") == "before", 0).when(F.col("side") == "after", 1).otherwise(2).cast("byte")
    label = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-(2**63)))  # noqa: E731 - no corner of a face
    v = {"vs": code, "vi": label("v"), **{c: number(c) for c in XYZ}}
    if colour:
        rgb = [F.col(c).cast("double") for c in "rgb"]
        v |= {"tint": F.coalesce(rgb[0] + rgb[1] + rgb[2], F.lit(0.0)), "tints": F.coalesce(rgb[0] * rgb[0] + rgb[1] * rgb[1] + rgb[2] * rgb[2], F.lit(0.0))}
    f = {"fs": code, **{c: F.coalesce(F.col(c).cast("long"), F.lit(-(2**63) + 1)) for c in "abc"}}
    rows = packed(key, v=(vertices.where(F.col(key).isNotNull()), v), f=(faces.where(F.col(key).isNotNull()), f)).where(F.size("vs") > 0)

    corner_names, face_names = list(v), list(f)

    def run(b: pa.RecordBatch):
        at, held = Lists(b, *corner_names), Lists(b, *face_names)
        n, slots = b.num_rows, 3 * b.num_rows
        slot, faced = at.row * 3 + at.numpy()[0], held.row * 3 + held.numpy()[0]
        xyz = np.stack(at.numpy()[2:5], axis=1)
        size = np.bincount(slot, minlength=slots)
        order, full = np.argsort(slot, kind="stable"), size > 0
        start = (np.cumsum(size) - size)[full]
        ends = np.full((slots, 6), np.nan)
        for i in range(3):
            for j, least in ((0, np.fmin), (1, np.fmax)):
                ends[full, 2 * i + j] = least.reduceat(xyz[order, i], start)
        out = {}
        area = np.bincount(*_faces(faced, [x.astype(np.int64) for x in held.numpy()[1:]], _Corners(slot, at.numpy()[1], xyz)), minlength=slots) if len(faced) else np.zeros(slots)
        n_faces = np.bincount(faced, minlength=slots)
        if colour:
            with np.errstate(all="ignore"):
                tint, tints = (np.bincount(slot, w, minlength=slots) / (3 * size) for w in at.numpy()[5:])
                std = np.sqrt(np.maximum(0.0, tints - tint * tint))
        for k, s in enumerate(_SIDES):
            here, none = slice(k, slots, 3), ~full[k::3]
            out |= {f"{s}_n_vertices": pa.array(size[here], mask=none)} | {f"{s}_{e}": pa.array(ends[here, i], mask=none | np.isnan(ends[here, i])) for i, e in enumerate(_ENDS)}
            out |= {f"{s}_n_faces": pa.array(n_faces[here], mask=none), f"{s}_area": pa.array(area[here].astype(float), mask=none)}
            if colour:
                out[f"{s}_colour_std"] = pa.array(std[here], mask=none)
        cell = np.stack([_rounded(xyz[:, i], digits).view(np.int64) for i in range(3)], axis=1)
        side = slot % 3
        order = np.lexsort((*cell.T, at.row))
        first = np.flatnonzero(np.append(True, (at.row[order][1:] != at.row[order][:-1]) | (cell[order][1:] != cell[order][:-1]).any(axis=1)))
        before, after = (np.maximum.reduceat((side[order] == k).astype(np.int8), first) for k in (0, 1))
        of = at.row[order][first]
        for name, w in (("differ", before != after), ("nb", before), ("na", after)):
            out[name] = pa.array(np.bincount(of, w, minlength=n).astype(np.int64))
        if components:
            last = faced % 3 == 1
            out["components"] = pa.array(_component_counts(held.row[last], np.stack([x[last] for x in held.numpy()[1:]], axis=1), n, True).astype(np.int32))
        yield rows_of(b, key, np.arange(n), **out)

    kinds = {"n_vertices": "long", **dict.fromkeys(_ENDS, "double"), "n_faces": "long", "area": "double"} | ({"colour_std": "double"} if colour else {})
    schema = [f"{s}_{c} {t}" for s in _SIDES for c, t in kinds.items()] + ["differ long", "nb long", "na long"] + ["components int"] * components
    return by_batches(rows, run, f"{key} {vertices.schema[key].dataType.simpleString()}, " + ", ".join(schema))


def pair_numbers(vertices: DataFrame, faces: DataFrame, key: str = "obj_id", components: bool = False) -> DataFrame:
    """One row for each pair that has vertices on either side, with what ``quality.mesh_metrics`` compares, but for penetration and gaps; closed components of the mesh after if asked for.

    A side without vertices has a box of no extent at no place: ratios over it are 0, its drift counts as none, its overlap as none.
    The edit ratio is that of vertices (rounded) on one side alone over those of the larger side; null where both are empty."""
    wide = _measured_sides(vertices, faces, key, 4, components)
    c = lambda n: F.col(n)

    def product(cs: list[Column]) -> Column:
        return cs[0] * cs[1] * cs[2]

    extent = lambda s: [c(f"{s}_{x}_hi") - c(f"{s}_{x}_lo") for x in XYZ]
    volume = {s: F.coalesce(product(extent(s)), F.lit(0.0)) for s in "ab"}
    # least and greatest pass over nulls, so a side that is not there is asked for first
    shared = product([F.greatest(F.least(c(f"a_{x}_hi"), c(f"b_{x}_hi")) - F.greatest(c(f"a_{x}_lo"), c(f"b_{x}_lo")), F.lit(0.0)) for x in XYZ])
    inter = F.when(c("a_n_vertices").isNotNull() & c("b_n_vertices").isNotNull(), shared).otherwise(F.lit(0.0))
    length = lambda cs: F.sqrt(cs[0] * cs[0] + cs[1] * cs[1] + cs[2] * cs[2])
    drift = length([(c(f"a_{x}_lo") + c(f"a_{x}_hi") - c(f"b_{x}_lo") - c(f"b_{x}_hi")) / 2 for x in XYZ]) / F.greatest(length(extent("b")), F.lit(1e-8))
    zero = lambda n: F.coalesce(c(n), F.lit(0))
    numbers = {
        "volume_ratio": F.coalesce(F.try_divide(volume["a"], volume["b"]), F.lit(0.0)),
        "area_ratio": zero("a_area") / F.when(zero("b_area") > 0, c("b_area")).otherwise(F.lit(1e-8)),
        "part_proportion": F.coalesce(F.try_divide(F.abs(zero("b_n_faces") - zero("a_n_faces")), F.greatest(zero("b_n_faces"), zero("a_n_faces"))), F.lit(0.0)),
        "min_vertices": F.least(zero("b_n_vertices"), zero("a_n_vertices")),
        "min_extent": F.least(*extent("b"), *extent("a")),
        "drift": F.coalesce(drift, F.lit(0.0)),
        "iou": inter / F.greatest(volume["a"] + volume["b"] - inter, F.lit(1e-12)),
    }
    if "r" in vertices.columns:
        numbers["min_colour_std"] = F.least(zero("b_colour_std"), zero("a_colour_std"))
    numbers["edit_ratio"] = F.try_divide("differ", F.greatest("nb", "na"))
    return wide.select(key, *[v.alias(n) for n, v in numbers.items()], *["components"] * components)


def _edges(mesh: np.ndarray, faces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edge of each face side, how many sides each edge has, face of each side); ``mesh`` is the mesh of each face."""
    sides = np.sort(np.concatenate([faces[:, [0, 1]], faces[:, [1, 2]], faces[:, [2, 0]]]), axis=1)
    whole = np.tile(mesh, 3)
    order = np.lexsort((sides[:, 1], sides[:, 0], whole))
    new = np.append(False, (whole[order][1:] != whole[order][:-1]) | (sides[order][1:] != sides[order][:-1]).any(axis=1))
    edge = np.empty(len(order), np.int64)
    edge[order] = np.cumsum(new)
    return edge, np.bincount(edge), np.tile(np.arange(len(faces)), 3)


def _component_counts(mesh: np.ndarray, faces: np.ndarray, n: int, closed: bool) -> np.ndarray:
    """``mesh_components`` of each of ``n`` meshes; ``mesh`` is the mesh of each face."""
    if not len(faces):
        return np.zeros(n, np.int64)
    edge, count, face = _edges(mesh, faces)
    order = np.argsort(edge, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(edge[order]) != 0))
    pairs = first[count[edge[order][first]] == 2]
    label = least_labels(len(faces), face[order[pairs]], face[order[pairs + 1]])
    root = label == np.arange(len(faces))
    if closed:
        open_ = np.zeros(len(faces), bool)
        open_[label[face[count[edge] != 2]]] = True
        root &= (np.bincount(label, minlength=len(faces)) >= 4) & ~open_
    return np.bincount(mesh[root], minlength=n)


def mesh_components(faces: np.ndarray, closed: bool = True) -> int:
    """Components of faces that share an edge no third face has; of closed ones those alone in which every edge has two faces, with at least four faces."""
    return int(_component_counts(np.zeros(len(faces), np.int64), faces, 1, closed)[0])


def component_counts(faces: DataFrame, closed: bool = True, key: str = "obj_id") -> DataFrame:
    """(key, components) of each mesh of ``faces``."""
    kind = faces.schema[key].dataType.simpleString()

    def run(b: pa.RecordBatch):
        f = Lists(b, "a", "b", "c")
        n = _component_counts(f.row, np.stack(f.numpy(np.int64), axis=1), b.num_rows, closed)
        yield rows_of(b, key, np.arange(b.num_rows), components=pa.array(n.astype(np.int32)))

    return by_batches(packed(key, f=(faces, {c: F.col(c) for c in "abc"})), run, f"{key} {kind}, components int")


def is_closed(faces: np.ndarray) -> bool:
    return bool(len(faces)) and bool((_edges(np.zeros(len(faces), np.int64), faces)[1] == 2).all())


def surface_points(vertices: np.ndarray, faces: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Points spread over a surface by area; the same for the same seed."""
    a, b, c = (vertices[faces[:, k]] for k in range(3))
    area = np.linalg.norm(np.cross(b - a, c - a), axis=1)
    if not len(area) or area.sum() <= 0:
        return np.empty((0, 3))
    rng = np.random.default_rng(seed)
    at = np.minimum(np.searchsorted(np.cumsum(area), rng.random(n) * area.sum()), len(area) - 1)
    u, v = rng.random((2, n, 1))
    over = (u + v) > 1
    u, v = np.where(over, 1 - u, u), np.where(over, 1 - v, v)
    return a[at] + u * (b - a)[at] + v * (c - a)[at]


def _far(points: np.ndarray, tri: np.ndarray) -> bool:
    """Whether all faces, each seen at most as the ball around it is, take less than half the sight of any of the points together."""
    mid = (points.min(axis=0) + points.max(axis=0)) / 2
    ball = tri.mean(axis=1)
    radius = np.sqrt(((tri - ball[:, None]) ** 2).sum(axis=2).max(axis=1))
    away = np.sqrt(((ball - mid) ** 2).sum(axis=1)) - np.sqrt(((points - mid) ** 2).sum(axis=1).max())
    return bool((away > radius).all()) and 2 * np.pi * (1 - np.sqrt(1 - (radius / away) ** 2)).sum() < 6


def inside(points: np.ndarray, vertices: np.ndarray, faces: np.ndarray) -> np.ndarray:
    """Which points a closed surface holds: by the solid angle of its faces, in blocks. What the corners of a face share is worked out once for each vertex."""
    total = np.zeros(len(points))
    if len(points) and _far(points, vertices[faces]):
        return np.zeros(len(points), bool)
    for at in range(0, len(faces), 4096):
        used, face = np.unique(faces[at : at + 4096], return_inverse=True)
        corners, face = vertices[used], face.reshape(-1, 3)
        step = max(128, (1 << 15) // len(face))
        for lo in range(0, len(points), step):
            p = points[lo : lo + step]
            r = [corners[:, i, None] - p[None, :, i] for i in range(3)]
            length = np.sqrt(r[0] * r[0] + r[1] * r[1] + r[2] * r[2])
            (ax, bx, cx), (ay, by, cy), (az, bz, cz), (la, lb, lc) = ([x[face[:, k]] for k in range(3)] for x in (*r, length))
            # a point in the plane of a face, with a top of 0, lies on its positive side: no -0.0
            top = 0.0 + ax * (by * cz - bz * cy) + ay * (bz * cx - bx * cz) + az * (bx * cy - by * cx)
            bottom = la * lb * lc + (ax * bx + ay * by + az * bz) * lc + (bx * cx + by * cy + bz * cz) * la + (cx * ax + cy * ay + cz * az) * lb
            total[lo : lo + step] += 2 * np.ascontiguousarray(np.arctan2(top, bottom).T).sum(axis=1)
    return np.abs(total) > 2 * np.pi


def nearest_distances(points: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Distance of each point to the nearest known one. Known points lie sorted along their longest axis and are taken outwards from each point until none can be nearer."""
    if len(known) <= 64:
        best = np.full(len(points), np.inf)
        for k in known:
            best = np.minimum(best, (points[:, 0] - k[0]) ** 2 + (points[:, 1] - k[1]) ** 2 + (points[:, 2] - k[2]) ** 2)
        return np.sqrt(best)
    axis = int(np.argmax(known.max(axis=0) - known.min(axis=0)))
    known = known[np.argsort(known[:, axis], kind="stable")]
    line = known[:, axis]
    best = np.full(len(points), np.inf)
    at = np.searchsorted(line, points[:, axis])
    for step in (-1, 1):
        live, k, width = np.arange(len(points)), at - (step < 0), 16
        while len(live):
            cols = k[live, None] + step * np.arange(width)
            there = (cols >= 0) & (cols < len(known))
            d = np.where(there, ((points[live, None, :] - known[np.clip(cols, 0, len(known) - 1)]) ** 2).sum(axis=2), np.inf)
            best[live] = np.minimum(best[live], d.min(axis=1))
            k[live] += step * width
            on = (k[live] >= 0) & (k[live] < len(known))
            gap = line[np.clip(k[live], 0, len(known) - 1)] - points[live, axis]
            live = live[on & (gap * gap < best[live])]
    return np.sqrt(best)


def fit_numbers(part: DataFrame, body: DataFrame, samples: int = 1000, key: str = "obj_id") -> DataFrame:
    """(key, penetration, gap) of a part against a body, both as rows (key, vertices array<array<double>>, faces array<array<int>>).

    Penetration is the share of the part's surface points inside a closed body, 0 for an open one; the gap is the tenth
    percentile of their distances to the body's nearest vertex, over the body's longest side. Points are drawn from the key's checksum.
    """
    both = part.select(key, F.col("vertices").alias("pv"), F.col("faces").alias("pf")).join(body.select(key, F.col("vertices").alias("bv"), F.col("faces").alias("bf")), key)
    kind = part.schema[key].dataType.simpleString()

    def run(b: pa.RecordBatch):
        arrays = [(lists := b.column(n)).offsets.to_numpy() - lists.offsets[0].as_py() for n in ("pv", "pf", "bv", "bf")]
        flat = [b.column(n).flatten().flatten().to_numpy(zero_copy_only=False).reshape(-1, 3) for n in ("pv", "pf", "bv", "bf")]
        held, gap = np.zeros(b.num_rows), np.zeros(b.num_rows)
        for i, k in enumerate(b.column(key).to_pylist()):
            pv, pf, bv, bf = (x[e[i] : e[i + 1]] for x, e in zip(flat, arrays))
            points = surface_points(pv, pf, samples, zlib.crc32(str(k).encode())) if len(pf) else np.empty((0, 3))
            if not len(points) or not len(bv):
                gap[i] = np.inf if not len(bv) else 0.0
                continue
            side = float((bv.max(axis=0) - bv.min(axis=0)).max())
            held[i] = inside(points, bv, bf).mean() if is_closed(bf) else 0.0
            gap[i] = tenth(nearest_distances(points, bv)) / max(side, 1e-8)
        yield rows_of(b, key, np.arange(b.num_rows), penetration=pa.array(held), gap=pa.array(gap))

    return by_batches(both, run, f"{key} {kind}, penetration double, gap double")


def tenth(d: np.ndarray) -> float:
    """Tenth percentile, between two numbers in proportion, as numpy's, at the cost of a partition."""
    at = (len(d) - 1) * 0.1
    low = int(at)
    high = min(low + 1, len(d) - 1)
    part, t = np.partition(d, [low, high]), at - low
    a, b = float(part[low]), float(part[high])
    return b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t


def mesh_rows(vertices: DataFrame, faces: DataFrame, key: str = "obj_id") -> DataFrame:
    """(key, vertices, faces) as arrays, one row for each mesh: vertices by their numbers, faces with the places of theirs. Faces of unknown vertices go."""
    v = {"v": F.coalesce(F.col("v").cast("long"), F.lit(-(2**63))), **{c: number(c) for c in XYZ}}
    f = {c: F.coalesce(F.col(c).cast("long"), F.lit(-(2**63) + 1)) for c in "abc"}
    rows = packed(key, v=(vertices.where(F.col(key).isNotNull()), v), f=(faces.where(F.col(key).isNotNull()), f)).where(F.size("v") > 0)
    lists = lambda size, inner: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * size.sum() + 1, 3, dtype=np.int32)), pa.array(inner.ravel())))

    corner_names, face_names = list(v), list(f)

    def run(b: pa.RecordBatch):
        at, held = Lists(b, *corner_names), Lists(b, *face_names)
        number_, xyz = at.numpy()[0], np.stack(at.numpy()[1:], axis=1)
        corners = _Corners(at.row, number_, xyz)
        order = np.lexsort((number_, at.row))
        to, there = zip(*[corners.find(held.row, x) for x in held.numpy()])
        # a number that two vertices bear names neither
        good = there[0] & there[1] & there[2] & (corners.times[np.stack(to)] == 1).all(axis=0) if len(corners.times) else np.zeros(len(held.row), bool)
        mesh = held.row[good]
        face = np.stack([corners.at[t[good]] - at.first[mesh] for t in to], axis=1) if len(corners.at) else np.empty((0, 3), np.int64)
        by = np.lexsort((*face.T[::-1], mesh))
        yield rows_of(b, key, np.arange(b.num_rows), vertices=lists(at.size, xyz[order]), faces=lists(np.bincount(mesh, minlength=b.num_rows), face[by].astype(np.int32)))

    return by_batches(rows, run, f"{key} {vertices.schema[key].dataType.simpleString()}, vertices array<array<double>>, faces array<array<int>>")


def scale_ratio(new: DataFrame, old: DataFrame, key: str = "obj_id") -> DataFrame:
    """(key, scale_ratio): the longer of the longest sides of two sets of vertices over the shorter; 999 where one has none."""
    side = lambda df, n: mesh_boxes(df, key).select(key, F.greatest(*[F.col(f"{c}_hi") - F.col(f"{c}_lo") for c in XYZ]).alias(n))
    both = side(new, "n").join(side(old, "o"), key, "full")
    return both.select(key, F.when((F.col("n") > 0) & (F.col("o") > 0), F.greatest("n", "o") / F.least("n", "o")).otherwise(F.lit(999.0)).alias("scale_ratio"))


def mesh_verdicts(vertices: DataFrame, faces: DataFrame, key: str = "obj_id") -> DataFrame:
    """(key, score, passed, reason): every check of a pair of meshes, with the first that fails. A mesh after without closed components has none."""
    m = pair_numbers(vertices, faces, key, components=True).withColumn("m", mesh_metrics())
    return m.select(key, weighted_score(F.col("m")).alias("score"), all_passed(F.col("m")).alias("passed"), F.coalesce(first_failure(F.col("m")), F.lit("")).alias("reason"))


# --- assembly -------------------------------------------------------------------------------


def _shifted(vertices: DataFrame, faces: DataFrame, after: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Vertex numbers of a second mesh moved past those of ``after``."""
    n = after.groupBy(key).agg((F.max("v") + 1).alias("__n"))
    move = lambda df, *cs: df.join(n, key, "left").withColumns({c: F.col(c) + F.coalesce("__n", F.lit(0)) for c in cs}).drop("__n")
    return move(vertices, "v"), move(faces, "a", "b", "c")


def without_parts(faces: DataFrame, parts: DataFrame, key: str = "obj_id") -> DataFrame:
    """A deletion: the faces of the other parts. (An addition is the whole mesh after what a deletion leaves.)"""
    return faces.join(parts.select(key, "part").distinct(), [key, "part"], "left_anti")


def moved_to(vertices: DataFrame, target: DataFrame, key: str = "obj_id", limit: float | None = None) -> DataFrame:
    """Vertices scaled evenly, so that their box fits into the target's, about its centre. ``limit`` instead bounds the longest side to that share of the target's longest, and never enlarges."""
    one, two = mesh_boxes(vertices, key), mesh_boxes(target, key)
    mid = lambda c: ((F.col(f"{c}_lo") + F.col(f"{c}_hi")) / 2)
    side = lambda c: F.col(f"{c}_hi") - F.col(f"{c}_lo")
    s = one.select(key, *[mid(c).alias(f"s{c}") for c in XYZ], *[side(c).alias(f"d{c}") for c in XYZ])
    t = two.select(key, *[mid(c).alias(f"t{c}") for c in XYZ], *[side(c).alias(f"e{c}") for c in XYZ])
    if limit is None:
        scale = F.least(*[F.col(f"e{c}") / (F.col(f"d{c}") + F.lit(1e-8)) for c in XYZ])
    else:
        scale = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.lit(limit) * F.greatest(*[F.col(f"e{c}") for c in XYZ]), F.greatest(*[F.col(f"d{c}") for c in XYZ])), F.lit(1.0)))
    fit = s.join(t, key).withColumn("__s", scale)
    return vertices.join(fit, key).select(*[c for c in vertices.columns if c not in XYZ], *[((F.col(c) - F.col(f"s{c}")) * F.col("__s") + F.col(f"t{c}")).alias(c) for c in XYZ])


def swapped(vertices: DataFrame, faces: DataFrame, old: DataFrame, new_vertices: DataFrame, new_faces: DataFrame, key: str = "obj_id") -> tuple[DataFrame, DataFrame]:
    """A swap: the faces of the ``old`` parts go, and a new part, fitted into their box, comes after the vertices that were there. Where no old part is, no new one comes."""
    corners = faces.join(old.select(key, "part").distinct(), [key, "part"], "left_semi").select(key, F.explode(F.array("a", "b", "c")).alias("v")).distinct()
    place = vertices.join(corners, [key, "v"], "left_semi")
    fitted = moved_to(new_vertices, place, key)
    v, f = _shifted(fitted, new_faces.join(fitted.select(key).distinct(), key, "left_semi"), vertices, key)
    names, sides = [key, "v", *XYZ], [key, "part", "a", "b", "c"]
    return vertices.select(*names).unionByName(v.select(*names)), without_parts(faces, old, key).select(*sides).unionByName(f.select(*sides))


def grafted(vertices: DataFrame, faces: DataFrame, new_vertices: DataFrame, new_faces: DataFrame, share: float = 0.4, key: str = "obj_id") -> tuple[DataFrame, DataFrame]:
    """A graft: nothing goes; the donor's part, at most ``share`` of the longest side, stands centred on top of the mesh (along z)."""
    part = moved_to(new_vertices, vertices, key, limit=share)
    top = mesh_boxes(vertices, key).select(key, F.col("z_hi").alias("__top"))
    foot = mesh_boxes(part, key).select(key, F.col("z_lo").alias("__foot"))
    part = part.join(top.join(foot, key), key).withColumn("z", F.col("z") + F.col("__top") - F.col("__foot")).drop("__top", "__foot")
    v, f = _shifted(part, new_faces.join(part.select(key).distinct(), key, "left_semi"), vertices, key)
    names, sides = [key, "v", *XYZ], [key, "part", "a", "b", "c"]
    return vertices.select(*names).unionByName(v.select(*names)), faces.select(*sides).unionByName(f.select(*sides))
