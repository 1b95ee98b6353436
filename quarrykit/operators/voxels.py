"""Sparse voxel sets: algebra, boxes, components, nearest neighbours, masks.

Set work is joins and aggregates on (object, x, y, z). Work that needs an object's whole grid
(at most 64^3 cells) is one Arrow-grouped call for each object.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrykit.operators.batched import Lists, blocks, by_batches, packed, ranges, rows_of

XYZ = ["x", "y", "z"]


def set_sizes(a: DataFrame, b: DataFrame, key: str = "obj_id") -> DataFrame:
    """(key, only_a, only_b, common) over the distinct cells of two sides."""
    both = a.select(key, *XYZ, F.lit(True).alias("a")).unionByName(b.select(key, *XYZ, F.lit(False).alias("a")))
    nowhere = F.when(reduce(or_, [F.col(c).isNull() for c in (key, *XYZ)]), F.col("a"))  # what is null is equal to nothing on the other side
    cells = both.groupBy(key, *XYZ, nowhere.alias("nowhere")).agg(F.max("a").alias("a"), F.max(~F.col("a")).alias("b"))
    return cells.groupBy(key).agg(F.count_if(~F.col("b")).alias("only_a"), F.count_if(~F.col("a")).alias("only_b"), F.count_if(F.col("a") & F.col("b")).alias("common"))


def locality(sizes: DataFrame) -> DataFrame:
    """Symmetric difference over union, 0 for two empty sets."""
    union = F.col("only_a") + F.col("only_b") + F.col("common")
    return sizes.withColumn("locality", F.when(union == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("only_a") + F.col("only_b"), union.cast("double"))))


def union(a: DataFrame, b: DataFrame, key: str = "obj_id") -> DataFrame:
    return a.select(key, *XYZ).unionByName(b.select(key, *XYZ)).distinct()


def minus(a: DataFrame, b: DataFrame, key: str = "obj_id") -> DataFrame:
    """Cells of ``a`` outside ``b``: and-not of masks, and deletion of a mask's voxels."""
    return a.join(b.select(key, *XYZ).distinct(), [key, *XYZ], "left_anti")


def boxes(v: DataFrame, key: str = "obj_id") -> DataFrame:
    """Minimum, maximum, centre and diagonal of each object's cells."""
    made = v.groupBy(key).agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{name}") for c in XYZ for f, name in ((F.min, "lo"), (F.max, "hi"))])
    side = [F.col(f"{c}_hi") - F.col(f"{c}_lo") for c in XYZ]
    return made.select("*", *[((F.col(f"{c}_lo") + F.col(f"{c}_hi")) / 2).alias(f"{c}_mid") for c in XYZ], F.sqrt(sum((s * s for s in side), F.lit(0))).alias("diagonal"))


def unique_cells(v: DataFrame, key: str = "obj_id") -> DataFrame:
    return v.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(*XYZ).alias("n_unique"))


def vertex_difference(a: DataFrame, b: DataFrame, key: str = "obj_id", digits: int = 4) -> DataFrame:
    """Symmetric difference of rounded vertex sets over the larger set."""
    near = lambda d: d.select(key, *[F.bround(c, digits).alias(c) for c in XYZ])
    s = set_sizes(near(a), near(b), key)
    larger = F.greatest(F.col("only_a"), F.col("only_b")) + F.col("common")
    return s.select(key, F.try_divide(F.col("only_a") + F.col("only_b"), larger.cast("double")).alias("difference"))


def coverage(rows: DataFrame, eps: float, key: str = "obj_id") -> DataFrame:
    """Share of rows, paired by place, whose features moved more than ``eps``."""
    return rows.groupBy(key).agg(F.avg(F.when(F.col("l2") > eps, 1.0).otherwise(0.0)).alias("coverage"))


def voxelised(vertices: DataFrame, key: str = "obj_id", grid: int = 64) -> DataFrame:
    cell = lambda c: F.greatest(F.lit(0), F.least(F.lit(grid - 1), F.floor((F.col(c) + 0.5) * grid).cast("int"))).alias(c)
    return vertices.select(key, *map(cell, XYZ)).distinct()


_STEPS = [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)]


def dilated(mask: DataFrame, occupied: DataFrame, radius: int, key: str = "obj_id") -> DataFrame:
    """The mask grown over six neighbours ``radius`` times, on occupied cells."""
    steps = F.array(*[F.struct(*[F.lit(v).alias(f"d{c}") for v, c in zip(s, XYZ)]) for s in [(0, 0, 0), *_STEPS]])
    cells = occupied.select(key, *XYZ).distinct()
    now = mask.select(key, *XYZ).distinct()
    for _ in range(radius):
        now = now.select(key, *XYZ, F.explode(steps).alias("s")).select(key, *[(F.col(c) + F.col(f"s.d{c}")).alias(c) for c in XYZ]).distinct()
    return now.join(cells, [key, *XYZ], "left_semi")


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of the component of each of ``n`` nodes, joined by edges (a, b): labels spread over edges and to what they point at."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        to = root.copy()
        np.minimum.at(to, root[a], low)
        np.minimum.at(to, root[b], low)
        to = to[to]
        if (to == root).all():
            return root
        root = to


def _component_counts(row: np.ndarray, grid: np.ndarray, n: int) -> np.ndarray:
    """Components of the cells of each of ``n`` objects; ``row`` is the object of each cell."""
    codes = np.unique(row * 262144 + np.clip(grid, 0, 63) @ np.array([4096, 64, 1]))
    m, ends = len(codes), []
    for step, edge in ((1, 64), (64, 4096), (4096, 262144)):
        to = np.searchsorted(codes, codes + step)
        joined = (to < m) & (codes[np.minimum(to, m - 1)] == codes + step) & ((codes % edge) // step != 63)
        ends.append((np.flatnonzero(joined), to[joined]))
    root = least_labels(m, *(np.concatenate(e) for e in zip(*ends)))
    return np.bincount(codes[root == np.arange(m)] // 262144, minlength=n)


def components(v: DataFrame, key: str = "obj_id") -> DataFrame:
    """Six-connected components of each object's cells, clipped to the 64^3 grid."""
    kind = v.schema[key].dataType.simpleString()

    def run(b: pa.RecordBatch):
        cells = Lists(b, *XYZ)
        n = _component_counts(cells.row, np.stack(cells.numpy(np.int64), axis=1), b.num_rows)
        yield rows_of(b, key, np.arange(b.num_rows), components=pa.array(n.astype(np.int32)))

    return by_batches(packed(key, cells=(v, {c: F.col(c) for c in XYZ})), run, f"{key} {kind}, components int")


def components_by_labels(v: DataFrame, key: str = "obj_id") -> DataFrame:
    """The same without Python: the least label spreads over neighbours until nothing changes. Each round is written."""
    from quarrykit.sharedfs import cut

    cell = [F.greatest(F.lit(0), F.least(F.lit(63), F.col(c))).cast("int").alias(c) for c in XYZ]
    now = cut(v.select(key, *cell).distinct().withColumn("label", F.col("x") * 4096 + F.col("y") * 64 + F.col("z")), "labels")
    steps = F.array(*[F.struct(*[F.lit(d).alias(f"d{c}") for d, c in zip(s, XYZ)]) for s in [(0, 0, 0), *_STEPS]])
    before = None
    while True:
        total = now.agg(F.sum("label")).first()[0]
        if total == before:
            return now.groupBy(key).agg(F.count_distinct("label").cast("int").alias("components"))
        before = total
        told = now.select(key, *XYZ, "label", F.explode(steps).alias("s")).select(key, *[(F.col(c) + F.col(f"s.d{c}")).alias(c) for c in XYZ], "label")
        least = told.groupBy(key, *XYZ).agg(F.min("label").alias("label"))
        now = cut(now.select(key, *XYZ).join(least, [key, *XYZ]), "labels")


def _nearest(points: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Row number of the nearest ``known`` (sorted by x, y, z) of each point; of equal distances the first. In blocks of some million distances."""
    out, block = [np.empty(0, np.int64)], max(1, (1 << 22) // len(known))
    for lo in range(0, len(points), block):
        d = 0.0
        for c in range(3):
            d = d + (points[lo : lo + block, c, None] - known[None, :, c]) ** 2
        out.append(d.argmin(axis=1))
    return np.concatenate(out)


#: Pairs of one object up to which objects are worked on side by side, and pairs of such a block.
_FEW, _BLOCK = 1 << 14, 1 << 20


def few_pairs(points: Lists, known: Lists):
    """Blocks of objects with few pairs: (place of a point, place of a known one) of all pairs, and where each point's pairs begin.

    Objects that lack one of the two have no pairs. Then come the objects with many, as (None, row)."""
    cost = points.size * known.size
    few = np.flatnonzero((cost > 0) & (cost <= _FEW))
    for s in blocks(cost[few], _BLOCK):
        at = few[s]
        left = ranges(points.first[at], points.size[at])
        each = np.repeat(known.size[at], points.size[at])
        yield (left, np.repeat(left, each), ranges(np.repeat(known.first[at], points.size[at]), each), np.concatenate([[0], np.cumsum(each)[:-1]])), None
    for row in np.flatnonzero(cost > _FEW):
        yield None, row


def span(lists: Lists, row: int) -> slice:
    return slice(int(lists.first[row]), int(lists.first[row] + lists.size[row]))


def _ranks(texts: pa.Array) -> np.ndarray:
    """Places of texts in their order, nulls last."""
    coded = texts.dictionary_encode()
    place = np.empty(len(coded.dictionary) + 1, np.int64)
    place[np.argsort(np.array(coded.dictionary.to_pylist(), dtype=object), kind="stable")] = np.arange(len(coded.dictionary))
    place[-1] = len(coded.dictionary)
    return place[coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)]


def nearest_labels(unknown: DataFrame, known: DataFrame, key: str = "obj_id") -> DataFrame:
    """(key, x, y, z, label) of each unlabelled cell, from the nearest labelled one of the object; ties go to the least (x, y, z)."""
    kind = unknown.schema[key].dataType.simpleString()
    right = [f"k{c}" for c in XYZ]

    def run(b: pa.RecordBatch):
        u, k = Lists(b, *XYZ), Lists(b, *right, "label")
        cells, there = np.stack([v.to_numpy(zero_copy_only=False) for v in u.values], axis=1).astype(float), np.stack([v.to_numpy(zero_copy_only=False) for v in k.values[:3]], axis=1).astype(float)
        label = k.values[3].field("label")
        # equal cells by label, absent ones last, as their order decides between them
        order = np.lexsort((_ranks(label), *there.T[::-1], k.row))
        there, label = there[order], label.take(pa.array(order))
        won = np.full(len(cells), -1, np.int64)
        for pairs, row in few_pairs(u, k):
            if pairs is None:
                at = span(k, row)
                won[span(u, row)] = at.start + _nearest(cells[span(u, row)], there[at])
            else:
                left, i, j, begin = pairs
                d = ((cells[i] - there[j]) ** 2).sum(axis=1)
                least = np.repeat(np.minimum.reduceat(d, begin), np.diff(np.append(begin, len(d))))
                won[left] = np.minimum.reduceat(np.where(d == least, j, len(there)), begin)
        found = label.take(pa.array(np.where(won < 0, 0, won), mask=won < 0))
        yield rows_of(b, key, u.row, **dict(zip(XYZ, u.values)), label=found)

    types = ", ".join(f"{c} {unknown.schema[c].dataType.simpleString()}" for c in XYZ)
    # a label may be absent, and a list holds no nulls: each stands in a struct
    both = packed(key, u=(unknown, {c: F.col(c) for c in XYZ}), k=(known, {**{f"k{c}": F.col(c) for c in XYZ}, "label": F.struct(F.col("label").cast("string").alias("label"))}))
    return by_batches(both, run, f"{key} {kind}, {types}, label string")


@lru_cache(1)
def _outwards(grid: int) -> np.ndarray:
    """Numbers of the steps from a cell to all others of the grid, the shortest first, equal ones by x, y and z."""
    by = np.arange(2 * grid - 1) - (grid - 1)
    return np.argsort((by[:, None, None] ** 2 + by[None, :, None] ** 2 + by[None, None, :] ** 2).ravel(), kind="stable")


def _votes(near: np.ndarray, cells: np.ndarray, flags: np.ndarray, k: int, grid: int) -> np.ndarray:
    """How many of the k nearest ``cells`` (of equal distances the least) of each ``near`` cell are flagged. Places around a cell are looked up
    from the nearest outwards, for all cells side by side, so the cost is that of the balls which hold k cells."""
    side, order = 2 * grid - 1, _outwards(grid)
    kinds = np.zeros((grid,) * 3, np.int8)
    kinds[tuple(cells.T)] = 1 + flags.astype(np.int8)
    left, won = np.full(len(near), k), np.zeros(len(near), np.int64)
    live, at, width = np.arange(len(near)), 0, 64
    while len(live):
        step = np.stack(np.unravel_index(order[at : at + width], (side,) * 3), axis=1) - (grid - 1)
        going = []
        for part in np.array_split(live, -(-len(live) * len(step) // (1 << 22))):
            to = near[part, None, :] + step[None]
            there = ((to >= 0) & (to < grid)).all(axis=2)
            kind = np.where(there, kinds[tuple(np.clip(to, 0, grid - 1).transpose(2, 0, 1))], 0)
            met = np.cumsum(kind > 0, axis=1)
            won[part] += ((kind == 2) & (met <= left[part, None])).sum(axis=1)
            left[part] -= np.minimum(met[:, -1], left[part])
            going.append(part[left[part] > 0])
        live, at, width = np.concatenate(going), at + width, min(2 * width, 4096)
    return won


def _votes_of_few(near: np.ndarray, cells: np.ndarray, flags: np.ndarray, k: int) -> np.ndarray:
    """The same by all distances, in blocks of some million: cheaper where an object has few cells, which lie far apart."""
    n, won, block = len(cells), [np.empty(0, np.int64)], max(1, (1 << 21) // len(cells))
    for lo in range(0, len(near), block):
        rank = np.zeros((len(near[lo : lo + block]), n), np.int64)
        for c in range(3):
            rank += (near[lo : lo + block, c, None] - cells[None, :, c]) ** 2
        rank = rank * n + np.arange(n)
        last = np.partition(rank, k - 1, axis=1)[:, k - 1 : k]
        won.append(((rank <= last) & flags).sum(axis=1))
    return np.concatenate(won)


def _voted(occ: np.ndarray, box: np.ndarray, pad: int, k: int, grid: int) -> np.ndarray:
    cells = np.unique(occ, axis=0)
    code = lambda c: (c[:, 0] * grid + c[:, 1]) * grid + c[:, 2]
    flags = np.isin(code(cells), code(box))
    if len(cells) <= k and 2 * flags.sum() <= len(cells):  # all vote on each cell
        return cells[:0]
    lo, hi = np.maximum(box.min(axis=0) - pad, 0), np.minimum(box.max(axis=0) + pad, grid - 1)
    near = np.stack(np.meshgrid(*[np.arange(a, b + 1) for a, b in zip(lo, hi)], indexing="ij"), axis=-1).reshape(-1, 3)
    near = near[~np.isin(code(near), code(cells))]
    if len(cells) <= k:
        return near
    votes = _votes_of_few(near, cells, flags, k) if len(cells) <= 4096 else _votes(near, cells, flags, k, grid)
    return near[2 * votes > k]


def _voted_by_all(cells: np.ndarray, occ: Lists, box: np.ndarray, ed: Lists, rows: np.ndarray, pad: int, grid: int):
    """(row, cell) of ``rows`` with so few cells that all of them vote on each empty one: their whole region or none of it. In blocks of some 100,000 cells."""
    code = lambda row, c: ((row * grid + c[:, 0]) * grid + c[:, 1]) * grid + c[:, 2]
    here = np.zeros(len(occ.size), bool)
    here[rows] = True  # cells of other objects may lie outside the grid
    held = np.unique(code(occ.row, cells)[here[occ.row]])
    flags = np.isin(held, np.unique(code(ed.row, box)[here[ed.row]]))
    cube = grid**3
    n, edited = np.bincount(held // cube, minlength=len(occ.size)), np.bincount(held[flags] // cube, minlength=len(occ.size))
    rows = rows[2 * edited[rows] > n[rows]]
    if not len(rows):
        return
    lo, hi = (f.reduceat(box, ed.first[ed.size > 0], axis=0) for f in (np.minimum, np.maximum))
    place = np.cumsum(ed.size > 0) - 1
    lo, hi = np.maximum(lo[place[rows]] - pad, 0), np.minimum(hi[place[rows]] + pad, grid - 1)
    side = hi - lo + 1
    for s in blocks(side.prod(axis=1), 1 << 17):
        size = side[s].prod(axis=1)
        which, at = np.repeat(np.arange(len(size)), size), ranges(np.zeros(len(size), np.int64), size)
        step = np.repeat(side[s, 2], size)
        plane = np.repeat(side[s, 1] * side[s, 2], size)
        near = lo[s][which] + np.stack([at // plane, at % plane // step, at % step], axis=1)
        row = rows[s][which]
        codes = code(row, near)
        to = np.minimum(np.searchsorted(held, codes), len(held) - 1)
        empty = held[to] != codes
        yield row[empty], near[empty]


def voted_region(occupied: DataFrame, edited: DataFrame, key: str = "obj_id", pad: int = 3, k: int = 100, grid: int = 64) -> DataFrame:
    """Empty cells near the edited ones (their box and ``pad``) join where over half of the k nearest occupied cells are edited; of equal distances
    the least cells count. Cells are on the grid; others raise."""
    kind = occupied.schema[key].dataType.simpleString()
    right = [f"e{c}" for c in XYZ]

    def run(b: pa.RecordBatch):
        occ, ed = Lists(b, *XYZ), Lists(b, *right)
        cells, box = np.stack(occ.numpy(np.int64), axis=1), np.stack(ed.numpy(np.int64), axis=1)
        both = np.flatnonzero((occ.size > 0) & (ed.size > 0))
        if len(both) and any((c[np.isin(l.row, both)] < 0).any() or (c[np.isin(l.row, both)] >= grid).any() for l, c in ((occ, cells), (ed, box))):
            raise ValueError(f"cells outside the grid of {grid}")
        few = occ.size[both] <= k
        for at, near in _voted_by_all(cells, occ, box, ed, both[few], pad, grid):
            yield rows_of(b, key, at, **{c: pa.array(near[:, i].astype(np.int32)) for i, c in enumerate(XYZ)})
        for row in both[~few]:
            won = _voted(cells[span(occ, row)], box[span(ed, row)], pad, k, grid).astype(np.int32)
            yield rows_of(b, key, np.full(len(won), row), **{c: pa.array(won[:, i]) for i, c in enumerate(XYZ)})

    both = packed(key, o=(occupied, {c: F.col(c) for c in XYZ}), e=(edited, {f"e{c}": F.col(c) for c in XYZ}))
    return by_batches(both, run, f"{key} {kind}, x int, y int, z int")


def mask_kind(edit_type, share, scale_threshold: float | None = None):
    """Which mask an edit gets: a modification of more than 0.35 of the object is handled as global, a scale only where that is switched on."""
    from quarrykit.functions.domain import effective_type

    kind = effective_type(edit_type)
    limit = 0.35
    promoted = (kind == "Modification") & (share > limit)
    if scale_threshold is not None:
        promoted = promoted | ((kind == "Scale") & (share > max(limit, scale_threshold)))
    return F.when(promoted | (kind == "Global"), "full").when(kind.isin("Material", "Deletion"), "part").otherwise("region")
