"""Many small objects and a few large ones, held against one object at a time."""

import numpy as np

from quarrykit.operators import geometry as G
from quarrykit.operators import meshes as M
from quarrykit.operators import voxels as VX


def cells(spark, rng, sizes, grid=64):
    made = {f"o{i}": rng.integers(0, grid, (n, 3)) for i, n in enumerate(sizes)}
    return made, spark.createDataFrame([(k, *map(int, c)) for k, cs in made.items() for c in cs], "obj_id string, x int, y int, z int")


def grouped(df) -> bool:
    """Whether Python is called once for each object."""
    return "InPandas" in df._jdf.queryExecution().optimizedPlan().toString()


def test_components_of_many_objects(spark):
    made, df = cells(spark, np.random.default_rng(1), [*range(1, 40)] * 5 + [3000], 12)
    got = VX.components(df)
    assert not grouped(got)
    want = {r.obj_id: r.components for r in VX.components_by_labels(df).collect()}
    assert {r.obj_id: r.components for r in got.collect()} == want and len(want) == len(made)


def test_nearest_labels_of_many_objects(spark):
    rng = np.random.default_rng(2)
    a, unknown = cells(spark, rng, [*range(1, 30)] * 3 + [400], 9)
    b, _ = cells(spark, rng, [*range(1, 30)] * 2 + [0] * 29 + [300], 9)
    name = lambda c: [None, "down", "up"][c[0] * 7 % 3]
    labelled = spark.createDataFrame([(k, *map(int, c), name(c)) for k, cs in b.items() for c in cs], "obj_id string, x int, y int, z int, label string")
    found = VX.nearest_labels(unknown, labelled)
    assert not grouped(found)
    want = []
    for k, cs in a.items():
        for c in cs:
            best = min(b[k], key=lambda o: (((o - c) ** 2).sum(), *o)) if len(b[k]) else None
            want.append((k, *map(int, c), None if best is None else name(best)))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_voted_regions_of_many_objects(spark):
    made, df = cells(spark, np.random.default_rng(3), [1, 2, 3, 5, 8, 9, 12] * 8 + [60], 10)
    outside = spark.createDataFrame([("far", 70, -1, 3)], df.schema)  # nothing of it is edited, so its place does not matter
    got = VX.voted_region(df.unionByName(outside), df.where("x < 4"), pad=1, k=8, grid=12)
    assert not grouped(got)
    want = set()
    for k, cs in made.items():
        box, distinct = cs[cs[:, 0] < 4], np.unique(cs, axis=0)
        if len(box):
            lo, hi = np.maximum(box.min(axis=0) - 1, 0), np.minimum(box.max(axis=0) + 1, 11)
            for c in np.stack(np.meshgrid(*[np.arange(p, q + 1) for p, q in zip(lo, hi)], indexing="ij"), -1).reshape(-1, 3):
                if not (distinct == c).all(axis=1).any():
                    near = sorted(distinct.tolist(), key=lambda o: (((o - c) ** 2).sum(), *o))[:8]
                    if 2 * sum(o[0] < 4 for o in near) > len(near):
                        want.add((k, *map(int, c)))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 500


def test_gaps_of_many_objects(spark):
    rng = np.random.default_rng(4)
    a, part = cells(spark, rng, [*range(1, 30)] * 3 + [400], 9)
    b, body = cells(spark, rng, [*range(1, 30)] * 2 + [0] * 29 + [300], 9)
    got = G.gap_distance(part, body)
    assert not grouped(got)
    want = {k: float(np.percentile(np.sqrt(((np.unique(p, axis=0)[:, None] - b[k][None]) ** 2).sum(axis=2)).min(axis=1), 10)) for k, p in a.items() if len(b[k])}
    assert {r.obj_id: r.gap for r in got.collect()} == want


def tetrahedra(spark, rng, n, most=9):
    """``n`` meshes of up to ``most`` tetrahedra on a coarse grid, some without their last face, before and after."""
    v, f = [], []
    for i in range(n):
        for side in ("before", "after"):
            for t in range(int(rng.integers(0 if side == "after" else 1, most))):
                at = rng.integers(0, 3, 3)
                corners = [at, at + [1, 0, 0], at + [0, 1, 0], at + [0, 0, 1]]
                v += [(f"o{i}", side, 4 * t + k, *map(float, c), int(rng.integers(256)), 7, t) for k, c in enumerate(corners)]
                f += [(f"o{i}", side, *(4 * t + k for k in face)) for face in [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)][: int(rng.integers(3, 5))]]
    return spark.createDataFrame(v, "obj_id string, side string, v int, x double, y double, z double, r int, g int, b int"), spark.createDataFrame(f, "obj_id string, side string, a int, b int, c int")


def test_numbers_of_meshes_move_them_once(spark):
    v, f = tetrahedra(spark, np.random.default_rng(7), 40)
    got = M.pair_numbers(v, f)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    rows = {r.obj_id: r for r in got.collect()}
    sides = lambda df: {k: [r for r in df.collect() if (r.obj_id, r.side) == k] for k in {(r.obj_id, r.side) for r in df.select("obj_id", "side").distinct().collect()}}
    vs, fs = sides(v), sides(f)
    for k, r in rows.items():
        area, cells, std = {}, {}, {}
        for s in ("before", "after"):
            at = {p.v: np.array([p.x, p.y, p.z]) for p in vs.get((k, s), [])}
            area[s] = sum(np.linalg.norm(np.cross(at[q.b] - at[q.a], at[q.c] - at[q.a])) / 2 for q in fs.get((k, s), []))
            cells[s] = {tuple(p) for p in at.values()}
            std[s] = float(np.std([[p.r, p.g, p.b] for p in vs.get((k, s), [])])) if at else 0
        assert abs(r.area_ratio - area["after"] / area["before"]) < 1e-9 and abs(r.min_colour_std - min(std.values())) < 1e-6
        assert abs(r.edit_ratio - len(cells["before"] ^ cells["after"]) / max(map(len, cells.values()))) < 1e-12
        assert r.min_vertices == min(len(vs.get((k, s), [])) for s in ("before", "after"))


def test_rounding_in_batches_is_that_of_columns(spark):
    x = [0.00005, 0.00015, 1.00005, -0.00005, 2.5, 1e300, float("nan"), 0.1 + 0.2, 12345.67885, -7.00025, 1.1 * 3, float("inf"), 5e15 + 0.5]
    from pyspark.sql import functions as F

    want = [r.y for r in spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, x double").orderBy("i").select((F.bround("x", 4) + F.lit(0.0)).alias("y")).collect()]
    assert list(map(str, M._rounded(np.array(x), 4).tolist())) == list(map(str, want))


def test_open_components_of_many_meshes(spark):
    _, f = tetrahedra(spark, np.random.default_rng(5), 60)
    after = f.where("side = 'after'")
    got = M.component_counts(after, closed=False)
    assert not grouped(got)
    want = {r.obj_id: r.n for r in after.selectExpr("obj_id", "a div 4 as t").distinct().groupBy("obj_id").count().withColumnRenamed("count", "n").collect()}
    assert {r.obj_id: r.components for r in got.collect()} == want


def test_closed_components_of_many_meshes(spark):
    _, f = tetrahedra(spark, np.random.default_rng(6), 60)
    got = M.component_counts(f)
    assert not grouped(got)
    n = f.selectExpr("obj_id", "side", "a div 4 as t").groupBy("obj_id", "side", "t").count().collect()
    doubled = {}
    for r in n:
        doubled.setdefault((r.obj_id, r.t), []).append(r["count"])
    # of both sides together only a tetrahedron that stands on one side is closed: on two its edges have more faces
    want = {k: sum(counts == [4] for (o, _), counts in doubled.items() if o == k) for k in {o for o, _ in doubled}}
    assert {r.obj_id: r.components for r in got.collect()} == want


def test_verdicts_of_meshes_move_them_once(spark):
    v, f = tetrahedra(spark, np.random.default_rng(8), 40)
    got = M.mesh_verdicts(v, f)
    assert not grouped(got) and got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    n = {r.obj_id: r.components for r in M.component_counts(f.where("side = 'after'")).collect()}
    assert {r.obj_id: r.components for r in M.pair_numbers(v, f, components=True).collect()} == {r.obj_id: n.get(r.obj_id, 0) for r in v.select("obj_id").distinct().collect()}


def test_points_inside_by_the_angle_of_each_face(spark):
    rng = np.random.default_rng(9)

    def plainly(points, tri):
        total = np.zeros(len(points))
        a, b, c = (tri[None, :, k] - points[:, None] for k in range(3))
        la, lb, lc = (np.linalg.norm(x, axis=2) for x in (a, b, c))
        top = (a * np.cross(b, c)).sum(axis=2)
        total = 2 * np.arctan2(top, la * lb * lc + (a * b).sum(axis=2) * lc + (b * c).sum(axis=2) * la + (c * a).sum(axis=2) * lb).sum(axis=1)
        return np.abs(total) > 2 * np.pi

    faces, far = np.array([(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)]), 0
    for i in range(60):
        at = rng.integers(0, 3, 3)
        body = np.array([at, at + [2, 0, 0], at + [0, 2, 0], at + [0, 0, 2]], float)
        points = np.concatenate([rng.random((40, 3)) * 3, rng.integers(0, 4, (20, 3))]) + (i % 4) * 1.5  # some in the planes of faces
        assert (M.inside(points, body, faces) == plainly(points, body[faces])).all()
        far += M._far(points, body[faces])
    assert 0 < far < 60
    d = rng.random(1000)
    assert M.tenth(d) == np.percentile(d, 10) and M.tenth(d[:1]) == d[0]


def test_mesh_rows_move_a_mesh_once(spark):
    v, f = tetrahedra(spark, np.random.default_rng(10), 20)
    v, f = v.where("side = 'before' and v <> 5"), f.where("side = 'before'")
    got = M.mesh_rows(v, f)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    for r in got.collect():
        mine = sorted((p.v, p.x, p.y, p.z) for p in v.where(f"obj_id = '{r.obj_id}'").collect())
        place = {p[0]: i for i, p in enumerate(mine)}
        assert [list(p[1:]) for p in mine] == r.vertices
        assert sorted([place[q.a], place[q.b], place[q.c]] for q in f.where(f"obj_id = '{r.obj_id}'").collect() if {q.a, q.b, q.c} <= set(place)) == r.faces
