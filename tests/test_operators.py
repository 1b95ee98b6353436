"""Hand-computed cases of operators whose results no SQL of the test tables pins."""

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrykit.functions import domain as D
from quarrykit.functions import text as X
from quarrykit.operators import geometry as G
from quarrykit.operators import json_text as J
from quarrykit.operators import keyed_logs as K
from quarrykit.operators import labels as L
from quarrykit.operators import pairing as P
from quarrykit.operators import quality as Q
from quarrykit.operators import selection as S
from quarrykit.operators import voxels as VX
from quarrykit.operators.planner import instructions, plan


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_reconcile(spark, tmp_path):
    from quarrykit.sources import logs

    main, worker = tmp_path / "edit_results_t.jsonl", tmp_path / "edit_results_t_gpu0.jsonl"
    main.write_text('{"edit_id": "e1", "status": "success"}\n\n{"edit_id": "e2", "status": "success"}\n')
    worker.write_text('{"edit_id": "e1", "status": "failed"}\n{bad json}\n{"status": "success"}\n{"edit_id": "e3", "status": "success"}\n{"edit_id": "x999", "status": "success"}\n5\n')
    (tmp_path / "edit_results_t_nongpu.jsonl").write_text("")
    (tmp_path / "edit_results_t_w1.jsonl").write_text("")
    found = logs.worker_files(str(tmp_path), "t")
    assert [p.rsplit("_", 1)[1] for p in found] == ["gpu0.jsonl", "w1.jsonl", "nongpu.jsonl"]
    schema = "edit_id string, status string"
    a = logs.read_log(spark, [str(main)], schema)
    b = logs.read_log(spark, [str(worker)], schema).withColumn("pos", F.col("pos") + (1 << 41))
    assert [r.line for r in a.orderBy("pos").collect()] == [1, 3]
    assert sorted(r.place for r in logs.bad_lines(b).collect()) == ["edit_results_t_gpu0.jsonl:2", "edit_results_t_gpu0.jsonl:6"]
    want = spark.createDataFrame([("e1",), ("e2",), ("e3",), ("e4",)], "edit_id string")
    merged, stats = K.reconcile(a.drop("file", "line"), b.drop("file", "line"), want)
    assert [(r.edit_id, r.status) for r in merged.orderBy("first_pos").collect()] == [("e1", "failed"), ("e2", "success"), ("e3", "success"), ("x999", "success")]
    s = stats.first()
    assert (s.bad_lines, s.missing_id_rows, s.unexpected_ids, s.missing_expected_ids, s.done_success_ids, s.merged_ids) == (2, 1, 1, 1, 3, 4)
    with pytest.raises(ValueError, match="bad_lines"):
        K.reconcile(a.drop("file", "line"), b.drop("file", "line"), want, strict=True)
    assert logs.read_log(spark, [str(tmp_path / "no")], schema).count() == 0
    with pytest.raises(Exception):
        logs.read_log(spark, [str(worker)], schema, strict=True).collect()


def test_ids_and_labels(spark):
    rows = spark.createDataFrame([("del_a_b_001",), ("gdel_x_1",), ("plain",), ("mod_7",), ("zz_1_2",)], "i string")
    got = [tuple(r) for r in rows.select(D.type_of_id(F.col("i")), D.object_of_id(F.col("i"))).collect()]
    assert got == [("deletion", "a_b"), ("deletion", "x"), ("unknown", "plain"), ("modification", "7"), ("unknown", "1")]
    assert one(spark, D.zero_padded(F.lit("1234"), 3)) == "1234" and one(spark, D.zero_padded(F.lit("7"), 3)) == "007"
    for label, core in (("body", True), ("main_frame", True), ("Head", True), ("wheel", False), ("spoiler", False), ("arm_left", False)):
        assert one(spark, D.is_core(F.lit(label))) is core
    assert one(spark, D.run_token(F.lit(""), F.lit(3))) == "shard03"
    assert one(spark, X.object_type(F.lit("A small red wooden chair with arms"))) == "chair"
    assert one(spark, X.normal_category(F.lit(" Left_rear-wheel 2 "))) == "wheel"
    assert one(spark, X.normal_category(F.lit("Left 2"))) == "left 2"
    assert one(spark, X.object_type(F.lit("a little 42"))) == "42" and one(spark, X.object_type(F.lit("The Old"))) == "old" and one(spark, X.object_type(F.lit(None).cast("string"))) == ""
    for said, want in (("REMOVE the hat", "Add the hat"), ("  get rid of  it", "Add it"), ("Take off hats", "Put on hats"), ("strip paint", "Add paint"), ("Eliminate a", "Add a"), ("Cut off b", "Attach b"), ("Erase it", "Add back erase it"), (" ", ""), (None, "")):
        assert one(spark, X.reversed_prompt(F.lit(said).cast("string"))) == want
    assert one(spark, X.structure_of(F.lit("A Chrome, teal (oxidized) box-like round . knob"))) == "A box-like round. knob"
    assert one(spark, X.appearance_of(F.lit("A dome-shaped oblong, teal 'slim' knob"))) == "A teal knob"
    assert one(spark, X.without_words(F.lit("A red, shiny box , tall ."), X.APPEARANCE_WORDS)) == "A box, tall."
    assert one(spark, X.wrapped(F.lit("one two  three four"), 9)) == "one two\nthree\nfour"
    assert one(spark, X.label_list(F.array(F.lit("a"), F.lit("b")))) == "p0=a, p1=b"
    assert bytes(one(spark, X.data_url_bytes(X.data_url(F.lit("x" * 100).cast("binary"))))) == b"x" * 100
    assert one(spark, D.part_label(F.array(F.lit("a"), F.lit("b")), F.lit("o"))) == "a, b"


def test_json_in_text(spark):
    cases = {'{"a": 1}': 1, 'x\n```json\n{"a": 2}\n```': 2, 'so {"a": 3} then': 3, "none": None}
    for text, want in cases.items():
        assert one(spark, F.try_variant_get(J.parsed(F.lit(text)), "$.a", "int")) == want
    assert J.first_balanced('x {"a": {"b": 1}} {"c": 2}') == '{"a": {"b": 1}}'
    assert J.first_balanced("no") is None and J.first_balanced(None) is None and J.first_balanced("{ never") is None
    last = 'try {"edit_executed": false} no: {"edit_executed": true, "reason": "a } brace \\" quoted"}'
    assert json.loads(J.judge_json("<think>{\"edit_executed\": 1}</think>" + last))["edit_executed"] is True
    assert J.judge_json('{"other": 1}') is None
    r = one(spark, J.judged(F.lit(last)))
    assert r.executed and not r.rejected and r.quality == 1
    assert one(spark, J.judged(F.lit("nothing"))).rejected


def test_components_two_ways(spark):
    rng = np.random.default_rng(1)
    rows = [(str(o), int(x), int(y), int(z)) for o in range(6) for x, y, z in rng.integers(0, 6, (30 + 20 * o, 3))] + [("e", 63, 0, 0), ("e", 0, 1, 0), ("e", 70, 0, 0), ("e", 5, 63, 1), ("e", 6, 0, 1)]
    v = spark.createDataFrame(rows, "obj_id string, x int, y int, z int")
    a = {r.obj_id: r.components for r in VX.components(v).collect()}
    b = {r.obj_id: r.components for r in VX.components_by_labels(v).collect()}
    assert a == b and a["e"] == 4


def test_masks_and_regions(spark):
    occ = spark.createDataFrame([("a", x, 0, 0) for x in range(0, 8, 2)], "obj_id string, x int, y int, z int")
    near = {(r.x, r.y, r.z) for r in VX.voted_region(occ, occ.where("x >= 4"), pad=1, k=1).collect()}
    assert (5, 0, 0) in near and (4, 1, 0) in near and (3, 0, 0) not in near
    rng = np.random.default_rng(2)
    cells = np.unique(rng.integers(20, 32, (900, 3)), axis=0)
    edited = cells[cells[:, 0] < 25]
    many = spark.createDataFrame([("a", *map(int, c)) for c in cells], occ.schema)
    got = {(r.x, r.y, r.z) for r in VX.voted_region(many, many.where("x < 25")).collect()}
    held, want = {tuple(map(int, c)) for c in cells}, set()
    for c in itertools.product(*[range(int(a) - 3, int(b) + 4) for a, b in zip(edited.min(axis=0), edited.max(axis=0))]):
        nearest = np.argsort(((cells - np.array(c)) ** 2).sum(axis=1), kind="stable")[:100]
        if c not in held and (cells[nearest, 0] < 25).sum() > 50:
            want.add(c)
    assert got == want and want
    near = rng.integers(18, 34, (300, 3))
    for k in (1, 7, 100):
        assert (VX._votes(near, cells, cells[:, 0] < 25, k, 64) == VX._votes_of_few(near, cells, cells[:, 0] < 25, k)).all()
    points, body = rng.random((60, 3)), rng.random((500, 3))
    frame = lambda ps: spark.createDataFrame([("a", *map(float, p)) for p in ps] + [("b", 0.0, 0.0, 0.0)] * (len(ps) > 60), "obj_id string, x double, y double, z double")
    gap = {r.obj_id: r.gap for r in G.gap_distance(frame(points), frame(body)).collect()}
    assert gap == {"a": pytest.approx(np.percentile(np.linalg.norm(points[:, None] - body[None], axis=2).min(axis=1), 10))}
    grown = VX.dilated(occ.where("x = 0"), occ.unionByName(spark.createDataFrame([("a", 1, 0, 0)], occ.schema)), 2)
    assert sorted(r.x for r in grown.collect()) == [0, 1, 2]


def test_partitions_and_packing(spark):
    ids = spark.range(10).select(F.col("id").cast("string").alias("k"), "id")
    assert [r.p for r in S.range_part(ids, ["id"], 4, "p").orderBy("id").collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    assert [r.p for r in S.modulo_part(ids, ["id"], 3, "p").orderBy("id").collect()] == [i % 3 for i in range(10)]
    with pytest.raises(ValueError):
        S.take_range_part(ids, ["id"], 4, 4)
    draw = random.Random(3)
    for many in ([5, 3, 3, 2], [draw.choice([1, 1, 2, 3, 7, 50]) for _ in range(400)], [1] * 9, []):
        rows = [(f"{i:04d}", i * 1000 + k) for i, n in enumerate(many) for k in range(n)]
        draw.shuffle(rows)
        got = {r.obj_id: (r.n, r.bucket) for r in S.packed(spark.createDataFrame(rows, "obj_id string, pos long"), 3).collect()}
        loads, want = [0] * 3, {}
        for i, n in sorted(enumerate(many), key=lambda x: -x[1]):
            b = min(range(3), key=lambda b: (loads[b], b))
            want[f"{i:04d}"], loads[b] = (n, b), loads[b] + n
        assert got == want
    edits = spark.createDataFrame([(o, f"{o}{i}", "00") for o in "abc" for i in range(4)], "obj_id string, edit_id string, shard string")
    order = [r.obj_id for r in S.grouped_shuffle(edits, 1, 2).collect()]
    assert sum(x != y for x, y in zip(order, order[1:])) == 2
    with pytest.raises(ValueError):
        K.assert_disjoint(spark.createDataFrame([("a", 1), ("a", 2)], "k string, b int"), "k", "b")
    assert S.even_views(10, 4) == [0, 2, 5, 7]


def test_scores(spark):
    m = F.array(Q.metric("a", F.lit(1.0), F.lit(True), 2), Q.metric("b", F.lit(0.0), F.lit(False), 1))
    assert one(spark, Q.weighted_score(m)) == 0.6667 and one(spark, Q.first_failure(m)) == "b" and not one(spark, Q.all_passed(m))
    empty = F.array().cast(f"array<{Q.METRIC}>")
    assert one(spark, Q.weighted_score(empty)) == 0.0 and one(spark, Q.all_passed(empty))
    numbers = {"volume_ratio": 1.0, "area_ratio": 1.0, "edit_ratio": 0.5, "part_proportion": 0.1, "components": 1, "min_vertices": 60, "min_extent": 0.1, "drift": 0.1, "min_colour_std": 2.0, "iou": 0.5, "penetration": 0.4, "gap": 0.1, "scale_ratio": 2.0}
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in numbers.items()])
    assert df.select(Q.all_passed(Q.mesh_metrics())).first()[0] and df.select(Q.first_failure(Q.mesh_metrics(swap=True))).first()[0] == "penetration"


def record(spark, parts, groups=(), whole=()):
    edit = lambda t, m="", p="do": {"type": t, "mod_type": m, "prompt": p, "after_desc": "", "before_part_desc": "", "after_part_desc": ""}
    ps = [{"part_id": i, "label": label, "core": None, "desc": "", "desc_without": "", "group": "", "edits": [edit(*e) for e in es]} for i, label, es in parts]
    gs = [{"group_name": "g", "part_ids": ids, "desc": "", "desc_without": "", "best_view": 0, "edits": [edit(*e) for e in es]} for ids, es in groups]
    ws = [{"type": "global", "prompt": p, "after_desc": ""} for p in whole]
    return spark.createDataFrame([("o", "00", len(ps), "a chair", [], ps, gs, ws)], L.RECORD)


def test_planner(spark):
    r = record(spark, [(0, "seat", [("modification", "swap", "new seat"), ("scale",)]), (1, "main body", []), (2, "leg", []), (3, "leg", [])], [([2, 3], [("addition",), ("deletion",), ("addition",), ("deletion",)]), ([0, 1, 2, 3], [("deletion",)])][:1], ["a", "", "c", "d"])
    got = {s.edit_id: s for s in plan(r).collect()}
    kinds = sorted(got)
    # group: two deletions and the addition after the first; part 0: deletion, addition, swap, scale; part 1 is core
    assert [k for k in kinds if k.startswith("del")] == ["del_o_000", "del_o_001", "del_o_002"]
    assert got["add_o_000"].source_del_id == "del_o_000" and got["add_o_001"].source_del_id == "del_o_002"
    assert got["del_o_000"].remove_part_ids == [2, 3] and got["del_o_000"].keep_part_ids == [0, 1] and got["del_o_002"].old_part_id == 0
    assert len([k for k in kinds if k.startswith("mod")]) == 1
    assert [got[k].edit_prompt for k in kinds if k.startswith("glb")] == ["a", "c"]  # the fourth is over the limit, the second empty
    assert len([k for k in kinds if k.startswith("scl")]) == 4 and len([k for k in kinds if k.startswith("mat")]) == 4
    assert len([k for k in kinds if k.startswith("idt")]) == 1
    everything = record(spark, [(0, "a", []), (1, "b", [])], [([0, 1], [("deletion",)])])
    ids = [s.edit_id for s in plan(everything).collect()]
    assert not any(i.startswith(("del", "add")) for i in ids)  # the whole object as a group emits nothing and still counts as grouped
    assert plan(record(spark, [(0, "a", [])])).count() == 0
    said = instructions(plan(r)).collect()
    assert len({(s.edit_id, s.instruction) for s in said}) == len(said)


def test_records_from_answers(spark):
    asked = {"prompt": "Remove it", "after_desc": "x", "before_part_desc": "", "after_part_desc": ""}
    answer = {"object_desc": "car", "parts": [{"part_id": 1, "label": "", "is_core": None, "desc": "d", "deletion": asked, "swaps": [asked], "scale": asked}], "global_edits": [asked]}
    df = spark.createDataFrame([("o", None, ["body", "wheel"], json.dumps(answer))], "obj_id string, shard string, labels array<string>, t string").withColumn("answer", F.from_json("t", L.ANSWER))
    r = L.from_part_answer(df).first()
    assert r.parts[0].label == "wheel" and [e.type for e in r.parts[0].edits] == ["deletion", "modification", "scale"] and not r.parts[0].core and r.shard == "00"
    g = {"object_desc": "car", "groups": [{"name": "wheels", "parts": [1, 7], "deletion": asked}]}
    df = spark.createDataFrame([("o", "03", ["body", "wheel"], [10, 20], json.dumps(g))], "obj_id string, shard string, labels array<string>, ids array<int>, t string").withColumn("answer", F.from_json("t", L.GROUP_ANSWER))
    r = L.from_group_answer(df).first()
    assert r.group_edits[0].part_ids == [20] and [e.type for e in r.group_edits[0].edits] == ["deletion", "addition"] and r.parts[0].core
    c = L.catalog(L.by_rules(df)).collect()
    assert [x.category for x in c] == ["body", "wheel"]
    parts = spark.createDataFrame([("o", 0), ("o", 1)], "obj_id string, part_id int")
    answers = spark.createDataFrame([("o", 1, "w", ["deletion", "nope"], 0), ("o", 1, "again", [], 1), ("o", 9, "x", [], 2)], "obj_id string, part_id int, label string, types array<string>, pos int")
    assert [(x.part_id, x.label, x.types) for x in L.validated(answers, parts).orderBy("late", "pos").collect()] == [(1, "w", ["deletion"]), (0, "part_0", ["deletion"])]


def test_geometry(spark):
    v = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("a", 2.0, 4.0, 1.0)], "obj_id string, x double, y double, z double")
    assert [(r.x, r.y, r.z) for r in G.normalised(v).orderBy("x").collect()] == [(-0.5, -1.0, -0.25), (0.5, 1.0, 0.25)]
    frames = spark.createDataFrame([("a", 0, [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, -10.0, 0.0, 0.0, 0.0, 1.0], 20.0)], "obj_id string, view int, w2c array<double>, focal double")
    assert sorted((r.px, r.py) for r in G.projected(v, frames, 32, 32).collect()) == [(16, 16), (20, 7)]
    edge = spark.createDataFrame([("a", 7.8, -7.8, 0.0), ("a", 8.0, 0.0, 0.0), ("a", -8.0, 0.0, 0.0), ("a", -8.1, 0.0, 0.0), ("a", 0.0, 0.0, 10.0)], v.schema)
    at = G.projected(edge, frames, 32, 32)
    assert sorted((r.px, r.py) for r in at.collect()) == [(0, 16), (31, 31)]
    pixels = spark.createDataFrame([("a", 0, 0, 16, 1, 2, 3, 0.5), ("a", 0, 31, 31, 4, 5, 6, 0.6)], "obj_id string, view int, px int, py int, r int, g int, b int, alpha double")
    assert [(r.px, r.g) for r in G.visible(at, pixels).collect()] == [(31, 5)]
    cams = [("a", i, float(x), float(y), float(z)) for i, (x, y, z) in enumerate([(1, 0, 0), (0, 1, 0), (-1, 0, 0.4), (0, -1, 0), (1, 0, 0), (0, 0, 0), (1, 0, 0.46)])] + [("z", 3, 0.0, 0.0, 0.0), ("z", 8, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(cams, "obj_id string, view int, cx double, cy double, cz double")
    got = {(r.obj_id, r.target): r["view"] for r in G.orthogonal_views(df).collect()}
    assert [got["a", t] for t in (0.0, 90.0, 180.0, -90.0)] == [6, 1, 2, 3] and got["z", 0.0] == 3
    seen = df.withColumn("has_image", (F.col("obj_id") == "a") & F.col("view").isin(0, 1, 4))
    got = {(r.obj_id, r.target): r["view"] for r in G.orthogonal_views(seen).collect()}
    assert [got["a", t] for t in (0.0, 90.0, 180.0, -90.0)] == [0, 1, 1, 0] and got["z", 90.0] == 3
    faces = spark.createDataFrame([("a", 0, 1, 2, 0), ("a", 5, 6, 7, 1), ("a", 6, 7, 9, 1)], "obj_id string, a int, b int, c int, part int")
    assert sorted((r.part, r.a, r.b, r.c) for r in G.split_faces(faces).collect()) == [(0, 0, 1, 2), (1, 0, 1, 2), (1, 1, 2, 3)]
    d = spark.createDataFrame([("a", i, float(i)) for i in range(40)], "obj_id string, v int, d double")
    assert G.contact_points(d, 2.5).count() == 4 and G.contact_points(d, 20.0).count() == 21
    poses = {r["view"]: r.c2w for r in G.orbit(spark.range(42).select(F.col("id").alias("view"))).collect()}
    assert len(poses) == 42
    for v, (lift, turn) in ((0, (-20, 0)), (9, (0, 720 / 7)), (41, (80, 2160 / 7))):
        e, a = math.radians(lift), math.radians(turn)
        at = np.array([2.5 * math.cos(e) * math.sin(a), 2.5 * math.sin(e), 2.5 * math.cos(e) * math.cos(a)])
        m = np.array(poses[v]).reshape(4, 4)
        back = at / np.linalg.norm(at)
        right = np.cross(-back, [0, 1, 0])
        right /= np.linalg.norm(right)
        assert np.allclose(m[:3, 3], at) and np.allclose(m[:3, 2], back) and np.allclose(m[:3, 0], right) and np.allclose(m[:3, 1], np.cross(right, -back)) and list(m[3]) == [0, 0, 0, 1]
    assert G.orbit(spark.range(42).select(F.col("id").alias("view")), 14).count() == 14
    votes = spark.createDataFrame([(1, 5), (1, 3), (1, 3), (1, 5), (2, 9)], "i int, l int")
    assert {r.i: r.l for r in G.majority_labels(votes, "i", "l").collect()} == {1: 3, 2: 9}


def test_both_directions(spark):
    p = spark.createDataFrame([("o", "del_o_1", "b", "a")], "obj_id string, edit_id string, before_path string, after_path string")
    assert [(r.edit_id, r.before_path) for r in P.both_directions(p).orderBy("edit_id").collect()] == [("add_o_1", "a"), ("del_o_1", "b")]


def test_shared_folder(spark):
    from quarrykit import sharedfs

    class Conf:
        def __init__(self, named):
            self.named = named

        def get(self, key, default=None):
            return self.named

    class Context:
        def __init__(self, master):
            self.master, self.applicationId = master, "app-of-a-test"

    class Session:
        def __init__(self, master, named):
            self.conf, self.sparkContext = Conf(named), Context(master)

    assert sharedfs.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert sharedfs.shared_dir(Session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    local = Session("local[2]", None)
    assert sharedfs.shared_dir(local) == sharedfs.shared_dir(local)
    with pytest.raises(ValueError):
        sharedfs.shared_dir(Session("yarn", None))


def _brute_candidates(rows, n):
    """All pairs of a catalogue's rows (idx, obj_id, category, object_type, cluster_size, aspect)."""
    far = lambda x, y, most: x is not None and y is not None and x > 0 and y > 0 and max(x, y) > most * min(x, y)
    rows = sorted(rows)
    found = []
    for i, o, k, t, s, r in rows:
        like = (b for b, p, l, u, z, q in rows if None not in (k, o, p) and l == k and p != o and (not t or not u or t == u) and not far(s, z, 5.0) and not far(r, q, 2.0))
        found += [(i, b, rank) for rank, b in enumerate(itertools.islice(like, n), 1)]
    return found


@pytest.mark.parametrize("heads", [(3, 20), (4096,)])
def test_swap_candidates_are_those_of_all_pairs(spark, heads):
    draw = random.Random(7)
    rows = [(i, draw.choice([*"pqrst", None]) if i % 3 else "p", draw.choice(["seat", "leg", None]), draw.choice(["a", "b", "", None]), draw.choice([0, 1, 4, 5, 6, 30, None]), draw.choice([-1.0, 1.0, 2.0, 2.5, 8.0, None])) for i in range(1, 300)]
    df = spark.createDataFrame(rows, "idx int, obj_id string, category string, object_type string, cluster_size int, aspect double")
    assert sorted(map(tuple, G.swap_candidates(df, 3, heads=heads).collect())) == _brute_candidates(rows, 3)


def test_swap_candidates_cross_labels(spark):
    from quarrykit.plans import queries
    from quarrykit.plans.frames import frame

    parts = sorted(frame(spark, "/root/testdata/sf0.001", "parts").collect(), key=lambda r: (r.obj_id, r.part_id))
    rows = [(i, r.obj_id, r.kind, None if r.qty <= 10 else "a" if r.qty > 25 else "b", r.cluster_size, r.qty) for i, r in enumerate(parts, 1)]
    got = sorted(map(tuple, queries.QUERIES["j12_swap_candidates"](spark, "/root/testdata/sf0.001").collect()))
    assert got == _brute_candidates(rows, 3)
    assert any(parts[i - 1].label != parts[b - 1].label for i, b, _ in got)


def test_voxel_queries_by_order_grow_with_the_table(spark):
    from quarrykit.plans import more_queries, queries  # noqa: F401
    from quarrykit.plans.frames import frame

    sf = "/root/testdata/sf0.001"
    orders = frame(spark, sf, "lineitem").where("l_returnflag <> 'R'").select("l_orderkey").distinct().count()
    side = frame(spark, sf, "order_a")
    assert side.select("obj_id").distinct().count() == orders > 200
    spread = side.agg(*[F.count_distinct(c).alias(c) for c in "xyz"], F.min("x").alias("lo"), F.max("z").alias("hi")).first()
    assert tuple(spread) == (64, 64, 64, 0, 63)
    for name in ("q17_components", "j13_nearest_labels", "j14_voted_region", "a21_j17_gap", "a16_pixel_counts", "w06_best_views", "w07_best_view_of_set"):
        assert f"{name}_by_order" in queries.QUERIES


def test_rule_weights(spark):
    """Weights and skipped rules, worked by hand."""
    cols = "edit_id string, edit_type string, n_voxels long, feat_max double, feat_std double, ss_max double, ss_std double, coord_min int, coord_max int, n_unique long, voxel_ratio double, deleted double, added double, iou double, ss_l2 double, ss_cosine double, ss_diff double, components int, locality double, drift double, feat_change double, axis_min double, axis_max double, min_extent double, coverage double, same_count boolean, has_after boolean, has_original boolean"
    ok = dict(n_voxels=500, feat_max=9.0, feat_std=0.5, ss_max=9.0, ss_std=0.002, coord_min=0, coord_max=63, n_unique=500, voxel_ratio=0.5, deleted=0.5, added=0.5, iou=0.5, ss_l2=0.5, ss_cosine=0.9, ss_diff=0.0, components=1, locality=0.1, drift=0.1, feat_change=0.5, axis_min=0.9, axis_max=1.1, min_extent=9.0, coverage=0.5, same_count=True, has_after=True, has_original=True)
    names = [c.split()[0] for c in cols.split(", ")]
    cases = {
        "good": ("deletion", {}), "large": ("deletion", {"feat_max": 60.0}), "dead": ("deletion", {"feat_std": 0.001}), "nan": ("deletion", {"feat_max": float("nan")}), "ss": ("deletion", {"ss_std": 0.0005}), "cells": ("deletion", {"coord_max": 64}),
        "no_ss": ("modification", {"ss_max": None, "ss_std": None, "ss_cosine": None, "locality": 0.9}), "no_ss_dead": ("modification", {"ss_max": None, "ss_std": None, "feat_std": 0.0}),
        "same": ("identity", {"feat_std": 0.0}), "same_alone": ("identity", {"feat_std": 0.0, "has_original": False}), "glob": ("global", {"voxel_ratio": 1.0, "coverage": 0.1}), "mat": ("material", {"voxel_ratio": 1.0, "ss_diff": None, "feat_change": 5.0}),
    }
    df = spark.createDataFrame([tuple({**ok, **more, "edit_id": i, "edit_type": t}[n] for n in names) for i, (t, more) in cases.items()], cols)
    got = {r.edit_id: (r.score, r.tier, r.reason) for r in Q.verdicts(df).collect()}
    assert got == {
        "good": (1.0, "high", ""), "large": (round(9 / 12, 4) / 2, "rejected", "feat_range"), "dead": (round(9 / 11, 4) / 2, "rejected", "feat_range"), "nan": (round(9 / 12, 4) / 2, "rejected", "feat_range"), "ss": (round(9 / 11, 4) / 2, "rejected", "ss_range"), "cells": (round(8 / 11, 4) / 2, "rejected", "coords_valid"),
        "no_ss": (round((1 + round(5 / 7.5, 4)) / 2, 4), "negative", "edit_locality"), "no_ss_dead": (round(7 / 9, 4) / 2, "rejected", "feat_range"),
        "same": (0.5, "negative", ""), "same_alone": (1.0, "high", ""), "glob": (round((1 + round(6.5 / 8, 4)) / 2, 4), "negative", "change_coverage"), "mat": (round((1 + round(2 / 3.5, 4)) / 2, 4), "negative", "feat_change"),
    }
    one_ = {r.edit_id: [(m.name, m.value, m.weight) for m in r.m] for r in df.select("edit_id", Q.layer_one().alias("m")).collect()}
    assert one_["good"] == [("voxel_count", 500.0, 2.0), ("feat_range", 9.0, 2.0), ("ss_range", 9.0, 2.0), ("coords_valid", 1.0, 3.0), ("coords_unique", 1.0, 2.0)]
    assert one_["dead"][1] == ("feat_range", 0.001, 2.0) and one_["large"][1] == ("feat_range", 60.0, 3.0) and one_["nan"][1] == ("feat_range", 0.0, 3.0) and len(one_["no_ss"]) == 4
    two = {r.edit_id: [m.name for m in r.m] for r in df.select("edit_id", Q.layer_two().alias("m")).collect()}
    assert two["no_ss"] == ["voxel_ratio", "edit_locality", "connected_components", "center_drift", "feat_change"] and two["mat"] == ["voxel_count_close", "feat_change"] and two["same"] == ["identity_valid"]


def test_rounding_is_of_the_binary_value(spark):
    from quarrykit.functions.vectors import rounded

    rng = random.Random(4)
    xs = [0.0, 1.0, 0.90625, 0.03125, 0.5, 0.00005, 0.92105] + [k / 20000 for k in range(1, 20000, 7)] + [(1.0 + round(rng.random(), 4)) / 2 for _ in range(4000)] + [rng.random() for _ in range(500)]
    got = [r.y for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(rounded(F.col("x")).alias("y")).collect()]
    assert got == [round(x, 4) for x in xs]


def test_small_orders_and_catalogues(spark, tmp_path):
    e = spark.createDataFrame([("o", "addition", 0), ("o", "scale", 1), ("o", "deletion", 2), ("o", "identity", 3), ("o", "odd", 4), ("o", "deletion", 5)], "obj_id string, edit_type string, pos int")
    assert [r.pos for r in S.in_process_order(e).collect()] == [2, 5, 1, 3, 0, 4]
    assert [(t, sorted(r.pos for r in d.collect())) for t, d in S.phases(e) if d.count()] == [("deletion", [2, 5]), ("scale", [1]), ("addition", [0]), ("identity", [3])]
    scored = spark.createDataFrame([("a", 0.5, 0), ("b", 0.9, 1), ("c", 0.5, 2), ("d", None, 3)], "k string, score double, pos int")
    assert [r.k for r in S.best_first(scored).collect()] == ["b", "a", "c", "d"]
    assert [r.worker for r in S.round_robin(scored, 3).orderBy("pos").collect()] == [0, 1, 2, 0]
    groups = S.largest_groups(e.withColumn("obj_id", F.col("edit_type"))).collect()
    assert [(r.obj_id, r.n) for r in groups][:2] == [("deletion", 2), ("addition", 1)]
    a = spark.createDataFrame([(["b", "a", "c"],)], "names array<string>")
    got = S.members_to_drop(a, F.array(F.lit("c"), F.lit("z"))).first()
    assert got.dropped == ["a", "b"] and got.kept == ["c"]
    r = record(spark, [(0, "seat", [("scale",)]), (1, "main body", [])], [([0, 1], [("deletion",)])], ["w"])
    L.save_catalog(r, str(tmp_path / "c"))
    assert L.load_catalog(spark, str(tmp_path / "c")).collect() == r.collect()
    got = L.summarised(r).first()
    assert (got.parts, got.part_edits, got.group_edits, got.global_edits, got.labels) == (2, 1, 1, 1, ["seat", "main body"])


def test_feature_change_of_unequal_lengths(spark):
    from quarrykit.functions import vectors as V

    arr = lambda *xs: F.array(*[F.lit(float(x)) for x in xs])
    assert one(spark, V.feature_change(arr(3, 4), arr(6, 8, 0))) == 1.0 and one(spark, V.feature_change(arr(3, 4), arr(3, 5))) == 0.2
    assert one(spark, V.feature_change(arr(0, 0), arr(1, 1))) == math.inf and one(spark, V.feature_change(arr(0), arr(1, 1))) == math.inf


def _cube(x, y, z, d):
    """Vertices and outward faces of a box."""
    vs = [(x + d * (i & 1), y + d * (i >> 1 & 1), z + d * (i >> 2)) for i in range(8)]
    fs = [(0, 2, 1), (1, 2, 3), (4, 5, 6), (5, 7, 6), (0, 1, 4), (1, 5, 4), (2, 6, 3), (3, 6, 7), (0, 4, 2), (2, 4, 6), (1, 3, 5), (3, 7, 5)]
    return [tuple(map(float, v)) for v in vs], fs


def _meshes(spark, rows):
    """(obj_id, side, part of the cube list) -> vertices, faces."""
    v = [(o, s, i, *p, 10 * i, 20, 30) for o, s, vs, _ in rows for i, p in enumerate(vs)]
    f = [(o, s, *t) for o, s, _, fs in rows for t in fs]
    return spark.createDataFrame(v, "obj_id string, side string, v int, x double, y double, z double, r int, g int, b int"), spark.createDataFrame(f, "obj_id string, side string, a int, b int, c int")


def test_mesh_numbers_of_boxes(spark):
    from quarrykit.operators import meshes as M

    small, large = _cube(0, 0, 0, 1), _cube(0, 0, 0, 2)
    two = (small[0] + _cube(5, 0, 0, 1)[0], small[1] + [tuple(i + 8 for i in t) for t in small[1]])
    v, f = _meshes(spark, [("a", "before", *small), ("a", "after", *large), ("b", "before", *two), ("b", "after", *small), ("c", "before", *small)])
    got = {r.obj_id: r for r in M.pair_numbers(v, f).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.volume_ratio, a.area_ratio, a.part_proportion, a.min_vertices, a.min_extent) == (8.0, 4.0, 0.0, 8, 1.0)
    assert a.edit_ratio == 14 / 8 and a.iou == pytest.approx(1 / 8) and a.drift == pytest.approx(math.sqrt(3) / 2 / math.sqrt(3))
    assert b.volume_ratio == pytest.approx(1 / 6) and b.area_ratio == 0.5 and b.part_proportion == 0.5 and b.edit_ratio == 0.5 and b.iou == pytest.approx(1 / 6)
    assert a.min_colour_std == pytest.approx(np.std([[10 * i, 20, 30] for i in range(8)]))
    assert (c.volume_ratio, c.area_ratio, c.part_proportion, c.min_vertices, c.iou, c.edit_ratio, c.drift, c.min_colour_std) == (0.0, 0.0, 1.0, 0, 0.0, 1.0, 0.0, 0.0)
    parts = lambda closed, keep: {r.obj_id: r.components for r in M.component_counts(f.where("side = 'before'").where(keep), closed).collect()}
    assert parts(True, "true") == {"a": 1, "b": 2, "c": 1} and parts(True, "a > 1") == {"a": 0, "b": 1, "c": 0} and parts(False, "true")["b"] == 2
    ok = {r.obj_id: (r.score, r.passed, r.reason) for r in M.mesh_verdicts(v, f).collect()}
    # a: volume 8 > 5, edit 1.75, part 0, 8 vertices, drift 0.5 fail; b: 8 vertices, drift 2.5 / sqrt(38) > 0.3
    assert ok["a"] == (round((12.5 - 1.5 - 2 - 1.5 - 2 - 1) / 12.5, 4), False, "volume_ratio") and ok["b"] == (round((12.5 - 2 - 1) / 12.5, 4), False, "has_geometry")
    assert ok["c"][1:] == (False, "volume_ratio")
    empty = v.where("false"), f.where("false")
    assert M.mesh_verdicts(*empty).count() == 0 and M.component_counts(empty[1]).count() == 0


def test_a_part_in_a_body(spark):
    from quarrykit.operators import meshes as M

    body = _cube(0, 0, 0, 10)
    cases = {"in": _cube(4, 4, 4, 1), "out": _cube(20, 0, 0, 1), "half": _cube(9, 4, 4, 2)}
    rows = lambda of: M.mesh_rows(*_meshes(spark, [(k, "s", *of(k)) for k in cases]))
    part, whole = rows(lambda k: cases[k]), rows(lambda k: body)
    got = {r.obj_id: (r.penetration, r.gap) for r in M.fit_numbers(part, whole).collect()}
    assert got == {r.obj_id: (r.penetration, r.gap) for r in M.fit_numbers(part.repartition(3), whole).collect()}
    assert got["in"][0] == 1.0 and got["out"][0] == 0.0 and abs(got["half"][0] - 0.5) < 0.06
    assert 1.0 <= got["out"][1] <= 1.1 and got["in"][1] > 0.5
    open_ = M.mesh_rows(*_meshes(spark, [("in", "s", body[0], body[1][1:])]))
    assert M.fit_numbers(part, open_).first().penetration == 0.0
    rng = np.random.default_rng(5)
    points, known = rng.random((200, 3)), rng.random((300, 3))
    assert np.allclose(M.nearest_distances(points, known), np.linalg.norm(points[:, None] - known[None], axis=2).min(axis=1))
    scale = {r.obj_id: r.scale_ratio for r in M.scale_ratio(_meshes(spark, [("a", "s", *_cube(0, 0, 0, 4)), ("b", "s", *body)])[0], _meshes(spark, [("a", "s", *_cube(9, 0, 0, 8))])[0]).collect()}
    assert scale == {"a": 2.0, "b": 999.0}


def test_assembly_of_meshes(spark):
    from quarrykit.operators import meshes as M

    body, hat, new = _cube(0, 0, 0, 2), _cube(0, 0, 2, 1), _cube(5, 5, 5, 10)
    vs, fs = body[0] + hat[0], [(*t, 0) for t in body[1]] + [(*(i + 8 for i in t), 1) for t in hat[1]]
    v = spark.createDataFrame([("o", i, *p) for i, p in enumerate(vs)] + [("q", 0, 0.0, 0.0, 0.0)], "obj_id string, v int, x double, y double, z double")
    f = spark.createDataFrame([("o", *t) for t in fs], "obj_id string, a int, b int, c int, part int")
    nv = spark.createDataFrame([(o, i, *p) for o in "oq" for i, p in enumerate(new[0])], "obj_id string, v int, x double, y double, z double")
    nf = spark.createDataFrame([(o, *t, 7) for o in "oq" for t in new[1]], "obj_id string, a int, b int, c int, part int")
    old = spark.createDataFrame([("o", 1)], "obj_id string, part int")
    assert {r.part for r in M.without_parts(f, old).collect()} == {0}
    made, faces = M.swapped(v, f, old, nv, nf)
    got = {r.v: (r.x, r.y, r.z) for r in made.where("obj_id = 'o'").collect()}
    assert len(got) == 24 and all(got[16 + i] == pytest.approx(hat[0][i], abs=1e-6) for i in range(8))
    rows = faces.collect()
    assert {r.part for r in rows} == {0, 7} and {r.a for r in rows if r.part == 7} <= set(range(16, 24)) and len(rows) == 24 and made.where("obj_id = 'q'").count() == 1
    made, faces = M.grafted(v.where("obj_id = 'o'"), f, nv, nf)
    got = {r.v: (r.x, r.y, r.z) for r in made.where("obj_id = 'o' and v >= 16").collect()}
    # at most 0.4 of the longest side (3): 1.2 wide, centred on x and y, its foot at the top (3)
    assert min(p[2] for p in got.values()) == pytest.approx(3.0) and max(p[2] for p in got.values()) == pytest.approx(4.2) and sum(p[0] for p in got.values()) / 8 == pytest.approx(1.0)
    assert faces.where("obj_id = 'o'").count() == 36
