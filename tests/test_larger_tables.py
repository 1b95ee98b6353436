"""What the smallest tables do not show: keys as larger ones have them, and plans that hold out over them."""

import duckdb
import pytest

from quarrykit.operators import geometry as G
from quarrykit.plans import mesh_queries, more_queries, queries as Q  # noqa: F401

SF = "/root/testdata/sf0.001"


def plan(df, of="optimizedPlan") -> str:
    return getattr(df._jdf.queryExecution(), of)().toString()


def held_to_sql(spark, tables, name):
    c = duckdb.connect()
    for t in ("lineitem", "part", "events", "orders"):
        c.execute(f"create view {t} as select * from '{tables}/{t}.parquet'")
    got = Q.QUERIES[name](spark, str(tables))
    names = sorted(got.columns)
    text = ", ".join(f'"{n}"' for n in names)
    want = sorted(map(str, c.execute(f"select {text} from ({Q.ORACLE[name]}) q").fetchall()))
    assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want and want


@pytest.fixture(scope="module")
def shifted(tmp_path_factory):
    """The smallest tables with suppliers 1,000 on."""
    to = tmp_path_factory.mktemp("shifted")
    duckdb.connect().execute(f"copy (select * replace (l_suppkey + 1000 as l_suppkey) from '{SF}/lineitem.parquet') to '{to}/lineitem.parquet' (format parquet)")
    for t in ("part", "events", "orders"):
        (to / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    return to


def test_vertex_colours_of_late_suppliers(spark, shifted):
    held_to_sql(spark, shifted, "a17_vertex_colours")
    seen = spark.createDataFrame([(1, 300.0, -4.0, 900.0)], "vertex int, r double, g double, b double")
    assert [tuple(r) for r in G.vertex_colours(seen, seen).collect()] == [(1, 255, 0, 255)]


def test_specs_are_made_once(spark):
    """An inner generator asks for the size of its array in a filter below, which makes every spec a second time."""
    for name in ("planner_specs", "k13_keep_list"):
        text = plan(Q.QUERIES[name](spark, SF))
        assert not any("md5" in line or "named_struct" in line for line in text.splitlines() if "Filter" in line), name
    # the plan for deletions alone draws no prompts
    assert "md5" not in plan(Q.QUERIES["k13_keep_list"](spark, SF)) and "md5" in plan(Q.QUERIES["planner_specs"](spark, SF))


def test_part_of_a_plan(spark):
    from quarrykit.operators import labels as L
    from quarrykit.operators.planner import plan as planned

    labels = [("a", "00", ["body", "left_arm", "left_arm", "wheel"]), ("b", "00", ["x"]), ("c", "01", ["base", "head"])]
    records = L.by_rules(spark.createDataFrame(labels, "obj_id string, shard string, labels array<string>"))
    whole = [r for r in planned(records).collect()]
    for types in (("deletion",), ("addition",), ("scale", "identity"), ("addition", "material")):
        got = planned(records, types=types).collect()
        assert sorted(map(str, got)) == sorted(str(r) for r in whole if r.edit_type in types) and got


def test_cross_check_groups_once(spark):
    from quarrykit.operators import keyed_logs as K

    a, b = (spark.createDataFrame([(k,) for k in ks], "k string") for ks in ([1, 1, 2, None, ""], [2, 3, 3, None]))
    made = K.cross_check(a, b, "k")
    assert "Join" not in plan(made) and plan(made).count("Aggregate") == 1
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, [("1", "missing"), ("", "missing"), ("3", "unexpected"), (None, "missing"), (None, "unexpected")]))


def test_worker_outputs_group_once(spark):
    from quarrykit.operators import keyed_logs as K

    a, b = (spark.createDataFrame([(k,) for k in ks], "k string") for ks in ([1, 1, 2, None], [2, 2, 3, 3, 4, None]))
    made = K.worker_outputs(a, b, "k")
    assert "Join" not in plan(made) and plan(made).count("Aggregate") == 1
    want = [("1", "missing", 0), (None, "missing", 0), ("2", "duplicate", 2), ("3", "duplicate", 2), ("3", "unexpected", 2), ("4", "unexpected", 1)]
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, want))


def test_edits_without_a_source_spread_out(spark):
    from quarrykit.operators import datasets as DS
    from quarrykit.operators import pairing as P

    rows = [(f"e{i}", "e1" if i % 7 == 0 else "" if i % 2 else None) for i in range(2000)]
    edits = spark.createDataFrame([(*r, "deletion") for r in rows], "edit_id string, source_del_id string, edit_type string")
    specs = spark.createDataFrame([(k, f"Remove {k}") for k, _ in rows] + [("", "Remove nothing")], "edit_id string, prompt string")
    log = spark.createDataFrame([], "edit_id string, status string, prompt string, pos long")
    files = spark.createDataFrame([(k, "b", "a") for k, _ in rows], "edit_id string, before_path string, after_path string")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for made in (P.resolved_prompts(edits, log, specs), DS.resolved_entries(edits, files)):
            sizes = [r.n for r in made.selectExpr("spark_partition_id() as p").groupBy("p").agg({"*": "count"}).toDF("p", "n").collect()]
            assert sum(sizes) == 2000 and max(sizes) < 1200
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert {r.prompt for r in P.resolved_prompts(edits, log, specs.where("edit_id in ('e1', '')")).collect()} == {"Remove e1", "Add e1", ""}


def sorted_in_one_task(df) -> bool:
    """No aggregate below the shuffle: rows whose buffers are sorted are sorted by one of the two tasks."""
    return "Aggregate" not in plan(df, "executedPlan").partition("Exchange")[2]


def test_first_existing_sorts_once(spark):
    from quarrykit.operators import pairing as P

    rows = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), ("b", "z", 3)], "k string, path string, rank int")
    made = P.first_existing(rows, "k")
    assert sorted_in_one_task(made) and {tuple(r) for r in made.collect()} == {("a", "y"), ("b", "z")}


def test_flat_pairs_sort_once(spark):
    from quarrykit.operators import datasets as DS

    rows = [("p", "before", "dir", "pd"), ("p", "before", "npz", "pn"), ("p", "after", "dir", "pa"), ("q", "before", "npz", "qb"), ("r", "after", "npz", "ra")]
    made = DS.flat_pairs(spark.createDataFrame(rows, "pair string, side string, kind string, path string"))
    assert sorted_in_one_task(made) and [tuple(r) for r in made.collect()] == [("p", "pn", "pa")]


def test_set_sizes_group_cells_once(spark):
    from quarrykit.operators import voxels as VX

    a, b = (spark.createDataFrame(rows, "obj_id string, x int, y int, z int") for rows in ([("a", 0, 0, 0), ("a", 0, 0, 0), ("a", 1, 0, 0), ("a", None, 0, 0), ("c", 1, 1, 1)], [("a", 0, 0, 0), ("a", None, 0, 0), ("b", 0, 0, 0)]))
    made = VX.set_sizes(a, b)
    assert "Join" not in plan(made)
    assert {tuple(r) for r in made.collect()} == {("a", 2, 1, 1), ("b", 0, 1, 0), ("c", 1, 0, 0)}


def test_views_of_an_object_sort_once(spark):
    rows = [("a", 0, 0.0, 0.0, 0.0, True), ("a", 1, 2.0, 0.0, 1.0, False), ("a", 2, 0.0, 2.0, 1.0, True), ("b", 4, 0.0, -2.0, 1.0, None), ("b", 3, -2.0, 0.0, 1.0, False), ("n", 7, 0.0, 0.0, 0.0, True)]
    made = G.orthogonal_views(spark.createDataFrame(rows, "obj_id string, view int, cx double, cy double, cz double, has_image boolean"))
    assert sorted_in_one_task(made) and "Expand" not in plan(made)
    got = {(r.obj_id, r.target): r.view for r in made.collect()}
    assert got == {**{("a", t): 2 for t in (0.0, 90.0, 180.0, -90.0)}, ("b", 0.0): 4, ("b", 90.0): 3, ("b", 180.0): 3, ("b", -90.0): 4, **{("n", t): 7 for t in (0.0, 90.0, 180.0, -90.0)}}


def test_split_faces_move_once(spark):
    rows = [("a", 0, 5, 9, 7), ("a", 0, 5, 9, 7), ("a", 1, 5, 6, 5), ("b", 0, -3, 100, 8), ("a", 0, 9, 11, 5)]
    made = G.split_faces(spark.createDataFrame(rows, "obj_id string, part int, a int, b int, c int"))
    assert plan(made, "executedPlan").count("Exchange") == 1 and "Window" not in plan(made)
    assert sorted(map(tuple, made.select("obj_id", "part", "a", "b", "c").collect())) == [("a", 0, 0, 2, 1), ("a", 0, 0, 2, 1), ("a", 0, 2, 3, 0), ("a", 1, 0, 1, 0), ("b", 0, 0, 2, 1)]
