import io
import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrykit.plans.config import Config, ConfigError, merged, pair_dir
from quarrykit.plans.slots import called, enriched, judged_by_digest, remembered
from quarrykit.plans.stages import Run, Step
from quarrykit.sources import archives, arrays, logs
from quarrykit.streaming.logs import LatestTable, append, keep_latest, per_object, stream_log


def test_arrays(spark, tmp_path):
    coords, feats = np.array([[0, 1, 2, 3], [0, 4, 5, 6]], np.int32), np.array([[0.5, 1], [2, 3]], np.float32)
    np.savez(tmp_path / "a.npz", slat_coords=coords, slat_feats=feats)
    np.savez(tmp_path / "b.npz", slat_coords=coords, slat_feats=feats, ss=np.zeros((2, 2), np.float32))
    np.savez(tmp_path / "c.npz", slat_feats=feats)
    np.savez(tmp_path / "n.npz", slat_coords=coords, slat_feats=feats * np.nan)
    (tmp_path / "d.npz").write_bytes(b"no archive")
    got = {os.path.basename(r.path): r for r in arrays.read_pairs(spark, str(tmp_path)).collect()}
    assert got["a.npz"].status == got["b.npz"].status == "ok" and got["a.npz"].ss is None and got["b.npz"].ss == [0.0] * 4
    assert got["c.npz"].reason == "missing slat_coords" and got["d.npz"].reason.startswith("unreadable") and got["n.npz"].status == "error"
    needed = {os.path.basename(r.path): r.status for r in arrays.read_pairs(spark, str(tmp_path), ss_needed=True).collect()}
    assert needed["a.npz"] == "error" and needed["b.npz"] == "ok"
    pairs = arrays.read_pairs(spark, str(tmp_path), pattern="b.npz")
    assert [(r.place, r.x, r.y, r.z, r.feat) for r in arrays.cells(pairs).orderBy("place").collect()] == [(0, 1, 2, 3, [0.5, 1.0]), (1, 4, 5, 6, [2.0, 3.0])]
    out = tmp_path / "out"
    out.mkdir()
    assert arrays.write_pairs(pairs.withColumn("name", F.lit("z")), str(out)).collect()[0].status == "ok"
    assert np.array_equal(np.load(out / "z.npz")["slat_coords"], coords)
    assert arrays.listing(spark, str(tmp_path), "*.npz").count() == 6


def test_zips_and_views(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/other.npy", b"1")
        z.writestr("x/gt_1.npy", b"2")
        z.writestr("x/gt_2.npy", b"3")
    (tmp_path / "b.zip").write_bytes(b"broken")
    got = {os.path.basename(r.path): (r.member, r.data) for r in arrays.zip_members(spark, str(tmp_path), "gt", ".npy").collect()}
    assert got == {"a.zip": ("x/gt_1.npy", bytearray(b"2")), "b.zip": (None, None)}
    np.savez(tmp_path / "v.npz", **{"000.png": np.zeros(3), "001.webp": np.zeros(3), "meta": np.zeros(1)})
    r = arrays.slimmed_members(spark, str(tmp_path), ["000"]).first()
    assert (r.views, r.kept) == (2, 1)
    images = spark.createDataFrame([("a", "000.webp", b"w"), ("a", "000.png", b"p"), ("a", "001.webp", b"q"), ("a", "x", b"")], "obj_id string, name string, data binary")
    assert {(r["view"], bytes(r.data)) for r in arrays.image_by_view(images).collect()} == {("000", b"p"), ("001", b"q")}
    faces = spark.createDataFrame([("a", 0, 4), ("a", 3, 2)], "obj_id string, face int, label int")
    assert [r.label for r in arrays.dense_labels(faces).orderBy("face").collect()] == [4, 0, 0, 2]
    _ = io


def test_text_sources(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("a\n# no\n\n  b \n")
    assert [r.edit_id for r in logs.read_ids(spark, str(tmp_path / "ids.txt")).collect()] == ["a", "b"]
    assert logs.read_ids(spark, str(tmp_path / "ids.txt"), comments=False).count() == 3
    assert logs.listed(["a,b c", "d"]) == ["a", "b", "c", "d"]
    (tmp_path / "c.json").write_text(json.dumps({"car": {"u1": ["wheel"], "u2": []}}))
    assert {(r.category, r.obj_id, tuple(r.labels)) for r in logs.read_category_labels(spark, str(tmp_path / "c.json")).collect()} == {("car", "u1", ("wheel",)), ("car", "u2", ())}
    at = tmp_path / "shard_01" / "o1"
    at.mkdir(parents=True)
    (at / "quality.json").write_text('{"tier":\n "high"}')
    assert [tuple(r) for r in logs.read_object_json(spark, str(tmp_path), "quality.json", "tier string").collect()] == [("high", "01", "o1")]
    assert logs.read_object_json(spark, str(tmp_path), "none.json", "tier string") is None
    logs.write_log(spark.createDataFrame([("b",), ("a",)], "k string"), str(tmp_path / "w"), "k")
    logs.append_log(spark.createDataFrame([("c",)], "k string"), str(tmp_path / "w"))
    assert spark.read.json(str(tmp_path / "w")).count() == 3


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = "edit_id string, status string, pos long"
    rows = [(f"e{i % 5}", "success" if i % 3 else "failed", i) for i in range(40)]
    for f in range(4):
        (src / f"{f}.json").write_text("\n".join(json.dumps(dict(zip(("edit_id", "status", "pos"), r))) for r in rows[f * 10 : f * 10 + 10]))
    table = LatestTable(spark, str(tmp_path / "t"), schema, "edit_id")
    assert table.read().count() == 0
    for _ in range(2):  # the second run has nothing new
        keep_latest(stream_log(spark, str(src), schema), table, str(tmp_path / "ck")).awaitTermination()
    want = {k: s for k, s, _ in rows}
    assert {r.edit_id: r.status for r in table.read().collect()} == want
    table.upsert(spark.createDataFrame([("e1", "old batch again", 99)], schema), 0)
    assert {r.edit_id: r.status for r in table.read().collect()} == want
    append(stream_log(spark, str(src), schema), str(tmp_path / "o"), str(tmp_path / "ck2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 40
    seen = []
    steps = [("a", lambda d: d.withColumn("status", F.col("status"))), ("b", lambda d: d)]
    per_object(stream_log(spark, str(src), schema), steps, lambda n, d, i: seen.append((n, d.count())), str(tmp_path / "ck3")).awaitTermination()
    assert sum(c for n, c in seen if n == "a") == 40 and sum(c for n, c in seen if n == "b") == sum(s == "success" for _, s, _ in rows)


def test_slots(spark):
    df = spark.createDataFrame([("a",), ("bad",)], "obj_id string")

    def client():
        def call(row):
            if row["obj_id"] == "bad":
                raise RuntimeError("no")
            return row["obj_id"].upper()

        return call

    got = {r.obj_id: (r.answer, r.status, r.reason) for r in called(df, client, wait=0.0).collect()}
    assert got == {"a": ("A", "success", ""), "bad": (None, "failed", "RuntimeError: no")}
    objects = spark.createDataFrame([("a", "00", ["wheel"]), ("b", "00", ["door"])], "obj_id string, shard string, labels array<string>")
    from quarrykit.operators.labels import by_rules

    assert enriched(objects, lambda d: by_rules(d.where("obj_id = 'a'"))).count() == 2
    assert judged_by_digest(spark.createDataFrame([("e",)], "edit_id string")).count() == 1


def test_config(monkeypatch, tmp_path):
    assert merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    monkeypatch.setenv("QK_ROOT", "data")
    c = Config({"root": "x", "n": {"k": 1}}, {"n": {"k": 2}}, env={"root": "QK_ROOT"}, paths=("root",), base=str(tmp_path))
    assert c["n.k"] == 2 and c.sources == {"root": "env:QK_ROOT", "n.k": "file"} and c["root"] == str(tmp_path / "data")
    with pytest.raises(ConfigError, match="key=root"):
        Config({"root": ""}, required=("root",))
    (tmp_path / "pairs_a").mkdir()
    assert pair_dir(str(tmp_path)) == str(tmp_path / "pairs_a")
    (tmp_path / "pairs_b").mkdir()
    assert pair_dir(str(tmp_path), "b") == str(tmp_path / "pairs_b")
    with pytest.raises(ValueError):
        pair_dir(str(tmp_path))


def test_stages(spark, tmp_path):
    def refuse(df):
        raise ValueError("bad")

    steps = [Step("a", (), lambda: spark.range(3)), Step("b", ("a",), lambda a: a.where("id > 0")), Step("c", ("b",), lambda b: b, refuse)]
    run = Run(spark, str(tmp_path), steps)
    with pytest.raises(FileNotFoundError):
        run.go(only=["b"])
    assert run.go(only=["a", "b"]) == {"a": "made", "b": "made", "c": "skipped"}
    assert run.go(only=["a"], resume=True)["a"] == "kept"
    with pytest.raises(ValueError):
        run.go(only=["c"])
    assert run.table("c").count() == 2  # written before it was checked


def test_logs_of_one_name_in_two_folders(spark, tmp_path):
    for d, rows in (("w 1", ["a", "b"]), ("w2", ["c"])):
        (tmp_path / d).mkdir()
        (tmp_path / d / "r.jsonl").write_text("".join(json.dumps({"edit_id": i}) + "\n" for i in rows))
    got = logs.read_log(spark, [str(tmp_path / d / "r.jsonl") for d in ("w2", "w 1", "none")], "edit_id string").orderBy("pos").collect()
    assert [(r.edit_id, r.file, r.line) for r in got] == [("c", "r.jsonl", 1), ("a", "r.jsonl", 1), ("b", "r.jsonl", 2)] and len({r.pos for r in got}) == 3


def _views(path, **more):
    raw = lambda b: np.frombuffer(b, np.uint8)
    mesh = {"part_id_to_name": ["leg", "seat"], "valid_clusters": {"c_1": {"part_ids": [1, 9], "cluster_size": 4}, "c_0": {"part_ids": [0], "cluster_size": 2}}}
    np.savez(path, **{"split_mesh.json": raw(json.dumps(mesh).encode()), "transforms.json": raw(b"{}"), "008.png": raw(b"p8"), "002.webp": raw(b"w2"), **more})


def test_archives(spark, tmp_path):
    at = tmp_path / "s" / "03"
    at.mkdir(parents=True)
    _views(at / "o.npz")
    _views(at / "p.npz", **{"000.webp": np.frombuffer(b"w0", np.uint8)})
    (at / "bad.npz").write_bytes(b"x")
    got = {r.obj_id: r for r in archives.read_objects(spark, str(tmp_path / "s")).collect()}
    assert (got["o"].shard, got["o"].views, got["p"].views, got["bad"].views) == ("03", [2, 8], [0, 2, 8], None) and got["bad"].status.startswith("error")
    assert [(p.part_id, p.cluster, p.names, p.cluster_size) for p in got["o"].parts] == [(1, "c_1", ["seat"], 4), (0, "c_0", ["leg"], 2)]
    small = {os.path.basename(r.path): (r.name, r.data) for r in archives.thumbnails(spark, str(tmp_path / "s")).collect()}
    assert small == {"o.npz": ("008.png", bytearray(b"p8")), "p.npz": ("000.webp", bytearray(b"w0")), "bad.npz": (None, None)}
    state = spark.createDataFrame([("o", False, False, True), ("p", False, True, True), ("bad", False, False, True)], "obj_id string, there boolean, encoded boolean, voxels boolean")
    out = tmp_path / "out"
    assert {tuple(r) for r in archives.unpacked(spark, str(tmp_path / "s"), str(out), state, dry=True).collect()} == {("o", "would_restore"), ("p", "skip_encoded"), ("bad", "would_restore")}
    assert not out.exists()
    assert {tuple(r) for r in archives.unpacked(spark, str(tmp_path / "s"), str(out), state).collect()} == {("o", "restored_2"), ("p", "skip_encoded"), ("bad", "error")}
    assert sorted(os.listdir(out / "o")) == ["008.png", "transforms.json"] and (out / "o" / "008.png").read_bytes() == b"p8"
    (at / "bad.npz").unlink()
    dry = {os.path.basename(r.path): (r.old, r.new) for r in archives.slimmed(spark, str(tmp_path / "s"), [8], dry=True).collect()}
    assert dry["o.npz"][1] == int(dry["o.npz"][0] * 3 / 4) and dry["o.npz"][0] == (at / "o.npz").stat().st_size
    archives.slimmed(spark, str(tmp_path / "s"), [8])
    with np.load(at / "p.npz") as z:
        assert sorted(z.files) == ["008.png", "split_mesh.json", "transforms.json"] and z["008.png"].tobytes() == b"p8"
    again = archives.slimmed(spark, str(tmp_path / "s"), [8]).collect()
    assert all(r.old == r.new for r in again) and len(again) == 2


def test_exported_pairs(spark, tmp_path):
    records = spark.createDataFrame([("e1", "deletion"), ("e2", "scale")], "edit_id string, edit_type string")
    blobs = spark.createDataFrame([("e1", "before", "mesh", None, b"m"), ("e1", "after", "render", 7, b"i"), ("e1", "before", "mask", 7, b"k"), ("e9", "after", "mesh", None, b"z"), ("e2", "after", "mesh", None, None)], "edit_id string, side string, kind string, view int, data binary")
    got = {r.edit_id: r for r in archives.exported(records, blobs, f"file://{tmp_path}/x").collect()}
    assert (got["e1"].before_mesh, got["e1"].after_mesh, got["e1"].before_renders, got["e1"].after_renders) == ("meshes/e1_before.ply", None, None, "renders/e1_after") and got["e2"].after_mesh is None
    assert (tmp_path / "x/renders/e1_after/007.webp").read_bytes() == b"i" and (tmp_path / "x/renders/e1_before/007_mask.npy").read_bytes() == b"k" and os.listdir(tmp_path / "x/meshes") == ["e1_before.ply"]
    assert '"before_mesh":null' in "".join(p.read_text() for p in (tmp_path / "x/manifest").glob("*.json"))


def test_asset_colours(spark, tmp_path):
    def glb(g):
        body = json.dumps(g).encode()
        body += b" " * (-len(body) % 4)
        return b"glTF" + (2).to_bytes(4, "little") + (20 + len(body)).to_bytes(4, "little") + len(body).to_bytes(4, "little") + b"JSON" + body

    plain = {"accessors": [{"count": 8}, {"count": 36}], "materials": [{"pbrMetallicRoughness": {}}], "meshes": [{"primitives": [{"attributes": {"POSITION": 0}, "indices": 1, "material": 0}]}]}
    (tmp_path / "a.glb").write_bytes(glb(plain))
    (tmp_path / "b.glb").write_bytes(glb({**plain, "materials": [{"pbrMetallicRoughness": {"baseColorTexture": {"index": 0}}}]}))
    (tmp_path / "c.glb").write_bytes(glb({**plain, "meshes": [{"primitives": [{"attributes": {"POSITION": 1, "COLOR_0": 1}}]}]}))
    (tmp_path / "d.glb").write_bytes(b"nothing")
    got = {os.path.basename(r.path): (r.geometries, r.faces, r.vertices, r.has_texture, r.has_vertex_color, r.has_color) for r in archives.asset_colours(spark, str(tmp_path)).collect()}
    assert got == {"a.glb": (1, 12, 8, False, False, False), "b.glb": (1, 12, 8, True, False, True), "c.glb": (1, 12, 36, False, True, True), "d.glb": (None, None, None, False, False, False)}


def test_remembered_results(spark, tmp_path):
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "edit_id string")
    made = lambda df: df.withColumn("status", F.when(F.col("edit_id") == "b", "failed").otherwise("success"))
    path = str(tmp_path / "cache")
    assert remembered(todo.where("edit_id <> 'c'"), made, path).count() == 2
    again = remembered(todo, lambda df: df.withColumn("status", F.lit("success")).withColumn("edit_id", F.col("edit_id")), path)
    assert sorted(map(tuple, again.collect())) == [("a", "success"), ("b", "success"), ("c", "success")]
    assert spark.read.parquet(path).count() == 4 and remembered(todo, made, path).count() == 3


def test_latest_table_writes_the_buckets_it_touches(spark, tmp_path):
    table = LatestTable(spark, str(tmp_path / "t"), "k string, pos long", "k", buckets=8)
    rows = lambda *r: spark.createDataFrame(r, "k string, pos long")
    table.upsert(rows(*[(f"k{i}", i) for i in range(50)]), 0)
    table.upsert(rows(("k3", 100), ("k4", 1), ("", 5)), 1)
    table.upsert(rows(("k3", 7)), 1)  # run again: its version stands
    table.upsert(spark.createDataFrame([], "k string, pos long"), 2)
    got = {r.k: r.pos for r in table.read().collect()}
    assert got == {**{f"k{i}": i for i in range(50)}, "k3": 100}
    assert 1 <= len(list((tmp_path / "t/v=1").glob("bucket=*"))) <= 2
    table.upsert(rows(("k3", 200)), 3)
    assert {r.k: r.pos for r in table.read().where("k = 'k3'").collect()} == {"k3": 200} and table.read().count() == 50
