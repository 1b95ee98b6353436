"""Archives of an object's views and files: read, thinned, unpacked, and pairs written out beside a manifest.

A member is an array of bytes under the file's name. Tables that write files are made once, in the shared folder, and
hold what was written; a task that runs twice writes the same files.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrykit.sharedfs import cut
from quarrykit.sources.files import put

VIEW = re.compile(r"^(\d+)\.(png|webp)$")


def _contents(spark: SparkSession, root: str, pattern: str = "*.npz") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")


def _open(content: bytes):
    return np.load(io.BytesIO(content), allow_pickle=False)


OBJECT = "path string, shard string, obj_id string, status string, part_names array<string>, views array<int>, parts array<struct<part_id:int,cluster:string,names:array<string>,cluster_size:int>>"


def _object(path: str, content: bytes) -> tuple:
    shard, name = path.rsplit("/", 2)[-2:]
    of = (path, shard, name.removesuffix(".npz"))
    try:
        with _open(content) as z:
            mesh = json.loads(z["split_mesh.json"].tobytes())
            names = mesh["part_id_to_name"]
            parts = [{"part_id": int(c.split("_")[-1]), "cluster": c, "names": [names[i] for i in info["part_ids"] if i < len(names)], "cluster_size": info["cluster_size"]} for c, info in mesh["valid_clusters"].items()]
            return *of, "ok", names, sorted(int(m[1]) for m in map(VIEW.match, z.files) if m), parts
    except Exception as e:  # noqa: BLE001 - damage of any kind is a row
        return *of, f"error: {type(e).__name__}", None, None, None


def read_objects(spark: SparkSession, root: str) -> DataFrame:
    """Objects of ``root/<shard>/<object>.npz``: named parts by cluster, and which views there are."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame([_object(p, c) for p, c in zip(b["path"], b["content"])], columns=[f.split()[0] for f in OBJECT.split(", ")])

    return _contents(spark, root).mapInPandas(run, OBJECT)


def thumbnails(spark: SparkSession, root: str, view: int = 0) -> DataFrame:
    """(path, name, data): the webp of a view, else the archive's first image; null where it has none or is broken."""

    def one(path, content):
        try:
            with _open(content) as z:
                images = [n for n in z.files if n.endswith((".webp", ".png"))]
                name = f"{view:03d}.webp" if f"{view:03d}.webp" in images else next(iter(images), None)
                return path, name, z[name].tobytes() if name else None
        except Exception:  # noqa: BLE001
            return path, None, None

    def run(batches):
        for b in batches:
            yield pd.DataFrame([one(p, c) for p, c in zip(b["path"], b["content"])], columns=["path", "name", "data"])

    return _contents(spark, root).mapInPandas(run, "path string, name string, data binary")


def slimmed(spark: SparkSession, root: str, keep: list[int], dry: bool = False) -> DataFrame:
    """Take the images of other views out of every archive, in its place: (path, old, new) bytes. Dry: nothing is written and ``new`` is in proportion to the members that stay."""
    wanted = {f"{v:03d}.{kind}" for v in keep for kind in ("png", "webp")}

    def one(path, content):
        with _open(content) as z:
            stay = [n for n in z.files if n in wanted or not n.endswith((".png", ".webp"))]
            if len(stay) == len(z.files):
                return path, len(content), len(content)
            if dry:
                return path, len(content), int(len(content) * len(stay) / len(z.files))
            out = io.BytesIO()
            np.savez_compressed(out, **{n: z[n] for n in stay})
        put(*path.rsplit("/", 1), out.getvalue())
        return path, len(content), len(out.getvalue())

    def run(batches):
        for b in batches:
            yield pd.DataFrame([one(p, c) for p, c in zip(b["path"], b["content"])], columns=["path", "old", "new"])

    return cut(_contents(spark, root).mapInPandas(run, "path string, old long, new long"), "slimmed")


def unpacked(spark: SparkSession, root: str, out: str, state: DataFrame, dry: bool = False) -> DataFrame:
    """Camera file and png views of each archive to ``out/<object>/``: (obj_id, status).

    ``state`` tells of an object (obj_id) whether its files are ``there``, whether it is ``encoded``, and whether it has ``voxels``; the first
    that stands in the way names the status. An object of no such row has none of the three."""
    files = _contents(spark, root).withColumn("obj_id", F.regexp_extract("path", "([^/]*)\\.npz$", 1))
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    status = F.when(has("there"), "skip_exists").when(has("encoded"), "skip_encoded").when(~has("voxels"), "skip_no_voxels")
    if dry:
        status = F.coalesce(status, F.lit("would_restore"))
    todo = files.join(state.select("obj_id", "there", "encoded", "voxels"), "obj_id", "left").select("obj_id", F.when(status.isNull(), F.col("content")).alias("content"), status.alias("status"))

    def one(obj_id, content, status):
        if status is not None:
            return obj_id, status
        try:
            with _open(content) as z:
                names = [n for n in z.files if n == "transforms.json" or n.endswith(".png")]
                for n in names:
                    put(f"{out}/{obj_id}", n, z[n].tobytes())
                return obj_id, f"restored_{len(names)}"
        except (ValueError, OSError, zipfile.BadZipFile):
            return obj_id, "error"

    def run(batches):
        for b in batches:
            yield pd.DataFrame([one(*r) for r in zip(b["obj_id"], b["content"], b["status"])], columns=["obj_id", "status"])

    return cut(todo.mapInPandas(run, "obj_id string, status string"), "unpacked")


def exported(records: DataFrame, blobs: DataFrame, out: str) -> DataFrame:
    """Write pairs: a mesh, views and masks for each side that has them, and the manifest as JSON lines under ``out/manifest``. The manifest comes back.

    ``blobs`` has (edit_id, side, kind, view, data), kind being ``mesh``, ``render`` or ``mask``. Paths in the manifest are relative, null where nothing was written.
    Blobs of edits without a record are not written. Where pairs share a side, leave it out and name the owner's path in the record."""
    place = F.when(F.col("kind") == "mesh", F.format_string("meshes/%s_%s.ply", "edit_id", "side")).otherwise(F.concat(F.format_string("renders/%s_%s/%03d", "edit_id", "side", F.coalesce("view", F.lit(0))), F.when(F.col("kind") == "mask", "_mask.npy").otherwise(".webp")))
    todo = blobs.where("data is not null").join(records.select("edit_id").distinct(), "edit_id", "left_semi").select("edit_id", "side", "kind", place.alias("place"), "data")

    def run(batches):
        for b in batches:
            for name, data in zip(b["place"], b["data"]):
                put(out, name, data)
            yield b[["edit_id", "side", "kind", "place"]]

    done = cut(todo.mapInPandas(run, "edit_id string, side string, kind string, place string"), "exported")
    paths = []
    for side in ("before", "after"):
        for kind, name, path in (("mesh", "mesh", F.col("place")), ("render", "renders", F.regexp_extract("place", "^(.*)/", 1))):
            paths.append(F.min(F.when((F.col("side") == side) & (F.col("kind") == kind), path)).alias(f"{side}_{name}"))
    manifest = records.join(done.groupBy("edit_id").agg(*paths), "edit_id", "left")
    manifest.write.mode("append").option("ignoreNullFields", "false").json(f"{out}/manifest")
    return manifest


def _glb(content: bytes) -> tuple:
    try:
        magic, _, _, n, kind = struct.unpack_from("<4sIIII", content)
        if magic != b"glTF" or kind != 0x4E4F534A:
            raise ValueError("no binary glTF")
        g = json.loads(content[20 : 20 + n])
        prims = [p for m in g.get("meshes", []) for p in m.get("primitives", [])]
        count = lambda i: g["accessors"][i]["count"]
        vertices = sum(count(p["attributes"]["POSITION"]) for p in prims)
        faces = sum((count(p["indices"]) if "indices" in p else count(p["attributes"]["POSITION"])) // 3 for p in prims)
        materials = g.get("materials", [])
        textured = any("baseColorTexture" in materials[p["material"]].get("pbrMetallicRoughness", {}) for p in prims if "material" in p)
        coloured = any("COLOR_0" in p["attributes"] for p in prims)
        return len(prims), faces, vertices, textured, coloured, textured or coloured, ""
    except Exception as e:  # noqa: BLE001
        return None, None, None, False, False, False, f"{type(e).__name__}: {e}"


def asset_colours(spark: SparkSession, root: str) -> DataFrame:
    """Of each binary glTF asset its size, geometries, faces and vertices, and whether it has a colour texture or vertex colours; a broken one has no colour and a reason."""
    names = ["geometries", "faces", "vertices", "has_texture", "has_vertex_color", "has_color", "reason"]

    def run(batches):
        for b in batches:
            rows = pd.DataFrame([(p, len(c), *_glb(c)) for p, c in zip(b["path"], b["content"])], columns=["path", "size", *names])
            yield rows.astype({n: "Int64" for n in names[:3]})

    return _contents(spark, root, "*.glb").mapInPandas(run, "path string, size long, geometries long, faces long, vertices long, has_texture boolean, has_vertex_color boolean, has_color boolean, reason string")
