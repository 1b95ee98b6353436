"""Array archives, listings and zip members as tables.

An archive is decoded where it lies, one task for some files; a broken one is a row with a
reason and fails nothing.
"""

from __future__ import annotations

import fnmatch
import io
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrykit.sources.files import put

PAIR = "path string, status string, reason string, n int, coords array<array<int>>, feats array<array<float>>, ss array<float>"


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified) of files under a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Objects that two listings with shard and obj_id share, in order: the index of a dataset."""
    return a.select("shard", "obj_id").distinct().join(b.select("shard", "obj_id").distinct(), ["shard", "obj_id"], "left_semi").orderBy("shard", "obj_id")


def _pair(path: str, data: bytes, ss_needed: bool) -> tuple:
    try:
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            lacking = [k for k in ("slat_feats", "slat_coords", *(["ss"] if ss_needed else [])) if k not in z]
            if lacking:
                return path, "error", "missing " + ", ".join(lacking), None, None, None, None
            feats, coords = z["slat_feats"], z["slat_coords"]
            ss = z["ss"].ravel().astype(np.float32).tolist() if "ss" in z else None
    except Exception as e:  # noqa: BLE001 - an archive of any kind of damage becomes a row
        return path, "error", f"unreadable: {type(e).__name__}", None, None, None, None
    if len(feats) != len(coords):
        return path, "error", "row counts differ", None, None, None, None
    if not np.isfinite(feats).all():
        return path, "error", "values that are not finite", None, None, None, None
    return path, "ok", "", len(coords), coords.astype(np.int32).tolist(), feats.astype(np.float32).tolist(), ss


def read_pairs(spark: SparkSession, root: str, ss_needed: bool = False, pattern: str = "*.npz") -> DataFrame:
    """Arrays of each archive: coordinates and features by row, the dense latent flat; status and reason where they lack or are broken."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")

    def run(batches):
        for b in batches:
            yield pd.DataFrame([_pair(p, c, ss_needed) for p, c in zip(b["path"], b["content"])], columns=["path", "status", "reason", "n", "coords", "feats", "ss"]).astype({"n": "Int32"})

    return files.mapInPandas(run, PAIR)


def cells(pairs: DataFrame) -> DataFrame:
    """(path, place, batch, x, y, z, feat): one row for each voxel, in the archive's order."""
    both = pairs.where("status = 'ok'").select("path", F.posexplode(F.arrays_zip("coords", "feats")).alias("place", "v"))
    at = lambda i: F.element_at("v.coords", i + 1)
    return both.select("path", "place", at(0).alias("batch"), at(1).alias("x"), at(2).alias("y"), at(3).alias("z"), F.col("v.feats").alias("feat"))


def write_pairs(df: DataFrame, folder: str) -> DataFrame:
    """Write each row's arrays as ``<name>.npz`` under a folder that all executors share; (name, status) rows come back when it runs."""

    def run(batches):
        for b in batches:
            out = []
            for name, coords, feats, ss in zip(b["name"], b["coords"], b["feats"], b["ss"]):
                arrays = {"slat_coords": np.stack(coords).astype(np.int32) if len(coords) else np.empty((0, 4), np.int32), "slat_feats": np.stack(feats).astype(np.float32) if len(feats) else np.empty((0, 0), np.float32)}
                if ss is not None:
                    arrays["ss"] = np.array(ss, np.float32)
                data = io.BytesIO()
                np.savez_compressed(data, **arrays)
                put(folder, f"{name}.npz", data.getvalue())
                out.append((name, "ok"))
            yield pd.DataFrame(out, columns=["name", "status"])

    return df.select("name", "coords", "feats", "ss").mapInPandas(run, "name string, status string")


def zip_members(spark: SparkSession, root: str, part: str, suffix: str) -> DataFrame:
    """(path, member, data): the first member of each zip whose name has ``part`` and ends in ``suffix``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(root).select("path", "content")

    def run(batches):
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        hit = next((n for n in z.namelist() if part in n and n.endswith(suffix)), None)
                        out.append((path, hit, z.read(hit) if hit else None))
                except zipfile.BadZipFile:
                    out.append((path, None, None))
            yield pd.DataFrame(out, columns=["path", "member", "data"])

    return files.mapInPandas(run, "path string, member string, data binary")


def slimmed_members(spark: SparkSession, root: str, keep: list[str]) -> DataFrame:
    """(path, size, views, kept) of view archives: how many image members there are, and how many of them are kept."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz").load(root).select("path", "length", "content")

    def run(batches):
        for b in batches:
            out = []
            for path, n, content in zip(b["path"], b["length"], b["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    views = [m.removesuffix(".npy") for m in z.namelist() if fnmatch.fnmatch(m, "[0-9]*.png*") or fnmatch.fnmatch(m, "[0-9]*.webp*")]
                out.append((path, n, len(views), len([v for v in views if v.split(".")[0] in keep])))
            yield pd.DataFrame(out, columns=["path", "size", "views", "kept"])

    return files.mapInPandas(run, "path string, size long, views int, kept int")


def dense_labels(faces: DataFrame, key: str = "obj_id") -> DataFrame:
    """Face labels for every face from 0 to the last, gaps filled with 0."""
    ends = faces.groupBy(key).agg(F.max("face").alias("last"))
    every = ends.select(key, F.explode(F.sequence(F.lit(0), F.col("last"))).alias("face"))
    return every.join(faces.select(key, "face", "label"), [key, "face"], "left").select(key, "face", F.coalesce("label", F.lit(0)).alias("label"))


def image_by_view(images: DataFrame, key: str = "obj_id") -> DataFrame:
    """(key, view, data): the png of a view, else its webp."""
    view = F.regexp_extract("name", "^(\\d+)\\.(png|webp)$", 1)
    kind = F.regexp_extract("name", "^(\\d+)\\.(png|webp)$", 2)
    rows = images.withColumns({"view": view, "kind": kind}).where("view <> ''")
    return rows.groupBy(key, "view").agg(F.min_by("data", "kind").alias("data"))
