"""Near duplicates: circulant MinHash, banding, exact Jaccard.

A text's shingles are its distinct runs of three words (lower case, letters
and digits). Two fixed permutations of 2**20 places make the whole signature:
the first places a shingle, the second, shifted by k, gives coordinate k.
The K values of one place lie side by side in the second permutation, so a
signature is a running minimum over rows of one table.

1. Rows with the same text are one node (the text's 128-bit digest). Each task signs a text it
   meets again only once, for as long as it remembers it, and signatures are merged by digest.
2. Signatures are cut into bands; nodes that agree on a band share a bucket.
3. Each node is held against one node of its buckets by the exact Jaccard index of the shingle sets: the one that meets
   most others in its own buckets, so the middle of a cluster and not one at its edge, which few would match. Those that pass form components.
4. In buckets that still hold more than one component every pair across
   components that can pass is verified too: all pairs in a bucket of at most ``FEW`` nodes; in larger
   ones those that share a rare shingle. (Of two sets with Jaccard index t or more, some shingle stands both among the first
   n - ceil(2tn/(1+t)) + 1 of the smaller and among the first n - ceil(tn) + 1 of the larger, in one order of all shingles, here
   from rare to frequent; so texts with a frequent part in common and an index below t do not meet.) Both ways verify
   all pairs of a bucket that pass, so the size of a bucket changes nothing. Pairs inside a component are already joined.
5. Components of all verified pairs are the groups; the least doc_id stays.

Nothing is broadcast. The text is shuffled once, for the sets of bucketed
nodes only after the join; all else moves digests, ids and band hashes. Minima and counts of buckets and groups are
aggregates that combine before the shuffle and are joined back, so a bucket or group of any size is split by the adaptive skew join.

Defined results: null texts and texts without a word are in no group. Texts of
fewer than three words have one shingle. Repeated rows are exact copies and one
of them stays. doc_ids keep their type; a null one sorts after all others. Other columns are carried
where rows are returned, whatever their names, but for ones that begin with
``__near_``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.llm.graph import components
from quarrykit.llm.words import fold_words, grams, hash_words, mix, text_shingles, trimmed
from quarrykit.sharedfs import cut, drop

SHINGLE, BANDS, ROWS, THRESHOLD = 3, 32, 5, 0.6
PLACES = 1 << 20
BLOCK = 8192
#: Nodes of a bucket whose pairs are listed; texts that a task remembers.
FEW, REMEMBERED = 8, 200_000
_TABLES: dict = {}


def _tables(k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation; and rows of the second: row p has the values of place p under k successive shifts."""
    if k not in _TABLES:
        rng = np.random.default_rng(20240607)
        first = rng.permutation(PLACES).astype(np.int32)
        second = rng.permutation(PLACES).astype(np.int32)
        _TABLES[k] = first, np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[:k]]), k)
    return _TABLES[k]


def signatures(sets: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """One signature for each run of ``sets`` that begins at ``starts``; no run is empty."""
    first, shifted = _tables(k)
    at = first[(sets & np.uint64(PLACES - 1)).astype(np.int64)]
    sig = np.full((len(starts), k), PLACES, np.int32)
    for lo in range(0, len(at), BLOCK):
        hi = min(lo + BLOCK, len(at))
        d0, d1 = np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, hi, "left")
        low = np.minimum.reduceat(shifted[at[lo:hi]], np.maximum(starts[d0:d1], lo) - lo, axis=0)
        np.minimum(sig[d0:d1], low, out=sig[d0:d1])
    return sig


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    h = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    parts = sig.reshape(len(sig), bands, rows).astype(np.uint64)
    for r in range(rows):
        h = mix(h + parts[:, :, r])
    return h.view(np.int64)


def _banded(bands: int, rows: int):
    def run(batches):
        met: set[bytes] = set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                words, starts, has, total = [], [], [], 0
                for key, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    w = fold_words(t) if t and key not in met else []
                    if w:
                        met.add(key)
                        if len(met) > REMEMBERED:
                            met.clear()
                    has.append(bool(w))
                    if w:
                        w += [""] * (SHINGLE - len(w))
                        starts.append(total)
                        total += len(w)
                        words += w
                if not total:
                    continue
                # shingles of all texts at once, without those that run over a text's end
                g = grams(hash_words(words), SHINGLE)
                starts = np.array(starts)
                inside = np.ones(total, bool)
                ends = np.append(starts[1:], total)
                for k in range(1, SHINGLE):
                    inside[ends - k] = False
                g = g[inside[: len(g)]]
                starts = starts - (SHINGLE - 1) * np.arange(len(starts))
                h = band_hashes(signatures(g, starts, bands * rows), bands, rows)
                keep = part.filter(pa.array(has))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(h) + 1) * bands, pa.int32()), pa.array(h.ravel()))
                yield pa.RecordBatch.from_arrays([keep.column(0), lists], names=["key", "bands"])

    return run


def _sets(batches):
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            made = [text_shingles(t, SHINGLE).view(np.int64) for t in part.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(m) for m in made])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(made)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["node", "shingles"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.unhex(F.md5(text)).alias("key"), F.col(id_col).alias("doc_id"), text.alias("text"))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of ``pairs`` whose shingle sets have at least that Jaccard index."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", shared.alias("n"), (F.size("sa") + F.size("sb")).alias("m")).where(F.col("n") >= F.lit(threshold) * (F.col("m") - F.col("n"))).select("a", "b")


def _with_ends(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``rows`` (key, ..., value) of keys that hold more than one value, with the least of them and the number of rows."""
    ends = rows.groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("n")).where("lo <> hi").select(key, "lo", "n")
    return rows.join(ends, key)


def towards_middles(shared: DataFrame) -> DataFrame:
    """(a, b), a > b: each node of ``shared`` (h, node, n) with the one of its buckets that meets most others; ties go to the least node."""
    met = shared.groupBy("node").agg((-F.sum("n")).alias("met"))
    ranked = shared.join(met, "node").select("h", F.struct("met", "node").alias("rank"))
    best = ranked.groupBy("h").agg(F.min("rank").alias("best"))
    to = ranked.join(best, "h").groupBy("rank.node").agg(F.min("best").alias("best")).select("node", F.col("best.node").alias("to")).where("node <> to")
    return to.select(F.greatest("node", "to").alias("a"), F.least("node", "to").alias("b"))


def rare_pairs(members: DataFrame, sets: DataFrame, bands: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of ``members`` (node, root) of different roots that share a band and may have that Jaccard index: they share a shingle of their rare ends."""
    own = sets.join(members, "node").withColumn("size", F.size("shingles"))
    long = own.select("node", F.explode("shingles").alias("s"))
    often = long.groupBy("s").agg(F.count("*").alias("f"))
    order = long.join(often, "s").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("f", "s"))).alias("o"))
    length = lambda least: F.col("size") - F.ceil(F.col("size") * F.lit(least) - F.lit(1e-9)).cast("int") + 1
    ends = cut(own.select("node", "root", "size").join(order, "node").withColumn("o", F.transform(F.slice("o", 1, length(threshold)), lambda x: x["s"])).withColumn("k", length(2 * threshold / (1 + threshold))), "ends")
    one = ends.select("node", "root", "size", F.explode(F.slice("o", 1, F.col("k"))).alias("s")).alias("x")
    two = ends.select("node", "root", "size", F.explode("o").alias("s")).alias("y")
    fit = (F.col("x.s") == F.col("y.s")) & (F.struct("x.size", "x.node") < F.struct("y.size", "y.node")) & (F.col("x.size") >= F.lit(threshold - 1e-9) * F.col("y.size")) & (F.col("x.root") != F.col("y.root"))
    found = one.join(two, fit).select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
    with_bands = found.join(bands.select(F.col("node").alias("a"), F.col("bands").alias("ba")), "a").join(bands.select(F.col("node").alias("b"), F.col("bands").alias("bb")), "b")
    return with_bands.where(F.arrays_overlap("ba", "bb")).select("a", "b")


def near_groups(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text", few: int = FEW) -> DataFrame:
    """(key, root) for each distinct text that has a word: texts with one root are near copies."""
    base = _keyed(docs, id_col, text_col).where("text is not null").select("key", "text")
    signed = base.mapInArrow(trimmed(_banded(bands, rows)), "key binary, bands array<bigint>")
    nodes = cut(signed.groupBy("key").agg(F.first("bands").alias("bands")).select(F.monotonically_increasing_id().alias("node"), "key", "bands"), "nodes")
    shared = cut(_with_ends(nodes.select(F.explode("bands").alias("h"), "node"), "h", "node").select("h", "node", "n"), "buckets")
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "key")
    texts = base.join(wanted, "key").groupBy("key", "node").agg(F.first("text").alias("text")).select("node", "text")
    sets = cut(texts.mapInArrow(trimmed(_sets), "node long, shingles array<bigint>"), "sets")
    # each node against the middle of its buckets
    tried = cut(towards_middles(shared), "tried")
    held = cut(verified(tried, sets, threshold), "held")
    part = components(held)
    # what the buckets still hold across components
    placed = shared.select("h", "node").join(part, "node", "left").select("h", "node", F.coalesce("root", "node").alias("root"))
    mixed = cut(_with_ends(placed, "h", "root").select("h", "node", "root", "n"), "mixed")
    one, two = mixed.where(F.col("n") <= few).alias("x"), mixed.where(F.col("n") <= few).alias("y")
    across = one.join(two, (F.col("x.h") == F.col("y.h")) & (F.col("x.node") > F.col("y.node")) & (F.col("x.root") != F.col("y.root"))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    large = mixed.where(F.col("n") > few).select("node", "root").distinct()
    if not large.isEmpty():
        across = across.unionByName(rare_pairs(large, sets, nodes, threshold))
    more = verified(across.distinct().join(tried, ["a", "b"], "left_anti"), sets, threshold)
    root = components(held.unionByName(more))
    drop(shared, sets, tried, held, mixed)
    return nodes.select("node", "key").join(root, "node", "left").select("key", F.coalesce("root", "node").alias("root"))


def _stays(keys: DataFrame, *more: str):
    """(root, n, the row that stays) of ``keys`` (root, doc_id, key)."""
    return keys.groupBy("root").agg(F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", *more)).alias("stays"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """(doc_id, group_id, keep) for every row that has an exact or near copy. ``group_id`` is the group's least doc_id."""
    groups = near_groups(docs, threshold, id_col=id_col, text_col=text_col, **more)
    keyed = _keyed(docs, id_col, text_col).where("text is not null").select("key", "doc_id")
    rows = cut(keyed.join(groups, "key").select("root", "doc_id", "key", F.monotonically_increasing_id().alias("row")), "rows")
    ends = _stays(rows, "row").where("n > 1").select("root", F.col("stays.doc_id").alias("group_id"), F.col("stays.row").alias("stays"))
    return rows.join(ends, "root").select("doc_id", "group_id", (F.col("row") == F.col("stays")).alias("keep"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of ``docs``, of each group the one with the least doc_id, with all their columns."""
    groups = cut(near_groups(docs, threshold, id_col=id_col, text_col=text_col, **more), "groups")
    keys = _keyed(docs, id_col, text_col).where("text is not null").select("key", "doc_id").join(groups, "key")
    stays = _stays(keys).select(F.col("stays.key").alias("__near_key"), F.col("stays.doc_id").alias("__near_id"))
    text = F.col(text_col).cast("string")
    tagged = docs.withColumn("__near_key", F.unhex(F.md5(text)))
    kept = tagged.where(text.isNotNull()).join(stays, "__near_key").where(F.col(id_col).eqNullSafe(F.col("__near_id")))
    kept = kept.withColumn("__near_n", F.row_number().over(W.partitionBy("__near_key").orderBy(id_col))).where("__near_n = 1")
    # texts without a word are in no group; few others lack what the first test looks for
    plain = tagged.where(text.isNotNull() & ~text.rlike("[\\p{L}\\p{N}_]")).join(groups.select(F.col("key").alias("__near_key")), "__near_key", "left_anti")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return kept.select(*names).unionByName(plain.select(*names)).unionByName(docs.where(text.isNull()))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_minhash": op6_minhash}
ORACLE: dict[str, str] = {}
