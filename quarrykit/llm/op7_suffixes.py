"""Exact repeats of at least ``LEAST`` words, by bucket-pointer refinement.

A suffix starts at each word of each text. It lies first in the bucket of its q-gram
(``Q`` words), and a bucket is refined by sorting its suffixes on the bucket
identifiers of the suffixes q words further on, then 2q words further on, and
so on; refined identifiers replace the old ones at once, so each pass doubles
the depth by reusing the last. At depth ``LEAST`` suffixes with one identifier
begin with the same words. A bucket of one suffix is in place and is not sorted again.

Over a corpus:

1. Of the q-grams in each window of ``LEAST`` words, that with the least hash
   is an anchor. The same window has the same anchor wherever it stands, so
   equal windows always share an anchor's bucket; about one suffix in 16 moves.
2. Buckets in which one suffix, or one text, stands alone are dropped.
3. Each anchor left takes along the words around it that windows on it can
   reach (30 before, 50 from it on), to the partition of its bucket.
4. There, buckets are refined to depth ``LEAST`` for the 31 starts from which a
   window can reach the anchor; starts in one bucket at that depth whose texts
   differ are repeats. A bucket of more than ``LARGE`` anchors fits no task: it is split
   at once into the buckets of its starts at that depth, whose least and greatest text are aggregated before they move.
5. Repeated windows are merged into spans, text by text.

Rows with one text are one unit; where a text has several rows, all of it
repeats (if it has ``LEAST`` words). Texts move once, for those with anchors left in step 3.

Words are runs of characters other than ASCII whitespace, compared as they
are. Defined results: null, empty and shorter texts have no span. Repeats
within one text alone do not count. A repeated row has its spans again; a
null doc_id is carried. Other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.llm.words import grams, hash_words, trimmed
from quarrykit.sharedfs import cut

LEAST, Q = 50, 20
BEFORE = LEAST - Q  # words before an anchor that its windows can reach
WIDTH = BEFORE + LEAST
FIRST = 7  # words of the initial buckets within a partition
BATCH = 20_000  # contexts that are refined together, when their buckets are complete
LARGE = 20_000  # anchors of a bucket that one task refines


def anchors(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, q-gram hashes) of the anchors of one text."""
    if len(ids) < LEAST:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = grams(ids, Q)
    least = np.lib.stride_tricks.sliding_window_view(h, BEFORE + 1).argmin(axis=1)
    at = np.unique(least + np.arange(len(least)))
    return at, h[at]


def _find(batches):
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            part = b.slice(lo, 256)
            rows, where, which = [], [], []
            for i, t in enumerate(part.column(1).to_pylist()):
                at, h = anchors(hash_words(t.split()))
                if len(at):
                    rows.append(np.full(len(at), i))
                    where.append(at)
                    which.append(h)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(where).astype(np.int32)), pa.array(np.concatenate(which).view(np.int64))],
                    names=["key", "pos", "bucket"],
                )


def _around(batches):
    """Anchors with their words: (bucket, key, pos, before, words, large), ``before`` of them ahead of the anchor."""
    for b in batches:
        for lo in range(0, b.num_rows, 128):
            part = b.slice(lo, 128)
            rows, pos, bucket, before, words, large = [], [], [], [], [], []
            for i, (t, found) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                ids = hash_words(t.split()).astype(np.uint32)
                for hit in {(f["pos"], f["bucket"], f["large"]) for f in found}:
                    p = hit[0]
                    s = max(0, p - BEFORE)
                    rows.append(i)
                    pos.append(p)
                    bucket.append(hit[1])
                    large.append(hit[2])
                    before.append(p - s)
                    words.append(ids[s : p + LEAST].tobytes())
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int64()), part.column(0).take(pa.array(rows)), pa.array(pos, pa.int32()), pa.array(before, pa.int32()), pa.array(words, pa.binary()), pa.array(large, pa.bool_())],
                    names=["bucket", "key", "pos", "before", "words", "large"],
                )


def _rank(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def refine(words: np.ndarray, group: np.ndarray, depth: int, starts: int) -> np.ndarray:
    """Bucket identifiers at ``depth`` words for the suffixes that begin in the first ``starts`` columns of each row of ``words``.

    Only suffixes of one ``group`` and column are held against each other. Identifiers are equal if and
    only if the suffixes agree on ``depth`` words.
    """
    n, width = words.shape
    # initial buckets: FIRST words, hashed, and the group and column
    reach = width - FIRST + 1
    h = np.zeros((n, reach), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(FIRST):
            h = (h + words[:, k : k + reach].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        h += (group.astype(np.uint64)[:, None] * np.uint64(1 << 10) + np.arange(reach, dtype=np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    ptr = _rank(h.ravel()).reshape(n, reach)
    known = FIRST
    while known < depth:
        step = min(known, depth - known)  # known + step words after this pass; the overlap agrees by itself
        left = ptr[:, : ptr.shape[1] - step]
        size = np.bincount(ptr.ravel())
        alone = size[left] == 1
        # sort only buckets that hold more than one suffix, on the pointers ``step`` words further on
        pair = left.astype(np.int64) * (ptr.max() + 1) + ptr[:, step:]
        made = np.empty(left.shape, np.int64)
        open_ = ~alone
        made[open_] = _rank(pair[open_])
        made[alone] = np.arange(int(alone.sum())) + n * width
        ptr = _rank(made.ravel()).reshape(made.shape) if known + step < depth else made
        known += step
    return ptr[:, :starts]


def _table(before: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(words around each anchor, which of those places are in the text), the anchor at column BEFORE."""
    table = np.zeros((len(words), WIDTH), np.uint32)
    valid = np.zeros((len(words), WIDTH), bool)
    for i, (b, w) in enumerate(zip(before, words)):
        a = np.frombuffer(w, np.uint32)
        table[i, BEFORE - b : BEFORE - b + len(a)] = a
        valid[i, BEFORE - b : BEFORE - b + len(a)] = True
    return table, valid


def _starts(batches):
    """(key, start, c, d) of every window that can reach an anchor, (c, d) being the identifier of its words."""
    for b in batches:
        for lo in range(0, b.num_rows, 2_000):
            part = b.slice(lo, 2_000)
            table, valid = _table(part.column(3).to_numpy(), part.column(4).to_pylist())
            codes = []
            for mult in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
                h = np.zeros((len(table), BEFORE + 1), np.uint64)
                with np.errstate(over="ignore"):
                    for k in range(LEAST):
                        h = (h + table[:, k : k + BEFORE + 1].astype(np.uint64) + np.uint64(1)) * np.uint64(mult)
                        h ^= h >> np.uint64(31)
                codes.append(h)
            i, j = np.nonzero(valid[:, : BEFORE + 1] & valid[:, LEAST - 1 : LEAST + BEFORE])
            at = part.column(2).to_numpy()[i] - BEFORE + j
            yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(i)), pa.array(at.astype(np.int32)), *[pa.array(h[i, j].view(np.int64)) for h in codes]], names=["key", "start", "c", "d"])


def repeats(bucket: np.ndarray, key: np.ndarray, before: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(has a repeat, first start, last start) for each anchor, as columns 0..BEFORE, the anchor at BEFORE."""
    table, valid = _table(before, words)
    # places outside the text: no two agree
    table[~valid] = np.arange(int((~valid).sum()), dtype=np.uint32)
    ids = refine(table, bucket, LEAST, BEFORE + 1)
    whole = valid[:, : BEFORE + 1] & valid[:, LEAST - 1 : LEAST + BEFORE]
    flat, owner = ids[whole], np.broadcast_to(key[:, None], ids.shape)[whole]
    code = _rank(flat)
    lo, hi = np.full(code.max() + 1 if len(code) else 0, np.iinfo(np.int64).max), np.full(code.max() + 1 if len(code) else 0, -1)
    np.minimum.at(lo, code, owner)
    np.maximum.at(hi, code, owner)
    hit = np.zeros(ids.shape, bool)
    hit[whole] = (lo != hi)[code]
    return hit.any(axis=1), hit.argmax(axis=1), BEFORE - hit[:, ::-1].argmax(axis=1)


def _refined(batches):
    """Sorted by bucket in; (key, start, end) out. A bucket is always refined whole."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BATCH:
            t = pa.Table.from_batches(held).combine_chunks()
            bucket = t["bucket"].to_numpy()
            cut_at = int(np.searchsorted(bucket, bucket[-1]))
            if cut_at:
                yield from _spans(t.slice(0, cut_at))
            held = t.slice(cut_at).combine_chunks().to_batches()
            rows = t.num_rows - cut_at
    if rows:
        yield from _spans(pa.Table.from_batches(held).combine_chunks())


def _spans(t: pa.Table):
    bucket, pos = t["bucket"].to_numpy(), t["pos"].to_numpy()
    codes = t["key"].combine_chunks().dictionary_encode()
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy().astype(np.int64)
    # whole buckets, about BATCH rows at a time
    edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    at = 0
    while at < len(edges) - 1:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + BATCH, "right")) - 1)
        lo, hi = int(edges[at]), int(edges[to])
        at = to
        part = t.slice(lo, hi - lo)
        has, first, last = repeats(_rank(bucket[lo:hi]), codes[lo:hi], part["before"].to_numpy(), part["words"].to_pylist())
        k = np.flatnonzero(has)
        if len(k):
            p = pos[lo:hi][k]
            for made in pa.table({"key": part["key"].take(pa.array(k)), "start": pa.array((p - BEFORE + first[k]).astype(np.int32)), "end": pa.array((p - BEFORE + last[k] + LEAST).astype(np.int32))}).to_batches():
                yield made


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE) -> DataFrame:
    """(doc_id, start_word, end_word) of each row's spans, words counted from 0, the end excluded: every window of ``LEAST`` words inside the union of
    spans that stands in at least two rows is in one; touching windows are one span."""
    text = F.col(text_col).cast("string")
    base = docs.select(F.unhex(F.md5(text)).alias("key"), F.col(id_col).alias("doc_id"), text.alias("text")).where("text is not null")
    found = cut(base.select("key", F.col("text").cast("binary").alias("text")).mapInArrow(trimmed(_find), "key binary, pos int, bucket bigint").distinct(), "anchors")
    # aggregated before they move and joined back, so that no task sees a whole bucket
    buckets = cut(found.groupBy("bucket").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("bucket", (F.col("n") > large).alias("large")), "buckets")
    by_text = cut(found.join(buckets, "bucket").groupBy("key").agg(F.collect_list(F.struct("pos", "bucket", "large")).alias("found")), "found")
    texts = base.select("key", "text").join(by_text.select("key"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")).join(by_text, "key")
    around = texts.select("key", F.col("text").cast("binary").alias("text"), "found").mapInArrow(trimmed(_around), "bucket bigint, key binary, pos int, before int, words binary, large boolean")
    spans = []
    if not buckets.where("large").isEmpty():
        around = cut(around, "around")
        starts = cut(around.where("large").mapInArrow(trimmed(_starts), "key binary, start int, c bigint, d bigint").distinct(), "starts")
        shared = starts.groupBy("c", "d").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("c", "d")
        spans.append(starts.join(shared, ["c", "d"], "left_semi").select("key", "start", (F.col("start") + LEAST).alias("end")))
    spans.append(around.where("not large").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(trimmed(_refined), "key binary, start int, end int"))
    rows = base.select("key", "doc_id", F.regexp_count("text", F.lit("[^ \t\n\r\f\x0b]+")).alias("n"))
    copied = rows.groupBy("key").agg(F.count("*").alias("copies"), F.first("n").alias("n")).where((F.col("copies") > 1) & (F.col("n") >= LEAST)).select("key", F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))
    spans = reduce(DataFrame.unionByName, spans, copied)
    along = W.partitionBy("key").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(W.unboundedPreceding, -1))
    islands = spans.withColumn("new", (before.isNull() | (F.col("start") > before)).cast("int")).withColumn("island", F.sum("new").over(along.rowsBetween(W.unboundedPreceding, 0)))
    merged = islands.groupBy("key", "island").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word")).drop("island")
    return rows.select("key", "doc_id").join(merged, "key").select("doc_id", "start_word", "end_word")


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+') AS w FROM documents),
win AS (SELECT rid, i, md5(array_to_string(w[i + 1:i + {LEAST}], ' ')) AS h FROM (SELECT rid, w, unnest(range(0, len(w) - {LEAST - 1})) AS i FROM d WHERE len(w) >= {LEAST})),
rep AS (SELECT h FROM win GROUP BY h HAVING count(DISTINCT rid) > 1),
hit AS (SELECT rid, i FROM win SEMI JOIN rep USING (h)),
mark AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= {LEAST} THEN 0 ELSE 1 END AS new FROM hit),
isl AS (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i ROWS UNBOUNDED PRECEDING) AS island FROM mark)
SELECT any_value(d.doc_id) AS doc_id, CAST(min(i) AS INTEGER) AS start_word, CAST(max(i) + {LEAST} AS INTEGER) AS end_word FROM isl JOIN d USING (rid) GROUP BY rid, island
"""

QUERIES = {"op7_suffixes": op7_suffixes}
ORACLE = {"op7_suffixes": _SQL}
