import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrykit.llm import op7_suffixes as op


def brute(rows):
    """Spans by all windows of all rows."""
    where = defaultdict(set)
    words = [(t or "").encode().split() for _, t in rows]
    for r, w in enumerate(words):
        for i in range(len(w) - op.LEAST + 1):
            where[tuple(w[i : i + op.LEAST])].add(r)
    out = []
    for r, w in enumerate(words):
        span = None
        for i in range(len(w) - op.LEAST + 1):
            if len(where[tuple(w[i : i + op.LEAST])]) > 1:
                if span and i <= span[1]:
                    span[1] = i + op.LEAST
                else:
                    if span:
                        out.append((rows[r][0], *span))
                    span = [i, i + op.LEAST]
        if span:
            out.append((rows[r][0], *span))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n, v=400: [f"w{rng.randrange(v)}" for _ in range(n)]
    shared = [text(n) for n in (49, 50, 51, 70, 130, 400)]
    rows = []
    for i in range(50):
        w = text(rng.randrange(0, 160))
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(0, max(1, len(s) - 49))
            k = rng.randrange(len(w) + 1)
            w[k:k] = s[a : a + rng.randrange(40, 200)]
        rows.append((i, " ".join(w)))
    rows += [(50, None), (51, ""), (52, rows[3][1]), (3, rows[3][1]), (None, " ".join(shared[4])), (53, "same " * 300), (54, "same " * 120 + "end"), (55, "ab cd " * 150), (56, " ".join(text(9000, 10**6) + shared[5]))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("batch", [20_000, 5])
def test_against_all_windows(spark, monkeypatch, seed, batch):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, pos int")
    if batch == 5:  # in this process: workers do not see the patch
        monkeypatch.setattr(op, "BATCH", 5)
        import pyarrow as pa

        tables = [pa.RecordBatch.from_pylist([{"key": str(i).encode(), "text": (t or "").encode()} for i, t in rows])]
        found = pa.Table.from_batches(list(op._find(iter(tables)))).to_pylist()
        by = defaultdict(list)
        for f in found:
            by[f["key"]].append({"pos": f["pos"], "bucket": f["bucket"], "large": False})
        around = [b for i, t in rows for b in op._around(iter([pa.RecordBatch.from_pylist([{"key": str(i).encode(), "text": (t or "").encode(), "found": by[str(i).encode()]}])]))]
        t = pa.Table.from_batches(around).sort_by("bucket")
        want = None
        for size in (5, 10**6):
            monkeypatch.setattr(op, "BATCH", size)
            got = sorted((r["key"], r["start"], r["end"]) for b in op._refined(iter(t.to_batches(max_chunksize=3))) for r in b.to_pylist())
            assert want is None or got == want
            want = got
        return
    got = sorted(((r.doc_id, r.start_word, r.end_word) for r in op.repeated_spans(docs).collect()), key=str)
    assert got == brute(rows)


def test_large_buckets_are_split(spark):
    rows = corpus(3)
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    for large in (0, 3):
        assert sorted(((r.doc_id, r.start_word, r.end_word) for r in op.repeated_spans(docs, large=large).collect()), key=str) == brute(rows)


def test_a_passage_of_very_many_texts(spark):
    """One passage in surroundings that all differ: its buckets hold every text."""
    n, passage = 30_000, " ".join(f"p{i}" for i in range(60))
    words = lambda m: F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.concat(F.lit(m), F.hex(F.xxhash64("id", i)))), " ")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words("a"), F.lit(passage), words("b")).alias("text"))
    got = op.repeated_spans(docs)
    assert [tuple(r) for r in got.groupBy("start_word", "end_word").agg(F.count_distinct("doc_id").alias("n"), F.count("*").alias("m")).collect()] == [(40, 100, n, n)]


def test_refinement_names_equal_prefixes():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 2, (60, op.WIDTH)).astype(np.uint32)
    words[30:] = words[:30]
    words[30:, 40] ^= 1
    group = np.arange(60) % 30 % 4
    for depth in (7, 13, 30, op.LEAST):
        ids = op.refine(words, group, depth, op.BEFORE + 1)
        for c in range(op.BEFORE + 1):
            same = ids[:, c][:, None] == ids[:, c]
            want = (group[:, None] == group) & (words[:, None, c : c + depth] == words[None, :, c : c + depth]).all(axis=2)
            assert (same == want).all()


def test_empty(spark):
    assert op.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0
