import itertools

import numpy as np
import pytest

from quarrykit.llm import op6_minhash as op
from quarrykit.llm.graph import components
from quarrykit.llm.words import text_shingles

DOCS = "/root/testdata/sf0.001/documents.parquet"


def brute_groups(rows, threshold):
    """Least doc_id of each row's component, by all pairs."""
    sets = [text_shingles(t, op.SHINGLE) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a is None or b is None or min(len(a), len(b)) < threshold * max(len(a), len(b)):
            continue
        n = len(np.intersect1d(a, b, assume_unique=True))
        if n >= threshold * (len(a) + len(b) - n):
            pairs.add((rows[i][0], rows[j][0]))
            root[find(j)] = find(i)
    return pairs, [find(i) for i in range(len(rows))]


def test_against_all_pairs(spark):
    docs = spark.read.parquet(DOCS)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    pairs, roots = brute_groups(rows, op.THRESHOLD)
    got = {r.doc_id: r.group_id for r in op.near_duplicates(docs).collect()}
    assert pairs
    hit = sum(got.get(a) is not None and got.get(a) == got.get(b) for a, b in pairs)
    assert hit >= 0.95 * len(pairs)
    of = {r[0]: g for r, g in zip(rows, roots)}
    for d, g in got.items():  # nothing is joined that all pairs do not join
        assert of[d] == of[g]


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    body = " ".join(f"v{i % 97}x{i}" for i in range(200))
    rows = [(1, None), (2, ""), (3, " ,. "), (4, "one"), (5, "One!"), (5, "One!"), (6, long), (7, long + " end"), (8, body), (9, body.replace("v5x5 ", "")), (9, body), (None, body), (None, "alone here now"), (10, "two words")]
    docs = spark.createDataFrame([(i, t, "k", 0) for i, t in rows], "doc_id long, text string, key string, node int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.group_id, r.keep) for r in op.near_duplicates(docs).collect())
    assert got == [(False, 4, 4, True), (False, 5, 4, False), (False, 5, 4, False), (False, 6, 6, True), (False, 7, 6, False), (False, 8, 8, True), (False, 9, 8, False), (False, 9, 8, False), (True, 0, 8, False)]
    left = op.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 2, 3, 4, 6, 8, 10]
    again = spark.createDataFrame([(5, "a b c d")] * 3, "doc_id long, text string")
    assert op.drop_near_duplicates(again).count() == 1
    assert op.near_duplicates(docs.limit(0)).count() == 0
    assert op.drop_near_duplicates(docs.limit(0)).count() == 0


def test_signature_is_the_minimum_over_shifts():
    k, rng = 20, np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (9000, 3))
    sig = op.signatures(np.concatenate([a, b]), np.array([0, len(a)]), k)
    first, shifted = op._tables(k)
    second = shifted[:, 0]
    for row, s in ((0, a), (1, b)):
        at = first[(s & np.uint64(op.PLACES - 1)).astype(int)].astype(int)
        for j in range(k):
            assert sig[row, j] == min(second[(at + j) % op.PLACES])


def test_a_hot_bucket_with_two_kinds(spark):
    """Hundreds of near copies of two texts that share a lot; groups are as all pairs give them."""
    base = [f"t{i}" for i in range(60)]
    rows = []
    for n in range(150):
        w = list(base)
        w[n % 60] = f"edit{n}"
        rows.append((n, " ".join(w)))
    pairs, roots = brute_groups(rows, op.THRESHOLD)
    got = {r.doc_id: r.group_id for r in op.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0} and len(got) == 150 and set(roots) == {0}


def family(n, copies):
    """Texts with a passage in common and an index of about 0.53, and near copies of some."""
    core = [f"c{i}" for i in range(100)]
    rows = [(k, " ".join(core + [f"u{k}x{i}" for i in range(42)])) for k in range(n)]
    return rows + [(n + k, rows[k * 7][1].replace(f"u{k * 7}x40", "other")) for k in range(copies)]


def test_large_buckets_give_what_small_ones_give(spark):
    rows = family(400, 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, roots = brute_groups(rows, op.THRESHOLD)
    of = {r[0]: rows[g][0] for r, g in zip(rows, roots)}
    assert len(set(roots)) == 400 and len(pairs) == 20
    for few in (2, 10**6):
        got = {r.doc_id: r.group_id for r in op.near_duplicates(docs, few=few).collect()}
        assert len(got) == 40 and all(of[d] == of[g] for d, g in got.items())


def test_a_bucket_of_many_that_do_not_match(spark):
    """No pairs are listed within it: 20,000 texts that share bands and have an index below the threshold."""
    import time

    rows = family(20000, 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    began = time.time()
    got = {r.doc_id: r.group_id for r in op.near_duplicates(docs).collect()}
    assert time.time() - began < 150
    assert got == {d: g for k in range(50) for d, g in ((k * 7, k * 7), (20000 + k, k * 7))}


def test_a_cluster_with_a_middle_is_joined_by_it(spark, monkeypatch):
    """Near copies of one text that are no near copies of each other: whatever the nodes' order, most are held against that text, and few pairs are left to verify."""
    rng = np.random.default_rng(7)
    rows = [(0, " ".join(f"m{i}" for i in range(60)))]
    for k in range(1, 151):
        w = rows[0][1].split()
        for j in rng.choice(15, 4, replace=False):
            w[4 * j] = f"edit{k}x{j}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    verified, counted = op.verified, []

    def counting(pairs, sets, threshold):
        found = verified(pairs, sets, threshold)
        counted.append((pairs.count(), found.count()))
        return found

    monkeypatch.setattr(op, "verified", counting)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (2, 3):
        counted.clear()
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            groups = [r.root for r in op.near_groups(docs).collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert len(groups) == 151 and max(groups.count(g) for g in groups) >= 0.95 * 151
        assert counted[0][1] >= 0.9 * 150 and counted[1][0] <= 4 * 150


def test_towards_middles(spark):
    """Node 7 meets most others; 9 meets 0 alone, as 0 meets fewer than 7 does but more than 9; ties go to the least."""
    buckets = {1: [7, 3, 4, 5], 2: [7, 0], 3: [0, 9], 4: [21, 20]}
    shared = spark.createDataFrame([(h, n, len(ns)) for h, ns in buckets.items() for n in ns], "h long, node long, n long")
    assert sorted(tuple(r) for r in op.towards_middles(shared).collect()) == [(7, 0), (7, 3), (7, 4), (7, 5), (9, 0), (21, 20)]


def test_string_ids_and_words_of_newer_scripts(spark):
    rows = [("b", "same words here"), ("a", "same words here"), (None, "same words here"), ("c", "\U00011f04\U00011f05 \U00011f06"), ("d", "\U00011f04\U00011f05 \U00011f06"), ("e", "!!"), ("f", "!!")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert sorted((r.doc_id or "-", r.group_id, r.keep) for r in op.near_duplicates(docs).collect() if r.group_id == "a") == [("-", "a", False), ("a", "a", True), ("b", "a", False)]
    grouped = {r.doc_id for r in op.near_duplicates(docs).collect() if r.keep is False}
    left = sorted(r.doc_id for r in op.drop_near_duplicates(docs).collect())
    assert left == sorted({i for i, _ in rows} - grouped) and {"e", "f"} <= set(left)


@pytest.mark.parametrize("n", [1, 2, 33])
def test_components_of_a_path(spark, n):
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}
