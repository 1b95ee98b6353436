import hashlib
from collections import defaultdict

import pytest

from quarrykit.llm import op1_mixing as op


def brute(rows, weights, other, limit):
    units = defaultdict(int)
    for i, text, source in rows:
        for c in "\t\n\r\f":
            text = text.replace(c, " ") if text else text
        units[source, i] += len([w for w in (text or "").split(" ") if w])
    digest = {u: hashlib.md5(("" if u[1] is None else str(u[1])).encode()).hexdigest() for u in units}
    if isinstance(limit, tuple):
        limit = sum(units.values()) * limit[0] // limit[1]
    queue, upto = [], defaultdict(int)
    for u in sorted(units, key=lambda u: (digest[u], -1 if u[1] is None else u[1])):
        upto[u[0]] += units[u]
        queue.append((upto[u[0]] / weights.get(u[0], other), u[0] is not None, u[0] or "", digest[u], u))
    out, total = [], 0
    for finish, *_, u in sorted(queue, key=lambda q: q[:4]):
        total += units[u]
        if total > limit:
            break
        out.append((u[0], u[1], units[u], finish, total))
    return out


@pytest.mark.parametrize("slice_docs", [1, 7, 10**6])
@pytest.mark.parametrize("budget", [0, 900, (1, 2), 10**9])
def test_against_a_queue(spark, slice_docs, budget):
    rows = [(i % 170, " ".join(["w"] * (i * 37 % 23)) + "\tx\n", ["a", "b", None, "hot"][0 if i % 9 == 0 else 1 if i % 7 == 0 else 2 if i % 11 == 0 else 3]) for i in range(200)]
    rows += [(None, "two words", "a"), (5, None, "b"), (6, "", "b"), (6, "", "b"), (7, "w " * 50000, "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 2.0, "hot": 0.5}
    got = op.mixed_units(docs, weights, 1.0, budget, slice_docs).collect()
    want = brute(rows, weights, 1.0, budget)
    key = lambda r: (r[4], r[3], r[0] or "", -1 if r[1] is None else r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_shares_follow_weights(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(3000)], "doc_id long, text string, source string")
    tokens = defaultdict(int)
    for r in op.mixed_units(docs, {"a": 1.0, "b": 2.0, "c": 1.0}, budget=4000).collect():
        tokens[r.source] += r.tokens
    assert abs(tokens["b"] - 2000) < 20 and abs(tokens["a"] - 1000) < 20


def test_ties_go_by_source_then_digest(spark):
    """Equal lengths and weights: every finish time comes once for each source."""
    rows = [(i, "w w", s) for i in range(30) for s in ("b", "a", None)] + [(100 + i, "", s) for i in range(9) for s in ("a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = op.mixed_units(docs, {"a": 1.0, "b": 1.0}, 1.0, 61, 5).collect()
    want = brute(rows, {"a": 1.0, "b": 1.0}, 1.0, 61)
    assert len({u[3] for u in want}) < len(want)
    key = lambda r: (r[4], r[3], r[0] or "", -1 if r[1] is None else r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    kept = sorted((r.doc_id, r.source or "") for r in op.mix(docs, weights={"a": 1.0, "b": 1.0}, budget=61).collect())
    assert kept == sorted((u[1], u[0] or "") for u in want)


def test_string_ids_and_seeds(spark):
    docs = spark.createDataFrame([(f"d{i}", "w " * (i % 4), "ab"[i % 2], "s") for i in range(200)] + [(None, "w", "a", "s")], "doc_id string, text string, source string, digest string")
    kept = {seed: {r.doc_id for r in op.mix(docs, seed=seed, budget=100).collect()} for seed in ("", "x")}
    assert kept[""] != kept["x"] and all(0 < len(k) < 150 for k in kept.values())
    assert kept[""] == {r.doc_id for r in op.mixed_units(docs, budget=100).collect()}


def test_rows_come_back_whole(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 3), (1, "a b", "s", 4), (2, None, None, 5), (None, "c", "t", 6)], "doc_id long, text string, source string, tokens int")
    out = op.mix(docs, budget=10**6)
    assert out.columns == docs.columns and out.count() == 4
    assert op.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        op.mixed_units(docs, {"s": 0.0})
