import duckdb
import numpy as np

from quarrykit.llm import op10_toxicity as op

SF = "/root/testdata/sf0.1"


def triples(rows):
    made = [op.counts(t) for t, _ in rows]
    n = [len(m) for m in made]
    return np.array([x for _, x in rows]), np.repeat(np.arange(len(rows)), n), np.array([b for m in made for b in m], np.int64), np.array([c for m in made for c in m.values()])


def test_held_out_accuracy():
    rows = duckdb.execute(f"select text, toxic from '{SF}/documents.parquet' join '{SF}/labels.parquet' using (doc_id) order by md5(doc_id::varchar)").fetchall()
    model = op.fit(*triples(rows[:2600]))
    assert model.thresholds == sorted(model.thresholds) and len(model.weights) < 2000
    y = np.array([x for _, x in rows[2600:]])
    p = np.array([model.score(t) for t, _ in rows[2600:]]) >= model.thresholds[0]
    assert (p & (y == 1)).sum() >= 0.9 * (y == 1).sum()
    assert (p & (y == 0)).sum() <= 0.005 * (y == 0).sum()


def test_gradient_is_the_slope():
    """Thresholds and weights end where the penalised loss has no better neighbour."""
    rng = np.random.default_rng(3)
    texts = [(" ".join(rng.choice(["aa", "bb", "cc", "dd"], 8)) + (" venom" * int(k) if k else ""), int(k > 0)) for k in rng.integers(0, 4, 600)]
    toxic, r, c, n = triples(texts)
    y = op.grade(toxic, r, c, n)
    model = op.fit(toxic, r, c, n)

    def loss(weights, t):
        z = np.array([sum(weights.get(b, 0.0) * np.log1p(k) for b, k in op.counts(s).items()) for s, _ in texts])
        upper = np.concatenate([[-np.inf], t, [np.inf]])
        p = op._sigmoid(upper[y + 1] - z) - op._sigmoid(upper[y] - z)
        return -np.log(np.maximum(p, 1e-12)).mean() + op.L1 * sum(map(abs, weights.values()))

    best = loss(model.weights, model.thresholds)
    for b in model.weights:
        for d in (-0.05, 0.05):
            assert loss(model.weights | {b: model.weights[b] + d}, model.thresholds) >= best - 1e-4
    order = [np.mean([model.score(s) for (s, _), g in zip(texts, y) if g == k]) for k in range(4) if (y == k).any()]
    assert order == sorted(order)


def test_rows(spark):
    model = op.Model({op.bucket("vile"): 3.0, op.bucket("^rott"): 1.0}, [1.0, 3.0, 5.0])
    texts = [None, "", "fine words", "vile", "VILE, vile! " * 4000, "rotten rotted", "x" * 200000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(3, "vile", "s"), (None, "vile", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, severity string")
    out = op.score_documents(docs, model).collect()
    assert len(out) == len(rows)
    for r in out:
        text = texts[r.doc_id] if r.doc_id is not None else "vile"
        above = op._sigmoid(model.score(text) - np.array(model.thresholds))
        assert abs(r.severity - above.sum()) < 1e-9 and r.toxic == (above[0] >= 0.5) and r.grade == (above >= 0.5).sum()
    kept = op.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 6]
    assert op.score_documents(docs.limit(0), model).count() == 0


def test_training_where_labels_are_thin(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, "c")], "doc_id long, text string")
    for rows in ([], [(1, 0)], [(1, 1), (2, 1)], [(1, None), (None, 1), (9, 1)]):
        model = op.train(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        out = op.score_documents(docs, model).collect()
        assert model.weights == {} and len(out) == 3 and not any(r.toxic for r in out)
        share = {(): 0, ((1, 0),): 0, ((1, 1), (2, 1)): 1, ((1, None), (None, 1), (9, 1)): 0}[tuple(rows)]
        assert all(abs(r.severity - share) < 1e-6 for r in out)
        assert op.drop_toxic(docs, model).count() == 3


def test_memory_of_training():
    """Fitting takes room for the triples and the buckets that occur, not for all buckets."""
    import tracemalloc

    rng = np.random.default_rng(5)
    n, each = 3000, 200
    toxic = (np.arange(n) % 10 == 0).astype(np.int32)
    rows = np.repeat(np.arange(n, dtype=np.int32), each)
    cols = rng.integers(0, 50_000, n * each).astype(np.int32) * 80
    cols[::each] = np.where(toxic == 1, 1 << 21, 80)
    tracemalloc.start()
    model = op.fit(toxic, rows, cols, np.ones(n * each, np.int32))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert model.weights[1 << 21] > 0 and peak < 60


def test_equal_texts_count_once():
    import pyarrow as pa

    rows = [(0, [5, 6], [1, 2]), (1, [5, 6], [1, 2]), (0, [5, 6], [2, 1]), (0, [], []), (0, [5, 6], [1, 2]), (0, [], []), (1, [7], [1])]
    made = pa.table({"toxic": pa.array([t for t, _, _ in rows], pa.int32()), "words": pa.array([w for _, w, _ in rows], pa.list_(pa.int32())), "times": pa.array([k for _, _, k in rows], pa.list_(pa.int32()))})
    for table in (made, pa.concat_tables([made.slice(0, 3), made.slice(3)])):
        toxic, n, words, times = op._once(table)
        assert toxic.tolist() == [1, 0, 0, 0, 1] and n.tolist() == [2, 2, 2, 0, 1]
        assert words.tolist() == [5, 6, 5, 6, 5, 6, 7] and times.tolist() == [1, 2, 2, 1, 1, 2, 1]
    assert [len(x) for x in op._once(made.slice(0, 0))] == [0, 0, 0, 0]
