import glob
import random

import numpy as np
import pyarrow as pa
from pyarrow import orc

from quarrykit.llm import op4_pieces, op9_orc


def plain_codec():
    return op4_pieces.Codec(op4_pieces.zipf_scores(op4_pieces.read_model(op4_pieces.MODEL)))


def by_brute_force(c, text):
    """All ways over the text by a table of best scores, one piece after another: no automaton, no segments."""
    if not text:
        return [] if text == "" else None
    words = {p: (s, i) for i, (p, s, k) in enumerate(op4_pieces.zipf_scores(op4_pieces.read_model(op4_pieces.MODEL))) if k in (op4_pieces.NORMAL, op4_pieces.USER)}
    longest, s = max(map(len, words)), op4_pieces.MARK + text.replace(" ", op4_pieces.MARK)
    best = [(0.0, 0, None)]
    for j in range(1, len(s) + 1):
        ways = [(best[i][0] + words[s[i:j]][0], -i, words[s[i:j]][1]) for i in range(max(0, j - longest), j) if s[i:j] in words]
        top = None
        for w in sorted(ways, key=lambda w: -w[1]):  # the longer piece wins a tie
            top = w if top is None or w[0] > top[0] else top
        if s[j - 1] not in words and (top is None or best[j - 1][0] + c.unk_score > top[0]):
            top = (best[j - 1][0] + c.unk_score, -(j - 1), None)
        best.append((top[0], -top[1], top[2]))
    ids, j = [], len(s)
    while j:
        _, i, k = best[j]
        ids += [k] if k is not None else c.spelled(s[j - 1])
        j = i
    return ids[::-1]


def read_rows(spark, df):
    """(rows, rows that came from the row groups that were read)."""
    store = spark.sparkContext._jsc.sc().statusStore()
    group = f"g{random.random()}"
    spark.sparkContext.setJobGroup(group, group)
    rows = df.collect()
    read = 0
    for job in spark.sparkContext.statusTracker().getJobIdsForGroup(group):
        for stage in spark.sparkContext.statusTracker().getJobInfo(job).stageIds:
            read += store.lastStageAttempt(stage).inputRecords()
    return rows, read


def test_round_trip_and_pruning(spark, tmp_path):
    texts = [None, "", "a b", "x" * 50000, "tab\there", "é 日本 \n\n two  spaces "] + [f"word{i} and {i * i}" for i in range(8000)]
    docs = spark.createDataFrame([(i * 3, t, 0) for i, t in enumerate(texts)] + [(6, "a b", 1), (None, "n", 2)], "doc_id long, text string, ids int")
    path = str(tmp_path / "t")
    op9_orc.write_tokens(docs.repartition(3), path, stripe_bytes=20_000, stride=1000, files=4)
    back, c = op9_orc.read_tokens(spark, path), plain_codec()
    rows = back.collect()
    assert len(rows) == len(texts) + 2 and all(r.round_trip is (None if r.ids is None else True) for r in rows)
    want = dict(enumerate(texts))
    for r in rows:
        text = "n" if r.doc_id is None else want[r.doc_id // 3]
        assert (r.ids is None) == (text is None) and r.n_tokens == (None if text is None else len(r.ids))
        if text is not None:
            assert c.decode(r.ids) == text
            if r.doc_id is None or r.doc_id < 60 and len(text) < 1000:
                assert r.ids == by_brute_force(c, text)
    files = glob.glob(path + "/*.orc")
    assert len(files) == 4
    spans = sorted((min(t), max(t)) for f in files if (t := orc.ORCFile(f).read(columns=["doc_id"])["doc_id"].drop_null().to_pylist()) and t == sorted(t))
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # files do not overlap
    # one row group of one stripe of one file is read for an id, and those that meet a range for it
    rows, read = read_rows(spark, op9_orc.read_tokens(spark, path, ids=[9, 10**9]))
    assert [r.n_tokens for r in rows] == [len(c.encode("x" * 50000))] and read <= 1000
    rows, read = read_rows(spark, op9_orc.read_tokens(spark, path, between=(9000, 9299)))
    assert len(rows) == 100 and read <= 2000
    rows, read = read_rows(spark, op9_orc.read_tokens(spark, path, ids=[10]))  # between two ids: the Bloom filter says no
    assert rows == [] and read <= 1000
    # one file of several stripes, for tasks that read a part each
    op9_orc.write_tokens(docs, str(tmp_path / "one"), stripe_bytes=20_000, stride=1000, files=1)
    (one,) = glob.glob(str(tmp_path / "one/*.orc"))
    assert orc.ORCFile(one).nstripes > 1 and orc.ORCFile(one).nrows == len(texts) + 2
    assert read_rows(spark, op9_orc.read_tokens(spark, str(tmp_path / "one"), between=(0, 30)))[1] <= 1000


def test_one_id_in_a_third_of_the_rows_is_spread(spark, tmp_path):
    rows = [(7, f"text {i % 50}") for i in range(900)] + [(None, "same")] * 900 + [(i, "t") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "h")
    op9_orc.write_tokens(docs.repartition(4), path, files=9)
    held = [orc.ORCFile(f).read(columns=["doc_id"])["doc_id"].to_pylist() for f in glob.glob(path + "/*.orc")]
    assert sum(map(len, held)) == len(rows) and max(map(len, held)) <= 0.25 * len(rows)
    assert sorted((x is None, x or 0) for h in held for x in h) == sorted((i is None, i or 0) for i, _ in rows)


def test_places_do_not_depend_on_the_order_of_rows():
    p = op9_orc.Places([1, 5, 5, 5, 5, 9, None, None], 4)
    ids = [5] * 30 + [None] * 20 + list(range(12)) + [5] * 30
    tokens = [[i % 7] for i in range(len(ids))]
    seen = []
    for seed in range(3):
        order = list(range(len(ids)))
        random.Random(seed).shuffle(order)
        at = p.of(pa.array([ids[i] for i in order], pa.int64()), pa.array([tokens[i] for i in order], pa.list_(pa.int32())), {})
        seen.append(sorted((str(ids[i]), tokens[i], k) for i, k in zip(order, at.tolist())))
    assert seen[0] == seen[1] == seen[2] and np.ptp([k for _, _, k in seen[0]]) == 3


def test_string_ids(spark, tmp_path):
    docs = spark.createDataFrame([(f"doc-{i:03d}", f"text {i}") for i in range(100)] + [(None, "n"), ("", "e")], "doc_id string, text string")
    path = str(tmp_path / "s")
    op9_orc.write_tokens(docs, path, files=3)
    back = op9_orc.read_tokens(spark, path)
    assert back.schema["doc_id"].dataType.simpleString() == "string"
    assert sorted(map(str, [r.doc_id for r in back.collect()])) == sorted(map(str, [r.doc_id for r in docs.collect()]))
    assert [r.doc_id for r in op9_orc.read_tokens(spark, path, ids=["doc-042"]).collect()] == ["doc-042"]


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    op9_orc.write_tokens(docs, str(tmp_path / "e"))
    back = op9_orc.read_tokens(spark, str(tmp_path / "e"))
    assert back.count() == 0 and back.columns == ["doc_id", "ids", "n_tokens", "round_trip"]
