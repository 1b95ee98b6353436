import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, written and read as the pipeline does."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = [docs]
    for name, f in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        f(spark, made[-1], SF).write.parquet(path)
        made.append(spark.read.parquet(path))
    return [sorted((tuple(r.asDict().items()) for r in d.collect()), key=str) for d in made], [d.columns for d in made], docs


def texts(rows):
    return {dict(r)["doc_id"]: dict(r)["text"] for r in rows}


def test_columns_and_last_stage(stages):
    rows, columns, docs = stages
    assert all(c == docs.columns for c in columns[:5])
    from quarrykit.llm import op4_pieces as op

    c = op.Codec(op.zipf_scores(op.read_model(op.MODEL)))
    want = texts(rows[4])
    assert {dict(r)["doc_id"]: dict(r)["ids"] for r in rows[5]} == {i: c.encode(t) for i, t in want.items()}
    assert all(dict(r)["round_trip"] for r in rows[5])


def test_toxicity(stages, spark):
    rows, _, docs = stages
    from quarrykit.llm import op10_toxicity as op

    model = op.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {i for i, t in texts(rows[0]).items() if model.score(t) < model.thresholds[0]}
    assert set(texts(rows[1])) == want


def test_near_duplicates(stages):
    rows, _, _ = stages
    from test_op6_minhash import brute_groups

    from quarrykit.llm import op6_minhash as op

    before = sorted(texts(rows[1]).items())
    _, roots = brute_groups(before, op.THRESHOLD)
    least = {}
    for (i, _), g in zip(before, roots):
        least[g] = min(least.get(g, i), i)
    got, want = set(texts(rows[2])), set(least.values())
    assert want <= got and len(got - want) <= 0.02 * len(before)


def test_secrets(stages, spark):
    rows, _, _ = stages
    from quarrykit.llm import op3_secrets as op

    before, after = texts(rows[2]), texts(rows[3])
    assert set(before) == set(after)
    import hashlib

    sample = [t for _, t in sorted(((hashlib.md5(str(i).encode()).hexdigest(), i), t) for i, t in before.items())[: op.SAMPLE]]
    field = op.fit(op.sequences(sample, op.SEQUENCES, random.Random(3)))
    import re

    import numpy as np
    from test_op3_secrets import tag_spans

    for i, text in before.items():
        # plain Viterbi over the whole text, by the field's own emissions of every token
        words = list(re.finditer(r"[^ \t\n\r\x0b\x0c]+", text or ""))
        spans = []
        if words:
            y, _ = op.viterbi(field.emissions([w.group() for w in words]), field.pairs, field.first, np.zeros(3))
            for a, b in tag_spans(y):
                lo, hi = words[a].start(), words[b - 1].end()
                if b == a + 1 and (v := op.parts(text[lo:hi])[1]):
                    lo += text[lo:hi].rindex(v)
                    hi = lo + len(v)
                spans.append((lo, hi))
        want, at = "", 0
        for lo, hi in spans:
            want, at = want + text[at:lo] + op.MARK, hi
        assert after[i] == want + text[at:]


def test_mixing(stages):
    rows, _, _ = stages
    from test_op1_mixing import brute

    from quarrykit.llm import op1_mixing as op

    before = [(d["doc_id"], d["text"], d["source"]) for d in map(dict, rows[3])]
    assert sorted(texts(rows[4])) == sorted(u[1] for u in brute(before, op.WEIGHTS, op.OTHER, op.BUDGET))
