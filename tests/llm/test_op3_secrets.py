import random
import re

import duckdb
import numpy as np
import pytest

from quarrykit.llm import op3_secrets as op

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def corpus():
    return [t for (t,) in duckdb.execute(f"select text from '{DOCS}' order by md5(doc_id::varchar)").fetchall()]


@pytest.fixture(scope="module")
def field(corpus):
    return op.fit(op.sequences(corpus[:100], 1200, random.Random(3)), steps=110)


def tag_spans(y):
    """(first, one past the last) of each secret in a sequence of tags; an I after an O begins one."""
    found = []
    for t, tag in enumerate(y):
        if tag == op.B or tag == op.I and (t == 0 or y[t - 1] == op.O):
            found.append([t, t + 1])
        elif tag == op.I:
            found[-1][1] = t + 1
    return [tuple(s) for s in found]


def test_held_out_sequences(corpus, field):
    hit = extra = missed = 0
    for tokens, tags, about in op.sequences(corpus[100:200], 300, random.Random(8)):
        e = field.emissions(tokens)
        for j, k in enumerate(op.text_features(tokens)):
            e += field.about[j][about[j]] - field.about[j][k]
        got, _ = op.viterbi(e, field.pairs, field.first, np.zeros(3))
        for p, q in zip(got, tags):
            hit += p != op.O and q != op.O
            extra += p != op.O and q == op.O
            missed += p == op.O and q != op.O
    assert hit >= 0.9 * (hit + missed) and hit >= 0.9 * (hit + extra)


def test_whole_corpus_has_its_tokens_found(corpus, field):
    s = op.Scanner(field)
    hit = extra = missed = 0
    for text, spans in zip(corpus, s.spans(corpus)):
        true = {m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', text, re.I)}
        got = {(a, b) for a, b, _ in spans}
        hit, extra, missed = hit + len(true & got), extra + len(got - true), missed + len(true - got)
    assert hit and missed <= 0.05 * hit and extra <= 0.1 * hit


def test_skipping_is_exact(field):
    """The same tags as plain Viterbi over each whole text."""
    rng = random.Random(5)
    weak = op.Field(field.offsets, field.about * 0 + rng.random(), field.pairs * 4, field.first)  # so that transitions matter
    for f in (field, weak):
        texts = []
        for tokens, _, _ in op.sequences(["the plain text of it = 12 and so on", 'token = "x"'], 150, rng):
            texts.append([w.encode() for w in tokens])
        texts += [[], [b"token"], [b'"0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f"']]
        for tokens, hits in zip(texts, op.Scanner(f).tags(texts)):
            if not tokens:
                assert hits == []
                continue
            e = f.emissions([t.decode() for t in tokens])
            y, best = op.viterbi(e, f.pairs, f.first, np.zeros(3))
            assert [(a, b) for a, b, _ in hits] == tag_spans(y)
            score = lambda tags: f.first[tags[0]] + e[range(len(tags)), tags].sum() + sum(f.pairs[a, b] for a, b in zip(tags, tags[1:]))
            assert score(y) == pytest.approx(best)
            for a, b, lead in hits:
                assert lead == pytest.approx(best - score(y[:a] + [op.O] * (b - a) + y[b:]))


def test_rows(spark, field):
    key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
    texts = [None, "", "plain words only here", f'é the token = "{key}"!! and more', f'token = "{key}" ' + "word " * 60000 + f'token = "{key}"', "a" * 100000]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)] + [(3, texts[3], 2, None), (None, texts[3], 3, "x")], "doc_id long, text string, n_chars long, start string")
    out = sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.end) for r in op.scan(docs, field).collect())
    at = texts[3].index(key)
    assert out == [(-1, at, at + 40), (3, at, at + 40), (3, at, at + 40), (4, 9, 49), (4, len(texts[4]) - 41, len(texts[4]) - 1)]
    clean = op.redact(docs, field)
    assert clean.columns == docs.columns
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows[3].text == f'é the token = "{op.MARK}"!! and more' and rows[3].n_chars == len(rows[3].text)
    assert rows[0].text is None and rows[2].text == texts[2] and key not in rows[4].text and clean.count() == len(texts) + 2
    assert op.scan(docs.limit(0), field).count() == 0 and op.redact(docs.limit(0), field).count() == 0


def test_training_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    texts = [r.text for r in empty.collect()]
    assert list(op.sequences(texts, 5, random.Random(1)))
