import gc
import math
import random
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import pytest

from quarrykit.llm import op4_pieces as op
from quarrykit.llm.words import trimmed

ODD = [None, "", " ", "\n", "a  b", " a", "a ", "\n\nx", "a \n b", "漢字 é x", "x" * 5000, "\t\ttab  \n\n  y", "emoji 😀 ok", "the the the"]


def brute(c, pieces, text):
    """Best score by plain dynamic programming over all substrings of the whole text."""
    s = op.MARK + text.replace(" ", op.MARK)
    words = {p: v for p, v, k in pieces if k in (op.NORMAL, op.USER)}
    best = [0.0] + [-math.inf] * len(s)
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + 20) + 1):
            if s[i:j] in words:
                best[j] = max(best[j], best[i] + words[s[i:j]])
        if s[i] not in words:
            best[i + 1] = max(best[i + 1], best[i] + c.unk_score)
    return best[-1]


@pytest.fixture(scope="module")
def zipf():
    pieces = op.zipf_scores(op.read_model(op.MODEL))
    return pieces, op.Codec(pieces)


@pytest.mark.parametrize("scores", ["file", "zipf"])
def test_paths_are_best(scores):
    pieces = op.read_model(op.MODEL)
    if scores == "zipf":
        pieces = op.zipf_scores(pieces)
    c = op.Codec(pieces)
    rng = random.Random(4)
    texts = [t for t in ODD if t and len(t) < 100] + ["".join(rng.choice("aethnio \n漢é.") for _ in range(60)) for _ in range(60)]
    for t in texts:
        got, at = 0.0, 0
        s = op.MARK + t.replace(" ", op.MARK)
        pending = b""
        for i in c.encode(t):
            p, v, k = pieces[i]
            if k == op.BYTE:
                pending += bytes([int(p[3:5], 16)])
                if pending.decode("utf-8", "ignore"):
                    assert s[at] == pending.decode()
                    got, at, pending = got + c.unk_score, at + 1, b""
            else:
                assert s.startswith(p, at)
                got, at = got + v, at + len(p)
        assert at == len(s)
        assert got == pytest.approx(brute(c, pieces, t), abs=1e-6)


def test_same_ids_as_the_public_library_with_these_scores(zipf):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    pieces, c = zipf
    m = pb.ModelProto()
    with open(op.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    for p, (_, s, k) in zip(m.pieces, pieces):
        if k == op.NORMAL:
            p.score = s
    lib = sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    rng = random.Random(1)
    texts = [t for t in ODD if t is not None and len(t) < 100]
    texts += ["".join(rng.choice(["th", "er", " ", "in", "é", "\n", "tion", "  ", "9", "漢"]) for _ in range(40)) for _ in range(300)]
    for t in texts:
        assert c.encode(t) == lib.encode(t), t


def test_models_of_another_normaliser_are_refused(tmp_path):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    with open(op.MODEL, "rb") as f:
        data = f.read()

    def changed(change):
        m = pb.ModelProto()
        m.ParseFromString(data)
        change(m)
        (tmp_path / "m").write_bytes(m.SerializeToString())
        return op.read_model(str(tmp_path / "m"))

    assert changed(lambda m: None) == op.read_model(op.MODEL)
    for change in (
        lambda m: setattr(m.normalizer_spec, "precompiled_charsmap", b"x"),
        lambda m: setattr(m.normalizer_spec, "remove_extra_whitespaces", True),
        lambda m: setattr(m.normalizer_spec, "add_dummy_prefix", False),
        lambda m: m.ClearField("normalizer_spec"),
        lambda m: setattr(m.pieces[300], "type", op.USER),
    ):
        with pytest.raises(ValueError, match="not supported"):
            changed(change)


def test_whole_table(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(1, "", "x"), (None, "null id", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = op.encode_documents(df).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id == 0:
            assert r.ids is None and r.n_tokens is None and r.round_trip is None
        else:
            assert r.round_trip and r.n_tokens == len(r.ids)
    back = {r.doc_id: r.text for r in op.decode_documents(op.encode_documents(df)).collect()}
    assert all(back[i] == t for i, t in enumerate(ODD))
    assert op.encode_documents(df.limit(0)).count() == 0


def test_memory_is_bounded_and_changes_nothing(zipf, monkeypatch):
    _, c = zipf
    want = [c.encode(f"w{i} x") for i in range(50)]
    monkeypatch.setattr(op, "REMEMBERED", 3)
    c.memory.clear()
    assert [c.encode(f"w{i} x") for i in range(50)] == want
    assert len(c.memory) <= 3 and len(c.memory.old) <= 3
    texts = [f"w{i} xé漢 w{i}a\nw{i} " + "z" * 60 for i in range(30)] + [None, ""]
    assert [None if b is None else list(memoryview(b).cast("i")) for b in c.encode_many(texts)] == [None if t is None else c.encode(t) for t in texts]


def test_remembered_words_are_small():
    c = op.Codec(op.zipf_scores(op.read_model(op.MODEL)))
    texts = pa.array([" ".join(f"w{i}q{j}" for j in range(100)) for i in range(300)])
    op.encode_column(texts.slice(0, 1), c)
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for _ in range(3):
        for at in range(0, len(texts), 50):
            op.encode_column(texts.slice(at, 50), c)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held / 30_000 < 100  # bytes a word; dictionaries of texts and bytes took 139


def test_other_operators_leave_no_codec():
    def make():
        return weakref.ref(op.codec("k", lambda: op.zipf_scores(op.read_model(op.MODEL))))

    held = make()
    list(trimmed(iter)([]))
    assert held() is None
    held = make()
    list(trimmed(iter, "k")([]))
    assert held() is not None


def test_a_word_is_solved_once(monkeypatch):
    c, solved = op.Codec(op.zipf_scores(op.read_model(op.MODEL))), []
    solve = c.solve
    monkeypatch.setattr(c, "solve", lambda words: solved.append(len(words)) or solve(words))
    texts = pa.array([f"gqx{i} zvw{i}" for i in range(200)])
    first, again = (op.encode_column(texts, c)[0] for _ in range(2))
    assert first.equals(again) and sum(solved) == 400


def test_slices_hold_few_rows_and_bytes():
    texts = pa.array(["a" * 10] * 3000 + [None, "", "b" * (op.TEXT_BYTES + 1)] + ["c" * (op.TEXT_BYTES // 3)] * 7)
    got = list(op.slices(texts))
    assert [a for a, _ in got] == [0, *np.cumsum([n for _, n in got])[:-1]] and sum(n for _, n in got) == len(texts)
    assert all(n == 1 or n <= op.TEXTS and sum(len(t or "") for t in texts.slice(a, n).to_pylist()) <= op.TEXT_BYTES for a, n in got)
    assert list(op.slices(texts.slice(0, 0))) == []
