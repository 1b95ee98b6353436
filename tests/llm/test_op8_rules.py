import math

import pytest

from quarrykit.llm import op8_rules as op


def test_tail_is_exact():
    for n, k, r in ((1, 0, 0.3), (50, 3, 0.02), (400, 0, 0.004), (7, 7, 0.5), (30, 29, 0.9)):
        assert op.tail(n, k, r) == pytest.approx(sum(math.comb(n, i) * r**i * (1 - r) ** (n - i) for i in range(k + 1)), rel=1e-9)


def firsts(n, at):
    """Counts of first rejections by step, ``n`` in all."""
    row = [at.get(i, 0) for i in range(60)]
    return [*row, n - sum(row)]


def test_the_path_ends_at_its_first_failure():
    chosen = op.cutoffs([("en", firsts(5000, {2: 3, 14: 60, 30: 400, 50: 1})), (None, firsts(300, {})), ("de", firsts(100, {}))])
    # the first 30 steps lose 63 of 5000, the next 463; a null stratum is one of its own; the third has too few for any step
    assert [chosen["en", r] for r in ("symbols", "capitals", "word_copies")] == [0.02, 0.10, op.LADDERS["word_copies"][1][5]]
    assert ("en", "line_copies") not in chosen and chosen[None, "words"] == 30.0 and not any(s == "de" for s, _ in chosen)
    assert op.tail(5000, 63, op.RISK) <= op.DELTA / 2 < op.tail(5000, 463, op.RISK)


def test_fewest_good_texts():
    one, four = op.fewest(op.RISK, op.DELTA), op.fewest(op.RISK, op.DELTA / 4)
    assert (one, four) == (149, 217)
    assert op.tail(149, 0, op.RISK) <= op.DELTA < op.tail(148, 0, op.RISK)
    assert op.cutoffs([("a", firsts(149, {}))]) and not op.cutoffs([("a", firsts(148, {}))])
    # strata that can prove nothing do not split the level
    assert {s for s, _ in op.cutoffs([("a", firsts(149, {})), *[(str(i), firsts(148, {})) for i in range(50)]])} == {"a"}
    assert {s for s, _ in op.cutoffs([(str(i), firsts(217, {})) for i in range(4)])} == {"0", "1", "2", "3"}
    assert op.cutoffs([]) == {}


def test_features_and_decisions(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "One two two\nthree\nthree", "en"), (4, "#$% a", "de"), (5, "x" * 100000, "en"), (5, "x" * 100000, "en"), (None, "A B", "en")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, words double")
    f = {(r.doc_id, r.stratum): r for r in op.text_features(docs).collect()}
    r = f[3, "en"]
    assert (r.words, r.word_copies, r.line_copies, r.capitals, r.symbols) == (5.0, 2 / 5, 1 / 3, 1 / 23, 0.0)
    assert f[1, "en"].words == 0 and f[2, None].words == 0 and f[4, "de"].symbols == 3 / 5
    out = op.decide(op.text_features(docs), {("en", "words"): 3.0, ("de", "symbols"): 0.5}).collect()
    assert sorted((r.doc_id or 0, r.keep, r.broken) for r in out) == [(0, False, "words"), (1, False, "words"), (2, True, ""), (3, True, ""), (4, False, "symbols"), (5, False, "words"), (5, False, "words")]
    labels = spark.createDataFrame([(1, 1), (3, 1), (3, 1), (99, 1), (None, 1), (4, None), (4, 0)], "doc_id long, quality int")
    assert [r.keep for r in op.apply_rules(docs, labels).collect()] == [True] * 7
    assert op.apply_rules(docs.limit(0), labels).count() == 0
    assert op.apply_rules(docs, labels.limit(0)).count() == 7


def test_null_and_empty_languages_are_two_strata_and_copies_count_once(spark):
    rows = [(i, f"w{i} " * 40 if i < 160 else "same " * 40, None if i % 2 else "") for i in range(1000)]
    docs = spark.createDataFrame([(f"d{i}", t, lang) for i, t, lang in rows], "doc_id string, text string, lang string")
    labels = spark.createDataFrame([(f"d{i}", 1) for i, _, _ in rows] * 2, "doc_id string, quality int")
    features = op.text_features(docs)
    assert op.calibrate(features, labels) == {}  # 81 distinct good texts in each
    more = docs.unionByName(spark.createDataFrame([(f"n{i}", f"N{i} b c d", None) for i in range(149)], docs.schema))
    chosen = op.calibrate(op.text_features(more), labels.unionByName(spark.createDataFrame([(f"n{i}", 1) for i in range(149)], labels.schema)))
    assert {s for s, _ in chosen} == {None}
    kept = {r.doc_id: (r.stratum, r.keep) for r in op.decide(op.text_features(more), {(None, "words"): 5.0}).collect()}
    assert kept["n3"] == (None, False) and kept["d1"] == (None, True) and kept["d2"] == ("", True)
    assert op.text_features(spark.createDataFrame([("a", "É Ü b", "fr")], docs.schema)).first().capitals == 2 / 5


def test_false_rejections_stay_within_the_risk(spark):
    """Enough good texts of one language: rules bite, and lose at most the stated share of good ones."""
    rows = [(i, " ".join(f"word{(i * 7 + k) % 997}" for k in range(40)) + (" ##" * 40 if i % 10 == 0 else "")) for i in range(4000)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i, _ in rows], "doc_id long, quality int")
    out = op.apply_rules(docs, labels).collect()
    good = [r for r in out if r.doc_id % 10]
    assert sum(not r.keep for r in good) <= op.RISK * len(good)
    assert all(not r.keep for r in out if r.doc_id % 10 == 0)
