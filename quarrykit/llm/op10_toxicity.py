"""Toxicity by cumulative-link ordinal regression over sparse words.

Grades. Labels say only toxic or not, so a grade is made of the label and how
much of the text carries it: 0 is labelled clean; of the labelled toxic, 1, 2
and 3 hold up to three, up to eight, and more occurrences of features that the
labels single out (in at least ``MIN_TOXIC`` toxic sample texts and at least
``LIFT`` times as frequent among toxic as among clean ones; a word and its
beginning are two features).

Model. P(grade > k) = sigmoid(w.x - t_k) with t_0 < t_1 < t_2 and one weight
vector w for all thresholds; x has log(1 + count) of each hashed word and of
the first four letters of longer words. Features are screened first: those in at least
``MIN_TEXTS`` sample texts whose presence differs between the classes by a
chi-square of ``SCREEN``. An L1 penalty by proximal gradient then leaves few
with a weight, so a long clean text does not add up noise. Equal texts count once. Expected severity is the sum of the three
probabilities. A text is rejected where P(grade > 0) is at least one half.

Fitting reads at most ``SAMPLE`` labelled rows, those with the least digest of
their doc_id, so it is the same for any layout; that is the only bounded
part. Their hashed words come to the driver, not their texts. The fitted
weights, all that the penalty leaves (features of the sample, so bounded with it), go out with the tasks; every text is
scored whole.

Defined results: a null or empty text has no features and the severity of an
empty text, and is not rejected. Where labels lack one of the two classes
nothing is rejected and severity is the share of toxic labels. Texts that are equal in words and label count once; null labels are left out.
Repeated rows repeat; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrykit.llm.sampling import least_digests
from quarrykit.llm.words import trim, trimmed

SAMPLE, BITS, GRADES = 12_000, 22, 4
MIN_TOXIC, LIFT = 3, 20.0
#: Triples that are counted at once.
SLICE = 1 << 19
MIN_TEXTS, SCREEN, L1, STEPS = 3, 15.0, 1e-4, 400
_WORD = re.compile(r"\w+")


def bucket(word: str) -> int:
    return crc32(word.encode("utf-8", "replace")) & ((1 << BITS) - 1)


def buckets(word: str) -> tuple[int, ...]:
    """The features of a word: itself, and its beginning."""
    return (bucket(word), bucket("^" + word[:4])) if len(word) > 4 else (bucket(word),)


def counts(text: str | None) -> dict[int, int]:
    made: dict[int, int] = {}
    if text:
        for w in _WORD.findall(text.lower()):
            for b in buckets(w):
                made[b] = made.get(b, 0) + 1
    return made


def _hashed(batches):
    for b in batches:
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            made = [counts(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([list(m) for m in made], pa.list_(pa.int32())), pa.array([list(m.values()) for m in made], pa.list_(pa.int32()))],
                names=["toxic", "words", "times"],
            )


class Model:
    """Weights by word bucket, and the thresholds; without ``rejects`` no text is rejected."""

    def __init__(self, weights: dict[int, float], thresholds: list[float], rejects: bool = True):
        self.weights, self.thresholds, self.rejects = weights, thresholds, rejects

    def score(self, text: str | None) -> float:
        return sum(self.weights[b] * log1p(n) for b, n in counts(text).items() if b in self.weights)


def _sigmoid(z):
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def _tally(rows: np.ndarray, cols: np.ndarray, of: np.ndarray, width: int) -> np.ndarray:
    """For each bucket the triples whose row is ``of`` the class; in slices, as bincount copies what it counts into wider numbers."""
    made = np.zeros(width)
    for at in range(0, len(cols), SLICE):
        made += np.bincount(cols[at : at + SLICE][of[rows[at : at + SLICE]]], minlength=width)
    return made


def _compact(cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that occur, and ``cols`` as places among them."""
    seen = np.zeros(1 << BITS, bool)
    seen[cols] = True
    place = np.cumsum(seen, dtype=np.int32) - np.int32(1)
    return np.flatnonzero(seen), place[cols]


def grade(toxic: np.ndarray, rows: np.ndarray, cols: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Grades of sample texts given as (row, bucket, count) triples."""
    n, width = len(toxic), int(cols.max(initial=0)) + 1
    tox, clean = _tally(rows, cols, toxic == 1, width), _tally(rows, cols, toxic == 0, width)
    nt, nc = max(1, int(toxic.sum())), max(1, int((toxic == 0).sum()))
    marked = (tox >= MIN_TOXIC) & (tox / nt >= LIFT * (clean + 0.5) / nc)
    at = marked[cols]
    hits = np.bincount(rows[at], times[at], minlength=n)
    return np.where(toxic == 0, 0, np.where(hits <= 3, 1, np.where(hits <= 8, 2, 3)))


def fit(toxic: np.ndarray, rows: np.ndarray, cols: np.ndarray, times: np.ndarray) -> Model:
    """Accelerated proximal gradient on the mean negative log-likelihood."""
    n = len(toxic)
    met, cols = _compact(cols)
    y = grade(toxic, rows, cols, times)
    if n == 0 or y.max() == 0 or y.min() > 0:
        share = float(toxic.mean()) if n else 0.0
        return Model({}, [30.0 if share == 0 else float(np.log(1 / share - 1)) if share < 1 else -30.0, 60.0, 90.0], rejects=False)
    n1, n0 = float((y > 0).sum()), float((y == 0).sum())
    has1, has0 = _tally(rows, cols, y > 0, len(met)), _tally(rows, cols, y == 0, len(met))
    both = has1 + has0
    chi = (has1 * (n0 - has0) - has0 * (n1 - has1)) ** 2 * n / np.maximum(1.0, both * (n - both) * n1 * n0)
    keep = ((both >= MIN_TEXTS) & (chi >= SCREEN))[cols]
    rows, times = rows[keep].astype(np.int64), times[keep]
    used, cols = np.unique(cols[keep], return_inverse=True)
    used = met[used]
    x, d = np.log1p(times.astype(float)), len(used)
    w, t = np.zeros(d), np.array([1.0, 2.0, 3.0])
    w_mom, t_mom, speed, step = w.copy(), t.copy(), 1.0, 64.0

    def loss(w, t, grads=True):
        z = np.bincount(rows, w[cols] * x, minlength=n)
        upper = np.concatenate([[-np.inf], t, [np.inf]])
        hi, lo = _sigmoid(upper[y + 1] - z), _sigmoid(upper[y] - z)
        p = np.maximum(hi - lo, 1e-12)
        value = -np.log(p).mean()
        if not grads:
            return value
        dhi, dlo = hi * (1 - hi) / p / n, lo * (1 - lo) / p / n
        gt = np.array([dlo[y == k + 1].sum() - dhi[y == k].sum() for k in range(GRADES - 1)])
        return value, np.bincount(cols, (dhi - dlo)[rows] * x, minlength=d), gt

    for _ in range(STEPS):
        step *= 1.2
        value, gw, gt = loss(w_mom, t_mom)
        while True:
            new = w_mom - step * gw
            new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
            new_t = np.maximum.accumulate(np.sort(t_mom - step * gt) + np.arange(GRADES - 1) * 1e-6)
            dw, dt = new - w_mom, new_t - t_mom
            if loss(new, new_t, False) <= value + gw @ dw + gt @ dt + (dw @ dw + dt @ dt) / (2 * step) + 1e-12 or step < 1e-6:
                break
            step /= 2
        if dw @ (new - w) + dt @ (new_t - t) < 0:  # the momentum points uphill
            speed = 1.0
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        w_mom, t_mom = new + (speed - 1) / faster * (new - w), np.sort(new_t + (speed - 1) / faster * (new_t - t))
        w, t, speed = new, new_t, faster
    held = np.flatnonzero(w)
    return Model({int(used[i]): float(w[i]) for i in held}, [float(v) for v in t])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``sample`` labelled rows of ``docs``."""
    known = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = least_digests(known, "__id", sample, "toxic")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    made = texts.join(chosen, "__id").select("toxic", "text").mapInArrow(trimmed(_hashed), "toxic int, words array<int>, times array<int>").toArrow()
    toxic, n, words, times = _once(made)
    del made
    model = fit(toxic, np.repeat(np.arange(len(n), dtype=np.int32), n), words, times)
    del words, times
    trim()
    return model


def _once(made: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes, lengths, and all words and counts of the rows of ``made``, of equal ones the last; read in place, one batch after another."""
    last: dict[tuple[int, bytes], int] = {}
    rows: list[tuple[int, np.ndarray, np.ndarray]] = []
    for b in made.to_batches():
        lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (b.column(1), b.column(2))]
        for i, t in enumerate(b.column(0).to_pylist()):
            own, counted = (values[ends[i] : ends[i + 1]] for ends, values in lists)
            last[t, hashlib.md5(own.tobytes() + counted.tobytes(), usedforsecurity=False).digest()] = len(rows)
            rows.append((t, own, counted))
    once = [rows[i] for i in sorted(last.values())]
    none = [np.zeros(0, np.int32)]
    return np.array([t for t, _, _ in once], np.int32), np.array([len(w) for _, w, _ in once], np.int64), np.concatenate(none + [w for _, w, _ in once]), np.concatenate(none + [k for _, _, k in once])


class _Weights(dict):
    """word -> its features that have a weight, for the words that a worker has met."""

    def __init__(self, by_bucket: dict[int, float]):
        super().__init__()
        self.by_bucket = by_bucket

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(b for b in buckets(word) if b in self.by_bucket)
        if len(word) < 24:
            if len(self) > 400_000:
                self.clear()
            self[word] = found
        return found


def scorer(model: Model):
    """Column of texts -> struct of severity, grade and reject."""

    def scored(batches):
        weights = _Weights(model.weights)
        for texts in batches:
            z = np.zeros(len(texts))
            for i, t in enumerate(t for at in range(0, len(texts), 256) for t in texts.slice(at, 256).to_pylist()):
                if t:
                    found = [bs for bs in map(weights.__getitem__, _WORD.findall(t.lower())) if bs]
                    if found:
                        n: dict[int, int] = {}
                        for bs in found:
                            for b in bs:
                                n[b] = n.get(b, 0) + 1
                        z[i] = sum(model.weights[b] * log1p(k) for b, k in n.items())
            above = _sigmoid(z[:, None] - np.array(model.thresholds))
            severity = above.sum(axis=1)
            yield pa.StructArray.from_arrays([pa.array(severity), pa.array((above >= 0.5).sum(axis=1).astype(np.int32)), pa.array((above[:, 0] >= 0.5) & model.rejects)], names=["severity", "grade", "toxic"])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from trimmed(scored)(batches)

    return F.arrow_udf(run, "severity double, grade int, toxic boolean").asNondeterministic()


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, grade, toxic) for every row: expected severity, the most grades whose probability is a half, and whether it is rejected."""
    made = docs.select(F.col(id_col).alias("doc_id"), scorer(model)(F.col(text_col).cast("string")).alias("s"))
    return made.select("doc_id", "s.severity", "s.grade", "s.toxic")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    tagged = docs.select("*", scorer(model)(F.col(text_col).cast("string")).alias("__toxicity"))
    return tagged.where("not __toxicity.toxic").drop("__toxicity")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLE: dict[str, str] = {}
