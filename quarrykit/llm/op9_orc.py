"""Token ids as ORC.

Documents are encoded to token ids, decoded again for a check, and written as ORC: stripes of a fixed
size (each is a unit that one task can read), ids in the format's integer run-length encoding, a row
index with minima and maxima for every ``STRIDE`` rows, and Bloom filters on
doc_id. Rows are placed by ranges of doc_id and sorted in each, so files, stripes and row groups hold
narrow ranges of ids, and those that cannot hold an id are skipped by their metadata when
ids or a range of them are asked for.

The bounds of the ranges come from a sample of doc_ids (about ``PER_FILE`` for each file); they
place rows and decide nothing else. An id that fills several ranges, a null one too, is spread over all of them by
the digest of the row, so no task gets all rows of one id. Texts are not shuffled, their ids are, once. Writing goes through the
committer, so a lost executor's tasks are written again and no file comes twice.

Defined results: (doc_id, ids, n_tokens, round_trip), ``round_trip`` being whether the decoded ids are the text. A null text has
null ids, an empty one none. doc_ids keep their type. Repeated ones stay repeated, null ones are stored and found by no id. Other columns
are not looked at.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrykit.llm.op4_pieces import MODEL, codec, encode_column, read_model, slices, zipf_scores
from quarrykit.llm.words import trimmed
from quarrykit.sharedfs import new_path

STRIPE_BYTES, STRIDE, FALSE_POSITIVES = 16 << 20, 2_000, 0.01
PER_FILE = 100


class Places:
    """Ranges of doc_ids, nulls first."""

    def __init__(self, sample: list, n: int):
        self.n = n
        ids = [None] * sum(i is None for i in sample) + sorted(i for i in sample if i is not None)
        cuts = [ids[k * len(ids) // n] for k in range(1, n)] if ids else []
        self.nulls = sum(c is None for c in cuts)
        self.cuts = np.array(cuts[self.nulls :], object if cuts and isinstance(cuts[-1], str) else None)

    def of(self, ids: pa.Array, tokens: pa.ListArray, met: dict[bytes, int]) -> np.ndarray:
        """A place for each row. Rows of an id that has several take turns from their digest on; ``met`` counts equal rows, so the places do not depend on the rows' order."""
        known = np.flatnonzero(np.asarray(ids.is_valid()))
        lo, hi = np.zeros(len(ids), np.int64), np.full(len(ids), self.nulls, np.int64)
        if len(known):
            of = ids.take(pa.array(known))
            of = np.array(of.to_pylist(), object) if self.cuts.dtype == object else of.to_numpy(zero_copy_only=False)
            lo[known] = self.nulls + np.searchsorted(self.cuts, of, "left")
            hi[known] = self.nulls + np.searchsorted(self.cuts, of, "right")
        for i in np.flatnonzero(hi > lo).tolist():
            key = md5(f"{ids[i].as_py()!r}|{tokens[i].is_valid}|".encode("utf-8", "replace") + np.asarray(tokens[i].values if tokens[i].is_valid else (), np.int32).tobytes()).digest()
            turn = met[key] = met.get(key, -1) + 1
            lo[i] += (int.from_bytes(key[:4], "little") + turn) % (hi[i] - lo[i] + 1)
        return lo


def places(docs: DataFrame, id_col: str, files: int) -> Places:
    ids = docs.select(F.col(id_col).alias("i"))
    total = ids.count()
    share = min(1.0, PER_FILE * files / max(1, total))
    return Places([r.i for r in ids.where(F.rand(11) < share).collect()], files)


def write_tokens(docs: DataFrame, path: str, model: str = MODEL, stripe_bytes: int = STRIPE_BYTES, stride: int = STRIDE, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Encode ``docs`` and write (doc_id, ids, n_tokens, round_trip) under ``path``, in as many files as the session has shuffle partitions if not told."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = places(docs, id_col, files)
    shared = spark.sparkContext.broadcast((zipf_scores(read_model(model)), place))
    key = (model, "zipf")

    def run(batches):
        pieces, place = shared.value
        c, met = codec(key, lambda: pieces), {}
        for b in batches:
            for at, rows in slices(b.column(1)):
                part = b.slice(at, rows)
                ids, ok = encode_column(part.column(1), c)
                at_ = place.of(part.column(0), ids, met)
                yield pa.RecordBatch.from_arrays([part.column(0), ids.cast(pa.list_(arrow_kind)), pc.list_value_length(ids), ok, pa.array(at_.astype(np.int32))], names=["doc_id", "ids", "n_tokens", "round_trip", "place"])

    # ids of a vocabulary of at most 2**15 pieces move in two bytes each
    narrow = len(shared.value[0]) <= 1 << 15
    kind, arrow_kind = (T.ShortType(), pa.int16()) if narrow else (T.IntegerType(), pa.int32())
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(kind)), T.StructField("n_tokens", T.IntegerType()), T.StructField("round_trip", T.BooleanType()), T.StructField("place", T.IntegerType())])
    encoded = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(trimmed(run, key), schema)
    options = {
        "orc.stripe.size": stripe_bytes,
        "orc.row.index.stride": stride,
        "orc.create.index": "true",
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": FALSE_POSITIVES,
        "compression": "zstd",
    }
    encoded.repartitionById(files, "place").sortWithinPartitions("doc_id").withColumn("ids", F.col("ids").cast("array<int>")).drop("place").write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str, ids: list | None = None, between: tuple | None = None) -> DataFrame:
    """The written rows; with ``ids`` or ``between`` those alone, whose condition reaches the files', stripes' and row groups' metadata."""
    df = spark.read.orc(path)
    if ids is not None:
        df = df.where(F.col("doc_id").isin(list(ids)))
    if between is not None:
        df = df.where(F.col("doc_id").between(*between))
    return df


def op9_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the whole table, then read all of it back."""
    path = new_path(spark, "tokens-orc")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_tokens(spark, path)


QUERIES = {"op9_orc": op9_orc}
ORACLE: dict[str, str] = {}
