"""Objects as rows of lists, and what their Arrow batches need: many small objects are worked on side by side.

A group call costs about a millisecond for each object, whatever its size; here an object is one row that holds its lists
(made by one aggregate, so that rows of one place travel together), and Spark cuts the batches by bytes, so large objects come
few at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def packed(key: str, **sides: tuple[DataFrame, dict[str, Column]]) -> DataFrame:
    """One row for each key of any side, with a list for each named column; lists of a side that lacks the key are empty.

    The sides are laid one under another, so that one shuffle brings all of an object together.
    """
    names = {n: c for _, columns in sides.values() for n, c in columns.items()}
    kinds = {n: df.select(c.alias(n)).schema[n].dataType for df, columns in sides.values() for n, c in columns.items()}
    whole = None
    for df, columns in sides.values():
        one = df.select(F.col(key), *[(columns[n] if n in columns else F.lit(None).cast(kinds[n])).alias(n) for n in names])
        whole = one if whole is None else whole.unionByName(one)
    return whole.groupBy(key).agg(*[F.collect_list(n).alias(n) for n in names])


def number(c: str) -> Column:
    """A double; nulls, which a list would not hold, are NaN."""
    return F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))


class Lists:
    """List columns of a batch, laid end to end, with the row of each member."""

    def __init__(self, batch: pa.RecordBatch, *names: str):
        ends = [batch.column(n).offsets.to_numpy() for n in names]
        sizes = [np.diff(e) for e in ends]
        if any((s != sizes[0]).any() for s in sizes):
            raise ValueError(f"nulls in {', '.join(names)}")
        self.size, self.first = sizes[0].astype(np.int64), (ends[0][:-1] - ends[0][0]).astype(np.int64)
        self.row = np.repeat(np.arange(len(self.size)), self.size)
        self.values = [batch.column(n).flatten() for n in names]

    def numpy(self, kind=None) -> list[np.ndarray]:
        made = [v.to_numpy(zero_copy_only=False) for v in self.values]
        return made if kind is None else [m.astype(kind, copy=False) for m in made]


def by_batches(rows: DataFrame, run: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def inner(batches):
        for b in batches:
            if b.num_rows:
                yield from run(b)

    return rows.mapInArrow(inner, schema)


def rows_of(batch: pa.RecordBatch, key: str, at: np.ndarray, **columns) -> pa.RecordBatch:
    """The keys of the rows ``at`` with columns beside them."""
    return pa.RecordBatch.from_pydict({key: batch.column(key).take(pa.array(at)), **columns})


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + size[0] - 1, then those of the next."""
    to = np.cumsum(size)
    return np.arange(to[-1] if len(to) else 0) + np.repeat(first - (to - size), size)


def blocks(cost: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of neighbours that cost up to ``most`` together; what alone costs more stands alone."""
    lo, total = 0, np.concatenate([[0], np.cumsum(cost)])
    while lo < len(cost):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, side="right")) - 1)
        yield slice(lo, hi)
        lo = hi
