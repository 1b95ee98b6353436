import hashlib

import pytest

from quarrykit.llm.sampling import least_digests


@pytest.mark.parametrize("ids", [[i % 900 for i in range(1000)] + [None], [7] * 2000, [None] * 1500 + list(range(500)), [7] * 1500 + list(range(1500)), []])
def test_least_digests(spark, ids):
    df = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "i long, k long")
    rank = lambda row: (hashlib.md5(("" if row[0] is None else str(row[0])).encode()).hexdigest(), row[0] is not None, row[0] or 0, row[1])
    for n in (0, 5, 40, 5000):
        got = [tuple(r) for r in least_digests(df, "i", n, "k").collect()]
        assert got == sorted(((i, k) for k, i in enumerate(ids)), key=rank)[:n]
