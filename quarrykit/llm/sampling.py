"""A bounded sample that is the same for any layout of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_digests(df: DataFrame, id_col: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows of ``df`` with the least digest of ``id_col`` (all, if it has fewer); a null id has the digest of the empty string.

    Only rows under a bound that at least ``n`` digests meet are ranked, so what each task
    sends on does not grow with the number of tasks. The bound is raised until so many do; it changes no row of the result.
    """
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    total = df.select(id_col).count()
    share = 4 * n / max(1, total)
    while share < 1:
        under = df.where(place < F.lit(int(2**32 * share)))
        if under.select(id_col).count() >= n:
            df = under
            break
        share *= 8
    return df.orderBy(digest, id_col, *ties).limit(n)
