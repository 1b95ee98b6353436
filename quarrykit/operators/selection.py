"""Filters, limits, samples and partitions of work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrykit.functions import domain as D


def of_types(df: DataFrame, types, always=()) -> DataFrame:
    """Rows of some edit types; ``always`` are let through whatever is asked."""
    return df.where(F.col("edit_type").isin(*types, *always))


def of_shards(df: DataFrame, shards, empty_is_all: bool = True) -> DataFrame:
    if shards is None or (empty_is_all and not shards):
        return df
    return df.where(F.col("shard").isin(*shards)) if shards else df.where(F.lit(False))


def included(df: DataFrame, ids: DataFrame | None, key: str, limit: int | None = None, order: str = "pos") -> DataFrame:
    """Rows with a listed id; only without a list the limit applies."""
    if ids is not None:
        return df.join(ids.select(key).distinct(), key, "left_semi")
    return df.orderBy(order).limit(limit) if limit else df


def allowed(df: DataFrame, ids: DataFrame | None, key: str) -> DataFrame:
    """Semi-join with the allowed ids; None (no quality file was found) is no filter."""
    return df if ids is None else df.join(ids.select(key).distinct(), key, "left_semi")


def at_least(df: DataFrame, tier: str, lenient: bool = False, column: str = "tier") -> DataFrame:
    return df.where(D.tier_at_least_or_absent(F.col(column), tier) if lenient else D.tier_at_least(F.col(column), tier))


def worklist(specs: DataFrame, scored: DataFrame, cached: DataFrame, types=None, objects: DataFrame | None = None) -> DataFrame:
    """Edits to judge: no identity or addition, asked types and objects, neither scored nor rendered yet."""
    todo = specs.where(~F.col("edit_type").isin("identity", "addition"))
    if types:
        todo = of_types(todo, types)
    if objects is not None:
        todo = todo.join(objects.select("obj_id").distinct(), "obj_id", "left_semi")
    return todo.join(scored.select("edit_id").distinct(), "edit_id", "left_anti").join(cached.select("edit_id").distinct(), "edit_id", "left_anti")


def within_voxels(df: DataFrame, most: int, *sizes: str) -> DataFrame:
    """Rows marked ``usable`` if each side has at most so many voxels; nothing is replaced by a random row."""
    ok = F.lit(True)
    for s in sizes:
        ok = ok & (F.col(s) <= most)
    return df.withColumn("usable", ok)


def include_closure(edits: DataFrame, listed: DataFrame) -> DataFrame:
    """Ids listed, additions whose source deletion is listed, and identities of objects with a listed edit that is no identity."""
    ids = listed.select("edit_id").distinct()
    own = edits.join(ids, "edit_id", "left_semi")
    added = edits.where("edit_type = 'addition'").join(ids.withColumnRenamed("edit_id", "source_del_id"), "source_del_id", "left_semi")
    objects = own.where("edit_type <> 'identity'").select("obj_id").distinct()
    same = edits.where("edit_type = 'identity'").join(objects, "obj_id", "left_semi")
    return own.select("edit_id").unionByName(added.select("edit_id")).unionByName(same.select("edit_id")).distinct()


def top_counts(df: DataFrame, what: Column, n: int = 20, pos: str = "pos", name: str = "value") -> DataFrame:
    """The most frequent values; of equal ones that seen first."""
    found = df.where(what.isNotNull()).groupBy(what.alias(name)).agg(F.count("*").alias("n"), F.min(pos).alias("first_pos"))
    return found.orderBy(F.desc("n"), "first_pos").limit(n)


def first_k(df: DataFrame, k: int, by: list[str], order: list) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= k).drop("__r")


def digest_rank(seed: str, *columns: Column) -> Column:
    """A stable stand-in for a random draw: the digest of a seed and the row's key."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[c.cast("string") for c in columns]))


def sampled_templates(objects: DataFrame, templates: list[str], k: int, seed: str, *key: str) -> DataFrame:
    """``k`` distinct templates for each row, by the digest of the seed, the key and the template's number."""
    many = objects.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(templates) - 1))))
    drawn = many.withColumn("draw", F.row_number().over(W.partitionBy(*key).orderBy(digest_rank(seed, *[F.col(c) for c in key], F.col("i")))))
    return drawn.where(F.col("draw") <= k).withColumn("template", F.element_at(F.array(*map(F.lit, templates)), F.col("i") + 1)).drop("i")


def shuffle_order(seed: int, epoch: int) -> list[Column]:
    """Objects in a shuffled order and the edits of each together, shuffled too; another order each epoch."""
    token = str(seed + epoch)
    return [digest_rank(token, F.col("shard"), F.col("obj_id")), F.col("shard"), F.col("obj_id"), digest_rank(token, F.col("edit_id")), F.col("edit_id")]


def grouped_shuffle(edits: DataFrame, seed: int, epoch: int) -> DataFrame:
    """The edits in ``shuffle_order``."""
    return edits.orderBy(*shuffle_order(seed, epoch))


def even_views(n: int, k: int) -> list[int]:
    return sorted({int(i * n / k) for i in range(k)})


def modulo_part(df: DataFrame, order: list, n: int, name: str = "part") -> DataFrame:
    """Row i of the order goes to part i mod n. The numbering is a range sort with sums over its partitions, see ``numbered``."""
    return numbered(df, order).withColumn(name, (F.col("__n") % n).cast("int")).drop("__n")


def range_part(df: DataFrame, order: list, k: int, name: str = "part") -> DataFrame:
    """Parts of ceil(n / k) rows along the order; the last may be short or empty."""
    total = df.count()
    size = max(1, -(-total // k))
    return numbered(df, order).withColumn(name, F.floor(F.col("__n") / size).cast("int")).drop("__n")


def take_range_part(df: DataFrame, order: list, index: int, k: int) -> DataFrame:
    if not 0 <= index < k:
        raise ValueError(f"part {index} of {k}")
    return range_part(df, order, k, "__part").where(F.col("__part") == index).drop("__part")


def round_robin(pending: DataFrame, n: int, pos: str = "pos", name: str = "worker") -> DataFrame:
    """What is pending, dealt to ``n`` workers in its order."""
    return modulo_part(pending, [pos], n, name)


def best_first(rows: DataFrame, score: str = "score", pos: str = "pos") -> DataFrame:
    """Highest score first, equal ones as they came."""
    return rows.orderBy(F.desc_nulls_last(score), pos)


def in_process_order(edits: DataFrame, pos: str = "pos") -> DataFrame:
    """The edits of each object by type: deletions first, additions last, unknown types after all; each type as it came."""
    return edits.orderBy("obj_id", F.coalesce(D.choose(F.col("edit_type"), D.PROCESS_ORDER), F.lit(len(D.PROCESS_ORDER))), pos)


def phases(edits: DataFrame) -> list[tuple[str, DataFrame]]:
    """The types in the order in which a stream handles them: each made type, then additions, which take a deletion's arrays, then identities, which take any edit's."""
    order = [t for t in sorted(D.PROCESS_ORDER, key=D.PROCESS_ORDER.get) if t not in ("addition", "identity")]
    return [(t, edits.where(F.col("edit_type") == t)) for t in [*order, "addition", "identity"]]


def largest_groups(df: DataFrame, key: str = "obj_id", pos: str = "pos") -> DataFrame:
    """(key, n, first_pos), the largest group first, of equal ones that seen first."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(pos).alias("first_pos")).orderBy(F.desc("n"), "first_pos")


def members_to_drop(archives: DataFrame, keep: Column, names: str = "names") -> DataFrame:
    """``dropped`` and ``kept``: members of an archive that are not, and that are, wanted."""
    return archives.withColumns({"dropped": F.array_sort(F.array_except(names, keep)), "kept": F.array_sort(F.array_intersect(names, keep))})


def numbered(df: DataFrame, order: list, name: str = "__n") -> DataFrame:
    """Rows numbered from 0 along the order, without one task for all of them: rows are counted by
    range partition first, then numbered inside each from where it starts."""
    from quarrykit.sharedfs import cut

    ranged = cut(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "numbered")
    starts = ranged.groupBy("__p").agg(F.count("*").alias("__c")).withColumn("__s", F.coalesce(F.sum("__c").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__p", "__s")
    inside = F.row_number().over(W.partitionBy("__p").orderBy(*order)) - 1
    return ranged.join(starts, "__p").withColumn(name, F.col("__s") + inside).drop("__p", "__s")


def chunks_with_additions(edits: DataFrame, size: int = 20) -> DataFrame:
    """Deletions of an object in chunks of ``size``, each with the additions that come of its deletions."""
    chunked = edits.where("edit_type = 'deletion'").withColumn("chunk", F.floor((F.row_number().over(W.partitionBy("obj_id").orderBy("pos")) - 1) / size).cast("int"))
    added = edits.where("edit_type = 'addition'").join(chunked.select(F.col("edit_id").alias("source_del_id"), "chunk"), "source_del_id")
    return chunked.select("obj_id", "edit_id", "chunk").unionByName(added.select("obj_id", "edit_id", "chunk"))


def packing_turns(sizes: list[tuple[int, int]], buckets: int) -> list[tuple[int, list[tuple[int, list[int]]]]]:
    """Largest first to the bucket with the least load, the lowest on a tie, for ``sizes`` (size, how many): for each size the runs (first, buckets that take turns from there on).

    A bucket's turns of one size end at loads that lie that size apart, so those of all buckets interleave: it joins once the others reach
    its level, and within a level they go by what their loads exceed it."""
    loads, made = [0] * buckets, []
    for n, many in sorted(sizes, reverse=True):
        level = [load // n for load in loads]
        steps, first, runs, got = sorted(set(level)), 0, [], [0] * buckets
        for at, after in zip(steps, [*steps[1:], None]):
            turn = sorted((b for b in range(buckets) if level[b] <= at), key=lambda b: (loads[b] % n, b))
            take = many - first if after is None else min((after - at) * len(turn), many - first)
            runs.append((first, turn))
            for i, b in enumerate(turn):
                got[b] += take // len(turn) + (i < take % len(turn))
            first += take
            if first == many:
                break
        loads = [load + n * g for load, g in zip(loads, got)]
        made.append((n, runs))
    return made


def packed(edits: DataFrame, buckets: int, key: str = "obj_id", pos: str = "pos") -> DataFrame:
    """(key, n, bucket): objects kept together, the largest first (of equal ones that seen first) to the bucket with the least load.

    The driver sees how many objects there are of each size, at most the root of twice the rows; objects are numbered in that order over range partitions and read their
    bucket off their number."""
    from quarrykit.sharedfs import cut

    groups = cut(edits.groupBy(key).agg(F.count("*").alias("n"), F.min(pos).alias("p")), "groups")
    sizes = [(r["n"], r["k"]) for r in groups.groupBy("n").agg(F.count("*").alias("k")).collect()]
    first, rows = 0, []
    many = dict(sizes)
    for n, runs in packing_turns(sizes, buckets):
        rows.append((n, first, runs))
        first += many[n]
    turns = edits.sparkSession.createDataFrame(rows, "n bigint, first bigint, runs array<struct<start: bigint, turn: array<int>>>")
    at = F.col("__n") - F.col("first")
    run = F.element_at(F.filter("runs", lambda r: r["start"] <= at), -1)
    bucket = F.get(run["turn"], ((at - run["start"]) % F.size(run["turn"])).cast("int"))
    return numbered(groups, [F.desc("n"), F.col("p"), F.col(key)]).join(turns, "n").select(key, "n", bucket.alias("bucket"))
