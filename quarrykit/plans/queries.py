"""Every operator over the test tables, with the SQL of its result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrykit.functions import domain as D
from quarrykit.functions import text as X
from quarrykit.functions import vectors as V
from quarrykit.operators import geometry as G
from quarrykit.operators import keyed_logs as K
from quarrykit.operators import pairing as P
from quarrykit.operators import quality as Q
from quarrykit.operators import reports as R
from quarrykit.operators import selection as S
from quarrykit.operators import voxels as VX
from quarrykit.plans.frames import frame, sql_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_BY_ORDER = {"side_a": "order_a", "side_b": "order_b"}


def _add(name: str, sql: str | None, make: Callable[..., DataFrame], *frames: str) -> None:
    """``make`` gets the named frames. What reads the sides is registered over the orders too, as ``name_by_order``."""
    QUERIES[name] = lambda spark, sf_dir: make(*[frame(spark, sf_dir, f) for f in frames])
    if sql:
        ORACLE[name] = sql_of(sql)
    if not set(frames).isdisjoint(_BY_ORDER):
        over = lambda text: re.sub(r"\{(side_[ab])\}", lambda m: "{" + _BY_ORDER[m[1]] + "}", text)
        _add(f"{name}_by_order", over(sql) if sql else None, make, *[_BY_ORDER.get(f, f) for f in frames])


_T = "CASE coalesce({c}, '') WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 WHEN 'negative' THEN 3 ELSE 4 END"


def _rank(c: str) -> str:
    return _T.replace("{c}", c)


# --- keyed logs ----------------------------------------------------------------------------

_add("k01_ids_first_seen", "SELECT k, min(pos) AS first_pos, count(*) AS n FROM {rows} r GROUP BY k", lambda r: K.ids_first_seen(r, "k"), "rows")
_FIRST = "SELECT k, qty, flag, pos FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos, flag) AS r FROM (SELECT k, pos, min(qty) AS qty, min(flag) AS flag FROM {rows} r WHERE k <> '' GROUP BY k, pos) q) q WHERE r = 1"
_ONE = lambda r: r.groupBy("k", "pos").agg(F.min("qty").alias("qty"), F.min("flag").alias("flag"))
_add("k02_dedup_first", _FIRST, lambda r: K.first_rows(_ONE(r), "k"), "rows")
_add("k03_merge_last_wins", "SELECT k, arg_max(qty, pos) AS qty, max(pos) AS pos, min(pos) AS first_pos FROM (SELECT DISTINCT k, pos, qty FROM {rows} r WHERE k <> '') q GROUP BY k", lambda r: K.last_wins(r.select("k", "pos", "qty").distinct(), "k"), "rows")
_add("k04_merge_any_key", "SELECT k, max(pos) AS pos, min(pos) AS first_pos FROM {rows} r WHERE k IS NOT NULL GROUP BY k", lambda r: K.last_wins(r.select("k", "pos").distinct(), "k", empty_keys=True), "rows")
_add("k04_conflicts", "SELECT k, count(DISTINCT concat(CAST(qty AS STRING), '|', flag)) AS versions FROM {rows} r GROUP BY k HAVING count(DISTINCT concat(CAST(qty AS STRING), '|', flag)) > 1", lambda r: K.conflicts(r, "k"), "rows")
_add("k05_merge_scores", "SELECT edit_id, arg_max(score, pos) AS score, max(pos) AS pos, min(pos) AS first_pos FROM {log} l GROUP BY edit_id", lambda g: K.last_wins(g.select("edit_id", "score", "pos"), "edit_id"), "log")


def _reconciled(log: DataFrame, edits: DataFrame) -> DataFrame:
    rows = log.withColumn("bad", F.col("pos") % 97 == 0).withColumn("edit_id", F.when(F.col("pos") % 89 == 0, "").otherwise(F.col("edit_id")))
    want = log.where("pos % 3 = 0").select("edit_id")
    return K.reconcile(rows.where("pos < 2000"), rows.where("pos >= 2000"), want)[1]


_add(
    "k06_reconcile",
    """WITH l AS (SELECT CASE WHEN pos % 89 = 0 THEN '' ELSE edit_id END AS edit_id, pos, status, pos % 97 = 0 AS bad FROM {log} g),
    m AS (SELECT edit_id, arg_max(status, pos) AS status FROM l WHERE NOT bad AND edit_id <> '' GROUP BY edit_id), w AS (SELECT DISTINCT edit_id FROM {log} g WHERE pos % 3 = 0)
    SELECT (SELECT count(*) FROM l WHERE bad) AS bad_lines, (SELECT count(*) FROM l WHERE NOT bad AND edit_id = '') AS missing_id_rows, (SELECT count(*) FROM l) AS total_rows,
    (SELECT count(*) FROM m ANTI JOIN w USING (edit_id)) AS unexpected_ids, (SELECT count(*) FROM w ANTI JOIN m USING (edit_id)) AS missing_expected_ids,
    (SELECT count(*) FROM m WHERE status = 'success') AS done_success_ids, (SELECT count(*) FROM m) AS merged_ids,
    (SELECT count(*) FROM (SELECT edit_id FROM l WHERE NOT bad AND edit_id <> '' AND pos >= 2000 GROUP BY edit_id HAVING count(*) > 1) d) AS duplicate_ids""",
    _reconciled, "log", "edits",
)
_add(
    "k07_worker_outputs",
    """WITH p AS (SELECT DISTINCT edit_id FROM {edits} e WHERE qty > 10), r AS (SELECT edit_id, count(*) AS n FROM (SELECT edit_id FROM {edits} e WHERE qty < 40 UNION ALL SELECT edit_id FROM {edits} e WHERE qty BETWEEN 20 AND 22) u GROUP BY edit_id),
    b AS (SELECT coalesce(p.edit_id, r.edit_id) AS edit_id, coalesce(n, 0) AS n, p.edit_id IS NULL AS extra FROM p FULL JOIN r ON p.edit_id = r.edit_id)
    SELECT edit_id, 'missing' AS problem, n FROM b WHERE n = 0 UNION ALL SELECT edit_id, 'duplicate', n FROM b WHERE n > 1 UNION ALL SELECT edit_id, 'unexpected', n FROM b WHERE extra""",
    lambda e: K.worker_outputs(e.where("qty > 10"), e.where("qty < 40").select("edit_id").unionByName(e.where("qty between 20 and 22").select("edit_id")), "edit_id"), "edits",
)
_add("k08_overlapping_dispatch", "SELECT o AS k, count(DISTINCT supp % 4) AS buckets FROM {lines} l GROUP BY o HAVING count(DISTINCT supp % 4) > 1", lambda d: K.overlapping_dispatch(d.select(F.col("o").alias("k"), (F.col("supp") % 4).alias("b")), "k", "b"), "lines")
_add("k14_right_wins", "SELECT edit_id, tier FROM {scores} s WHERE edit_id NOT IN (SELECT edit_id FROM {listed} l) UNION ALL SELECT edit_id, 'listed' FROM {listed} l", lambda s, li: K.union_right_wins(s.select("edit_id", "tier"), li.withColumn("tier", F.lit("listed")), "edit_id"), "scores", "listed")
_add("j01_resume_success", "SELECT DISTINCT e.obj_id FROM {objects} e WHERE NOT EXISTS (SELECT 1 FROM {log} l WHERE l.edit_id = e.obj_id AND l.status = 'success')", lambda o, g: K.not_succeeded(o.select(F.col("obj_id").alias("edit_id")), g, "edit_id").select(F.col("edit_id").alias("obj_id")).distinct(), "objects", "log")
_add("j01_succeeded_last", "SELECT edit_id FROM {log} l GROUP BY edit_id HAVING arg_max(status, pos) = 'success'", lambda g: K.succeeded_last(g, "edit_id"), "log")
_add("j02_resume_existing", "SELECT count(*) AS n FROM {objects} o WHERE obj_id NOT IN (SELECT edit_id FROM {log} l)", lambda o, g: K.not_existing(o.select(F.col("obj_id").alias("edit_id")), g, "edit_id").agg(F.count("*").alias("n")), "objects", "log")
_add("j03_resume_two_sources", "SELECT edit_id FROM {edits} e WHERE edit_id NOT IN (SELECT edit_id FROM {scores} s) AND edit_id NOT IN (SELECT edit_id FROM {files} f WHERE after_path IS NOT NULL)", lambda e, s, f: K.not_done(e, "edit_id", s, f.where("after_path is not null")).select("edit_id"), "edits", "scores", "files")
_add("j22_cross_check", "SELECT edit_id, 'missing' AS problem FROM {listed} l WHERE edit_id NOT IN (SELECT edit_id FROM {scores} s) UNION ALL SELECT edit_id, 'unexpected' FROM {scores} s WHERE edit_id NOT IN (SELECT edit_id FROM {listed} l)", lambda a, b: K.cross_check(a, b, "edit_id"), "listed", "scores")
_add("w01_sequences", "SELECT edit_id, CAST(row_number() OVER (PARTITION BY shard, edit_type ORDER BY pos) - 1 AS INT) AS seq FROM {edits} e", lambda e: K.sequence_numbers(e.drop("seq"), ["shard", "edit_type"]).select("edit_id", "seq"), "edits")
_add("w02_planner_ids", "SELECT concat('del_', obj_id, '_', lpad(CAST(row_number() OVER (PARTITION BY obj_id ORDER BY part_id) - 1 AS STRING), 3, '0')) AS edit_id, part_id FROM {parts} p", lambda p: K.sequence_numbers(p, ["obj_id"], "part_id").select(F.format_string("del_%s_%03d", "obj_id", "seq").alias("edit_id"), "part_id"), "parts")
_add("w12_duplicates", "SELECT k, count(*) AS n FROM {rows} r GROUP BY k HAVING count(*) > 1", lambda r: K.duplicate_counts(r, "k"), "rows")
_add("a05_status_counts", "SELECT CASE WHEN pos % 97 = 0 THEN '<bad json>' ELSE coalesce(CASE WHEN pos % 11 > 0 THEN status END, '?') END AS status, count(*) AS n FROM {log} l GROUP BY 1", lambda g: K.status_counts(g.withColumn("bad", F.col("pos") % 97 == 0).withColumn("status", F.when(F.col("pos") % 11 > 0, F.col("status"))), bad="bad"), "log")
_add("s02_read_counts", "SELECT (SELECT count(*) FROM {rows} r WHERE qty = 3) AS bad_lines, (SELECT count(*) FROM {rows} r WHERE qty <> 3 AND k = '') AS missing_id_rows, (SELECT count(*) FROM {rows} r) AS total_rows", lambda r: __import__("quarrykit.sources.logs", fromlist=["x"]).read_counts(r.withColumn("bad", F.col("qty") == 3), "k"), "rows")

# --- filters and projections ---------------------------------------------------------------

_add("p01_p04_types", "SELECT edit_id FROM {edits} e WHERE edit_type IN ('deletion', 'scale', 'addition')", lambda e: S.of_types(e, ["deletion", "scale"], ["addition"]).select("edit_id"), "edits")
_add("p02_shards", "SELECT edit_id FROM {edits} e WHERE shard IN ('01', '07')", lambda e: S.of_shards(e, ["01", "07"]).select("edit_id"), "edits")
_add("p03_included", "SELECT e.edit_id FROM {edits} e SEMI JOIN {listed} l ON e.edit_id = l.edit_id", lambda e, li: S.included(e, li, "edit_id", 5).select("edit_id"), "edits", "listed")
_add("p05_min_tier", f"SELECT edit_id FROM {{scores}} s WHERE {_rank('tier')} <= 2", lambda s: S.at_least(s, "low").select("edit_id"), "scores")
_add("p06_min_tier_lenient", f"SELECT e.edit_id FROM {{edits}} e LEFT JOIN {{scores}} s ON e.edit_id = s.edit_id WHERE s.tier IS NULL OR {_rank('s.tier')} <= 1", lambda e, s: S.at_least(e.select("edit_id").join(s, "edit_id", "left"), "medium", lenient=True).select("edit_id"), "edits", "scores")
_add("p07_tier_fallback", "SELECT e.edit_id, coalesce(s.tier, CASE WHEN e.qty > 20 THEN 'low' END, 'rejected') AS tier FROM {edits} e LEFT JOIN {scores} s ON e.edit_id = s.edit_id", lambda e, s: e.join(s.select("edit_id", "tier"), "edit_id", "left").select("edit_id", D.tier_of(F.col("tier"), F.when(F.col("qty") > 20, "low")).alias("tier")), "edits", "scores")
_add("p08_voxel_limit", "SELECT edit_id, qty <= 30 AND supp <= 40 AS usable FROM {edits} e", lambda e: S.within_voxels(e, 30, "qty").withColumn("u", F.col("usable")).select("edit_id", (F.col("u") & (F.col("supp") <= 40)).alias("usable")), "edits")
_add(
    "p09_p13_ids",
    """SELECT edit_id, CASE WHEN edit_type IN ('modification', 'scale', 'material', 'global') THEN 'gpu' ELSE 'non_gpu' END AS route,
    CASE edit_type WHEN 'deletion' THEN 'Deletion' WHEN 'addition' THEN 'Addition' WHEN 'scale' THEN 'Scale' WHEN 'material' THEN 'Material' WHEN 'global' THEN 'Global' ELSE 'Modification' END AS effective,
    edit_type AS of_id, obj_id AS object, lpad(CAST(seq AS STRING), 3, '0') AS padded FROM {edits} e""",
    lambda e: e.select("edit_id", D.route(F.col("edit_type")).alias("route"), D.effective_type(F.col("edit_type")).alias("effective"), D.type_of_id(F.col("edit_id")).alias("of_id"), D.object_of_id(F.col("edit_id")).alias("object"), D.zero_padded(F.col("seq"), 3).alias("padded")), "edits",
)
_add("p10_worklist", "SELECT edit_id FROM {edits} e WHERE edit_type NOT IN ('identity', 'addition') AND edit_id NOT IN (SELECT edit_id FROM {scores} s) AND edit_id NOT IN (SELECT edit_id FROM {files} f WHERE after_path IS NOT NULL)", lambda e, s, f: S.worklist(e, s, f.where("after_path is not null")).select("edit_id"), "edits", "scores", "files")
_CORE = "len(list_intersect(regexp_split_to_array(lower(label), '[_\\s-]+'), ['" + "', '".join(D.CORE_WORDS) + "'])) > 0"
_add("p20_p23_labels", f"SELECT obj_id, part_id, {_CORE} AS core, regexp_replace(label, ' [^ ]*$', '') AS short FROM {{parts}} p", lambda p: p.select("obj_id", "part_id", D.is_core(F.col("label")).alias("core"), D.node_label(F.replace("label", F.lit(" "), F.lit("_"))).alias("short")).withColumn("short", F.replace("short", F.lit("_"), F.lit(" "))), "parts")
_add("p22_padded_labels", "SELECT obj_id, array_to_string(list_transform(range(0, 4), lambda i: coalesce(ls[i + 1], 'unknown_' || i)), ',') AS labels FROM (SELECT obj_id, list_sort(list(label)) AS ls FROM {parts} p GROUP BY obj_id) q", lambda p: p.groupBy("obj_id").agg(F.array_sort(F.collect_list("label")).alias("ls")).select("obj_id", F.array_join(D.padded_labels(F.col("ls"), F.lit(4)), ",").alias("labels")), "parts")

# --- joins -----------------------------------------------------------------------------------

_add("j04_allowed", f"SELECT edit_id FROM {{edits}} e WHERE edit_id IN (SELECT edit_id FROM {{scores}} s WHERE {_rank('tier')} <= 1)", lambda e, s: S.allowed(e, S.at_least(s, "medium"), "edit_id").select("edit_id"), "edits", "scores")
_add("j05_include_closure", "SELECT edit_id FROM {edits} e WHERE edit_id IN (SELECT edit_id FROM {listed} l) OR (edit_type = 'addition' AND source_del_id IN (SELECT edit_id FROM {listed} l)) OR (edit_type = 'identity' AND obj_id IN (SELECT obj_id FROM {edits} f WHERE edit_type <> 'identity' AND edit_id IN (SELECT edit_id FROM {listed} l)))", S.include_closure, "edits", "listed")
_add("j06_source_seq", "SELECT e.edit_id, CASE WHEN e.edit_type = 'addition' THEN coalesce(d.seq, -1) END AS source_seq FROM {edits} e LEFT JOIN {edits} d ON d.edit_id = e.source_del_id AND d.obj_id = e.obj_id AND d.edit_type = 'deletion'", lambda e: P.with_source_seq(e).select("edit_id", "source_seq"), "edits")
_add("j07_addition_files", "SELECT a.edit_id, d.edit_id AS source_id, CASE WHEN d.edit_id IS NULL THEN 'error' ELSE 'ok' END AS status FROM {edits} a LEFT JOIN {edits} s ON s.edit_id = a.source_del_id LEFT JOIN {edits} d ON d.obj_id = a.obj_id AND d.edit_type = 'deletion' AND d.seq = coalesce(s.seq, -1) WHERE a.edit_type = 'addition'", lambda e: P.addition_files(P.with_source_seq(e)), "edits")
_add("j08_with_quality", "SELECT e.edit_id, s.tier, s.score FROM {edits} e LEFT JOIN {scores} s ON e.edit_id = s.edit_id", lambda e, q: P.with_quality(e, q).select("edit_id", "tier", "score"), "edits", "quality")
_add("j09_inherited_scores", "SELECT a.edit_id, s.tier, s.score, concat('Inherited from ', s.edit_id) AS reason FROM {edits} a JOIN {scores} s ON s.edit_id = a.source_del_id WHERE a.edit_type = 'addition'", P.inherited_scores, "edits", "scores")
_add("j10_promoted_additions", "SELECT a.edit_id, a.source_del_id, CASE WHEN f.before_path IS NOT NULL THEN f.after_path END AS before_path, f.before_path AS after_path, CASE WHEN f.before_path IS NULL THEN 'failed' ELSE 'success' END AS status FROM {edits} a LEFT JOIN {files} f ON f.edit_id = a.source_del_id WHERE a.edit_type = 'addition'", P.promoted_additions, "edits", "files")
_add("j11_paired_by_suffix", "SELECT d.edit_id AS del_id, a.edit_id AS add_id, concat('add_', substr(d.edit_id, 5)) AS reverse_id FROM {edits} d LEFT JOIN {edits} a ON a.edit_type = 'addition' AND substr(a.edit_id, 5) = substr(d.edit_id, 5) WHERE d.edit_type = 'deletion'", P.paired_by_suffix, "edits")
_add("j11b_paired_by_parts", "SELECT d.edit_id AS del_id, min(a.edit_id) AS add_id FROM {edits} d LEFT JOIN {edits} a ON a.edit_type = 'addition' AND a.obj_id = d.obj_id AND a.supp % 3 = d.supp % 3 WHERE d.edit_type = 'deletion' GROUP BY d.edit_id", lambda e: P.paired_by_parts(e.withColumn("part_ids", F.array((F.col("supp") % 3).cast("int"), (F.col("supp") % 3).cast("int")))), "edits")
_add("j19_prompts", "SELECT e.edit_id, coalesce(CASE WHEN g.reason <> '' THEN g.reason END, CASE WHEN e.qty > 25 THEN concat('Make it ', e.flag) END, CASE WHEN s.qty > 25 THEN concat('Add back make it ', s.flag) END, '') AS prompt FROM {edits} e LEFT JOIN {edits} s ON s.edit_id = e.source_del_id LEFT JOIN (SELECT edit_id, arg_max(reason, pos) AS reason FROM {log} l WHERE status = 'success' GROUP BY edit_id) g ON g.edit_id = e.edit_id", lambda e, g: P.resolved_prompts(e.select("edit_id", "source_del_id"), g.withColumn("prompt", F.col("reason")), e.select("edit_id", F.when(F.col("qty") > 25, F.concat(F.lit("Make it "), "flag")).otherwise("").alias("prompt"))), "edits", "log")
_W05 = "SELECT obj_id, min_by(edit_id, pos) AS source_id FROM {edits} r WHERE qty > 20 AND edit_type <> 'identity' GROUP BY obj_id"
_done = lambda e: e.where("edit_type <> 'identity'").withColumn("status", F.when(F.col("qty") > 20, "success").otherwise("failed"))
_add("w05_first_success", _W05.replace("source_id", "edit_id"), lambda e: P.first_success(_done(e)), "edits")
_add("j23_deferred_identities", f"SELECT e.edit_id, e.obj_id, f.source_id, CASE WHEN f.source_id IS NULL THEN 'failed' ELSE 'success' END AS status FROM {{edits}} e LEFT JOIN ({_W05}) f ON f.obj_id = e.obj_id WHERE e.edit_type = 'identity'", lambda e: P.deferred_identities(e, _done(e)), "edits")
_add("j24_backfilled_additions", "SELECT a.edit_id, CASE WHEN f.before_path IS NULL AND f.after_path IS NULL THEN 'no_pair' WHEN f.before_path IS NULL THEN 'no_before' WHEN f.after_path IS NULL THEN 'no_after' ELSE 'ok' END AS status FROM {edits} a LEFT JOIN {files} f ON f.edit_id = a.source_del_id WHERE a.edit_type = 'addition'", P.backfilled_additions, "edits", "files")
_add("o07_both_directions", "SELECT e.obj_id, e.edit_id, 'deletion' AS edit_type, f.before_path, f.after_path FROM {edits} e JOIN {files} f ON e.edit_id = f.edit_id WHERE e.edit_type = 'deletion' UNION ALL SELECT e.obj_id, concat('add_', substr(e.edit_id, 5)), 'addition', f.after_path, f.before_path FROM {edits} e JOIN {files} f ON e.edit_id = f.edit_id WHERE e.edit_type = 'deletion'", lambda e, f: P.both_directions(e.where("edit_type = 'deletion'").join(f, "edit_id")), "edits", "files")
_add("s31_packed_entries", "SELECT e.obj_id, e.edit_id, e.edit_type, CAST(row_number() OVER (PARTITION BY e.obj_id, e.edit_type ORDER BY e.pos) - 1 AS INT) AS seq, b.original_path, CASE WHEN e.edit_type NOT IN ('addition', 'identity') THEN f.after_path END AS file_path FROM {edits} e JOIN {files} f ON f.edit_id = e.edit_id LEFT JOIN (SELECT x.obj_id, min_by(y.before_path, x.pos) AS original_path FROM {edits} x JOIN {files} y ON x.edit_id = y.edit_id WHERE y.before_path IS NOT NULL GROUP BY x.obj_id) b ON b.obj_id = e.obj_id", lambda e, f: P.packed_object_entries(e, f), "edits", "files")
_add("s32_manifest", "SELECT shard, obj_id, CAST(row_number() OVER (PARTITION BY obj_id ORDER BY pos) - 1 AS INT) AS edit_idx, edit_id, edit_type FROM {edits} e", lambda e: P.manifest(e.groupBy("shard", "obj_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "edit_id", "edit_type"))), lambda s: F.struct(s["edit_id"].alias("edit_id"), s["edit_type"].alias("edit_type"))).alias("edits"))), "edits")
_add("s40_first_existing", "SELECT edit_id, coalesce(before_path, after_path) AS path FROM {files} f WHERE coalesce(before_path, after_path) IS NOT NULL", lambda f: P.first_existing(f.select("edit_id", F.col("before_path").alias("path"), F.lit(0).alias("rank")).unionByName(f.select("edit_id", F.col("after_path").alias("path"), F.lit(1).alias("rank"))).where("path is not null"), "edit_id"), "files")


def _candidates(p: DataFrame) -> DataFrame:
    cat = S.numbered(p, ["obj_id", "part_id"], "idx").select(
        (F.col("idx") + 1).cast("int").alias("idx"), "obj_id", F.col("kind").alias("category"), F.when(F.col("qty") > 10, F.when(F.col("qty") > 25, "a").otherwise("b")).alias("object_type"), "cluster_size", F.col("qty").alias("aspect")
    )
    return G.swap_candidates(cat, 3).select("idx", "candidate", F.col("rank").cast("int").alias("rank"))


_add(
    "j12_swap_candidates",
    """WITH c AS (SELECT CAST(row_number() OVER (ORDER BY obj_id, part_id) AS INT) AS idx, obj_id, kind, CASE WHEN qty > 25 THEN 'a' WHEN qty > 10 THEN 'b' END AS t, cluster_size AS s, qty AS r FROM {parts} p),
    m AS (SELECT a.idx, min(b.idx, 3) AS best FROM c a JOIN c b ON a.kind = b.kind WHERE a.obj_id <> b.obj_id AND coalesce(a.t = b.t, TRUE) AND (a.s <= 0 OR b.s <= 0 OR greatest(a.s, b.s) <= 5 * least(a.s, b.s)) AND (a.r <= 0 OR b.r <= 0 OR greatest(a.r, b.r) <= 2 * least(a.r, b.r)) GROUP BY a.idx)
    SELECT idx, unnest(best) AS candidate, CAST(unnest(range(1, len(best) + 1)) AS INT) AS rank FROM m""",
    _candidates, "parts",
)

# --- aggregates ------------------------------------------------------------------------------

_scored = lambda e, s: e.select("edit_id", "shard", "edit_type", "pos").join(s, "edit_id")
_add("a01_a02_summary", "SELECT shard, tier, edit_type, count(*) AS n, CAST(grouping_id(shard, tier, edit_type) AS INT) AS level FROM {edits} e JOIN {scores} s USING (edit_id) GROUP BY GROUPING SETS ((), (tier), (edit_type), (tier, edit_type), (shard), (shard, tier), (shard, edit_type), (shard, tier, edit_type))", lambda e, s: Q.summary(_scored(e, s), "shard"), "edits", "scores")
_add("a02_clean_counts", f"SELECT shard, count(*) AS n, count(*) FILTER (WHERE tier IN ('high', 'medium')) AS passed, count(*) FILTER (WHERE {_rank('tier')} <= 2) AS clean FROM {{edits}} e JOIN {{scores}} s USING (edit_id) GROUP BY shard", lambda e, s: Q.clean_counts(_scored(e, s), "low", "shard"), "edits", "scores")
_add("a03_stage_counts", "SELECT count(*) AS rows, count(DISTINCT k) AS ids, count(*) - count(DISTINCT k) AS duplicates FROM {rows} r", lambda r: R.stage_counts(r, "k"), "rows")
_add("a03_counts_by", "SELECT coalesce(CASE WHEN tax < 0.05 THEN flag END, 'unknown') AS value, count(*) AS n FROM {edits} e GROUP BY 1", lambda e: R.counts_by(e, F.when(F.col("tax") < 0.05, F.col("flag"))), "edits")
_add("a04_failure_reasons", "SELECT substr(reason, 1, 120) AS reason, count(*) AS n, min(pos) AS first_pos FROM {log} l WHERE status <> 'success' GROUP BY 1", lambda g: R.failure_reasons(g), "log")
_add("a06_category_summary", "SELECT kind AS category, count(*) AS parts, count(DISTINCT obj_id) AS objects FROM {parts} p GROUP BY kind ORDER BY parts DESC, category LIMIT 20", lambda p: R.category_summary(p.withColumn("category", F.col("kind"))), "parts")
_add("a07_type_counts", "SELECT obj_id, " + ", ".join(f"count(*) FILTER (WHERE edit_type = '{t}') AS \"{t}\"" for t in D.EDIT_TYPES) + " FROM {edits} e GROUP BY obj_id", lambda e: R.type_counts(e, D.EDIT_TYPES), "edits")
_add("a08_quality_report", "SELECT count(*) AS total, count(*) FILTER (WHERE qty > 20) AS passed, count(*) FILTER (WHERE NOT qty > 20) AS failed, round(count(*) FILTER (WHERE qty > 20) / greatest(count(*), 1), 4) AS pass_rate, round(avg(disc), 4) AS mean_score, round(median(disc), 4) AS median_score FROM {edits} e", lambda e: Q.quality_report(e.select((F.col("qty") > 20).alias("passed"), F.col("disc").alias("score"))), "edits")
_add("a10_tier_distribution", "SELECT tier, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 1) AS percent FROM {scores} s GROUP BY tier", Q.tier_distribution, "scores")
_add("a11_match_report", "SELECT priority AS category, count(*) AS n, count(l.edit_id) AS matched, count(*) - count(l.edit_id) AS unmatched FROM {objects} o LEFT JOIN (SELECT DISTINCT edit_id FROM {log} g) l ON l.edit_id = o.obj_id GROUP BY priority", lambda o, g: R.match_report(o.withColumn("category", F.col("priority")), g.select(F.col("edit_id").alias("obj_id")), "obj_id"), "objects", "log")
_add("a12_training_meta", "SELECT objects, edits, edit_type, n FROM (SELECT count(DISTINCT obj_id) AS objects, count(*) AS edits FROM {edits} e) w CROSS JOIN (SELECT edit_type, count(*) AS n FROM {edits} e GROUP BY edit_type) k", lambda e: P.training_meta(e).select("objects", "edits", F.explode("by_type").alias("t")).select("objects", "edits", "t.edit_type", "t.n"), "edits")
_add("a14_passed_per_object", "SELECT e.obj_id, count(*) AS n, count(*) FILTER (WHERE tier IN ('high', 'medium')) AS passed, count(*) FILTER (WHERE tier = 'high') AS clean FROM {edits} e JOIN {scores} s USING (edit_id) GROUP BY e.obj_id", lambda e, s: Q.clean_counts(e.select("edit_id", "obj_id").join(s, "edit_id"), "high", "obj_id"), "edits", "scores")
_add("a15_majority_labels", "SELECT obj_id, arg_min(cluster_size, CAST(-n AS BIGINT) * 1000 + cluster_size) AS cluster_size FROM (SELECT obj_id, cluster_size, count(*) AS n FROM {parts} p GROUP BY ALL) q GROUP BY obj_id", lambda p: G.majority_labels(p, "obj_id", "cluster_size"), "parts")
_PIX = "(SELECT CAST(l_orderkey % 300 AS STRING) AS obj_id, CAST(l_partkey % 5 AS INT) AS \"view\", CAST(l_suppkey % 4 AS INT) - 1 AS part FROM {lineitem})"
_pix = lambda li, key="l_orderkey % 300": li.select(F.expr(key).cast("string").alias("obj_id"), (F.col("l_partkey") % 5).cast("int").alias("view"), ((F.col("l_suppkey") % 4).cast("int") - 1).alias("part"))
_PIX_BY_ORDER = _PIX.replace("l_orderkey % 300", "l_orderkey")
_pix_by_order = lambda li: _pix(li, "l_orderkey")
_add("a16_pixel_counts", f'SELECT obj_id, "view", part, count(*) AS n FROM {_PIX} q WHERE part >= 0 GROUP BY ALL', lambda li: G.pixel_counts(_pix(li)), "lineitem")
_add("a16_pixel_counts_by_order", f'SELECT obj_id, "view", part, count(*) AS n FROM {_PIX_BY_ORDER} q WHERE part >= 0 GROUP BY ALL', lambda li: G.pixel_counts(_pix_by_order(li)), "lineitem")
_add("w06_best_views", f'WITH c AS (SELECT obj_id, "view" AS v, part, count(*) AS n FROM {_PIX} q WHERE part >= 0 GROUP BY ALL) SELECT p.obj_id, p.part, CAST(coalesce(b.v, 0) AS INT) AS "view" FROM (SELECT DISTINCT obj_id, part FROM {_PIX} q) p LEFT JOIN (SELECT obj_id, part, arg_max(v, n * 10 - v) AS v FROM c GROUP BY obj_id, part) b ON b.obj_id = p.obj_id AND b.part = p.part', lambda li: G.best_views(G.pixel_counts(_pix(li)), _pix(li)), "lineitem")
_add("w06_best_views_by_order", f'WITH c AS (SELECT obj_id, "view" AS v, part, count(*) AS n FROM {_PIX_BY_ORDER} q WHERE part >= 0 GROUP BY ALL) SELECT p.obj_id, p.part, CAST(coalesce(b.v, 0) AS INT) AS "view" FROM (SELECT DISTINCT obj_id, part FROM {_PIX_BY_ORDER} q) p LEFT JOIN (SELECT obj_id, part, arg_max(v, n * 10 - v) AS v FROM c GROUP BY obj_id, part) b ON b.obj_id = p.obj_id AND b.part = p.part', lambda li: G.best_views(G.pixel_counts(_pix_by_order(li)), _pix_by_order(li)), "lineitem")
_add("w07_best_view_of_set", f'WITH c AS (SELECT obj_id, "view" AS v, count(*) AS n FROM {_PIX} q WHERE part IN (0, 1) AND "view" NOT IN (0, 3) GROUP BY ALL), p AS (SELECT DISTINCT obj_id FROM {_PIX} q WHERE part IN (0, 1)) SELECT p.obj_id, CAST(coalesce(b.v, 0) AS INT) AS "view" FROM p LEFT JOIN (SELECT obj_id, arg_max(v, n * 10 - v) AS v FROM c GROUP BY obj_id) b ON b.obj_id = p.obj_id', lambda li: G.best_view_of_set(G.pixel_counts(_pix(li)), _pix(li).where("part in (0, 1)"), skip=(0, 3)), "lineitem")
_add("w07_best_view_of_set_by_order", f'WITH c AS (SELECT obj_id, "view" AS v, count(*) AS n FROM {_PIX_BY_ORDER} q WHERE part IN (0, 1) AND "view" NOT IN (0, 3) GROUP BY ALL), p AS (SELECT DISTINCT obj_id FROM {_PIX_BY_ORDER} q WHERE part IN (0, 1)) SELECT p.obj_id, CAST(coalesce(b.v, 0) AS INT) AS "view" FROM p LEFT JOIN (SELECT obj_id, arg_max(v, n * 10 - v) AS v FROM c GROUP BY obj_id) b ON b.obj_id = p.obj_id', lambda li: G.best_view_of_set(G.pixel_counts(_pix_by_order(li)), _pix_by_order(li).where("part in (0, 1)"), skip=(0, 3)), "lineitem")
_add("a23_stage_costs", "SELECT edit_type AS stage, count(*) AS n, CAST(CASE edit_type WHEN 'deletion' THEN 0.5 WHEN 'scale' THEN 0.0209 ELSE 0.0 END AS DOUBLE) AS unit, round(count(*) * CAST(CASE edit_type WHEN 'deletion' THEN 0.5 WHEN 'scale' THEN 0.0209 ELSE 0.0 END AS DOUBLE), 6) AS cost FROM {edits} e GROUP BY edit_type", lambda e: R.stage_costs(e.groupBy(F.col("edit_type").alias("stage")).agg(F.count("*").alias("n")), {"deletion": 0.5, "scale": 0.0209}), "edits")
_add("a24_slimming", "SELECT CAST(sum(num) AS BIGINT) AS old, CAST(sum(CAST(floor(num * 3 / 7) AS BIGINT)) AS BIGINT) AS new, round(100 * (sum(num) - sum(CAST(floor(num * 3 / 7) AS BIGINT))) / sum(num), 2) AS percent FROM {objects} o", lambda o: R.slimming(o.select(F.col("num").alias("size"), F.lit(3).alias("kept"), F.lit(7).alias("views"))), "objects")
_add("a25_totals", "SELECT CAST(sum(seq) AS BIGINT) AS seq, CAST(sum(supp) AS BIGINT) AS supp FROM {edits} e", lambda e: R.totals(e, "seq", "supp"), "edits")

# --- order, limits, samples, partitions --------------------------------------------------------

_add("t01_limit", "SELECT edit_id FROM {edits} e WHERE edit_type = 'scale' ORDER BY pos LIMIT 25", lambda e: S.included(S.of_types(e, ["scale"]), None, "edit_id", 25).select("edit_id"), "edits")
_add("t02_top_counts", "SELECT part AS value, count(*) AS n, min(pos) AS first_pos FROM {edits} e GROUP BY part ORDER BY n DESC, first_pos LIMIT 20", lambda e: S.top_counts(e, F.col("part")), "edits")
_add("t05_first_k", "SELECT edit_id FROM (SELECT edit_id, row_number() OVER (PARTITION BY edit_type ORDER BY pos) AS r FROM {edits} e) q WHERE r <= 7", lambda e: S.first_k(e, 7, ["edit_type"], ["pos"]).select("edit_id"), "edits")
_add("t07_sampled_templates", "SELECT obj_id, t AS template, CAST(draw AS INT) AS draw FROM (SELECT obj_id, ['red', 'green', 'blue', 'grey'][i + 1] AS t, row_number() OVER (PARTITION BY obj_id ORDER BY md5(concat_ws('|', 's', obj_id, CAST(i AS STRING)))) AS draw FROM (SELECT obj_id, unnest(range(0, 4)) AS i FROM {objects} o) q) q WHERE draw <= 2", lambda o: S.sampled_templates(o.select("obj_id"), ["red", "green", "blue", "grey"], 2, "s", "obj_id").select("obj_id", "template", F.col("draw").cast("int").alias("draw")), "objects")
_add("t09_grouped_shuffle", "SELECT edit_id, row_number() OVER (ORDER BY md5(concat_ws('|', '8', shard, obj_id)), shard, obj_id, md5(concat_ws('|', '8', edit_id)), edit_id) - 1 AS place FROM {edits} e", lambda e: S.numbered(e, S.shuffle_order(7, 1), "place").select("edit_id", "place"), "edits")
_add("w08_modulo_parts", "SELECT obj_id, CAST((row_number() OVER (ORDER BY num) - 1) % 6 AS INT) AS part FROM {objects} o", lambda o: S.modulo_part(o.select("obj_id", "num"), ["num"], 6).select("obj_id", "part"), "objects")
_add("w10_range_parts", "SELECT obj_id, CAST(floor((row_number() OVER (ORDER BY num) - 1) / ceil((SELECT count(*) FROM {objects} o) / 7)) AS INT) AS part FROM {objects} o", lambda o: S.range_part(o.select("obj_id", "num"), ["num"], 7).select("obj_id", "part"), "objects")
_add("w11_chunks", "WITH d AS (SELECT shard AS obj_id, edit_id, CAST(floor((row_number() OVER (PARTITION BY shard ORDER BY pos) - 1) / 20) AS INT) AS chunk FROM {edits} e WHERE edit_type = 'deletion') SELECT * FROM d UNION ALL SELECT a.shard, a.edit_id, d.chunk FROM {edits} a JOIN d ON d.edit_id = a.source_del_id WHERE a.edit_type = 'addition'", lambda e: S.chunks_with_additions(e.withColumn("obj_id", F.col("shard"))), "edits")
_add(
    "o01_packed",
    """WITH RECURSIVE g AS MATERIALIZED (SELECT obj_id, n, row_number() OVER (ORDER BY n DESC, p, obj_id) AS i FROM (SELECT obj_id, count(*) AS n, min(pos) AS p FROM {edits} e GROUP BY obj_id) q),
    s AS (SELECT 0 AS i, CAST(NULL AS VARCHAR) AS obj_id, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS bucket, [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0] AS loads
      UNION ALL SELECT g.i, g.obj_id, g.n, list_position(s.loads, list_min(s.loads)) - 1, list_transform(s.loads, lambda x, k: x + CASE WHEN k = list_position(s.loads, list_min(s.loads)) THEN g.n ELSE 0 END) FROM s JOIN g ON g.i = s.i + 1)
    SELECT obj_id, n, CAST(bucket AS INT) AS bucket FROM s WHERE i > 0""",
    lambda e: S.packed(e.select("obj_id", "pos"), 8), "edits",
)

# --- arrays and voxels ------------------------------------------------------------------------

_A, _B = "CAST(a AS DOUBLE[])", "CAST(b AS DOUBLE[])"
_va, _vb = (lambda: V.doubles(F.col("a"))), (lambda: V.doubles(F.col("b")))
_add("m02_m05_latents", f"SELECT id, round(list_dot_product({_A}, {_B}) / (sqrt(list_dot_product({_A}, {_A})) * sqrt(list_dot_product({_B}, {_B}))), 6) AS cosine, round(list_distance({_A}, {_B}) / sqrt(list_dot_product({_A}, {_A})), 6) AS l2, round(list_max([abs(x - y) for x, y in zip_(a, b)]), 6) AS diff FROM {{vectors}} v".replace("list_max([abs(x - y) for x, y in zip_(a, b)])", f"list_max(list_transform(range(1, 65), lambda i: abs(({_A})[i] - ({_B})[i])))"), lambda v: v.select("id", F.round(V.cosine(_va(), _vb()), 6).alias("cosine"), F.round(V.relative_l2(_va(), _vb()), 6).alias("l2"), F.round(V.max_difference(_va(), _vb()), 6).alias("diff")), "vectors")
_add("a19_array_stats", f"SELECT id, round(list_avg({_A}), 6) AS mean, round(list_stddev_pop({_A}), 6) AS std, round(list_max(list_transform({_A}, lambda x: abs(x))), 6) AS top FROM {{vectors}} v", lambda v: v.select("id", F.round(V.mean(_va()), 6).alias("mean"), F.round(V.deviation(_va()), 6).alias("std"), F.round(V.max_abs(_va()), 6).alias("top")), "vectors")
_add("m19_blend", f"SELECT id, i, round(({_A})[i + 1] + 0.25 * (({_B})[i + 1] - ({_A})[i + 1]), 6) AS x FROM (SELECT *, unnest(range(0, 64)) AS i FROM {{vectors}} v) q", lambda v: v.select("id", F.posexplode(V.blend(_va(), _vb(), 0.25)).alias("i", "x")).select("id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x")), "vectors")
_SIZES = "(SELECT coalesce(a.obj_id, b.obj_id) AS obj_id, count(*) FILTER (WHERE b.obj_id IS NULL) AS only_a, count(*) FILTER (WHERE a.obj_id IS NULL) AS only_b, count(*) FILTER (WHERE a.obj_id = b.obj_id) AS common FROM (SELECT DISTINCT * FROM {side_a} q) a FULL JOIN (SELECT DISTINCT * FROM {side_b} q) b USING (obj_id, x, y, z) GROUP BY 1)".replace("USING (obj_id, x, y, z)", "ON a.obj_id = b.obj_id AND a.x = b.x AND a.y = b.y AND a.z = b.z")
_add("k10_k11_locality", f"SELECT *, CASE WHEN only_a + only_b + common = 0 THEN 0.0 ELSE (only_a + only_b) / (only_a + only_b + common) END AS locality FROM {_SIZES} s", lambda a, b: VX.locality(VX.set_sizes(a, b)), "side_a", "side_b")
_add("k12_vertex_difference", f"SELECT obj_id, (only_a + only_b) / (greatest(only_a, only_b) + common) AS difference FROM {_SIZES} s", lambda a, b: VX.vertex_difference(a.select("obj_id", *[F.col(c).cast("double").alias(c) for c in "xyz"]), b.select("obj_id", *[F.col(c).cast("double").alias(c) for c in "xyz"])), "side_a", "side_b")
_add("k15_k16_minus", "SELECT a.obj_id, x, y, z FROM {side_a} a ANTI JOIN {side_b} b USING (obj_id, x, y, z)", VX.minus, "side_a", "side_b")
_add("k15_union", "SELECT obj_id, x, y, z FROM {side_a} a UNION SELECT obj_id, x, y, z FROM {side_b} b", VX.union, "side_a", "side_b")
_add("a18_boxes", "SELECT obj_id, count(*) AS n, " + ", ".join(f"min({c}) AS {c}_lo, max({c}) AS {c}_hi, (min({c}) + max({c})) / 2 AS {c}_mid" for c in "xyz") + ", sqrt(" + " + ".join(f"(max({c}) - min({c})) * (max({c}) - min({c}))" for c in "xyz") + ") AS diagonal FROM {side_a} a GROUP BY obj_id", VX.boxes, "side_a")
_BOXES = "(SELECT obj_id, " + ", ".join(f"min({c}) AS {c}l, max({c}) AS {c}h" for c in "xyz") + " FROM {%s} q GROUP BY obj_id)"
_INTER = " * ".join(f"greatest(least(a.{c}h, b.{c}h) - greatest(a.{c}l, b.{c}l), 0)" for c in "xyz")
_VOL = lambda s: " * ".join(f"greatest({s}.{c}h - {s}.{c}l, 1)" for c in "xyz")


def _iou(a: DataFrame, b: DataFrame) -> DataFrame:
    left, right = (VX.boxes(v).select("obj_id", *[F.col(f"{c}_{e}").alias(f"{s}{c}{e}") for c in "xyz" for e in ("lo", "hi")]) for v, s in ((a, "a"), (b, "b")))
    box = lambda s, e: [F.col(f"{s}{c}{e}") for c in "xyz"]
    return left.join(right, "obj_id").select("obj_id", F.round(V.box_iou(box("a", "lo"), box("a", "hi"), box("b", "lo"), box("b", "hi")), 9).alias("iou"))


_add("m01_box_iou", f"SELECT obj_id, round(i / (v + w - i), 9) AS iou FROM (SELECT a.obj_id, CAST({_INTER} AS DOUBLE) AS i, {_VOL('a')} AS v, {_VOL('b')} AS w FROM {_BOXES % 'side_a'} a JOIN {_BOXES % 'side_b'} b ON a.obj_id = b.obj_id) q", _iou, "side_a", "side_b")
_add("a22_unique_cells", "SELECT obj_id, count(*) AS n, count(DISTINCT (x, y, z)) AS n_unique FROM {side_a} a GROUP BY obj_id", VX.unique_cells, "side_a")
_add(
    "q17_components",
    """WITH RECURSIVE c AS (SELECT DISTINCT obj_id, least(greatest(x, 0), 63) * 4096 + least(greatest(y, 0), 63) * 64 + least(greatest(z, 0), 63) AS i FROM {side_a} a), s(d) AS (VALUES (1), (64), (4096)),
    e AS (SELECT a.obj_id, a.i, b.i AS j FROM c a CROSS JOIN s JOIN c b ON b.obj_id = a.obj_id AND b.i = a.i + s.d WHERE (a.i // s.d) % 64 <> 63), n AS MATERIALIZED (SELECT obj_id, i, j FROM e UNION ALL SELECT obj_id, j, i FROM e),
    l(obj_id, i, label) USING KEY (obj_id, i) AS (SELECT obj_id, i, i FROM c UNION (SELECT n.obj_id, n.i, min(l.label) FROM l JOIN n ON n.obj_id = l.obj_id AND n.j = l.i JOIN recurring.l r ON r.obj_id = n.obj_id AND r.i = n.i GROUP BY n.obj_id, n.i, r.label HAVING min(l.label) < r.label))
    SELECT obj_id, CAST(count(DISTINCT label) AS INT) AS components FROM l GROUP BY obj_id""",
    VX.components, "side_a",
)
_add("j13_nearest_labels", "SELECT u.obj_id, u.x, u.y, u.z, arg_min(k.label, ((u.x - k.x) * (u.x - k.x) + (u.y - k.y) * (u.y - k.y) + (u.z - k.z) * (u.z - k.z)) * 1000000 + k.x * 10000 + k.y * 100 + k.z) AS label FROM (SELECT DISTINCT * FROM {side_a} a WHERE x < 2) u JOIN (SELECT DISTINCT obj_id, x, y, z, CASE WHEN y > 5 THEN 'up' ELSE 'down' END AS label FROM {side_b} b WHERE x >= 2) k ON k.obj_id = u.obj_id GROUP BY ALL", lambda a, b: VX.nearest_labels(a.where("x < 2").distinct(), b.where("x >= 2").distinct().withColumn("label", F.when(F.col("y") > 5, "up").otherwise("down"))).where("label is not null"), "side_a", "side_b")
_add("o14_dilated", "WITH m AS (SELECT DISTINCT * FROM {side_a} a WHERE x < 3), d AS (SELECT DISTINCT m.obj_id, m.x + s.dx AS x, m.y + s.dy AS y, m.z + s.dz AS z FROM m CROSS JOIN (VALUES (0,0,0),(1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) s(dx, dy, dz)) SELECT d.obj_id, d.x, d.y, d.z FROM d SEMI JOIN {side_b} b USING (obj_id, x, y, z)", lambda a, b: VX.dilated(a.where("x < 3"), b, 1), "side_a", "side_b")
_add(
    "j14_voted_region",
    """WITH o AS (SELECT DISTINCT obj_id, x, y, z FROM {side_a} a), b AS (SELECT obj_id, greatest(min(x) - 3, 0) AS x0, least(max(x) + 3, 63) AS x1, greatest(min(y) - 3, 0) AS y0, least(max(y) + 3, 63) AS y1, greatest(min(z) - 3, 0) AS z0, least(max(z) + 3, 63) AS z1 FROM o WHERE x < 4 GROUP BY obj_id),
    g AS (SELECT obj_id, x, y, unnest(range(z0, z1 + 1)) AS z FROM (SELECT obj_id, x, unnest(range(y0, y1 + 1)) AS y, z0, z1 FROM (SELECT obj_id, unnest(range(x0, x1 + 1)) AS x, y0, y1, z0, z1 FROM b) q) q), e AS (SELECT g.* FROM g ANTI JOIN o ON o.obj_id = g.obj_id AND o.x = g.x AND o.y = g.y AND o.z = g.z),
    v AS (SELECT e.obj_id, e.x, e.y, e.z, arg_min(o.x < 4, ((e.x - o.x) * (e.x - o.x) + (e.y - o.y) * (e.y - o.y) + (e.z - o.z) * (e.z - o.z)) * 1000000 + o.x * 10000 + o.y * 100 + o.z, 100) AS near FROM e JOIN o ON o.obj_id = e.obj_id GROUP BY ALL)
    SELECT obj_id, CAST(x AS INT) AS x, CAST(y AS INT) AS y, CAST(z AS INT) AS z FROM v WHERE 2 * len(list_filter(near, lambda f: f)) > len(near)""",
    lambda a: VX.voted_region(a, a.where("x < 4")), "side_a",
)
_add("m22_voxelised", "SELECT DISTINCT obj_id, " + ", ".join(f"greatest(0, least(63, CAST(floor(({c} / 12.0 - 0.5 + 0.5) * 64) AS INT))) AS {c}" for c in "xyz") + " FROM {side_a} a", lambda a: VX.voxelised(a.select("obj_id", *[(F.col(c) / 12.0 - 0.5).alias(c) for c in "xyz"])), "side_a")
_add("a21_j17_gap", "WITH p AS (SELECT * FROM {side_a} a WHERE z < 3), b AS (SELECT * FROM {side_b} b WHERE z >= 3), d AS (SELECT p.obj_id, p.x, p.y, p.z, min(sqrt((p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y) + (p.z - b.z) * (p.z - b.z))) AS d FROM p JOIN b ON p.obj_id = b.obj_id GROUP BY ALL) SELECT obj_id, round(quantile_cont(d, 0.1), 6) AS gap FROM d GROUP BY obj_id", lambda a, b: G.gap_distance(a.where("z < 3"), b.where("z >= 3")).select("obj_id", F.round("gap", 6).alias("gap")), "side_a", "side_b")
_CAM_SQL = "SELECT obj_id, pos AS view, CAST(qty - 25 AS DOUBLE) AS cx, CAST(disc * 100 - 5 AS DOUBLE) AS cy, CAST(supp % 30 AS DOUBLE) AS cz, supp % 3 > 0 AS has_image FROM {edits} e"
_add("j16_orthogonal_views", f"WITH f AS ({_CAM_SQL}), a AS (SELECT *, bool_or(has_image) OVER (PARTITION BY obj_id) AS any_image FROM f), g AS (SELECT a.*, t.target, degrees(atan2(cy, cx)) AS az, degrees(asin(cz / sqrt(cx * cx + cy * cy + cz * cz))) AS el FROM a CROSS JOIN (VALUES (0.0), (90.0), (180.0), (-90.0)) t(target) WHERE has_image OR NOT any_image), d AS (SELECT *, round(sqrt((CASE WHEN abs(az - target) > 180 THEN 360 - abs(az - target) ELSE abs(az - target) END) ** 2 + (el - 25) ** 2), 9) AS dist FROM g) SELECT obj_id, CAST(target AS DOUBLE) AS target, view FROM (SELECT *, row_number() OVER (PARTITION BY obj_id, target ORDER BY dist, view) AS r FROM d) q WHERE r = 1", lambda e: G.orthogonal_views(e.select("obj_id", F.col("pos").alias("view"), (F.col("qty") - 25).cast("double").alias("cx"), (F.col("disc") * 100 - 5).cast("double").alias("cy"), (F.col("supp") % 30).cast("double").alias("cz"), (F.col("supp") % 3 > 0).alias("has_image"))), "edits")

# --- text -----------------------------------------------------------------------------------------

_STOP = "little|big|large|small|main|second|first|outer|inner|lower|upper|bottom|top|back|rear|front|right|left"
_add("x01_categories", f"SELECT DISTINCT label, coalesce(nullif(array_to_string(list_filter(regexp_split_to_array(lower(trim(label)), '[_\\-\\s]+'), lambda w: w <> '' AND NOT regexp_full_match(w, '{_STOP}|\\pN+')), '_'), ''), lower(label)) AS category FROM (SELECT label FROM {{parts}} p UNION ALL SELECT concat('Left ', part_id, '_', label, '-Main little SECOND') FROM {{parts}} p UNION ALL SELECT concat(' upper  ', part_id) FROM {{parts}} p) q", lambda p: p.select(F.explode(F.array("label", F.concat(F.lit("Left "), "part_id", F.lit("_"), "label", F.lit("-Main little SECOND")), F.concat(F.lit(" upper  "), "part_id"))).alias("label")).select("label", X.normal_category(F.col("label")).alias("category")).distinct(), "parts")
_add("x04_x16_labels", "SELECT DISTINCT label, trim(replace(replace(label, ' ', '_'), '_', ' ')) AS human, replace(replace(kind, '&&', ' and '), '-', ' ') AS clean FROM {parts} p", lambda p: p.select("label", X.human_label(F.replace("label", F.lit(" "), F.lit("_"))).alias("human"), X.clean_category(F.col("kind")).alias("clean")).distinct(), "parts")
_add("x05_templates", "SELECT obj_id, part_id, concat('Put the ', label, ' of ', kind, ' on ', substr(obj_id, 1, 8)) AS t FROM {parts} p", lambda p: p.select("obj_id", "part_id", X.fill_template(F.lit("Put the {part} of {obj} on {donor}"), part=F.col("label"), obj=F.col("kind"), donor=F.substring("obj_id", 1, 8)).alias("t")), "parts")
_SAID = [("remove  ", "Add "), ("Delete ", "Add "), ("TAKE AWAY ", "Add "), ("Take off ", "Put on "), ("get rid of ", "Add "), ("Cut off ", "Attach "), ("Detach ", "Attach "), ("  Eliminate ", "Add "), ("Strip ", "Add "), ("Lose ", "Add back lose "), ("Erase ", "Add back erase ")]
_add("x06_reversed_prompts", "SELECT edit_id, CASE pos % 12 " + " ".join(f"WHEN {i} THEN concat('{put}the ', flag)" for i, (_, put) in enumerate(_SAID)) + " ELSE '' END AS p FROM {edits} e", lambda e: e.select("edit_id", X.reversed_prompt(F.when(F.col("pos") % 12 == 11, F.lit("  ")).otherwise(F.concat(D.choose(F.col("pos") % 12, {i: said for i, (said, _) in enumerate(_SAID)}, ""), F.lit("the "), "flag"))).alias("p")), "edits")
_add("x13_x14_captions", "SELECT conv_id, turn, coalesce(substr(trim(regexp_replace(text, '\\s+', ' ', 'g')), 1, 80), '') AS c FROM {conversations}", lambda c: c.select("conv_id", "turn", F.substring(X.short_caption(F.array(F.lit(" "), F.col("text"))), 1, 80).alias("c")), "conversations")
_add("x18_data_urls", "SELECT conv_id, turn, concat('data:image/png;base64,', to_base64(encode(text))) AS u FROM {conversations}", lambda c: c.select("conv_id", "turn", X.data_url(F.encode("text", "UTF-8")).alias("u")), "conversations")
_add("n01_parsed", "SELECT event_id, CAST(CAST(props AS JSON) ->> '$.k' AS INT) AS k FROM {events}", lambda e: e.select("event_id", F.try_variant_get(__import__("quarrykit.operators.json_text", fromlist=["x"]).parsed(F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```"))), "$.k", "int").alias("k")), "events")
_add("n02_first_balanced", "SELECT event_id, props AS j FROM {events}", lambda e: e.select("event_id", __import__("quarrykit.operators.json_text", fromlist=["x"]).extracted(F.concat(F.lit("so "), "props", F.lit(" and {more}"))).alias("j")), "events")
_add("n03_n04_judged", "SELECT event_id, event_type = 'error' AS rejected, event_type <> 'error' AND value > 10 AS executed, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE event_id % 5 END AS INT) AS quality FROM {events}", lambda e: e.select("event_id", __import__("quarrykit.operators.json_text", fromlist=["x"]).judged(F.when(F.col("event_type") == "error", "none").otherwise(F.format_string('<think>{x}</think> first {"a": "}"} then {"edit_executed": %s, "visual_quality": %d}', (F.col("value") > 10).cast("string"), F.col("event_id") % 5))).alias("j")).select("event_id", "j.rejected", "j.executed", "j.quality"), "events")

# --- checks --------------------------------------------------------------------------------------------


def _measured(e: DataFrame) -> DataFrame:
    q, d, t = F.col("qty"), F.col("disc"), F.col("tax")
    known = lambda c: F.when(F.col("supp") % 19 > 0, c)  # noqa: E731 - some edits have no structure latent
    return e.select(
        "edit_id", "edit_type", "pos", "shard", (q * 40).alias("n_voxels"), (q + 1).alias("feat_max"), (d + 0.005).alias("feat_std"), known((q * 2.1)).alias("ss_max"), known(t / 10 + 0.0005).alias("ss_std"), F.lit(0).alias("coord_min"), (q + 10).alias("coord_max"),
        F.when(F.col("supp") % 9 == 0, q * 40 - 1).otherwise(q * 40).alias("n_unique"), (q / 25).alias("voxel_ratio"), (d * 5).alias("deleted"), (d * 6).alias("added"), (1 - d * 9).alias("iou"), known(t * 10).alias("ss_l2"), known(1 - t * 10).alias("ss_cosine"), known(t / 50).alias("ss_diff"),
        (1 + F.col("supp") % 5).alias("components"), (d * 4).alias("locality"), (t * 5).alias("drift"), (d * 20).alias("feat_change"), (0.6 + d * 3).alias("axis_min"), (1 + t * 10).alias("axis_max"), (F.col("supp") % 4).alias("min_extent"), (d * 7).alias("coverage"),
        (F.col("supp") % 2 == 0).alias("same_count"), (F.col("supp") % 11 > 0).alias("has_after"), (F.col("supp") % 13 > 0).alias("has_original"),
    )


#: The rules as they are published: (type, rule, what passes, weight, whether it needs the structure latent), with every number written out.
_RULES_SQL = [
    ("deletion", "voxel_ratio", "qty / 25 BETWEEN 0.05 AND 0.95", "2", False), ("deletion", "delete_ratio", "disc * 5 BETWEEN 0.02 AND 0.80", "2", False), ("deletion", "bbox_iou", "1 - disc * 9 >= 0.15", "1.5", False),
    ("deletion", "ss_change", "tax * 10 BETWEEN 0.01 AND 0.90", "1", True), ("deletion", "connected_components", "1 + supp % 5 <= 3", "1.5", False), ("deletion", "not_degenerate", "supp % 4 > 1", "2", False),
    ("addition", "voxel_ratio", "qty / 25 BETWEEN 1.05 AND 20.0", "2", False), ("addition", "add_ratio", "disc * 6 BETWEEN 0.02 AND 0.80", "2", False), ("addition", "bbox_iou", "1 - disc * 9 >= 0.15", "1.5", False),
    ("modification", "voxel_ratio", "qty / 25 BETWEEN 0.3 AND 3.0", "1.5", False), ("modification", "ss_cosine_sim", "1 - tax * 10 >= 0.3", "2", True), ("modification", "edit_locality", "disc * 4 BETWEEN 0.02 AND 0.70", "2.5", False),
    ("modification", "connected_components", "1 + supp % 5 <= 5", "1", False), ("modification", "center_drift", "tax * 5 < 0.3", "1.5", False), ("modification", "feat_change", "disc * 20 < 5.0", "1", False),
    ("scale", "voxel_ratio", "qty / 25 BETWEEN 0.5 AND 2.0", "2", False), ("scale", "ss_cosine_sim", "1 - tax * 10 >= 0.5", "2.5", True), ("scale", "edit_locality", "disc * 4 BETWEEN 0.01 AND 0.50", "2", False),
    ("scale", "center_drift", "tax * 5 < 0.2", "1.5", False), ("scale", "bbox_axis_ratio", "0.6 + disc * 3 >= 0.7 AND 1 + tax * 10 <= 1.8", "1.5", False),
    ("material", "voxel_count_close", "abs(qty / 25 - 1) <= 0.01", "2", False), ("material", "ss_match", "tax / 50 < 0.001", "3", True), ("material", "feat_change", "disc * 20 BETWEEN 0.01 AND 2.0", "1.5", False),
    ("global", "voxel_count_close", "abs(qty / 25 - 1) <= 0.01", "2", False), ("global", "ss_match", "tax / 50 < 0.001", "3", True), ("global", "feat_change", "disc * 20 BETWEEN 0.02 AND 2.0", "1.5", False),
    ("global", "change_coverage", "supp % 2 > 0 OR disc * 7 >= 0.3", "CASE WHEN supp % 2 = 0 THEN 1.5 ELSE 0 END", False), ("identity", "identity_valid", "TRUE", "1", False),
]
_SANITY_SQL = [
    ("voxel_count", "qty * 40 BETWEEN 100 AND 40000", "2", False), ("feat_range", "qty + 1 <= 50 AND disc + 0.005 >= 0.01", "CASE WHEN qty + 1 > 50 THEN 3 ELSE 2 END", False),
    ("ss_range", "qty * 2.1 <= 100 AND tax / 10 + 0.0005 >= 0.001", "CASE WHEN qty * 2.1 > 100 THEN 3 ELSE 2 END", True), ("coords_valid", "qty + 10 < 64", "3", False), ("coords_unique", "supp % 9 <> 0", "2", False),
]


def _check_sql() -> str:
    """Rules as rows, so that the SQL is built another way than the projection: one row for each edit and rule, then sums."""
    of = lambda rows, kind: " UNION ALL ".join(f"SELECT edit_id, {i} AS i, '{n}' AS name, ({c}) AS ok, CAST({w} AS DOUBLE) AS w FROM e WHERE {kind(k)}{' AND supp % 19 > 0' if ss else ''}" for i, (k, n, c, w, ss) in enumerate(rows))
    one, two = of([("", *r) for r in _SANITY_SQL], lambda k: "TRUE"), of(_RULES_SQL, lambda k: f"edit_type = '{k}'")
    sums = "SELECT edit_id, round(sum(CASE WHEN ok THEN w ELSE 0 END) / sum(w), 4) AS s, bool_and(ok) AS ok, coalesce(arg_min(name, i) FILTER (WHERE NOT ok), '') AS f FROM ({}) q GROUP BY edit_id"
    return f"""WITH e AS (SELECT * FROM {{edits}} x), m AS (SELECT e.edit_id, edit_type, supp % 11 > 0 AS has_after, supp % 13 > 0 AS has_original, a.s AS s1, a.ok AS ok1, a.f AS f1, b.s AS s2, b.ok AS ok2, b.f AS f2
      FROM e JOIN ({sums.format(one)}) a ON a.edit_id = e.edit_id JOIN ({sums.format(two)}) b ON b.edit_id = e.edit_id)
    SELECT edit_id, round(CAST(CASE WHEN edit_type = 'identity' THEN CASE WHEN ok1 OR NOT has_original THEN 1.0 ELSE 0.5 END WHEN NOT has_after THEN 0.0 WHEN NOT ok1 THEN s1 * 0.5 WHEN NOT has_original THEN 0.0 ELSE CAST(format('{{:.4f}}', (s1 + s2) / 2) AS DOUBLE) END AS DOUBLE), 6) AS score,
      CASE WHEN edit_type = 'identity' THEN CASE WHEN ok1 OR NOT has_original THEN 'high' ELSE 'negative' END WHEN NOT has_after OR NOT ok1 OR NOT has_original THEN 'rejected' WHEN NOT ok2 THEN 'negative' WHEN (s1 + s2) / 2 >= 0.8 THEN 'high' WHEN (s1 + s2) / 2 >= 0.6 THEN 'medium' WHEN (s1 + s2) / 2 >= 0.4 THEN 'low' ELSE 'negative' END AS tier,
      CASE WHEN edit_type = 'identity' THEN '' WHEN NOT has_after THEN 'missing after' WHEN NOT ok1 THEN f1 WHEN NOT has_original THEN 'missing original' ELSE f2 END AS reason FROM m"""


_add("q01_q16_verdicts", _check_sql(), lambda e: Q.verdicts(_measured(e)).select("edit_id", F.round("score", 6).alias("score"), "tier", "reason"), "edits")
_add("a09_metric_pass_rates", "SELECT name, count(*) AS n, round(avg(CAST(ok AS INT)), 4) AS pass_rate FROM (SELECT 'voxel_count' AS name, qty * 40 BETWEEN 100 AND 40000 AS ok FROM {edits} e UNION ALL SELECT 'feat_range', qty + 1 <= 50 AND disc + 0.005 >= 0.01 FROM {edits} e UNION ALL SELECT 'ss_range', qty * 2.1 <= 100 AND tax / 10 + 0.0005 >= 0.001 FROM {edits} e WHERE supp % 19 > 0 UNION ALL SELECT 'coords_valid', qty + 10 < 64 FROM {edits} e UNION ALL SELECT 'coords_unique', supp % 9 <> 0 FROM {edits} e) q GROUP BY name", lambda e: Q.metric_pass_rates(_measured(e).select(Q.layer_one().alias("metrics"))), "edits")
_FLAGS = lambda: ((F.col("supp") % 10 > 0), (F.col("supp") % 7 > 0), (F.col("supp") % 5 > 0), (1 + F.col("part") % 5), (F.col("part") % 3 > 0), (F.col("supp") % 17 == 0))
_add("q40_m08_judge", "SELECT edit_id, CASE WHEN supp % 17 = 0 THEN 'rejected' WHEN supp % 10 = 0 OR supp % 7 = 0 THEN 'negative' WHEN supp % 5 > 0 AND part % 3 > 0 AND 1 + part % 5 >= 4 THEN 'high' WHEN supp % 5 > 0 AND part % 3 > 0 AND 1 + part % 5 >= 3 THEN 'medium' WHEN 1 + part % 5 >= 2 THEN 'low' ELSE 'negative' END AS tier, round(0.3 * CAST(supp % 10 > 0 AS INT) + 0.2 * CAST(supp % 7 > 0 AS INT) + 0.2 * CAST(supp % 5 > 0 AS INT) + 0.2 * (part % 5) / 4 + 0.1 * CAST(part % 3 > 0 AS INT), 4) AS score FROM {edits} e", lambda e: e.select("edit_id", V.judge_tier(*_FLAGS()).alias("tier"), V.judge_score(*_FLAGS()[:5]).alias("score")), "edits")
_add("q41_finalised", "SELECT e.edit_id, CASE WHEN edit_type = 'identity' THEN 'high' ELSE coalesce(s.tier, 'rejected') END AS tier, CASE WHEN edit_type = 'identity' THEN 1.0 ELSE coalesce(s.score, 0.0) END AS score FROM {edits} e LEFT JOIN {scores} s ON s.edit_id = e.edit_id", Q.finalised, "edits", "scores")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each shard how many edits survive at medium or better, with the reasons that the rest fail, most frequent first."""
    done = Q.verdicts(_measured(frame(spark, sf_dir, "edits")))
    good = D.tier_at_least(F.col("tier"), "medium")
    by = done.groupBy("shard", F.when(~good, F.col("reason")).alias("reason")).agg(F.count("*").alias("n"))
    return by.groupBy("shard").agg(F.sum("n").alias("edits"), F.sum(F.when(F.col("reason").isNull(), F.col("n")).otherwise(0)).alias("survive"), F.max_by("reason", F.when(F.col("reason").isNotNull(), F.struct("n", "reason"))).alias("top_reason"))


QUERIES["flagship_survival"] = flagship
ORACLE["flagship_survival"] = f"""WITH d AS (SELECT e.shard, v.tier, v.reason FROM ({sql_of(_check_sql())}) v JOIN ({sql_of('SELECT edit_id, shard FROM {edits} e')}) e USING (edit_id)),
r AS (SELECT shard, reason, count(*) AS n FROM d WHERE tier NOT IN ('high', 'medium') GROUP BY ALL), t AS (SELECT shard, reason, row_number() OVER (PARTITION BY shard ORDER BY n DESC, reason DESC) AS k FROM r)
SELECT d.shard, count(*) AS edits, CAST(count(*) FILTER (WHERE tier IN ('high', 'medium')) AS BIGINT) AS survive, any_value(t.reason) AS top_reason FROM d LEFT JOIN t ON t.shard = d.shard AND t.k = 1 GROUP BY d.shard"""


def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planner over orders as objects, their lines as parts, by rule-made records."""
    from quarrykit.operators import labels as L
    from quarrykit.operators.planner import plan

    parts = frame(spark, sf_dir, "parts")
    objects = parts.groupBy("obj_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("part_id", "label"))), lambda p: p["label"]).alias("labels")).withColumn("shard", F.lit("00"))
    return plan(L.by_rules(objects)).select("edit_id", "edit_type", "obj_id", "old_part_id", "source_del_id", "edit_prompt")


QUERIES["planner_specs"] = planned
_DRAWN = lambda kind, options: " UNION ALL ".join(f"SELECT '{kind}' AS kind, '{i}' AS k, '{t}' AS t" for i, t in enumerate(options))
ORACLE["planner_specs"] = sql_of(
    """WITH t AS ("""
    + " UNION ALL ".join(
        [
            _DRAWN("scale", ["Make the {part} larger", "Make the {part} smaller", "Stretch the {part} upwards", "Widen the {part}", "Double the height of the {part}", "Halve the {part} in size", "Make the {part} thinner", "Flatten the {part}"]),
            _DRAWN("material", ["Turn the {part} into wood", "Turn the {part} into brushed steel", "Give the {part} a marble surface", "Make the {part} of clear glass", "Cover the {part} with leather", "Cast the {part} in bronze", "Give the {part} a coat of matte paint", "Make the {part} of woven rattan"]),
            _DRAWN("identity", ["Leave the {obj} as it is", "Change nothing about the {obj}", "Keep the {obj} unchanged", "Return the {obj} without an edit", "Do not alter the {obj}", "Let the {obj} stay the same", "Make no edit to the {obj}", "Hand back the {obj} untouched"]),
        ]
    ).replace("{", "<").replace("}", ">")
    + """), p AS (SELECT obj_id, label, trim(replace(label, '_', ' ')) AS name, CAST(row_number() OVER (PARTITION BY obj_id ORDER BY part_id, label) - 1 AS INT) AS i, count(*) OVER (PARTITION BY obj_id) AS parts FROM {parts} x),
    q AS (SELECT *, len(list_intersect(regexp_split_to_array(lower(label), '[_\\s-]+'), ['body', 'torso', 'base', 'frame', 'main', 'head', 'wall', 'floor', 'chassis', 'hull', 'trunk'])) > 0 AS core FROM p WHERE parts >= 2),
    d AS (SELECT *, lpad(CAST(row_number() OVER (PARTITION BY obj_id ORDER BY i) - 1 AS VARCHAR), 3, '0') AS k FROM q WHERE NOT core),
    o AS (SELECT obj_id, concat('An object with ', string_agg(name, ', ' ORDER BY i)) AS whole FROM q GROUP BY obj_id),
    m AS (SELECT obj_id, kind, i, arg_min(replace(t, '<part>', name), md5(concat_ws('|', t.k, obj_id, kind, CAST(i AS VARCHAR)))) AS said FROM q CROSS JOIN t WHERE kind <> 'identity' GROUP BY obj_id, kind, i, name)
    SELECT concat('del_', obj_id, '_', k) AS edit_id, 'deletion' AS edit_type, obj_id, i AS old_part_id, '' AS source_del_id, concat('Remove the ', name) AS edit_prompt FROM d
    UNION ALL SELECT concat('add_', obj_id, '_', k), 'addition', obj_id, i, concat('del_', obj_id, '_', k), concat('Add the ', name) FROM d
    UNION ALL SELECT concat(CASE kind WHEN 'scale' THEN 'scl' ELSE 'mat' END, '_', obj_id, '_', lpad(CAST(row_number() OVER (PARTITION BY obj_id, kind ORDER BY i) - 1 AS VARCHAR), 3, '0')), kind, obj_id, i, '', said FROM m
    UNION ALL SELECT concat('idt_', obj_id, '_000'), 'identity', obj_id, -1, '', arg_min(replace(t, '<obj>', whole), md5(concat_ws('|', t.k, obj_id, kind))) FROM o CROSS JOIN t WHERE kind = 'identity' GROUP BY obj_id, whole"""
)


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that stay in the deletions of the planner."""
    from quarrykit.operators import labels as L
    from quarrykit.operators.planner import plan

    parts = frame(spark, sf_dir, "parts")
    objects = parts.groupBy("obj_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("part_id", "label"))), lambda p: p["label"]).alias("labels")).withColumn("shard", F.lit("00"))
    return plan(L.by_rules(objects), types=("deletion",)).select("obj_id", "old_part_id", F.array_join("keep_part_ids", ",").alias("keep"))


QUERIES["k13_keep_list"] = _kept
ORACLE["k13_keep_list"] = sql_of(
    """WITH q AS (SELECT obj_id, label, CAST(row_number() OVER (PARTITION BY obj_id ORDER BY part_id, label) - 1 AS INT) AS i FROM {parts} x)
    SELECT a.obj_id, a.i AS old_part_id, string_agg(CAST(b.i AS VARCHAR), ',' ORDER BY b.i) AS keep FROM q a JOIN q b ON b.obj_id = a.obj_id AND b.i <> a.i
    WHERE len(list_intersect(regexp_split_to_array(lower(a.label), '[_\\s-]+'), ['body', 'torso', 'base', 'frame', 'main', 'head', 'wall', 'floor', 'chassis', 'hull', 'trunk'])) = 0 GROUP BY a.obj_id, a.i"""
)
