"""The rest of the queries: discovery, packing, geometry and text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrykit.functions import domain as D
from quarrykit.functions import text as X
from quarrykit.functions import vectors as V
from quarrykit.operators import datasets as S
from quarrykit.operators import geometry as G
from quarrykit.operators import labels as L
from quarrykit.operators import reports as R
from quarrykit.operators import voxels as VX
from quarrykit.plans.queries import _add, _done

_paths = lambda f: f.select("edit_id", F.explode(F.array(F.struct(F.lit("before").alias("side"), F.col("before_path").alias("path")), F.struct(F.lit("after").alias("side"), F.col("after_path").alias("path")))).alias("s")).select(F.col("edit_id").alias("pair"), "s.side", "s.path").where("path is not null").withColumn("kind", F.lit("npz"))
_add("s34_flat_pairs", "SELECT edit_id AS pair, before_path AS before, after_path AS after FROM {files} f WHERE before_path IS NOT NULL AND after_path IS NOT NULL", lambda f: S.flat_pairs(_paths(f)), "files")
_add("p19_resolved_entries", "SELECT e.edit_id, CASE WHEN edit_type = 'addition' THEN s.after_path ELSE f.before_path END AS before, CASE edit_type WHEN 'addition' THEN s.before_path WHEN 'identity' THEN f.before_path ELSE f.after_path END AS after FROM {edits} e LEFT JOIN {files} f ON f.edit_id = e.edit_id LEFT JOIN {files} s ON s.edit_id = e.source_del_id", S.resolved_entries, "edits", "files")
_add("s35_discovered", "SELECT edit_id FROM (SELECT e.edit_id, row_number() OVER (PARTITION BY edit_type ORDER BY e.edit_id) AS r FROM {edits} e WHERE shard IN ('01', '02') AND edit_type IN ('scale', 'deletion') AND e.edit_id IN (SELECT edit_id FROM {scores} s WHERE tier IN ('high', 'medium'))) q WHERE r <= 9", lambda e, s: S.discovered(e, s, "medium", ["scale", "deletion"], ["01", "02"], 9).select("edit_id"), "edits", "scores")
_add("s41_prompt_map", "SELECT edit_id, arg_max(reason, pos) AS prompt FROM {log} l WHERE status = 'success' AND reason <> '' GROUP BY edit_id", lambda g: S.prompt_map(g.withColumn("prompt", F.col("reason"))), "log")
_add("s42_missing_before", "SELECT e.edit_id, CASE WHEN o.price > 50000 THEN o.obj_id END AS path, CASE WHEN o.price > 50000 THEN 'fixed' ELSE 'no_source' END AS status FROM {edits} e JOIN {files} f ON f.edit_id = e.edit_id LEFT JOIN {objects} o ON o.obj_id = e.obj_id WHERE edit_type IN ('modification', 'global') AND f.before_path IS NULL", lambda e, f, o: S.missing_before(e.join(f, "edit_id"), o.where("price > 50000").select("obj_id", F.col("obj_id").alias("path"))), "edits", "files", "objects")
_add("s33_migrated", "SELECT e.edit_id, CASE WHEN edit_type IN ('addition', 'identity') THEN 'linked' WHEN f.after_path IS NULL THEN 'no_after' WHEN b.shared IS NULL THEN 'no_before' ELSE 'converted' END AS status, b.shared FROM {edits} e JOIN {files} f ON f.edit_id = e.edit_id LEFT JOIN (SELECT x.obj_id, arg_min(y.before_path, x.pos) AS shared FROM {edits} x JOIN {files} y ON x.edit_id = y.edit_id WHERE y.before_path IS NOT NULL GROUP BY x.obj_id) b ON b.obj_id = e.obj_id", lambda e, f: S.migrated(e.join(f, "edit_id")), "edits", "files")
_add("p14_metadata_entries", "SELECT obj_id, edit_id, edit_type, seq, CASE WHEN edit_type = 'addition' THEN seq + 1 END AS source_seq, CASE WHEN edit_type IN ('deletion', 'addition', 'modification', 'scale', 'material') THEN part END AS part, CASE WHEN edit_type IN ('modification', 'scale', 'material', 'global') THEN flag END AS prompt, CASE WHEN edit_type = 'identity' THEN TRUE END AS same FROM {edits} e", lambda e: S.metadata_entries(e.withColumns({"source_seq": F.col("seq") + 1, "prompt": F.col("flag")})), "edits")
_add("o15_conditioning", "SELECT e.edit_id, CASE WHEN f.before_path IS NOT NULL THEN 'cache' WHEN f.after_path IS NOT NULL THEN 'render' ELSE 'none' END AS source, coalesce(f.before_path, f.after_path) AS path FROM {edits} e JOIN {files} f ON f.edit_id = e.edit_id", lambda e, f: S.conditioning(e, f.where("before_path is not null").select("edit_id", F.col("before_path").alias("path")), f.where("after_path is not null").select("edit_id", F.col("after_path").alias("path")), live=False), "edits", "files")
_add("o09_pending", "SELECT e.edit_id FROM {edits} e WHERE e.edit_id NOT IN (SELECT edit_id FROM {scores} s WHERE score > 0.3)", lambda e, s: S.pending(e, s.withColumn("valid", F.col("score") > 0.3)).select("edit_id"), "edits", "scores")
_add("s23_packed_status", "SELECT obj_id, CASE WHEN views = 0 THEN 'no_views' WHEN parts < 2 THEN 'too_few_parts' ELSE 'ok' END AS status, views, parts FROM (SELECT obj_id, CAST(sum(part_id) % 3 AS INT) AS views, CAST(count(*) AS INT) AS parts FROM {parts} p GROUP BY obj_id) q", lambda p: S.packed_status(p.groupBy("obj_id").agg((F.sum("part_id") % 3).cast("int").alias("views"), F.count("*").cast("int").alias("parts"))), "parts")
_add("o17_reencoded", "SELECT CASE WHEN f.before_path IS NULL THEN 'no_ply' ELSE 'encoded' END AS status, count(*) AS n FROM {edits} e JOIN {scores} s ON s.edit_id = e.edit_id JOIN {files} f ON f.edit_id = e.edit_id WHERE edit_type = 'deletion' AND tier = 'high' GROUP BY 1", lambda e, s, f: S.reencoded(e.where("edit_type = 'deletion'"), s.where("tier = 'high'"), f.where("before_path is not null")), "edits", "scores", "files")
_add("u09_collated", "SELECT obj_id, CAST(floor(i / 8) AS INT) AS batch, CAST(i % 8 AS INT) AS item, n, CAST(coalesce(sum(n) OVER (PARTITION BY floor(i / 8) ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM (SELECT obj_id, count(*) AS n, row_number() OVER (ORDER BY obj_id) - 1 AS i FROM {side_a} a GROUP BY obj_id) q", lambda a: S.collated(a, 8, "obj_id"), "side_a")
_add("u09_batched_cells", "SELECT obj_id, x, y, z, CAST(floor(i / 8) AS INT) AS batch, CAST(i % 8 AS INT) AS item FROM (SELECT *, dense_rank() OVER (ORDER BY obj_id) - 1 AS i FROM {side_a} a) q", lambda a: S.batched_cells(a, 8, "obj_id"), "side_a")
_add("j18_merged_back", "SELECT s.edit_id, s.tier, g.status FROM (SELECT edit_id, arg_max(status, pos) AS status FROM {log} l GROUP BY edit_id) g JOIN (SELECT obj_id AS edit_id, status AS tier FROM {objects} o) s ON s.edit_id = g.edit_id", lambda o, g: S.merged_back(o.select(F.col("obj_id").alias("edit_id"), F.col("status").alias("tier")), g.select("edit_id", "status", "pos")), "objects", "log")
_add("a20_coverage", "SELECT obj_id, avg(CASE WHEN qty > 25 THEN 1.0 ELSE 0.0 END) AS coverage FROM {edits} e GROUP BY obj_id", lambda e: VX.coverage(e.select("obj_id", F.col("qty").alias("l2")), 25.0), "edits")
_add("a26_listing_progress", "SELECT count(DISTINCT obj_id) AS folders, count(*) FILTER (WHERE flag = 'A') AS after_files, count(*) FILTER (WHERE flag = 'N') AS edited_images, count(*) AS files FROM {edits} e", lambda e: R.listing_progress(e.select(F.concat(F.lit("r/"), "obj_id", F.lit("/"), F.when(F.col("flag") == "A", "after.npz").when(F.col("flag") == "N", F.concat("edit_id", F.lit("_edited.png"))).otherwise("x.bin")).alias("path"))), "edits")
_add("m06_m07_ratios", "SELECT edit_id, CASE WHEN greatest(qty, supp) > 0 THEN round(least(qty, supp) / greatest(qty, supp), 9) ELSE 1.0 END AS low_high, CASE WHEN qty > 0 AND disc > 0 THEN round(greatest(qty, disc) / least(qty, disc), 6) ELSE 999.0 END AS symmetric FROM {edits} e", lambda e: e.select("edit_id", F.round(V.low_high_ratio(F.col("qty"), F.col("supp")), 9).alias("low_high"), F.round(V.symmetric_ratio(F.col("qty"), F.col("disc")), 6).alias("symmetric")), "edits")
_add("m10_m12_cameras", "SELECT edit_id, round(degrees(atan2(supp - 50, qty - 25.5)), 6) AS azimuth, round(degrees(asin(CAST(seq AS DOUBLE) / sqrt((qty - 25.5) * (qty - 25.5) + (supp - 50) * (supp - 50) + seq * seq))), 6) AS elevation FROM {edits} e", lambda e: e.select("edit_id", F.round(V.azimuth(F.col("qty") - 25.5, F.col("supp") - 50), 6).alias("azimuth"), F.round(V.elevation(F.col("qty") - 25.5, F.col("supp") - 50, F.col("seq").cast("double")), 6).alias("elevation")), "edits")
_add("m12_axes_turned", "SELECT edit_id, (qty + 0.5) * 2 AS x, (0.5 - disc) * 2 AS y, CAST((supp + 0.5) * 2 AS DOUBLE) AS z FROM {edits} e", lambda e: G.axes_turned(e.select("edit_id", F.col("qty").alias("x"), F.col("supp").alias("y"), F.col("disc").alias("z")), 0.5, 2.0), "edits")
_add("m15_pixel_ids", "SELECT edit_id, part % 256 + 256 * (supp % 256) AS id FROM {edits} e", lambda e: e.select("edit_id", V.pixel_id(F.col("part") % 256, F.col("supp") % 256).alias("id")), "edits")
_add("m16_standardised", "SELECT id, round(list_sum(list_transform(range(1, 65), lambda i: (CAST(a[i] AS DOUBLE) - 0.1) / 0.5)), 6) AS total FROM {vectors} v", lambda v: v.select("id", F.round(V.total(V.standardised(V.doubles(F.col("a")), F.array_repeat(F.lit(0.1), 64), F.array_repeat(F.lit(0.5), 64))), 6).alias("total")), "vectors")
_add("m04_feature_change", "SELECT id, round(sqrt(list_sum(list_transform(range(1, 65), lambda i: (CAST(b[i] AS DOUBLE) - a[i]) * (CAST(b[i] AS DOUBLE) - a[i])))) / sqrt(list_dot_product(CAST(a AS DOUBLE[]), CAST(a AS DOUBLE[]))), 6) AS change FROM {vectors} v", lambda v: v.select("id", F.round(V.feature_change(V.doubles(F.col("a")), V.doubles(F.col("b"))), 6).alias("change")), "vectors")
_add("m20_m21_scales", "SELECT edit_id, round(least(qty / 2, supp / 3.0, price / 4), 6) AS fit, round(greatest(qty / 2, supp / 3.0, price / 4), 6) AS ratio, round(least(1.0, 0.4 * greatest(2, 3, 4) / greatest(qty, supp, price)), 9) AS graft FROM {edits} e", lambda e: _scales(e), "edits")


def _scales(e: DataFrame) -> DataFrame:
    box, unit = [F.col("qty"), F.col("supp").cast("double"), F.col("price")], [F.lit(2.0), F.lit(3.0), F.lit(4.0)]
    fit, ratio = G.aligned_scale(unit, box)
    return e.select("edit_id", F.round(fit, 6).alias("fit"), F.round(ratio, 6).alias("ratio"), F.round(G.graft_scale(box, unit), 9).alias("graft"))


_add("p15_p17_parts", "SELECT edit_id, CASE WHEN qty > 30 THEN flag WHEN qty > 10 THEN 'target' ELSE '' END AS first, CASE WHEN qty > 30 THEN concat(flag, ', two') ELSE 'old' END AS label FROM {edits} e", lambda e: _first_labels(e), "edits")


def _first_labels(e: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    many = F.when(F.col("qty") > 30, F.array("flag", F.lit("two"))).otherwise(none)
    return e.select("edit_id", D.first_label(many, F.when(F.col("qty") > 10, F.array(F.lit("target"))).otherwise(none)).alias("first"), D.part_label(many, F.lit("old")).alias("label"))


_add("p17_part_ids", "SELECT edit_id, CASE WHEN edit_type IN ('deletion', 'addition') OR (edit_type IN ('modification', 'scale') AND qty > 20) THEN CASE WHEN qty > 20 THEN '1,2' ELSE '' END ELSE '7' END AS ids FROM {edits} e", lambda e: e.select("edit_id", F.array_join(D.part_ids(F.col("edit_type"), F.when(F.col("qty") > 20, F.array(F.lit(1), F.lit(2))).otherwise(F.array().cast("array<int>")), F.lit(7)), ",").alias("ids")), "edits")
_ADJ = "classic|vintage|stylish|square|round|short|tall|decorative|ornate|simple|plastic|metal|wooden|little|big|large|small|white|black|green|blue|red|new|old|modern|the|an|a"
#: The word lists once more, each in one pattern, so that the SQL does not take the library's.
_APP = "yellow|woven|worn|wooden|white|weathered|vibrant|velvet|transparent|translucent|titanium|textured|teal|tarnished|tan|suede|striped|stone|steel|solid|smooth|silver|silk|shiny|rustic|rubber|rough|ridged|ribbed|red|purple|polished|plastic|plain|pink|patterned|pale|oxidized|orange|opaque|navy|metallic|matte|maroon|marble|linen|light|leather|knurled|ivory|iron|iridescent|grooved|grey|green|gray|golden|gold|glossy|glass|fur|frosted|feathered|faded|fabric|denim|deep|dark|crimson|cream|cotton|corroded|copper|concrete|chrome|checkered|ceramic|burgundy|brushed|brown|bronze|bright|brick|blue|black|beige|aluminum|aged"
_STR = "wide|wedge-shaped|triangular|tiny|thin|thick|teardrop|tapered|tall|stubby|streamlined|square|spherical|small|slim|slender|short|rounded|round|rectangular|pointed|oval|octagonal|oblong|narrow|massive|long|large|hexagonal|flat|flared|elongated|dome-shaped|cylindrical|curved|convex|conical|concave|compact|circular|bulky|bulbous|boxy|blunt|blocky|bell-shaped|angular|aerodynamic"
_add("x02_object_types", f"SELECT DISTINCT d, CASE WHEN len(nouns) > 0 THEN nouns[-1] WHEN len(w) > 0 THEN w[-1] ELSE '' END AS t FROM (SELECT d, w, list_filter(list_transform(w, lambda x: regexp_replace(x, '[^a-z]', '', 'g')), lambda x: x <> '' AND NOT regexp_full_match(x, '{_ADJ}')) AS nouns FROM (SELECT d, list_filter(regexp_split_to_array(regexp_replace(lower(d), '\\s+(with|having|featuring|including|and)\\s.*$', ''), '\\s+'), lambda x: x <> '') AS w FROM (SELECT concat(kind, CASE part_id % 3 WHEN 0 THEN ' with legs' WHEN 1 THEN ' Stylish, vintage and red' ELSE '' END) AS d FROM {{parts}} p UNION ALL SELECT concat('a little ', CAST(part_id AS STRING)) FROM {{parts}} p UNION ALL SELECT '') q) q) q", lambda p: p.select(F.explode(F.array(F.concat("kind", F.when(F.col("part_id") % 3 == 0, " with legs").when(F.col("part_id") % 3 == 1, " Stylish, vintage and red").otherwise("")), F.concat(F.lit("a little "), F.col("part_id").cast("string")), F.lit(""))).alias("d")).select("d", X.object_type(F.col("d")).alias("t")).distinct(), "parts")
_add("x03_part_phrases", "SELECT obj_id, part_id, CASE WHEN qty > 30 THEN kind WHEN qty > 10 THEN label ELSE concat('part ', part_id) END AS p FROM {parts} p", lambda p: p.select("obj_id", "part_id", X.part_phrase(F.when(F.col("qty") > 30, F.col("kind")).otherwise(" "), F.when(F.col("qty") > 10, F.replace("label", F.lit(" "), F.lit("_"))).otherwise(""), F.col("part_id")).alias("p")), "parts")
_DESC = "concat(label, ' (Rustic), iridescent box , \"oxidized\" dome-shaped stub . bulky')"
_chan = lambda pattern: f"trim(regexp_replace(array_to_string(list_filter(regexp_split_to_array(d, '\\s+'), lambda x: x <> '' AND NOT regexp_full_match(lower(trim(x, concat('.,;:!?()[]\"', chr(39)))), '{pattern}')), ' '), ' ([,.])', '\\1', 'g'))"
_add("x07_x08_channels", f"SELECT obj_id, part_id, {_chan(_APP)} AS structure, {_chan(_STR)} AS appearance FROM (SELECT obj_id, part_id, {_DESC} AS d FROM {{parts}} p) q", lambda p: p.withColumn("d", F.concat("label", F.lit(' (Rustic), iridescent box , "oxidized" dome-shaped stub . bulky'))).select("obj_id", "part_id", X.structure_of(F.col("d")).alias("structure"), X.appearance_of(F.col("d")).alias("appearance")), "parts")
_add("x09_x11_prompts", "SELECT edit_id, CASE edit_type WHEN 'modification' THEN concat('Change the ', flag, ' of this box: go') WHEN 'scale' THEN concat('Resize the ', flag, ' of this box: go') WHEN 'global' THEN 'Restyle this box: go' ELSE 'Edit this box: go' END AS p, CASE WHEN qty > 20 THEN concat('Compare before and after. Instruction: ', flag) ELSE 'Compare before and after. No instruction was given; judge the visible change.' END AS j FROM {edits} e", lambda e: e.select("edit_id", X.edit_prompt(F.col("edit_type"), F.lit("go"), F.col("flag"), F.lit("box")).alias("p"), X.judge_prompt(F.when(F.col("qty") > 20, F.col("flag")).otherwise(" ")).alias("j")), "edits")
_add("x12_label_lists", "SELECT obj_id, array_to_string(list_transform(range(1, len(ls) + 1), lambda i: concat('p', i - 1, '=', ls[i])), ', ') AS l FROM (SELECT obj_id, list_sort(list(label)) AS ls FROM {parts} p GROUP BY obj_id) q", lambda p: p.groupBy("obj_id").agg(F.array_sort(F.collect_list("label")).alias("ls")).select("obj_id", X.label_list(F.col("ls")).alias("l")), "parts")
_add("n07_n11_records", "SELECT obj_id, CAST(count(*) AS INT) AS parts, CAST(count(*) FILTER (WHERE NOT core) AS INT) AS part_edits, CAST(0 AS INT) AS group_edits, CAST(0 AS INT) AS global_edits FROM (SELECT obj_id, len(list_intersect(regexp_split_to_array(lower(label), '[_\\s-]+'), ['" + "', '".join(D.CORE_WORDS) + "'])) > 0 AS core FROM {parts} p) q GROUP BY obj_id", lambda p: L.nested_counts(L.by_rules(p.groupBy("obj_id").agg(F.array_sort(F.collect_list("label")).alias("labels")).withColumn("shard", F.lit("00")))), "parts")
_add("n09_catalog", "SELECT p.obj_id, p.label, coalesce(s.size, 0) AS cluster_size FROM (SELECT obj_id, label, CAST(row_number() OVER (PARTITION BY obj_id ORDER BY label) - 1 AS INT) AS i FROM {parts} p) p LEFT JOIN (SELECT obj_id, CAST(part_id AS INT) AS part_id, max(cluster_size) AS size FROM {parts} p GROUP BY ALL) s ON s.obj_id = p.obj_id AND s.part_id = p.i", lambda p: L.catalog(L.by_rules(p.groupBy("obj_id").agg(F.array_sort(F.collect_list("label")).alias("labels")).withColumn("shard", F.lit("00"))), sizes=p.groupBy("obj_id", "part_id").agg(F.max("cluster_size").alias("cluster_size"))).select("obj_id", "label", "cluster_size"), "parts")
_add("j20_j21_catalog_lookup", "SELECT p.obj_id, p.i AS part_id, p.label, o.priority, coalesce(s.size, 0) AS cluster_size FROM (SELECT obj_id, label, CAST(row_number() OVER (PARTITION BY obj_id ORDER BY label) - 1 AS INT) AS i FROM {parts} p) p JOIN (SELECT * FROM {objects} x WHERE status <> 'O') o ON o.obj_id = p.obj_id LEFT JOIN (SELECT obj_id, CAST(part_id AS INT) AS part_id, max(cluster_size) AS size FROM {parts} p WHERE cluster_size > 10 GROUP BY ALL) s ON s.obj_id = p.obj_id AND s.part_id = p.i", lambda p, o: L.catalog(L.by_rules(p.groupBy("obj_id").agg(F.array_sort(F.collect_list("label")).alias("labels")).withColumn("shard", F.lit("00"))), o.where("status <> 'O'").select("obj_id", "priority"), p.where("cluster_size > 10").groupBy("obj_id", "part_id").agg(F.max("cluster_size").alias("cluster_size"))).select("obj_id", "part_id", "label", "priority", "cluster_size"), "parts", "objects")
_add("p21_validated", "WITH a AS (SELECT obj_id, part_id, label FROM {parts} p WHERE qty > 20) SELECT p.obj_id, p.part_id, coalesce(a.label, concat('part_', p.part_id)) AS label FROM {parts} p LEFT JOIN a ON a.obj_id = p.obj_id AND a.part_id = p.part_id", lambda p: L.validated(p.where("qty > 20").select("obj_id", "part_id", "label", F.array(F.lit("scale")).alias("types"), F.col("part_id").alias("pos")), p).select("obj_id", "part_id", "label"), "parts")
_add("w05_pending_identities", "SELECT count(*) AS n FROM {edits} e WHERE edit_type <> 'identity' AND qty > 20", lambda e: _done(e).where("status = 'success'").agg(F.count("*").alias("n")), "edits")
_add("s22_dense_labels", "SELECT g.obj_id, CAST(g.face AS INT) AS face, coalesce(f.label, 0) AS label FROM (SELECT obj_id, unnest(range(0, m + 1)) AS face FROM (SELECT obj_id, max(part_id) AS m FROM {parts} p GROUP BY obj_id) q) g LEFT JOIN (SELECT obj_id, part_id AS face, max(cluster_size) AS label FROM {parts} p GROUP BY ALL) f ON f.obj_id = g.obj_id AND f.face = g.face", lambda p: __import__("quarrykit.sources.arrays", fromlist=["x"]).dense_labels(p.groupBy("obj_id", F.col("part_id").alias("face")).agg(F.max("cluster_size").alias("label"))), "parts")
_add("o12_kept_faces", "SELECT obj_id, part_id AS part, count(*) AS n FROM {parts} p WHERE (obj_id, part_id) NOT IN (SELECT obj_id, part_id FROM {parts} q WHERE qty > 25) GROUP BY ALL", lambda p: G.kept_faces(p.withColumnRenamed("part_id", "part"), p.where("qty > 25").withColumnRenamed("part_id", "part")).groupBy("obj_id", "part").agg(F.count("*").alias("n")), "parts")
_add("o18_assembled", "SELECT obj_id, part_id AS part, CAST(coalesce(sum(cluster_size) OVER (PARTITION BY obj_id ORDER BY part_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM {parts} p WHERE qty > 15", lambda p: G.assembled(p.withColumnRenamed("part_id", "part").withColumn("n_vertices", F.col("cluster_size")), p.where("qty > 15").withColumnRenamed("part_id", "part")).select("obj_id", "part", "offset"), "parts")
_add("o13_mask_kinds", "SELECT edit_id, CASE WHEN edit_type = 'global' OR (edit_type IN ('modification', 'identity') AND disc > 0.035) OR (edit_type = 'scale' AND disc > 0.06) THEN 'full' WHEN edit_type IN ('material', 'deletion') THEN 'part' ELSE 'region' END AS mask FROM {edits} e", lambda e: e.select("edit_id", VX.mask_kind(F.col("edit_type"), F.round(F.col("disc") * 10, 6), 0.6).alias("mask")), "edits")

_EL, _AZ = "radians(-20 + 20 * (v // 7))", "radians((v % 7) * 360.0 / 7)"
_M11 = {0: f"cos({_AZ})", 1: f"-sin({_AZ}) * sin({_EL})", 2: f"cos({_EL}) * sin({_AZ})", 3: f"2.5 * cos({_EL}) * sin({_AZ})", 4: "0", 5: f"cos({_EL})", 6: f"sin({_EL})", 7: f"2.5 * sin({_EL})", 8: f"-sin({_AZ})", 9: f"-cos({_AZ}) * sin({_EL})", 10: f"cos({_EL}) * cos({_AZ})", 11: f"2.5 * cos({_EL}) * cos({_AZ})", 12: "0", 13: "0", 14: "0", 15: "1"}
_add("m11_orbit", "SELECT v AS view, i, round(CAST(CASE i " + " ".join(f"WHEN {i} THEN {x}" for i, x in _M11.items()) + " END AS DOUBLE), 9) + 0.0 AS x FROM (SELECT DISTINCT l_orderkey % 42 AS v FROM {lineitem}) q CROSS JOIN (SELECT unnest(range(0, 16)) AS i) r", lambda li: G.orbit(li.select((F.col("l_orderkey") % 42).alias("view")).distinct()).select("view", F.posexplode("c2w").alias("i", "x")).select("view", F.col("i").cast("long").alias("i"), (F.round("x", 9) + 0.0).alias("x")), "lineitem")
