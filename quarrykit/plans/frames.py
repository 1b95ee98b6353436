"""The entities of edit data as projections of the test tables.

One SQL text each, in the dialect that Spark and the reference engine of the tests share; ``{name}`` stands for
a table or another projection.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_TYPE = "CASE n % 7 WHEN 1 THEN 'deletion' WHEN 2 THEN 'addition' WHEN 3 THEN 'modification' WHEN 4 THEN 'scale' WHEN 5 THEN 'material' WHEN 6 THEN 'identity' ELSE 'global' END"
_PREFIX = "CASE n % 7 WHEN 1 THEN 'del' WHEN 2 THEN 'add' WHEN 3 THEN 'mod' WHEN 4 THEN 'scl' WHEN 5 THEN 'mat' WHEN 6 THEN 'idt' ELSE 'glb' END"

FRAMES = {
    # one row for each (order, line); the table repeats some
    "lines": "SELECT l_orderkey AS o, l_linenumber AS n, min(l_partkey) AS part, max(l_suppkey) AS supp, max(l_quantity) AS qty, max(l_discount) AS disc, max(l_tax) AS tax, max(l_extendedprice) AS price, min(l_returnflag) AS flag, count(*) AS copies FROM {lineitem} GROUP BY l_orderkey, l_linenumber",
    "edits": f"""SELECT concat({_PREFIX}, '_', CAST(o AS STRING), '_00', CAST(n AS STRING)) AS edit_id, {_TYPE} AS edit_type, CAST(o AS STRING) AS obj_id,
        concat('0', CAST(o % 10 AS STRING)) AS shard, CASE WHEN n % 7 = 2 THEN concat('del_', CAST(o AS STRING), '_001') ELSE '' END AS source_del_id,
        o * 10 + n AS pos, CAST((o + n) % 4 AS INT) AS seq, part, supp, qty, disc, tax, price, flag FROM {{lines}}""",
    "log": "SELECT CAST(user_id AS STRING) AS edit_id, event_id AS pos, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, event_type AS reason, value AS score FROM {events}",
    # a log whose keys repeat, some empty
    "rows": "SELECT CASE WHEN l_quantity < 2 THEN '' ELSE concat(CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) END AS k, l_partkey * 100000 + l_suppkey * 100 + CAST(l_quantity AS INT) AS pos, l_returnflag AS flag, CAST(l_quantity AS INT) AS qty FROM {lineitem}",
    "scores": "SELECT edit_id, CASE WHEN qty > 40 THEN 'high' WHEN qty > 30 THEN 'medium' WHEN qty > 20 THEN 'low' WHEN qty > 10 THEN 'negative' ELSE 'rejected' END AS tier, disc * 10 AS score FROM {edits} WHERE tax < 0.06",
    "quality": "SELECT e.shard, e.obj_id, e.edit_id, s.tier, s.score FROM {edits} e JOIN {scores} s ON e.edit_id = s.edit_id",
    "files": "SELECT edit_id, CASE WHEN qty > 15 THEN concat('b/', edit_id) END AS before_path, CASE WHEN disc > 0.02 THEN concat('a/', edit_id) END AS after_path FROM {edits}",
    "listed": "SELECT edit_id FROM {edits} WHERE qty > 35",
    "objects": "SELECT CAST(o_orderkey AS STRING) AS obj_id, concat('0', CAST(o_orderkey % 10 AS STRING)) AS shard, o_orderkey AS num, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price FROM {orders}",
    "parts": "SELECT CAST(l.o AS STRING) AS obj_id, l.n AS part_id, p.p_name AS label, p.p_type AS kind, p.p_brand AS brand, p.p_size AS cluster_size, l.qty FROM {lines} l JOIN {part} p ON l.part = p.p_partkey",
    "side_a": "SELECT CAST(l_orderkey % 200 AS STRING) AS obj_id, CAST(l_partkey % 12 AS INT) AS x, CAST(l_suppkey % 12 AS INT) AS y, CAST(l_linenumber AS INT) AS z FROM {lineitem} WHERE l_returnflag <> 'R'",
    "side_b": "SELECT CAST(l_orderkey % 200 AS STRING) AS obj_id, CAST(l_partkey % 12 AS INT) AS x, CAST(l_suppkey % 12 AS INT) AS y, CAST(l_linenumber AS INT) AS z FROM {lineitem} WHERE l_returnflag <> 'A'",
    # the sides again with an order as object and cells all over the grid, so that both grow with the table
    "order_a": "SELECT CAST(l_orderkey AS STRING) AS obj_id, CAST((l_partkey * 31 + l_linenumber) % 64 AS BIGINT) AS x, CAST((l_suppkey * 29 + l_partkey) % 64 AS BIGINT) AS y, CAST((l_orderkey * 13 + l_linenumber * 7) % 64 AS BIGINT) AS z FROM {lineitem} WHERE l_returnflag <> 'R'",
    "order_b": "SELECT CAST(l_orderkey AS STRING) AS obj_id, CAST((l_partkey * 31 + l_linenumber) % 64 AS BIGINT) AS x, CAST((l_suppkey * 29 + l_partkey) % 64 AS BIGINT) AS y, CAST((l_orderkey * 13 + l_linenumber * 7) % 64 AS BIGINT) AS z FROM {lineitem} WHERE l_returnflag <> 'A'",
    # a tetrahedron for each line of an order; the mesh after lacks some lines, has others moved, and some without their last face
    "corners": "SELECT l.*, k, s, (n - 1) * 4 + k AS v, part % 97 + CASE WHEN k = 1 THEN 1 + disc * 10 ELSE 0 END AS x, supp % 89 + CASE WHEN k = 2 THEN 1 + disc * 10 ELSE 0 END AS y, qty + CASE WHEN k = 3 THEN 1 + disc * 10 ELSE 0 END AS z FROM {lines} l CROSS JOIN (VALUES (0, 'before'), (1, 'before'), (2, 'before'), (3, 'before'), (0, 'after'), (1, 'after'), (2, 'after'), (3, 'after')) AS c(k, s) WHERE s = 'before' OR flag <> 'R'",
    "mesh_v": "SELECT CAST(o AS STRING) AS obj_id, s AS side, CAST(v AS INT) AS v, CAST(x + CASE WHEN s = 'after' AND qty > 40 THEN 0.5 ELSE 0 END AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, CAST(z AS DOUBLE) AS z, CAST(part % 256 AS INT) AS r, CAST(supp % 256 AS INT) AS g, CAST(qty * 5 AS INT) AS b FROM {corners} q",
    "mesh_f": "SELECT CAST(o AS STRING) AS obj_id, s AS side, CAST(n * 4 - 4 + i AS INT) AS a, CAST(n * 4 - 4 + j AS INT) AS b, CAST(n * 4 - 4 + m AS INT) AS c FROM {corners} q JOIN (VALUES (0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)) AS t(i, j, m) ON k = i + j + m - 3 WHERE s = 'before' OR tax <= 0.05 OR k < 3",
    "vectors": "SELECT a.vec_id AS id, a.embedding AS a, b.embedding AS b FROM {embeddings} a JOIN {embeddings} b ON b.vec_id = a.vec_id + 1",
}

_NAME = re.compile(r"\{(\w+)\}")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = FRAMES[name]
    return spark.sql(sql, **{n: frame(spark, sf_dir, n) for n in set(_NAME.findall(sql))})


def sql_of(text: str) -> str:
    """``text`` with every projection written out, for an engine that has the tables by name."""
    while hit := _NAME.search(text):
        name = hit.group(1)
        text = text[: hit.start()] + (name if name in TABLES else f"({FRAMES[name]})") + text[hit.end() :]
    return text
