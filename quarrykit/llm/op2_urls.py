"""URL filters: a trie over reversed host labels, then path segments.

``https://blog.shop.example.com/en/7?x#y`` becomes ``com example shop blog / en 7``.
Allow and block entries are hosts with or without a path, and lie in one trie;
a host entry covers its subdomains too, one with a path covers what lies under
that path on exactly the named host. The entry with the most labels and segments on the
URL's way decides; one that is in both lists blocks.

The trie goes to every executor while it has at most ``MOST_NODES`` nodes, of about
250 bytes each with their text. Beyond that the same answer comes from a join of each URL's
own prefixes with the table of entries, which has no bound.

Reading a URL: the scheme is optional, the host is lower-cased, user, port and
trailing dots go, the query and fragment are ignored, empty segments count
nothing, and segments compare as written. An IPv4 host or a bracketed IPv6
one is a single label.

Defined results: a null URL, or one without a host, is ``invalid``. One that
no entry covers is ``default``. Repeated rows repeat; other columns are not
looked at.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALLOW = ["blog.tionsh.example.net", "m.ththth.example.net/en", "blog.tionsh.example.net/fr/825", "www.ththhe.example.com/en/687", "thther.example.org/en", "www.cheap-pills.example.com/en/10"]
BLOCK = ["example.net", "cheap-pills.example.com", "www.cheap-pills.example.com", "blog.tionsh.example.net/fr", "www.ththhe.example.com/en", "thther.example.org", "ththre.example.com/fr", "therti.example.org", "m.theror.example.com", "ththed.example.org/de", "blog.tiontion.example.com/en"]
#: About 100 MB in a worker.
MOST_NODES = 400_000

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://")
_NUMERIC = re.compile(r"[0-9.]+")
_PORT = re.compile(r":[0-9]*$")


def steps(url: str | None) -> tuple[list[str], list[str]] | None:
    """(reversed host labels, path segments), or None without a host."""
    if not url:
        return None
    rest = _SCHEME.sub("", url.strip(" \t\r\n"), count=1)
    for c in "?#":
        rest = rest.partition(c)[0]
    host, _, path = rest.partition("/")
    host = _PORT.sub("", host.rpartition("@")[2]).rstrip(".").lower()
    if not host:
        return None
    labels = [host] if host[:1] == "[" or _NUMERIC.fullmatch(host) else [x for x in host.split(".") if x][::-1]
    return (labels, [x for x in path.split("/") if x]) if labels else None


def prefixes(url: str | None) -> list[tuple[str, int]] | None:
    """The keys of all entries that would cover the URL, with their depths. Keys differ wherever the ways do: no label of a split host has a dot, no segment a slash."""
    at = steps(url)
    if at is None:
        return None
    labels, segments = at
    made = [(f"{n} " + ".".join(labels[:n]), n) for n in range(1, len(labels) + 1)]
    return made + [(made[-1][0] + "/" + "/".join(segments[:n]), len(labels) + n) for n in range(1, len(segments) + 1)]


def entry_key(entry: str) -> str:
    at = prefixes(entry)
    if at is None:
        raise ValueError(f"no host in entry {entry!r}")
    return at[-1][0]


class Trie:
    """Nodes are dicts; ``None`` holds (blocks, entry) where an entry ends, ``/`` the root of a host's paths."""

    def __init__(self, allow, block):
        self.root: dict = {}
        for blocks, entries in ((False, allow), (True, block)):
            for entry in entries:
                at = steps(entry)
                if at is None:
                    raise ValueError(f"no host in entry {entry!r}")
                node = self.root
                for x in at[0]:
                    node = node.setdefault(x, {})
                if at[1]:
                    node = node.setdefault("/", {})
                    for x in at[1]:
                        node = node.setdefault(x, {})
                node[None] = (blocks, entry)

    def match(self, url: str | None) -> tuple[str, str | None, int]:
        """(verdict, entry, depth)."""
        at = steps(url)
        if at is None:
            return "invalid", None, 0
        node, best, depth = self.root, None, 0
        for n, x in enumerate(at[0], 1):
            node = node.get(x)
            if node is None:
                break
            if None in node:
                best, depth = node[None], n
        if node is not None and at[1]:
            node = node.get("/")
            for n, x in enumerate(at[1], len(at[0]) + 1):
                node = node.get(x) if node else None
                if node is None:
                    break
                if None in node:
                    best, depth = node[None], n
        return ("default", None, 0) if best is None else ("block" if best[0] else "allow", best[1], depth)


def nodes(allow, block, enough: float) -> int:
    """Nodes that a trie of the entries has at most; counted no further than ``enough``."""
    n = 1
    for entry in (*allow, *block):
        at = steps(entry)
        n += 2 + sum(map(len, at)) if at else 0
        if n > enough:
            break
    return n


_RESULT = "verdict string, entry string, depth int"


def filter_urls(pages: DataFrame, allow=ALLOW, block=BLOCK, url_col: str = "url", id_col: str = "page_id", most_nodes: int = MOST_NODES) -> DataFrame:
    """(page_id, url, verdict, entry, depth) for every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    if nodes(allow, block, most_nodes) > most_nodes:
        return _by_join(rows, allow, block)
    shared = pages.sparkSession.sparkContext.broadcast(Trie(allow, block))

    def run(urls: pa.Array) -> pa.Array:
        match = shared.value.match
        verdict, entry, depth = zip(*map(match, urls.to_pylist())) if len(urls) else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(verdict, pa.string()), pa.array(entry, pa.string()), pa.array(depth, pa.int32())], names=["verdict", "entry", "depth"])

    return rows.withColumn("m", F.arrow_udf(run, _RESULT).asNondeterministic()("url")).select("page_id", "url", "m.verdict", "m.entry", "m.depth")


def _by_join(rows: DataFrame, allow, block) -> DataFrame:
    """The same by joining each distinct URL's prefixes with the entries."""
    spark = rows.sparkSession
    listed = spark.createDataFrame([(entry_key(e), b, n, e) for b, es in ((False, allow), (True, block)) for n, e in enumerate(es)], "key string, blocks boolean, n int, entry string")
    last = W.partitionBy("key").orderBy(F.desc("blocks"), F.desc("n"))
    entries = listed.withColumn("r", F.row_number().over(last)).where("r = 1").select("key", "blocks", "entry")

    def run(urls: pa.Array) -> pa.Array:
        made = [None if p is None else [{"key": k, "depth": d} for k, d in p] for p in map(prefixes, urls.to_pylist())]
        return pa.array(made, pa.list_(pa.struct([("key", pa.string()), ("depth", pa.int32())])))

    kind = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("depth", T.IntegerType())]))
    urls = rows.select("url").distinct().withColumn("p", F.arrow_udf(run, kind).asNondeterministic()("url"))
    hit = urls.select("url", F.inline("p")).join(entries, "key").groupBy("url").agg(F.max(F.struct("depth", "blocks", "entry")).alias("m"))
    found = urls.join(hit, "url", "left").select(
        F.col("url").alias("__url"),
        F.when(F.col("p").isNull(), "invalid").when(F.col("m").isNull(), "default").when(F.col("m.blocks"), "block").otherwise("allow").alias("verdict"),
        F.col("m.entry").alias("entry"),
        F.coalesce("m.depth", F.lit(0)).alias("depth"),
    )
    return rows.join(found, F.col("url").eqNullSafe(F.col("__url")), "left").drop("__url")


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _values() -> str:
    return ", ".join(f"('{e}', {b})" for b, es in ((0, ALLOW), (1, BLOCK)) for e in es)


_SQL = f"""
WITH entries AS (SELECT key, max(blocks) AS blocks, arg_max(entry, blocks) AS entry FROM (
    SELECT entry, blocks, array_to_string(list_reverse(string_split(string_split(entry, '/')[1], '.')), '.') || array_to_string(list_transform(string_split(entry, '/')[2:], lambda x: '/' || x), '') AS key
    FROM (VALUES {_values()}) v(entry, blocks)) q GROUP BY key),
cut AS (SELECT DISTINCT url, regexp_extract(regexp_replace(trim(url, ' \t\r\n'), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^[^?#]*') AS rest FROM pages),
split AS (SELECT url, lower(rtrim(regexp_replace(regexp_extract(rest, '^(?:[^/]*@)?([^/]*)', 1), ':[0-9]*$', ''), '.')) AS host,
  list_filter(string_split(regexp_extract(rest, '^[^/]*(.*)$', 1), '/'), lambda x: x <> '') AS segments FROM cut),
labelled AS (SELECT url, segments, CASE WHEN host IS NULL OR host = '' THEN NULL WHEN starts_with(host, '[') OR regexp_full_match(host, '[0-9.]+') THEN [host]
  ELSE list_reverse(list_filter(string_split(host, '.'), lambda x: x <> '')) END AS labels FROM split),
deep AS (
  SELECT url, n AS depth, array_to_string(labels[1:n], '.') AS key FROM (SELECT url, labels, unnest(range(1, len(labels) + 1)) AS n FROM labelled)
  UNION ALL
  SELECT url, len(labels) + n AS depth, array_to_string(labels, '.') || '/' || array_to_string(segments[1:n], '/') AS key
  FROM (SELECT url, labels, segments, unnest(range(1, len(segments) + 1)) AS n FROM labelled)
),
best AS (SELECT url, max(depth) AS depth, arg_max(entry, depth) AS entry, arg_max(blocks, depth) AS blocks FROM deep JOIN entries USING (key) GROUP BY url)
SELECT p.page_id, p.url,
  CASE WHEN l.labels IS NULL OR len(l.labels) = 0 THEN 'invalid' WHEN b.url IS NULL THEN 'default' WHEN b.blocks = 1 THEN 'block' ELSE 'allow' END AS verdict,
  b.entry, CAST(coalesce(b.depth, 0) AS INTEGER) AS depth
FROM pages p LEFT JOIN labelled l ON p.url = l.url LEFT JOIN best b ON p.url = b.url
"""

QUERIES = {"op2_urls": op2_urls}
ORACLE = {"op2_urls": _SQL}
