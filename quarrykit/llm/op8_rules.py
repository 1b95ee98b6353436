"""Quality rules with risk-controlled thresholds.

Five rules reject a text: too many symbols, too many capitals, words that
repeat, lines that repeat, too few words. Each has a fixed ladder of cutoffs
from lenient to strict, and the ladders follow each other in a fixed order: one path of steps, each of which
adds a rung to all before it. On the labelled good texts (``quality = 1``) of a
stratum (a language), a step is admitted if the exact binomial test rejects
"all rules up to here together lose more than ``RISK`` of the good texts" at its level: P(Bin(n, RISK) <= k)
at most that, for k of n good texts rejected, which is the same as a Clopper-Pearson upper bound of at most ``RISK``.
The tests go along the path and end at the first that fails, which
needs no correction; over the strata that can prove a step at all (by their number of labels alone) ``DELTA`` is split evenly (Bonferroni).
So, with probability 1 - ``DELTA`` over the holdout, in every stratum at once at
most ``RISK`` of good texts are lost to all rules together. A stratum with too few labels
keeps all its texts: one alone needs 149 good texts, four need 217 each.

The bound needs independent draws, so a text that is labelled good counts once in a stratum, however many
copies or labels it has. Near copies are not told apart from it.

Texts are read once for their features; the features are written, joined to
the labels for the counts, and read again for the decisions. The counts, one row for each step of a stratum that has at
least as many labelled good texts as a lone one needs, come to the driver.

Defined results: a null text has the features of an empty one. A null
language is a stratum of its own. A label whose document is absent, and a
null quality, count nothing; a repeated row is decided as often as it comes. doc_ids keep their type. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrykit.sharedfs import cut

RISK, DELTA = 0.02, 0.05
SYMBOLS = "#$%&*|{}<>^~=+@_\\"
#: Rule -> (rejects above or below, ladder from lenient to strict). The order of the rules is that of the path.
LADDERS: dict[str, tuple[str, list[float]]] = {
    "symbols": (">", [0.30, 0.25, 0.20, 0.15, 0.12, 0.10, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02]),
    "capitals": (">", [0.90, 0.80, 0.70, 0.60, 0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.12, 0.10]),
    "word_copies": (">", [0.98, 0.95, 0.92, 0.90, 0.88, 0.85, 0.82, 0.80, 0.77, 0.75, 0.72, 0.70]),
    "line_copies": (">", [0.90, 0.80, 0.70, 0.60, 0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.10, 0.05]),
    "words": ("<", [2, 3, 4, 5, 6, 8, 10, 12, 15, 20, 25, 30]),
}


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, key, a column for each rule); ``key`` is the text's digest."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("stratum"),
        F.unhex(F.md5(text)).alias("key"),
        text.alias("t"),
        F.regexp_extract_all(text, F.lit("[^ \t\n\r\f]+"), 0).alias("w"),
        F.split(text, "\n").alias("l"),
    )
    chars, words, lines = F.length("t"), F.size("w"), F.size("l")
    share = lambda n, of: F.when(of > 0, n.cast("double") / of).otherwise(F.lit(0.0))
    return split.select(
        "doc_id",
        "stratum",
        "key",
        share(chars - F.length(F.translate("t", SYMBOLS, "")), chars).alias("symbols"),
        share(F.regexp_count("t", F.lit("\\p{Lu}")), chars).alias("capitals"),
        share(words - F.size(F.array_distinct("w")), words).alias("word_copies"),
        share(lines - F.size(F.array_distinct("l")), lines).alias("line_copies"),
        words.cast("double").alias("words"),
    )


def _rejects(rule: str, cutoff: float):
    return F.col(rule) > F.lit(float(cutoff)) if LADDERS[rule][0] == ">" else F.col(rule) < F.lit(float(cutoff))


def tail(n: int, k: int, r: float) -> float:
    """P(Bin(n, r) <= k), exactly summed."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(r) + (n - i) * math.log1p(-r) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def fewest(risk: float, level: float) -> int:
    """Good texts from which on a step that rejects none of them is admitted."""
    return math.ceil(math.log(level) / math.log1p(-risk) - 1e-9)


def cutoffs(counts: list[tuple[str | None, list[int]]], risk: float = RISK, delta: float = DELTA) -> dict[tuple[str | None, str], float]:
    """(stratum, rule) -> the strictest admitted cutoff, where there is one. ``counts``: stratum, and how many distinct good texts are first rejected at each step of the path; the last number is of those that never are."""
    sizes = sorted((sum(k) for _, k in counts), reverse=True)
    able = max([m for m, n in enumerate(sizes, 1) if n >= fewest(risk, delta / m)], default=0)
    chosen: dict[tuple[str | None, str], float] = {}
    path = [(rule, c) for rule, (_, ladder) in LADDERS.items() for c in ladder]
    for stratum, firsts in counts:
        n, k = sum(firsts), 0
        if not able or n < fewest(risk, delta / able):
            continue
        for (rule, cutoff), more in zip(path, firsts):
            k += more
            if tail(n, k, risk) > delta / able:
                break
            chosen[stratum, rule] = float(cutoff)
    return chosen


def calibrate(features: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> dict[tuple[str | None, str], float]:
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    if good.schema["doc_id"].dataType != features.schema["doc_id"].dataType:
        good = good.select(F.col("doc_id").cast("string").alias("doc_id"))
        features = features.withColumn("doc_id", F.col("doc_id").cast("string"))
    steps = [_rejects(rule, c) for rule, (_, ladder) in LADDERS.items() for c in ladder]
    first = F.lit(len(steps))
    for i, hit in reversed(list(enumerate(steps))):
        first = F.when(hit, i).otherwise(first)
    held = features.join(good, "doc_id").groupBy("stratum", "key").agg(*[F.first(r).alias(r) for r in LADDERS])
    placed = held.groupBy("stratum", first.alias("step")).agg(F.count("*").alias("n"))
    whole = placed.groupBy("stratum").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("at"))
    rows = whole.where(F.col("n") >= fewest(risk, delta)).collect()
    return cutoffs([(r["stratum"], [r["at"].get(i, 0) for i in range(len(steps) + 1)]) for r in rows], risk, delta)


def decide(features: DataFrame, chosen: dict[tuple[str | None, str], float]) -> DataFrame:
    """(doc_id, stratum, keep, broken): ``broken`` names the rules that reject, joined by commas."""
    spark = features.sparkSession
    by_stratum: dict[str | None, dict[str, float]] = {}
    for (s, rule), c in chosen.items():
        by_stratum.setdefault(s, {})[rule] = c
    rows = [(s, *[m.get(rule) for rule in LADDERS]) for s, m in by_stratum.items()]
    table = spark.createDataFrame(rows, "__stratum string, " + ", ".join(f"c_{r} double" for r in LADDERS))
    both = features.join(F.broadcast(table) if len(rows) <= 10_000 else table, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    broken = F.concat_ws(",", *[F.when((F.col(r) > F.col(f"c_{r}")) if LADDERS[r][0] == ">" else (F.col(r) < F.col(f"c_{r}")), F.lit(r)) for r in LADDERS])
    return both.select("doc_id", "stratum", broken.alias("broken")).select("doc_id", "stratum", (F.col("broken") == "").alias("keep"), "broken")


def apply_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, **columns) -> DataFrame:
    features = cut(text_features(docs, **columns), "features")
    return decide(features, calibrate(features, labels, risk, delta))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


_SQL = """
WITH s AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f]+') AS w, string_split(coalesce(text, ''), chr(10)) AS l, row_number() OVER () AS rid FROM documents),
f AS (SELECT rid, doc_id, stratum, t,
  CASE WHEN length(t) > 0 THEN CAST(length(t) - length(translate(t, '#$%&*|{}<>^~=+@_\\', '')) AS DOUBLE) / length(t) ELSE 0.0 END AS symbols,
  CASE WHEN length(t) > 0 THEN CAST(length(t) - length(regexp_replace(t, '\\p{Lu}', '', 'g')) AS DOUBLE) / length(t) ELSE 0.0 END AS capitals,
  CASE WHEN len(w) > 0 THEN CAST(len(w) - len(list_distinct(w)) AS DOUBLE) / len(w) ELSE 0.0 END AS word_copies,
  CAST(len(l) - len(list_distinct(l)) AS DOUBLE) / len(l) AS line_copies,
  CAST(len(w) AS DOUBLE) AS words FROM s),
r AS (
  SELECT 0 + i AS step, 'symbols' AS rule, [0.30, 0.25, 0.20, 0.15, 0.12, 0.10, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02][i + 1]::DOUBLE AS c FROM range(12) x(i) UNION ALL
  SELECT 12 + i, 'capitals', [0.90, 0.80, 0.70, 0.60, 0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.12, 0.10][i + 1]::DOUBLE FROM range(12) x(i) UNION ALL
  SELECT 24 + i, 'word_copies', [0.98, 0.95, 0.92, 0.90, 0.88, 0.85, 0.82, 0.80, 0.77, 0.75, 0.72, 0.70][i + 1]::DOUBLE FROM range(12) x(i) UNION ALL
  SELECT 36 + i, 'line_copies', [0.90, 0.80, 0.70, 0.60, 0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.10, 0.05][i + 1]::DOUBLE FROM range(12) x(i) UNION ALL
  SELECT 48 + i, 'words', [2, 3, 4, 5, 6, 8, 10, 12, 15, 20, 25, 30][i + 1]::DOUBLE FROM range(12) x(i)),
good AS (SELECT DISTINCT stratum, t, symbols, capitals, word_copies, line_copies, words FROM f SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) q USING (doc_id)),
n AS (SELECT stratum, count(*) AS n FROM good GROUP BY stratum),
able AS (SELECT coalesce(max(m), 0) AS m FROM (SELECT n, row_number() OVER (ORDER BY n DESC) AS m FROM n) q WHERE pow(0.98, n) <= 0.05 / m),
lost AS (SELECT g.stratum, r.step, count(*) FILTER (WHERE (r.step >= 0 AND symbols > [0.30, 0.25, 0.20, 0.15, 0.12, 0.10, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02][least(r.step, 11) + 1])
  OR (r.step >= 12 AND capitals > [0.90, 0.80, 0.70, 0.60, 0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.12, 0.10][least(r.step - 12, 11) + 1]) OR (r.step >= 24 AND word_copies > [0.98, 0.95, 0.92, 0.90, 0.88, 0.85, 0.82, 0.80, 0.77, 0.75, 0.72, 0.70][least(r.step - 24, 11) + 1])
  OR (r.step >= 36 AND line_copies > [0.90, 0.80, 0.70, 0.60, 0.50, 0.40, 0.30, 0.25, 0.20, 0.15, 0.10, 0.05][least(r.step - 36, 11) + 1]) OR (r.step >= 48 AND words < [2, 3, 4, 5, 6, 8, 10, 12, 15, 20, 25, 30][least(r.step - 48, 11) + 1])) AS k
  FROM good g CROSS JOIN r GROUP BY ALL),
p AS (SELECT lost.stratum, step, CASE WHEN k >= n.n THEN 1.0 ELSE list_sum([exp(lgamma(n.n + 1) - lgamma(i + 1) - lgamma(n.n - i + 1) + i * ln(0.02::DOUBLE) + (n.n - i) * ln(0.98::DOUBLE)) for i in range(0, k + 1)]) END <= 0.05 / nullif(able.m, 0) AND pow(0.98, n.n) <= 0.05 / nullif(able.m, 0) AS ok
  FROM lost JOIN n ON n.stratum IS NOT DISTINCT FROM lost.stratum CROSS JOIN able),
q AS (SELECT stratum, step, bool_and(coalesce(ok, FALSE)) OVER (PARTITION BY stratum ORDER BY step ROWS UNBOUNDED PRECEDING) AS ok FROM p),
c AS (SELECT q.stratum, r.rule, arg_max(r.c, r.step) AS c, min(r.step) AS place FROM q JOIN r USING (step) WHERE ok GROUP BY q.stratum, r.rule),
hit AS (SELECT f.rid, string_agg(c.rule, ',' ORDER BY c.place) AS broken FROM f JOIN c ON f.stratum IS NOT DISTINCT FROM c.stratum
  WHERE CASE c.rule WHEN 'symbols' THEN f.symbols > c.c WHEN 'capitals' THEN f.capitals > c.c WHEN 'word_copies' THEN f.word_copies > c.c WHEN 'line_copies' THEN f.line_copies > c.c ELSE f.words < c.c END GROUP BY f.rid)
SELECT f.doc_id, f.stratum, hit.rid IS NULL AS keep, coalesce(hit.broken, '') AS broken FROM f LEFT JOIN hit USING (rid)
"""


QUERIES = {"op8_rules": op8_rules}
ORACLE = {"op8_rules": _SQL}
