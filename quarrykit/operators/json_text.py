"""JSON inside free text.

The simple forms are Spark expressions. Balanced braces cannot be matched by a regular
expression, so those two scans are Arrow functions over whole columns.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_THINK = re.compile(r"<think>.*?</think>", re.S)
_FENCE = re.compile(r"```(?:json)?\s*\n(.*?)```", re.S)


def parsed(text: Column) -> Column:
    """A variant: the text itself, what a fence holds, or what stands from the first brace to the last; null if none is JSON."""
    fenced = F.regexp_extract(text, "(?s)```(?:json)?\\s*(.*?)```", 1)
    braced = F.regexp_extract(text, "(?s)(\\{.*\\})", 1)
    return F.coalesce(F.try_parse_json(F.trim(text)), *[F.try_parse_json(F.when(F.length(F.trim(c)) > 0, F.trim(c))) for c in (fenced, braced)])


def _loads(s: str):
    try:
        return json.loads(s)
    except ValueError:
        return None


def first_balanced(text: str | None) -> str | None:
    """JSON by: the whole, a fence with a line break, the first balanced braces (braces in strings count)."""
    if text is None:
        return None
    fence = _FENCE.search(text)
    for s in (text.strip(), fence.group(1).strip() if fence else ""):
        if s and _loads(s) is not None:
            return s
    at = text.find("{")
    depth = 0
    for i in range(at, len(text)) if at >= 0 else ():
        depth += (text[i] == "{") - (text[i] == "}")
        if depth == 0:
            s = text[at : i + 1]
            return s if _loads(s) is not None else None
    return None


def _objects(text: str):
    """Outermost and inner balanced objects, with strings and escapes understood, by where they end."""
    opened: list[int] = []
    quoted = escaped = False
    for i, c in enumerate(text):
        if quoted:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                quoted = False
        elif c == '"' and opened:
            quoted = True
        elif c == "{":
            opened.append(i)
        elif c == "}" and opened:
            yield text[opened.pop() : i + 1]


def judge_json(text: str | None, field: str = "edit_executed") -> str | None:
    """The verdict in a judge's answer: without the think-block, the whole, a fence, or the last object that has the field."""
    if text is None:
        return None
    text = _THINK.sub("", text).rpartition("</think>")[2]
    fence = _FENCE.search(text)
    for s in (text.strip(), fence.group(1).strip() if fence else ""):
        v = _loads(s) if s else None
        if isinstance(v, dict) and field in v:
            return s
    found = None
    for s in _objects(text):
        v = _loads(s)
        if isinstance(v, dict) and field in v:
            found = s
    return found


def _arrow(f):
    return F.arrow_udf(lambda c: pa.array([f(t) for t in c.to_pylist()], pa.string()), "string")


def extracted(text: Column) -> Column:
    return _arrow(first_balanced)(text)


def judged(text: Column) -> Column:
    """Struct of a judge's verdict with defaults; null text or no verdict: rejected. Booleans are JSON booleans, strings are not taken for them."""
    v = F.try_parse_json(_arrow(judge_json)(text))
    flag = lambda n: F.coalesce(F.try_variant_get(v, f"$.{n}", "boolean"), F.lit(False))
    return F.struct(
        v.isNull().alias("rejected"), flag("edit_executed").alias("executed"), flag("correct_region").alias("region"), flag("preserve_other").alias("preserved"),
        F.coalesce(F.try_variant_get(v, "$.visual_quality", "int"), F.lit(1)).alias("quality"), flag("artifact_free").alias("clean"),
        F.coalesce(F.try_variant_get(v, "$.reason", "string"), F.lit("")).alias("reason"),
    )
