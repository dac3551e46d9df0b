"""Positions of regex matches as DataFrame expressions (code points, end exclusive).

A text split at the matches of a pattern and the matches themselves tell every
position: a match starts behind all the pieces and matches before it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,s:int,e:int,v:string>>"


def none() -> Column:
    return F.array().cast(SPAN)


def found(text: Column, pattern: str, kind: str, may: Column) -> Column:
    """All leftmost non-overlapping matches as ``struct(kind, s, e, v)``; ``may`` = false skips the regex work."""
    pieces = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), none().alias("out"))

    def step(acc: Column, p: Column) -> Column:
        s = acc["at"] + F.length(p["piece"])
        e = s + F.length(p["v"])
        one = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), p["v"].alias("v"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(values)).alias("piece"), values.alias("v"))
    walked = F.aggregate(zipped, start, step, lambda acc: acc["out"])
    return F.when(may & (F.size(values) > 0), walked).otherwise(none())


def written(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    order = F.array(*[F.lit(k) for k in kinds])
    keyed = F.array_sort(F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.array_position(order, x["kind"]).alias("k"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(keyed, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def masked(text: Column, spans: Column, mask: str = "[{}]") -> Column:
    """``text`` with every span replaced by its kind; overlapping spans are masked as one (the first kind wins)."""
    left, right = mask.split("{}")
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        before = F.substring(text, acc["at"] + 1, x["s"] - acc["at"])
        new = F.concat(acc["out"], before, F.lit(left), x["kind"], F.lit(right))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"),
                        F.when(x["s"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, rest)).otherwise(text)
