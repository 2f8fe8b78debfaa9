"""Spans of a pattern in a text, with positions, by built-in functions alone.

``regexp_extract_all`` gives the matches and ``split`` with the same pattern what lies between them;
running sums of their lengths are the positions (code points, end exclusive).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<start:long,end:long,value:string,before:string,after:string>"
GROUP = 64
CONTEXT = 32


def _running(values: Column, zero: Column) -> Column:
    """Running sums of an array of longs, by appending."""
    step = F.aggregate(values, F.struct(zero.alias("sum"), F.array().cast("array<long>").alias("all")),
                       lambda a, v: F.struct((a["sum"] + v).alias("sum"),
                                             F.concat(a["all"], F.array(a["sum"] + v)).alias("all")))
    return step["all"]


def running_sum(values: Column) -> Column:
    """Running sums of a long array: groups of 64 first, so that a text with very many matches
    costs no square of their number."""
    groups = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / GROUP).cast("int") - 1, F.lit(0)))
    part = lambda g: F.slice(values, g * GROUP + 1, F.lit(GROUP))
    sums = F.transform(groups, lambda g: F.aggregate(part(g), F.lit(0).cast("long"), lambda a, v: a + v))
    ahead = _running(F.concat(F.array(F.lit(0).cast("long")), sums), F.lit(0).cast("long"))
    return F.flatten(F.transform(groups, lambda g: _running(part(g), F.get(ahead, g))))


def with_spans(df: DataFrame, name: str, text: str, pattern: str, guard: Column, group: int | None = None) -> DataFrame:
    """Add ``name``: all leftmost non-overlapping matches as an array of SPAN, empty where ``guard`` is not true.

    With ``group``, SPAN's value is that group's text instead of the whole match. Each step is a
    column of its own, so that no expression is evaluated twice.
    """
    m, p, g, d = (f"_{name}_{x}" for x in "mpgd")
    none = F.array().cast("array<string>")
    found = F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    df = df.withColumn(m, found)
    some = F.size(m) > 0
    df = df.withColumn(p, F.when(some, F.split(text, pattern, -1)).otherwise(none))
    long0 = F.array(F.lit(0).cast("long"))
    gaps = F.transform(F.slice(F.col(p), 1, F.size(m)), lambda x: F.length(x).cast("long"))
    before = F.concat(long0, F.transform(F.col(m), lambda x: F.length(x).cast("long")))
    df = df.withColumn(d, F.when(some, running_sum(
        F.zip_with(gaps, F.slice(before, F.lit(1), F.size(m)), lambda a, b: a + b))))
    if group is not None:
        df = df.withColumn(g, F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none))
    value = F.col(m if group is None else g)

    def span(i: Column) -> Column:
        start = F.get(F.col(d), i)
        gap = F.get(F.col(p), i)
        return F.struct(start.alias("start"), (start + F.length(F.get(F.col(m), i))).alias("end"),
                        F.get(value, i).alias("value"), F.right(gap, F.lit(CONTEXT)).alias("before"),
                        F.left(F.get(F.col(p), i + 1), F.lit(CONTEXT)).alias("after"))

    spans = F.transform(F.sequence(F.lit(0), F.size(m) - 1), span)
    df = df.withColumn(name, F.when(some, spans).otherwise(F.array().cast(f"array<{SPAN}>")).cast(f"array<{SPAN}>"))
    return df.drop(m, p, d, *([g] if group is not None else []))


def marked(spans: Column, kind: str, rank: int) -> Column:
    """Sortable form of spans: start, rank of the kind, end, kind."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 s["end"].alias("end"), F.lit(kind).alias("kind")))


def listed(marks: Column) -> Column:
    """kind:start:end of sorted marks, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(F.array_sort(marks), one))


def cover(text: Column, marks: Column) -> Column:
    """``text`` with every marked span replaced by its kind in angle brackets; of overlapping spans the
    first by start, then the longer one by rank, names the union."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        gap = F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        out = F.when(fresh, F.concat(a["out"], F.array(gap, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.otherwise(a["out"]).alias("out"))

    def finish(a: Column) -> Column:
        return F.concat(F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return F.when(F.size(marks) > 0, F.aggregate(F.array_sort(marks), start, step, finish)).otherwise(text)
