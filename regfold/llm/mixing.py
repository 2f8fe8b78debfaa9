"""Mixing sources to target weights by weighted fair queueing (operator 10). DataFrame functions only.

Sources are ordered by code point, null last, and weigh 1, 2, 3, 1, 2, 3, ... They share the total of all sizes (words) by weight,
but no target passes ``MAX_REPEATS`` times its source; the excess is shared again by weight. That is
one water level: target = least(3 * size of the source, level * weight).

Each source's documents are shuffled by a hash of their id and queued, the whole queue up to three times over. An
entry's virtual finish time is the source's words up to and including it, over the source's weight.
All entries are ordered by finish time and taken until the budget, the total of all sizes, is used up.

Nothing sorts a source in one task: the shuffle hash cuts each source into ``HASH_BINS`` parts, whose totals
are summed first, so a running sum is an offset per part plus a sum inside of it. The
global order is cut into ``TIME_BINS`` ranges of finish time in the same way: a histogram finds the range
in which the budget ends, and only its rows are sorted.

Cases: null or empty texts have size 0 and take no words. If all sizes are 0, targets and takings
are 0. Null and repeated ids are queued like others; rows that are equal in id and size are
interchangeable. Extra columns are ignored. Reruns give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regfold.llm.common import WORD, prepare, unused

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
HASH_BINS = 4096
TIME_BINS = 65536


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """key, source, total -> the same with weight, level and target. One row per source."""
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = max_repeats * F.col("total")
    # sources that fill up first come first; those before a source are full when it is
    filling = Window.orderBy((cap / F.col("weight")).asc(), "key")
    before = F.coalesce(F.sum(cap).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    return (sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
            .withColumn("budget", F.sum("total").over(everything))
            .withColumn("level", (F.col("budget") - before) / rest)
            .withColumn("level", F.max("level").over(everything))
            .withColumn("target", F.least(cap.cast("double"), F.col("level") * F.col("weight")))
            .select("key", "source", "total", "weight", "level", "budget", "target"))


def _finish(turn: Column | int) -> Column:
    """Finish time of a document in the ``turn``-th pass over its source's queue, from 0."""
    return (turn * F.col("total") + F.col("upto")).cast("double") / F.col("weight")


def mix(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, weight, target, copies and taken (words) of every row."""
    prepare(docs.sparkSession)
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    sized = docs.select(
        "doc_id", "source", key.alias("key"), F.coalesce(F.md5("text"), F.lit("")).alias("content"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("shuffled"))
    sized = sized.withColumn("part", F.conv(F.substring("shuffled", 1, 3), 16, 10).cast("int") % HASH_BINS).checkpoint()
    parts = sized.groupBy("key", "part").agg(F.sum("size").alias("words"), F.min("source").alias("source"))
    targets = source_targets(parts.groupBy("key").agg(F.sum("words").alias("total"), F.min("source").alias("source")),
                             weights, max_repeats).checkpoint()
    ahead = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.select("key", "part", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
               .join(targets.drop("source"), "key"))
    upto = Window.partitionBy("key", "part").orderBy("shuffled", "doc_id", "size", "content").rowsBetween(
        Window.unboundedPreceding, 0)
    queue = (sized.join(offsets, ["key", "part"])
             .withColumn("upto", F.col("ahead") + F.sum("size").over(upto)).drop("ahead", "part").checkpoint())
    out = ["doc_id", "source", "content", "size", F.col("total").alias("source_size"), "weight", "target"]
    top = targets.select("level", "budget").first()
    if top is None or not top["budget"]:
        return queue.select(*out, F.lit(0).alias("copies"), F.lit(0).cast("long").alias("taken"))
    level, budget = top["level"], top["budget"]

    def time_bin(finish: Column) -> Column:
        return F.least(F.floor(finish / F.lit(level) * TIME_BINS), F.lit(2 * TIME_BINS))

    def entry(finish: Column) -> Column:
        return F.struct(finish.alias("finish"), "key", "shuffled", "doc_id", "size", "content")

    turns = F.explode(F.array(*[F.struct(_finish(k).alias("finish")) for k in range(max_repeats)])).alias("turn")
    entries = queue.select("key", "shuffled", "doc_id", "size", "content", turns)
    timed = entries.withColumn("bin", time_bin(F.col("turn.finish")))
    used = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    last = (timed.groupBy("bin").agg(F.sum("size").alias("words")).withColumn("used", F.sum("words").over(used))
            .filter(F.col("used") > budget).orderBy("bin").first())
    within = Window.orderBy("entry").rowsBetween(Window.unboundedPreceding, 0)
    inside = (timed.filter(F.col("bin") == last["bin"]).select("size", entry(F.col("turn.finish")).alias("entry"))
              .withColumn("used", F.lit(last["used"] - last["words"]) + F.sum("size").over(within))
              .filter(F.col("used") <= budget).agg(F.max("entry").alias("entry")).first()["entry"])

    def taken(turn: int) -> Column:
        finish = _finish(turn)
        early = time_bin(finish) < last["bin"]
        if inside is None:
            return early
        bound = F.struct(*[F.lit(v).cast(k).alias(n) for (n, k), v in zip(kinds, inside, strict=True)])
        return early | ((time_bin(finish) == last["bin"]) & (entry(finish) <= bound))

    kinds = [("finish", "double"), *[(n, dict(queue.dtypes)[n]) for n in ("key", "shuffled", "doc_id", "size", "content")]]
    copies = sum((taken(k).cast("int") for k in range(1, max_repeats)), taken(0).cast("int"))
    return (queue.withColumn("copies", copies)
            .select(*out, "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def mixed(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Rows equal in id and text are taken alike."""
    names = docs.columns
    key, id_, content, copies, copy = unused(docs, "_key", "_id", "_content", "_copies", "_copy")
    plan = (mix(docs, weights, max_repeats).groupBy("doc_id", "content").agg(F.min("copies").alias(copies))
            .filter(F.col(copies) > 0).select(F.col("doc_id").alias(id_), F.col("content").alias(content), copies))
    src = docs.withColumn(key, F.coalesce(F.md5("text"), F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(content))
    joined = src.join(plan, same)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select([f"`{c}`" for c in names])
