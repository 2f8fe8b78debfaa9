"""Connected components of a graph given as links, by alternating star contraction.

Each round points every node at the smallest node it sees (large star: from larger neighbours;
small star: from itself and smaller neighbours) until every component is one star around its
smallest node. Only minima are aggregated, so a hub of any degree combines before the shuffle, and
nothing is collected. The links shrink to one per node; every round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 64  # chains of length n need about log n rounds; more means a defect


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """``a`` sees ``b``: send what ``a`` sees (both: only larger nodes) to the smallest of all of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = edges.join(low, "a")
    if both:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) for every node with a link to another.

    Nulls and links of a node to itself say nothing and are left out. Repeated and reversed links
    count once. No links: no rows.
    """
    edges = (links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x != y")
             .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct().checkpoint())
    before = _state(edges)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(seen, both=True).distinct()
        edges = _star(large, both=False).distinct().checkpoint()
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())


def link_classes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Classes of ``rows`` (id, content) from what comparisons of distinct contents ``found``.

    ``found`` has, per content and comparison, ``links`` (linked rows of other contents) and
    ``parent`` (a content linked directly or over others, or null). Returned per row: id, content,
    n_links (other rows linked directly, its copies among them), class_id (smallest id of its
    class) and root (null for a row without any link). Rows with null content link with nothing.
    Rows are counted per content before the shuffle; rows without links join with nothing.
    """
    contents = rows.filter("content is not null").groupBy("content").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("id").alias("low_id"))
    links = found.groupBy("content").agg(F.sum("links").alias("links"))
    roots = components(found, "content", "parent").withColumnRenamed("node", "content")
    classes = (contents.join(roots, "content", "left").join(links, "content", "left")
               .filter("n_rows > 1 or root is not null").withColumn("root", F.coalesce("root", "content")))
    ids = classes.groupBy("root").agg(F.min("low_id").alias("low_id"))
    known = (classes.drop("low_id").join(ids, "root")
             .withColumn("n_links", F.col("n_rows") - 1 + F.coalesce("links", F.lit(0)))
             .select("content", "root", "low_id", "n_links"))
    return rows.join(known, "content", "left").select(
        "id", "content", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("low_id")).alias("class_id"), "root")
