"""Bounded nesting: flat child rows -> array elements of a main table, in pages.

An entity's children are not gathered into one row: one key may hold a third of all rows, and a
single array of that size would not fit one task. Each child row gets a page number
``1 + pmod(row_id, ceil(n / page_size))`` from the entity's child count ``n`` (a partially
aggregated count; only entities of several pages need it), and arrays are collected
per (entity, page). Page 0 is the head row with the root fields and single elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements per page: a few hundred KB per nested row at most.
PAGE_SIZE = 4096

# The children of one key meet its count in this many tasks. Adaptive execution can't split that
# join by itself: its right side is an aggregate, not a plain shuffle read.
SALTS = 16


def page_of(row_id: Column, n: Column, page_size: int = PAGE_SIZE) -> Column:
    """Page of one child row among ``n`` children of its entity."""
    pages = F.greatest(F.ceil(n / F.lit(page_size)), F.lit(1)).cast("bigint")
    return (F.pmod(row_id, pages) + F.lit(1)).cast("int")


def with_pages(children: DataFrame, key: str, counts: DataFrame, row_id: str = "_row_id",
               n: str = "_n", page_size: int = PAGE_SIZE, shared: bool = False) -> DataFrame:
    """Give each child a page and distribute by (key, page). Further columns of ``counts`` come along for entities of
    more than one page and are null for the others.

    Only entities with more children than a page meet their count; all children of the others are on page 1. At most one
    row in ``page_size`` can have such an entity of its own, so their counts are broadcast and the children are shuffled once, by
    (key, page), which is what spreads a hot key over tasks. With broadcasts off the counts are dealt to ``SALTS``
    tasks a key. Every later aggregation groups by (key, page, ...) and so runs without another shuffle.

    ``shared``: several branches of one plan read most of the columns (all but ``row_id``). Column pruning would give each branch
    a shuffle of its own columns; the row goes through it as one value that cannot be pruned, so all branches read one shuffle.
    """
    children, large = children.where(F.col(key).isNotNull()), counts.where(F.col(n) > page_size)
    if not children.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith(("-", "0")):
        joined = children.join(F.broadcast(large), [key], "left")
    else:
        salted = children.withColumn("_salt", F.pmod(F.col(row_id), F.lit(SALTS)).cast("int"))
        spread = large.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(spread, [key, "_salt"], "left").drop("_salt")
    paged = joined.withColumn("page", F.coalesce(page_of(F.col(row_id), F.col(n), page_size), F.lit(1))).drop(n)
    if not shared:
        return paged.repartition(key, "page")
    rest = [c for c in paged.columns if c not in (key, "page", row_id)]
    packed = paged.select(key, "page", F.array(F.struct(*rest)).alias("_packed")).repartition(key, "page")
    # fields of a struct column are pruned through a repartition, those of an array's item are not
    return packed.select(key, "page", *[F.element_at("_packed", 1).getField(c).alias(c) for c in rest])


def sorted_list(item: Column) -> Column:
    """``collect_list`` in a fixed order (nulls skipped), so results do not depend on task order."""
    return F.array_sort(F.collect_list(item))


class NestSpec:
    """One NN element: rows where ``cond`` holds, grouped by ``group`` ((name, expression) pairs)
    into outer elements, each holding its rows as ``rows``."""

    def __init__(self, name: str, cond: Column, group: list[tuple[str, Column]], row: Column):
        self.name, self.cond, self.group, self.row = name, cond, group, row


def nest_many(df: DataFrame, keys: list[str], specs: list[NestSpec]) -> DataFrame:
    """NN elements from one set of rows distributed by ``keys``: one row per ``keys`` with one
    array column per spec.

    A row that belongs to several elements is copied once per element (``explode`` of its tags),
    so the rows are read and shuffled once for all elements. Both grouping levels group by a
    superset of ``keys`` and run on the existing distribution (after ``with_pages`` Catalyst
    merges the repartition below into that one): no further shuffle, and no map-side combine,
    which would gain nothing since collected lists do not shrink.
    """
    tag = F.explode(F.array_compact(F.array(*[F.when(sp.cond, F.lit(i)) for i, sp in enumerate(specs)])))
    el = F.col("_el")
    tagged = df.repartition(*keys).select("*", tag.alias("_el"))
    gcols, rows = [], []
    for i, sp in enumerate(specs):
        gcols += [F.when(el == i, g).alias(f"_g{i}_{j}") for j, (_, g) in enumerate(sp.group)]
        rows.append(sorted_list(F.when(el == i, sp.row)).alias(f"_r{i}"))
    inner = tagged.groupBy(*keys, el, *gcols).agg(*rows)
    outs = []
    for i, sp in enumerate(specs):
        fields = [F.col(f"_g{i}_{j}").alias(n) for j, (n, _) in enumerate(sp.group)]
        outs.append(sorted_list(F.when(el == i, F.struct(*fields, F.col(f"_r{i}").alias("rows")))).alias(sp.name))
    return inner.groupBy(*keys).agg(*outs)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly ``schema``: present columns cast, missing ones typed nulls.

    A null literal for a missing element lets Catalyst drop a whole union branch when a query
    filters on that element.
    """
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
