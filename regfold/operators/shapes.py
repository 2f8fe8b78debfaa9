"""P0 and the six projection shapes: nested main table -> flat detail table.

Every operator is a narrow projection (select / explode / higher-order functions): no shuffle,
whole-stage codegen, and nested column pruning reaches the Parquet scan of a staged main table.
A main table may hold an entity in several rows (pages, parts, drops); S and O read the head
row (page 0), the array shapes read every row, so paged and unpaged main tables give the same
rows.

Leaves are cast with ``try_cast`` to the type in the register's typed schema: a main table read
from XML holds strings only (D1), a typed one passes through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfold.plans.specs import PROVENANCE, SPECS, TableSpec, field_type


def _carry(main: DataFrame) -> list[str]:
    return [c for c in PROVENANCE if c in main.columns]


def _base(main: DataFrame) -> list[Column]:
    return [F.col("entity_id").try_cast("bigint").alias("entity_id")] + [F.col(c) for c in _carry(main)]


def _leaf(parent: Column, spec: TableSpec, name: str, level: str = "leaf") -> Column:
    return parent.getField(name).try_cast(field_type(spec.registry, spec, name, level)).alias(name)


def _head(main: DataFrame) -> Column:
    # a row without a page is a whole entity
    return F.coalesce(F.col("page").try_cast("int"), F.lit(0)) == 0 if "page" in main.columns else F.lit(True)


def project_root(main: DataFrame, spec: TableSpec) -> DataFrame:
    """S: one row per entity from root columns."""
    cols = [F.col(n).try_cast(field_type(spec.registry, spec, n)).alias(n) for n in spec.fields]
    return main.where(_head(main)).select(*_base(main), *cols)


def project_struct(main: DataFrame, spec: TableSpec) -> DataFrame:
    """O / O*: zero or one row per entity from an optional struct."""
    el = F.col(spec.element)
    return main.where(el.isNotNull()).select(*_base(main), *[_leaf(el, spec, n) for n in spec.fields])


def _exploded(main: DataFrame, element: str, arr: Column | None = None) -> DataFrame:
    """Rows holding ``element``, one per item of ``arr`` (default: the element itself).

    The null test comes first so Catalyst drops every union branch of a main table that cannot
    hold the element (its column is a null literal there) before anything is computed.
    """
    keep = ["entity_id", *_carry(main)]
    arr = F.col(element) if arr is None else arr
    return (main.where(F.col(element).isNotNull())
            .select(*_base(main), F.explode(arr).alias("_x")).select(*keep, "_x"))


def project_array(main: DataFrame, spec: TableSpec) -> DataFrame:
    """N: one row per array element."""
    x = F.col("_x")
    df = _exploded(main, spec.element)
    return df.select("entity_id", *_carry(main), *[_leaf(x, spec, n) for n in spec.fields])


def project_nested(main: DataFrame, spec: TableSpec) -> DataFrame:
    """NN: one row per inner element, with the fields of its outer group."""
    x, r = F.col("_x"), F.col("_r")
    keep = ["entity_id", *_carry(main)]
    df = _exploded(main, spec.element)
    df = df.select(*keep, *[_leaf(x, spec, g, "group") for g in spec.group], F.explode(x.getField("rows")).alias("_r"))
    return df.select(*keep, *spec.group, *[_leaf(r, spec, n) for n in spec.fields])


def project_main_extra(main: DataFrame, spec: TableSpec) -> DataFrame:
    """M: the main element and every extra one, marked by ``is_main``."""
    el = F.col(spec.element)
    head = el.getField("main")

    def row(e: Column, is_main: bool) -> Column:
        return F.struct(*[_leaf(e, spec, n) for n in spec.fields], F.lit(is_main).alias("is_main"))

    main_row = row(head, True)
    empty = F.array_compact(F.array(F.when(F.lit(False), main_row)))  # typed empty array
    items = F.concat(
        F.array_compact(F.array(F.when(head.isNotNull(), main_row))),
        F.coalesce(F.transform(el.getField("extra"), lambda e: row(e, False)), empty),
    )
    x = F.col("_x")
    df = _exploded(main, spec.element, items)
    return df.select("entity_id", *_carry(main), *[x.getField(n).alias(n) for n in (*spec.fields, "is_main")])


def project_variant(main: DataFrame, spec: TableSpec) -> DataFrame:
    """P: the elements of one kind from an array shared by several tables."""
    arr = F.filter(F.col(spec.element), lambda e: e.getField("kind") == F.lit(spec.kind))
    x = F.col("_x")
    df = _exploded(main, spec.element, arr)
    return df.select("entity_id", *_carry(main), *[_leaf(x, spec, n) for n in spec.fields])


SHAPE_OPS = {
    "S": project_root,
    "O": project_struct,
    "N": project_array,
    "NN": project_nested,
    "M": project_main_extra,
    "P": project_variant,
}


def project(main: DataFrame, spec: TableSpec) -> DataFrame:
    """Build one detail table from a main table by its spec."""
    out = SHAPE_OPS[spec.shape](main, spec)
    if spec.keep_missing and spec.shape != "S":
        out = out.unionByName(_missing(main, spec, out))
    return out


def _rows_alike(spec: TableSpec) -> tuple:
    """Tables of one register with equal keys have rows of one type, from elements of one type."""
    types = tuple(str(field_type(spec.registry, spec, f)) for f in spec.fields)
    return spec.registry, spec.shape, spec.fields, types


def together(specs: list[TableSpec]) -> list[list[TableSpec]]:
    """Specs in groups that ``project_together`` can build from one scan, the others alone."""
    groups: dict = {}
    for s in specs:
        key = _rows_alike(s) if s.shape in ("O", "N", "P") and not s.keep_missing else (s.name,)
        groups.setdefault(key, []).append(s)
    return list(groups.values())


def project_together(main: DataFrame, specs: list[TableSpec]) -> DataFrame:
    """The rows of several tables of one group (``together``) from one scan, told apart by ``table``.

    Every row's elements are listed with their table (P: with their element; the kind decides later) and exploded;
    an array that several tables share is exploded once.
    """
    shape, keep = specs[0].shape, ["entity_id", *_carry(main)]
    elements = list(dict.fromkeys(s.element for s in specs))
    name = {s.element: s.name for s in specs}
    held = [F.when(F.col(e).isNotNull(), F.struct(F.lit(e if shape == "P" else name[e]).alias("table"), F.col(e).alias("value")))
            for e in elements]
    some = F.lit(False)
    for e in elements:
        some = some | F.col(e).isNotNull()
    df = main.where(some).select(*_base(main), F.explode(F.array_compact(F.array(*held))).alias("_of"))
    value = F.col("_of.value")
    df = df.select(*keep, F.col("_of.table").alias("table"), (value if shape == "O" else F.explode(value)).alias("_x"))
    x = F.col("_x")
    if shape == "P":
        table = F.lit(None).cast("string")
        for s in specs:
            table = F.when((F.col("table") == s.element) & (x.getField("kind") == s.kind), s.name).otherwise(table)
        df = df.withColumn("table", table).where("table is not null")
    return df.select(*keep, *[_leaf(x, specs[0], n) for n in specs[0].fields], "table")


def _missing(main: DataFrame, spec: TableSpec, found: DataFrame) -> DataFrame:
    """One row of nulls per entity (head row) that yielded no row of ``spec``.

    For a struct the head row says it; an array may sit on any page of the entity, so the heads
    are anti-joined with the entities that produced rows (a partially aggregated distinct).
    """
    if spec.shape == "O":
        heads = main.where(_head(main) & F.col(spec.element).isNull()).select(*_base(main))
    else:
        heads = (main.where(_head(main)).select(*_base(main))
                 .join(found.select("entity_id").distinct(), "entity_id", "left_anti"))
    nulls = [F.lit(None).cast(t).alias(c) for c, t in found.dtypes if c not in heads.columns]
    return heads.select("*", *nulls).select(*found.columns)


def element_rows(main: DataFrame, spec: TableSpec) -> Column:
    """Rows ``spec`` yields from one main row, computed without exploding (for counts)."""
    if spec.shape == "S":
        return F.when(_head(main), 1).otherwise(0)
    el = F.col(spec.element)
    if spec.shape == "O":
        return F.when(el.isNotNull(), 1).otherwise(0)
    if spec.shape == "N":
        return F.coalesce(F.size(el), F.lit(0))
    if spec.shape == "P":  # count matching kinds without building a filtered array
        return F.coalesce(F.aggregate(el, F.lit(0), lambda acc, e: acc + F.when(
            e.getField("kind") == F.lit(spec.kind), 1).otherwise(0)), F.lit(0))
    if spec.shape == "NN":
        return F.coalesce(
            F.aggregate(el, F.lit(0), lambda acc, g: acc + F.coalesce(F.size(g.getField("rows")), F.lit(0))),
            F.lit(0))
    if spec.shape == "M":
        return (F.when(el.getField("main").isNotNull(), 1).otherwise(0)
                + F.coalesce(F.size(el.getField("extra")), F.lit(0)))
    raise ValueError(spec.shape)


def fan_out_counts(mains: dict[str, DataFrame]) -> DataFrame:
    """Row count of every detail table, from one pass over each main table.

    Per row, each table's contribution is a size expression; one global aggregate sums them
    (partial aggregation, one row per task shuffled), then ``stack`` turns columns into rows.
    """
    parts = []
    for registry, main in mains.items():
        specs = [s for s in SPECS if s.registry == registry]
        sums = main.agg(*[F.sum(element_rows(main, s)).cast("bigint").alias(s.name) for s in specs])
        stack = "stack({}, {}) as (table_name, n_rows)".format(
            len(specs), ", ".join(f"'{s.name}', `{s.name}`" for s in specs))
        parts.append(sums.selectExpr(f"'{registry}' as registry", stack))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bad(parent: Column, spec: TableSpec, names, level: str = "leaf") -> Column:
    """Leaves of ``parent`` with text that does not cast to their type (strings always cast)."""
    from pyspark.sql import types as T

    out = F.lit(0)
    for n in names:
        t = field_type(spec.registry, spec, n, level)
        if isinstance(t, T.StringType):
            continue
        v = parent.getField(n) if parent is not None else F.col(n)
        out = out + F.when(v.isNotNull() & v.try_cast(t).isNull(), 1).otherwise(0)
    return out


def bad_values(main: DataFrame, spec: TableSpec) -> Column:
    """Per main row: values of ``spec`` that would turn null by ``try_cast``."""
    if spec.shape == "S":
        return F.when(_head(main), _bad(None, spec, spec.fields)).otherwise(0)
    el = F.col(spec.element)
    if spec.shape == "O":
        return F.when(el.isNotNull(), _bad(el, spec, spec.fields)).otherwise(0)
    if spec.shape in ("N", "P"):
        keep = (lambda e: e.getField("kind") == F.lit(spec.kind)) if spec.shape == "P" else (lambda e: F.lit(True))
        return F.coalesce(F.aggregate(el, F.lit(0), lambda acc, e: acc + F.when(keep(e), _bad(e, spec, spec.fields))
                                      .otherwise(0)), F.lit(0))
    if spec.shape == "NN":
        return F.coalesce(F.aggregate(el, F.lit(0), lambda acc, g: acc + _bad(g, spec, spec.group, "group")
                                      + F.coalesce(F.aggregate(g.getField("rows"), F.lit(0),
                                                               lambda a, r: a + _bad(r, spec, spec.fields)), F.lit(0))),
                          F.lit(0))
    if spec.shape == "M":
        m = el.getField("main")
        return (F.when(m.isNotNull(), _bad(m, spec, spec.fields)).otherwise(0)
                + F.coalesce(F.aggregate(el.getField("extra"), F.lit(0), lambda acc, e: acc + _bad(e, spec, spec.fields)),
                             F.lit(0)))
    raise ValueError(spec.shape)


def table_checks(mains: dict[str, DataFrame]) -> DataFrame:
    """(registry, table_name, n_expected, n_bad_values) for every detail table, from one pass
    over each main table: the rows each table must hold and the values that fail their cast."""
    parts = []
    for registry, main in mains.items():
        specs = [s for s in SPECS if s.registry == registry]
        aggs = []
        for s_ in specs:
            aggs.append(F.sum(element_rows(main, s_)).cast("bigint").alias(f"{s_.name}__n"))
            aggs.append(F.sum(bad_values(main, s_)).cast("bigint").alias(f"{s_.name}__bad"))
        stack = "stack({}, {}) as (table_name, n_expected, n_bad_values)".format(
            len(specs), ", ".join(f"'{s_.name}', `{s_.name}__n`, `{s_.name}__bad`" for s_ in specs))
        parts.append(main.agg(*aggs).selectExpr(f"'{registry}' as registry", stack))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bad_value_counts(mains: dict[str, DataFrame]) -> DataFrame:
    """(registry, table_name, n_bad_values)."""
    return table_checks(mains).select("registry", "table_name", "n_bad_values")
