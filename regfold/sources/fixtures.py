"""Nested main tables from the given test tables (FIXTURES.md section 3).

``person_main`` (register egrip): one head row per customer plus pages of its orders and of the
line items of its urgent / open orders. ``org_main`` (register egrul): one head row per supplier
plus pages of its line items. The result has exactly the register's typed schema.

Plan shape, per register:
  * one grouped aggregate over the children gives every single-valued element and the child
    count (partial aggregation, so a hot key costs one row per task in the shuffle);
  * the head row joins the entity table to that aggregate and to the small dimension tables
    (nation, region: Spark broadcasts them only while their measured size stays under
    ``spark.sql.autoBroadcastJoinThreshold``, else it sort-merge joins);
  * children join their count to get a page; every array of a page is collected in one
    aggregate keyed by (entity, page), so the children are shuffled for the join and reused.
The whole plan is lazy: a query on one element keeps only the branch that feeds it, and with ``shared`` off only the columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.operators.nest import PAGE_SIZE, NestSpec, conform, nest_many, sorted_list, union_all, with_pages
from regfold.plans.specs import FOUNDER_KINDS, SUBDIV_KINDS, schema_of
from regfold.sources.tables import read_table, row_id


def _email(name: Column) -> Column:
    return F.concat(F.replace(name, F.lit("#"), F.lit(".")), F.lit("@example.com"))


def _when(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


def _main_extra(registry: str, element: str, main: Column | None = None, extra: Column | None = None) -> Column:
    """An M element with both fields typed, whichever one this row carries."""
    t = schema_of(registry)[element].dataType
    m = (main if main is not None else F.lit(None)).cast(t["main"].dataType)
    e = (extra if extra is not None else F.lit(None)).cast(t["extra"].dataType)
    return F.struct(m.alias("main"), e.alias("extra"))


def _extras(rows: str, *fields: str) -> Column:
    """The rows of a page but the entity's main one, by ``fields``. An entity of several pages has brought its main row
    (``with_pages``); else it is the best row of the only page."""
    main = F.coalesce(F.col("_main_row"), F.col("_best").getField("_row_id"))
    left = F.filter(F.col(rows), lambda r: r.getField("_row_id") != main)
    return F.array_sort(F.transform(left, lambda r: F.struct(*[r.getField(f).alias(f) for f in fields])))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").drop("r_regionkey")


def person_main(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE, shared: bool = True) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
        row_id().alias("_row_id"))

    ostats = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("o_orderdate").alias("regip_first"),
        F.max(_when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("stop_last"),
        F.min(_when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate"))).alias("regpf_first"),
        F.min(_when(F.col("o_orderpriority") == "2-HIGH", F.col("o_orderdate"))).alias("regfss_first"),
    )
    # the argmax over a struct needs a sort-based aggregate: kept apart and narrow, so the
    # aggregate above stays hashed
    okv = orders.groupBy("o_custkey").agg(F.max(F.struct("o_totalprice", "o_orderkey", "_row_id")).alias("okved_main"))
    ostats = ostats.join(okv, "o_custkey", "left")

    geo = _geo(spark, sf_dir)
    h = (cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
         .join(ostats, cust.c_custkey == ostats.o_custkey, "left"))
    has_nation = F.col("n_nationkey").isNotNull()
    okm = F.col("okved_main")
    head = h.select(
        F.col("c_custkey").alias("entity_id"),
        F.lit(0).alias("page"),
        "c_name", "c_mktsegment",
        _when(F.col("c_acctbal") >= 0, F.struct("c_name", "c_acctbal")).alias("fl"),
        _when(has_nation, F.struct("n_name", "r_name")).alias("citizenship"),
        _when(F.col("_n").isNotNull(),
              F.struct(F.col("regip_first").alias("first_date"), F.col("_n").alias("n_items"))).alias("regip"),
        _when(has_nation, F.struct("n_nationkey", "n_name")).alias("regorg"),
        _when(F.col("stop_last").isNotNull(), F.struct(F.col("stop_last").alias("last_date"))).alias("stop"),
        F.struct("c_nationkey", "c_mktsegment").alias("uchetno"),
        _when(F.col("regpf_first").isNotNull(), F.struct(F.col("regpf_first").alias("first_date"))).alias("regpf"),
        _when(F.col("regfss_first").isNotNull(),
              F.struct(F.col("regfss_first").alias("first_date"))).alias("regfss"),
        _when(F.col("c_acctbal") < 0, F.struct(F.upper("c_name").alias("name_upper"))).alias("fiozags"),
        _when(F.col("c_mktsegment") == "BUILDING", F.struct(_email(F.col("c_name")).alias("email"))).alias("adremail"),
        _when(okm.isNotNull(), _main_extra("egrip", "okved", main=F.struct(okm.getField("o_orderkey").alias("o_orderkey")))
              ).alias("okved"),
    )

    # pages of orders: status entries and the extra activity codes
    counts = ostats.select("o_custkey", "_n", okm.getField("_row_id").alias("_main_row"))
    op = with_pages(orders, "o_custkey", counts, page_size=page_size)
    order_pages = op.groupBy("o_custkey", "page").agg(
        sorted_list(F.struct("o_orderkey", "o_orderstatus", "o_orderdate")).alias("status"),
        F.max(F.struct("o_totalprice", "o_orderkey", "_row_id")).alias("_best"),
        F.max("_main_row").alias("_main_row"),
        F.collect_list(F.struct("o_orderkey", "_row_id")).alias("_all"),
    ).select(F.col("o_custkey").alias("entity_id"), "page", "status",
             _main_extra("egrip", "okved", extra=_extras("_all", "o_orderkey")).alias("okved"))

    # pages of line items of urgent / open orders: licences and register entries (NN)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate", F.hash(row_id()).alias("_row_id"))
    sel = orders.where((F.col("o_orderpriority") == "1-URGENT") | (F.col("o_orderstatus") == "O")).select(
        "o_orderkey", "o_custkey",
        (F.col("o_orderpriority") == "1-URGENT").alias("_lic"), (F.col("o_orderstatus") == "O").alias("_note"))
    lo = li.join(sel, li.l_orderkey == sel.o_orderkey)
    lcounts = lo.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("_n"))
    lp = with_pages(lo, "o_custkey", lcounts, page_size=page_size)
    nested = nest_many(lp, ["o_custkey", "page"], [
        NestSpec("lic", F.col("_lic"), [("o_orderkey", F.col("o_orderkey"))],
                 F.struct("l_linenumber", "l_partkey")),
        NestSpec("noteegrip", F.col("_note"), [("o_orderkey", F.col("o_orderkey"))],
                 F.struct("l_linenumber", "l_returnflag", "l_shipdate")),
    ])

    schema = schema_of("egrip")
    parts = [head, order_pages, nested.withColumnRenamed("o_custkey", "entity_id")]
    return union_all([conform(p, schema) for p in parts])


def _kind(codes: tuple[str, ...], index: Column) -> Column:
    """Map 0..len-1 to a kind code."""
    out = None
    for i, code in enumerate(codes):
        out = (F.when(index == i, F.lit(code)) if out is None else out.when(index == i, F.lit(code)))
    return out


def org_main(spark: SparkSession, sf_dir: str, page_size: int = PAGE_SIZE, shared: bool = True) -> DataFrame:
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate", row_id().alias("_row_id"))
    ln = F.col("l_linenumber")

    lstats = li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("l_shipdate").alias("ulreg_first"),
        F.max(_when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50), F.col("l_shipdate"))
              ).alias("ulstop_last"),
        F.min(_when(ln == 1, F.col("l_shipdate"))).alias("ulpfreg_first"),
        F.min(_when(ln == 2, F.col("l_shipdate"))).alias("ulfssreg_first"),
        F.max(_when(ln == 4, F.col("l_quantity"))).alias("ulustcapdol_max"),
    )
    # The main activity code is a max over a struct, which only a sort-based aggregate can
    # compute; it runs over the line-5 rows alone, so the all-rows aggregate above stays hashed.
    okv = li.where(ln == 5).groupBy("l_suppkey").agg(
        F.max(F.struct("l_extendedprice", "l_orderkey", "l_partkey", "l_quantity", "_row_id")).alias("ulokved_main"))
    lstats = lstats.join(okv, "l_suppkey", "left")

    geo = _geo(spark, sf_dir)
    h = (sup.join(geo, sup.s_nationkey == geo.n_nationkey, "left")
         .join(lstats, sup.s_suppkey == lstats.l_suppkey, "left"))
    has_nation = F.col("n_nationkey").isNotNull()
    okm = F.col("ulokved_main")
    acct = F.col("s_acctbal")
    head = h.select(
        F.col("s_suppkey").alias("entity_id"),
        F.lit(0).alias("page"),
        "s_name", "s_acctbal",
        F.struct("s_name", F.upper("s_name").alias("name_upper")).alias("ul_name"),
        _when(has_nation, F.struct("n_name", "r_name")).alias("ul_adress"),
        _when(acct > 5000, F.struct(_email(F.col("s_name")).alias("email"))).alias("ulemail"),
        _when(F.col("ulreg_first").isNotNull(), F.struct(F.col("ulreg_first").alias("first_date"))).alias("ulreg"),
        _when(has_nation, F.struct("n_nationkey", "n_name")).alias("ulregorg"),
        _when(F.col("ulstop_last").isNotNull(), F.struct(F.col("ulstop_last").alias("last_date"))).alias("ulstop"),
        _when(acct < 4000, F.struct("s_acctbal")).alias("ulrules"),
        F.struct("s_nationkey").alias("ulnouch"),
        _when(F.col("ulpfreg_first").isNotNull(),
              F.struct(F.col("ulpfreg_first").alias("first_date"))).alias("ulpfreg"),
        _when(F.col("ulfssreg_first").isNotNull(),
              F.struct(F.col("ulfssreg_first").alias("first_date"))).alias("ulfssreg"),
        _when(F.col("_n").isNotNull(), F.struct(F.col("_n").alias("n_items"))).alias("ulustcap"),
        _when(F.col("ulustcapdol_max").isNotNull(),
              F.struct(F.col("ulustcapdol_max").alias("max_quantity"))).alias("ulustcapdol"),
        _when(has_nation, F.struct("n_name", "n_regionkey")).alias("ulacsderg"),
        _when(F.pmod(F.col("s_suppkey"), F.lit(10)) == 0, F.struct("s_name")).alias("krestxoz"),
        _when(F.pmod(F.col("s_suppkey"), F.lit(10)) == 5, F.struct("s_name")).alias("ulkvhp"),
        _when(okm.isNotNull(), _main_extra("egrul", "ulokved", main=F.struct(
            okm.getField("l_orderkey").alias("l_orderkey"), okm.getField("l_partkey").alias("l_partkey")))
              ).alias("ulokved"),
    )

    counts = lstats.select("l_suppkey", "_n", okm.getField("_row_id").alias("_main_row"))
    # what only line 5 needs travels as one column, null elsewhere
    own5 = _when(ln == 5, F.struct("l_extendedprice", "_row_id")).alias("_okved")
    lp = with_pages(li.select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
                              F.year("l_shipdate").cast("bigint").alias("_ship_year"), own5, "_row_id"),
                    "l_suppkey", counts, page_size=page_size, shared=shared).drop("_row_id")
    own_price, own_id = (F.col("_okved").getField(c).alias(c) for c in ("l_extendedprice", "_row_id"))
    ls, rf = F.col("l_linestatus"), F.col("l_returnflag")
    li3 = F.struct("l_orderkey", "l_partkey", "l_quantity")
    founder = _kind(FOUNDER_KINDS, F.pmod(F.col("l_partkey"), F.lit(len(FOUNDER_KINDS))))
    subdiv = F.when(ls == "F", F.lit(SUBDIV_KINDS[0])).when(ls == "O", F.lit(SUBDIV_KINDS[1]))
    flat = lp.groupBy("l_suppkey", "page").agg(
        sorted_list(_when((ln == 1) & (ls == "F"), li3)).alias("ulstatus"),
        sorted_list(_when((ln == 2) & (ls == "F"), li3)).alias("ulpolnom"),
        sorted_list(_when((ln == 2) & (ls == "O"), li3)).alias("uluprorg"),
        sorted_list(_when((ln == 3) & (ls == "F"), li3)).alias("ul_dover"),
        sorted_list(_when((ln == 3) & (ls == "O"), li3)).alias("ul_korp_contr"),
        sorted_list(_when(ln == 4, F.struct(founder.alias("kind"), "l_orderkey", "l_partkey", "l_quantity"))
                    ).alias("uluch"),
        F.max(_when(ln == 5, F.struct(own_price, "l_orderkey", "l_partkey", "l_quantity", own_id))).alias("_best"),
        F.max("_main_row").alias("_main_row"),
        F.collect_list(_when(ln == 5, F.struct("l_orderkey", "l_partkey", own_id))).alias("_ln5"),
        sorted_list(_when((ln == 7) & subdiv.isNotNull(),
                          F.struct(subdiv.alias("kind"), "l_orderkey", "l_partkey", "l_quantity"))).alias("subdiv"),
        sorted_list(_when((ln == 5) & (rf == "R"), li3)).alias("pravopred"),
        sorted_list(_when((ln == 5) & (rf == "A"), li3)).alias("ulpreemnik"),
    ).withColumn("ulokved", _main_extra("egrul", "ulokved", extra=_extras("_ln5", "l_orderkey", "l_partkey")))

    # the same distributed page rows feed the flat arrays and the nested ones: one shuffle
    nested = nest_many(lp, ["l_suppkey", "page"], [
        NestSpec("ullicenses", ln == 6, [("l_orderkey", F.col("l_orderkey"))], F.struct("l_partkey", "l_quantity")),
        NestSpec("ulreorg", ln == 7, [("l_returnflag", F.col("l_returnflag"))], F.struct("l_orderkey", "l_partkey")),
        NestSpec("ulegrul", ln == 1, [("ship_year", F.col("_ship_year"))],
                 F.struct("l_orderkey", "l_partkey")),
    ])

    schema = schema_of("egrul")
    parts = [head] + [p.withColumnRenamed("l_suppkey", "entity_id") for p in (flat, nested)]
    return union_all([conform(p, schema) for p in parts])


MAIN_BUILDERS = {"egrip": person_main, "egrul": org_main}


def build_main(spark: SparkSession, sf_dir: str, registry: str, page_size: int = PAGE_SIZE, shared: bool = True) -> DataFrame:
    """``shared``: the whole table is wanted, so line items are shuffled once for all elements. Off, each branch shuffles only
    the columns that a query of single elements reads."""
    return MAIN_BUILDERS[registry](spark, sf_dir, page_size, shared)
