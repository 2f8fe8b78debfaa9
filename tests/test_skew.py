"""A hot key and a block of copies: pages stay bounded and results stay whole."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, digest
from regfold.operators.shapes import project
from regfold.plans.specs import SPEC_BY_NAME
from regfold.sources.fixtures import build_main

PAGE = 64


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """The small tables, with a third of all line items moved to supplier 1 and 500 copies of
    one line item added (also supplier 1), written as a test data folder."""
    d = tmp_path_factory.mktemp("skewed")
    for t in ("supplier", "nation", "region", "customer", "orders"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(d / f"{t}.parquet"))
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = li.withColumn("l_suppkey", F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(1)).otherwise(F.col("l_suppkey")))
    one = hot.where("l_suppkey = 1").limit(1)
    copies = one.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("_copy")
    hot.unionByName(copies).repartition(4).write.parquet(str(d / "lineitem.parquet"))
    return str(d)


def test_hot_key_pages_are_bounded(spark, skewed_dir):
    main = build_main(spark, skewed_dir, "egrul", page_size=PAGE)
    per_page = main.where("page > 0").select(
        "entity_id", "page", F.coalesce(F.size("ulokved.extra"), F.lit(0)).alias("n5"),
        (F.coalesce(F.size("ulstatus"), F.lit(0)) + F.coalesce(F.size("ulpolnom"), F.lit(0))
         + F.coalesce(F.size("uluprorg"), F.lit(0)) + F.coalesce(F.size("uluch"), F.lit(0))).alias("n"))
    hot = per_page.where("entity_id = 1")
    n_lines = spark.read.parquet(f"{skewed_dir}/lineitem.parquet").where("l_suppkey = 1").count()
    assert hot.select("page").distinct().count() >= n_lines // PAGE  # the hot key is spread
    assert per_page.agg(F.max("n")).first()[0] <= 3 * PAGE        # no page grows with the key


def test_hot_key_results_are_whole(spark, skewed_dir, duck):
    con = duck(SF_SMALL)
    con.execute(f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM read_parquet('{skewed_dir}/lineitem.parquet/*.parquet')")
    import __spark_entry__ as E

    for key in ("tbl_ulstatus_info", "tbl_ulokved_info", "tbl_ulreorg_info", "tbl_ulustcap_info", "tbl_uluch_sub_info"):
        spec = SPEC_BY_NAME[key[4:]]
        got = project(build_main(spark, skewed_dir, "egrul", page_size=PAGE), spec).toPandas()
        want = con.execute(E.oracle_sql()[key]).df()
        assert digest(got) == digest(want), key


def test_hot_key_meets_its_count_in_many_tasks(spark, skewed_dir):
    """With broadcasts off, the join of children to counts spreads a key over the salts."""
    from regfold.operators.nest import SALTS, with_pages

    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        li = spark.read.parquet(f"{skewed_dir}/lineitem.parquet").select(
            "l_suppkey", F.monotonically_increasing_id().alias("_row_id"))
        counts = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("_n"))
        paged = with_pages(li, "l_suppkey", counts, page_size=PAGE)
        plan = paged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [l_suppkey" in plan and "_salt" in plan.split("SortMergeJoin")[1].splitlines()[0]
        assert paged.count() == li.count() and SALTS > 8
        assert paged.where("l_suppkey = 1").select("page").distinct().count() > 20
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_children_are_shuffled_once(spark, skewed_dir):
    """Only the counts of entities of several pages are sent about; the children meet them where they lie."""
    from regfold.operators.nest import with_pages

    li = spark.read.parquet(f"{skewed_dir}/lineitem.parquet").select("l_suppkey", F.monotonically_increasing_id().alias("_row_id"))
    li = li.unionByName(spark.createDataFrame([(None, 1)], "l_suppkey BIGINT, _row_id BIGINT"))
    counts = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("_n"))
    paged = with_pages(li, "l_suppkey", counts, page_size=8 * PAGE)
    plan = paged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "_salt" not in plan
    assert paged.columns == ["l_suppkey", "_row_id", "page"] and paged.count() == li.count() - 1
    n_pages = {r["l_suppkey"]: -(-r["_n"] // (8 * PAGE)) for r in counts.where("l_suppkey is not null").collect()}
    found = {r["l_suppkey"]: r["p"] for r in paged.groupBy("l_suppkey").agg(F.max("page").alias("p")).collect()}
    assert found == n_pages and max(n_pages.values()) > 4 and min(n_pages.values()) == 1
