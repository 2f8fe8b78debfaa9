
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, digest
from regfold.operators.shapes import fan_out_counts, project
from regfold.plans.specs import SPEC_BY_NAME, SPECS, specs_for
from regfold.sources.fixtures import build_main

# one table of every shape, both registers
SAMPLE = ["ip_info", "fl_info", "status_info", "okved_info", "lic_info", "noteegrip_info",
          "ul_info", "ulstop_info", "ulstatus_info", "uluch_ru_info", "ulokved_info", "ullicenses_info",
          "ulfilial_info", "ulreorg_info", "ulegrul_info"]


@pytest.mark.parametrize("name", SAMPLE)
def test_pages_do_not_change_rows(spark, name):
    """A main table cut into pages of 3 elements gives the same detail rows as one page each."""
    spec = SPEC_BY_NAME[name]
    whole = project(build_main(spark, SF_SMALL, spec.registry), spec).toPandas()
    paged = project(build_main(spark, SF_SMALL, spec.registry, page_size=3), spec).toPandas()
    assert digest(whole) == digest(paged)


def test_small_pages_bound_array_sizes(spark):
    main = build_main(spark, SF_SMALL, "egrul", page_size=5)
    big = main.select(F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in
                                   ("ulstatus", "uluch", "subdiv", "ullicenses", "ulreorg")]).alias("n")).agg(F.max("n"))
    # every page holds at most ~page_size children in expectation; hashing gives some spread
    assert big.first()[0] <= 5 * 4


def test_head_row_once_per_entity(spark):
    main = build_main(spark, SF_SMALL, "egrip", page_size=3)
    heads = main.where("page = 0").groupBy("entity_id").count()
    assert heads.where("count > 1").count() == 0
    assert heads.count() == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()


def test_variant_tables_add_up_to_their_array(spark):
    main = build_main(spark, SF_SMALL, "egrul")
    founders = [s for s in SPECS if s.element == "uluch"]
    total = sum(project(main, s).count() for s in founders)
    assert total == main.select(F.explode("uluch")).count()


def test_main_extra_one_main_per_entity(spark):
    for name in ("okved_info", "ulokved_info"):
        t = project(build_main(spark, SF_SMALL, SPEC_BY_NAME[name].registry, page_size=2), SPEC_BY_NAME[name])
        per = t.groupBy("entity_id").agg(F.sum(F.col("is_main").cast("int")).alias("m"))
        assert per.where("m <> 1").count() == 0


def test_fan_out_counts_equal_projection_counts(spark):
    mains = {r: build_main(spark, SF_SMALL, r) for r in ("egrip", "egrul")}
    counts = {r["table_name"]: r["n_rows"] for r in fan_out_counts(mains).collect()}
    for reg in ("egrip", "egrul"):
        for s in specs_for(reg)[:6]:
            assert counts[s.name] == project(mains[reg], s).count(), s.name


def test_single_table_plan_prunes_other_elements(spark):
    """A query on one array element keeps only the union branch that builds it."""
    plan = project(build_main(spark, SF_SMALL, "egrip"), SPEC_BY_NAME["status_info"])._jdf \
        .queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan


def test_projection_is_narrow(spark, tmp_path):
    """Over a staged main table a detail table is one scan + projection: no exchange."""
    build_main(spark, SF_SMALL, "egrul").write.parquet(str(tmp_path / "m"))
    main = spark.read.parquet(str(tmp_path / "m"))
    for name in ("ulreorg_info", "ulokved_info", "uluch_in_info", "ul_info"):
        plan = project(main, SPEC_BY_NAME[name])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name


@pytest.mark.parametrize("name", ["stop_info", "ulpolnom_info", "lic_info", "uluch_pif_info", "ulokved_info"])
def test_keep_missing_gives_one_null_row(spark, name):
    """With keep_missing every entity appears; those without the element once, with nulls."""
    from dataclasses import replace

    spec = SPEC_BY_NAME[name]
    main = build_main(spark, SF_SMALL, spec.registry, page_size=3)
    inner = project(main, spec)
    outer = project(main, replace(spec, keep_missing=True))
    n_entities = main.where("page = 0").count()
    have = inner.select("entity_id").distinct().count()
    assert outer.count() == inner.count() + (n_entities - have)
    assert outer.select("entity_id").distinct().count() == n_entities
    field = spec.fields[-1]
    assert outer.where(F.col(field).isNull()).count() >= n_entities - have
