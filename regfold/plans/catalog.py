"""Query keys -> Spark callables ``(spark, sf_dir) -> DataFrame`` and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regfold.operators.shapes import fan_out_counts, project
from regfold.plans import oracle
from regfold.plans.specs import REGISTRIES, SPECS, TableSpec
from regfold.session import apply_runtime_conf
from regfold.sources.fixtures import build_main

Query = Callable[[SparkSession, str], DataFrame]


def _table_query(spec: TableSpec) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_runtime_conf(spark)
        return project(build_main(spark, sf_dir, spec.registry, shared=False), spec)

    run.__name__ = spec.key
    run.__doc__ = f"{spec.shape}-shape detail table {spec.name} of register {spec.registry}"
    return run


def q_fan_out_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P0 over all 50 specs: rows per detail table, one pass per main table."""
    apply_runtime_conf(spark)
    return fan_out_counts({r: build_main(spark, sf_dir, r, shared=False) for r in REGISTRIES})


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {s.key: _table_query(s) for s in SPECS}
    out["fan_out_counts"] = q_fan_out_counts
    from regfold.plans import extra_queries

    out.update(extra_queries.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out = dict(oracle.TABLE_SQL)
    out["fan_out_counts"] = oracle.fan_out_counts_sql()
    from regfold.plans import extra_queries

    out.update(extra_queries.ORACLE)
    return out
