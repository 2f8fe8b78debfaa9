"""Flat ANSI SQL for every query key, run by DuckDB on the same Parquet tables.

These share no code with the Spark side: each ``tbl_*`` statement is the flat rule of FIXTURES.md
section 4, while Spark goes through the nested main table. Column names and types are aligned
(counts and years as BIGINT, every computed column aliased).
"""

from __future__ import annotations

_C = "customer"
_LI3 = "l_orderkey, l_partkey, l_quantity"


def _li(where: str, cols: str = _LI3) -> str:
    return f"SELECT l_suppkey AS entity_id, {cols} FROM lineitem WHERE {where}"


FOUNDER_SQL = {k: i for i, k in enumerate(("ru", "in", "fl", "sub", "pif", "doginv"))}

TABLE_SQL: dict[str, str] = {
    # entrepreneur register
    "tbl_ip_info": f"SELECT c_custkey AS entity_id, c_name, c_mktsegment FROM {_C}",
    "tbl_fl_info": f"SELECT c_custkey AS entity_id, c_name, c_acctbal FROM {_C} WHERE c_acctbal >= 0",
    "tbl_citizenship_info": (
        f"SELECT c_custkey AS entity_id, n_name, r_name FROM {_C} "
        "JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"),
    "tbl_regip_info": (
        f"SELECT c_custkey AS entity_id, min(o_orderdate) AS first_date, count(*) AS n_items "
        f"FROM {_C} JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"),
    "tbl_regorg_info": (
        f"SELECT c_custkey AS entity_id, n_nationkey, n_name FROM {_C} JOIN nation ON c_nationkey = n_nationkey"),
    "tbl_status_info": "SELECT o_custkey AS entity_id, o_orderkey, o_orderstatus, o_orderdate FROM orders",
    "tbl_stop_info": (
        "SELECT o_custkey AS entity_id, max(o_orderdate) AS last_date FROM orders "
        "WHERE o_orderstatus = 'F' GROUP BY o_custkey"),
    "tbl_uchetno_info": f"SELECT c_custkey AS entity_id, c_nationkey, c_mktsegment FROM {_C}",
    "tbl_regpf_info": (
        "SELECT o_custkey AS entity_id, min(o_orderdate) AS first_date FROM orders "
        "WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey"),
    "tbl_regfss_info": (
        "SELECT o_custkey AS entity_id, min(o_orderdate) AS first_date FROM orders "
        "WHERE o_orderpriority = '2-HIGH' GROUP BY o_custkey"),
    "tbl_okved_info": (
        "SELECT o_custkey AS entity_id, o_orderkey, "
        "row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1 AS is_main "
        "FROM orders"),
    "tbl_lic_info": (
        "SELECT o_custkey AS entity_id, o_orderkey, l_linenumber, l_partkey FROM orders "
        "JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'"),
    "tbl_noteegrip_info": (
        "SELECT o_custkey AS entity_id, o_orderkey, l_linenumber, l_returnflag, l_shipdate FROM orders "
        "JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'"),
    "tbl_fiozags_info": f"SELECT c_custkey AS entity_id, upper(c_name) AS name_upper FROM {_C} WHERE c_acctbal < 0",
    "tbl_adremail_info": (
        f"SELECT c_custkey AS entity_id, replace(c_name, '#', '.') || '@example.com' AS email "
        f"FROM {_C} WHERE c_mktsegment = 'BUILDING'"),
    # legal-entity register
    "tbl_ul_info": "SELECT s_suppkey AS entity_id, s_name, s_acctbal FROM supplier",
    "tbl_ul_name": "SELECT s_suppkey AS entity_id, s_name, upper(s_name) AS name_upper FROM supplier",
    "tbl_ul_adress": (
        "SELECT s_suppkey AS entity_id, n_name, r_name FROM supplier "
        "JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"),
    "tbl_ulemail_info": (
        "SELECT s_suppkey AS entity_id, replace(s_name, '#', '.') || '@example.com' AS email "
        "FROM supplier WHERE s_acctbal > 5000"),
    "tbl_ulreg_info": (
        "SELECT s_suppkey AS entity_id, min(l_shipdate) AS first_date "
        "FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey"),
    "tbl_ulregorg_info": (
        "SELECT s_suppkey AS entity_id, n_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
    "tbl_ulstatus_info": _li("l_linenumber = 1 AND l_linestatus = 'F'"),
    "tbl_ulstop_info": (
        "SELECT l_suppkey AS entity_id, max(l_shipdate) AS last_date FROM lineitem "
        "WHERE l_returnflag = 'R' AND l_quantity = 50 GROUP BY l_suppkey"),
    "tbl_ulrules_info": "SELECT s_suppkey AS entity_id, s_acctbal FROM supplier WHERE s_acctbal < 4000",
    "tbl_ulnouch_info": "SELECT s_suppkey AS entity_id, s_nationkey FROM supplier",
    "tbl_ulpfreg_info": (
        "SELECT l_suppkey AS entity_id, min(l_shipdate) AS first_date FROM lineitem "
        "WHERE l_linenumber = 1 GROUP BY l_suppkey"),
    "tbl_ulfssreg_info": (
        "SELECT l_suppkey AS entity_id, min(l_shipdate) AS first_date FROM lineitem "
        "WHERE l_linenumber = 2 GROUP BY l_suppkey"),
    "tbl_ulustcap_info": (
        "SELECT s_suppkey AS entity_id, count(*) AS n_items "
        "FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY s_suppkey"),
    "tbl_ulpolnom_info": _li("l_linenumber = 2 AND l_linestatus = 'F'"),
    "tbl_uluprorg_info": _li("l_linenumber = 2 AND l_linestatus = 'O'"),
    "tbl_ul_dover_info": _li("l_linenumber = 3 AND l_linestatus = 'F'"),
    "tbl_ul_korp_contr_info": _li("l_linenumber = 3 AND l_linestatus = 'O'"),
    **{f"tbl_uluch_{k}_info": _li(f"l_linenumber = 4 AND l_partkey % 6 = {i}") for k, i in FOUNDER_SQL.items()},
    "tbl_ulustcapdol_info": (
        "SELECT l_suppkey AS entity_id, max(l_quantity) AS max_quantity FROM lineitem "
        "WHERE l_linenumber = 4 GROUP BY l_suppkey"),
    "tbl_ulacsderg_info": (
        "SELECT s_suppkey AS entity_id, n_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
    "tbl_ulokved_info": (
        "SELECT l_suppkey AS entity_id, l_orderkey, l_partkey, "
        "row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey DESC, "
        "l_partkey DESC, l_quantity DESC) = 1 AS is_main FROM lineitem WHERE l_linenumber = 5"),
    "tbl_ullicenses_info": _li("l_linenumber = 6"),
    "tbl_ulfilial_info": _li("l_linenumber = 7 AND l_linestatus = 'F'"),
    "tbl_ulrepresent_info": _li("l_linenumber = 7 AND l_linestatus = 'O'"),
    "tbl_ulreorg_info": _li("l_linenumber = 7", "l_returnflag, l_orderkey, l_partkey"),
    "tbl_pravopred_info": _li("l_linenumber = 5 AND l_returnflag = 'R'"),
    "tbl_krestxoz": "SELECT s_suppkey AS entity_id, s_name FROM supplier WHERE s_suppkey % 10 = 0",
    "tbl_ulpreemnik_info": _li("l_linenumber = 5 AND l_returnflag = 'A'"),
    "tbl_ulkvhp": "SELECT s_suppkey AS entity_id, s_name FROM supplier WHERE s_suppkey % 10 = 5",
    "tbl_ulegrul_info": _li("l_linenumber = 1", "CAST(year(l_shipdate) AS BIGINT) AS ship_year, l_orderkey, l_partkey"),
}


def fan_out_counts_sql() -> str:
    """50 x count(*) of the flat rules, as (registry, table_name, n_rows)."""
    from regfold.plans.specs import SPECS

    parts = [f"SELECT '{s.registry}' AS registry, '{s.name}' AS table_name, "
             f"CAST(count(*) AS BIGINT) AS n_rows FROM ({TABLE_SQL[s.key]}) t" for s in SPECS]
    return "\nUNION ALL\n".join(parts)
