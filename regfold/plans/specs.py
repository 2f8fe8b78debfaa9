"""The 50 detail tables as data (P1-P50), and the typed document schema of each register.

A detail table is a ``TableSpec``: which element of the main table it reads, in which shape, and
which fields. There is one generic operator per shape (``regfold.operators.shapes``); adding a
table is adding a line here, never code. Column types are taken from the register's typed
document schema, so XML read as strings is cast to the same types as the typed fixture.

The element layout is our own design (FIXTURES.md section 3): the reference does not publish
its schemas. A real feed needs new schema strings and specs, no new code.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import types as T

# Register names and schema versions (fixed values of the source).
REGISTRIES = ("egrip", "egrul")
SCHEMA_VERSIONS = ("new", "old")

# Shapes: S root, O optional struct, N array, NN array of groups holding arrays,
# M one main element plus extras, P one array shared by several tables, told apart by `kind`.
SHAPES = ("S", "O", "N", "NN", "M", "P")

# Columns added to every detail table when the main table came from files.
PROVENANCE = ("registry", "schema_version", "load_date", "is_full", "part", "src_file", "entry_id")

# Typed document schema of the entrepreneur register (one row per entity page).
PERSON_DDL = """
entity_id BIGINT, page INT, c_name STRING, c_mktsegment STRING,
fl STRUCT<c_name: STRING, c_acctbal: DOUBLE>,
citizenship STRUCT<n_name: STRING, r_name: STRING>,
regip STRUCT<first_date: TIMESTAMP_NTZ, n_items: BIGINT>,
regorg STRUCT<n_nationkey: INT, n_name: STRING>,
status ARRAY<STRUCT<o_orderkey: BIGINT, o_orderstatus: STRING, o_orderdate: TIMESTAMP_NTZ>>,
stop STRUCT<last_date: TIMESTAMP_NTZ>,
uchetno STRUCT<c_nationkey: INT, c_mktsegment: STRING>,
regpf STRUCT<first_date: TIMESTAMP_NTZ>,
regfss STRUCT<first_date: TIMESTAMP_NTZ>,
okved STRUCT<main: STRUCT<o_orderkey: BIGINT>, extra: ARRAY<STRUCT<o_orderkey: BIGINT>>>,
lic ARRAY<STRUCT<o_orderkey: BIGINT, rows: ARRAY<STRUCT<l_linenumber: INT, l_partkey: BIGINT>>>>,
noteegrip ARRAY<STRUCT<o_orderkey: BIGINT,
    rows: ARRAY<STRUCT<l_linenumber: INT, l_returnflag: STRING, l_shipdate: TIMESTAMP_NTZ>>>>,
fiozags STRUCT<name_upper: STRING>,
adremail STRUCT<email: STRING>
"""

_LI3 = "STRUCT<l_orderkey: BIGINT, l_partkey: BIGINT, l_quantity: DOUBLE>"

# Typed document schema of the legal-entity register.
ORG_DDL = f"""
entity_id BIGINT, page INT, s_name STRING, s_acctbal DOUBLE,
ul_name STRUCT<s_name: STRING, name_upper: STRING>,
ul_adress STRUCT<n_name: STRING, r_name: STRING>,
ulemail STRUCT<email: STRING>,
ulreg STRUCT<first_date: TIMESTAMP_NTZ>,
ulregorg STRUCT<n_nationkey: INT, n_name: STRING>,
ulstatus ARRAY<{_LI3}>,
ulstop STRUCT<last_date: TIMESTAMP_NTZ>,
ulrules STRUCT<s_acctbal: DOUBLE>,
ulnouch STRUCT<s_nationkey: INT>,
ulpfreg STRUCT<first_date: TIMESTAMP_NTZ>,
ulfssreg STRUCT<first_date: TIMESTAMP_NTZ>,
ulustcap STRUCT<n_items: BIGINT>,
ulpolnom ARRAY<{_LI3}>,
uluprorg ARRAY<{_LI3}>,
ul_dover ARRAY<{_LI3}>,
ul_korp_contr ARRAY<{_LI3}>,
uluch ARRAY<STRUCT<kind: STRING, l_orderkey: BIGINT, l_partkey: BIGINT, l_quantity: DOUBLE>>,
ulustcapdol STRUCT<max_quantity: DOUBLE>,
ulacsderg STRUCT<n_name: STRING, n_regionkey: INT>,
ulokved STRUCT<main: STRUCT<l_orderkey: BIGINT, l_partkey: BIGINT>,
    extra: ARRAY<STRUCT<l_orderkey: BIGINT, l_partkey: BIGINT>>>,
ullicenses ARRAY<STRUCT<l_orderkey: BIGINT, rows: ARRAY<STRUCT<l_partkey: BIGINT, l_quantity: DOUBLE>>>>,
subdiv ARRAY<STRUCT<kind: STRING, l_orderkey: BIGINT, l_partkey: BIGINT, l_quantity: DOUBLE>>,
ulreorg ARRAY<STRUCT<l_returnflag: STRING, rows: ARRAY<STRUCT<l_orderkey: BIGINT, l_partkey: BIGINT>>>>,
pravopred ARRAY<{_LI3}>,
krestxoz STRUCT<s_name: STRING>,
ulpreemnik ARRAY<{_LI3}>,
ulkvhp STRUCT<s_name: STRING>,
ulegrul ARRAY<STRUCT<ship_year: BIGINT, rows: ARRAY<STRUCT<l_orderkey: BIGINT, l_partkey: BIGINT>>>>
"""

DDL = {"egrip": PERSON_DDL, "egrul": ORG_DDL}


@lru_cache(maxsize=None)
def schema_of(registry: str) -> T.StructType:
    """Typed document schema of a register (parsed once; needs a running session)."""
    return T.StructType.fromDDL(" ".join(DDL[registry].split()))

# Founder kinds (element `uluch`) and subdivision kinds (element `subdiv`): fixed values.
FOUNDER_KINDS = ("ru", "in", "fl", "sub", "pif", "doginv")
SUBDIV_KINDS = ("filial", "represent")


@dataclass(frozen=True)
class TableSpec:
    """One detail table: ``project(main, spec)`` gives it.

    name     table name, also the query key ``tbl_<name>``
    registry which main table it reads
    shape    one of SHAPES
    element  element of the main table (None for S)
    fields   output fields: root columns (S), struct fields (O), array element fields (N, P),
             inner row fields (NN), main/extra fields (M)
    group    NN only: fields of the outer element, output before ``fields``
    kind     P only: value of the element's ``kind`` field
    rare     O*: the element is mostly absent (documentation only)
    keep_missing  D2: an entity without the element still gives one row, its fields null
    """

    name: str
    registry: str
    shape: str
    element: str | None
    fields: tuple[str, ...]
    group: tuple[str, ...] = field(default=())
    kind: str | None = None
    rare: bool = False
    keep_missing: bool = False

    @property
    def key(self) -> str:
        return f"tbl_{self.name}"


def _s(name, reg, fields):
    return TableSpec(name, reg, "S", None, tuple(fields))


def _o(name, reg, el, fields, rare=False):
    return TableSpec(name, reg, "O", el, tuple(fields), rare=rare)


def _n(name, reg, el, fields):
    return TableSpec(name, reg, "N", el, tuple(fields))


def _nn(name, reg, el, group, fields):
    return TableSpec(name, reg, "NN", el, tuple(fields), group=tuple(group))


def _m(name, reg, el, fields):
    return TableSpec(name, reg, "M", el, tuple(fields))


def _p(name, reg, el, kind, fields):
    return TableSpec(name, reg, "P", el, tuple(fields), kind=kind)


_LI = ("l_orderkey", "l_partkey", "l_quantity")

# Table names of both registers are fixed values of the source (15 + 35).
SPECS: tuple[TableSpec, ...] = (
    # entrepreneur register
    _s("ip_info", "egrip", ["c_name", "c_mktsegment"]),
    _o("fl_info", "egrip", "fl", ["c_name", "c_acctbal"]),
    _o("citizenship_info", "egrip", "citizenship", ["n_name", "r_name"]),
    _o("regip_info", "egrip", "regip", ["first_date", "n_items"]),
    _o("regorg_info", "egrip", "regorg", ["n_nationkey", "n_name"]),
    _n("status_info", "egrip", "status", ["o_orderkey", "o_orderstatus", "o_orderdate"]),
    _o("stop_info", "egrip", "stop", ["last_date"], rare=True),
    _o("uchetno_info", "egrip", "uchetno", ["c_nationkey", "c_mktsegment"]),
    _o("regpf_info", "egrip", "regpf", ["first_date"], rare=True),
    _o("regfss_info", "egrip", "regfss", ["first_date"], rare=True),
    _m("okved_info", "egrip", "okved", ["o_orderkey"]),
    _nn("lic_info", "egrip", "lic", ["o_orderkey"], ["l_linenumber", "l_partkey"]),
    _nn("noteegrip_info", "egrip", "noteegrip", ["o_orderkey"],
        ["l_linenumber", "l_returnflag", "l_shipdate"]),
    _o("fiozags_info", "egrip", "fiozags", ["name_upper"], rare=True),
    _o("adremail_info", "egrip", "adremail", ["email"], rare=True),
    # legal-entity register
    _s("ul_info", "egrul", ["s_name", "s_acctbal"]),
    _o("ul_name", "egrul", "ul_name", ["s_name", "name_upper"]),
    _o("ul_adress", "egrul", "ul_adress", ["n_name", "r_name"]),
    _o("ulemail_info", "egrul", "ulemail", ["email"], rare=True),
    _o("ulreg_info", "egrul", "ulreg", ["first_date"]),
    _o("ulregorg_info", "egrul", "ulregorg", ["n_nationkey", "n_name"]),
    _n("ulstatus_info", "egrul", "ulstatus", _LI),
    _o("ulstop_info", "egrul", "ulstop", ["last_date"], rare=True),
    _o("ulrules_info", "egrul", "ulrules", ["s_acctbal"], rare=True),
    _o("ulnouch_info", "egrul", "ulnouch", ["s_nationkey"]),
    _o("ulpfreg_info", "egrul", "ulpfreg", ["first_date"]),
    _o("ulfssreg_info", "egrul", "ulfssreg", ["first_date"]),
    _o("ulustcap_info", "egrul", "ulustcap", ["n_items"]),
    _n("ulpolnom_info", "egrul", "ulpolnom", _LI),
    _n("uluprorg_info", "egrul", "uluprorg", _LI),
    _n("ul_dover_info", "egrul", "ul_dover", _LI),
    _n("ul_korp_contr_info", "egrul", "ul_korp_contr", _LI),
    _p("uluch_ru_info", "egrul", "uluch", "ru", _LI),
    _p("uluch_in_info", "egrul", "uluch", "in", _LI),
    _p("uluch_fl_info", "egrul", "uluch", "fl", _LI),
    _p("uluch_sub_info", "egrul", "uluch", "sub", _LI),
    _p("uluch_pif_info", "egrul", "uluch", "pif", _LI),
    _p("uluch_doginv_info", "egrul", "uluch", "doginv", _LI),
    _o("ulustcapdol_info", "egrul", "ulustcapdol", ["max_quantity"]),
    _o("ulacsderg_info", "egrul", "ulacsderg", ["n_name", "n_regionkey"]),
    _m("ulokved_info", "egrul", "ulokved", ["l_orderkey", "l_partkey"]),
    _nn("ullicenses_info", "egrul", "ullicenses", ["l_orderkey"], ["l_partkey", "l_quantity"]),
    _p("ulfilial_info", "egrul", "subdiv", "filial", _LI),
    _p("ulrepresent_info", "egrul", "subdiv", "represent", _LI),
    _nn("ulreorg_info", "egrul", "ulreorg", ["l_returnflag"], ["l_orderkey", "l_partkey"]),
    _n("pravopred_info", "egrul", "pravopred", _LI),
    _o("krestxoz", "egrul", "krestxoz", ["s_name"], rare=True),
    _n("ulpreemnik_info", "egrul", "ulpreemnik", _LI),
    _o("ulkvhp", "egrul", "ulkvhp", ["s_name"], rare=True),
    _nn("ulegrul_info", "egrul", "ulegrul", ["ship_year"], ["l_orderkey", "l_partkey"]),
)

SPEC_BY_NAME = {s.name: s for s in SPECS}


def specs_for(registry: str) -> tuple[TableSpec, ...]:
    return tuple(s for s in SPECS if s.registry == registry)


def field_type(registry: str, spec: TableSpec, name: str, level: str = "leaf") -> T.DataType:
    """Type of one output field, looked up in the register's typed schema."""
    schema = schema_of(registry)
    if spec.shape == "S":
        return schema[name].dataType
    el = schema[spec.element].dataType
    if spec.shape == "O":
        return el[name].dataType
    if spec.shape in ("N", "P"):
        return el.elementType[name].dataType
    if spec.shape == "NN":
        outer = el.elementType
        if level == "group":
            return outer[name].dataType
        return outer["rows"].dataType.elementType[name].dataType
    if spec.shape == "M":
        return el["main"].dataType[name].dataType
    raise ValueError(spec.shape)
