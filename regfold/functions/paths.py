"""Path, link and routing column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Remote directory per (register, schema version) and the URL tokens of each
# register, as the source lists them.
REMOTE_DIRS = (
    ("egrul", "new", "?dir=EGRUL_406"),
    ("egrul", "old", "?dir=EGRUL"),
    ("egrip", "new", "?dir=EGRIP_405"),
    ("egrip", "old", "?dir=EGRIP"),
)
URL_TOKENS = (("EGRUL", "egrul"), ("EGRIP", "egrip"))
DEFAULT_REGISTRY = "egrul"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def base_name(path) -> Column:
    """Last ``/`` segment of a path or link."""
    return F.element_at(F.split(_c(path), "/"), -1)


def join_path(*parts) -> Column:
    """Join path or URL parts with ``/``."""
    return F.concat_ws("/", *[_c(p) for p in parts])


def remote_dir(registry, schema_version) -> Column:
    """S1 as an expression: (register, schema version) -> remote directory."""
    out = None
    for reg, ver, d in REMOTE_DIRS:
        cond = (_c(registry) == reg) & (_c(schema_version) == ver)
        out = F.when(cond, F.lit(d)) if out is None else out.when(cond, F.lit(d))
    return out


def route_table(spark: SparkSession) -> DataFrame:
    """S1 as a 4-row lookup table, for a join (Spark broadcasts it: its size is fixed)."""
    return spark.createDataFrame(list(REMOTE_DIRS), "registry STRING, schema_version STRING, remote_dir STRING")


def registry_of_url(url) -> Column:
    """Which register a URL belongs to, by substring; the legal-entity one by default."""
    out = None
    for token, reg in URL_TOKENS:
        cond = _c(url).contains(token)
        out = F.when(cond, F.lit(reg)) if out is None else out.when(cond, F.lit(reg))
    return out.otherwise(F.lit(DEFAULT_REGISTRY))
