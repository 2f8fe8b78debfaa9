"""File-name column functions (C1-C3, C9, C11, C13). All are built-in expressions (codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source's file naming.
XML_EXT = ".XML"          # upper case, matched case-sensitively
PARQUET_EXT = ".parquet"
DROP_NAME_FORMAT = "yyyy-MM-dd_HH-mm-ss"   # publish drop files, second resolution


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_stem(name) -> Column:
    """Text before the first ``.XML`` (case-sensitive); the whole name if there is none."""
    return F.split(_c(name), r"\.XML", 2).getItem(0)


def register_token(registry) -> Column:
    """The register name as it appears in file names (upper case)."""
    return F.upper(_c(registry))


def part_name(table, stem, registry) -> Column:
    """Detail part name: table + the text after the last register token of the main file stem."""
    s = F.split(_c(stem), F.concat(F.lit(r"\Q"), register_token(registry), F.lit(r"\E")))
    return F.concat(_c(table), F.element_at(s, -1))


def date_key(name) -> Column:
    """The second-to-last ``_`` token of a part name (its date); null for a name without one."""
    return F.try_element_at(F.split(_c(name), "_"), F.lit(-2))


def slice_name(table, load_date) -> Column:
    """C11: ``<table>_<date>``, the name of a merged date slice."""
    return F.concat_ws("_", _c(table), _c(load_date).cast("string"))


def drop_name(run_ts, seq) -> Column:
    """A drop file name from the run time plus a per-run sequence in seconds.

    The source names drop files by the current second and sleeps a second between files; here
    the n-th file of a run gets run time + n seconds, so names stay unique without waiting.
    """
    ts = F.timestamp_add("SECOND", _c(seq), _c(run_ts))
    return F.concat(F.date_format(ts, DROP_NAME_FORMAT), F.lit(PARQUET_EXT))
