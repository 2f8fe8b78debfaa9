"""Parts and schema versions of a table, united and grouped by load date.

The source groups part files by a date token of their names and merges each group into one
file. Here parts are rows: the date key is a column derived per row from its file name, and a
merge is one read (or ``unionByName``) over all parts, so no date is split or dropped, whatever
order the listing comes in. Nothing is deduplicated (D3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfold.functions.names import date_key, slice_name


def union_parts(parts: list[DataFrame], schema_versions: list[str] | None = None) -> DataFrame:
    """Union by column name; columns missing in a part are null. With ``schema_versions``
    each part is tagged, so old and new drops stay told apart after the union."""
    tagged = parts
    if schema_versions is not None:
        tagged = [p.withColumn("schema_version", F.lit(v)) for p, v in zip(parts, schema_versions)]
    out = tagged[0]
    for p in tagged[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def with_load_date(df: DataFrame, name_col: str = "src_file", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A1: the date key (second-to-last ``_`` token of the file name) as a DATE column."""
    key = date_key(F.regexp_replace(F.col(name_col), r"\.[^.]*$", ""))
    return df.withColumn("load_date", F.try_to_date(key, date_format))


def merge_by_date(df: DataFrame, table: str, part_col: str = "part") -> DataFrame:
    """A1 + U1 + C11: one row per date slice of ``table``: slice name, rows and parts merged.

    A grouped aggregate with partial aggregation: the shuffle carries one row per (task, date).
    """
    return (df.groupBy("load_date")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col(part_col)).alias("n_parts"))
            .select("load_date", slice_name(F.lit(table), F.col("load_date")).alias("slice_name"),
                    "n_rows", "n_parts"))
