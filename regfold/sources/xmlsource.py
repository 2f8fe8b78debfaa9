"""S8 (XML -> nested main table) and the corrupt-row split of N3.

All files of a drop are one read with an explicit schema (never inferred): every leaf is a
string (D1), and the detail specs ``try_cast`` them. The XML source parses a file in one task
(``multiLine`` must stay on: line mode loses records), so parallelism comes from the number of
files. A record that fails to parse lands in ``_corrupt_record``; the other records of the file
stay (a truncated tail costs one row; broken markup inside a file costs the rest of that file, so archives' entries
are checked record by record on their way out, see ``records``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_TAG = "Entity"
ROOT_TAG = "Entities"
CORRUPT = "_corrupt_record"


def string_schema(dt: T.DataType) -> T.DataType:
    """The same nesting with every leaf a string: how the XML is read."""
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, string_schema(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(string_schema(dt.elementType), True)
    return T.StringType()


def write_xml(df: DataFrame, path: str, row_tag: str = ROW_TAG, root_tag: str = ROOT_TAG,
              partition_by: tuple[str, ...] = (), compression: str = "none") -> None:
    """``compression`` as of Spark's text files (``gzip``: ``read_xml`` unpacks while it parses; a file is one task either way)."""
    w = df.write.mode("overwrite").format("xml").option("rowTag", row_tag).option("rootTag", root_tag).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_xml(spark: SparkSession, path: str, schema: T.StructType, row_tag: str = ROW_TAG,
             glob: str | None = None, corrupt: bool = False, charset: str | None = None,
             path_col: str | None = None) -> DataFrame:
    """One read of every XML file under ``path`` with an explicit schema, plus ``src_file`` (and the whole path as ``path_col``).

    ``corrupt=True`` adds ``_corrupt_record`` (PERMISSIVE); otherwise malformed records fail the
    job (FAILFAST), so bad input is never silently dropped.
    """
    if corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    r = (spark.read.schema(schema).format("xml").option("rowTag", row_tag)
         .option("mode", "PERMISSIVE" if corrupt else "FAILFAST"))
    if corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if charset:
        r = r.option("charset", charset)
    out = r.load(path).withColumn("src_file", F.col("_metadata.file_name"))
    return out.withColumn(path_col, F.col("_metadata.file_path")) if path_col else out


def bad_values(df: DataFrame, typed: T.StructType) -> F.Column:
    """Names of the top-level leaves of ``typed`` whose string value does not cast (array<string>).

    Types are checked after the read, never inside it: a record that fails typing in the XML
    reader is reported with the text of its whole file, which a large file cannot afford.
    """
    checks = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name))
              for f in typed.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.StringType))]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def split_errors(df: DataFrame, typed: T.StructType | None = None,
                 corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows); good + bad = all.

    Bad: broken markup (``_corrupt_record``, one row per damaged file) or, with ``typed``, a
    value that does not cast; bad rows keep ``bad_fields`` and the file they came from. Good
    rows are cast to ``typed``. Spark refuses a query on raw XML whose only data column is the
    corrupt one (e.g. counting bad rows): stage the parsed table first, as ``daily_run`` does.
    """
    has_corrupt = corrupt_col in df.columns
    fields = bad_values(df, typed) if typed is not None else F.array().cast("array<string>")
    marked = df.withColumn("bad_fields", fields)
    bad = F.size("bad_fields") > 0
    if has_corrupt:
        bad = bad | F.col(corrupt_col).isNotNull()
    good = marked.where(~bad).drop("bad_fields", *([corrupt_col] if has_corrupt else []))
    if typed is not None:
        names = set(typed.fieldNames())
        good = good.select(*[F.col(c).try_cast(typed[c].dataType).alias(c) if c in names else F.col(c)
                             for c in good.columns])
    return good, marked.where(bad)
