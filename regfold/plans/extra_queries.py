"""

Every query reads the given tables whole. Queries that exercise files (archives, XML, streams,
publication) first write what Spark derived from the tables into a fresh folder under the shared
``spark.checkpoint.dir`` and then read it back, so the file operators run on real data volumes.
Dates leave as ``yyyy-MM-dd`` strings, so both engines hand over the same Python values.
"""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.functions.dates import is_new_year
from regfold.functions.names import date_key, file_stem, part_name
from regfold.functions.paths import registry_of_url, route_table
from regfold.operators.audit import failure_notices
from regfold.operators.merge import merge_by_date, union_parts, with_load_date
from regfold.operators.shapes import project
from regfold.plans import commits
from regfold.plans import publish as pub
from regfold.plans.fanout import stage
from regfold.plans.oracle import TABLE_SQL
from regfold.plans.specs import REGISTRIES, SPEC_BY_NAME, SPECS, schema_of
from regfold.session import apply_runtime_conf, frees_shuffles, staging_dir
from regfold.sources import archive, landing, xmlsource
from regfold.sources.files import delete_folder, filesystem_for
from regfold.sources.fixtures import build_main
from regfold.sources.records import CHUNK
from regfold.sources.tables import read_table
from regfold.streaming.intake import consume_once, read_sink

# Fixed parameters of the test queries (own values, not the source's).
BASE_URL = "https://registry.example"
RUN_TS = "2024-01-30 12:00:00"        # "now" of retention and the drop index
LOAD_DATE = "2024-01-30"
NEXT_DATE = "2024-01-31"
STATUS_TAGS = ("b", "h2", "footer", "em")
DROP_PREFIX = "DROP_"


def _ds(col) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd")


def _stage(spark: SparkSession, name: str) -> str:
    apply_runtime_conf(spark)
    return staging_dir(spark, name)


# --- S1, C10 ---------------------------------------------------------------------------------

def q_route_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    rows = (read_table(spark, sf_dir, "customer").select(F.lit("egrip").alias("registry"),
                                                         F.col("c_custkey").alias("entity_id"))
            .unionByName(read_table(spark, sf_dir, "supplier").select(F.lit("egrul").alias("registry"),
                                                                      F.col("s_suppkey").alias("entity_id"))))
    rows = rows.withColumn("schema_version",
                           F.when(F.pmod(F.col("entity_id"), F.lit(2)) == 0, "new").otherwise("old"))
    routed = rows.join(route_table(spark), ["registry", "schema_version"], "left")
    return routed.select("registry", "entity_id", "schema_version", "remote_dir",
                         registry_of_url(F.col("remote_dir")).alias("cert_registry"))


_ROUTE_SQL = """
SELECT registry, entity_id, schema_version, remote_dir,
       CASE WHEN remote_dir LIKE '%EGRUL%' THEN 'egrul' WHEN remote_dir LIKE '%EGRIP%' THEN 'egrip'
            ELSE 'egrul' END AS cert_registry
FROM (
  SELECT registry, entity_id, schema_version,
         CASE WHEN registry = 'egrul' AND schema_version = 'new' THEN '?dir=EGRUL_406'
              WHEN registry = 'egrul' THEN '?dir=EGRUL'
              WHEN schema_version = 'new' THEN '?dir=EGRIP_405' ELSE '?dir=EGRIP' END AS remote_dir
  FROM (
    SELECT registry, entity_id, CASE WHEN entity_id % 2 = 0 THEN 'new' ELSE 'old' END AS schema_version
    FROM (SELECT 'egrip' AS registry, c_custkey AS entity_id FROM customer
          UNION ALL SELECT 'egrul', s_suppkey FROM supplier) r) v) w
"""


# --- S2, C4, C8, C12 -------------------------------------------------------------------------

def q_snapshot_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.pmod(F.col("o_custkey"), F.lit(2)) == 0, "egrul").otherwise("egrip").alias("registry"),
        F.to_date("o_orderdate").alias("d"))
    return o.select("o_orderkey", "registry", _ds(F.col("d")).alias("load_date"),
                    landing.drop_path(F.lit(BASE_URL), F.col("registry"), F.lit("new"), F.col("d")).alias("drop_path"),
                    is_new_year(F.col("d")).alias("is_full"))


_SNAPSHOT_SQL = f"""
SELECT o_orderkey, registry, strftime(o_orderdate, '%Y-%m-%d') AS load_date,
       '{BASE_URL}/' || CASE WHEN registry = 'egrul' THEN '?dir=EGRUL_406' ELSE '?dir=EGRIP_405' END || '/'
         || strftime(o_orderdate, '%d.%m.%Y')
         || CASE WHEN month(o_orderdate) = 1 AND day(o_orderdate) = 1 THEN '_FULL' ELSE '' END AS drop_path,
       (month(o_orderdate) = 1 AND day(o_orderdate) = 1) AS is_full
FROM (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN 'egrul' ELSE 'egrip' END AS registry FROM orders) o
"""


# --- S3, F2, C7 ------------------------------------------------------------------------------

def q_landing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the test pages carry no class, so every anchor with an href counts."""
    apply_runtime_conf(spark)
    pages = read_table(spark, sf_dir, "pages")
    return landing.listing_links(pages, parent="url", link_class=None)


_LINKS_SQL = r"""
SELECT page_id, pos, href, string_split(href, '/')[-1] AS file_name
FROM (
  SELECT page_id, url, CAST(i - 1 AS BIGINT) AS pos, anchor,
         regexp_extract(anchor, '\shref="([^"]*)"', 1) AS href
  FROM (
    SELECT page_id, url, unnest(a) AS anchor, unnest(generate_series(1, len(a))) AS i
    FROM (SELECT page_id, url, regexp_extract_all(html, '(<a\s[^>]*>)', 1) AS a FROM pages) p
  ) x
  WHERE regexp_matches(anchor, '\shref="')
) y
WHERE href <> url
"""


# --- S4 --------------------------------------------------------------------------------------

def q_landing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page checked for several error tags, under a made-up HTTP status."""
    apply_runtime_conf(spark)
    pages = read_table(spark, sf_dir, "pages")
    m = F.pmod(F.col("page_id"), F.lit(10))
    status = F.when(m == 0, 503).when(m == 1, 302).when(m == 2, 100).otherwise(200)
    df = pages.select("page_id", "html", status.alias("status"),
                      F.explode(F.array(*[F.lit(t) for t in STATUS_TAGS])).alias("tag"))
    return df.select("page_id", "tag", "status",
                     landing.listing_status(F.col("status"), F.col("html"), F.col("tag")).alias("verdict"))


_STATUS_SQL = r"""
SELECT page_id, tag, status,
       CASE WHEN status > 200 THEN 'failed'
            WHEN regexp_matches(html, '<' || tag || '[\s>/]') THEN 'none' ELSE 'found' END AS verdict
FROM (
  SELECT page_id, html,
         CASE page_id % 10 WHEN 0 THEN 503 WHEN 1 THEN 302 WHEN 2 THEN 100 ELSE 200 END AS status,
         unnest(['b', 'h2', 'footer', 'em']) AS tag
  FROM pages) p
"""


# --- S5, F1 ----------------------------------------------------------------------------------

def q_file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents land as text files, one folder per source; the manifest sums bytes per source."""
    root = _stage(spark, "landing-docs")
    (read_table(spark, sf_dir, "documents").select("source", "text")
     .write.mode("overwrite").partitionBy("source").text(root))
    m = landing.file_manifest(spark, root, "*.txt")
    return (m.withColumn("source", F.regexp_extract("dir", r"source=([^/]*)$", 1))
            .groupBy("source").agg(F.sum("size").cast("bigint").alias("n_bytes")))


_MANIFEST_SQL = """
SELECT source, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY source
"""


# --- S7 --------------------------------------------------------------------------------------

def q_archive_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are zipped by the executors (one archive per task), then expanded again."""
    root = _stage(spark, "archives")
    docs = read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("entry"), "text")
    archive.zip_partitions(docs, root, "entry", "text", prefix="docs").count()
    entries = archive.archive_entries(spark, root)
    return entries.where(F.col("error").isNull()).select(
        F.regexp_extract("entry", r"^doc_(\d+)\.txt$", 1).cast("bigint").alias("doc_id"),
        F.col("size").cast("bigint").alias("n_bytes"), F.col("md5").alias("content_md5"))


_ARCHIVE_SQL = "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, md5(text) AS content_md5 FROM documents"


# --- S7-S14, N1-N3, P0: the daily job ---------------------------------------------------------

def _flaws(archive_file) -> dict[int, int]:
    """Bytes to flip ({offset: mask}) that spoil the entries of an archive that lie in its folder ``d``, each in one of three
    ways: a byte of the data (no checksum fits), the entry's own header, or a flag that calls it encrypted."""
    found: dict[int, int] = {}

    def two(at: int) -> int:
        archive_file.seek(at)
        return int.from_bytes(archive_file.read(2), "little")

    with zipfile.ZipFile(archive_file) as z:
        at = z.start_dir  # of the central directory
        for k, entry in enumerate(z.infolist()):
            own = entry.header_offset
            if entry.filename.startswith("d/"):
                if k % 3 == 0:
                    found[own + 30 + two(own + 26) + two(own + 28) + entry.compress_size // 2] = 0xFF
                elif k % 3 == 1:
                    found[own] = 0xFF
                else:
                    found |= {f: 1 for f in (own + 6, at + 8) if not two(f) & 1}
            at += 46 + sum(two(at + n) for n in (28, 30, 32))  # lengths of name, extra field and comment
    return found


def _damaged_copy(source: str, target: str) -> None:
    """Stream an archive to ``target`` with its flaws."""
    source_fs, src = filesystem_for(source)
    target_fs, dst = filesystem_for(target)
    target_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
    with source_fs.open_input_file(src) as data:
        flaws = _flaws(io.BytesIO(data.read()) if data.size() < CHUNK else data)  # pyarrow cannot seek before an empty archive
    with source_fs.open_input_stream(src) as data, target_fs.open_output_stream(dst) as out:
        begin = 0
        while chunk := bytearray(data.read(CHUNK)):
            for at, mask in flaws.items():
                if begin <= at < begin + len(chunk):
                    chunk[at - begin] ^= mask
            out.write(bytes(chunk))
            begin += len(chunk)


def _spoil(spark: SparkSession, whole: str, landed: str) -> None:
    """Land the archives of ``whole`` with spoilt entries, under their names."""
    def copy(batches):
        for pdf in batches:
            for name, path in zip(pdf["archive"], pdf["path"], strict=True):
                _damaged_copy(path, f"{landed}/{name}")
            yield pdf[["path"]]

    archive.list_archives(spark, whole).select("archive", "path").mapInPandas(copy, "path STRING").count()


def _xml_files(spark: SparkSession, sf_dir: str, registry: str, root: str) -> DataFrame:
    """A register's main table as packed XML files (kind, path), one kind for every fifth entity."""
    gen = os.path.join(root, "xml", registry)
    main = build_main(spark, sf_dir, registry).withColumn("kind", F.pmod(F.col("entity_id"), F.lit(5)))
    xmlsource.write_xml(main, gen, partition_by=("kind",), compression="gzip")
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xml.gz").load(gen).select(
        "kind", "path", F.monotonically_increasing_id().cast("string").alias("number"))


LISTED_TASKS = 20  # tasks of the file list whose undated entries share an archive


def _land(spark: SparkSession, sf_dir: str, registry: str, root: str) -> str:
    """A register's drop. Of five entities one lies in an entry with a
    lower-case name (in an archive with an upper-case one), one in a damaged entry between the good ones, one in an entry of the
    next day that begins with an underscore, one in an entry without a date, whose names repeat or differ only in their folders
    (in an archive without ending that begins with an underscore). Only the landed archives stay."""
    landed, whole = (os.path.join(root, d, registry) for d in ("landed", "whole"))
    files = _xml_files(spark, sf_dir, registry, root)
    head = F.concat(F.when(F.col("kind") == 3, "_").when(F.col("kind") == 2, "d/").otherwise(""),
                    F.lit(f"{DROP_PREFIX}{registry.upper()}_"), F.when(F.col("kind") == 3, NEXT_DATE).otherwise(LOAD_DATE))
    odd = F.element_at(F.array(F.lit("sub/readme.XML"), F.lit("sub__readme.XML")), (F.crc32("number") % 2 + 1).cast("int"))
    name = F.when(F.col("kind") == 4, odd).otherwise(
        F.concat(head, F.lit("_"), "number", F.when(F.col("kind") == 1, ".xml").otherwise(".XML")))
    files = files.withColumn("entry", name)
    undated = max(2, files.rdd.getNumPartitions() // LISTED_TASKS)
    _zip_files(files.where("kind in (0, 2, 3)"), whole, prefix="good")
    _zip_files(files.where("kind = 1"), landed, prefix="good", ending=".ZIP")
    _zip_files(files.where("kind = 4").coalesce(undated), landed, prefix="_good", ending="")
    delete_folder(os.path.join(root, "xml", registry))
    _spoil(spark, whole, landed)
    delete_folder(whole)
    filesystem, p = filesystem_for(os.path.join(landed, "broken.zip"))
    with filesystem.open_output_stream(p) as out:
        out.write(b"no archive")
    return landed


def _zip_files(files: DataFrame, out_dir: str, **names: str) -> None:
    archive.zip_partitions(files, out_dir, "entry", "path", from_files=True, **names).count()


def _slices_by_entity(spark: SparkSession, out: str) -> DataFrame:
    published = commits.read_slices(spark, out, commits.current(out).slices, schema="entity_id BIGINT")
    return (published.groupBy("registry", F.col("table").alias("table_name"), _ds(F.col("load_date")).alias("load_date"),
                              "entity_id").agg(F.count(F.lit(1)).alias("n_rows")))


@frees_shuffles
def q_daily_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both registers land as archives (good, damaged and oddly named entries) and go through the daily
    run; rows of every published table by slice and entity."""
    from regfold.plans.daily import daily_run

    root = _stage(spark, "daily-drop")
    out = os.path.join(root, "out")
    # the register of the largest shuffle lands first, while the disk holds no other archives
    drops = {r: {"new": _land(spark, sf_dir, r, root)} for r in reversed(REGISTRIES)}
    daily_run(spark, drops, out, LOAD_DATE, parallel=4)
    return _slices_by_entity(spark, out)


@frees_shuffles
def q_daily_late_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one date, the landing folder replaced between them. First part 1 lands, and part 2 damaged; then part 2 lands
    again, repaired, and part 3. The slices hold all three."""
    from regfold.plans.daily import daily_run

    root = _stage(spark, "daily-late")
    out = os.path.join(root, "out")
    files = _xml_files(spark, sf_dir, "egrip", root)
    name = F.concat(F.when(F.col("kind") == 1, "d/").otherwise(""), F.lit(f"{DROP_PREFIX}EGRIP_{LOAD_DATE}_"), "number", F.lit(".XML"))
    files = files.withColumn("entry", name)
    whole, first, second = (os.path.join(root, d) for d in ("whole-1", "landed-1", "landed-2"))
    _zip_files(files.where("kind in (0, 1)"), whole, prefix="parts")
    _spoil(spark, whole, first)
    delete_folder(whole)
    daily_run(spark, {"egrip": {"new": first}}, out, LOAD_DATE, parallel=4)
    delete_folder(first)
    # archives and entries have the names that they had, less those of part 1
    _zip_files(files.where("kind in (0, 1)").where("kind = 1"), second, prefix="parts")
    _zip_files(files.where("kind = 2"), second, prefix="late")
    delete_folder(os.path.join(root, "xml"))
    daily_run(spark, {"egrip": {"new": second}}, out, NEXT_DATE, parallel=4)
    return _slices_by_entity(spark, out)


_LATE_SQL = ("SELECT registry, table_name, entity_id, count(*) AS n_rows, '" + LOAD_DATE + "' AS load_date\nFROM ("
             + "\nUNION ALL\n".join(f"SELECT '{s.registry}' AS registry, '{s.name}' AS table_name, entity_id FROM ({TABLE_SQL[s.key]}) t"
                                     for s in SPECS if s.registry == "egrip") + ") r\nWHERE entity_id % 5 < 3 GROUP BY ALL")


def _daily_sql() -> str:
    parts = [f"SELECT '{s.registry}' AS registry, '{s.name}' AS table_name, entity_id FROM ({TABLE_SQL[s.key]}) t"
             for s in SPECS]
    return (f"SELECT registry, table_name, entity_id, count(*) AS n_rows, CASE entity_id % 5 WHEN 3 THEN '{NEXT_DATE}' "
            f"WHEN 4 THEN NULL ELSE '{LOAD_DATE}' END AS load_date\nFROM (" + "\nUNION ALL\n".join(parts)
            + ") r\nWHERE entity_id % 5 <> 2 GROUP BY ALL")


# --- S8 --------------------------------------------------------------------------------------

def q_xml_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer main table goes out as XML, comes back with its explicit string schema and
    gives the open-order line items (NN) with provenance from the drop folder."""
    root = _stage(spark, "xml")
    main = build_main(spark, sf_dir, "egrip")
    xmlsource.write_xml(main.withColumn("registry", F.lit("egrip")).withColumn("load_date", F.lit(LOAD_DATE)),
                        root, partition_by=("registry", "load_date"), compression="gzip")
    back = xmlsource.read_xml(spark, root, xmlsource.string_schema(schema_of("egrip")))
    t = project(back, SPEC_BY_NAME["noteegrip_info"])
    return t.select("entity_id", "registry", _ds(F.col("load_date")).alias("load_date"),
                    "o_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")


_XML_SQL = f"""
SELECT o_custkey AS entity_id, 'egrip' AS registry, '{LOAD_DATE}' AS load_date,
       o_orderkey, l_linenumber, l_returnflag, l_shipdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'
"""


# --- S9 --------------------------------------------------------------------------------------

def q_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land as files; two availableNow runs take each file once."""
    root = _stage(spark, "intake")
    events = read_table(spark, sf_dir, "events")
    events.write.mode("overwrite").parquet(os.path.join(root, "landing"))
    args = dict(src_dir=os.path.join(root, "landing"), schema=events.schema,
                sink_dir=os.path.join(root, "sink"), checkpoint_dir=os.path.join(root, "checkpoint"))
    consume_once(spark, **args)
    consume_once(spark, **args)  # nothing new: adds no rows
    return read_sink(spark, args["sink_dir"])


_STREAM_SQL = "SELECT * FROM events"


# --- C1, C2, C3, C9 --------------------------------------------------------------------------

def q_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate",
        F.when(F.pmod(F.col("o_orderkey"), F.lit(2)) == 0, "egrul").otherwise("egrip").alias("registry"))
    tbl = F.when(F.col("registry") == "egrip", "status_info").otherwise("ulstatus_info")
    ext = F.when(F.pmod(F.col("o_orderkey"), F.lit(7)) == 0, ".xml").otherwise(".XML")
    name = F.concat(F.lit(DROP_PREFIX), F.upper("registry"), F.lit("_"), _ds(F.col("o_orderdate")), F.lit("_"),
                    (F.pmod(F.col("o_orderkey"), F.lit(5)) + 1).cast("string"), ext)
    o = o.select("o_orderkey", "registry", tbl.alias("tbl"), name.alias("xml_name"))
    o = o.withColumn("stem", file_stem("xml_name"))
    o = o.withColumn("part_name", part_name(F.col("tbl"), F.col("stem"), F.col("registry")))
    return o.select("o_orderkey", "xml_name", "stem", "part_name", date_key("part_name").alias("date_key"))


_NAMES_SQL = f"""
SELECT o_orderkey, xml_name, stem, part_name, string_split(part_name, '_')[-2] AS date_key
FROM (
  SELECT *, tbl || string_split(stem, upper(registry))[-1] AS part_name
  FROM (
    SELECT *, string_split(xml_name, '.XML')[1] AS stem
    FROM (
      SELECT o_orderkey, registry,
             CASE WHEN registry = 'egrip' THEN 'status_info' ELSE 'ulstatus_info' END AS tbl,
             '{DROP_PREFIX}' || upper(registry) || '_' || strftime(o_orderdate, '%Y-%m-%d') || '_'
               || CAST(o_orderkey % 5 + 1 AS VARCHAR)
               || CASE WHEN o_orderkey % 7 = 0 THEN '.xml' ELSE '.XML' END AS xml_name
      FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'egrul' ELSE 'egrip' END AS registry FROM orders) a
    ) b) c) d
"""


# --- A1, U1, C11 -----------------------------------------------------------------------------

def q_merge_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive in three parts; parts are united, dated from their file names, merged."""
    apply_runtime_conf(spark)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = []
    for k in range(3):
        p = o.where(F.pmod(F.col("o_orderkey"), F.lit(3)) == k)
        parts.append(p.select("o_orderkey", F.lit(k + 1).alias("part"),
                              F.concat(F.lit("status_info_"), _ds(F.col("o_orderdate")), F.lit(f"_{k + 1}.parquet"))
                              .alias("src_file")))
    merged = merge_by_date(with_load_date(union_parts(parts)), "status_info")
    return merged.select(_ds(F.col("load_date")).alias("load_date"), "slice_name", "n_rows", "n_parts")


_MERGE_SQL = """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS load_date, 'status_info_' || strftime(o_orderdate, '%Y-%m-%d') AS slice_name,
       count(*) AS n_rows, count(DISTINCT o_orderkey % 3) AS n_parts
FROM orders GROUP BY 1, 2
"""


# --- U2 --------------------------------------------------------------------------------------

def q_union_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_runtime_conf(spark)
    new = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    old = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    return union_parts([new, old], ["new", "old"])


_UNION_SQL = """
SELECT c_custkey AS entity_id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, 'new' AS schema_version FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS entity_id, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       'old' AS schema_version FROM supplier
"""


# --- S11, S12, S14, S15, N2 ------------------------------------------------------------------

def _published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published by year into a fresh root, twice: the second write replaces the first."""
    root = _stage(spark, "publish")
    o = read_table(spark, sf_dir, "orders").withColumn("load_date", F.trunc(F.to_date("o_orderdate"), "year"))
    for _ in range(2):
        pub.publish(o, root, "egrip", "orders")
    return pub.read_published(spark, root)


def q_publish_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published row with the slice it lies in."""
    published = _published_orders(spark, sf_dir)
    return published.select("registry", F.col("table").alias("table_name"), _ds(F.col("load_date")).alias("load_date"),
                            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


_PUBLISH_SQL = """
SELECT 'egrip' AS registry, 'orders' AS table_name, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS load_date,
       o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders
"""


def q_drop_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slices go out as flat drop files; every drop file read back, under its name, with its slice.
    A slice of this size is one file."""
    root = _stage(spark, "drops")
    idx = pub.write_drops(_published_orders(spark, sf_dir), root, F.to_timestamp(F.lit(RUN_TS)))
    back = (spark.read.parquet(root).groupBy(F.col("_metadata.file_name").alias("drop_name"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_keys")))
    return idx.join(back, "drop_name", "full").select(
        "registry", F.col("table").alias("table_name"), _ds(F.col("load_date")).alias("load_date"), "seq", "drop_name",
        "n_rows", "sum_keys")


_DROP_SQL = f"""
SELECT registry, table_name, load_date, seq, n_rows, sum_keys,
       strftime(TIMESTAMP '{RUN_TS}' + seq * INTERVAL 1 SECOND, '%Y-%m-%d_%H-%M-%S') || '.parquet' AS drop_name
FROM (
  SELECT registry, table_name, load_date, n_rows, sum_keys,
         CAST(row_number() OVER (ORDER BY registry, table_name, load_date) - 1 AS BIGINT) AS seq
  FROM (SELECT 'egrip' AS registry, 'orders' AS table_name, count(*) AS n_rows,
               CAST(sum(o_orderkey) AS BIGINT) AS sum_keys,
               strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS load_date FROM orders GROUP BY ALL) s) t
"""


def q_run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and flags per published slice. File counts depend on the writing tasks, so they are
    checked by the tests, not compared here."""
    m = pub.manifest(_published_orders(spark, sf_dir), "slices", "registers")
    flags = [F.concat_ws(",", k).alias(k) if isinstance(v, list) else F.col(k) for k, v in pub.NOTICE_FLAGS]
    return m.select("registry", F.col("table").alias("table_name"), _ds(F.col("load_date")).alias("load_date"),
                    "n_rows", "bucket_name", "pilot_name", *flags)


_MANIFEST_RUN_SQL = """
SELECT 'egrip' AS registry, 'orders' AS table_name, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS load_date,
       count(*) AS n_rows, 'slices' AS bucket_name, 'registers' AS pilot_name, 30 AS mem_limit, true AS s3_clean_if_exist, true AS format_check, true AS hist,
       '.parquet' AS file_mask, 'drp' AS destination
FROM orders GROUP BY 3
"""


# --- U1: compaction ---------------------------------------------------------------------------

def q_compact_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are published by year as 40 small files a slice and then compacted; rows, files and digests of the slices
    before and after."""
    from regfold.plans.compaction import compact
    from regfold.plans.daily import slice_checks
    from regfold.plans.fanout import slice_path

    root = _stage(spark, "compact")
    o = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity_id"), "o_orderkey", "o_orderstatus",
                                                   F.trunc(F.to_date("o_orderdate"), "year").alias("load_date"))
    o.repartition(40).write.partitionBy("load_date").parquet(os.path.join(slice_path(root, "egrip", "status_info"), "run=first"))
    days = [_d.load_date for _d in o.select("load_date").distinct().collect()]  # a handful of years
    commits.commit(root, commits.State().after(LOAD_DATE, "first", {"egrip": [commits.date_key(d) for d in days]}))
    before = stage(slice_checks(spark, root, commits.current(root).slices), os.path.join(root, "_before"))
    compact(spark, root)
    after = slice_checks(spark, root, commits.current(root).slices)
    both = before.select("load_date", F.col("n_rows").alias("rows_before"), F.col("digest").alias("before")).join(after, "load_date")
    return both.select(_ds(F.col("load_date")).alias("load_date"), "rows_before", "n_rows", "n_files",
                       (F.col("before") == F.col("digest")).alias("same_content"))


_COMPACT_SQL = """
SELECT strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS load_date, count(*) AS rows_before, count(*) AS n_rows,
       1::BIGINT AS n_files, true AS same_content FROM orders GROUP BY 1
"""


# --- S16, F3, C5, C6 -------------------------------------------------------------------------

def q_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event stands for a drop file named by its time (every 50th name is unparsable)."""
    apply_runtime_conf(spark)
    ev = read_table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.pmod(F.col("event_id"), F.lit(50)) == 0,
               F.concat(F.lit("broken_"), F.col("event_id").cast("string"), F.lit(".parquet")))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd_HH-mm-ss"), F.lit(".parquet"))).alias("drop_name"))
    r = pub.retention(ev, F.to_timestamp(F.lit(RUN_TS)))
    return r.select("event_id", "drop_name", "age_days", "expired", "unparsable")


_RETENTION_SQL = f"""
SELECT event_id, drop_name, age_days, COALESCE(age_days >= 21, false) AS expired, age_days IS NULL AS unparsable
FROM (
  SELECT event_id,
         CASE WHEN event_id % 50 = 0 THEN 'broken_' || CAST(event_id AS VARCHAR) || '.parquet'
              ELSE strftime(ts, '%Y-%m-%d_%H-%M-%S') || '.parquet' END AS drop_name,
         CASE WHEN event_id % 50 = 0 THEN NULL
              ELSE CAST(floor((epoch_us(TIMESTAMP '{RUN_TS}') - epoch_us(date_trunc('second', ts))) / 86400000000)
                        AS BIGINT) END AS age_days
  FROM events) e
"""


# --- N1 --------------------------------------------------------------------------------------

def q_audit_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events become failure notices; the failing step follows from the user id."""
    apply_runtime_conf(spark)
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    code = F.concat(F.lit("0"), (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("string"))
    ev = ev.select("event_id", "ts", code.alias("code"))
    file = F.when(F.col("code") == "03", F.concat(F.lit("event_"), F.col("event_id").cast("string"), F.lit(".zip")))
    return failure_notices(ev, "code", file=file, run_date=_ds(F.col("ts")), keep=("event_id",))


_AUDIT_SQL = """
SELECT event_id, code, 'REGLOAD_FILECOPY_' || code AS subject,
       concat_ws('; ', CASE code WHEN '01' THEN 'source access check failed'
                                 WHEN '02' THEN 'new files or data not found'
                                 WHEN '03' THEN 'file transfer failed' ELSE 'unknown failure' END,
                 CASE WHEN file IS NOT NULL THEN 'file: ' || file END) AS message,
       file, CAST(NULL AS VARCHAR) AS dir, strftime(ts, '%Y-%m-%d') AS run_date
FROM (
  SELECT event_id, ts, code, CASE WHEN code = '03' THEN 'event_' || CAST(event_id AS VARCHAR) || '.zip' END AS file
  FROM (SELECT event_id, ts, '0' || CAST(user_id % 3 + 1 AS VARCHAR) AS code FROM events
        WHERE event_type = 'error') a) b
"""


# --- N3 --------------------------------------------------------------------------------------

def q_split_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events go out as XML with every 10th value broken; the string read plus a typed check
    splits them (good rows typed, bad rows flagged with the field that failed)."""
    from pyspark.sql import types as T

    root = _stage(spark, "xml-events")
    ev = read_table(spark, sf_dir, "events")
    value = F.when(F.pmod(F.col("event_id"), F.lit(10)) == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    xmlsource.write_xml(ev.select(F.col("event_id").cast("string").alias("event_id"), "event_type", value.alias("value")),
                        os.path.join(root, "xml"), row_tag="Event", root_tag="Events")
    typed = T.StructType.fromDDL("event_id BIGINT, event_type STRING, value DOUBLE")
    parsed = xmlsource.read_xml(spark, os.path.join(root, "xml"), xmlsource.string_schema(typed),
                                row_tag="Event", corrupt=True)
    back = stage(parsed, os.path.join(root, "_parsed"))  # Spark queries the corrupt column only once parsed
    good, bad = xmlsource.split_errors(back, typed)
    return (good.select("event_id", "event_type", "value", F.lit(False).alias("is_bad"))
            .unionByName(bad.select(F.col("event_id").try_cast("bigint").alias("event_id"), "event_type",
                                    F.lit(None).cast("double").alias("value"), F.lit(True).alias("is_bad"))))


_SPLIT_SQL = """
SELECT event_id, event_type, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
       event_id % 10 = 0 AS is_bad
FROM events
"""


QUERIES = {
    "route_schema": q_route_schema,
    "snapshot_path": q_snapshot_path,
    "landing_links": q_landing_links,
    "landing_status": q_landing_status,
    "file_manifest": q_file_manifest,
    "archive_expand": q_archive_expand,
    "daily_drop": q_daily_drop,
    "daily_late_parts": q_daily_late_parts,
    "compact_slices": q_compact_slices,
    "xml_main": q_xml_main,
    "stream_once": q_stream_once,
    "file_names": q_file_names,
    "merge_by_date": q_merge_by_date,
    "union_schemas": q_union_schemas,
    "publish_slices": q_publish_slices,
    "drop_index": q_drop_index,
    "retention": q_retention,
    "audit_failures": q_audit_failures,
    "run_manifest": q_run_manifest,
    "split_errors": q_split_errors,
}

ORACLE = {
    "route_schema": _ROUTE_SQL,
    "snapshot_path": _SNAPSHOT_SQL,
    "landing_links": _LINKS_SQL,
    "landing_status": _STATUS_SQL,
    "file_manifest": _MANIFEST_SQL,
    "archive_expand": _ARCHIVE_SQL,
    "daily_drop": _daily_sql(),
    "daily_late_parts": _LATE_SQL,
    "compact_slices": _COMPACT_SQL,
    "xml_main": _XML_SQL,
    "stream_once": _STREAM_SQL,
    "file_names": _NAMES_SQL,
    "merge_by_date": _MERGE_SQL,
    "union_schemas": _UNION_SQL,
    "publish_slices": _PUBLISH_SQL,
    "drop_index": _DROP_SQL,
    "retention": _RETENTION_SQL,
    "audit_failures": _AUDIT_SQL,
    "run_manifest": _MANIFEST_RUN_SQL,
    "split_errors": _SPLIT_SQL,
}
