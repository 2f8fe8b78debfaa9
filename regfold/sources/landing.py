"""Landing area: drop folders, listing pages and landed files.

The network side of the source (client certificates, proxy, download) is not built; what remains
is data work over listing pages and landed files, as DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.functions.dates import drop_folder
from regfold.functions.paths import base_name, join_path, remote_dir

# Listing verdicts of S4 (our names).
FOUND, NONE, FAILED = "found", "none", "failed"
# Fixed values of the source's listing pages: the tag whose presence means "no such drop", and
# the class that marks a file link.
ERROR_TAG = "b"
LINK_CLASS = "clearfix"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def drop_path(base_url, registry, schema_version, load_date) -> Column:
    """S2 + C8: ``<url>/<remote dir>/<dd.MM.yyyy>[_FULL]``."""
    parts = [_c(base_url), remote_dir(registry, schema_version), drop_folder(load_date)]
    return F.concat(parts[0], F.lit("/"), parts[1], F.lit("/"), parts[2])  # null if the route is unknown


# Character references that links hold: fixed values. The ampersand comes last, so that none is decoded twice.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&#38;", "&"), ("&amp;", "&"))


def attribute(tag, name: str) -> Column:
    """Value of an attribute of a start tag, in any of the three quoting forms, decoded; null if absent."""
    start = r"(?is)^<[a-z0-9]+(?:\s+(?!" + name + r"\s*=)[^\s=>\"']+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)*\s+" + name
    value = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    out = F.concat(*[F.regexp_extract(_c(tag), start + value, k) for k in (1, 2, 3)])
    for ref, char in ENTITIES:
        out = F.replace(out, F.lit(ref), F.lit(char))
    return F.when(_c(tag).rlike(start + value), out)


def listing_links(pages: DataFrame, html: str = "html", parent: str | None = None,
                  link_class: str | None = LINK_CLASS, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """S3 + F2 + C7: anchors of a listing page with an ``href``, in page order.

    ``link_class`` keeps only anchors carrying that class (None: all anchors); links equal to the
    column ``parent`` (e.g. the listing's own directory) are dropped.
    """
    extra = [parent] if parent else []
    tag = r"""(?i)(<a\s(?:[^>"']|"[^"]*"|'[^']*')*>)"""
    anchors = pages.select(*keep, *extra,
                           F.posexplode(F.regexp_extract_all(F.col(html), F.lit(tag), 1)).alias("pos", "anchor"))
    if link_class:
        classes = F.split(attribute("anchor", "class"), r"\s+")
        anchors = anchors.where(F.array_contains(classes, link_class))
    links = anchors.select(*keep, *extra, F.col("pos").cast("bigint").alias("pos"),
                           attribute("anchor", "href").alias("href")).where("href is not null")
    if parent:
        links = links.where(F.col("href") != F.col(parent))
    return links.select(*keep, "pos", "href", base_name("href").alias("file_name"))


def has_tag(html, tag: str) -> Column:
    """Does the page hold an element ``<tag>`` (with or without attributes)?"""
    return _c(html).rlike(r"<" + tag + r"[\s>/]")


def listing_status(status, html, tag: str | Column = ERROR_TAG) -> Column:
    """Status <= 200 and no error tag -> found; error tag -> none; status > 200, or no status
    (the request itself failed) -> failed."""
    tag_present = (has_tag(html, tag) if isinstance(tag, str)
                   else F.regexp_like(_c(html), F.concat(F.lit("<"), tag, F.lit(r"[\s>/]"))))
    return (F.when(_c(status).isNull() | (_c(status) > 200), F.lit(FAILED))
            .when(tag_present, F.lit(NONE))
            .otherwise(F.lit(FOUND)))


def file_manifest(spark: SparkSession, landing_dir: str, glob: str = "*") -> DataFrame:
    """S5 + F1: landed files -> (file_name, dir, size). Only metadata is read, never the content.

    ``pathGlobFilter`` keeps matching files at the top level and sub-folders of a partitioned
    layout; nothing else is listed.
    """
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(landing_dir)
    return df.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"),  # _metadata.file_path is URL-encoded
        F.col("_metadata.file_size").cast("bigint").alias("size"),
    )
