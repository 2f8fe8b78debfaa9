"""Secret scans over a ledger of content-addressed blobs (operator 6). DataFrame functions only.

Every version of a text is a blob, named by its SHA-256. A rule has a version. The ledger (a Parquet
folder) holds, for each blob scanned, the rule versions it was scanned with and what they found. A scan
reduces its input to distinct blobs, drops the pairs of blob and rule version that the ledger holds,
scans the rest, appends to the ledger, and joins findings back to every path (row) with that blob. So
copies, renames and old versions cost nothing, and a new rule version rescans with that rule alone.

An append is one write, so a scan that fails or runs again leaves each pair scanned, at worst twice with
the same findings. Copies combine before the shuffle.

Cases: null text counts as empty. Very long texts are scanned whole, all patterns in linear time.
Repeated rows and null ids give a row each. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import prepare
from regfold.llm.spans import listed, marked, with_spans


@dataclass(frozen=True)
class Rule:
    """``group``'s text of a match must have ``least`` characters; ``guard`` matches every text that can match."""

    kind: str
    version: int
    pattern: str
    guard: str
    group: int = 0
    least: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The first three are the base kinds. A run of hex digits is one match, so its length may stand in the
# pattern; an assignment is dropped when its value is short, and what it covers is not searched again.
RULES = (
    Rule("assign", 1, r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]+)",
         r"(?i)password|passwd|secret|token|api_?key", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]++", "AKIA", 0, 20),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}+", "[0-9a-f]{24}"),
    Rule("jwt", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", "eyJ"),
    Rule("forge", 1, r"(?<![A-Za-z0-9_])gh[oprsu]_[A-Za-z0-9]{36,}+", "gh[oprsu]_"),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----", "PRIVATE KEY"),
)
BASE = ("assign", "access", "hex")
FOUND = "array<struct<start:long,rank:int,end:long,kind:string>>"


def blob_of(text: str = "text"):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _ledger(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    schema = f"blob string, rules array<string>, found {FOUND}"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _long(least: int):
    return lambda s: F.length(s["value"]) >= least


def _scan(blobs: DataFrame, rules) -> DataFrame:
    """Findings in ``text`` of every rule named in ``todo``."""
    df = blobs
    for rank, rule in enumerate(rules):
        column = f"_s{rank}"
        wanted = F.array_contains("todo", rule.name) & F.col("text").rlike(rule.guard)
        df = with_spans(df, column, "text", rule.pattern, wanted, rule.group or None)
        if rule.least:
            df = df.withColumn(column, F.filter(column, _long(rule.least)))
    marks = [marked(F.col(f"_s{k}"), r.kind, k) for k, r in enumerate(rules)]
    return df.select("blob", F.col("todo").alias("rules"), F.array_sort(F.concat(*marks)).cast(FOUND).alias("found"))


def scan(docs: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """Scan what ``ledger`` has not seen, append to it, and return doc_id, blob and found of every row."""
    prepare(docs.sparkSession)
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = (_ledger(docs, ledger).groupBy("blob")
            .agg(F.array_distinct(F.flatten(F.collect_set("rules"))).alias("seen")))
    blobs = (docs.select(blob_of().alias("blob"), F.coalesce("text", F.lit("")).alias("text")).groupBy("blob")
             .agg(F.first("text").alias("text")))
    todo = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
    pending = blobs.join(seen, "blob", "left").withColumn("todo", todo).filter(F.size("todo") > 0)
    _scan(pending.select("blob", "text", "todo"), rules).write.mode("append").parquet(ledger)
    current = [r.name for r in rules]
    hits = (_ledger(docs, ledger).filter(F.size("found") > 0)
            # findings of rule versions that are no longer current are left out
            .withColumn("found", F.filter("found", lambda s: F.exists(
                F.col("rules"), lambda r: r.startswith(F.concat(s["kind"], F.lit("@"))) & r.isin(current))))
            .groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found")))
    out = docs.select("doc_id", blob_of().alias("blob")).join(hits, "blob", "left")
    return out.select("doc_id", "blob", F.coalesce("found", F.array().cast(FOUND)).alias("found"))


def report(found: DataFrame) -> DataFrame:
    """doc_id, counts of base findings, base_sha256 and spans of every row of ``scan``."""
    of = lambda *kinds: F.filter("found", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(of(*BASE)), 256).alias("base_sha256"),
                        listed(F.col("found")).alias("spans"))
