"""One daily load, end to end: archives -> XML -> main table -> 50 detail tables -> report.

Mirrors the data path of the source's daily job without its scheduler and network clients:

  0. S9   compare the archives' entries with the ledger of earlier runs: only entries that are new, or landed with other
          content, are loaded
  1. S7   expand these entries on the executors, packed; bad archives and entries become audit rows, broken records too
  2. S8   one XML read per register over all parts and schema versions (U2), explicit schema,
          provenance from file names (registry, schema_version, load_date, is_full, part, src_file, entry_id)
  3. N3   corrupt records split off into the audit (code 04), bad archives too (code 03)
  4. S13  the main table is staged once as Parquet in a folder owned by the run; the expanded XML then goes
  5. P0   every detail table is a projection of the staged main table, written by date slice into folders of this
          run. A date that is out already is rebuilt: the rows of its entries that this run has not loaded are carried over
          (U1), so late parts add to a slice and a replaced entry replaces its own rows, whether or not the earlier
          archives are still there
  6. N2   a report row per (registry, table): rows and digest read back against those handed to the write and
          against the rows expected from the main table (``ok``, ``empty`` (D7) or ``mismatch``) and the values that did not
          cast to their type (``n_bad_values``); and a manifest row per slice published
  7. S14  the commit: one small file makes all slices of the run current at once (``commits``)
  8. S15  on demand, the run's slices once more as flat drop files
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.functions.dates import is_new_year
from regfold.functions.names import date_key, file_stem
from regfold.operators.audit import failure_notices
from regfold.operators.shapes import table_checks
from regfold.plans import commits, publish
from regfold.plans.fanout import PLACE, digest, fan_out_all, stage
from regfold.plans.specs import PROVENANCE, REGISTRIES, SPECS, field_type, schema_of, specs_for
from regfold.session import frees_shuffles, staging_dir
from regfold.sources import archive, xmlsource
from regfold.sources.files import delete_folder, folder_exists

STATUS_OK, STATUS_EMPTY, STATUS_MISMATCH = "ok", "empty", "mismatch"


def with_provenance(df: DataFrame, registry: str, schema_version: str | None = None,
                    name_col: str = "src_file") -> DataFrame:
    """Columns every detail table carries, parsed from ``…<REGISTER>…_<date>_<part>.XML``."""
    stem = file_stem(F.col(name_col))
    d = F.try_to_date(date_key(stem), "yyyy-MM-dd")
    out = df.withColumn("registry", F.lit(registry))
    if schema_version is not None:
        out = out.withColumn("schema_version", F.lit(schema_version))
    return (out.withColumn("load_date", d)
            .withColumn("is_full", is_new_year(d))
            .withColumn("part", F.element_at(F.split(stem, "_"), -1)))


def read_drop(spark: SparkSession, xml_dirs: dict[str, str], registry: str, extracted: bool = False) -> DataFrame:
    """All XML of one register, every schema version (``{version: dir}``), as one main table.

    ``extracted``: the folders are those of ``extract_archives``, of which committed attempts are read.
    """
    schema = xmlsource.string_schema(schema_of(registry))
    # src_file is the archive's entry, whether it was cut or not
    entry = archive.entry_name("src_file")
    parts = []
    for v, d in xml_dirs.items():
        if extracted:
            rows = xmlsource.read_xml(spark, archive.data_path(d), schema, corrupt=True, path_col="_path")
            rows = archive.take_committed(rows, d, "_path")
        else:
            rows = xmlsource.read_xml(spark, d, schema, corrupt=True)
        parts.append(with_provenance(rows.withColumn("src_file", entry), registry, v))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def record_run(df: DataFrame, log_dir: str, run_date: str) -> DataFrame:
    """Write a run's rows as the log's partition of that run, in place of an earlier try, and read them back."""
    path = os.path.join(log_dir, f"run_date={run_date}")
    df.drop("run_date").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.drop("run_date").schema).parquet(path).withColumn("run_date", F.lit(run_date))


def content_schema() -> str:
    """The content columns of all detail tables, for one read over tables of different columns."""
    kinds = {"entity_id": "bigint", "is_main": "boolean"}
    for s in SPECS:
        kinds |= {f: field_type(s.registry, s, f).simpleString() for f in s.fields}
        kinds |= {g: field_type(s.registry, s, g, "group").simpleString() for g in s.group}
    kinds |= {c: "boolean" if c == "is_full" else "string" for c in PROVENANCE if c not in PLACE}
    return ", ".join(f"`{c}` {t}" for c, t in kinds.items())


def slice_checks(spark: SparkSession, out_root: str, slices: dict[str, dict[str, str]]) -> DataFrame | None:
    """(registry, table, load_date, n_rows, n_files, n_bytes, digest) of published slices, from one scan of all
    their columns; None if there are none."""
    published = commits.read_slices(spark, out_root, slices, schema=content_schema())
    if published is None:
        return None
    return publish.slices(published, digest([c for c in published.columns if c not in PLACE]))


def run_report(spark: SparkSession, registry: str, checked: DataFrame | None) -> DataFrame:
    """N2 + D7: rows and digest per (registry, table) of the slices ``checked``; tables with no rows get ``empty``."""
    rep = spark.createDataFrame([(registry, s.name) for s in specs_for(registry)], "registry STRING, table STRING")
    if checked is not None:
        found = checked.groupBy("registry", "table").agg(
            F.sum("n_rows").alias("n_rows"), F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"))
        rep = rep.join(found, ["registry", "table"], "left")
    else:  # nothing published
        rep = rep.select("*", F.lit(None).cast("bigint").alias("n_rows"), F.lit(None).cast("string").alias("digest"))
    n = F.coalesce("n_rows", F.lit(0)).cast("bigint")
    return rep.select("registry", "table", n.alias("n_rows"), F.coalesce("digest", F.lit("0")).alias("digest"),
                      F.when(n > 0, STATUS_OK).otherwise(STATUS_EMPTY).alias("status"))


def check_report(report: DataFrame, checks: DataFrame | None, written: DataFrame | None = None) -> DataFrame:
    """Join what was read back with the rows that the main tables and carried slices hold (``table_checks``) and
    with the rows and digests handed to the writes; a table that differs from either becomes ``mismatch``."""
    if checks is not None:
        report = report.join(checks.withColumnRenamed("table_name", "table"), ["registry", "table"], "left")
    else:
        report = report.withColumn("n_expected", F.lit(None)).withColumn("n_bad_values", F.lit(None))
    n_exp = F.coalesce("n_expected", F.lit(0)).cast("bigint")
    differs = F.col("n_rows") != n_exp
    if written is not None:
        report = report.join(written, ["registry", "table"], "left")
        differs = differs | ~F.struct("n_rows", "digest").eqNullSafe(
            F.struct(F.coalesce("rows_written", F.lit(0)).cast("bigint").alias("n_rows"),
                     F.coalesce("digest_written", F.lit("0")).alias("digest")))
    return report.select(
        "registry", "table", "n_rows", n_exp.alias("n_expected"),
        F.coalesce("n_bad_values", F.lit(0)).cast("bigint").alias("n_bad_values"),
        F.when(differs, STATUS_MISMATCH).otherwise(F.col("status")).alias("status"))


def verify(spark: SparkSession, out_root: str) -> DataFrame:
    """Every current slice read again and held against the manifest of the run that published it:
    (registry, table, load_date, run_date, n_rows, n_found, status)."""
    state = commits.current(out_root)
    keys = ["registry", "table", "load_date"]
    empty = "registry STRING, table STRING, load_date DATE, "
    found = slice_checks(spark, out_root, state.slices)
    found = (found.select(*keys, F.col("n_rows").alias("n_found"), F.col("digest").alias("digest_found"))
             if found is not None else spark.createDataFrame([], empty + "n_found BIGINT, digest_found STRING"))
    held = [(r, None if d == commits.UNDATED else d, run) for r, by_date in state.slices.items() for d, run in by_date.items()]
    held = spark.createDataFrame(held, "registry STRING, day STRING, run STRING").select(
        "registry", F.col("day").cast("date").alias("load_date"), "run")
    path = os.path.join(out_root, MANIFEST_DIR)
    if folder_exists(path):
        known = spark.read.schema(empty + "run STRING, n_rows BIGINT, digest STRING, run_date STRING").parquet(path)
        known = known.join(held, [known[c].eqNullSafe(held[c]) for c in ("registry", "load_date", "run")], "left_semi")
    else:
        known = spark.createDataFrame([], empty + "run STRING, n_rows BIGINT, digest STRING, run_date STRING")
    both = known.join(found, [known[c].eqNullSafe(found[c]) for c in keys], "full")
    same = known["n_rows"].eqNullSafe(found["n_found"]) & known["digest"].eqNullSafe(found["digest_found"])
    return both.select(*[F.coalesce(known[c], found[c]).alias(c) for c in keys], "run_date", "n_rows", "n_found",
                       F.when(same, STATUS_OK).otherwise(STATUS_MISMATCH).alias("status"))


@dataclass
class DailyResult:
    out_root: str
    report: DataFrame
    audit: DataFrame
    staged: dict


# Under the output root, one partition per run date:
AUDIT_DIR = "_audit"        # failure notices (N1)
RUNS_DIR = "_runs"          # a report row per table (N2)
MANIFEST_DIR = "_manifest"  # a row per published slice (N2)
INTAKE_DIR = "_intake"      # the archive entries seen, a folder per run (S9)

LEDGER = ("registry STRING, schema_version STRING, archive STRING, entry STRING, entry_id STRING, size BIGINT, crc BIGINT, "
          "landed BIGINT, error STRING")
# Faults of an entry itself: it is not tried again before it changes or its archive lands anew. Other failures (storage,
# network) are.
ENTRY_FAULTS = ("BadZipFile", "error", "ValueError", "RuntimeError", "NotImplementedError", "EOFError", "UnicodeDecodeError")


def ledger(spark: SparkSession, out_root: str, run_date: str, state: commits.State) -> DataFrame | None:
    """The content of every entry as the last committed run has seen it, without the runs of ``run_date``: a run that
    is repeated takes its own entries again. None if there is none."""
    paths = {os.path.join(out_root, INTAKE_DIR, f"run={run}"): k for k, (d, run) in enumerate(state.runs) if d != run_date}
    paths = {p: k for p, k in paths.items() if folder_exists(p)}
    if not paths:
        return None
    order = F.element_at(F.create_map(*[F.lit(v) for p, k in paths.items() for v in (p.rsplit("run=", 1)[1], k)]), F.col("run"))
    rows = spark.read.option("basePath", os.path.join(out_root, INTAKE_DIR)).schema(LEDGER + ", run STRING").parquet(*paths)
    return rows.groupBy("registry", "schema_version", "entry_id").agg(
        F.max_by(F.struct("size", "crc", F.when(F.col("error").isNotNull(), F.col("landed")).alias("failed_at")), order).alias("seen")).select("registry", "schema_version", "entry_id", "seen.*")


def entries_to_load(listed: DataFrame, before: DataFrame | None) -> DataFrame:
    """Of the listed entries (with ``registry``) those whose content is new, and the unreadable archives.

    An entry that has failed may look the same when it lands repaired: it is new if its archive has landed since.
    """
    if before is None:
        return listed
    same = [listed[c] == before[c] for c in ("registry", "schema_version", "entry_id", "size", "crc")]
    same.append(before["failed_at"].isNull() | (before["failed_at"] == listed["landed"]))
    new = listed.where("error is null").join(before, same, "left_anti")
    return new.unionByName(listed.where("error is not null"))


def entry_date(entry: str = "entry") -> F.Column:
    return F.try_to_date(date_key(file_stem(F.col(entry))), "yyyy-MM-dd")


def carried_over(spark: SparkSession, out_root: str, slices: dict[str, dict[str, str]], taken: DataFrame) -> dict:
    """What stays of published ``slices`` whose dates are rebuilt: the rows of entries that are not in ``taken``,
    {register: {table: rows}}."""
    replaced = taken.select("schema_version", "entry_id", "registry")
    out: dict = {}
    for r, by_date in slices.items():
        own = replaced.where(F.col("registry") == r).drop("registry")
        folders: dict[str, list[str]] = {}
        for p in commits.slice_folders(spark, out_root, {r: by_date}):
            folders.setdefault(commits.value_in(p, "table"), []).append(p)
        for table, paths in folders.items():
            rows = spark.read.option("basePath", out_root).parquet(*paths).drop("registry", "table", "run")
            rows = rows.withColumn("load_date", F.col("load_date").cast("date"))
            out.setdefault(r, {})[table] = rows.join(own, ["schema_version", "entry_id"], "left_anti")
    return out


@frees_shuffles
def daily_run(spark: SparkSession, archive_dirs: dict[str, dict[str, str]], out_root: str,
              run_date: str, parallel: int = 8, record: bool = True, once: bool = True,
              drop_dir: str | None = None, bucket_name: str | None = None,
              pilot_name: str | None = None) -> DailyResult:
    """``archive_dirs``: {registry: {schema_version: folder of landed zips}}; every file there is tried.

    With ``record`` the run's failure notices, report and manifest rows are written under ``out_root``, one partition
    per run date: running a date again replaces its notices and report (the manifest keeps a folder per run). The staged XML is dropped as soon as it is parsed, the main tables
    at the end (S13); without ``record`` they stay, as the report and notices still read them.

    With ``once`` entries that committed runs of other dates have seen with the same content are not loaded again (S9).
    Nothing that readers see changes before the commit, which is the last step but for the drop files: a run
    that fails is repeated in full. ``drop_dir`` takes the run's slices as flat files too (S15); the names go into the
    manifest.
    """
    run = f"{run_date}-{uuid.uuid4().hex[:12]}"
    work = staging_dir(spark, f"daily-{run_date}")
    state = commits.current(out_root)
    before = ledger(spark, out_root, run_date, state) if once else None
    run_ts = F.current_timestamp()

    def load(registry: str):
        """Expand, read, stage and split one register; returns (good rows, notices, staged path, entries tried)."""
        notices, xml_dirs = [], {}
        versions = archive_dirs.get(registry, {})
        if not versions:
            return None, notices, None, None
        listed = None
        for version, zdir in versions.items():
            part = archive.list_entries(spark, zdir).select("*", F.lit(registry).alias("registry"),
                                                            F.lit(version).alias("schema_version"))
            listed = part if listed is None else listed.unionByName(part)
        listed = stage(listed, os.path.join(work, "listed", registry))
        chosen = stage(entries_to_load(listed, before), os.path.join(work, "chosen", registry))
        tried = None
        for version, zdir in versions.items():
            xdir = os.path.join(work, "xml", registry, version)
            entries = chosen.where(F.col("schema_version") == version)
            rep = archive.extract_archives(spark, zdir, xdir, entries=entries, packed=True)
            outcome = rep.where("entry_id is not null and record_offset is null").select("entry_id", F.col("error").alias("fault"))
            own = entries.where("error is null").join(outcome, "entry_id").drop("error").withColumnRenamed("fault", "error")
            tried = own if tried is None else tried.unionByName(own)
            records = F.col("record_offset").isNotNull()
            notices.append(failure_notices(rep.where(F.col("error").isNotNull() & ~records), F.lit("03"),
                                           file=F.col("archive"), directory=F.lit(zdir), run_date=F.lit(run_date)))
            notices.append(failure_notices(rep.where(records), F.lit("04"), file=F.col("entry"), offset=F.col("record_offset"),
                                           run_date=F.lit(run_date)))
            if rep.isEmpty():
                nothing = spark.createDataFrame([(zdir,)], "dir STRING")
                notices.append(failure_notices(nothing, F.lit("02"), directory=F.col("dir"), run_date=F.lit(run_date)))
            if not rep.where("error is null").isEmpty():
                xml_dirs[version] = xdir
        if not xml_dirs:
            return None, notices, None, tried
        path = os.path.join(work, "main", registry)
        good, bad = xmlsource.split_errors(stage(read_drop(spark, xml_dirs, registry, extracted=True), path))
        if record:
            for xdir in xml_dirs.values():
                archive.drop_pieces(xdir)
        notices.append(failure_notices(bad, F.lit("04"), file=F.col("src_file"), run_date=F.lit(run_date)))
        return good, notices, path, tried

    # the registers are independent until the fan-out: load them at once
    with ThreadPoolExecutor(max_workers=len(REGISTRIES)) as pool:
        loaded = dict(zip(REGISTRIES, pool.map(load, REGISTRIES)))
    mains = {r: g for r, (g, _, _, _) in loaded.items() if g is not None}
    staged = {r: p for r, (_, _, p, _) in loaded.items() if p is not None}
    audits = [n for _, ns, _, _ in loaded.values() for n in ns]
    tried = [t for _, _, _, t in loaded.values() if t is not None]
    dates: dict[str, list[str]] = {}
    carried: dict = {}
    if mains:
        entries = tried[0]
        for t in tried[1:]:
            entries = entries.unionByName(t)
        entries = stage(entries, os.path.join(work, "tried"))
        taken = entries.where("error is null")
        # the dates of this drop: a handful of values
        for row in taken.select("registry", entry_date().alias("load_date")).distinct().collect():
            dates.setdefault(row.registry, []).append(commits.date_key(row.load_date))
        kept = {r: {d: state.slices[r][d] for d in ds if d in state.slices.get(r, {})} for r, ds in dates.items()}
        carried = carried_over(spark, out_root, {r: ds for r, ds in kept.items() if ds}, taken)
    written = [w for res in fan_out_all(spark, mains, out_root, parallel=parallel, run=run, carried=carried)
               for w in res.written] if mains else []
    slices = {r: {d: run for d in ds} for r, ds in dates.items()}
    checked = slice_checks(spark, out_root, slices)
    if checked is not None:
        checked = stage(checked, os.path.join(work, "checked"))
    report = run_report(spark, REGISTRIES[0], checked)
    for r in REGISTRIES[1:]:
        report = report.unionByName(run_report(spark, r, checked))
    handed = spark.createDataFrame([(w.registry, w.table, w.n_rows, w.digest) for w in written],
                                   "registry STRING, table STRING, rows_written BIGINT, digest_written STRING")
    # one pass over each staged main table: rows each table must hold, and values that turned
    # null by try_cast (D1); and the rows carried over
    report = check_report(report, _with_carried(table_checks(mains), carried) if mains else None, handed)
    audit = audits[0] if audits else spark.createDataFrame(
        [], "code STRING, subject STRING, message STRING, file STRING, dir STRING, run_date STRING")
    for a in audits[1:]:
        audit = audit.unionByName(a)
    if not record:
        report = stage(report, os.path.join(work, "report"))  # before the slices change again
    else:
        audit = record_run(audit, os.path.join(out_root, AUDIT_DIR), run_date)
        report = record_run(report, os.path.join(out_root, RUNS_DIR), run_date).drop("run_date")
    if mains:
        again = F.col("error").isNull() | F.substring_index("error", ":", 1).isin(*ENTRY_FAULTS)
        (entries.where(again).select(*[c.split()[0] for c in LEDGER.split(", ")])
         .write.mode("overwrite").parquet(os.path.join(out_root, INTAKE_DIR, f"run={run}")))
    elif tried:
        _write_tried(tried, os.path.join(out_root, INTAKE_DIR, f"run={run}"))
    if record and checked is not None:
        _write_manifest(checked, out_root, run, run_date, bucket_name, pilot_name)
    commits.commit(out_root, state.after(run_date, run, dates))
    if drop_dir and checked is not None:
        drops = publish.write_drops(commits.read_slices(spark, out_root, slices, schema="entity_id BIGINT"), drop_dir, run_ts)
        if record:
            _write_manifest(checked, out_root, run, run_date, bucket_name, pilot_name, drops)
    if record:
        delete_folder(work)
        staged = {}
    commits.vacuum(spark, out_root)
    return DailyResult(out_root, report, audit, staged)


def _write_tried(tried: list[DataFrame], path: str) -> None:
    """The ledger of a run that has loaded nothing: entries whose faults are their own."""
    rows = tried[0]
    for t in tried[1:]:
        rows = rows.unionByName(t)
    rows = rows.where(F.substring_index("error", ":", 1).isin(*ENTRY_FAULTS))
    rows.select(*[c.split()[0] for c in LEDGER.split(", ")]).write.mode("overwrite").parquet(path)


def _with_carried(checks: DataFrame, carried: dict) -> DataFrame:
    """``table_checks`` with the rows carried over added to those expected."""
    counts = [rows.select(F.lit(r).alias("registry"), F.lit(t).alias("table_name")) for r, tables in carried.items()
              for t, rows in tables.items()]
    if not counts:
        return checks
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    out = out.groupBy("registry", "table_name").agg(F.count(F.lit(1)).alias("n_carried"))
    return checks.join(out, ["registry", "table_name"], "left").select(
        "registry", "table_name", (F.coalesce("n_expected", F.lit(0)) + F.coalesce("n_carried", F.lit(0))).alias("n_expected"),
        "n_bad_values")


def _write_manifest(checked: DataFrame, out_root: str, run: str, run_date: str, bucket_name, pilot_name,
                    drops: DataFrame | None = None) -> None:
    slices = publish.manifest(checked, bucket_name, pilot_name)
    if drops is not None:
        names = drops.groupBy("registry", "table", "load_date").agg(F.sort_array(F.collect_list("drop_name")).alias("drop_names"))
        on = [slices[c].eqNullSafe(names[c]) for c in ("registry", "table", "load_date")]
        slices = slices.join(names, on, "left").select(slices["*"], "drop_names")
    else:
        slices = slices.withColumn("drop_names", F.lit(None).cast("array<string>"))
    path = os.path.join(out_root, MANIFEST_DIR, f"run_date={run_date}", f"run={run}")
    slices.drop("run").write.mode("overwrite").parquet(path)
