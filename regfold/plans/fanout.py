"""The daily fan-out: stage a main table once, write every detail table from it.

The reference re-reads every main file for each of its 50 table tasks and then merges the parts
per date. Here the main table is written once to a staging folder owned by the run (under the
shared ``spark.checkpoint.dir``), which cuts the lineage of its joins and aggregates; each detail
table is then a narrow projection over that Parquet, whose scan reads only the nested fields the
table needs. All parts and files of one drop are one read, so a write already yields whole date
slices and there is no separate merge step.

Writes go to ``<out>/registry=<r>/table=<t>/load_date=<d>/`` with dynamic partition overwrite:
a rerun replaces exactly the slices it writes (D5); the daily run writes below a ``run=`` folder of its own
(``commits``). Tables whose rows have the same type (founder kinds, plain child lists, ...) share one scan of
the main table and one write, partitioned by table. Several writes run at once from a
small thread pool; each is its own Spark job. What a write hands over is counted and hashed as it passes (``Written``), at
no further pass.
"""

from __future__ import annotations

import functools
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regfold.operators.shapes import project, project_together, together
from regfold.plans import commits
from regfold.plans.specs import TableSpec, specs_for

# Rows per output file: keeps files near a few hundred MB however large a slice is.
MAX_RECORDS_PER_FILE = 20_000_000


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and read it back: a cut in the lineage that survives
    lost executors (unlike cache or a local checkpoint) and keeps nested column pruning."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def slice_path(out_root: str, registry: str, table: str) -> str:
    return os.path.join(out_root, f"registry={registry}", f"table={table}")


def row_hash(columns: list[str]) -> Column:
    """A 64-bit hash of a row that depends on the names and values of its columns, not on their order; a column
    that is null counts like one that is not there."""
    each = [F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), F.col(c))).otherwise(F.lit(0)) for c in columns]
    return F.xxhash64(functools.reduce(lambda a, b: a.bitwiseXOR(b), each))


def digest(columns: list[str]) -> Column:
    """Sum of row hashes: equal for equal bags of rows, however they are dealt to files. 128 bits hold it."""
    return F.coalesce(F.sum(row_hash(columns).cast("decimal(38,0)")), F.lit(0)).cast("string")


# Folders that say what a row belongs to; the rest is its content.
PLACE = ("registry", "table", "run", "load_date")


@dataclass
class Written:
    """What a write handed over for one table."""

    registry: str
    table: str
    n_rows: int
    digest: str


def _write(df: DataFrame, path: str, by: list[str], tables: list[str]) -> dict[str, tuple[int, str]]:
    """Write ``df`` by the folders ``by``; rows and digest of each table."""
    content = [c for c in df.columns if c not in PLACE]
    seen = Observation()
    metrics = []
    for k, t in enumerate(tables):
        own = F.lit(True) if "table" not in by else F.col("table") == t
        hashed = F.when(own, row_hash(content)).cast("decimal(38,0)")
        metrics += [F.count(hashed).alias(f"n{k}"), F.coalesce(F.sum(hashed), F.lit(0)).cast("string").alias(f"d{k}")]
    # few files a slice, whatever the number of scan tasks: partitions follow bytes, and a slice
    # larger than one is split. Rows are counted behind that exchange: a task of the last stage counts once
    (df.hint("rebalance", *by).observe(seen, *metrics).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")  # on the write itself: no session setting can wipe history
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*by)
     .parquet(path))
    got = seen.get
    return {t: (got[f"n{k}"], got[f"d{k}"]) for k, t in enumerate(tables)}


def _dated(df: DataFrame, load_date: str | None) -> DataFrame:
    df = df.drop("registry")  # it is the partition folder
    return df if "load_date" in df.columns else df.withColumn("load_date", F.lit(load_date).cast("date"))


def write_table(df: DataFrame, out_root: str, registry: str, table: str, load_date: str | None, run: str | None = None) -> Written:
    path = slice_path(out_root, registry, table)
    got = _write(_dated(df, load_date), os.path.join(path, f"run={run}") if run else path, ["load_date"], [table])
    return Written(registry, table, *got[table])


def write_tables(df: DataFrame, out_root: str, registry: str, tables: list[str], load_date: str | None,
                 run: str | None = None) -> list[Written]:
    """Rows of several tables, told apart by their column ``table``."""
    df = _dated(df, load_date)
    by = ["table", "load_date"]
    if run:
        df, by = df.withColumn("run", F.lit(run)), ["table", "run", "load_date"]
    got = _write(df, os.path.join(out_root, f"registry={registry}"), by, tables)
    return [Written(registry, t, *got[t]) for t in tables]


@dataclass
class FanOutResult:
    registry: str
    tables: tuple[str, ...]
    out_root: str
    written: tuple[Written, ...] = ()


def fan_out(spark: SparkSession, main: DataFrame, registry: str, out_root: str,
            load_date: str | None = None, parallel: int = 4,
            specs: tuple[TableSpec, ...] | None = None) -> FanOutResult:
    """Write every detail table of ``registry`` (or those of ``specs``) from a (staged) main table."""
    return fan_out_all(spark, {registry: main}, out_root, load_date, parallel, specs=specs)[0]


def stage_all(builders: dict, root: str, parallel: int = 2) -> dict[str, DataFrame]:
    """Stage several main tables at once (``{registry: lazy DataFrame}``); returns the staged reads."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        futures = {r: pool.submit(stage, df, os.path.join(root, r)) for r, df in builders.items()}
        return {r: f.result() for r, f in futures.items()}


def fan_out_all(spark: SparkSession, mains: dict[str, DataFrame], out_root: str, load_date: str | None = None,
                parallel: int = 8, run: str | None = None, carried: dict[str, dict[str, DataFrame]] | None = None,
                specs: tuple[TableSpec, ...] | None = None) -> list[FanOutResult]:
    """Every detail table of every register from one pool of write jobs.

    Each job is a narrow scan-project-write of one table, or of several whose rows have one type; running several at once
    keeps the executors busy while small tables finish and big ones still write. ``carried`` (by register and table)
    are rows that earlier runs have published and that go into the same slices.
    """
    jobs = [(r, group) for r in mains for group in together([s for s in specs or specs_for(r) if s.registry == r])]

    def one(job) -> tuple[str, list[Written]]:
        reg, group = job
        old = {s.name: (carried or {}).get(reg, {}).get(s.name) for s in group}
        if len(group) == 1:
            df, kept = project(mains[reg], group[0]), old[group[0].name]
            if kept is not None:
                df = df.unionByName(kept, allowMissingColumns=True)
            return reg, [write_table(df, out_root, reg, group[0].name, load_date, run)]
        df = project_together(mains[reg], group)
        for name, kept in old.items():
            if kept is not None:
                df = df.unionByName(kept.withColumn("table", F.lit(name)), allowMissingColumns=True)
        return reg, write_tables(df, out_root, reg, [s.name for s in group], load_date, run)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = list(pool.map(one, jobs))
    by_register = {r: [w for reg, ws in done if reg == r for w in ws] for r in mains}
    return [FanOutResult(r, tuple(w.table for w in ws), out_root, tuple(ws)) for r, ws in by_register.items()]


def read_published(spark: SparkSession, out_root: str, registry: str, table: str) -> DataFrame:
    """A published table: its current slices, or the whole folder where no run has committed."""
    state = commits.current(out_root)
    if not state.number:
        return spark.read.parquet(slice_path(out_root, registry, table))
    own = commits.read_slices(spark, out_root, {registry: state.slices.get(registry, {})}, table)
    if own is None:
        raise ValueError(f"nothing is published as {registry}.{table}")
    return own.drop("registry", "table")
