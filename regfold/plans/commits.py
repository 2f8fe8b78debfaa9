"""Versions of the published slices (S6, S14): run folders, and one small file that says which of them count.

A run writes into folders of its own, ``<root>/registry=<r>/table=<t>/run=<run>/load_date=<d>/``, and touches no
other. What readers see is named by the newest file in ``<root>/_commits``: for every register and date, the run that holds
the date's slices in all tables, and the runs so far. The file is written under a hidden name and moved to the next
number, so a run counts whole or not at all: one that dies before leaves every slice as it was. Readers resolve the newest
commit once and then read folders that no later run changes; ``vacuum`` removes those that the last commits don't name.

One run at a time publishes below a root. Everything here is a row per date and run, never per record.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.sources.files import delete_folder, filesystem_for, folder_exists

COMMITS_DIR = "_commits"
UNDATED = "__HIVE_DEFAULT_PARTITION__"  # the folder of slices without a date
KEEP = 2  # commits whose folders stay: a reader may still be on the one before the newest


@dataclass
class State:
    """What is published after commit ``number``."""

    number: int = 0
    slices: dict[str, dict[str, str]] = field(default_factory=dict)  # register -> date (or UNDATED) -> run
    runs: list[list[str]] = field(default_factory=list)  # (run date, run), oldest first

    def after(self, run_date: str, run: str, dates: dict[str, list[str]]) -> State:
        """The state once ``run`` holds the slices of ``dates``."""
        slices = {r: dict(d) for r, d in self.slices.items()}
        for r, ds in dates.items():
            slices.setdefault(r, {}).update({d: run for d in ds})
        return State(self.number + 1, slices, [*self.runs, [run_date, run]])


def _numbers(out_root: str) -> list[int]:
    from pyarrow import fs

    folder = os.path.join(out_root, COMMITS_DIR)
    if not folder_exists(folder):
        return []
    filesystem, p = filesystem_for(folder)
    names = [f.base_name for f in filesystem.get_file_info(fs.FileSelector(p))]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read(out_root: str, number: int) -> State:
    filesystem, p = filesystem_for(os.path.join(out_root, COMMITS_DIR, f"{number:012d}.json"))
    with filesystem.open_input_stream(p) as f:
        return State(**json.loads(f.read()))


def current(out_root: str) -> State:
    """The newest commit; an empty state if there is none."""
    numbers = _numbers(out_root)
    return _read(out_root, numbers[-1]) if numbers else State()


def commit(out_root: str, state: State) -> None:
    filesystem, folder = filesystem_for(os.path.join(out_root, COMMITS_DIR))
    filesystem.create_dir(folder, recursive=True)
    if state.number in _numbers(out_root):
        raise RuntimeError(f"another run has published commit {state.number}")
    hidden = f"{folder}/.{state.number:012d}-{os.urandom(4).hex()}"
    with filesystem.open_output_stream(hidden) as out:
        out.write(json.dumps(state.__dict__).encode())
    filesystem.move(hidden, f"{folder}/{state.number:012d}.json")


def date_key(load_date) -> str:
    """The folder value of a load date."""
    return UNDATED if load_date is None else str(load_date)


def _found(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern; listed by Hadoop, so with Spark's own credentials."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [s.getPath().toString() for s in status or []]


def value_in(path: str, key: str) -> str:
    return next(p[len(key) + 1:] for p in path.split("/") if p.startswith(f"{key}="))


def slice_folders(spark: SparkSession, out_root: str, slices: dict[str, dict[str, str]], table: str = "*") -> list[str]:
    """The folders of ``slices`` (register -> date -> run) that exist, of one table or all."""
    out = []
    for registry, by_date in slices.items():
        for run in sorted(set(by_date.values())):
            found = _found(spark, f"{out_root}/registry={registry}/table={table}/run={run}/load_date=*")
            out += [p for p in found if by_date.get(value_in(p, "load_date")) == run]
    return out


def read_slices(spark: SparkSession, out_root: str, slices: dict[str, dict[str, str]], table: str = "*",
                schema: str | None = None) -> DataFrame | None:
    """The rows of ``slices`` with ``registry``, ``table`` and ``load_date``; None if no folder holds any."""
    paths = slice_folders(spark, out_root, slices, table)
    if not paths:
        return None
    reader = spark.read.option("basePath", out_root)
    out = (reader.schema(f"{schema}, registry STRING, table STRING, run STRING, load_date DATE") if schema else reader).parquet(*paths)
    return out.drop("run").withColumn("load_date", F.col("load_date").cast("date"))


def vacuum(spark: SparkSession, out_root: str, keep: int = KEEP) -> list[str]:
    """Remove run folders that none of the last ``keep`` commits names, those of failed runs among them; returns them.

    Not while a run is publishing.
    """
    numbers = _numbers(out_root)[-keep:]
    if not numbers:
        return []
    states = [_read(out_root, n) for n in numbers]
    named = {(r, d, run) for s in states for r, by_date in s.slices.items() for d, run in by_date.items()}
    gone = []
    for run_folder in _found(spark, f"{out_root}/registry=*/table=*/run=*"):
        registry, run = value_in(run_folder, "registry"), value_in(run_folder, "run")
        dates = _found(spark, f"{run_folder}/load_date=*")
        old = [p for p in dates if (registry, value_in(p, "load_date"), run) not in named]
        gone += [run_folder] if len(old) == len(dates) else old
    for p in gone:
        delete_folder(p)
    return gone
