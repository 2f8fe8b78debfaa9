"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regfold.session import ensure_checkpoint_dir, ship_package

# A word is a run of anything but space and \t \n \v \f \r: what bytes.split() splits at.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = " \t\n\r\x0b\x0c"

# Text handled at once by one Python worker; a longer document is a portion of its own.
PORTION_BYTES = 4 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package importable on the executors and checkpoint() usable. Settings stay as they are."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def map_batches(df: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with the package shipped first."""
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def portions(batches: Iterator[pa.RecordBatch], text: str = "text",
             limit: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each cut hold at most ``limit`` bytes, or are one document."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        lens = np.array([0 if v is None else v for v in pc.binary_length(col).to_pylist()], dtype=np.int64)
        start, total = 0, 0
        for i, n in enumerate(lens):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def row_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``keys`` in sorted rows, each as one table. Rows of a key may span batches."""
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for k in keys:
            v = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(a, b - a)
            key = tuple(part.column(part.schema.get_field_index(k))[0].as_py() for k in keys)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            held_key = key
    if held:
        yield pa.Table.from_batches(held)


def factorize(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Exact word ids in order of appearance, and the distinct words."""
    arr = np.empty(len(words), dtype=object)
    arr[:] = words
    ids, uniques = pd.factorize(arr)
    return ids.astype(np.int64), uniques


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` values, at the run's first position (length n - width + 1)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    level, have, mult = values.astype(np.uint64), 1, _MULT
    parts: list[tuple[np.ndarray, int, np.uint64]] = []
    rest = width
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                parts.append((level, have, mult))
            rest >>= 1
            if rest:
                level = level[: len(level) - have] * mult + level[have:]
                have, mult = have * 2, mult * mult
        out, at = np.zeros(n, dtype=np.uint64), 0
        for h, size, m in reversed(parts):
            out = out * m + h[at : at + n]
            at += size
        return mix64(out)


def first_equal(ids: np.ndarray, starts: np.ndarray, width: int, hashes: np.ndarray,
                scope: np.ndarray | None = None) -> np.ndarray:
    """For each window ``ids[s : s + width]``, the index (into ``starts``) of the first equal one.

    ``starts`` stand in the order that decides what is first. Windows are grouped by hash and then
    compared word by word, so a hash collision cannot join different windows. With ``scope``, only
    windows of one scope value are equal.
    """
    n = len(starts)
    first = np.arange(n)
    if n < 2:
        return first
    order = np.argsort(hashes, kind="stable")
    sorted_hashes = hashes[order]
    same = np.flatnonzero(sorted_hashes[1:] == sorted_hashes[:-1])
    if not len(same):
        return first
    a, b = starts[order[same]], starts[order[same + 1]]
    equal = np.ones(len(same), dtype=bool)
    for j in range(width):
        equal &= ids[a + j] == ids[b + j]
    if scope is not None:
        equal &= scope[order[same]] == scope[order[same + 1]]
    if not equal.all():  # equal hashes of different windows: order those groups by their words
        groups = np.unique(sorted_hashes[same[~equal]])
        clash = np.flatnonzero(np.isin(hashes, groups))
        rows = np.stack([ids[starts[clash] + j] for j in range(width)]
                        + ([] if scope is None else [scope[clash]]), axis=1)
        _, at, inverse = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        first[clash] = clash[at[inverse.ravel()]]
        clean = ~np.isin(sorted_hashes[same], groups)
        same = same[clean]
    head = np.ones(n, dtype=bool)
    head[same + 1] = False
    group_start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    members = np.zeros(n, dtype=bool)
    members[same] = members[same + 1] = True
    first[order[members]] = order[group_start[members]]
    return first


def doc_order(doc_id: Column) -> Column:
    """Sort key of a document id: nulls last."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def link_tree(linked: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links that connect what ``linked`` (left x right) connects: one per member and component."""
    root = np.arange(n)
    for i in np.flatnonzero(linked.any(axis=1)):
        members = np.append(right[linked[i]], left[i])
        olds = np.unique(root[members])
        root[np.isin(root, olds)] = olds[0]
    return [(i, int(r)) for i, r in enumerate(root) if r != i]
