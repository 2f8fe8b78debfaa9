"""Exact top-k search by inner product with norm buckets (operator 13).

Components become integers, floor(1024 x). Candidates are range-partitioned by falling length into shelves and cut
into buckets of vectors of about one length. A query that already knows ``top`` products of at least t needs, in a bucket
whose longest vector has length l, a cosine of t / (|q| l): its local threshold there. Above 1 the bucket is skipped.
Otherwise one of two prunings picks the vectors to verify:

  * length: the bucket's prefix of vectors with |q| |p| >= t, for low thresholds;
  * coordinate: from ``COORD_FROM`` on, only vectors whose direction lies, at each of the query's ``FOCUS`` largest
    coordinates, within arccos(threshold) of the query's own angle there.

What is left is verified by exact integer products, and the threshold rises with what is found. Thresholds start
from the ``SEEDS`` longest vectors of all (a broadcast of fixed size), so buckets too short for every query are not
even shuffled.

Queries are packed in blocks as well. Every query block meets every shelf in a cell of its own, whose size is
bounded; a cell returns at most ``top`` rows per query, and Spark ranks those of all cells. The work is that of the stated
query set against all rows, less what the bounds exclude.

Cases: vectors that are null or empty or hold null or non-finite components take no part. Only vectors of
equal length meet. Every row is a candidate; a query leaves out its own row, not copies of it. Queries are rows whose
id is divisible by ``every``; rows that share such an id are queries of their own, each with its ranks. A null id
is no query and sorts last. Zero vectors score 0. Integers are held within +-isqrt((2^63 - 1) / D), at most 2^31 - 1, so that no score
passes 64 bits. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from regfold.llm.common import doc_order, map_batches, prepare

TOP = 10
SCALE = 1024
EVERY = 100
BUCKET = 2048  # vectors of a bucket
SHELF = 8 * BUCKET  # of a range of buckets
QUERY_BLOCK = 4096
SEEDS = 1024
FOCUS = 4
COORD_FROM = 0.8
SLACK = 1e-9  # on lengths and cosines, against rounding
AT_ONCE = 1 << 20  # products held at once

NONE = -(2**63)  # a threshold that excludes nothing
PACK = "dim int, longest double, places binary, uids binary, lengths binary, vectors binary, ids array<{}>"


def _integers(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Integer components, packed, and the length of every vector."""
    for batch in batches:
        lists = batch.column("vector")
        flat = lists.flatten().to_numpy()
        ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
        dims, lengths, packed = [], [], []
        for c in np.split(flat, ends[:-1]):
            bound = min(2**31 - 1, math.isqrt((2**63 - 1) // len(c)))
            x = np.floor(np.clip(c * scale, -bound, bound)).astype(np.int32)
            dims.append(len(c))
            lengths.append(math.sqrt(int((x.astype(np.int64) ** 2).sum())))
            packed.append(x.tobytes())
        yield pa.record_batch([batch.column("uid"), batch.column("vec_id"), batch.column("place"), pa.array(dims, pa.int32()),
                               pa.array(lengths, pa.float64()), pa.array(packed, pa.binary())],
                              names=["uid", "vec_id", "place", "dim", "length", "vector"])


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (uid, vec_id, place, dim, length, vector) as packs of at most ``size`` vectors of one dimension."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        while held.num_rows > size:
            taken, held = _head(held, size)
            yield taken
    while held is not None and held.num_rows:
        taken, held = _head(held, size)
        yield taken


def _head(rows: pa.Table, size: int) -> tuple[pa.RecordBatch, pa.Table]:
    dims = rows.column("dim").to_numpy()
    k = min(size, int((dims == dims[0]).argmin()) or len(dims))
    own, rest = rows.slice(0, k).combine_chunks(), rows.slice(k)
    length = own.column("length").to_numpy()
    ids = own.column("vec_id").combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    packed = [own.column("place").to_numpy().tobytes(), own.column("uid").to_numpy().tobytes(), length.tobytes(),
              b"".join(own.column("vector").to_pylist())]
    return pa.record_batch(
        [pa.array([int(dims[0])], pa.int32()), pa.array([float(length.max())], pa.float64()),
         *[pa.array([b], pa.binary()) for b in packed], pa.ListArray.from_arrays(pa.array([0, k], pa.int32()), ids)],
        names=["dim", "longest", "places", "uids", "lengths", "vectors", "ids"]), rest


class Pack:
    """An unpacked row of ``PACK``."""

    def __init__(self, row: dict, ids: pa.Array | None = None):
        self.dim, self.longest, self.ids = row["dim"], row["longest"], ids
        self.place, self.uid = (np.frombuffer(row[c], dtype=np.int64) for c in ("places", "uids"))
        self.length = np.frombuffer(row["lengths"], dtype=np.float64)
        self.x = np.frombuffer(row["vectors"], dtype=np.int32).reshape(-1, self.dim)
        self.largest = int(np.abs(self.x.astype(np.int64)).max(initial=0))
        self._unit = None

    @property
    def unit(self) -> np.ndarray:
        if self._unit is None:
            self._unit = self.x / np.where(self.length > 0, self.length, 1.0)[:, None]
        return self._unit


def _products(q: Pack, rows: np.ndarray, b: Pack, cols: np.ndarray | slice) -> np.ndarray:
    """Exact integer products; in doubles where these hold all sums."""
    kind = np.float64 if q.largest * b.largest * b.dim < 2**53 else np.int64
    return q.x[rows].astype(kind) @ b.x[cols].astype(kind).T


def _visit(q: Pack, b: Pack, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, vector of the bucket) with a product of at least the query's ``least``, and the products."""
    reach = q.length * b.longest
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(reach > 0, least / reach, np.where(least > 0, np.inf, -np.inf))
    alive = local <= 1 + SLACK
    by_coordinate = np.flatnonzero(alive & (local >= COORD_FROM))
    by_length = np.flatnonzero(alive & (local < COORD_FROM))
    found: list[tuple] = []
    if len(by_length):
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where(q.length > 0, least / q.length, -np.inf)[by_length]
        prefix = np.searchsorted(-b.length, -(shortest * (1 - SLACK) - SLACK), side="right")
        prefix[least[by_length] <= 0] = len(b.length)
        step = max(1, AT_ONCE // max(1, len(b.length)))
        order = np.argsort(prefix, kind="stable")  # queries with prefixes of about one size together
        for a in range(0, len(order), step):
            own = by_length[order[a : a + step]]
            products = _products(q, own, b, slice(0, int(prefix[order[a : a + step]].max())))
            i, j = np.nonzero(products >= least[own][:, None])
            found.append((own[i], j, products[i, j].astype(np.int64)))
    for i in by_coordinate:
        near = _feasible(q.unit[i], b, float(local[i]))
        products = _products(q, np.array([i]), b, near)[0]
        j = np.flatnonzero(products >= least[i])
        found.append((np.full(len(j), i), near[j], products[j].astype(np.int64)))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _feasible(direction: np.ndarray, b: Pack, local: float) -> np.ndarray:
    """Vectors of the bucket that may have a cosine of ``local`` with ``direction``, by its largest coordinates.

    Two unit vectors whose cosine is c differ at a coordinate by an angle of arccos(c) at most.
    """
    angle = math.acos(min(1.0, local - SLACK))
    near = np.ones(len(b.length), dtype=bool)
    for f in np.argsort(-np.abs(direction))[:FOCUS]:
        at = math.acos(max(-1.0, min(1.0, direction[f])))
        low = math.cos(min(math.pi, at + angle)) - SLACK
        high = math.cos(max(0.0, at - angle)) + SLACK
        near &= (b.unit[:, f] >= low) & (b.unit[:, f] <= high)
    return np.flatnonzero(near)


class _Best:
    """The best products of a block's queries so far, and each query's threshold."""

    def __init__(self, q: Pack, top: int, least: np.ndarray | None = None):
        self.q, self.top = q, top
        self.least = np.full(len(q.uid), NONE) if least is None else least.copy()
        self.rows = [np.zeros(0, dtype=np.int64)] * 5  # query, score, place, uid, number of the vector
        self.seen = 0

    def visit(self, b: Pack) -> None:
        i, j, score = _visit(self.q, b, self.least)
        other = b.uid[j] != self.q.uid[i]
        i, j, score = i[other], j[other], score[other]
        if len(i):
            rows = [np.concatenate(c) for c in zip(self.rows, (i, score, b.place[j], b.uid[j], self.seen + j), strict=True)]
            order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
            rows = [c[order] for c in rows]
            first = np.searchsorted(rows[0], rows[0], side="left")
            rank = np.arange(len(first)) - first
            self.rows = [c[rank < self.top] for c in rows]
            full = rank == self.top - 1
            self.least[rows[0][full]] = np.maximum(self.least[rows[0][full]], rows[1][full])
        self.seen += len(b.uid)


def _with_least(batches: Iterator[pa.RecordBatch], seeds: list[dict], top: int) -> Iterator[pa.RecordBatch]:
    """Query blocks with every query's first threshold, and the shortest length that any of them needs."""
    packs = [Pack(s) for s in seeds]
    for batch in batches:
        least, need = [], []
        for row in batch.to_pylist():
            q = Pack(row)
            best = _Best(q, top)
            for b in packs:
                if b.dim == q.dim:
                    best.visit(b)
            least.append(best.least.tobytes())
            with np.errstate(divide="ignore", invalid="ignore"):
                short = np.where((q.length > 0) & (best.least > 0), best.least / q.length, 0.0)
            need.append(float(short.min()))
        yield pa.record_batch([*batch.columns, pa.array(least, pa.binary()), pa.array(need, pa.float64())],
                              names=[*batch.schema.names, "least", "need"])


def _cell(queries: pa.Table, buckets: pa.Table, top: int, kind: pa.DataType) -> pa.Table:
    """The best products of every query of a cell among its buckets, longest vectors first."""
    def ids(t: pa.Table, k: int) -> pa.Array:
        return pa.array(t.column("ids")[k].as_py(), kind)

    packs = [Pack(r, ids(buckets, k)) for k, r in enumerate(buckets.drop_columns(["ids"]).to_pylist())]
    packs.sort(key=lambda b: -b.longest)
    out = []
    for k, row in enumerate(queries.drop_columns(["ids"]).to_pylist()):
        q = Pack(row, ids(queries, k))
        best = _Best(q, top, np.frombuffer(row["least"], dtype=np.int64))
        own = [b for b in packs if b.dim == q.dim]
        for b in own:
            best.visit(b)
        if len(best.rows[0]):
            i, score, _, uid, number = best.rows
            out.append([pa.array(q.uid[i]), q.ids.take(pa.array(i)), pa.array(uid),
                        pa.concat_arrays([b.ids for b in own]).take(pa.array(number)), pa.array(score)])
    kinds = [pa.int64(), kind, pa.int64(), kind, pa.int64()]
    return pa.table([pa.chunked_array([o[c] for o in out], type=t) for c, t in enumerate(kinds)],
                    names=["query", "query_id", "uid", "vec_id", "score"])


def _packed(rows: DataFrame, per_part: int, size: int, kind: str) -> DataFrame:
    """Packs of ``rows`` by falling length; ``part`` is the range they come from."""
    n = rows.count()
    order = [F.col("dim"), F.desc("length"), F.col("uid")]
    spread = rows.repartitionByRange(max(1, math.ceil(n / per_part)), *order).sortWithinPartitions(*order)
    return map_batches(spread, lambda it: _pack(it, size), PACK.format(kind)).withColumn(
        "part", F.spark_partition_id()).checkpoint()


def _each(parts: DataFrame) -> Column:
    """All values of ``part``, one row each."""
    return F.explode(F.sequence(F.lit(0), F.lit(parts.agg(F.max("part")).first()[0])))


def search(vectors: DataFrame, every: int = EVERY, top: int = TOP, scale: int = SCALE, bucket: int = BUCKET,
           shelf: int = SHELF, query_block: int = QUERY_BLOCK, seeds: int = SEEDS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` highest products of every query."""
    prepare(vectors.sparkSession)
    kind = dict(vectors.dtypes)["vec_id"]
    value = F.col("embedding")
    bad = F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    usable = vectors.filter(value.isNotNull() & (F.size(value) > 0) & ~bad).select(
        F.monotonically_increasing_id().alias("uid"), "vec_id", doc_order(F.col("vec_id")).alias("place"),
        value.cast("array<double>").alias("vector"))
    rows = map_batches(usable, lambda it: _integers(it, scale),
                       f"uid long, vec_id {kind}, place long, dim int, length double, vector binary").checkpoint()
    buckets = _packed(rows, shelf, bucket, kind)
    # rows of fixed number and size; as packs of one vector each
    longest = rows.orderBy(F.desc("length"), "uid").limit(seeds).collect()
    first: dict[int, list] = {}
    for r in longest:
        first.setdefault(r["dim"], []).append(r)
    seed_packs = [{"dim": d, "longest": rs[0]["length"], "places": np.array([r["place"] for r in rs]).tobytes(),
                   "uids": np.array([r["uid"] for r in rs]).tobytes(),
                   "lengths": np.array([r["length"] for r in rs]).tobytes(),
                   "vectors": b"".join(bytes(r["vector"]) for r in rs)} for d, rs in first.items()]
    blocks = _packed(rows.filter(F.pmod("vec_id", F.lit(every)) == 0), query_block, query_block, kind)
    blocks = map_batches(blocks, lambda it: _with_least(it, seed_packs, top),
                         PACK.format(kind) + ", part int, least binary, need double").checkpoint()
    # the shortest length that any query of a dimension needs: one number per dimension
    needs = [(r["dim"], r["need"] * (1 - SLACK) - SLACK) for r in blocks.groupBy("dim").agg(F.min("need").alias("need")).collect()]
    if not needs:
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    need = F.element_at(F.create_map(*[F.lit(v) for pair in needs for v in pair]), F.col("dim"))
    left = blocks.withColumnRenamed("part", "block").withColumn("shelf", _each(buckets))
    right = buckets.filter(F.col("longest") >= need).withColumnRenamed("part", "shelf").withColumn("block", _each(blocks))
    arrow = to_arrow_type(rows.schema["vec_id"].dataType)
    found = left.groupBy("block", "shelf").cogroup(right.groupBy("block", "shelf")).applyInArrow(
        lambda q, b: _cell(q, b, top, arrow), f"query long, query_id {kind}, uid long, vec_id {kind}, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), doc_order(F.col("vec_id")), "uid")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))

