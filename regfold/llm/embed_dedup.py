"""Embedding near-dedup by an exact metric range join (operator 1).

Unit vectors with cosine >= t lie within r = sqrt(2 - 2t) of each other. Inside each label, pivots
(a sample of its vectors) cut the space into cells; a vector's home is its nearest pivot. If x with
home p has a partner y with home q, the triangle inequality gives d(x, q) <= d(x, p) + 2r, and as y
lies on q's side of the plane between p and q, x lies within r of that plane; the same holds for y and p. So of two
cells only the vectors that pass both tests are compared.

Vectors travel once, to their home, as they are. A cell larger than ``BLOCK`` is cut into blocks. Each block is compared
with itself where it arrives and, unless its label has no other block, written to a file of its own in the shared staging folder.
Each pair of blocks of a label is a unit of work that reads its two files, so nothing is copied for it: the
disk holds each vector a fixed number of times, whatever the number of blocks, and a task two blocks at once. Only
counts of links and one tree of links per pair leave a comparison. Each pair of vectors is compared once.

Equal vectors are one vector with several rows.

Pivots: one for every ``CELL`` vectors of a label that holds more than ``CELL``, and ``MAX_PIVOTS``
in all (their broadcast is bounded by that); a label beyond it has larger cells, hence more blocks.
Bound or sample never decide what is found.

Cases: rows whose label or vector is null, or whose vector is empty, zero or holds null or
non-finite components, link with nothing. Vectors of different length never link. Ids may be null or
repeat; component ids are the smallest id that is not null. Extra columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfold.llm.common import link_tree, map_batches, prepare, row_groups
from regfold.llm.components import link_classes
from regfold.session import frees_shuffles, staging_dir
from regfold.sources.files import delete_folder, filesystem_for

THRESHOLD = 0.93
CELL = 2048
MAX_PIVOTS = 2048
BLOCK = 2048
SLACK = 1e-9  # on distances, against rounding
PAIRS = 64  # pairs of blocks for one task
MAX_TASKS = 20_000
FOUND = "content binary, links long, parent binary"


def _unit(vectors, dim: int) -> np.ndarray:
    x = np.asarray(vectors, dtype=np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors of a list column whose lists all hold ``dim`` numbers."""
    return _unit(column.flatten().to_numpy(zero_copy_only=False), dim)


def _homes(batches: Iterator[pa.RecordBatch], pivots: dict) -> Iterator[pa.RecordBatch]:
    """Each vector with its cell: the nearest pivot of its label."""
    for batch in batches:
        for a in range(0, batch.num_rows, 2000):
            part = batch.slice(a, 2000)
            cell = np.zeros(part.num_rows, dtype=np.int32)
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                groups.setdefault(key, []).append(i)
            for (label, dim), members in groups.items():
                centres = pivots.get((label, dim))
                if centres is not None:
                    x = _vectors(part.column(4).take(pa.array(members)), dim)
                    cell[members] = np.sqrt(np.maximum(0.0, 2 - 2 * (x @ centres.T))).argmin(axis=1)
            yield pa.record_batch([*part.columns, pa.array(cell)], names=[*part.schema.names, "cell"])


def _near(x: np.ndarray, centres: np.ndarray | None, home: int, other: int, radius: float) -> np.ndarray:
    """Which of the vectors of cell ``home`` may have partners in cell ``other``."""
    if home == other or centres is None:
        return np.arange(len(x))
    p, q = centres[home], centres[other]
    to_home, to_other = np.maximum(0.0, 2 - 2 * (x @ p)), np.maximum(0.0, 2 - 2 * (x @ q))
    between = math.sqrt(max(0.0, 2 - 2 * float(p @ q)))
    plane = to_other - to_home <= 2 * between * (radius + SLACK) + SLACK
    return np.flatnonzero(plane & (np.sqrt(to_other) <= np.sqrt(to_home) + 2 * radius + SLACK))


def _linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    linked = np.zeros((len(x), len(y)), dtype=bool)
    for a in range(0, len(x), 256):
        linked[a : a + 256] = x[a : a + 256] @ y.T >= threshold
    return linked


def _found(linked: np.ndarray, left: np.ndarray, right: np.ndarray, content: list, links: np.ndarray) -> list[pa.Array]:
    """The columns ``FOUND`` of the contents that are linked."""
    parent: list[bytes | None] = [None] * len(content)
    for a, b in link_tree(linked, left, right, len(content)):
        parent[a] = content[b]
    keep = [k for k in range(len(content)) if links[k] or parent[k] is not None]
    return [pa.array([content[k] for k in keep], pa.binary()), pa.array(links[keep], pa.int64()),
            pa.array([parent[k] for k in keep], pa.binary())]


def _blocks(batches: Iterator[pa.RecordBatch], folder: str, threshold: float, pivots: dict) -> Iterator[pa.RecordBatch]:
    """What each block's own vectors link, and a row that names the block's file if its label has other blocks."""
    for group in row_groups(batches, ["label", "dim", "cell", "block"]):
        label, dim, cell = (group.column(c)[0].as_py() for c in ("label", "dim", "cell"))
        content, n_rows = group.column("content").to_pylist(), group.column("n_rows").to_numpy()
        vectors = group.column("vector").combine_chunks()
        x = _vectors(vectors, dim)
        linked = _linked(x, x, threshold)
        np.fill_diagonal(linked, False)
        every = np.arange(len(content))
        found = _found(linked, every, every, content, linked @ n_rows)
        n, names = len(found[0]), []
        if (label, dim) in pivots or group.column("n_blocks")[0].as_py() > 1:
            names = [f"{uuid.uuid4().hex}.arrow"]  # of this attempt: only files that a committed row names are read
            filesystem, root = filesystem_for(folder)
            filesystem.create_dir(root, recursive=True)
            kept = pa.record_batch([group.column("content").combine_chunks(), group.column("n_rows").combine_chunks(), vectors],
                                   names=["content", "n_rows", "vector"])
            with filesystem.open_output_stream(f"{root}/{names[0]}") as out, pa.ipc.new_file(out, kept.schema) as file:
                file.write_batch(kept)
        of = [pa.array([None] * n + v * len(names), t) for v, t in (
            ([label], group.schema.field("label").type), ([dim], pa.int32()), ([cell], pa.int32()), (names, pa.string()))]
        empty = [pa.nulls(len(names), c.type) for c in found]
        yield pa.record_batch([*[pa.concat_arrays([c, e]) for c, e in zip(found, empty, strict=True)], *of],
                              names=["content", "links", "parent", "label", "dim", "cell", "file"])


def _read_block(folder: str, name: str, dim: int) -> tuple[list, np.ndarray, np.ndarray]:
    filesystem, root = filesystem_for(folder)
    with filesystem.open_input_file(f"{root}/{name}") as data:
        block = pa.ipc.open_file(data).get_batch(0)
    return block.column(0).to_pylist(), block.column(1).to_numpy(), _vectors(block.column(2), dim)


def _compare(batches: Iterator[pa.RecordBatch], folder: str, threshold: float, pivots: dict,
             radius: float) -> Iterator[pa.RecordBatch]:
    """What the vectors of two blocks link with each other."""
    held, first = None, None
    for batch in batches:
        for label, dim, i, j, p, q in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held != i:
                held, first = i, _read_block(folder, i, dim)
            centres = pivots.get((label, dim))
            left = _near(first[2], centres, p, q, radius)
            if not len(left):
                continue
            second = _read_block(folder, j, dim)
            right = _near(second[2], centres, q, p, radius)
            linked = _linked(first[2][left], second[2][right], threshold)
            if not linked.any():
                continue
            content = [first[0][k] for k in left] + [second[0][k] for k in right]
            links = np.concatenate([linked @ second[1][right], first[1][left] @ linked])
            found = _found(linked, np.arange(len(left)), len(left) + np.arange(len(right)), content, links)
            yield pa.record_batch(found, names=["content", "links", "parent"])


def _pivots(distinct: DataFrame, cell: int, max_pivots: int) -> dict:
    """Pivots by (label, dim) for labels with more than ``cell`` vectors; at most about ``max_pivots`` in all."""
    sizes = distinct.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell)
    big = sizes.orderBy(F.desc("n"), "label", "dim").limit(max_pivots // 2).collect()
    wanted = sum(math.ceil(r["n"] / cell) for r in big)
    share = min(1.0, max_pivots / max(1, wanted))
    out: dict = {}
    if not big:
        return out
    rate = [(r["label"], r["dim"], max(2, math.ceil(math.ceil(r["n"] / cell) * share)), r["n"]) for r in big]
    kind = dict(distinct.dtypes)["label"]
    rates = distinct.sparkSession.createDataFrame(rate, f"label {kind}, dim int, k long, n long")
    chance = F.pmod(F.xxhash64("content"), F.lit(1_000_000)) < F.col("k") * 1_000_000 / F.col("n")
    picked = (distinct.join(F.broadcast(rates), ["label", "dim"]).filter(chance)
              .select("label", "dim", "vector", "content").orderBy("content").limit(2 * max_pivots).collect())
    for r in picked:
        out.setdefault((r["label"], r["dim"]), []).append(r["vector"])
    return {key: _unit(v, key[1]) for key, v in out.items() if len(v) > 1}


@frees_shuffles
def _links(spark: SparkSession, rows: DataFrame, threshold: float, cell: int, block: int, max_pivots: int) -> DataFrame:
    """Links and a tree of them per content, from every comparison (``FOUND``), checkpointed."""
    kinds = dict(rows.dtypes)
    kind, vector = kinds["label"], kinds["vector"]
    distinct = (rows.filter("content is not null").groupBy("content", "label", F.size("vector").alias("dim"))
                .agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n_rows")).checkpoint())
    radius = math.sqrt(2 - 2 * threshold)
    folder = staging_dir(spark, "embed-dedup")
    pivots = _pivots(distinct, cell, max_pivots)
    homes = map_batches(distinct.select("label", "dim", "content", "n_rows", "vector"), lambda it: _homes(it, pivots),
                        f"label {kind}, dim int, content binary, n_rows long, vector {vector}, cell int")
    # a row for every ``block`` vectors at most
    large = (homes.groupBy("label", "dim", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
             .withColumn("n_blocks", F.ceil(F.col("n") / block)).drop("n"))
    order = ["label", "dim", "cell", "block"]
    blocks = (homes.join(F.broadcast(large), ["label", "dim", "cell"], "left")
              .withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1).cast("long")))
              .withColumn("block", F.pmod(F.xxhash64("content"), "n_blocks"))
              .repartition(*order).sortWithinPartitions(*order))
    own = map_batches(blocks, lambda it: _blocks(it, folder, threshold, pivots),
                      f"{FOUND}, label {kind}, dim int, cell int, file string").checkpoint()
    found = own.filter("file is null").select("content", "links", "parent")
    files = own.filter("file is not null").select("label", "dim", "cell", "file")
    sizes = files.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    n_pairs = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0]
    if n_pairs:
        pairs = files.select("label", "dim", F.col("cell").alias("p"), F.col("file").alias("i")).join(
            files.select("label", "dim", F.col("cell").alias("q"), F.col("file").alias("j")), ["label", "dim"]).filter("i < j")
        least = min(n_pairs, int(spark.conf.get("spark.sql.shuffle.partitions")))
        n_tasks = int(min(MAX_TASKS, max(least, math.ceil(n_pairs / PAIRS))))
        dealt = pairs.select("label", "dim", "i", "j", "p", "q").repartition(n_tasks, "i", "j").sortWithinPartitions("i")
        found = found.unionByName(map_batches(dealt, lambda it: _compare(it, folder, threshold, pivots, radius), FOUND).checkpoint())
    delete_folder(folder)
    return found


def embedding_classes(vectors: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, block: int = BLOCK,
                      max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    spark = prepare(vectors.sparkSession)
    value = F.col("embedding")
    bad = F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    usable = (F.col("label").isNotNull() & value.isNotNull() & (F.size(value) > 0) & ~bad
              & F.exists(value, lambda v: v != 0))
    key = F.unhex(F.md5(F.concat_ws("|", F.col("label").cast("string"), value.cast("string"))))
    # floats stay floats on the way, which halves them; every computation is in doubles
    vector = value if dict(vectors.dtypes)["embedding"] == "array<float>" else value.cast("array<double>")
    rows = vectors.select("vec_id", "label", vector.alias("vector"), F.when(F.coalesce(usable, F.lit(False)), key).alias("content"))
    found = _links(spark, rows, threshold, cell, block, max_pivots)
    classes = link_classes(rows.select(F.col("vec_id").alias("id"), "content"), found)
    return classes.select(F.col("id").alias("vec_id"), "n_links", F.col("class_id").alias("component_id"),
                          F.col("class_id").eqNullSafe(F.col("id")).alias("kept"))
