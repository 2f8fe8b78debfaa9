"""N-gram Jaccard join by MinHash banding (operator 8).

Documents are sets of five-word shingles; two link if the Jaccard similarity of their sets is 0.8
or more. Band and row counts follow from the target recall at the threshold. Documents are shuffled
on band hashes; those that share a band fall into one candidate cluster, and inside a cluster all
pairs are compared on their full shingle sets. Only counts of links and one tree of links per task
leave a comparison, never the pairs.

* Equal texts count as one text with several rows: only distinct texts are banded and compared.
* A large cluster is cut into blocks by a hash of the text, and every pair of blocks is a task of its
  own, so a group that holds a third of all rows spreads over the cluster.

Cases: a text of fewer than five words is one shingle (all its words); null texts and texts without
words link with nothing. Rows that repeat a text link with each other. Ids may be null or repeat: a
class id is the smallest id of its class that is not null. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import factorize, link_tree, map_batches, mix64, portions, prepare, rolling_hash, row_groups, unused
from regfold.llm.components import components, link_classes

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 320
BLOCK_SHINGLES = 1_000_000  # of one block of a cluster
BLOCK_TEXTS = 1500
COLUMNS = 4096  # shingles counted at once in a comparison


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, hence fewest false candidates, that reach ``recall`` at
    ``threshold`` with at most ``hashes`` hash functions."""
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= hashes:
            best = (bands, rows)
    return best


def _shingles(docs: list[bytes]) -> list[np.ndarray]:
    """Distinct 64-bit shingle hashes of each text, sorted."""
    split = [d.split() for d in docs]
    words = [w for s in split for w in s]
    if not words:
        return [np.zeros(0, dtype=np.uint64)] * len(docs)
    ids, uniques = factorize(words)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in uniques], dtype=np.uint64)[ids]
    runs = rolling_hash(hashes, WIDTH)
    out, at = [], 0
    for s in split:
        n = len(s)
        if n >= WIDTH:
            out.append(np.unique(runs[at : at + n - WIDTH + 1]))
        else:
            out.append(rolling_hash(hashes[at : at + n], n) if n else np.zeros(0, dtype=np.uint64))
        at += n
    return out


def _bands(batches: Iterator[pa.RecordBatch], n_bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    random = np.random.Generator(np.random.PCG64(20240130))
    mult = random.integers(0, 2**32, n_bands * rows, dtype=np.uint32) | np.uint32(1)
    add = random.integers(0, 2**32, n_bands * rows, dtype=np.uint32)
    fold = (random.integers(0, 2**63, rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
    band_no = mix64(np.arange(1, n_bands + 1, dtype=np.uint64))
    for part in portions(batches):
        n_words, out = [], []
        raw = [t or b"" for t in part.column(2).to_pylist()]
        with np.errstate(over="ignore"):
            for shingles in _shingles(raw):
                n_words.append(len(shingles))
                if not len(shingles):
                    out.append(None)
                    continue
                x = (shingles >> np.uint64(32)).astype(np.uint32)
                low = np.full(len(mult), 0xFFFFFFFF, dtype=np.uint32)
                for a in range(0, len(x), 2048):
                    values = x[None, a : a + 2048] * mult[:, None]
                    values ^= values >> np.uint32(15)
                    values *= np.uint32(0x2C1B3C6D)
                    values += add[:, None]
                    low = np.minimum(low, values.min(axis=1))
                signature = low.reshape(n_bands, rows).astype(np.uint64)
                out.append(mix64((mix64(signature + fold[None, :]) * fold[None, :]).sum(axis=1) ^ band_no).view(np.int64))
        yield pa.record_batch([part.column(0), part.column(1), pa.array(n_words, pa.int64()),
                               pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "content", "n_shingles", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in portions(batches):
        at = part.schema.get_field_index("text")
        sets = [s.tobytes() for s in _shingles(part.column(at).to_pylist())]
        names = [n for n in part.schema.names if n != "text"]
        yield pa.record_batch([*(part.column(part.schema.get_field_index(n)) for n in names),
                               pa.array(sets, pa.binary())], names=[*names, "shingles"])


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the ``left`` sets with the ``right`` ones."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = column.ravel()
    shared = count[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1].ravel()
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        here = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        here[owner[lo:hi], column[lo:hi] - a] = 1
        out += here[left] @ here[right].T
    return out


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for group in row_groups(batches, ["cluster", "i", "j"]):
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        content = group.column("content").to_pylist()
        n_rows = group.column("n_rows").to_numpy()
        block = group.column("block").to_numpy()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("shingles").to_pylist()]
        size = np.array([len(s) for s in sets])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):
            continue
        common = _common(sets, left, right)
        linked = common >= threshold * (size[left][:, None] + size[right][None, :] - common) - 1e-9
        if i == j:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(sets), dtype=np.int64)
        links[left] += linked @ n_rows[right]
        if i != j:
            links[right] += n_rows[left] @ linked
        parent: list[bytes | None] = [None] * len(sets)
        for a, b in link_tree(linked, left, right, len(sets)):
            parent[a] = content[b]
        keep = np.flatnonzero(links)
        yield pa.record_batch([pa.array([content[k] for k in keep], pa.binary()), pa.array(links[keep], pa.int64()),
                               pa.array([parent[k] for k in keep], pa.binary())],
                              names=["content", "links", "parent"])


def signatures(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, content (MD5 of the text), n_shingles and band hashes of every row."""
    n_bands, rows = plan_bands(threshold, recall)
    kind = dict(docs.dtypes)["doc_id"]
    src = docs.select("doc_id", F.unhex(F.md5("text")).alias("content"), F.col("text").cast("binary").alias("text"))
    return map_batches(src, lambda it: _bands(it, n_bands, rows),
                       f"doc_id {kind}, content binary, n_shingles long, bands array<long>")


def candidate_clusters(rows: DataFrame) -> DataFrame:
    """``node`` and ``cluster`` of texts that share a band, directly or over others.

    Nodes are 64 bits of the content key; should two texts share them, their clusters merely merge.
    """
    banded = rows.select(_node("content"), F.explode("bands").alias("band"))
    shared = (banded.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .filter("low < high").select("band", "low"))
    links = banded.join(shared, "band").filter("node != low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    return components(links).withColumnRenamed("root", "cluster")


def _node(column: str):
    return F.xxhash64(column).alias("node")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Every row's doc_id, content key, n_links (other rows linked directly), class_id and kept.

    kept holds for the rows whose id is the class id (a row of a class without ids keeps itself).
    """
    prepare(docs.sparkSession)
    rows = signatures(docs, threshold, recall).checkpoint()
    texts = (rows.filter("n_shingles > 0").groupBy("content")
             .agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("low_id"),
                  F.max("n_shingles").alias("n_shingles")))
    clusters = candidate_clusters(rows).checkpoint()
    members = texts.withColumn("node", F.xxhash64("content")).join(clusters, "node").drop("node").checkpoint()
    sizes = members.groupBy("cluster").agg(F.greatest(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS)).alias("n_blocks"))
    placed = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("content", F.lit(1)), "n_blocks"))
    # one row holds each text: the one with the smallest id
    source = docs.select("doc_id", F.unhex(F.md5("text")).alias("content"), F.col("text").cast("binary").alias("text"))
    with_text = (placed.join(source, F.col("low_id").eqNullSafe(source.doc_id)
                             & (placed.content == source.content))
                 .select("cluster", placed.content, "n_rows", "block", "n_blocks", "text")
                 .dropDuplicates(["cluster", "content"]))
    sets = map_batches(with_text, _sets,
                       "cluster long, content binary, n_rows long, block long, n_blocks long, shingles binary")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    tasks = (sets.withColumn("other", other)
             .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "content", "n_rows", "shingles"))
    found = map_batches(tasks.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j"),
                        lambda it: _verify(it, threshold), "content binary, links long, parent binary").checkpoint()
    ids = rows.select(F.col("doc_id").alias("id"), F.when(F.col("n_shingles") > 0, F.col("content")).alias("content"))
    return (link_classes(ids, found)
            .select(F.col("id").alias("doc_id"), "n_links", "class_id",
                    F.col("class_id").eqNullSafe(F.col("id")).alias("kept"), "content", "root"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without all but one of each class, with all their columns."""
    names = [f"`{c}`" for c in docs.columns]
    key, id_, content, stays, n = unused(docs, "_key", "_id", "_content", "_stays", "_n")
    judged = near_duplicates(docs, threshold, recall).filter("root is not null")
    # rows that share id and text can't be told apart: the class keeps one of its kept kinds of rows
    kinds = judged.groupBy("root", "doc_id", "content").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias(n))
    best = kinds.filter("kept").groupBy("root").agg(F.min(F.struct("doc_id", "content")).alias("best"))
    verdict = (kinds.join(best, "root")
               .withColumn(stays, F.col("kept") & F.col("best").eqNullSafe(F.struct("doc_id", "content")))
               .select(F.col("doc_id").alias(id_), F.col("content").alias(content), stays, n).checkpoint())
    src = docs.withColumn(key, F.unhex(F.md5("text")))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(content))
    left = src.join(verdict.filter(~F.col(stays)), same, "left_anti")
    repeated = verdict.filter(F.col(stays) & (F.col(n) > 1))
    if repeated.isEmpty():
        return left.select(names)
    alone = left.join(repeated, same, "left_anti").select(names)
    one = left.join(repeated, same, "left_semi").dropDuplicates(["doc_id", key]).select(names)
    return alone.unionByName(one)
