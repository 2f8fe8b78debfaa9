"""Ranked lexical search by pipelined term partitioning (operator 12).

The terms of all items are dealt to a few owners, the rarest to the first. An owner holds the postings of its terms, cut
into shards of documents. For every block of items and shard, bundles travel from owner to owner: a bundle is
an item's sparse accumulators, (document, score so far), and each stage cogroups them with the owner's postings
of that shard and adds its integer contributions. The last stage selects a shard's best, and Spark the best of all shards.

One pass over the texts makes the index: a portion of a task's input (about 4 MB of text) is a shard, so every
group is bounded, however common a term or large the corpus. It keeps postings whose term falls into one of
``SLOTS`` hash slots that the items use (a fixed-size filter); the join with the terms is exact.

A document leaves a bundle only when it cannot matter: its score plus all that later owners could add (each less than
1,000,000 times the weight) is below the tenth best score the shard already has. Scores never fall, so the
shard's ten best are always exact.

Cases: null and empty texts have no terms. Rows that share an item_id, null included, are one item with the terms of all
of them. Every row of documents is a document; a null doc_id sorts last. Terms that weigh 0 add nothing. Items without
a document above 0 have no rows; an empty table on either side gives none. Very long texts are counted piece by piece.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from regfold.llm.common import PORTION_BYTES, doc_order, map_batches, portions, prepare
from regfold.session import staging_dir

TOP = 10
OWNERS = 4
BLOCK_ITEMS = 256
SLOTS = 1 << 20
_ASCII_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Bytes of terms (ASCII letters and digits, all of other characters), with A-Z lower-cased; the rest become spaces.
FOLD = bytes(ord(chr(b).lower()) if b in _ASCII_TERM else b if b >= 128 else 32 for b in range(256))


def count_terms(text: bytes | None) -> Counter:
    """Terms of a text and their numbers."""
    counts: Counter = Counter()
    text, at = (text or b"").translate(FOLD), 0
    while at < len(text):
        stop = at + PORTION_BYTES
        if stop < len(text):
            cut = text.rfind(b" ", at, stop)
            stop = cut if cut > at else (text.find(b" ", stop) + 1 or len(text) + 1) - 1
        counts.update(text[at:stop].split())
        at = stop
    return counts


def _slot(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) % SLOTS


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in portions(batches):
        for i, text in enumerate(part.column(1).to_pylist()):
            terms = list(count_terms(text))
            yield pa.record_batch([part.column(0).take(pa.array([i] * len(terms), pa.int32())), pa.array(terms, pa.binary()),
                                   pa.array([_slot(t) for t in terms], pa.int32())], names=["item_id", "term", "slot"])


def _index(batches: Iterator[pa.RecordBatch], used: bytes) -> Iterator[pa.RecordBatch]:
    """Per shard: one row with its documents in order of id, and one per term with its postings."""
    from pyspark import TaskContext

    shard = TaskContext.get().partitionId() << 32
    bits = np.unpackbits(np.frombuffer(used, dtype=np.uint8))
    wanted: dict[bytes, bool] = {}
    for part in portions(batches):
        if len(wanted) > 500_000:
            wanted.clear()
        part = part.take(pa.array(np.argsort(part.column(1).to_numpy(), kind="stable")))
        lists: dict[bytes, tuple[list, list, list]] = {}
        n_docs = n_terms = 0
        for i, text in enumerate(part.column(2)):
            counts = count_terms(text.as_py())
            n = counts.total()
            n_docs += n > 0
            n_terms += n
            for term, tf in counts.items():
                keep = wanted.get(term)
                if keep is None:
                    keep = wanted[term] = bool(bits[_slot(term)])
                if keep:
                    docs, tfs, sizes = lists.setdefault(term, ([], [], []))
                    docs.append(i)
                    tfs.append(tf)
                    sizes.append(n)
        terms = sorted(lists)
        k = len(terms) + 1
        packed = [[np.array(lists[t][c], dtype=np.int32).tobytes() for t in terms] for c in range(3)]
        ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
        yield pa.record_batch(
            [pa.array([shard] * k, pa.int64()), pa.array([None, *terms], pa.binary()),
             pa.array([n_docs, *[len(lists[t][0]) for t in terms]], pa.int64()),
             pa.array([n_terms] + [None] * (k - 1), pa.int64()),
             *[pa.array([None, *column], pa.binary()) for column in packed],
             pa.concat_arrays([ids, pa.nulls(k - 1, ids.type)])],
            names=["shard", "term", "df", "n_terms", "docs", "tfs", "sizes", "ids"])
        shard += 1


def _added(segments: pa.Table, bundles: pa.Table, n_docs: int, n_terms: int, top: int):
    """The accumulators of a group after its owner's contributions: items, rests, and a matrix item x document."""
    rest: dict = {}
    for row in segments.column("items").to_pylist():
        rest |= {i["item_id"]: i["rest"] for i in row}
    carried = bundles.column("item_id").to_pylist()
    for item, left in zip(carried, bundles.column("rest").to_pylist(), strict=True):
        rest.setdefault(item, left)
    at = {item: k for k, item in enumerate(rest)}
    docs = [[np.frombuffer(b, dtype=np.int32) for b in t.column("docs").to_pylist()] for t in (segments, bundles)]
    width = max((int(d.max(initial=-1)) for side in docs for d in side), default=-1) + 1
    scores = np.zeros((len(at), width), dtype=np.int64)
    for item, own, score in zip(carried, docs[1], bundles.column("scores").to_pylist(), strict=True):
        scores[at[item], own] += np.frombuffer(score, dtype=np.int64)
    for own, *row in zip(docs[0], *(segments.column(c).to_pylist() for c in ("tfs", "sizes", "weight", "items")), strict=True):
        tf, size = (np.frombuffer(b, dtype=np.int32).astype(np.int64) for b in row[:2])
        m = 100 - 90 + 90 * size * n_docs // n_terms
        gain = row[2] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        for i in row[3]:
            scores[at[i["item_id"]], own] += gain
    return at, rest, scores


def _best(score: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` highest scores above 0, the earlier of equal ones first."""
    own = np.flatnonzero(score > 0)
    if len(own) > top:
        own = own[score[own] >= np.partition(score[own], -top)[-top]]
    return own[np.lexsort((own, -score[own]))][:top]


def _carry(segments: pa.Table, bundles: pa.Table, n_docs: int, n_terms: int, top: int, kind: pa.DataType) -> pa.Table:
    at, rest, scores = _added(segments, bundles, n_docs, n_terms, top)
    block, shard = ((segments if segments.num_rows else bundles).column(c)[0].as_py() for c in ("block", "shard"))
    rows = []
    for item, k in at.items():
        own = np.flatnonzero(scores[k])
        if len(own) > top:
            floor = np.partition(scores[k, own], -top)[-top]
            own = own[scores[k, own] + 1_000_000 * rest[item] >= floor]
        rows.append((block, shard, item, rest[item], own.astype(np.int32).tobytes(), scores[k, own].tobytes()))
    cols = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), kind, pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                    names=["block", "shard", "item_id", "rest", "docs", "scores"])


def _select(segments: pa.Table, bundles: pa.Table, n_docs: int, n_terms: int, top: int, kind: pa.DataType) -> pa.Table:
    at, _, scores = _added(segments, bundles, n_docs, n_terms, top)
    shard = (segments if segments.num_rows else bundles).column("shard")[0].as_py()
    found = [(item, int(d), int(scores[k, d])) for item, k in at.items() for d in _best(scores[k], top)]
    items, docs, score = zip(*found, strict=True) if found else ([], [], [])
    return pa.table([pa.array([shard] * len(found), pa.int64()), pa.array(items, kind), pa.array(docs, pa.int32()),
                     pa.array(score, pa.int64())], names=["shard", "item_id", "doc", "score"])


def _owner(step: Callable, *known) -> Callable:
    return lambda segments, bundles: step(segments, bundles, *known)


def _owners(terms: DataFrame, owners: int) -> list[int]:
    """Owner of each class of terms (by the power of two of their frequency): about equal numbers of postings."""
    bulk = dict(terms.groupBy(F.floor(F.log2("df")).cast("int").alias("c")).agg(F.sum("df")).collect())
    total, before, out = sum(bulk.values()), 0, []
    for c in range(max(bulk, default=-1) + 1):
        out.append(min(owners - 1, owners * before // total))
        before += bulk.get(c, 0)
    return out


def search(items: DataFrame, docs: DataFrame, top: int = TOP, owners: int = OWNERS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring documents of every item."""
    spark = prepare(docs.sparkSession)
    item_kind, doc_kind = dict(items.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]
    empty = f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long"
    wanted = map_batches(items.select("item_id", F.col("text").cast("binary").alias("text")), _item_terms,
                         f"item_id {item_kind}, term binary, slot int").distinct().checkpoint()
    slots = wanted.select("slot").distinct().toPandas()["slot"].to_numpy()  # at most SLOTS numbers
    used = np.zeros(SLOTS, dtype=bool)
    used[slots] = True
    bits = np.packbits(used).tobytes()

    root = staging_dir(spark, "lexical")
    src = docs.select("doc_id", doc_order(F.col("doc_id")).alias("place"), F.col("text").cast("binary").alias("text"))
    schema = (f"shard long, term binary, df long, n_terms long, docs binary, tfs binary, sizes binary, ids array<{doc_kind}>")
    map_batches(src.select("doc_id", "place", "text"), lambda it: _index(it, bits), schema).write.parquet(
        os.path.join(root, "index"))
    index = spark.read.schema(schema).parquet(os.path.join(root, "index"))
    shards, postings = index.filter("term is null"), index.filter("term is not null")
    n_docs, n_terms = shards.agg(F.sum("df"), F.sum("n_terms")).first()
    if not n_docs or not len(slots):
        return spark.createDataFrame([], empty)

    known = postings.groupBy("term").agg(F.sum("df").alias("df")).join(wanted.select("term").distinct(), "term")
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    known = known.withColumn("weight", weight).filter("weight > 0").checkpoint()
    owner_of = _owners(known, owners)
    if not owner_of:
        return spark.createDataFrame([], empty)
    owner = F.element_at(F.array(*map(F.lit, owner_of)), F.floor(F.log2("df")).cast("int") + 1)
    later = Window.partitionBy("item_id").orderBy("owner").rangeBetween(1, Window.unboundedFollowing)
    n_blocks = math.ceil(wanted.select("item_id").distinct().count() / block_items)
    block = F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(n_blocks))
    asked = (wanted.join(known.withColumn("owner", owner), "term")
             .withColumn("rest", F.coalesce(F.sum("weight").over(later), F.lit(0)).cast("long"))
             .groupBy("owner", "term", "weight", block.alias("block"))
             .agg(F.collect_list(F.struct("item_id", "rest")).alias("items")))
    (postings.join(asked, "term").select("owner", "block", "shard", "weight", "items", "docs", "tfs", "sizes")
     .write.partitionBy("owner").parquet(os.path.join(root, "segments")))
    segments = spark.read.parquet(os.path.join(root, "segments"))

    kind = to_arrow_type(items.schema["item_id"].dataType)
    bundles = spark.createDataFrame([], f"block long, shard long, item_id {item_kind}, rest long, docs binary, scores binary")
    at = ["block", "shard"]
    for k in range(owners):
        last = k == owners - 1
        own = segments.filter(F.col("owner") == k).drop("owner")
        bundles = own.groupBy(*at).cogroup(bundles.groupBy(*at)).applyInArrow(
            _owner(_select if last else _carry, n_docs, n_terms, top, kind),
            f"shard long, item_id {item_kind}, doc int, score long" if last else
            f"block long, shard long, item_id {item_kind}, rest long, docs binary, scores binary")
    found = bundles.join(shards.select("shard", "ids"), "shard").select(
        "item_id", F.element_at("ids", F.col("doc") + 1).alias("doc_id"), "score", "shard", "doc")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), doc_order(F.col("doc_id")), "shard", "doc")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))

