"""Substring dedup by super-k-mers (operator 3).

A window is ``WINDOW`` consecutive words of one document. A word goes if a window that covers it
has the same words as a window that starts earlier: in a smaller doc_id, or before it in the same
document. Windows are judged on the input.

Every window has a minimiser: the smallest hash among its runs of ``SEED`` words. Equal windows
have equal minimisers, so each consecutive stretch of windows with one minimiser travels as one
packed string to the minimiser's bucket. There all windows are sorted and compared word by word.
Windows that repeat inside one portion of a task's input are settled before the shuffle, and only
the earliest travels, so a passage shared by a third of all documents arrives once per portion.

A hot minimiser (a phrase that stands in a large share of all documents) would make one bucket, so one task, grow with the
input. A sample of the documents, one in ``SAMPLED``, tells which buckets will hold more than ``GROUP_BYTES``; every
task deals the windows of these to sub-buckets by a second minimiser, under another order of the hashes, which
equal windows share as well and consecutive ones mostly. The sample decides where windows are compared, never which.

A bucket that still has more than ``GROUP_BYTES`` of packed text is never held
whole: it is read in chunks of that size, each settled alone, and the windows left travel one by one to ``FANOUT``
sub-buckets by a hash of all their words, which equal windows share; and so on until every group fits.

Cases: null, empty and short texts (fewer than 20 words) keep all their words. Rows with equal
doc_id and equal text are the same document and get the same result; rows that share a doc_id but
not the text are ordered by a hash of the text. A null doc_id sorts last. Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import doc_order, factorize, first_equal, map_batches, mix64, portions, rolling_hash
from regfold.session import staging_dir

WINDOW = 20
SEED = 4
BUCKET_BYTES = 4 << 20  # input text for each bucket
SORT_WINDOWS = 4_000_000  # windows sorted at once; a larger bucket is sorted in several rounds
GROUP_BYTES = 32 << 20  # packed text of a bucket that is judged at once
FANOUT = 256  # sub-buckets of a larger one
WORDS_BYTES = 8 << 20  # packed text whose words are numbered at once
SAMPLED = 64  # one document in so many tells the hot buckets
_OTHER = np.uint64(0xA0761D6478BD642F)  # turns the order of hashes into another

PACKED = "bucket long, docs binary, hashes binary, starts binary, ends binary, words binary"
JUDGED = "doc long, text_hash long, start int, stop int, " + PACKED  # a range, or windows that travel on


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = [pa.int64(), *[pa.binary()] * 5]
    return pa.record_batch([pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)],
                           names=["bucket", "docs", "hashes", "starts", "ends", "words"])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    extra = width - have
    return np.minimum(values[: len(values) - extra], values[extra:]) if extra else values


def _ranges(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge removed windows, ordered by document and start: index of each range's first window, word after its last."""
    if not len(start):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + WINDOW)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(start)) - 1
    return heads, start[tails] + WINDOW


def _split(batches: Iterator[pa.RecordBatch], n_buckets: int, hot: dict[int, tuple[int, int]] | None = None) -> Iterator[pa.RecordBatch]:
    """Packed rows of every bucket; ``hot``: first number and count of the sub-buckets of some."""
    zstd = zstandard.ZstdCompressor(level=3)
    for part in portions(batches):
        docs = sorted(zip(*(part.column(i).to_pylist() for i in range(3)), strict=True), key=lambda r: r[:2])
        words: list[bytes] = []
        keys, sizes = [], []
        for doc, text_hash, text in docs:
            own = (text or b"").split()
            if len(own) >= WINDOW:
                words += own
                keys.append((doc, text_hash))
                sizes.append(len(own))
        if not keys:
            continue
        doc_key = np.array(keys, dtype=np.int64)
        size = np.array(sizes)
        ends = np.cumsum(size)
        begins = ends - size
        ids, uniques = factorize(words)
        word_hash = np.array([xxhash.xxh3_64_intdigest(w) for w in uniques], dtype=np.uint64)[ids]
        seeds = rolling_hash(word_hash, SEED)
        minimum = _sliding_min(seeds, WINDOW - SEED + 1)
        n_windows = size - WINDOW + 1
        starts = np.repeat(begins - np.cumsum(n_windows) + n_windows, n_windows) + np.arange(n_windows.sum())
        of_doc = np.repeat(np.arange(len(size)), n_windows)
        offset = starts - begins[of_doc]
        first = first_equal(ids, starts, WINDOW, rolling_hash(word_hash, WINDOW)[starts])
        known = first != np.arange(len(first))
        # a row that repeats an earlier one is the same document, at the same start
        known_later = known & ~((offset[first] == offset) & (doc_key[of_doc[first]] == doc_key[of_doc]).all(axis=1))
        rows: list[tuple] = []
        gone = np.flatnonzero(known_later)
        if len(gone):
            heads, stops = _ranges(of_doc[gone], offset[gone])
            at = gone[heads]
            rows.append((int(minimum[starts[0]] % np.uint64(n_buckets)), doc_key[of_doc[at], 0].tobytes(),
                         doc_key[of_doc[at], 1].tobytes(), offset[at].astype(np.int32).tobytes(),
                         stops.astype(np.int32).tobytes(), None))
        send = np.flatnonzero(~known)
        if len(send):
            at = starts[send]
            low = minimum[at]
            new = np.ones(len(send), dtype=bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1]) | (of_doc[send][1:] != of_doc[send][:-1])
            of_window = (low % np.uint64(n_buckets)).astype(np.int64)
            large = np.flatnonzero(np.isin(of_window, list(hot))) if hot else np.zeros(0, dtype=np.int64)
            if len(large):
                second = _sliding_min(mix64(seeds ^ _OTHER), WINDOW - SEED + 1)[at[large]]
                begin, count = (np.array([hot[b][k] for b in of_window[large].tolist()], dtype=np.int64) for k in (0, 1))
                of_window[large] = begin + (second % count.astype(np.uint64)).astype(np.int64)
                new[1:] |= of_window[1:] != of_window[:-1]
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:], len(send)) - 1
            bucket = of_window[heads]
            order = np.argsort(bucket, kind="stable")
            froms, tos = at[heads].tolist(), (at[tails] + WINDOW).tolist()
            bounds = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)]
            for a, b in zip(bounds, bounds[1:], strict=False):
                own = order[a:b]
                head = send[heads[own]]
                text = b"\n".join([b" ".join(words[froms[i] : tos[i]]) for i in own.tolist()])
                rows.append((int(bucket[own[0]]), doc_key[of_doc[head], 0].tobytes(),
                             doc_key[of_doc[head], 1].tobytes(), offset[head].astype(np.int32).tobytes(),
                             None, zstd.compress(text)))
        yield _packed(rows)


def _judged(ranges: tuple | None = None, onward: list[tuple] | None = None) -> pa.RecordBatch:
    """Rows of ``JUDGED``: ranges (doc, text_hash, start, stop), or packed rows."""
    if onward is None:
        kinds = [np.int64, np.int64, np.int32, np.int32]
        cols = [pa.array(np.asarray(c, dtype=t)) for c, t in zip(ranges, kinds, strict=True)]
        n = len(cols[0])
        cols += [pa.nulls(n, pa.int64()), *[pa.nulls(n, pa.binary())] * 5]
    else:
        n = len(onward)
        packed = _packed(onward)
        cols = [pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())] + packed.columns
    return pa.record_batch(cols, names=[c.split()[0] for c in JUDGED.split(", ")])


def _judge_rows(rows: list[dict], onward: bool, level: int) -> Iterator[pa.RecordBatch]:
    """Ranges of the windows of ``rows`` that repeat an earlier one there; with ``onward``, the first ones travel on."""
    unzip = zstandard.ZstdDecompressor()
    numbers: dict[bytes, int] = {}
    docs, hashes, begins, sizes, id_parts = [], [], [], [], []
    words: list[bytes] = []
    held = 0
    for k, row in enumerate(rows):
        text = unzip.decompress(row["words"])
        sizes.append(np.array([r.count(b" ") + 1 for r in text.split(b"\n")], dtype=np.int64))
        words += text.split()
        held += len(text)
        if held >= WORDS_BYTES or k == len(rows) - 1:
            ids, uniques = factorize(words)
            id_parts.append(np.array([numbers.setdefault(w, len(numbers)) for w in uniques], dtype=np.int32)[ids])
            words, held = [], 0
        docs.append(np.frombuffer(row["docs"], dtype=np.int64))
        hashes.append(np.frombuffer(row["hashes"], dtype=np.int64))
        begins.append(np.frombuffer(row["starts"], dtype=np.int32))
    if not docs:
        return
    doc, text_hash, begin, size = (np.concatenate(x) for x in (docs, hashes, begins, sizes))
    ids = np.concatenate(id_parts)
    at = np.cumsum(size) - size
    order = np.lexsort((begin, text_hash, doc))
    n_windows = (size - WINDOW + 1)[order]
    within = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    record = np.repeat(order, n_windows)
    starts = at[record] + within
    offset = begin[record] + within
    value = rolling_hash(ids, WINDOW)[starts]
    rounds = -(-len(starts) // SORT_WINDOWS)
    gone_parts, first_parts = [], []
    for r in range(rounds):
        own = np.flatnonzero(value % np.uint64(rounds) == r) if rounds > 1 else np.arange(len(starts))
        first = own[first_equal(ids, starts[own], WINDOW, value[own])]
        a, b = record[first], record[own]
        later = (doc[a] != doc[b]) | (text_hash[a] != text_hash[b]) | (offset[first] != offset[own])
        gone_parts.append(own[later])
        if onward:
            first_parts.append(own[first == own])
    gone = np.sort(np.concatenate(gone_parts))
    if len(gone):
        owner = np.cumsum(np.append(0, (np.diff(doc[record[gone]]) != 0) | (np.diff(text_hash[record[gone]]) != 0)))
        heads, stops = _ranges(owner, offset[gone])
        own = record[gone[heads]]
        yield _judged((doc[own], text_hash[own], offset[gone[heads]], stops))
    if onward:
        zstd = zstandard.ZstdCompressor(level=3)
        send = np.sort(np.concatenate(first_parts))
        words = list(numbers)
        # the same for equal windows in every task, unlike the ids
        word_hash = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)[ids]
        value = rolling_hash(word_hash, WINDOW)[starts[send]]
        digit = ((value >> np.uint64(8 * (level % 8))) % np.uint64(FANOUT)).astype(np.int64)
        by_digit = np.argsort(digit, kind="stable")
        bounds = np.searchsorted(digit[by_digit], np.arange(FANOUT + 1))
        for sub in range(FANOUT):
            own = send[by_digit[bounds[sub] : bounds[sub + 1]]]
            if len(own):
                text = b"\n".join([b" ".join([words[k] for k in ids[s : s + WINDOW].tolist()]) for s in starts[own].tolist()])
                rec = record[own]
                yield _judged(onward=[(rows[0]["bucket"] * FANOUT + sub, doc[rec].tobytes(), text_hash[rec].tobytes(),
                                       offset[own].astype(np.int32).tobytes(), None, zstd.compress(text))])


def _judge(batches: Iterator[pa.RecordBatch], level: int = 0, group_bytes: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Per bucket: the ranges of words that go, and of a bucket above ``group_bytes`` the windows that travel on."""
    held: list[dict] = []
    n_held, bucket, large = 0, None, False
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["bucket"] != bucket:
                yield from _judge_rows(held, large, level)
                held, n_held, bucket, large = [], 0, row["bucket"], False
            if row["words"] is None:
                doc, text_hash = (np.frombuffer(row[c], dtype=np.int64) for c in ("docs", "hashes"))
                yield _judged((doc, text_hash, *(np.frombuffer(row[c], dtype=np.int32) for c in ("starts", "ends"))))
                continue
            n = zstandard.frame_content_size(row["words"])
            if held and n_held + n > group_bytes:
                large = True
                yield from _judge_rows(held, large, level)
                held, n_held = [], 0
            held.append(row)
            n_held += n
    yield from _judge_rows(held, large, level)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in portions(batches):
        n_words, n_removed, kept = [], [], []
        for text, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
            words = (text or b"").split()
            n_words.append(len(words))
            if ranges:
                left, at = [], 0
                for r in sorted((r["start"], r["stop"]) for r in ranges):
                    if r[0] > at:
                        left += words[at : r[0]]
                    at = max(at, r[1])
                words = left + words[at:]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        yield pa.record_batch([part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                               pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def _sizes(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, bytes of packed text) of every row that ``_split`` would send."""
    for packed in _split(batches, n_buckets):
        size = [0 if w is None else zstandard.frame_content_size(w) for w in packed.column("words").to_pylist()]
        yield pa.record_batch([packed.column("bucket"), pa.array(size, pa.int64())], names=["bucket", "size"])


def hot_buckets(src: DataFrame, n_buckets: int, group_bytes: int = GROUP_BYTES, sampled: int = SAMPLED) -> dict[int, tuple[int, int]]:
    """Buckets that will hold more than ``group_bytes``, with the first number and the count of their sub-buckets.
    There are at most as many as the packed text has stretches of that size."""
    some = src.filter(F.pmod(F.xxhash64("doc"), F.lit(sampled)) == 0)
    sizes = map_batches(some, lambda it: _sizes(it, n_buckets), "bucket long, size long").groupBy("bucket").agg(
        (F.sum("size") * sampled).alias("size")).filter(F.col("size") > group_bytes)
    out, at = {}, n_buckets
    for r in sizes.orderBy("bucket").collect():
        n = -(-2 * r["size"] // group_bytes)
        out[r["bucket"]] = (at, n)
        at += n
    return out


def repeated_ranges(docs: DataFrame, group_bytes: int = GROUP_BYTES, sampled: int = SAMPLED) -> DataFrame:
    """Word ranges to remove: (doc, text_hash, start, stop), not merged across buckets."""
    src = docs.select(doc_order(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("text_hash"),
                      F.col("text").cast("binary").alias("text"))
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(width, -(-total // BUCKET_BYTES))
    hot = hot_buckets(src, n_buckets, group_bytes, sampled)
    packed = map_batches(src, lambda it: _split(it, n_buckets, hot), PACKED)
    root, ranges, level = staging_dir(docs.sparkSession, "repeats"), None, 0
    while True:  # a round more only for buckets that were too large in the last one
        judged = map_batches(packed.repartition("bucket").sortWithinPartitions("bucket"),
                             lambda it, k=level: _judge(it, k, group_bytes), JUDGED)
        path = os.path.join(root, str(level))
        judged.write.parquet(path)
        judged = docs.sparkSession.read.schema(JUDGED).parquet(path)
        found = judged.filter("bucket is null").select("doc", "text_hash", "start", "stop")
        ranges = found if ranges is None else ranges.unionByName(found)
        packed = judged.filter("bucket is not null").select(*[c.split()[0] for c in PACKED.split(", ")])
        level += 1
        if packed.isEmpty():
            return ranges


def remove_repeats(docs: DataFrame, group_bytes: int = GROUP_BYTES, sampled: int = SAMPLED) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) for every row."""
    ranges = (repeated_ranges(docs, group_bytes, sampled).groupBy("doc", "text_hash")
              .agg(F.collect_list(F.struct("start", "stop")).alias("ranges")))
    # the ranges grow with the input: one plan at every size
    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"), doc_order(F.col("doc_id")).alias("doc"),
                      F.xxhash64("text").alias("text_hash"))
    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(src.join(ranges.hint("merge"), ["doc", "text_hash"], "left").select("doc_id", "text", "ranges"), _cut,
                       f"doc_id {kind}, n_words long, n_removed long, kept_text string")
