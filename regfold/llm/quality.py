"""Quality rules by compression bands (operator 4).

A document compresses by a ratio: its UTF-8 bytes over their zstandard size. Natural text of a
given length falls in a band, learned from the corpus's labelled good documents (``learn_limits``; wide limits stand in
where there are none); far above it the text repeats itself, below it there is nothing to
learn (encoded or random data). The ratio of the whole text is held against the limits of its
length, and that of every ``CHUNK`` bytes of it against limits of their own (a last, shorter one against those of its
length): a document whose repetitive or incompressible
chunks make up more than ``BAD_SHARE`` of it goes too, so junk cannot hide in a long text.

Besides, base rules: fewer than 10 words, or more than a fifth of all words inside five-word
windows that occur twice or more.

Each document is judged alone, so there is no shuffle. Null text counts as empty: 0 words, base
rules fail. Texts below the first length in ``LIMITS`` have no band. Repeated rows and null ids
give a row each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import GAPS, factorize, first_equal, map_batches, portions, rolling_hash
from regfold.llm.toxicity import held_out

LEVEL = 3
CHUNK = 4096
BAD_SHARE = 0.3
REPEAT_WIDTH = 5
SYMBOLS = "#*$%&|<>"

LEAST_ROWS = 30  # a class with fewer keeps its wide limits
MARGIN = 0.03  # limits lie this share outside of the smallest and largest ratio seen

# From this many bytes on: smallest and largest ratio of natural text where labels teach nothing else. Wide, for prose of
# any vocabulary: text compresses better the longer it is, and plain English reaches 3 within 30 KB.
LIMITS = (
    (128, 0.9, 2.2),
    (256, 1.0, 2.6),
    (384, 1.1, 2.8),
    (512, 1.1, 3.0),
    (768, 1.2, 3.0),
    (1024, 1.2, 3.2),
    (1536, 1.25, 3.4),
    (2048, 1.3, 3.5),
    (3072, 1.3, 3.7),
    (4096, 1.3, 3.8),
    (6144, 1.4, 4.0),
    (8192, 1.4, 4.2),
    (16384, 1.4, 4.5),
    (65536, 1.5, 5.0),
)
CHUNK_LIMITS = (1.3, 3.8)  # of full chunks


def limits_of(size: int, limits=LIMITS) -> tuple[float, float]:
    low, high = 0.0, float("inf")
    for least, lo, hi in limits:
        if size >= least:
            low, high = lo, hi
    return low, high


def outside(data: bytes, zstd: zstandard.ZstdCompressor, limits=LIMITS, own=None) -> tuple[float, bool]:
    """The ratio, and whether it lies outside of the limits of its length (or of ``own``)."""
    ratio = len(data) / len(zstd.compress(data)) if data else 0.0
    low, high = own or limits_of(len(data), limits)
    return ratio, not low <= ratio <= high


def _repeat_words(docs: list[list[bytes]]) -> list[int]:
    """Words of each document inside windows that occur at least twice in it."""
    words = [w for d in docs for w in d]
    size = np.array([len(d) for d in docs])
    out = np.zeros(len(docs), dtype=np.int64)
    n_windows = np.maximum(size - REPEAT_WIDTH + 1, 0)
    if not n_windows.sum():
        return out.tolist()
    ids, _ = factorize(words)
    begins = np.cumsum(size) - size
    of_doc = np.repeat(np.arange(len(docs)), n_windows)
    starts = begins[of_doc] + np.arange(len(of_doc)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    with np.errstate(over="ignore"):
        value = rolling_hash(ids, REPEAT_WIDTH)[starts] ^ (of_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = first_equal(ids, starts, REPEAT_WIDTH, value, of_doc)
    later = np.flatnonzero(first != np.arange(len(first)))
    twice = np.zeros(len(first), dtype=bool)
    twice[later] = twice[first[later]] = True
    covered = np.zeros(len(words), dtype=bool)
    for j in range(REPEAT_WIDTH):
        covered[starts[twice] + j] = True
    owner = np.repeat(np.arange(len(docs)), size)
    return np.bincount(owner[covered], minlength=len(docs)).tolist()


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line.strip(GAPS):
            n += line in seen
            seen.add(line)
    return n


def _measure(batches: Iterator[pa.RecordBatch], limits, chunk_limits, chunk: int, bad_share: float) -> Iterator[pa.RecordBatch]:
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    for part in portions(batches):
        raw = [t or b"" for t in part.column(1).to_pylist()]
        docs = [t.split() for t in raw]
        repeat = _repeat_words(docs)
        rows = []
        for data, words, n_repeat in zip(raw, docs, repeat, strict=True):
            text = data.decode("utf-8", "replace")
            ratio, bad = outside(data, zstd, limits)
            flags = [outside(data[i : i + chunk], zstd, limits, chunk_limits if i + chunk <= len(data) else None)[1]
                     for i in range(0, len(data), chunk)]
            bad_chunks, n = sum(flags), len(words)
            failed = n < 10 or 100 * n_repeat > 20 * n
            kept = not (failed or bad or bad_chunks > bad_share * len(flags))
            rows.append((n, len(text) - sum(text.count(c) for c in GAPS), sum(text.count(c) for c in SYMBOLS),
                         _dup_lines(text), n_repeat, failed, kept, ratio, bad_chunks, len(flags)))
        cols = list(zip(*rows, strict=True))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                 "ratio", "bad_chunks", "n_chunks"]
        kinds = [*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.record_batch([part.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                              names=["doc_id", *names])


def quality(docs: DataFrame, limits=LIMITS, chunk_limits=CHUNK_LIMITS, chunk: int = CHUNK,
            bad_share: float = BAD_SHARE) -> DataFrame:
    """The measures and verdict of every document; ``learn_limits`` gives limits of a corpus with labels."""
    kind = dict(docs.dtypes)["doc_id"]
    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_batches(src, lambda it: _measure(it, limits, chunk_limits, chunk, bad_share),
                       f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                       "n_repeat_words long, base_failed boolean, kept boolean, ratio double, bad_chunks long, "
                       "n_chunks long")


def _good(batches: Iterator[pa.RecordBatch], limits, chunk_limits, chunk: int, bad_share: float) -> Iterator[pa.RecordBatch]:
    for part in portions(batches):
        text = part.column(part.schema.get_field_index("text")).cast(pa.binary())
        ids = pa.array(range(part.num_rows), pa.int64())
        alone = pa.record_batch([ids, text], names=["doc_id", "text"])
        for judged in _measure(iter([alone]), limits, chunk_limits, chunk, bad_share):
            yield part.filter(judged.column(judged.schema.get_field_index("kept")))


def keep_good(docs: DataFrame, limits=LIMITS, chunk_limits=CHUNK_LIMITS, chunk: int = CHUNK,
              bad_share: float = BAD_SHARE) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return map_batches(docs, lambda it: _good(it, limits, chunk_limits, chunk, bad_share), docs.schema)


def _ratios(batches: Iterator[pa.RecordBatch], edges: list[int], chunk: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, class, n, low, high) of texts that pass the base rules, and of their full chunks as class -1: number of
    ratios, smallest and largest."""
    zstd = zstandard.ZstdCompressor(level=LEVEL)
    for part in portions(batches):
        raw = [t or b"" for t in part.column(1).to_pylist()]
        docs = [t.split() for t in raw]
        at, rows = [], []
        for k, (data, words, n_repeat) in enumerate(zip(raw, docs, _repeat_words(docs), strict=True)):
            if len(words) < 10 or 100 * n_repeat > 20 * len(words):
                continue
            if len(data) >= edges[0]:
                ratio = outside(data, zstd)[0]
                at.append(k)
                rows.append((max(e for e in edges if len(data) >= e), 1, ratio, ratio))
            chunks = [outside(data[i : i + chunk], zstd)[0] for i in range(0, len(data) - chunk + 1, chunk)]
            if chunks:
                at.append(k)
                rows.append((-1, len(chunks), min(chunks), max(chunks)))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.record_batch([part.column(0).take(pa.array(at, pa.int64())),
                               *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
                              names=["doc_id", "class", "n", "low", "high"])


def learn_limits(docs: DataFrame, labels: DataFrame, margin: float = MARGIN, chunk: int = CHUNK):
    """Limits of whole texts and of full chunks from all labelled good documents that are not held out: smallest and largest
    ratio of each class, by one aggregate, widened by ``margin``. Classes with fewer than ``LEAST_ROWS`` of them keep ``LIMITS``
    and ``CHUNK_LIMITS``. Every document is measured where it lies; only its numbers meet the labels, so no text is shuffled."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    good = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    src = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("binary").alias("text"))
    edges = [least for least, _, _ in LIMITS]
    ratios = map_batches(src, lambda it: _ratios(it, edges, chunk),
                         f"doc_id {dict(docs.dtypes)['doc_id']}, class long, n long, low double, high double")
    seen = ratios.join(good, "doc_id").groupBy("class").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()  # a row per class
    found = {r["class"]: (round(r["low"] * (1 - margin), 3), round(r["high"] * (1 + margin), 3)) for r in seen
             if r["n"] >= LEAST_ROWS}
    return tuple((least, *found.get(least, (lo, hi))) for least, lo, hi in LIMITS), found.get(-1, CHUNK_LIMITS)
