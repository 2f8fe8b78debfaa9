"""SentencePiece encoding and decoding by a table of distinct chunks (operator 2).

No piece of the model crosses from a character to a following whitespace marker, and none holds a
newline (both are checked when the model is loaded). So a text's segmentation is the
segmentation of its chunks, a chunk being a word with the markers before it, a newline, or trailing
markers. Each task segments every distinct chunk once, keeps its ids in a table, and joins them back
by position. The table is local to a Python worker and emptied at ``TABLE_CHUNKS`` entries or
``TABLE_CHARS`` characters, which bounds memory without changing any result; no row is shuffled.

Cases: null and empty texts give the end id alone and decode to the empty string. Very long texts
and chunks are encoded whole. Repeated rows and null ids give a row each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import map_batches, portions

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
TABLE_CHUNKS = 500_000
TABLE_CHARS = 16_000_000

_CHUNKS = re.compile(r" *[^ \n]+| +|\n")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkTable:
    """Ids of distinct chunks, exactly as the library segments them."""

    def __init__(self, model: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = map(self.lib.id_to_piece, range(self.lib.get_piece_size()))
        if any("\n" in p or MARKER in p.lstrip(MARKER) for p in pieces):
            raise ValueError("a piece of this model holds a newline or crosses a whitespace marker")
        # a newline stands before each chunk, so the library's own leading marker can't merge with it
        self.lead = len(self.lib.encode("\n"))
        if self.lib.normalize(" a  b\n c ") != "▁▁a▁▁b\n▁c▁":
            raise ValueError("this model rewrites whitespace")
        self.end = self.lib.eos_id()
        self.decimal = [str(i) for i in range(self.lib.get_piece_size())]
        self.ids: dict[str, bytes] = {}
        self.chars = 0

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text, without the end id."""
        split = [_CHUNKS.findall(" " + t.replace(MARKER, " ")) if t else [] for t in texts]
        distinct = set(chain.from_iterable(split))
        new = [c for c in distinct if c not in self.ids]
        if len(self.ids) + len(new) > TABLE_CHUNKS or self.chars > TABLE_CHARS:
            self.ids, self.chars, new = {}, 0, list(distinct)
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            for chunk, ids in zip(some, self.lib.encode(["\n" + c for c in some], num_threads=1), strict=True):
                self.ids[chunk] = array("i", ids[self.lead :]).tobytes()
            self.chars += sum(map(len, some))
        for chunks in split:
            yield np.frombuffer(b"".join(map(self.ids.__getitem__, chunks)), dtype=np.intc).tolist()


def _encode(batches: Iterator[pa.RecordBatch], model: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    table = ChunkTable(model)
    for part in portions(batches):
        counts, id_hash, ids_out, decoded = [], [], [], []
        for ids in table.encode([t or "" for t in part.column(1).to_pylist()]):
            ids.append(table.end)
            counts.append(len(ids))
            id_hash.append(hashlib.sha256(" ".join(map(table.decimal.__getitem__, ids)).encode()).hexdigest())
            decoded.append(hashlib.sha256(table.lib.decode(ids).encode("utf-8")).hexdigest())
            if with_ids:
                ids_out.append(np.array(ids, dtype=np.int32))
        cols = [part.column(0), pa.array(counts, pa.int64()), pa.array(id_hash, pa.string()),
                pa.array(decoded, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            cols.append(pa.array(ids_out, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.record_batch(cols, names=names)


def encode(docs: DataFrame, model: str | None = None, with_ids: bool = True) -> DataFrame:
    """Tokens of each whole text: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    ``model`` is a path that every executor can read; the default is the installed public model.
    """
    model = model or model_path()
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select("doc_id", "text"), lambda it: _encode(it, model, with_ids),
                       schema + ", ids array<int>" * with_ids)


def _decode(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model)
    for batch in batches:
        texts = [lib.decode(ids or []) for ids in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decode(tokens: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and text of rows that hold ``ids``; null ids give the empty text."""
    model = model or model_path()
    kind = dict(tokens.dtypes)["doc_id"]
    return map_batches(tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids")),
                       lambda it: _decode(it, model), f"doc_id {kind}, text string")
