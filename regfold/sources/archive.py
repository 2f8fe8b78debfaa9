"""Expand zip archives on the executors; a bad archive, entry or record is reported and skipped.

Two steps, both Spark jobs. First every archive's central directory is read (names and sizes
only; the archive list comes from ``binaryFile`` without its ``content`` column), giving one
row per entry, or one error row per archive that is not a zip. Then the entries, in order, are cut into tasks of about
``TASK_BYTES`` uncompressed bytes. Each task opens an
archive once through ``pyarrow.fs`` (a seekable file on local disk, HDFS or an object store)
for its run of entries and streams each entry in chunks: to a landing folder for the XML
reader (``extract_archives``) or through a byte count and CRC check (``archive_entries``). No
archive or entry is ever held whole in memory or passes through the driver.

Extraction is a commit in two phases. An attempt at an entry writes below ``data/<entry_id>/<attempt>/``, a folder
that no other entry, retry or speculative copy shares, so nothing that fails can touch what another has written. The report
row names the attempt, and the report is a table written by Spark's own committer: one attempt of each task gets into
it. Readers take the rows of committed attempts (``take_committed``). ``entry_id`` is a digest of archive, entry name and
the number of the entry among those of its name, so no two entries share a folder, whatever their names.

The XML source parses one file per task, so an entry larger than ``split_bytes`` is cut, while
it streams, right after a closing row tag into files of about that size. Each piece is wrapped
in the file's own prologue and root tag. All entries, cut or not, are named ``<entry>.<nnnnn>.XML``, so the
text before the first ``.XML`` (register, date, part) is unchanged and a name does not depend on a size; a ``~`` stands
before names that Spark's readers would skip, and ``entry_name`` takes it off. ``packed`` pieces are gzip, with ``.gz`` behind the
name (a piece is one parse task either way). Records that are not well-formed are left out
and reported with their byte offset (``records``). An entry that fails (checksum, not XML) is reported and
contributes no row.
"""

from __future__ import annotations

import fnmatch
import hashlib
import io
import uuid
import zipfile
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regfold.session import ensure_checkpoint_dir
from regfold.sources.files import delete_folder
from regfold.sources.files import filesystem_for as _fs
from regfold.sources.records import CHUNK, Records
from regfold.sources.xmlsource import ROW_TAG

LIST_SCHEMA = ("archive STRING, path STRING, entry STRING, copy INT, number INT, entry_id STRING, size BIGINT, crc BIGINT, "
               "landed BIGINT, error STRING")
ENTRY_SCHEMA = "archive STRING, entry STRING, size BIGINT, md5 STRING, error STRING"
# a row per entry, and one with an offset for every record left out
EXTRACT_SCHEMA = ("archive STRING, entry STRING, entry_id STRING, attempt STRING, size BIGINT, record_offset BIGINT, "
                  "error STRING")
SPLIT_BYTES = 256 * 1024 * 1024   # XML pieces of about this size: one parse task each
TASK_BYTES = 128 * 1024 * 1024    # uncompressed bytes handed to one extraction task


def list_archives(spark: SparkSession, archive_dir: str, glob: str = "*") -> DataFrame:
    """(archive, path, size, landed) of every landed file, whatever its name; file contents are not read. ``landed``: when, in
    milliseconds."""
    seen = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(archive_dir)
            .select(F.col("_metadata.file_name").alias("archive"), "path",  # not _metadata.file_path: it is URL-encoded
                    F.col("_metadata.file_size").alias("size"),
                    F.unix_millis("_metadata.file_modification_time").alias("landed")))
    # Spark's file sources skip names that begin with _ or . without a word: these few are listed here
    path = spark._jvm.org.apache.hadoop.fs.Path(archive_dir, "[_.]*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    hidden = [(f.getPath().getName(), f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found if f.isFile()]
    hidden = [h for h in hidden if fnmatch.fnmatchcase(h[0], glob)]
    return seen.unionByName(spark.createDataFrame(hidden, "archive STRING, path STRING, size BIGINT, landed BIGINT")) if hidden else seen


def _directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for name, path, landed in zip(pdf["archive"], pdf["path"], pdf["landed"]):
            try:
                filesystem, p = _fs(path)
                copies: Counter = Counter()  # entries of one name are told apart by their order
                found = []
                with filesystem.open_input_file(p) as raw, zipfile.ZipFile(raw) as z:
                    for number, i in enumerate(z.infolist()):
                        if not i.is_dir():
                            copy = copies[i.filename]
                            copies[i.filename] += 1
                            own = hashlib.md5(f"{name}\0{i.filename}\0{copy}".encode("utf-8", "surrogateescape")).hexdigest()
                            found.append((name, path, i.filename, copy, number, own, i.file_size, i.CRC, landed, None))
                rows += found
            except Exception as e:  # not an archive at all: one error row, the others go on
                rows.append((name, path, *[None] * 6, landed, f"{type(e).__name__}: {e}"))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in LIST_SCHEMA.split(", ")])
        yield out.astype({c: "Int64" for c in ("copy", "number", "size", "crc", "landed")})


def list_entries(spark: SparkSession, archive_dir: str, glob: str = "*") -> DataFrame:
    """One row per archive entry (from the central directories), or per unreadable archive."""
    return list_archives(spark, archive_dir, glob).mapInPandas(_directory, LIST_SCHEMA)


def _spread(entries: DataFrame) -> DataFrame:
    """Good entries in tasks that each begin within one stretch of ``TASK_BYTES`` of the bytes before them, in order
    of archive and entry: no task gets more than that and its last entry, and each sees a run of an archive's entries, so
    it opens that archive once.

    The byte count before an entry is summed inside of its archive; only the archives' totals meet in one task.
    """
    good = entries.where(F.col("error").isNull())
    totals = good.groupBy("archive").agg(F.sum("size").alias("bytes"))
    ahead = Window.orderBy("archive").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("archive", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("archive").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    placed = good.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(totals, "archive").withColumn(
        "task", F.floor((F.col("ahead") + F.col("inside")) / TASK_BYTES).cast("int")).drop("ahead", "inside").checkpoint()
    last = placed.agg(F.max("task")).first()[0]
    return (placed.repartitionById((last or 0) + 1, "task").sortWithinPartitions("archive", "number").drop("task"))


def _each_entry(batches: Iterator[pd.DataFrame], make) -> Iterator[pd.DataFrame]:
    """Hand the stream of every assigned entry to a sink of its own (``make()``); archives are opened
    once per run of their entries."""
    for pdf in batches:
        rows: list[tuple] = []
        path, raw, z = None, None, None
        try:
            for e in pdf.itertuples(index=False):
                sink = make()
                try:
                    if path != e.path:
                        if z is not None:
                            z.close()
                            raw.close()
                        path, raw, z = None, None, None
                        filesystem, p = _fs(e.path)
                        raw = filesystem.open_input_file(p)
                        z = zipfile.ZipFile(raw)
                        path = e.path
                    with z.open(z.infolist()[int(e.number)]) as stream:
                        rows += sink.take(e, stream)
                except Exception as error:  # a damaged entry: report it, leave nothing of it, keep the others
                    sink.undo()
                    rows.append(sink.failed(e, f"{type(error).__name__}: {error}"))
        finally:
            for f in (z, raw):
                if f is not None:
                    f.close()
        columns = make().columns
        yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns if c in ("size", "record_offset")})


def _with_errors(entries: DataFrame, done: DataFrame, schema: str) -> DataFrame:
    kinds = [c.split() for c in schema.split(", ")]
    bad = entries.where(F.col("error").isNotNull()).select(
        *[(F.col(c) if c in ("archive", "error") else F.lit(None)).cast(t).alias(c) for c, t in kinds])
    return done.unionByName(bad)


class _Count:
    """Read an entry to its end (the zip module checks its CRC there); its bytes and their digest."""

    columns = ["archive", "entry", "size", "md5", "error"]

    def undo(self):
        pass

    def failed(self, e, error):
        return e.archive, e.entry, None, None, error

    def take(self, e, stream):
        n, digest = 0, hashlib.md5()
        while chunk := stream.read(CHUNK):
            n += len(chunk)
            digest.update(chunk)
        return [(e.archive, e.entry, n, digest.hexdigest(), None)]


SHOWN = "~"  # put before names that begin with _ or . (Spark's readers skip those) or with itself


def piece_name(folder: str, entry: str, number: int) -> str:
    """Every entry lands under one rule, whatever its size or name: ``<entry>.<nnnnn>.XML``, behind
    ``SHOWN`` where Spark would not see it."""
    return f"{folder}/{SHOWN if entry[:1] in ('_', '.', SHOWN) else ''}{entry}.{number:05d}.XML"


def entry_name(piece):
    """The entry of a piece (column of file names); files that are no pieces keep their names."""
    return F.regexp_replace(piece, rf"^{SHOWN}?(.*)\.[0-9]{{5}}\.XML(\.gz)?$", "$1")


class _Write:
    """Stream one entry into ``<root>/data/<entry_id>/<attempt>/``, cut into pieces above ``split_bytes``."""

    columns = [c.split()[0] for c in EXTRACT_SCHEMA.split(", ")]

    def __init__(self, out_dir: str, split_bytes: int = SPLIT_BYTES, row_tag: str = ROW_TAG, packed: bool = False):
        self.out_dir, self.split_bytes, self.row_tag, self.packed = out_dir, split_bytes, row_tag, packed
        self.attempt = uuid.uuid4().hex
        self.filesystem = self.folder = self.out = None

    def failed(self, e, error):
        return e.archive, e.entry, e.entry_id, None, None, None, error

    def undo(self):
        """Remove what this attempt wrote. No one reads it without a report row that names it, so leftovers do no harm."""
        if self.out is not None and not self.out.closed:
            self.out.close()
        if self.folder is not None:
            try:
                self.filesystem.delete_dir(self.folder)
            except OSError:
                pass

    def take(self, e, stream):
        first = stream.read(CHUNK)
        if first.lstrip(b"\xef\xbb\xbf\xff\xfe \t\r\n\0")[:1] != b"<":
            raise ValueError("not an XML document")
        self.filesystem, root = _fs(self.out_dir)
        self.folder = f"{root}/data/{e.entry_id}/{self.attempt}"
        self.filesystem.create_dir(self.folder, recursive=True)
        base = e.entry.strip("/").replace("/", "__")  # sub-folders of the archive flattened
        cut = Records(first, lambda: stream.read(CHUNK), self.row_tag)
        if not cut.found:  # one piece as it is
            with self._open(base, 1) as out:
                out.write(first)
                n = len(first)
                while chunk := stream.read(CHUNK):
                    n += out.write(chunk)
            return [(e.archive, e.entry, e.entry_id, self.attempt, n, None, None)]
        bad, n = [], 0
        piece, written = 0, 0
        for run, offset, error in cut.runs():
            if run is None:
                bad.append((e.archive, e.entry, e.entry_id, self.attempt, None, offset, error))
                continue
            n += len(run)
            while run:
                if self.out is None:
                    piece += 1
                    self.out = self._open(base, piece)
                    self.out.write(cut.header)
                    written = len(cut.header)
                # after the first record that ends at or beyond the target size
                k = run.find(cut.end_tag, max(0, self.split_bytes - len(cut.end_tag) - written))
                k = k + len(cut.end_tag) if k >= 0 else len(run)
                self.out.write(run[:k])
                written += k
                run = run[k:]
                if written >= self.split_bytes:
                    self._end(cut.trailer)
        if self.out is not None:
            self._end(cut.trailer)
        return [(e.archive, e.entry, e.entry_id, self.attempt, n, None, None), *bad]

    def _open(self, base: str, number: int):
        path = piece_name(self.folder, base, number)
        if self.packed:
            return self.filesystem.open_output_stream(f"{path}.gz", compression="gzip")
        return self.filesystem.open_output_stream(path)

    def _end(self, trailer: bytes) -> None:
        self.out.write(trailer)
        self.out.close()
        self.out = None


def _listed(spark: SparkSession, archive_dir: str, glob: str) -> DataFrame:
    """The entry list, staged: every later step reads the same list, and lost executors don't matter."""
    ensure_checkpoint_dir(spark)
    return list_entries(spark, archive_dir, glob).checkpoint()


def archive_entries(spark: SparkSession, archive_dir: str, glob: str = "*") -> DataFrame:
    """(archive, entry, size, md5, error): every entry read through, bad ones reported."""
    entries = _listed(spark, archive_dir, glob)
    done = _spread(entries).mapInPandas(lambda it: _each_entry(it, _Count), ENTRY_SCHEMA)
    return _with_errors(entries, done, ENTRY_SCHEMA)


def extract_archives(spark: SparkSession, archive_dir: str, out_dir: str, glob: str = "*",
                     split_bytes: int = SPLIT_BYTES, row_tag: str = ROW_TAG,
                     entries: DataFrame | None = None, packed: bool = False) -> DataFrame:
    """Write every entry below ``out_dir`` (big ones in pieces) and return the committed report, which is kept there too.
    ``entries``: some rows of ``list_entries``, staged, in place of all. ``packed``: as gzip."""
    ensure_checkpoint_dir(spark)
    if entries is None:
        entries = _listed(spark, archive_dir, glob)
    done = _spread(entries).mapInPandas(
        lambda it: _each_entry(it, lambda: _Write(out_dir, split_bytes, row_tag, packed)), EXTRACT_SCHEMA)
    path = f"{out_dir.rstrip('/')}/report"
    _with_errors(entries, done, EXTRACT_SCHEMA).write.mode("overwrite").parquet(path)  # runs the expansion, commits it
    return spark.read.schema(EXTRACT_SCHEMA).parquet(path)


def data_path(out_dir: str) -> str:
    """What an XML reader loads: the pieces of all attempts (see ``take_committed``)."""
    return f"{out_dir.rstrip('/')}/data/*/*"


def drop_pieces(out_dir: str) -> None:
    """Remove what ``extract_archives`` has expanded; its report stays."""
    delete_folder(f"{out_dir.rstrip('/')}/data")


def take_committed(rows: DataFrame, out_dir: str, path_col: str) -> DataFrame:
    """The rows read from committed attempts, with ``entry_id`` in place of ``path_col``."""
    report = rows.sparkSession.read.schema(EXTRACT_SCHEMA).parquet(f"{out_dir.rstrip('/')}/report")
    committed = report.where("error is null").select("entry_id", "attempt")
    parts = F.split(path_col, "/")
    placed = rows.withColumns({"entry_id": F.element_at(parts, -3), "attempt": F.element_at(parts, -2)})
    return placed.join(committed, ["entry_id", "attempt"], "left_semi").drop("attempt", path_col)


def zip_partitions(df: DataFrame, out_dir: str, name_col: str, content_col: str, prefix: str = "drop",
                   ending: str = ".zip", from_files: bool = False) -> DataFrame:
    """Pack each partition's rows into one zip ``<prefix>_<partition><ending>`` (entries named by
    ``name_col``), streamed straight to the output; returns (archive, n_entries).
    With ``from_files`` the content column holds paths, and each file is streamed into its entry: files of any size
    pass in chunks. Deterministic names: a retried task overwrites its own archive."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        filesystem, root = _fs(out_dir)
        filesystem.create_dir(root, recursive=True)
        name = f"{prefix}_{TaskContext.get().partitionId():05d}{ending}"
        n = 0
        with filesystem.open_output_stream(f"{root}/{name}") as out, \
                zipfile.ZipFile(_Unseekable(out), "w", compression=zipfile.ZIP_DEFLATED) as z:
            for pdf in batches:
                for entry, content in zip(pdf[name_col], pdf[content_col]):
                    if from_files:
                        _add_file(z, entry, content)
                    else:
                        z.writestr(entry, content if isinstance(content, (bytes, bytearray)) else str(content))
                    n += 1
        yield pd.DataFrame({"archive": [name], "n_entries": [n]})

    return df.select(name_col, content_col).mapInPandas(run, "archive STRING, n_entries BIGINT")


def _add_file(z: zipfile.ZipFile, entry: str, path: str) -> None:
    source_fs, p = _fs(path)  # its streams unpack files that end in .gz
    with source_fs.open_input_stream(p) as data, z.open(entry, "w", force_zip64=True) as out:
        while chunk := data.read(CHUNK):
            out.write(chunk)


class _Unseekable(io.RawIOBase):
    """A write-only stream without seek, so ``zipfile`` writes data descriptors as it goes."""

    def __init__(self, out):
        self.out = out
        self.pos = 0

    def writable(self):
        return True

    def write(self, b):
        self.out.write(b)
        self.pos += len(b)
        return len(b)

    def tell(self):
        return self.pos

    def flush(self):
        pass
