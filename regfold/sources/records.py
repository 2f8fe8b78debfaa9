"""Record-level recovery (S8, N3): the stream of one XML file as pieces that hold whole, well-formed records only.

Spark's XML source gives up on a file at its first broken tag. So each file is checked while it streams out of its
archive: runs of records, up to the last closing row tag read so far, go through the expat parser. A run that fails is
tried record by record, and a broken record is left out and reported with its byte offset; where a closing
row tag is missing, the next whole record inside of it is kept. Between cuts at most one read and one record are held.

Files whose encoding expat cannot decode, that are not a byte-wise superset of ASCII, or that declare a document type are cut,
but not checked.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator
from xml.parsers import expat

CHUNK = 4 * 1024 * 1024
RECORD_BYTES = 256 * 1024 * 1024  # a record that has not ended by then fails the file

_LAST_START_TAG = re.compile(rb"<([^\s<>/!?][^\s<>/]*)[^>]*>\s*$")
_UNFINISHED = (expat.errors.codes[expat.errors.XML_ERROR_UNCLOSED_TOKEN],
               expat.errors.codes[expat.errors.XML_ERROR_UNCLOSED_CDATA_SECTION])


def encoding_of(start: bytes) -> str:
    """Encoding of the XML declaration, UTF-8 without one."""
    m = re.search(rb"""^[^<]{0,4}<\?xml[^>]*?encoding=["']([\w.:-]+)["']""", start[:400])
    try:
        return codecs.lookup(m.group(1).decode()).name if m else "utf-8"
    except LookupError:
        return "utf-8"


def _checkable(encoding: str, header: bytes) -> bool:
    if b"<!DOCTYPE" in header or "<r>".encode(encoding) != b"<r>":
        return False
    try:
        expat.ParserCreate(encoding).Parse(b"<r/>", True)
    except (expat.ExpatError, LookupError, ValueError):
        return False
    return True


class Records:
    """Cuts one file's records out of its stream."""

    def __init__(self, first: bytes, read: Callable[[], bytes], row_tag: str):
        self.read = read
        self.encoding = encoding_of(first)
        tag = re.escape(row_tag.encode(self.encoding))
        self.start_tag, self.end_tag = re.compile(rb"<" + tag + rb"[\s>/]"), b"</" + row_tag.encode(self.encoding) + b">"
        m = self.start_tag.search(first)
        self.first = first
        self.header = first[:m.start()] if m else first
        self.found = m is not None  # no record at all: nothing to cut or check
        root = _LAST_START_TAG.search(self.header) if m else None
        self.trailer = b"</" + root.group(1) + b">\n" if root else b""
        self.check = self.found and _checkable(self.encoding, self.header)

    def _fault(self, data: bytes) -> int:
        """0 for well-formed content, else expat's code."""
        if not self.check:
            return 0
        parser = expat.ParserCreate(self.encoding)
        try:
            for part, last in ((b"<r>", False), (data, False), (b"</r>", True)):
                parser.Parse(part, last)
        except expat.ExpatError as e:
            return e.code
        return 0

    def runs(self) -> Iterator[tuple[bytes | None, int | None, str | None]]:
        """(records, None, None), or (None, offset, error) of a record that was left out."""
        buf, offset = self.first[len(self.header):], len(self.header)
        while True:
            end = buf.rfind(self.end_tag)
            if end >= 0:
                end += len(self.end_tag)
                run, buf = buf[:end], buf[end:]
                if self._fault(run):
                    yield from self._sifted(run, offset)
                else:
                    yield run, None, None
                offset += end
            elif len(buf) > RECORD_BYTES:
                raise ValueError(f"no end of record within {RECORD_BYTES} bytes from byte {offset}")
            more = self.read()
            if not more:
                break
            buf += more
        rest = buf.rstrip()  # the root's own closing tag, and records without a closing tag of their own
        rest = rest.removesuffix(self.trailer.strip())
        if self.start_tag.search(rest):
            if self._fault(rest):
                yield None, offset + self.start_tag.search(rest).start(), "record does not end"
            else:
                yield rest, None, None

    def _sifted(self, run: bytes, offset: int) -> Iterator[tuple[bytes | None, int | None, str | None]]:
        at = 0
        while at < len(run):
            end = run.index(self.end_tag, at) + len(self.end_tag)
            fault = self._fault(run[at:end])
            if fault in _UNFINISHED and end < len(run):  # a comment or CDATA section may hold the row tag
                wider = run.index(self.end_tag, end) + len(self.end_tag)
                if not self._fault(run[at:wider]):
                    end, fault = wider, 0
            if not fault:
                yield run[at:end], None, None
            else:
                starts = [m.start() for m in self.start_tag.finditer(run, at, end)]
                yield None, offset + (starts[0] if starts else at), expat.errors.messages.get(fault, "not well-formed")
                if len(starts) > 1 and not self._fault(run[starts[-1]:end]):
                    yield run[starts[-1]:end], None, None
            at = end
