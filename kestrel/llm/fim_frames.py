"""Fill-in-middle over seekable compressed frames.

A text is stored as independent zstandard frames of ``FRAME`` code points each, with
the number of units that start before each frame (`framed`).  A cut after so many
units is then found by a search over these counts, and only the frame that holds it
is decompressed (`Frames.seek`).  The parts of the result, and the text that is
rebuilt from the result, are streamed frame by frame (`Frames.read`): no step
after the first holds more than one frame of a text besides compressed data, and
the result itself is stored as frames again (`Writer`).

Units are white space with the word after it, or white space at the end: a unit
starts at the first code point and wherever white space follows something else.

Prefix, middle and suffix come from a digest of the seed and the id (`decide`):
cuts h1 % (n + 1) and h2 % (n + 1) in order; plain unless h3 % 100 < ``RATE``; of
the others the share ``SPM`` has the suffix first.  A result is read back by
searching its stream for the three marks, which no text that is cut contains.

Defined results: a null text counts as empty; empty texts and texts with a mark in
them stay plain; a null id is the empty string in the digest; rows that repeat give
repeated results.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import map_batches, staged, text_of

#: Code points in a frame.
FRAME = 16384
#: Seed of the decisions, per cent of the texts that are cut, and of these with the suffix first.
SEED, RATE, SPM = 42, 50, 80
# fixed values: the marks
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = PREFIX, SUFFIX, MIDDLE
PLAIN = "plain"

# fixed values: white space between units
_WHITE = np.zeros(128, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def unit_starts(text: str, after_white: bool | None) -> np.ndarray:
    """Where units start in a piece of a text; ``after_white`` says what comes before it, None that nothing does."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    white = _WHITE[np.minimum(points, 127)]
    starts = white.copy()
    starts[1:] &= ~white[:-1]
    if len(starts):
        starts[0] = True if after_white is None else bool(white[0]) and not after_white
    return np.flatnonzero(starts)


class Frames:
    """A text as frames: compressed pieces, the units and code points before each piece, and what stands before it."""

    def __init__(self, data: list[bytes], units: list[int], chars: list[int], white: list[bool], frame: int = FRAME):
        self.data, self.units, self.chars, self.white, self.frame = data, units, chars, white, frame
        self.opened = 0             # frames decompressed so far

    def _piece(self, k: int) -> str:
        self.opened += 1
        return zstandard.decompress(self.data[k]).decode("utf-8", "surrogatepass")

    def seek(self, unit: int) -> int:
        """The code point at which unit number ``unit`` starts; the end of the text for one past the last."""
        if unit >= self.units[-1]:
            return self.chars[-1]
        k = bisect_right(self.units, unit) - 1
        starts = unit_starts(self._piece(k), self.white[k] if k else None)
        return self.chars[k] + int(starts[unit - self.units[k]])

    def read(self, start: int, end: int) -> Iterator[str]:
        """The code points from start to end, in pieces."""
        k = bisect_right(self.chars, start) - 1
        while start < end:
            piece = self._piece(k)
            yield piece[start - self.chars[k]:end - self.chars[k]]
            k += 1
            start = self.chars[k]


class Writer:
    """Takes text in pieces of any length, makes frames."""

    def __init__(self, frame: int = FRAME):
        self.frame, self.rest, self.size = frame, [], 0
        self.data, self.units, self.chars, self.white = [], [0], [0], []
        self.before: bool | None = None

    def _put(self, piece: str) -> None:
        self.data.append(zstandard.compress(piece.encode("utf-8", "surrogatepass"), 3))
        self.units.append(self.units[-1] + len(unit_starts(piece, self.before)))
        self.chars.append(self.chars[-1] + len(piece))
        self.white.append(bool(self.before))
        last = ord(piece[-1])
        self.before = last < 128 and bool(_WHITE[last])

    def write(self, text: str) -> None:
        at = 0
        while at < len(text):
            some = text[at:at + self.frame - self.size]
            at += len(some)
            self.rest.append(some)
            self.size += len(some)
            if self.size == self.frame:
                self._put("".join(self.rest))
                self.rest, self.size = [], 0

    def close(self) -> Frames:
        if self.size:
            self._put("".join(self.rest))
            self.rest, self.size = [], 0
        return Frames(self.data, self.units, self.chars, self.white, self.frame)


def marks(pieces: Iterable[str]) -> Iterator[tuple[int, str]]:
    """Places and names of all marks in a stream of pieces."""
    at, tail = 0, ""
    for piece in pieces:
        text = tail + piece
        i = text.find("<")
        while i >= 0:
            if text[i:i + 3] in MARKS:
                yield at - len(tail) + i, text[i:i + 3]
            i = text.find("<", i + 1)
        at += len(piece)
        tail = text[-2:]            # shorter than a mark, so none is told twice


def decide(doc: int | None, n: int, marked: bool, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> tuple[str, int, int]:
    """The form of a text of n units, and the units before the middle and before the suffix."""
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    if not n or marked or h3 % 100 >= rate:
        return PLAIN, 0, 0
    return ("spm" if h4 % 100 < spm else "psm"), *sorted((h1 % (n + 1), h2 % (n + 1)))


def transformed(text: Frames, form: str, cuts: tuple[int, int]) -> Frames:
    """The result as frames; ``cuts`` are code points."""
    if form == PLAIN:
        return text
    a, b = cuts
    prefix, middle, suffix = (PREFIX, 0, a), (MIDDLE, a, b), (SUFFIX, b, text.chars[-1])
    out = Writer(text.frame)
    for mark, start, end in ((suffix, prefix, middle) if form == "spm" else (prefix, suffix, middle)):
        out.write(mark)
        for piece in text.read(start, end):
            out.write(piece)
    return out.close()


def restored(result: Frames, form: str) -> Iterator[str]:
    """The text, in pieces, from the frames of a result and its form."""
    end = result.chars[-1]
    if form == PLAIN:
        yield from result.read(0, end)
        return
    found = list(marks(result.read(0, end)))
    if len(found) != 3 or found[0][0] != 0:
        raise ValueError("not a result of this form")
    ends = [at for at, _ in found[1:]] + [end]
    place = {mark: (at + len(mark), stop) for (at, mark), stop in zip(found, ends)}
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from result.read(*place[mark])


def sha256(pieces: Iterable[str]) -> str:
    h = hashlib.sha256()
    for piece in pieces:
        h.update(piece.encode("utf-8", "surrogatepass"))
    return h.hexdigest()


_STORE = "doc_id long, marked boolean, frames array<binary>, units array<long>, chars array<long>, white array<boolean>"
_LONGS, _BLOBS, _FLAGS = pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.bool_())


def framed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame: int = FRAME) -> DataFrame:
    """The store: doc_id, marked (whether a mark is in the text), frames, and for each frame and the end the units
    and code points before it, and whether white space is before the frame."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, marked = [], []
        for text in batch.column(1).to_pylist():
            w = Writer(frame)
            w.write(text)
            out.append(w.close())
            marked.append(any(m in text for m in MARKS))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(marked, pa.bool_()), pa.array([f.data for f in out], _BLOBS), pa.array([f.units for f in out], _LONGS),
             pa.array([f.chars for f in out], _LONGS), pa.array([f.white for f in out], _FLAGS)],
            ["doc_id", "marked", "frames", "units", "chars", "white"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(src, _STORE, run)


def _each(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bool, Frames]]:
    """The rows of a store, one text at a time."""
    for i in range(batch.num_rows):
        doc, marked, *frames = (c[i].as_py() for c in batch.columns)
        yield doc, marked, Frames(*frames)


def transform(store: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """doc_id, form, output (the text of the result), prefix_chars and middle_chars of every stored text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, marked, text in _each(batch):
            form, *units = decide(doc, text.units[-1], marked, seed, rate, spm)
            a, b = (text.seek(u) for u in units)
            result = transformed(text, form, (a, b))
            rows.append((doc, form, "".join(result.read(0, result.chars[-1])), *((None, None) if form == PLAIN else (a, b - a))))
        return _batch(rows, [("doc_id", pa.int64()), ("form", pa.string()), ("output", pa.string()), ("prefix_chars", pa.int64()),
                             ("middle_chars", pa.int64())])
    return map_batches(store, "doc_id long, form string, output string, prefix_chars long, middle_chars long", run)


def restore(results: DataFrame, frame: int = FRAME) -> DataFrame:
    """doc_id and text of the rows of `transform`."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, form, output in zip(*(c.to_pylist() for c in batch.columns)):
            w = Writer(frame)
            w.write(output)
            rows.append((doc, "".join(restored(w.close(), form))))
        return _batch(rows, [("doc_id", pa.int64()), ("text", pa.string())])
    return map_batches(results.select("doc_id", "form", "output"), "doc_id long, text string", run)


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame: int = FRAME, seed: int = SEED, rate: int = RATE,
           spm: int = SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every document.

    The store is written to the checkpoint folder; results and rebuilt texts are streamed into their digests.
    """
    store = staged(framed(docs, id_col, text_col, frame))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, marked, text in _each(batch):
            n = text.units[-1]
            form, *units = decide(doc, n, marked, seed, rate, spm)
            a, b = (text.seek(u) for u in units) if form != PLAIN else (0, 0)
            result = transformed(text, form, (a, b))
            sizes = (None, None) if form == PLAIN else (a, b - a)
            rows.append((doc, n, form, *sizes, sha256(result.read(0, result.chars[-1])), sha256(restored(result, form))))
        return _batch(rows, [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                             ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
    return map_batches(store, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
                              "restored_sha256 string", run)


# fixed values: the two kinds of units
_UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: The same in DuckDB.
SQL = rf"""
WITH a AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_UNITS}') AS u,
    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), b AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM a
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS x, greatest(h1 % (n + 1), h2 % (n + 1)) AS y,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {RATE}
      THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM b
), d AS (
  SELECT *, coalesce(array_to_string(u[1:x], ''), '') AS p, coalesce(array_to_string(u[x + 1:y], ''), '') AS m,
    coalesce(array_to_string(u[y + 1:], ''), '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM d
"""
