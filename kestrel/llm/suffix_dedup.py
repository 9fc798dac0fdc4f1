"""Removal of byte strings that an earlier document has, by maximal repeats of an enhanced suffix array.

A suffix array over a corpus does not fit a machine, so the suffixes are dealt
to many small arrays by content.  Of each window of ``MIN_LENGTH`` bytes the
smallest hash of its ``ANCHOR``-byte strings is the anchor; runs of windows with
one anchor make a segment.  Equal windows have equal anchors, so all copies of a
window meet in the group of their anchor:

1. anchors that only one document has are found on (anchor, document) alone and
   leave (`repeated_anchors`); a document is its id and a part of its text's hash,
   so that rows sharing an id are many documents here;
2. the segments of the others are grouped by anchor; each group sorts the
   suffixes of its segments, and a stack scan over the common prefixes of
   neighbours walks the tree of common-prefix intervals.  Intervals whose
   suffixes differ in the byte on their left are maximal repeats and give all
   their occurrences (`maximal_repeats`);
3. in each group of occurrences, those in documents after the smallest id are
   marked; the marks of a document are joined to its text.

Copies inside a task's chunk of documents are settled there: all but the first
document's are marked at once, and rows that repeat id and text are read once, so a
passage that a third of all rows share costs one segment for each chunk.  The number
of groups comes from the bytes of all texts.

Defined results: null texts count as empty; matches never cross rows; a null id
comes after all others; rows that share an id count as one document (neither
is earlier than the other); strings are judged on the input.  Other columns are
ignored by `digest` and kept by `strip`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import groups_for, mix, pack, staged, text_bytes, text_of, unpack

#: Shortest string in bytes that counts as a repeat.
MIN_LENGTH = 50
#: Bytes of an anchor.
ANCHOR = 20
#: Bits of an anchor's hash.
ANCHOR_BITS = 39
#: Bytes of text a task works on at once, below 2**24 with what a single text may add being cut to pieces.
CHUNK = 1 << 22
#: Longest piece of a text that is worked on at once; pieces overlap by a window less one byte.
PIECE = 1 << 22
#: Bytes of text to a group of anchors, which one task meets at once; parts that the texts of one id are told apart by.
GROUP, PARTS = 1 << 26, 1 << 16
_BLOCK = 1 << 17
_MASK = np.uint64((1 << 24) - 1)


def _rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all ``width``-byte strings, built from those of half their length."""
    if width == 1:
        return data.astype(np.uint64) + np.uint64(1)
    half = width // 2
    a = _rolling(data, half)
    n = len(data) - width + 1
    left, right = a[:n], a[half:half + n]
    out = left * np.uint64(pow(0x5851F42D4C957F2D, half, 1 << 64)) + right
    if width % 2:
        out = out * np.uint64(0x5851F42D4C957F2D) + (data[width - 1:].astype(np.uint64) + np.uint64(1))
    return out


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    span, m = 1, keys
    while 2 * span <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = width - span
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting: `np.unique` hashes them one by one into nodes that it allocates."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, anchor hash and text number of each run of windows with one anchor.

    ``bounds`` part the texts inside ``data`` (below 2**24 bytes).
    """
    none = np.zeros(0, dtype=np.int64)
    n = len(data) - MIN_LENGTH + 1
    if n <= 0:
        return none, none, none, none
    width = MIN_LENGTH - ANCHOR + 1
    best = np.empty(n, dtype=np.uint64)
    for at in range(0, n, _BLOCK):
        to = min(n, at + _BLOCK)
        part = data[at:to + MIN_LENGTH - 1]
        keys = mix(_rolling(part, ANCHOR))
        keys &= ~_MASK
        keys |= np.arange(at, at + len(keys), dtype=np.uint64)
        best[at:to] = _window_minima(keys, width)
    where = best & _MASK
    first = bounds[:-1]
    past = np.maximum(bounds[1:] - MIN_LENGTH + 1, first)         # first position without a window in its text
    cut = np.empty(n, dtype=bool)
    cut[0] = True
    np.not_equal(where[1:], where[:-1], out=cut[1:])
    cut[first[first < n]] = cut[past[past < n]] = True
    cuts = np.flatnonzero(cut)
    ends = np.append(cuts[1:], n)
    text = np.searchsorted(bounds, cuts, side="right") - 1
    ok = cuts < past[np.minimum(text, len(past) - 1)]
    # smallest hashes are all low: scramble once more to deal them evenly
    anchor = (mix(best[cuts[ok]] & ~_MASK) >> np.uint64(64 - ANCHOR_BITS)).astype(np.int64)
    return cuts[ok], (ends + MIN_LENGTH - 1)[ok], anchor, text[ok]


def maximal_repeats(data: np.ndarray, bounds: np.ndarray, least: int = MIN_LENGTH
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats of at least ``least`` bytes in the strings that ``bounds`` part.

    Returns (group, position, length) of every occurrence of every repeat; a string's
    start counts as a left neighbour of its own.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < least:
        return none, none, none
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(ends[:len(data) - least + 1] - np.arange(len(data) - least + 1) >= least)
    # suffixes whose first bytes nobody shares are leaves of the root; the array leaves them out
    _, where, count = np.unique(_rolling(data, least)[at], return_inverse=True, return_counts=True)
    at = at[count[where] > 1]
    if not len(at):
        return none, none, none
    room = ends[at] - at
    longest = int(room.max())
    words = -(-longest // 8)
    padded = np.concatenate([data, np.zeros(8 * words, dtype=np.uint8)])
    rows = padded[at[:, None] + np.arange(8 * words)]
    rows[np.arange(8 * words) >= room[:, None]] = 0
    keys = rows.reshape(len(at), words, 8).view(">u8").reshape(len(at), words)
    order = np.lexsort((room, *(keys[:, i] for i in range(words - 1, -1, -1))))
    at, room, rows = at[order], room[order], rows[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
    common = np.minimum(common, np.minimum(room[1:], room[:-1]))
    starts = np.zeros(len(data) + 1, dtype=bool)
    starts[bounds] = True
    left = np.where(starts[at], -1 - np.arange(len(at)), data[np.maximum(at - 1, 0)].astype(np.int64))
    diverse = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])      # changes of the left byte up to here
    low = np.flatnonzero(np.concatenate([[True], common < least, [True]]))  # runs that share the least length
    found: list[tuple[int, int, int]] = []
    for lo, hi in zip(low[:-1].tolist(), (low[1:] - 1).tolist()):
        if hi > lo and diverse[hi] > diverse[lo]:
            found += _intervals(common[lo:hi].tolist(), lo, diverse)
    if not found:
        return none, none, none
    first, last, size = (np.array(x, dtype=np.int64) for x in zip(*found))
    count = last - first + 1
    group = np.repeat(np.arange(len(first)), count)
    member = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[group]
    return group, at[member], size[group]


def _intervals(common: list[int], base: int, diverse: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, last, length) of the left-diverse intervals of a run of common-prefix lengths."""
    out, stack = [], [(common[0], 0)]
    for i in range(1, len(common) + 1):
        now = common[i] if i < len(common) else -1
        begin = i
        while stack and stack[-1][0] > now:
            size, begin = stack.pop()
            if diverse[base + i] > diverse[base + begin]:
                out.append((base + begin, base + i, size))
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, begin))
    return out


def _chunks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    """Bounded numbers of pieces of texts: bytes, bounds, piece starts, and the named columns by piece, by id.

    The first two columns are id and hash; rows that repeat both are taken once in a chunk.
    """
    held, size, met = [], 0, set()
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
        for text, *values in zip(batch.column(batch.schema.get_field_index("text")).to_pylist(), *cols):
            if (values[0], values[1]) in met:
                continue
            met.add((values[0], values[1]))
            raw = text.encode("utf-8", "surrogatepass")
            for at in range(0, max(1, len(raw) - MIN_LENGTH + 1), PIECE - MIN_LENGTH + 1):
                piece = raw[at:at + PIECE]
                if size + len(piece) > CHUNK and held:
                    yield _joined(held, len(columns))
                    held, size, met = [], 0, set()
                held.append((piece, at, *values))
                size += len(piece)
    if held:
        yield _joined(held, len(columns))


def _joined(held: list[tuple], n: int) -> tuple:
    held.sort(key=lambda x: x[2])
    bounds = np.concatenate([[0], np.cumsum([len(x[0]) for x in held])])
    data = np.frombuffer(b"".join(x[0] for x in held), dtype=np.uint8)
    return data, bounds, np.array([x[1] for x in held]), [[x[2 + i] for x in held] for i in range(n)]


def _part(h: Column) -> Column:
    """The part of an id's texts that a text is in, as a long."""
    return F.pmod(h, F.lit(PARTS)).cast("long")


def repeated_anchors(rows: DataFrame, groups: int) -> DataFrame:
    """(o, part, anchor) of the anchors that at least two documents have; ``rows`` has o, h and text."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (data, bounds, _, (ids, _, parts)) in enumerate(_chunks(batches, ("o", "h", "part"))):
            _, _, anchor, text = segments(data, bounds)
            if not len(anchor):
                continue
            uniq, number = np.unique(np.array([ids, parts], dtype=np.int64), axis=1, return_inverse=True)
            pairs = _distinct((anchor << 24) | number.reshape(-1)[text])
            anchor, (owner, part) = pairs >> 24, uniq[:, pairs & 0xFFFFFF]
            first = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            several = ~first
            several[:-1] |= ~first[1:]
            bucket = (anchor[first] * groups) >> ANCHOR_BITS
            cut = np.searchsorted(bucket, np.arange(groups + 1))
            a, o, p = anchor[first], owner[first], part[first]
            blocks = [(b, 0, pack(np.diff(a[i:j], prepend=0), o[i:j], p[i:j]))
                      for b, (i, j) in enumerate(zip(cut[:-1], cut[1:])) if j > i]
            if several.any():       # already known to be repeated
                blocks.append((hash((k, int(anchor[0]))) % groups, 1, pack(anchor[several], owner[several], part[several])))
            yield pa.RecordBatch.from_arrays([pa.array([b[0] for b in blocks], pa.int32()),
                                              pa.array([b[1] for b in blocks], pa.int32()),
                                              pa.array([b[2] for b in blocks], pa.binary())], ["bucket", "kind", "block"])

    def meet(t: pa.Table) -> pa.Table:
        met, known = [], []
        for kind, block in zip(t.column("kind").to_pylist(), t.column("block").to_pylist()):
            x, *document = unpack(block)
            (known if kind else met).append((x if kind else np.cumsum(x), *document))
        if met:
            anchor, owner, part = (np.concatenate(c) for c in zip(*met))
            order = np.lexsort((part, owner, anchor))
            anchor, owner, part = anchor[order], owner[order], part[order]
            new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
            group = np.cumsum(new) - 1
            last = np.append(np.flatnonzero(new)[1:], len(new)) - 1
            ok = ((owner[new] != owner[last]) | (part[new] != part[last]))[group]
            known.append((anchor[ok], owner[ok], part[ok]))
        anchor, owner, part = (np.concatenate(c) for c in zip(*known))
        return pa.table({"o": pa.array(owner, pa.int64()), "part": pa.array(part, pa.int64()), "anchor": pa.array(anchor, pa.int64())})

    dealt = rows.select("o", "h", _part(F.col("h")).alias("part"), "text").mapInArrow(deal, "bucket int, kind int, block binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "o long, part long, anchor long")


def marks(rows: DataFrame, wanted: DataFrame, groups: int) -> DataFrame:
    """(o, h, span): the spans of each text to remove, as start * 2**24 + length.

    ``rows`` has o, h and text, ``wanted`` the repeated anchors by document.
    """
    lists = wanted.groupBy("o", "part").agg(F.collect_set("anchor").alias("anchors"))
    joined = rows.withColumn("part", _part(F.col("h"))).join(lists, ["o", "part"]).select("o", "h", "text", "anchors")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, bounds, piece_at, (ids, hs, anchors) in _chunks(batches, ("o", "h", "anchors")):
            start, end, anchor, text = segments(data, bounds)
            _, number = np.unique(np.array([ids, hs], dtype=np.int64), axis=1, return_inverse=True)
            number = number.reshape(-1)
            # the document first: neighbouring segments are looked up in one place of the list
            listed = _distinct(np.concatenate([np.array(x, dtype=np.int64) | (n << ANCHOR_BITS) for x, n in zip(anchors, number)]))
            sought = anchor | (number[text] << ANCHOR_BITS)
            ok = listed[np.minimum(np.searchsorted(listed, sought), len(listed) - 1)] == sought
            start, end, anchor, text = start[ok], end[ok], anchor[ok], text[ok]
            if not len(start):
                continue
            own, h = np.array(ids, dtype=np.int64)[text], np.array(hs, dtype=np.int64)[text]
            at = start - bounds[text] + piece_at[text]
            raw = data.tobytes()
            strings = [raw[i:j] for i, j in zip(start.tolist(), end.tolist())]
            first: dict[bytes, int] = {}
            lead = np.array([first.setdefault(s, i) for i, s in enumerate(strings)])
            late = own > own[lead]                  # texts are in id order: the lead has the smallest id
            out = [(int(b), 1, pack(own[late][m], h[late][m], (at[late][m] << 24) | (end - start)[late][m]), None)
                   for b, m in _dealt((own[late] ^ h[late]) % groups)]
            stay = np.flatnonzero(~late)
            for b, m in _dealt((anchor[stay] * groups) >> ANCHOR_BITS):
                i = stay[m]
                names, name = np.unique(lead[i], return_inverse=True)       # a string's lead is in its bucket, and stays
                out.append((int(b), 0, pack(name, own[i], h[i], at[i], (end - start)[names]),
                            zstandard.compress(b"".join([strings[x] for x in names.tolist()]), 3)))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                                              pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.binary())],
                                             ["bucket", "kind", "block", "strings"])

    def meet(t: pa.Table) -> pa.Table:
        done, names, parts = [], {}, []
        for kind, block, packed in zip(*(t.column(c).to_pylist() for c in ("kind", "block", "strings"))):
            arrays = unpack(block)
            if kind:
                done.append(arrays)
                continue
            name, own, h, at, size = arrays
            raw, cut = zstandard.decompress(packed), np.concatenate([[0], np.cumsum(size)]).tolist()
            number = np.array([names.setdefault(raw[i:j], len(names)) for i, j in zip(cut[:-1], cut[1:])])
            parts.append((number[name], own, h, at))
        if parts:
            done.append(_settle(list(names), *(np.concatenate(x) for x in zip(*parts))))
        return pa.table({c: pa.array(np.concatenate([d[i] for d in done]), pa.int64())
                         for i, c in enumerate(("o", "h", "span"))})

    dealt = joined.mapInArrow(deal, "bucket int, kind int, block binary, strings binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "o long, h long, span long")


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    values, first = np.unique(bucket[order], return_index=True)
    return zip(values.tolist(), np.split(order, first[1:])) if len(order) else iter(())


def _settle(strings: list[bytes], name: np.ndarray, own: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple:
    """Spans to remove among the occurrences (string number, id, text hash, start) of distinct strings."""
    size = np.array([len(s) for s in strings])
    bounds = np.concatenate([[0], np.cumsum(size)])
    lowest = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(lowest, name, own)
    late = own > lowest[name]                   # the whole string stands in an earlier document
    spans = [(own[late], h[late], (at[late] << 24) | size[name[late]])]
    data = np.frombuffer(b"".join(strings), dtype=np.uint8)
    group, position, length = maximal_repeats(data, bounds)
    if len(group):
        which = np.searchsorted(bounds, position, side="right") - 1
        least = np.full(int(group.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, group, lowest[which])
        # each occurrence in a string stands for one in every document that has the string
        order = np.argsort(name, kind="stable")
        count = np.bincount(name, minlength=len(strings))
        begin = np.cumsum(count) - count
        times = count[which]
        rep = np.repeat(np.arange(len(group)), times)
        occ = order[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + begin[which][rep]]
        late = own[occ] > least[group[rep]]
        rep, occ = rep[late], occ[late]
        spans.append((own[occ], h[occ], ((at[occ] + position[rep] - bounds[which[rep]]) << 24) | length[rep]))
    out = [np.concatenate(x) for x in zip(*spans)]
    keep = np.unique(np.stack(out), axis=1) if len(out[0]) else np.zeros((3, 0), dtype=np.int64)
    return tuple(keep)


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("o"),
                       F.xxhash64(text).alias("h"), text.alias("text"), *more)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(o, h, spans): what to remove from each text; written to the checkpoint folder."""
    groups = groups_for(docs.sparkSession, text_bytes(docs, text_col), GROUP)
    rows = _keyed(docs, id_col, text_col)
    wanted = staged(repeated_anchors(rows, groups))
    found = staged(marks(rows, wanted, groups))
    return found.groupBy("o", "h").agg(F.collect_set("span").alias("spans"))


def _covered(n: int, packed: list[int] | None) -> np.ndarray:
    """Which of n bytes the spans cover."""
    step = np.zeros(n + 1, dtype=np.int64)
    if packed:
        s = np.array(packed, dtype=np.int64)
        np.add.at(step, s >> 24, 1)
        np.add.at(step, (s >> 24) + (s & 0xFFFFFF), -1)
    return np.cumsum(step[:n]) > 0


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                gone = _covered(len(raw), packed)
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                rows.append((len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in
                                    enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    rows = _keyed(docs, id_col, text_col, F.col(id_col).cast("long").alias("doc_id"))
    joined = rows.join(spans(docs, id_col, text_col), ["o", "h"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the repeated strings.  A character goes when all its bytes do; null texts stay null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sp = batch.schema.get_field_index("__text"), batch.schema.get_field_index("__spans")
            out = []
            for text, packed in zip(batch.column(at).to_pylist(), batch.column(sp).to_pylist()):
                if text and packed:
                    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                    gone = _covered(len(raw), packed)
                    begin = np.flatnonzero((raw & 0xC0) != 0x80)
                    whole = np.logical_and.reduceat(gone, begin)
                    keep = ~np.repeat(whole, np.diff(np.append(begin, len(raw))))
                    text = raw[keep].tobytes().decode("utf-8", "surrogatepass")
                out.append(text)
            cols = [pa.array(out, pa.string()) if i == at else c for i, c in enumerate(batch.columns) if i != sp]
            yield pa.RecordBatch.from_arrays(cols, [n for i, n in enumerate(batch.schema.names) if i != sp])
    names = docs.columns
    rows = docs.withColumnRenamed(text_col, "__text").withColumns({
        "__o": F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)), "__h": F.xxhash64(text_of("__text"))})
    found = spans(docs, id_col, text_col).select(F.col("o").alias("__o"), F.col("h").alias("__h"),
                                                 F.col("spans").alias("__spans"))
    joined = rows.join(found, ["__o", "__h"], "left").drop("__o", "__h")
    cut = joined.mapInArrow(run, joined.drop("__spans").schema)
    return cut.withColumnRenamed("__text", text_col).select(*names)
