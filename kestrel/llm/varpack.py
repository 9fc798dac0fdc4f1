"""Variable-capacity best-fit packing of token sequences.

Several sequence lengths are permitted.  Pieces are placed longest first into the
open bin that they fill best.  A piece that fits none opens the bin of least cost:
for each permitted length that holds the piece, the cost of a row of that length
(its tokens and `ROW_COST` for the row itself) is divided by the tokens that can
still be expected to fill it, given the pieces that remain.  So long rows are
opened while there are short pieces to fill them and short ones when they run out.
In the end each bin shrinks to the least permitted length that holds its contents.

Documents are dealt to shards of about `SHARD_PIECES` by a hash of id and text, so packing is
independent of how the input is stored; only lengths move, never tokens.
Documents over the largest length are cut into pieces of it, without loss.

Defined results: a null text counts as empty; an empty document has one row
without a sequence; rows that repeat are packed as often, and which of them goes to
which shard depends on where they are stored; a null id is an id, whose rows are dealt
by their texts.  Pieces of one length are placed by id, then piece.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import Copies, map_batches, staged, text_of

#: Permitted sequence lengths in tokens, and what a row costs besides them.
CAPACITIES = (512, 1024, 2048, 4096)
ROW_COST = 64
#: Documents packed by one task.
SHARD_PIECES = 20_000


def read_ranks(path: str) -> bytes:
    """A rank file, read by the driver and sent to the tasks: a file of fixed size."""
    with open(path, "rb") as f:
        return f.read()


_KEPT: dict[int, tiktoken.Encoding] = {}


def tokenizer(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    key = hash((ranks, pattern))
    if key not in _KEPT:
        _KEPT.clear()
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _KEPT[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _KEPT[key]


class Shelf:
    """Open bins by free space; the fullest that holds a piece is found in logarithmic time."""

    def __init__(self):
        self.spaces: list[int] = []
        self.bins: dict[int, list[int]] = {}

    def put(self, space: int, name: int) -> None:
        if space:
            if space not in self.bins:
                self.bins[space] = []
                insort(self.spaces, space)
            self.bins[space].append(name)

    def take(self, size: int) -> tuple[int, int] | None:
        """(space, bin) of the least space of at least ``size``."""
        at = bisect_left(self.spaces, size)
        if at == len(self.spaces):
            return None
        space = self.spaces[at]
        name = self.bins[space].pop()
        if not self.bins[space]:
            del self.bins[space]
            del self.spaces[at]
        return space, name


def pack(sizes: list[int], capacities: tuple[int, ...] = CAPACITIES, row_cost: int = ROW_COST
         ) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the final capacity of each bin.  Pieces are at most the largest capacity."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    # tokens of all pieces of at most each size that remain to be placed
    left = np.bincount(np.array(sizes, dtype=np.int64), weights=sizes, minlength=capacities[-1] + 1).cumsum() if sizes else None
    shelf, bin_of, offset, used = Shelf(), [0] * len(sizes), [0] * len(sizes), []
    placed = 0                      # tokens placed so far; longer pieces are all placed
    total = sum(sizes)
    for i in order:
        size = sizes[i]
        found = shelf.take(size)
        if found is None:
            best = None
            for c in capacities:
                if c >= size:
                    remain = min(float(left[c - size]), total - placed - size)
                    fill = min(c, size + remain)
                    cost = (c + row_cost) / fill
                    if best is None or cost < best[0]:
                        best = (cost, c)
            found = best[1], len(used)
            used.append(0)
        space, name = found
        bin_of[i], offset[i] = name, used[name]
        used[name] += size
        placed += size
        shelf.put(space - size, name)
    return bin_of, offset, [next(c for c in capacities if c >= u) for u in used]


def lengths(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and n_tokens of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = tokenizer(sent.value, pattern).encode_to_numpy
        n = [len(encode(t, disallowed_special=())) if t else 0 for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(src, "doc_id long, n_tokens long", run)


def _dealt_lengths(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str) -> DataFrame:
    """`lengths` with ``deal``, a hash of id, text and, for rows that repeat, the copy's number in its task."""
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, copies = tokenizer(sent.value, pattern).encode_to_numpy, Copies()
        for b in batches:
            n = [len(encode(t, disallowed_special=())) if t else 0 for t in b.column(1).to_pylist()]
            keys = b.column(2).to_pylist()
            deal = [hash((k, copies.next(k))) for k in keys]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(deal, pa.int64())], ["doc_id", "n_tokens", "deal"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return src.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).mapInArrow(run, "doc_id long, n_tokens long, deal long")


def packed(sizes: DataFrame, capacities: tuple[int, ...] = CAPACITIES, row_cost: int = ROW_COST,
           shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Where each piece of each document goes.

    ``sizes`` has doc_id and n_tokens, and may have a long ``deal`` that says where rows of one id go apart.  Returns doc_id, piece (from 0), doc_start and n_tokens of the piece,
    seq_id, capacity (the length of the sequence after downsizing) and seq_start.
    """
    capacities, top = tuple(sorted(capacities)), max(capacities)
    sizes = staged(sizes)
    shards = max(1, -(-sizes.count() // shard_pieces))
    pieces = sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n_tokens") / top) - 1, F.lit(0))
                                                            .cast("int"))))
    pieces = pieces.select(
        "doc_id", "piece", (F.col("piece") * F.lit(top).cast("long")).alias("doc_start"),
        F.least(F.col("n_tokens") - F.col("piece") * top, F.lit(top).cast("long")).alias("n_tokens"),
        F.pmod(F.xxhash64("deal" if "deal" in sizes.columns else "doc_id", "piece"), F.lit(shards)).cast("int").alias("shard"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("n_tokens", "ascending")])
        n = t.column("n_tokens").to_numpy()
        full = np.flatnonzero(n > 0)
        bins, offsets, caps = pack(n[full].tolist(), capacities, row_cost)
        seq, cap, start = np.full(len(n), -1), np.full(len(n), -1), np.full(len(n), -1)
        if len(full):
            seq[full] = (key[0].as_py() << 32) + np.array(bins)
            cap[full], start[full] = np.array(caps)[bins], offsets
        empty = n == 0
        return pa.table([t.column("doc_id"), t.column("piece"), t.column("doc_start"), t.column("n_tokens"),
                         *(pa.array(a, pa.int64(), mask=empty) for a in (seq, cap, start))],
                        names=["doc_id", "piece", "doc_start", "n_tokens", "seq_id", "capacity", "seq_start"])
    return pieces.groupBy("shard").applyInArrow(run, "doc_id long, piece int, doc_start long, n_tokens long, seq_id long, "
                                                     "capacity long, seq_start long")


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`packed` for the token counts of the documents' texts."""
    return packed(_dealt_lengths(docs, ranks_path, pattern, id_col, text_col))


def sequences(placed: DataFrame) -> DataFrame:
    """One row for each sequence: seq_id, capacity, n_tokens, and its pieces in order."""
    return placed.where("seq_id IS NOT NULL").groupBy("seq_id").agg(
        F.first("capacity").alias("capacity"), F.sum("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("seq_start", "doc_id", "doc_start", "n_tokens"))).alias("pieces"))

