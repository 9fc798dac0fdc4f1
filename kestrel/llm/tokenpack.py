"""Token ids of all documents as packed matrices.

Documents are tokenised and cut, without loss, into pieces of at most the row
length.  Pieces are dealt to shards by a hash; inside a shard the longest come
first, and a segment tree over free capacities finds the open row with the least
space that holds a piece (best-fit decreasing).  Each row of the result is one
row of an id matrix: the ids, padded, with the cumulative segment lengths and the
places where positions start again from 0, as variable-length attention wants
them.

Defined results: a null text counts as empty; empty documents are in no row; rows
that repeat are packed as often, and which of them goes to which shard depends on
where they are stored; a null id is an id, whose rows are dealt by their texts; pieces
of one length are placed by id, then start.  Ids of the result fit the stated width.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import Copies, text_bytes, text_of
from kestrel.llm.varpack import read_ranks, tokenizer

#: Tokens in a row, tokens in a shard, and bytes of text to a token as a first guess.
ROW, SHARD_TOKENS, BYTES_PER_TOKEN = 2048, 1 << 22, 3
#: Tokens sent at once by a task that tokenises.
SEND = 1 << 20


class CapacityTree:
    """A segment tree over free capacities 0..top: how many open rows have each; finds the least that suffices."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(top + 1)]

    def _add(self, at: int, n: int) -> None:
        at += self.size
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        self._add(space, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(space, row) with the least space of at least ``least``, which then is no longer open."""
        at = least + self.size
        if not self.count[at]:
            # up to the first ancestor with an open row to the right, then down its left side
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        space = at - self.size
        self._add(space, -1)
        return space, self.rows[space].pop()


def best_fit_decreasing(sizes: list[int], row: int = ROW) -> list[list[int]]:
    """Rows as lists of piece numbers, pieces in the order in which they were placed."""
    tree, rows = CapacityTree(row), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found = row, len(rows)
            rows.append([])
        space, at = found
        rows[at].append(i)
        if space > sizes[i]:
            tree.put(space - sizes[i], at)
    return rows


def pieces(docs: DataFrame, ranks_path: str, pattern: str, row: int = ROW, id_col: str = "doc_id", text_col: str = "text",
           shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(shard, doc_id, doc_start, ids): the pieces of all documents, ids as little-endian numbers of the stated width."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    src = src.withColumn("key", F.xxhash64("doc_id", "text"))
    size = text_bytes(src, "text")
    shards = max(1, -(-size // (BYTES_PER_TOKEN * shard_tokens)))
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(sent.value, pattern)
        kind = np.dtype("<u2" if encoder.n_vocab <= 1 << 16 else "<u4")
        out: list[tuple[int | None, int, bytes, int]] = []
        held, copies = 0, Copies()
        for batch in batches:
            for doc, text, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = encoder.encode_to_numpy(text, disallowed_special=()).astype(kind)
                deal = hash((key, copies.next(key)))
                out += [(doc, at, ids[at:at + row].tobytes(), deal) for at in range(0, len(ids), row)]
                held += len(ids)
                if held >= SEND:
                    yield _rows(out)
                    out, held = [], 0
        if out:
            yield _rows(out)
    cut = src.mapInArrow(run, "doc_id long, doc_start long, ids binary, deal long")
    return cut.select("doc_id", "doc_start", "ids", F.pmod(F.xxhash64("deal", "doc_start"), F.lit(shards)).cast("int").alias("shard"))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.binary(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], ["doc_id", "doc_start", "ids", "deal"])


def packed_matrix(docs: DataFrame, ranks_path: str, pattern: str, row: int = ROW, pad: int | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row for each packed sequence.

    seq_id, n_tokens (without padding), ids (binary: ``row`` little-endian numbers, of two bytes when the vocabulary
    fits, padded with ``pad``, which is the first free id unless stated), cu_seqlens (0 and the end of each segment),
    position_resets (where positions start from 0: the start of each segment and of the padding, if any), and for
    each segment its doc_id and its start in the document's tokens.
    """
    ranks = read_ranks(ranks_path)
    vocabulary = tokenizer(ranks, pattern).n_vocab
    fill = vocabulary if pad is None else pad
    kind = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
    if not 0 <= fill <= np.iinfo(kind).max:
        raise ValueError(f"the padding id {fill} does not fit {kind}")

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("doc_start", "ascending")])
        docs_, starts, ids = (t.column(c).to_pylist() for c in ("doc_id", "doc_start", "ids"))
        sizes = [len(x) // kind.itemsize for x in ids]
        out: dict[str, list] = {c: [] for c in ("seq_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "doc_starts")}
        for k, members in enumerate(best_fit_decreasing(sizes, row)):
            ends = np.cumsum([0, *(sizes[i] for i in members)])
            n = int(ends[-1])
            out["seq_id"].append((key[0].as_py() << 32) + k)
            out["n_tokens"].append(n)
            out["ids"].append(b"".join([*(ids[i] for i in members), np.full(row - n, fill, dtype=kind).tobytes()]))
            out["cu_seqlens"].append(ends.astype(np.int32))
            out["position_resets"].append(ends[:len(ends) - (n == row)].astype(np.int32))
            out["doc_ids"].append([docs_[i] for i in members])
            out["doc_starts"].append([starts[i] for i in members])
        many = pa.list_(pa.int64())
        return pa.table({"seq_id": pa.array(out["seq_id"], pa.int64()), "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                         "ids": pa.array(out["ids"], pa.binary()), "cu_seqlens": pa.array(out["cu_seqlens"], pa.list_(pa.int32())),
                         "position_resets": pa.array(out["position_resets"], pa.list_(pa.int32())),
                         "doc_ids": pa.array(out["doc_ids"], many), "doc_starts": pa.array(out["doc_starts"], many)})
    return pieces(docs, ranks_path, pattern, row, id_col, text_col).groupBy("shard").applyInArrow(
        run, "seq_id long, n_tokens long, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, "
             "doc_starts array<long>")


def positions(cu_seqlens: list[int], row: int = ROW) -> np.ndarray:
    """Position ids of a row: from 0 in each segment, and in the padding."""
    out = np.arange(row)
    for a, b in zip(cu_seqlens, [*cu_seqlens[1:], row]):
        out[a:b] -= a
    return out


def write(matrix: DataFrame, path: str) -> None:
    """Write the matrix, one file for each task, as Parquet (binary ids uncompressed are their own matrix rows)."""
    matrix.write.mode("error").parquet(path)
