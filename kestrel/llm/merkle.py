"""Merkle manifest of a dataset, by checkpoint and recompute.

Every row is a leaf; the leaves of one key (here: of one language) form a tree, and
the roots of these trees form the top tree, whose root stands for the dataset.
Only every ``EVERY``-th level of a tree is stored, starting with its leaves.  What
lies between two stored levels is a set of aligned subtrees of at most
``2 ** EVERY`` nodes: the build hashes each to its one node of the next stored
level, and proof extraction regenerates its interior from the stored nodes, hands
each of them its siblings and forgets the interior again.  Proofs go from the root
down, one join of subtrees with the proof of their upper node for each stored
level, so a proof of any length touches each leaf once.

Digests: ``H`` is sha256 over concatenated inputs, digests as lowercase hex text.  A
field is ``-`` if null, else its UTF-8 byte count, ``:`` and the value.  Two
neighbours become their H, the last one without a neighbour its own H, until one
remains; a lone leaf is its own root.

Defined results: a null key is a tree of its own and the first in the top tree, the
others follow bytewise.  Leaves of a tree ascend by id, a null id first, ties by
digest; rows that repeat are leaves as often.  No rows: no result.  Other
columns are ignored.  Row numbers come from a range partitioning, so no tree of any
size passes through one task; one number for each partition reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import map_batches, staged

#: Levels from one stored level to the next; subtrees have two to the power of it nodes at most.
EVERY = 4
#: The fields of a row that its leaf covers.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Sides of a sibling: before, after, and a node without one.
LEFT, RIGHT, LONE = "L", "R", "-"


def digest(*nodes: bytes) -> bytes:
    """H of digests."""
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def interior(nodes: Sequence[bytes], first: bool, every: int = EVERY) -> list[list[bytes]]:
    """All levels of an aligned subtree, the stored nodes first and the one upper node last.

    A first subtree that is not full is the whole tree and ends at its root; any other has ``every`` levels.
    """
    levels = [list(nodes)]
    whole = first and len(nodes) < 1 << every
    while len(levels[-1]) > 1 or (not whole and len(levels) <= every):
        last = levels[-1]
        levels.append([digest(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def siblings(levels: list[list[bytes]], i: int) -> tuple[str, list[bytes]]:
    """The sides, one letter for each level, and the siblings that there are, of stored node ``i``."""
    sides, found = "", []
    for level in levels[:-1]:
        other = i ^ 1
        if other < len(level):
            sides += LEFT if other < i else RIGHT
            found.append(level[other])
        else:
            sides += LONE
        i >>= 1
    return sides, found


def fold(leaf: bytes, sides: str, proof: Sequence[bytes]) -> bytes:
    """The root that a leaf and its siblings give."""
    rest, node = iter(proof), leaf
    for side in sides:
        node = digest(node) if side == LONE else digest(next(rest), node) if side == LEFT else digest(node, next(rest))
    return node


def leaf_of(fields: Sequence[Column]) -> Column:
    """H of the fields of a row, as binary."""
    def one(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(one, fields)).cast("binary"), 256))


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, key_col: str = "lang", id_col: str = "doc_id",
           claimed: Column | None = None) -> DataFrame:
    """tree, doc_id, h (the leaf) and claimed of every row; ``claimed`` is a leaf to be proved in its place, or null."""
    key = F.coalesce(F.concat(F.lit("="), F.col(key_col).cast("string")), F.lit(""))
    return docs.select(key.alias("tree"), F.col(id_col).cast("long").alias("doc_id"),
                       leaf_of([F.col(c) for c in fields]).alias("h"),
                       (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed"))


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``pos``, from 0 in each ``tree``, by ``order``; which of equal rows comes first makes no difference."""
    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # equal rows get numbers of their own, or they could not be parted between tasks
    by = [F.col("tree").asc(), *[F.col(c).asc_nulls_first() for c in order], F.col("__equal").asc()]
    rows = staged(rows.withColumn("__equal", F.monotonically_increasing_id()))
    ranged = staged(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("__equal"))
    at = F.monotonically_increasing_id()
    ranged = ranged.withColumns({"__part": F.shiftright(at, 33).cast("int"), "__at": at.bitwiseAND(F.lit((1 << 33) - 1))})
    # only the first tree of a partition can have begun in one before it
    runs = ranged.groupBy("__part", "tree").agg(F.count(F.lit(1)).alias("n"))
    ends = runs.groupBy("__part").agg(F.min(F.struct("tree", "n")).alias("first"), F.max(F.struct("tree", "n")).alias("last"))
    before, tree, n = {}, None, 0
    for r in sorted(ends.collect(), key=lambda r: r["__part"]):
        before[r["__part"]] = n if r["first"]["tree"] == tree else 0
        n = r["last"]["n"] + (before[r["__part"]] if r["last"]["tree"] == r["first"]["tree"] else 0)
        tree = r["last"]["tree"]
    fields = [f for f in ranged.schema.fields if not f.name.startswith("__")]
    width = len(fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            trees = b.column(b.schema.get_field_index("tree")).to_pylist()
            if now is None:
                now, n = trees[0], before[b.column(width)[0].as_py()]
            pos = np.empty(len(trees), dtype=np.int64)
            for i, t in enumerate(trees):
                if t != now:
                    now, n = t, 0
                pos[i] = n
                n += 1
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(pos)], [*b.schema.names[:width], "pos"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return ranged.drop("__at").mapInArrow(count, f"{schema}, pos long")


def _subtrees(level: DataFrame, every: int, *more: str) -> DataFrame:
    """(tree, pos, members): the aligned subtrees over a stored level, named by their upper node."""
    up = F.shiftright("pos", every)
    return (level.groupBy("tree", up.alias("up")).agg(F.sort_array(F.collect_list(F.struct("pos", "h", *more))).alias("members"))
            .select("tree", F.col("up").alias("pos"), "members"))


def _raised(level: DataFrame, every: int) -> DataFrame:
    """The next stored level."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pos = batch.column(1).to_pylist()
        tops = [interior([m["h"] for m in members], p == 0, every)[-1][0] for p, members in zip(pos, batch.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(tops, pa.binary())], ["tree", "pos", "h"])
    return map_batches(_subtrees(level, every), "tree string, pos long, h binary", run)


@dataclass
class Manifest:
    """The stored levels of the trees and of the top tree, lowest first; each ends with a level of roots only.

    Levels have the columns tree, pos and h, the leaves doc_id and claimed as well; the top tree's tree is ''
    and its leaves carry the tree that they are the root of as ``of``.
    """
    trees: list[DataFrame]
    top: list[DataFrame]
    every: int = EVERY

    def write(self, folder: str) -> None:
        """Store all levels as Parquet."""
        for name, levels in (("trees", self.trees), ("top", self.top)):
            for k, level in enumerate(levels):
                level.write.mode("error").parquet(f"{folder}/{name}/{k}-{len(levels)}")

    @classmethod
    def read(cls, spark: SparkSession, folder: str, trees: int, top: int, every: int = EVERY) -> Manifest:
        """The manifest of ``write``, given its numbers of stored levels."""
        return cls([spark.read.parquet(f"{folder}/trees/{k}-{trees}") for k in range(trees)],
                   [spark.read.parquet(f"{folder}/top/{k}-{top}") for k in range(top)], every)

    def root(self) -> bytes | None:
        """The root of the dataset; None without rows."""
        row = self.top[-1].select("h").first()
        return None if row is None else bytes(row["h"])


def _levels(level: DataFrame, every: int) -> list[DataFrame]:
    out = [level]
    while out[-1].where("pos > 0").limit(1).count():
        out.append(staged(_raised(out[-1], every)))
    return out


def build(rows: DataFrame, every: int = EVERY) -> Manifest:
    """The manifest of `leaves`; stored levels are written to the checkpoint folder."""
    trees = _levels(staged(numbered(rows, ["doc_id", "h"])), every)
    tops = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h")
    return Manifest(trees, _levels(staged(numbered(tops, ["of"])), every), every)


def _lowered(level: DataFrame, above: DataFrame, every: int, more: dict[str, str], carried: dict[str, str]) -> DataFrame:
    """Proofs of the nodes of a stored level, from those of the level above: its subtrees are regenerated one by one."""
    names = ["tree", "pos", "h", *more, "sides", "siblings", *carried]
    types = {"tree": "string", "pos": "long", "h": "binary", **more, "sides": "string", "siblings": "array<binary>", **carried}
    arrow = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    joined = _subtrees(level, every, *more).join(above.select("tree", "pos", "sides", "siblings", *carried), ["tree", "pos"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {n: [] for n in names}
        for row in batch.to_pylist():
            members = row["members"]
            levels = interior([m["h"] for m in members], row["pos"] == 0, every)
            for i, m in enumerate(members):
                sides, found = siblings(levels, i)
                here = {**row, **m, "sides": sides + row["sides"], "siblings": found + row["siblings"]}
                for n in names:
                    out[n].append(here[n])
        return pa.RecordBatch.from_arrays([pa.array(out[n], arrow[types[n]]) for n in names], names)
    return map_batches(joined, ", ".join(f"{n} {types[n]}" for n in names), run)


def _descend(levels: list[DataFrame], every: int, start: DataFrame, more: dict[str, str], carried: dict[str, str]) -> DataFrame:
    if len(levels) == 1:        # roots only: leaves are their own roots
        return levels[0].join(start.drop("pos"), "tree").select("tree", "pos", "h", *more, "sides", "siblings", *carried)
    for k in range(len(levels) - 2, -1, -1):
        start = _lowered(levels[k], start, every, more if k == 0 else {}, carried)
    return start


def proofs(manifest: Manifest) -> DataFrame:
    """Of every leaf: tree, pos, h, doc_id, claimed, sides, siblings (from the leaf to the root), subroot, root."""
    nothing = [F.lit("").alias("sides"), F.array().cast("array<binary>").alias("siblings")]
    start = manifest.top[-1].select("tree", "pos", *nothing, F.col("h").alias("root"))
    top = _descend(manifest.top, manifest.every, start, {"of": "string"}, {"root": "binary"})
    start = top.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "sides", "siblings",
                       F.col("h").alias("subroot"), "root")
    return _descend(manifest.trees, manifest.every, start, {"doc_id": "long", "claimed": "binary"},
                    {"subroot": "binary", "root": "binary"})


def checked(proved: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every proof.

    Folded is the claimed leaf where there is one, else the leaf itself.
    """
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, leaf, claimed, subroot, root, sides, proof = (c.to_pylist() for c in batch.columns)
        folded = [fold(c or h, s, p) for h, c, s, p in zip(leaf, claimed, sides, proof)]
        texts = [[x.hex() for x in col] for col in (leaf, subroot, root, [digest(*p) for p in proof], folded)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(t, pa.string()) for t in texts),
                                           pa.array([a == b for a, b in zip(folded, root)], pa.bool_())], names)
    return map_batches(proved.select("doc_id", "h", "claimed", "subroot", "root", "sides", "siblings"),
                       "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
                       run)


def tampered(every_nth: int = 7, id_col: str = "doc_id", count_col: str = "n_chars", fields: Sequence[str] = FIELDS) -> Column:
    """The leaf of a row whose ``count_col`` was raised by one, where the id's crc32 is divisible; else null."""
    crc = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))
    return F.when(crc % every_nth == 0, leaf_of([F.col(c) + 1 if c == count_col else F.col(c) for c in fields]))


def audit(docs: DataFrame, change: Callable[[], Column] = tampered) -> DataFrame:
    """Build the manifest of the documents and hold every row, some of them tampered with, against it."""
    return checked(proofs(build(leaves(docs, claimed=change()))))


#: The same in DuckDB: levels by recursion, siblings by a join for each level.
SQL = """
WITH RECURSIVE bits AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL
), crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(8 * strlen(s)),
      lambda i: CAST((ascii(substr(s, CAST(i // 8 + 1 AS BIGINT), 1)) >> CAST(i % 8 AS INTEGER)) & 1 AS BIGINT))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)))) AS c FROM bits
), fields AS (
  SELECT d.doc_id, lang, coalesce('=' || lang, '') AS tree, n_chars,
    coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(text) || ':' || text, '-') AS z, coalesce(c % 7 = 0, false) AS touched
  FROM documents d LEFT JOIN crc ON crc.doc_id = d.doc_id
), leaf AS (
  SELECT doc_id, tree, sha256(a || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || z) AS h,
    CASE WHEN touched THEN sha256(a || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || z) END AS claimed
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaf
), node AS (
  SELECT 0 AS level, tree, pos, h, n FROM placed
  UNION ALL
  SELECT level + 1, tree, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM node WHERE n > 1
  GROUP BY level, tree, pos // 2, n
), sub AS (
  SELECT tree, h, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1
), upper AS (
  SELECT 0 AS level, pos, h, n FROM sub
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM upper WHERE n > 1 GROUP BY level, pos // 2, n
), root AS (SELECT h, level AS height FROM upper WHERE n = 1
), every AS (
  SELECT p.tree, p.pos, p.h AS leaf, p.doc_id, p.claimed, s.h AS subroot, s.pos AS spot, s.height, r.h AS root, r.height + s.height AS steps
  FROM placed p JOIN sub s USING (tree) CROSS JOIN root r
), sib AS (
  SELECT e.tree, e.pos, e.steps, l.level, CASE WHEN l.level < e.height THEN (e.pos >> l.level) % 2 ELSE (e.spot >> (l.level - e.height)) % 2 END AS odd,
    coalesce(x.h, u.h) AS h
  FROM every e JOIN (SELECT unnest(range(80)) AS level) l ON l.level < e.steps
  LEFT JOIN node x ON l.level < e.height AND x.tree = e.tree AND x.level = l.level AND x.pos = xor(e.pos >> l.level, 1)
  LEFT JOIN upper u ON l.level >= e.height AND u.level = l.level - e.height AND u.pos = xor(e.spot >> (l.level - e.height), 1)
), proof AS (SELECT tree, pos, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof_sha256 FROM sib GROUP BY tree, pos
), fold AS (
  SELECT tree, pos, CAST(0 AS BIGINT) AS level, steps, coalesce(claimed, leaf) AS h FROM every
  UNION ALL
  SELECT f.tree, f.pos, f.level + 1, f.steps,
    sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.odd = 1 THEN s.h || f.h ELSE f.h || s.h END)
  FROM fold f JOIN sib s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level
)
SELECT e.doc_id, e.leaf, e.subroot, e.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = e.root AS verified
FROM every e LEFT JOIN proof p ON p.tree = e.tree AND p.pos = e.pos JOIN fold f ON f.tree = e.tree AND f.pos = e.pos AND f.level = f.steps
"""
