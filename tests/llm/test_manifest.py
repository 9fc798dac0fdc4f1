"""The Merkle manifest against a plain build of the whole tree."""

import hashlib
import zlib

import duckdb
import pytest
from cases import SMALL, messy

from kestrel.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return H(*map(field, (r["doc_id"], r["source"], r["lang"], n, r["text"])))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain(rows):
    """The rows of `audit`, from whole trees in memory."""
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = {}
    for k in order:
        trees[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        built[k] = plain_levels([leaf(r) for r in trees[k]])
    top = plain_levels([built[k][-1][0] for k in order])
    out = []
    for t, k in enumerate(order):
        for p, r in enumerate(trees[k]):
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node, proof = leaf(r, int(bad)), []
            for levels, i in ((built[k], p), (top, t)):
                for level in levels[:-1]:
                    other = level[i ^ 1:(i ^ 1) + 1]
                    proof += other
                    node = H(node) if not other else H(other[0], node) if i & 1 else H(node, other[0])
                    i >>= 1
            out.append((r["doc_id"], leaf(r), built[k][-1][0], top[-1][0], H(*proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def test_messy_rows(spark):
    docs = messy(spark)
    got = sorted((tuple(r) for r in merkle.audit(docs).collect()), key=str)
    assert got == plain(docs.collect())
    assert merkle.audit(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 257])
def test_sizes_of_trees(spark, n):
    docs = spark.createDataFrame([(i, f"text {i}", "s", "a" if i < n else None, 6) for i in range(n + 1)],
                                 "doc_id long, text string, source string, lang string, n_chars long")
    got = sorted((tuple(r) for r in merkle.audit(docs).collect()), key=str)
    assert got == plain(docs.collect())


def test_many_keys_and_one_hot_id(spark):
    rows = [(None if i % 3 == 0 else i, "same" if i % 2 else f"t{i}", "s", f"l{i % 40:02}é", None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    assert sorted((tuple(r) for r in merkle.audit(docs).collect()), key=str) == plain(docs.collect())


def test_proofs_of_a_stored_manifest_refuse_changes(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    m = merkle.build(merkle.leaves(docs))
    m.write(str(tmp_path / "m"))
    again = merkle.Manifest.read(spark, str(tmp_path / "m"), len(m.trees), len(m.top))
    assert again.root() == m.root()
    rows = merkle.proofs(again).collect()
    assert len(rows) == docs.count()
    for r in rows[:40]:
        proof = [bytes(p) for p in r.siblings]
        assert merkle.fold(bytes(r.h), r.sides, proof) == m.root()
        assert merkle.fold(bytes(31) + b"\1", r.sides, proof) != m.root()
        if proof:
            assert merkle.fold(bytes(r.h), r.sides, [*proof[:-1], bytes(32)]) != m.root()
    # only every fourth level is stored
    sizes = [level.count() for level in m.trees]
    assert all(b <= -(-a // 16) + 4 for a, b in zip(sizes, sizes[1:]))


def test_small_table_against_sql(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    names = merkle.audit(docs).columns
    want = con.execute(f"SELECT {', '.join(names)} FROM ({merkle.SQL})").fetchall()
    assert sorted((tuple(r) for r in merkle.audit(docs).collect()), key=str) == sorted(want, key=str) == plain(docs.collect())
