"""Ids that repeat, many labels, rows that share an id: whole results, and no task with all of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_repeats

from kestrel.llm import components, html_blocks, langid, suffix_dedup, tokenpack, varpack
from kestrel.llm.vocab import BYTE_RANKS, PATTERN

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


def prose(r, n):
    return " ".join(r.choice(WORDS, n))


@pytest.mark.parametrize("same", [None, 1])
def test_main_text_when_all_ids_are_equal_or_null(spark, same, monkeypatch):
    monkeypatch.setattr(html_blocks, "TRAIN_PAGES", 60)
    r = np.random.default_rng(1)
    pages = [(same, "u", f"<html><body><nav><a href=x>menu item</a></nav><article><h1>{prose(r, 6)}</h1><p>{prose(r, 40)}</p></article>"
                         f"<footer>copyright {prose(r, 3)}</footer></body></html>") for _ in range(300)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = html_blocks.main_text(df).collect()
    assert len(out) == 300 and sum(bool(x.text) for x in out) > 290
    # one page that is there many times is a sample too
    again = html_blocks.main_text(spark.createDataFrame([pages[0]] * 40, df.schema)).collect()
    assert {x.text != "" for x in again} == {True}


def test_every_label_is_learned(spark):
    r = np.random.default_rng(2)
    rows = []
    for k in range(1100):
        letters = [chr(0x4E00 + 12 * k + i) for i in range(12)]
        rows += [(4 * k + d, " ".join("".join(r.choice(letters, 4)) for _ in range(12)), f"l{k:04}") for d in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    table = langid.profile_table(docs)
    held = {x.lang for x in docs.where(~langid.held_out("doc_id")).select("lang").distinct().collect()}
    assert {x.lang for x in table.select("lang").distinct().collect()} == held and len(held) > 1000
    got = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(x.lang_pred == x.lang for x in got if x.lang in held)
    # slices give what one piece gives
    src = docs.select("doc_id", "text")
    one = {x.doc_id: (x["__lang"], x["__score"]) for x in langid.labelled(src, "text", table).collect()}
    cut = {x.doc_id: (x["__lang"], x["__score"]) for x in langid.labelled(src, "text", table, size=300).collect()}
    assert one == cut


def plain_best(profiles, text):
    found = langid.ranked(langid.grams(text)).tolist()
    if not found:
        return langid.UNDETERMINED, 0.0
    best = None
    for name in sorted(profiles):
        place = {c: i for i, c in enumerate(profiles[name])}
        out = sum(min(abs(place[c] - i), langid.TOP) if c in place else langid.TOP for i, c in enumerate(found))
        if best is None or out < best[0]:
            best = out, name
    return best[1], 1 - best[0] / (langid.TOP * len(found))


def test_distances_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    profiles = langid.learn(docs)
    want = {r.doc_id: plain_best(profiles, r.text) for r in docs.collect()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs).collect()}
    assert got.keys() == want.keys()
    for k, (name, score) in want.items():
        assert got[k][0] == name and abs(got[k][1] - score) < 1e-12


def hot_rows():
    """A third of the rows has no id, another third is one row again and again."""
    r = np.random.default_rng(3)
    shared = prose(r, 30)
    rows = [(None, f"{prose(r, 12)} {shared if i % 4 == 0 else ''} {prose(r, 8)}") for i in range(60)]
    rows += [(7, "the same row " + shared)] * 60
    rows += [(100 + i, f"{prose(r, 10)} {shared if i % 3 == 0 else ''}") for i in range(60)]
    return rows


def test_repeats_when_many_rows_share_an_id(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2000)        # several chunks for each task
    rows = hot_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((r.doc_id if r.doc_id is not None else 1 << 62, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest(docs).collect())
    keyed = sorted(((1 << 62) if i is None else i, t) for i, t in rows)
    assert got == sorted(brute_repeats(keyed))


def test_shards_stay_even_when_many_rows_share_an_id(spark):
    rows = hot_rows() * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    dealt = varpack._dealt_lengths(docs, BYTE_RANKS, PATTERN, "doc_id", "text")
    placed = varpack.packed(dealt, shard_pieces=60)
    sizes = [r["count"] for r in placed.groupBy(F.shiftright("seq_id", 32)).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 2.5 * len(rows) / len(sizes)
    pieces = tokenpack.pieces(docs, BYTE_RANKS, PATTERN, shard_tokens=600).groupBy("shard").count().collect()
    assert sum(r["count"] for r in pieces) == len(rows) and max(r["count"] for r in pieces) < 3 * len(rows) / len(pieces)


def test_best_fit_takes_the_least_cost_by_brute_force():
    """Every piece goes to the open bin that it fills best; a new bin is the one of least cost."""
    r = np.random.default_rng(4)
    for _ in range(30):
        sizes = r.integers(1, 4097 if r.random() < 0.5 else 900, int(r.integers(1, 120))).tolist()
        bins, starts, _ = varpack.pack(sizes)
        space: dict[int, int] = {}
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
        left, placed = list(order), 0
        for i in order:
            open_ = [s for s in space.values() if s >= sizes[i]]
            if bins[i] in space:
                assert space[bins[i]] == min(open_)
            else:
                assert not open_
                def cost(c, i=i, placed=placed):
                    fits = sum(s for s in sizes if s <= c - sizes[i])
                    remain = min(fits, sum(sizes) - placed - sizes[i])
                    return (c + varpack.ROW_COST) / min(c, sizes[i] + remain)
                best = min((c for c in varpack.CAPACITIES if c >= sizes[i]), key=cost)
                space[bins[i]] = best
            space[bins[i]] -= sizes[i]
            left.remove(i)
            placed += sizes[i]


def test_hot_nodes_of_a_graph(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT", 50)
    star = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 2000)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(star, "a long, b long")).collect()}
    assert {got[i] for i in [*range(400), 2000]} == {0} and {got[i] for i in range(1000, 1061)} == {1000}


def test_installed_package_lists_the_queries(tmp_path):
    """What the packaging file installs imports on its own and has all queries."""
    import os
    import shutil
    import subprocess
    import sys
    import tomllib
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    with open(f"{top}/pyproject.toml", "rb") as f:
        spec = tomllib.load(f)["tool"]["setuptools"]
    for m in spec["py-modules"]:
        shutil.copy(f"{top}/{m}.py", tmp_path)
    shutil.copytree(f"{top}/kestrel", tmp_path / "kestrel")
    out = subprocess.run([sys.executable, "-c", "from kestrel.llm.queries import QUERIES; print(sum(q.startswith('op') for q in QUERIES))"],
                         cwd="/", env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("13"), out.stderr[-800:]
