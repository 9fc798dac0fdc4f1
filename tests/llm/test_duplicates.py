"""Near-duplicates and repeats against brute force."""

import collections
import hashlib

import numpy as np
import pytest
from cases import SMALL, messy
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import jaccard_forest, projection_passes, suffix_dedup
from kestrel.llm.components import components, roots

NULL = (1 << 63) - 1


def brute_repeats(rows, least=50):
    """Bytes to remove from each (id, text), by the definition."""
    first: dict[bytes, int] = {}
    for i, t in sorted(((NULL if i is None else i, t or "") for i, t in rows)):
        b = t.encode()
        for p in range(len(b) - least + 1):
            first.setdefault(b[p:p + least], i)
    out = []
    for i, t in rows:
        b, own = (t or "").encode(), NULL if i is None else i
        gone = bytearray(len(b))
        for p in range(len(b) - least + 1):
            if first[b[p:p + least]] < own:
                gone[p:p + least] = b"\1" * least
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len([r for r in bytes(gone).split(b"\0") if r]), hashlib.sha256(kept).hexdigest()))
    return out


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (str(r[0]), r[-1]))


def check_repeats(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(suffix_dedup.digest(docs).collect()) == by_id(brute_repeats(rows))


def test_repeats_of_messy_rows(spark):
    docs = messy(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert by_id(suffix_dedup.digest(docs).collect()) == by_id(brute_repeats(rows))
    out = suffix_dedup.strip(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[8] == "" and texts[4] is None and texts[7] == "é" * 60 and texts[14] == "hi there"
    assert suffix_dedup.digest(docs.limit(0)).count() == 0


def test_repeats_of_overlapping_passages(spark):
    r = np.random.default_rng(4)
    base = ["".join(r.choice(list("abcdé "), 260)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.integers(0, 4)):
            t = base[r.integers(6)]
            a = int(r.integers(0, 200))
            parts.append(t[a:a + int(r.integers(30, 140))])
        rows.append((int(r.integers(0, 40)), "".join(parts)))
    check_repeats(spark, rows)


def test_repeats_of_periodic_texts(spark):
    check_repeats(spark, [(3, "ab" * 200), (1, "ba" * 60), (2, "aab" * 90), (5, "a" * 49), (6, "a" * 50), (7, "a" * 51), (4, "x" + "ab" * 30)])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), min_size=1, max_size=6), st.integers(2, 9))
def test_maximal_repeats_by_definition(strings, least):
    raw = [s.encode() for s in strings]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in raw])])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    group, at, size = suffix_dedup.maximal_repeats(data, bounds, least)
    got = collections.defaultdict(set)
    for g, p, n in zip(group.tolist(), at.tolist(), size.tolist()):
        got[g, n].add(p)
    found = {data[min(ps):min(ps) + n].tobytes(): ps for (_, n), ps in got.items()}
    places = collections.defaultdict(set)
    for s, start in zip(raw, bounds.tolist()):
        for i in range(len(s)):
            for j in range(i + least, len(s) + 1):
                places[s[i:j]].add(start + i)
    starts, ends = set(bounds[:-1].tolist()), set(bounds[1:].tolist())
    text = data.tobytes()
    want = {}
    for w, ps in places.items():
        left = {-1 - p if p in starts else text[p - 1] for p in ps}
        right = {-1 - p if p + len(w) in ends else text[p + len(w)] for p in ps}
        if len(ps) > 1 and len(left) > 1 and len(right) > 1:
            want[w] = ps
    assert found == want


def test_components(spark):
    r = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {k: v for k, v in roots(iter(e for e in edges if e[0] != e[1])).items()}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def brute_links(texts):
    sets = [frozenset((lambda w: [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else [])((t or "").lower().split())) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    return links


def check_join(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    links = brute_links([t for _, t in rows])
    degree = collections.Counter(x for e in links for x in e)
    top = roots(iter((i, j) for i, j in links))
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[top.get(i, i)].append(NULL if rows[i][0] is None else rows[i][0])
    want = sorted((str(rows[i][0]), str(None if min(members[top.get(i, i)]) == NULL else min(members[top.get(i, i)])), degree[i]) for i in range(len(rows)))
    got = jaccard_forest.classes_of(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == want
    return got


def test_join_of_messy_rows(spark):
    docs = messy(spark)
    check_join(docs)
    out = jaccard_forest.first_of_each(docs)
    ids = [r["doc_id"] for r in out.collect()]
    assert out.columns == docs.columns and 11 in ids and 12 not in ids and 13 not in ids and 10 not in ids
    assert ids.count(3) == 1 and ids.count(1) == 1
    assert jaccard_forest.classes_of(docs.limit(0)).count() == 0


def test_join_of_a_group_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_forest, "BLOCK", 16)
    r = np.random.default_rng(6)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        mine = list(words)
        for k in r.integers(0, 120, int(r.integers(0, 5))):
            mine[k] = f"x{i}"
        rows.append((1000 - i, " ".join(mine)))
    rows += [(i, " ".join(f"{i}-{k}" for k in range(30))) for i in range(20)]
    got = check_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r.kept for r in got) >= 21


def test_join_of_the_small_table(spark):
    check_join(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_prefixes_are_as_long_as_the_recall_allows():
    for s in (0.5, 0.8, 0.95):
        n = jaccard_forest.prefix_length(s, 64, 12, 0.99)
        assert 1 - (1 - s ** n) ** 64 >= 0.99 and (n == 12 or 1 - (1 - s ** (n + 1)) ** 64 < 0.99)
    with pytest.raises(ValueError):
        jaccard_forest.prefix_length(0.1, 2, 4, 0.99)


def check_vectors(rows, got, threshold=0.95):
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    scaled = [np.array(v, dtype=float) / np.abs(v).max() if good(v) else None for _, v in rows]
    units = [None if v is None else v / np.linalg.norm(v) for v in scaled]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold]
    degree, top = collections.Counter(x for e in links for x in e), roots(iter(links))
    members = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        members[top.get(i, i)].append(NULL if k is None else k)
    want = []
    for i, (k, _) in enumerate(rows):
        low = min(members[top.get(i, i)])
        want.append((str(k), degree[i], str(None if low == NULL else low), low == (NULL if k is None else k)))
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == sorted(want)


def test_vectors(spark):
    r = np.random.default_rng(7)
    rows = []
    for _ in range(60):
        v = r.standard_normal(16)
        rows += [v + 0.12 * r.standard_normal(16) for _ in range(r.integers(1, 9))]
    rows = [(int(k), v.tolist()) for k, v in zip(r.permutation(len(rows)), rows)]
    rows += [(5000, rows[3][1]), (5001, rows[3][1]), (5001, rows[3][1]), (5002, [2 * x for x in rows[3][1]]), (5003, None), (5004, []), (5005, [0.0] * 16),
             (5006, [float("nan")] * 16), (5007, [1.0, None]), (5008, [float("inf"), 1.0]), (5009, [1.0, 2.0]), (5010, [1.0, 2.0, 0.0]),
             (None, rows[3][1]), (5011, [1e300, 2e300]), (5012, [1e-300, 2e-300])]
    df = spark.createDataFrame([(a, b, 1, "z") for a, b in rows], "vec_id long, embedding array<double>, n_links int, c string")
    check_vectors(rows, projection_passes.link(df).collect())
    assert projection_passes.link(df.limit(0)).count() == 0


def test_a_large_group_of_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(projection_passes, "BLOCK", 32)
    r = np.random.default_rng(8)
    v = r.standard_normal(24)
    rows = [(i, (v + 0.11 * r.standard_normal(24)).tolist()) for i in range(150)] + [(1000 + i, r.standard_normal(24).tolist()) for i in range(50)]
    check_vectors(rows, projection_passes.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())


def test_passes_grow_with_the_number_of_vectors():
    assert projection_passes.passes(100) <= projection_passes.passes(10_000) <= projection_passes.passes(10 ** 9)


def test_pairs_inside_a_dense_third_of_the_vectors(spark):
    r = np.random.default_rng(21)
    n, dims = 20_000, 64

    def units(v):
        return v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre, own = units(r.standard_normal(dims)), units(r.standard_normal((n // 3, dims)))
    own = units(own - (own @ centre)[:, None] * centre)
    x = np.concatenate([np.sqrt(0.8) * centre + np.sqrt(0.2) * own, units(r.standard_normal((n - n // 3, dims)))])
    for i in range(400):        # partners at cos 0.955 among the vectors of pairwise cos 0.8
        side = units(r.standard_normal(dims))
        side = units(side - (side @ x[i]) * x[i])
        x[400 + i] = 0.955 * x[i] + np.sqrt(1 - 0.955 ** 2) * side
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {v.vec_id: v for v in projection_passes.link(df).collect()}
    near = [np.flatnonzero(x[lo:lo + 2000] @ x.T >= 0.95) for lo in range(0, n, 2000)]
    assert sum(map(len, near)) == n + 800 and sum(v.n_links for v in got.values()) == 800
    assert all(got[400 + i].component_id == i for i in range(400))


def test_segments_are_cut_by_sorts_and_masks(monkeypatch):
    """`np.unique` hashes whole arrays, which took over half of the time of a chunk; texts of any length, also empty ones at the end."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 101, n, dtype=np.uint8)) for n in (0, 400, 49, 50, 700, 0, 3)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    want = []
    for k, t in enumerate(texts):       # each text by itself: one cut wherever the anchor moves
        _, end, anchor, _ = suffix_dedup.segments(np.frombuffer(t, dtype=np.uint8), np.array([0, len(t)]))
        want += [(int(e) + int(bounds[k]), int(a), k) for e, a in zip(end, anchor)]

    def refused(*args, **kwargs):
        raise AssertionError("np.unique over a chunk")
    monkeypatch.setattr(np, "unique", refused)
    start, end, anchor, text = suffix_dedup.segments(np.frombuffer(b"".join(texts), dtype=np.uint8), bounds)
    assert list(zip(end.tolist(), anchor.tolist(), text.tolist())) == want and (np.diff(start) > 0).all()
    x = rng.integers(-5, 5, 100)
    assert suffix_dedup._distinct(x).tolist() == sorted(set(x.tolist())) and not len(suffix_dedup._distinct(x[:0]))
