"""The pipeline against the same stages done plainly, and the contract of its stages."""

import corpus_pipeline
from cases import SMALL, messy
from test_duplicates import brute_links, brute_repeats, roots

from kestrel.llm import langid, pii, varpack
from kestrel.llm.queries import ORACLES, QUERIES
from kestrel.llm.vocab import BYTE_RANKS, PATTERN


def test_names():
    assert sorted(q for q in QUERIES if q.startswith("op")) == sorted(
        ["op1_html_blocks", "op2_jaccard_forest", "op3_bpe_transducer", "op4_suffix_repeats", "op5_projection_passes",
         "op6_variable_best_fit", "op7_language_profiles", "op8_bottom_k", "op9_personal_data", "op10_packed_ids",
         "op11_merkle_manifest", "op12_fim_frames", "op13_chat_tokens"])
    assert "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)


def test_run_against_brute_force(spark, quick_training):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    profiles = langid.Profiles(langid.learn(docs))
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if profiles.best(r.text)[1] >= langid.MIN_SCORE)
    top = roots(iter((a, b) for a, b in brute_links([t for _, t in rows])))
    rows = [r for i, r in enumerate(rows) if top.get(i, i) == i]
    kept = {}
    for (i, text), (_, n, gone, _, _) in zip(rows, brute_repeats(rows)):
        kept[i] = (text, n - gone)
    after = corpus_pipeline.repeats(spark, corpus_pipeline.near_duplicates(spark, corpus_pipeline.language(spark, docs, SMALL), SMALL), SMALL)
    # whole characters stay, so a text may keep up to a character's bytes more at each end of a cut
    got = {r.doc_id: r.text for r in after.collect()}
    assert set(got) == set(kept)
    for i, (text, n) in kept.items():
        assert n <= len(got[i].encode()) <= n + 6 * text.count(" ") + 6 and (n < len(text.encode()) or got[i] == text)
    clean = corpus_pipeline.personal_data(spark, after, SMALL)
    assert clean.columns == docs.columns
    encode = varpack.tokenizer(varpack.read_ranks(BYTE_RANKS), PATTERN).encode_ordinary
    want = {r.doc_id: len(encode(r.text)) for r in clean.collect()}
    placed = {}
    for r in corpus_pipeline.run(spark, SMALL).collect():
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_tokens
    assert placed == want


def test_stages_of_messy_rows(spark, quick_training):
    docs = messy(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
        if name != "packing":
            assert out.columns == docs.columns, name
            assert dict(out.dtypes) == dict(docs.dtypes), name
        assert out.count() > 0


def test_personal_data_leaves_other_texts_alone(spark, quick_training):
    docs = spark.createDataFrame([(1, "nothing to see here, move on", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.personal_data(spark, docs, SMALL).first().text == "nothing to see here, move on"
    assert pii.replaced("a b@c.de f", [("email", 2, 8)]) == "a [EMAIL] f"
