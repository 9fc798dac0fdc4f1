"""The registered queries of this subpackage: one for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from kestrel.llm import (bottomk, bpe_stream, chat_tokens, fim_frames, html_blocks, jaccard_forest, langid, merkle, pii, projection_passes,
                         suffix_dedup, tokenpack, varpack)
from kestrel.llm.common import table
from kestrel.llm.vocab import BYTE_BPE, BYTE_RANKS, PATTERN

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op11_merkle_manifest": merkle.SQL,
    "op12_fim_frames": fim_frames.SQL,
    "op13_chat_tokens": chat_tokens.SQL,
}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.main_text(table(spark, sf_dir, "pages"))


@query
def op2_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links (5-word shingles, Jaccard 0.8 or more) of every document."""
    return jaccard_forest.classes_of(table(spark, sf_dir, "documents"))


@query
def op3_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the streaming encoder and decoder."""
    return bpe_stream.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that an earlier one has."""
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op5_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links (cosine 0.95 or more) and component of every vector."""
    return projection_passes.link(table(spark, sf_dir, "embeddings"))


@query
def op6_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document, or piece of one, in sequences of several lengths."""
    return varpack.pack_documents(table(spark, sf_dir, "documents"), BYTE_RANKS, PATTERN)


@query
def op7_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by out-of-place distance."""
    return langid.predict(table(spark, sf_dir, "documents"))


@query
def op8_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every document and of its edited text."""
    return bottomk.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, by rules and by the network."""
    return pii.digest(table(spark, sf_dir, "documents"))


@query
def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document as rows of packed matrices."""
    return tokenpack.packed_matrix(table(spark, sf_dir, "documents"), BYTE_RANKS, PATTERN)


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document held against the manifest of all, some of them tampered with."""
    return merkle.audit(table(spark, sf_dir, "documents"))


@query
def op12_fim_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for fill-in-middle, and rebuilt."""
    return fim_frames.digest(table(spark, sf_dir, "documents"))


@query
def op13_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and read back."""
    return chat_tokens.digest(chat_tokens.with_quote(table(spark, sf_dir, "conversations")), BYTE_RANKS, PATTERN)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, one after the other, over all documents."""
    return corpus_pipeline.run(spark, sf_dir)
