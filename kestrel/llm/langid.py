"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams (one to three
characters, words padded with a blank), most frequent first.  A document's own
most frequent n-grams are ranked alike, and its distance to a language is the
sum over them of how far out of place each is in the profile, ``TOP`` for those
that the profile lacks.  The nearest profile wins.

Every label is learned.  Profiles stay a table of (lang, rank, code); the tasks get them in slices of
at most ``SLICE`` languages, and a document carries the best language so far from
one slice to the next, so that no task holds more than a slice however many labels there are.

Defined results: texts are lower-cased, anything that is not a letter parts
words.  Null texts and texts without a letter are `und` with score 0, as is
everything when there is nothing to learn from.  Ties between n-grams go to the
smaller code, ties between languages to the first by name.  Rows that repeat
give repeated results; a null id counts as a row to learn from.  `known` drops null
texts and texts without a letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import map_batches, staged

#: N-grams in a profile, and of a document that are compared.
TOP = 400
#: Documents that a language's profile is counted on: a sample of about this many, chosen by a hash of the id.
TRAIN_DOCS = 3000
#: Languages whose profiles are sent to the tasks at once.
SLICE = 4000
UNDETERMINED = "und"
#: Least score of a document in one of the learned languages; texts in them score 0.4 and more, foreign scripts 0.
MIN_SCORE = 0.1

_BLANK = 32


def _letters() -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    # letters of the planes that have any; the rest of the code space is unassigned or private
    for first, last in ((0, 0x20000), (0x20000, 0x33480)):
        table[first:last] = [chr(c).isalpha() for c in range(first, last)]
    return table


_TABLE: list[np.ndarray] = []


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text, three characters of 21 bits each."""
    if not _TABLE:
        _TABLE.append(_letters())
    raw = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    raw = np.where(_TABLE[0][raw], raw, np.uint32(_BLANK))
    blank = raw == _BLANK
    keep = np.ones(len(raw), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    c = raw[keep].astype(np.uint64)
    if len(c) < 3:
        return np.zeros(0, dtype=np.uint64)
    blank = blank[keep]
    two = (c[:-1] << np.uint64(21)) | c[1:]
    three = (two[:-1] << np.uint64(21)) | c[2:]
    return np.concatenate([c[~blank], two, three[~blank[1:-1]]])


def ranked(codes: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    order = np.lexsort((values, -counts))[:top] if len(values) <= 4 * top else _head(values, counts, top)
    return values[order]


def _head(values: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    least = np.partition(counts, len(counts) - top)[len(counts) - top]
    some = np.flatnonzero(counts >= least)
    return some[np.lexsort((values[some], -counts[some]))[:top]]


def held_out(id_col: str) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 modulo 4."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(4)) == 2


def profile_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  train_docs: int = TRAIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, rank, code): the profiles of all languages that label a document which is not held out; written.

    Counted on a sample of about ``train_docs`` documents for each language, chosen by a hash of id and text.
    """
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id")))
    unit = F.pmod(F.xxhash64(F.lit("profile"), "id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = rows.withColumn("unit", unit)
    sizes = staged(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("unit").alias("least")))
    few = sizes.limit(SLICE + 1).count() <= SLICE
    chosen = (F.col("unit") * F.col("n") < train_docs) | (F.col("unit") == F.col("least"))     # no language without a document
    sample = rows.join(F.broadcast(sizes) if few else sizes, "lang").where(chosen).select("lang", "text")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        langs, codes = [], {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes.setdefault(lang, []).append(grams(text))
        out_code, out_n = [], []
        for lang, parts in codes.items():
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            langs += [lang] * len(values)
            out_code.append(values.astype(np.int64))
            out_n.append(counts)
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(out_code)),
                                           pa.array(np.concatenate(out_n).astype(np.int64))], ["lang", "code", "n"])
    counts = map_batches(sample, "lang string, code long, n long", count).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return staged(counts.withColumn("rank", first).where(F.col("rank") <= top).select("lang", "rank", "code"))


def slices(table: DataFrame, size: int = SLICE) -> Iterator[dict[str, list[int]]]:
    """The profiles of a table, code lists by language, in slices of about ``size`` languages; one slice is held at a time."""
    parts = max(1, -(-table.where("rank = 1").count() // size))
    for k in range(parts):
        out: dict[str, list[int]] = {}
        mine = table.where(F.pmod(F.xxhash64("lang"), F.lit(parts)) == k)
        for r in sorted(mine.collect(), key=lambda r: (r["lang"], r["rank"])):
            out.setdefault(r["lang"], []).append(r["code"])
        yield out


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_docs: int = TRAIN_DOCS, top: int = TOP) -> dict[str, list[int]]:
    """All profiles at once, for a bounded number of labels."""
    table = profile_table(docs, id_col, text_col, lang_col, train_docs, top)
    return {lang: codes for part in slices(table) for lang, codes in part.items()}


class Profiles:
    """Profiles of several languages, ready to measure distances to all of them at once.

    For every code, the languages whose profile has it and its place there: a document is held against the
    postings of its own codes, not against all profiles in full.
    """

    def __init__(self, profiles: dict[str, list[int]]):
        self.names = sorted(profiles)
        sizes = [len(profiles[name]) for name in self.names]
        code = np.array([c for name in self.names for c in profiles[name]], dtype=np.uint64)
        lang = np.repeat(np.arange(len(self.names)), sizes)
        place = np.concatenate([np.zeros(0, dtype=np.int64), *(np.arange(n) for n in sizes)])
        order = np.argsort(code, kind="stable")
        self.codes, first = np.unique(code[order], return_index=True)
        self.first = np.append(first, len(code))
        self.lang, self.place = lang[order], place[order]

    def distances(self, found: np.ndarray) -> np.ndarray:
        """The out-of-place distance of ranked codes to every language."""
        at = np.minimum(np.searchsorted(self.codes, found), len(self.codes) - 1)
        rank = np.flatnonzero(self.codes[at] == found)
        begin, size = self.first[at[rank]], np.diff(self.first)[at[rank]]
        posting = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        # what a code in its place, or near it, takes off the greatest distance
        off = TOP - np.minimum(np.abs(self.place[posting] - np.repeat(rank, size)), TOP)
        return TOP * len(found) - np.bincount(self.lang[posting], weights=off, minlength=len(self.names)).astype(np.int64)

    def best(self, text: str | None) -> tuple[str, float]:
        """The nearest language, and 1 less the mean distance in units of TOP."""
        found = ranked(grams(text))
        if not len(found) or not self.names:
            return UNDETERMINED, 0.0
        out = self.distances(found)
        win = int(out.argmin())
        return self.names[win], 1.0 - float(out[win]) / (TOP * len(found))


def _better(a: tuple[str, float], b: tuple[str, float]) -> tuple[str, float]:
    """The nearer of two languages, the first by name of equally near ones."""
    if UNDETERMINED in (a[0], b[0]) and a[0] != b[0]:
        return b if a[0] == UNDETERMINED else a
    return max(a, b, key=lambda x: x[1]) if a[1] != b[1] else min(a, b)


def labelled(rows: DataFrame, text_col: str, table: DataFrame, size: int = SLICE) -> DataFrame:
    """The rows with ``__lang`` and ``__score``: the nearest of the languages in a table of profiles."""
    columns, at = rows.columns, rows.columns.index(text_col)
    out = rows.withColumns({"__lang": F.lit(UNDETERMINED), "__score": F.lit(0.0)})
    schema = out.schema
    for part in slices(table, size):
        sent = rows.sparkSession.sparkContext.broadcast(Profiles(part))

        def run(batch: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            old = zip(*(batch.column(len(columns) + i).to_pylist() for i in (0, 1)))
            got = [_better(o, sent.value.best(t)) for o, t in zip(old, batch.column(at).to_pylist())]
            return pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.array([g[0] for g in got], pa.string()),
                                               pa.array([g[1] for g in got], pa.float64())], [*columns, "__lang", "__score"])
        out = map_batches(out, schema, run)
    return out


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from those not held out."""
    table = profile_table(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return labelled(rows, "text", table).select("doc_id", held_out("doc_id").alias("held_out"), F.col("__lang").alias("lang_pred"),
                                                F.col("__score").alias("score"))


def known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          least: float = MIN_SCORE) -> DataFrame:
    """The documents, all columns, without those that are undetermined or nearer than ``least`` to no language."""
    got = labelled(docs, text_col, profile_table(docs, id_col, text_col, lang_col))
    return got.where((F.col("__lang") != UNDETERMINED) & (F.col("__score") >= least)).select(*docs.columns)
