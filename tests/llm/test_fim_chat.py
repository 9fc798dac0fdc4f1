"""Fill-in-middle and chat formatting against plain versions and exact round trips."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from cases import SMALL, messy, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm import chat_tokens, fim_frames, varpack
from kestrel.llm.vocab import BYTE_RANKS, PATTERN

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_fim(doc, text):
    text = text or ""
    units = UNITS.findall(text)
    n, h = len(units), sha(f"42:{'' if doc is None else doc}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 80:
        return doc, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return doc, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


PARTS = st.lists(st.sampled_from(["a", " ", "\n", "\x0b", "\x1f", "<", "P>", "<S>", "<M>", "é", "😀", "  bb", "　"]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(PARTS, st.sampled_from([1, 2, 5, 64]), st.data())
def test_frames_seek_and_restore(text, frame, data):
    w = fim_frames.Writer(frame)
    cut = data.draw(st.integers(0, len(text)))
    w.write(text[:cut])
    w.write(text[cut:])
    frames, units = w.close(), UNITS.findall(text)
    assert frames.units[-1] == len(units)
    a, b = sorted(data.draw(st.tuples(st.integers(0, len(units)), st.integers(0, len(units)))))
    frames.opened = 0
    ends = frames.seek(a), frames.seek(b)
    assert frames.opened <= 2               # only the frames that hold the cuts
    assert ends == (len("".join(units[:a])), len("".join(units[:b])))
    assert "".join(frames.read(*ends)) == "".join(units[a:b])
    assert [x for x, _ in fim_frames.marks(frames.read(0, len(text)))] == [m.start() for m in re.finditer("<[PSM]>", text)]
    if not re.search("<[PSM]>", text):
        for form in ("spm", "psm"):
            assert "".join(fim_frames.restored(fim_frames.transformed(frames, form, ends), form)) == text


def test_fim_of_messy_rows(spark):
    docs = messy(spark)
    extra = [(100 + i, t) for i, t in enumerate(["<P>", "a <S> b", "<M", "x" * 70000 + " y", ("w " * 40000), " ", "a", "　a b\x0bc"] * 6)]
    docs = docs.select("doc_id", "text", "n_tokens").unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    want = sorted((plain_fim(r["doc_id"], r["text"]) for r in docs.collect()), key=str)
    for frame in (fim_frames.FRAME, 1000):
        assert sorted((tuple(r) for r in fim_frames.digest(docs, frame=frame).collect()), key=str) == want
    assert fim_frames.digest(docs.limit(0)).count() == 0
    results = fim_frames.transform(fim_frames.framed(docs))
    assert rows_of(fim_frames.restore(results), "doc_id", "text") == sorted(
        ((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (str(r[0]), r[1]))


def sql(text, table, names):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return sorted(con.execute(f"SELECT {', '.join(names)} FROM ({text})").fetchall(), key=str)


def test_fim_of_the_small_table(spark):
    got = fim_frames.digest(spark.read.parquet(f"{SMALL}/documents.parquet"))
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == sql(fim_frames.SQL, "documents", got.columns)
    assert {r[2] for r in rows} == {"plain", "spm", "psm"}


SPEECH = st.lists(st.sampled_from([*chat_tokens.CONTROLS, "\\", "<", "[", "s>", "/INST]", "<\\s>", "[\\\\INST]", "a", " ", "é", "😀", "\n"]),
                  max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(SPEECH)
def test_escapes_are_reversible(text):
    hidden = chat_tokens.escape(text)
    assert chat_tokens.unescape(hidden) == text
    assert not any(c in hidden for c in chat_tokens.CONTROLS)


@pytest.fixture(scope="module")
def template():
    return chat_tokens.Template(varpack.tokenizer(varpack.read_ranks(BYTE_RANKS), PATTERN))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "</s>"]), SPEECH), max_size=6))
def test_turns_read_back_from_ids_and_from_text(template, turns):
    ids, loss, starts = chat_tokens.spliced([(*template.encode(r, t), r == "assistant") for r, t in turns])
    assert list(template.turns(ids)) == turns == chat_tokens.parse(template.text(ids))
    assert "".join(template.masked(ids, loss)) == "".join(t for r, t in turns if r == "assistant")
    assert len(starts) == len(turns) and not loss[ids >= template.base].any()


def plain_chat(spark, rows):
    """The digest of every conversation, from all its rows in memory; ties by Spark's hash of role and text."""
    rows = rows.selectExpr("conv_id", "turn", "coalesce(role, '') role", "coalesce(text, '') text").selectExpr("*", "xxhash64(role, text) h").collect()
    out = []
    for conv in {r.conv_id for r in rows}:
        mine = sorted((r for r in rows if r.conv_id == conv), key=lambda r: (r.turn is not None, r.turn or 0, r.h))
        learned = [r.text for r in mine if r.role == "assistant"]
        size = 0
        for r in mine:
            marks = chat_tokens._MARKS.get(r.role)
            size += len("".join(marks)) if marks else len("[ROLE][/ROLE][TURN][/TURN]" + chat_tokens.escape(r.role))
            size += len(chat_tokens.escape(r.text))
        out.append((conv, len(mine), sha("".join(f"{r.role}\n{r.text}\n" for r in mine)), len("".join(learned)), sha("".join(learned)), size))
    return sorted(out, key=str)


def test_chat_of_messy_rows(spark):
    said = ["hi", None, "", chat_tokens.QUOTE, "a\\</s>", "é 😀 " * 50, "[\\INST] <\\\\s>"]
    roles = ["user", "assistant", "system", None, "tool", "assistant"]
    rows = [(None if i % 3 == 0 else i % 11, None if i % 13 == 0 else (i * 7) % 5, roles[i % 6], said[i % 7], "x", i) for i in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string, part int").repartition(5)
    want = plain_chat(spark, df)
    # a third of all rows is one conversation; small parts split many of them
    for part in (chat_tokens.PART, 40):
        assert sorted((tuple(r) for r in chat_tokens.digest(df, BYTE_RANKS, PATTERN, part=part).collect()), key=str) == want
    assert chat_tokens.digest(df.limit(0), BYTE_RANKS, PATTERN).count() == 0


def test_a_long_conversation_is_spread(spark):
    df = spark.range(4000).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('turn ', id) text")
    parts = chat_tokens.formatted(df, BYTE_RANKS, PATTERN).selectExpr("part >> 32 task", "n_turns", "turn_starts", "ids", "loss").collect()
    assert len({p.task for p in parts}) > 4 and max(p.n_turns for p in parts) < 2000
    assert all(np.frombuffer(p.ids, "<u4")[p.turn_starts].min() >= 50256 and len(p.ids) == 4 * len(p.loss) for p in parts)
    got = chat_tokens.digest(df, BYTE_RANKS, PATTERN).collect()
    assert [tuple(r) for r in got] == plain_chat(spark, df)


def test_chat_of_the_small_table(spark):
    rows = chat_tokens.with_quote(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    got = chat_tokens.digest(rows, BYTE_RANKS, PATTERN)
    have = sorted((tuple(r) for r in got.collect()), key=str)
    assert have == sql(chat_tokens.SQL, "conversations", got.columns)
    quote = next(r for r in have if r[0] == -1)
    both = f"user\n{chat_tokens.QUOTE}\nassistant\n{chat_tokens.QUOTE}\n"
    assert quote[1:5] == (2, sha(both), 21, sha(chat_tokens.QUOTE))
