"""Chat formatting, assembled from tokens.

Every turn is encoded on its own (`Template.encode`): its opening and closing marks
are reserved ids, one beyond the vocabulary for each control string, and only its
text goes through the tokenizer, which cannot make a reserved id.  Turns are then put
together (`spliced`): ids are spliced, and the places of turns and the loss mask come
from running sums, of segment lengths, and of +1 and -1 where an assistant's text
begins and ends.

    <<SYS>>text<</SYS>>[INST]text[/INST]<s>text</s>[INST]text[/INST]<s>text</s>

A user's turn stands in [INST], a system's in <<SYS>>, an assistant's in <s>; any
other role's has its name in [ROLE] and its text in [TURN].  In texts and names, a
control string gets a backslash after its first character, and one more where it has
some already; taking one away from each gives the text back, so that the formatted
text can be read without the ids as well (`parse`).  Only assistants' texts are under
the loss mask, marks are not.

Rows are range-partitioned by conversation and turn, so a conversation of any length
is spread over tasks and comes out as several parts, each of whole turns, which are
closed at ``PART`` tokens.  Reading back works on parts.  The digests alone, which are
sequential by nature, follow the parts of a split conversation through one task, as a
sorted stream.

Defined results: a null text or role counts as empty; turns ascend, null first, ties
by a hash of role and text; rows that repeat are turns as often; a null id is a
conversation of its own.  No rows: no result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import staged, text_of
from kestrel.llm.varpack import read_ranks, tokenizer

# fixed values: the control strings; the reserved id of each is its place here, after the vocabulary
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[TURN]", "[/TURN]")
ASSISTANT = "assistant"
_MARKS = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), ASSISTANT: ("<s>", "</s>")}
_OTHER = ("[TURN]", "[/TURN]")
#: Tokens at which a part is closed, and characters of text sent at once to a digest.
PART, SEND = 1 << 18, 1 << 20

_HIDDEN = re.compile("|".join(rf"({re.escape(c[0])})(\\*)({re.escape(c[1:])})" for c in CONTROLS))
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))


def escape(text: str) -> str:
    """The text without control strings: each, however many backslashes it has inside, gets one more."""
    return _HIDDEN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    """The text of an escaped text."""
    return _HIDDEN.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text) if "\\" in text else text


class Template:
    """Reserved ids of the control strings, after those of a vocabulary."""

    def __init__(self, vocabulary: tiktoken.Encoding):
        self.vocabulary = vocabulary
        self.base = vocabulary.n_vocab
        self.id = {c: self.base + i for i, c in enumerate(CONTROLS)}
        self.opened = {marks[0]: role for role, marks in _MARKS.items()}

    def encode(self, role: str, text: str) -> tuple[np.ndarray, int, int]:
        """Ids of a turn, and where the text begins and ends in them."""
        get = self.vocabulary.encode_ordinary
        first, last = _MARKS.get(role, _OTHER)
        head = [self.id[first]] if role in _MARKS else [self.id["[ROLE]"], *get(escape(role)), self.id["[/ROLE]"], self.id[first]]
        body = get(escape(text))
        return np.array([*head, *body, self.id[last]], dtype="<u4"), len(head), len(head) + len(body)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids without reserved ones."""
        return self.vocabulary.decode_bytes(ids.tolist()).decode("utf-8", "surrogatepass")

    def split(self, ids: np.ndarray) -> Iterator[tuple[str, int, int]]:
        """Each control string with the bounds of the ids up to the next one."""
        at = np.flatnonzero(ids >= self.base).tolist()
        if len(ids) and at[:1] != [0]:
            raise ValueError("ids before the first mark")
        for a, b in zip(at, [*at[1:], len(ids)]):
            yield CONTROLS[int(ids[a]) - self.base], a + 1, b

    def text(self, ids: np.ndarray) -> str:
        """The formatted text."""
        return "".join(c + self.decode(ids[a:b]) for c, a, b in self.split(ids))

    def turns(self, ids: np.ndarray) -> Iterator[tuple[str, str]]:
        """Role and text of every turn."""
        role = ""
        for control, a, b in self.split(ids):
            if control == "[ROLE]":
                role = unescape(self.decode(ids[a:b]))
            elif control in self.opened or control == _OTHER[0]:
                yield self.opened.get(control, role), unescape(self.decode(ids[a:b]))

    def masked(self, ids: np.ndarray, loss: np.ndarray) -> Iterator[str]:
        """The texts under the loss mask, one for each run of it, unescaped."""
        edge = np.flatnonzero(np.diff(loss.astype(np.int8), prepend=0, append=0))
        for a, b in edge.reshape(-1, 2).tolist():
            yield unescape(self.decode(ids[a:b]))


def parse(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted text."""
    out, role, at = [], "", 0
    marks = list(_CONTROL.finditer(text))
    opened = {first: r for r, (first, _) in _MARKS.items()}
    for m, after in zip(marks, marks[1:]):
        body = unescape(text[m.end():after.start()])
        if m[0] == "[ROLE]":
            role = body
        elif m[0] in opened or m[0] == _OTHER[0]:
            out.append((opened.get(m[0], role), body))
    return out


def spliced(turns: list[tuple[np.ndarray, int, int, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, loss mask and the start of every turn, of encoded turns (ids, start and end of the text, whether it is learned)."""
    sizes = np.array([len(ids) for ids, *_ in turns], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = np.concatenate([np.zeros(0, "<u4"), *(t[0] for t in turns)])
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    begin, end, learned = np.array([t[1:] for t in turns], dtype=np.int64).reshape(-1, 3).T
    np.add.at(edges, starts + begin, learned)
    np.add.at(edges, starts + end, -learned)
    return ids, np.cumsum(edges[:-1]).astype(bool), starts


_FORMATTED = ("conv_id long, part long, whole boolean, n_turns long, n_tokens long, ids binary, loss binary, turn_starts array<long>")
_FORMATTED_ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()),
                              ("n_tokens", pa.int64()), ("ids", pa.binary()), ("loss", pa.binary()), ("turn_starts", pa.list_(pa.int64()))])


def formatted(rows: DataFrame, ranks_path: str, pattern: str, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", part: int = PART) -> DataFrame:
    """Parts of conversations: ids (little-endian, four bytes each), loss (a byte for each id), turn_starts.

    The parts of a conversation follow each other by ``part``; ``whole`` says that it surely has no other.
    """
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(read_ranks(ranks_path))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src = rows.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                      text_of(role_col).alias("role"), text_of(text_col).alias("text"))
    # equal rows get numbers of their own, or they could not be parted between tasks
    src = src.withColumns({"h": F.xxhash64("role", "text"), "equal": F.monotonically_increasing_id()})
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "h", "equal")]
    src = src.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    src = src.select("conv_id", "role", "text", F.spark_partition_id().alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(tokenizer(sent.value, pattern))
        turns: list[tuple[np.ndarray, int, int, bool]] = []
        now, size, number, begun, seen = None, 0, 0, False, False

        def close(whole: bool) -> pa.RecordBatch:
            nonlocal turns, size, number
            ids, loss, starts = spliced(turns)
            row = {"conv_id": now, "part": (task << 32) + number, "whole": whole, "n_turns": len(turns), "n_tokens": len(ids),
                   "ids": ids.tobytes(), "loss": loss.tobytes(), "turn_starts": starts}
            number += 1
            turns, size = [], 0
            return row

        for b in batches:
            out = []
            ids, roles, texts, tasks = (c.to_pylist() for c in b.columns)
            for conv, role, text, task in zip(ids, roles, texts, tasks):
                if seen and conv != now:
                    if turns:           # the first conversation of a task may have begun in the one before
                        out.append(close(begun))
                    begun = True
                now, seen = conv, True
                turns.append((*template.encode(role, text), role == ASSISTANT))
                size += len(turns[-1][0])
                if size >= part:
                    out.append(close(False))
                    begun = False
            if out:
                yield pa.RecordBatch.from_pylist(out, _FORMATTED_ARROW)
        if turns:                       # the last one may go on in the next
            yield pa.RecordBatch.from_pylist([close(False)], _FORMATTED_ARROW)
    return src.mapInArrow(run, _FORMATTED)


def _spoken(role: str, text: str) -> str:
    return f"{role}\n{text}\n"


_BACK = ("conv_id long, part long, piece int, whole boolean, n_turns long, loss_chars long, formatted_chars long, turns string, loss string")
_BACK_ARROW = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int32()), ("whole", pa.bool_()),
                         ("n_turns", pa.int64()), ("loss_chars", pa.int64()), ("formatted_chars", pa.int64()),
                         ("turns", pa.string()), ("loss", pa.string())])


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def read_back(parts: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """What `formatted` parts say, from ids and loss mask alone: counts, and of a whole conversation both digests;
    of the parts of others, their turns and learned texts, in pieces."""
    sent = parts.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(tokenizer(sent.value, pattern))
        for b in batches:
            out = []
            for row in b.to_pylist():
                ids, loss = np.frombuffer(row["ids"], "<u4"), np.frombuffer(row["loss"], np.uint8)
                said = [_spoken(*t) for t in template.turns(ids)]
                turns, learned = "".join(said), "".join(template.masked(ids, loss))
                own = {"conv_id": row["conv_id"], "part": row["part"], "piece": 0, "whole": row["whole"], "n_turns": len(said),
                       "loss_chars": len(learned), "formatted_chars": len(template.text(ids))}
                if row["whole"]:
                    out.append({**own, "turns": _hash(turns), "loss": _hash(learned)})
                    continue
                for k in range(max(1, -(-max(len(turns), len(learned)) // SEND))):
                    some = slice(k * SEND, (k + 1) * SEND)
                    out.append({**own, "piece": k, "turns": turns[some], "loss": learned[some]})
                    own.update(n_turns=0, loss_chars=0, formatted_chars=0)
            if out:
                yield pa.RecordBatch.from_pylist(out, _BACK_ARROW)
    return parts.select("conv_id", "part", "whole", "ids", "loss").mapInArrow(run, _BACK)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                           ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digest(rows: DataFrame, ranks_path: str, pattern: str, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", part: int = PART) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of every conversation, read back
    from its formatted parts."""
    back = read_back(formatted(rows, ranks_path, pattern, id_col, turn_col, role_col, text_col, part), ranks_path, pattern)
    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # whole conversations have only their digests to move
    back = back.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, counts = None, None, np.zeros(3, dtype=np.int64)

        def close() -> dict:
            turns, loss = (h if isinstance(h, str) else h.hexdigest() for h in open_)
            return {"conv_id": now, "n_turns": int(counts[0]), "turns_sha256": turns, "loss_chars": int(counts[1]),
                    "loss_sha256": loss, "formatted_chars": int(counts[2])}

        for b in batches:
            out = []
            for row in b.to_pylist():
                if open_ is not None and row["conv_id"] != now:
                    out.append(close())
                    open_ = None
                if open_ is None:
                    now, counts = row["conv_id"], np.zeros(3, dtype=np.int64)
                    open_ = (row["turns"], row["loss"]) if row["whole"] else (hashlib.sha256(), hashlib.sha256())
                if not row["whole"]:
                    for h, c in zip(open_, ("turns", "loss")):
                        h.update(row[c].encode("utf-8", "surrogatepass"))
                counts = counts + [row["n_turns"], row["loss_chars"], row["formatted_chars"]]
            if out:
                yield pa.RecordBatch.from_pylist(out, _DIGEST_ARROW)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([close()], _DIGEST_ARROW)
    return back.mapInArrow(run, _DIGEST)


#: The conversation that quotes the template.
QUOTE = "</s>[INST] ok [/INST]"


def with_quote(rows: DataFrame) -> DataFrame:
    """The conversations and conversation -1, in which both sides say control strings."""
    spark = rows.sparkSession
    extra = spark.createDataFrame([(-1, 0, "user", QUOTE), (-1, 1, ASSISTANT, QUOTE)], "conv_id long, turn long, role string, text string")
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)


def _sql() -> str:
    hidden = "|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROLS)

    def size(col: str) -> str:
        return f"length({col}) + len(regexp_extract_all({col}, '{hidden}'))"
    marks = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b) in _MARKS.items())
    other = len("".join(("[ROLE]", "[/ROLE]", *_OTHER)))
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{QUOTE}' UNION ALL SELECT -1, 1, '{ASSISTANT}', '{QUOTE}'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = '{ASSISTANT}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = '{ASSISTANT}'), '')) AS loss_sha256,
  CAST(sum({size("text")} + CASE role {marks} ELSE {other} + {size("role")} END) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


#: The same in DuckDB; needs turns without ties, as it cannot compute the hash that breaks them.
SQL = _sql()
