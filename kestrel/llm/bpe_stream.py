"""Byte-level BPE as a bounded-lookahead streaming transducer.

From the merge list a *sufficient lookahead* is computed for every token: how
many bytes from the token's start on can decide whether it stands in the final
segmentation.  Merges are visited in order of rank; merge (a, b) -> ab makes a's
presence depend on what b's depends on, and so on (`Vocabulary.reach`).  The
transducer reads symbols into a bounded buffer and emits leading tokens as soon
as everything that they depend on has been read.  BPE segments what follows an
emitted token as if it stood alone, so nothing emitted is needed again.

Texts are cut before the merges by the usual pattern of this family of
vocabularies; added tokens are cut out first.  A text is read in slices of bounded
length, which end where a piece is sure to begin, and every piece goes through the
transducer; tokens of short pieces that a task has met are remembered, up to a bound.
A run without such a place is read piece by piece, a piece of any length by the
buffer.  Decoding feeds the tokens' bytes through an incremental UTF-8 decoder which
keeps at most three bytes back.  A vocabulary file that asks for anything else
(a normalizer, another way to cut, dropout, word ends) is refused.

Defined results: null texts count as empty; an empty text has no tokens and
decodes to the empty text; rows that repeat give repeated results; other columns
are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import map_batches, text_of

# fixed values: the characters with the Unicode property White_Space
_SPACE = "\t-\r \x85\xa0  -     　"
# fixed values: the pattern that cuts texts before the merges
_PIECES = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
           rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: A blank between two characters that are not white space always starts a piece.
_APART = re.compile(f"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")
_CROWDED = re.compile(f" [{_SPACE}]"), re.compile(f"[{_SPACE.replace(' ', '')}] ")
#: Entries of the memo of short chunks; characters of a slice; tokens sent on at once by a long run; longest chunk kept in the memo.
MEMO, SLICE, SEND, LONGEST = 300_000, 1 << 16, 1 << 14, 64


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable Latin-1, else from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


def _check(spec: dict) -> None:
    """Refuse a file that this transducer would not encode as it asks."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = []
    if model.get("type", "BPE") != "BPE":
        wrong.append(f"model {model['type']}")
    wrong += [f"{key} {model[key]!r}" for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
              if model.get(key)]
    if spec.get("normalizer"):
        wrong.append(f"normalizer {spec['normalizer'].get('type')}")
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        wrong.append(f"pre_tokenizer {cut}")
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        wrong.append(f"decoder {spec.get('decoder')}")
    if wrong:
        raise ValueError("not a plain byte-level vocabulary: " + ", ".join(wrong))


class Vocabulary:
    """Symbols, merges and added tokens of a byte-level BPE file (the JSON text of it)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        _check(spec)
        model, letters = spec["model"], byte_alphabet()
        ids: dict[str, int] = model["vocab"]
        self.added = {}
        for t in spec.get("added_tokens") or []:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"added token {t['content']!r}: only plain added tokens are supported")
            self.added[t["content"]] = t["id"]
        n = max([*ids.values(), *self.added.values()]) + 1
        self.width = n
        self.bytes: list[bytes] = [b""] * n
        for token, i in ids.items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.of_byte = [ids.get(c, -1) for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        #: per token, the bytes from its start that decide on it
        self.reach = [1] * n
        seen = set(self.of_byte)
        for r, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, ab = ids[left], ids[right], ids[left + right]
            if a not in seen or b not in seen:
                raise ValueError("a merge uses a token that a later merge makes")
            seen.add(ab)
            self.rank.setdefault(a * n + b, r)
            self.made.append(ab)
            size = len(self.bytes[a])
            far = max(self.reach[a], size + self.reach[b])
            self.reach[a] = far
            self.reach[b] = max(self.reach[b], far - size)
            self.reach[ab] = max(self.reach[ab], far, len(self.bytes[ab]))
        #: enough for every token
        self.lookahead = max(self.reach)
        self.never = len(self.made)

    def merge(self, s: list[int]) -> list[int]:
        """Apply the merges to a list of symbols, the lowest rank first, leftmost first."""
        n, get, never = self.width, self.rank.get, self.never
        ranks = [get(a * n + b, never) for a, b in zip(s, s[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            i = ranks.index(best)
            s[i:i + 2] = [self.made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(s[i - 1] * n + s[i], never)
            if i < len(ranks):
                ranks[i] = get(s[i] * n + s[i + 1], never)
        return s


class Transducer:
    """Symbols in, tokens out, with a buffer of at most ``block`` symbols (four lookaheads)."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.block = 4 * vocabulary.lookahead
        self.buffer: list[int] = []

    def feed(self, data: bytes) -> Iterator[int]:
        for i in range(0, len(data), self.block):
            self.buffer += [self.v.of_byte[b] for b in data[i:i + self.block]]
            if len(self.buffer) >= self.block:
                yield from self._settled()

    def finish(self) -> list[int]:
        out, self.buffer = self.v.merge(self.buffer), []
        return out

    def _settled(self) -> list[int]:
        have, at, out = len(self.buffer), 0, []
        for token in self.v.merge(self.buffer[:]):
            if at + self.v.reach[token] > have:
                break
            out.append(token)
            at += len(self.v.bytes[token])
        del self.buffer[:at]
        return out


class _Memo(dict):
    """Tokens of the short chunks met before; chunks start with the blank before them, if any."""

    def __init__(self, tokens: Callable[[str], bytes], older: dict | None = None):
        super().__init__()
        self.tokens, self.older = tokens, older or {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.tokens(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids

    def aged(self) -> _Memo:
        """Itself, or once it is full an empty memo that can still look up what it had."""
        return _Memo(self.tokens, dict(self)) if len(self) > MEMO else self


class Encoder:
    """Encodes texts of any length; what it keeps besides the result is bounded."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pieces = regex.compile(_PIECES)
        special = sorted(vocabulary.added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.transducer = Transducer(vocabulary)
        self.memo, self.words = _Memo(self._chunk), _Memo(self._piece)

    def _piece(self, piece: str) -> bytes:
        """The tokens of a piece, four bytes each."""
        t = self.transducer
        return array("I", [*t.feed(piece.encode("utf-8", "surrogatepass")), *t.finish()]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if chunk[:1] == " " and chunk[1:].isalpha():        # one piece
            return self.words[chunk]
        return b"".join([self.words[p] for p in self.pieces.findall(chunk)])

    def _cut(self, text: str, at: int, end: int) -> int:
        """Where the slice that begins at ``at`` ends: at the last blank within its length that surely begins a piece,
        or else at the first one after it."""
        if end - at <= SLICE:
            return end
        stop = at + SLICE
        while (stop := text.rfind(" ", at + 1, stop)) > 0:
            if _APART.match(text, stop):
                return stop
        found = _APART.search(text, at + SLICE, end)
        return found.start() if found else end

    def _run(self, text: str) -> Iterator[np.ndarray]:
        """A run that could not be cut, piece by piece through the transducer."""
        out: array = array("I")
        for m in self.pieces.finditer(text):
            data = memoryview(m.group().encode("utf-8", "surrogatepass"))
            for i in range(0, len(data), SEND):
                out.extend(self.transducer.feed(bytes(data[i:i + SEND])))
                if len(out) >= SEND:
                    yield np.frombuffer(out.tobytes(), dtype="<u4")
                    out = array("I")
            out.extend(self.transducer.finish())
        if out:
            yield np.frombuffer(out.tobytes(), dtype="<u4")

    def _plain(self, text: str, at: int, end: int) -> Iterator[np.ndarray]:
        while at < end:
            cut = self._cut(text, at, end)
            part, at = text[at:cut], cut
            if len(part) > 2 * SLICE:
                yield from self._run(part)
                continue
            chunks = _APART.split(part) if any(p.search(part) for p in _CROWDED) else part.split(" ")
            self.memo, self.words = self.memo.aged(), self.words.aged()
            get = self.memo.__getitem__
            ids = get(chunks[0]) if chunks[0] else b""
            yield np.frombuffer(b"".join([ids, *map(get, map(" ".__add__, chunks[1:]))]), dtype="<u4")

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """Tokens of a text, in arrays of bounded length."""
        at = 0
        if self.special:
            for m in self.special.finditer(text):
                if m.start() > at:
                    yield from self._plain(text, at, m.start())
                yield np.array([self.v.added[m.group()]], dtype="<u4")
                at = m.end()
        if at < len(text):
            yield from self._plain(text, at, len(text))

    def ids(self, text: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<u4"), *self.encode(text)])


class Speller:
    """Byte strings of many ids at once, put one after the other."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        return self.flat[np.repeat(self.start[ids] - ends + size, size) + np.arange(ends[-1])].tobytes()


class Decoder:
    """Tokens in, text out; an unfinished character waits for its other bytes."""

    def __init__(self, spell: Speller):
        self.spell = spell
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.state.decode(self.spell(ids))

    def finish(self) -> str:
        return self.state.decode(b"", True)


_KEPT: dict[str, tuple[Encoder, Speller, Speller]] = {}


def tools(spec: str) -> tuple[Encoder, Speller, Speller]:
    """The encoder of a vocabulary's JSON text, the spellers of its tokens' bytes and of decimal
    ids with a comma before each; kept by the worker for its next task."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _KEPT:
        v = Vocabulary(spec)
        _KEPT.clear()
        _KEPT[key] = Encoder(v), Speller(v.bytes), Speller([b",%d" % i for i in range(v.width)])
    return _KEPT[key]


def read_spec(path: str) -> str:
    """The vocabulary file, read by the driver and sent to the tasks: a file of fixed size."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the token ids of every text."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        e, _, _ = tools(spec.value)
        ids = [e.ids(t).astype(np.int32) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                                           pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(src, "doc_id long, n_tokens long, ids array<int>", run)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of every list of token ids (null: empty)."""
    spec = tokens.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        (_, spell, _), out = tools(spec.value), []
        for ids in batch.column(1).to_pylist():
            d = Decoder(spell)
            out.append(d.feed(np.array(ids or (), dtype=np.int64)) + d.finish())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])
    src = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return map_batches(src, "doc_id long, text string", run)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode its tokens again, in one pass: doc_id, n_tokens, ids_sha256,
    decoded_sha256, same (whether the decoded text is the text)."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        e, spell, decimal = tools(spec.value)
        rows = []
        for text in batch.column(1).to_pylist():
            n, ids_sha, text_sha, back = 0, hashlib.sha256(), hashlib.sha256(), Decoder(spell)
            for ids in e.encode(text):
                listed = decimal(ids)
                ids_sha.update(listed if n else listed[1:])
                text_sha.update(back.feed(ids).encode())
                n += len(ids)
            text_sha.update(back.finish().encode())
            same = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest() == text_sha.digest()
            rows.append((n, ids_sha.hexdigest(), text_sha.hexdigest(), same))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in
                                enumerate((pa.int64(), pa.string(), pa.string(), pa.bool_())))],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(src, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean", run)
