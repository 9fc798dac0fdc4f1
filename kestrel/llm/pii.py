"""Personal data by rules and by a character-level bidirectional LSTM with CRF transitions.

The rules give the base spans: email addresses, IPv4 addresses, payment cards and
phone numbers.  The network is trained in numpy from spans that the rules label
in a bounded sample of windows, and from those spans rewritten in the ways people
write them and the rules do not know: a phone number without its plus sign, a
card with dots, an email address with blanks around its at sign, an address with its
dots in brackets (`rewrite`).  Digits and names of rewritten spans are drawn anew, so that
shapes are learned, not values.

The network reads what is around every digit and every at sign of every text (no span
of these kinds is without both), up to the next white space on either side, over one
blank next to an at sign.  Windows overlap, each is decoded by Viterbi search, and a
character that several windows hold gets the tag of the window in which it is farthest
from an edge.  A span then takes in the characters next to it that belong to it
(`completed`).  Spans are added where no base span is and the kind's own test (digits,
check digit, parts up to 255) passes; all four kinds can be added.

Defined results: null texts count as empty; positions are code points, ends
exclusive; rows that repeat give repeated results; other columns are ignored by
`digest` and kept by `redact`.  With nothing to learn from, only base spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import lstm
from kestrel.llm.common import map_batches, text_of

KINDS = ("email", "ip", "card", "phone")
# fixed values: the base patterns; email is looked for from its at sign on
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Windows that the network is trained on at most; characters in a window and shared by neighbours; on each side of a trigger.
TRAIN_WINDOWS, WINDOW, OVERLAP, AROUND = 1000, 96, 48, 24
HIDDEN, STEPS, BATCH, RATE, SEED = 20, 280, 140, 0.03, 5
#: Rewritten windows and decoys that are made of the labelled ones.
REWRITTEN, DECOYS = 1600, 300
#: Windows decoded at once.
DECODE = 256
_TRIGGER, _BLANK = re.compile("[0-9@]"), re.compile(r"\s")
_SYMBOLS = 98


def luhn(digits: str) -> bool:
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _AT.finditer(text):
        at = m.start()
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the rules, by kind, then start."""
    out = [("email", i, j) for i, j in _emails(text)] if "@" in text else []
    if not _TRIGGER.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


# ---- the network ----

def symbols(text: str) -> np.ndarray:
    """Symbol number of each character: printable ASCII, other white space, other letters, all else."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    out = np.where((raw >= 32) & (raw < 127), raw - 32, 97)
    for i in np.flatnonzero(out == 97):
        c = text[i]
        out[i] = 95 if c.isspace() else 96 if c.isalpha() else 97
    return out


#: Tags: outside, then beginning and inside of each kind.
TAGS = 1 + 2 * len(KINDS)


def _allowed() -> np.ndarray:
    """Penalties: an inside tag only follows a tag of its kind."""
    ok = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        ok[:, inside] = -1e4
        ok[inside - 1, inside] = ok[inside, inside] = 0
    return ok


def initial(seed: int = SEED) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p: dict[str, np.ndarray] = {}
    for d in ("f", "b"):
        p["x" + d] = r.normal(0, 0.1, (_SYMBOLS, 4 * HIDDEN))
        p["h" + d] = r.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        p["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    p["o"], p["ob"], p["t"] = r.normal(0, 0.2, (2 * HIDDEN, TAGS)), np.zeros(TAGS), np.zeros((TAGS, TAGS))
    return p


def _emissions(p: dict, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, tuple]:
    ahead, kf = lstm.forward(p["xf"][x] + p["cf"], p["hf"], keep)
    behind, kb = lstm.forward(p["xb"][x[::-1]] + p["cb"], p["hb"], keep)
    both = np.concatenate([ahead, behind[::-1]], axis=2)
    return both @ p["o"] + p["ob"], both, (kf, kb)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradient(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean negative log likelihood of tags y under the CRF, and its gradient; both (time, batch)."""
    e, both, (kf, kb) = _emissions(p, x, keep=True)
    trans = p["t"] + _allowed().astype(p["t"].dtype)
    steps, n = x.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, steps):
        alpha[t] = _logsum(alpha[t - 1][:, :, None] + trans, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsum(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _logsum(alpha[-1], 1)
    de = np.exp(alpha + beta - z[None, :, None])
    rows = np.arange(n)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    score = e[0][rows, y[0]].copy()
    de[0][rows, y[0]] -= 1
    for t in range(1, steps):
        pair = np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - z[:, None, None])
        grad["t"] += pair.sum(0)
        score += e[t][rows, y[t]] + trans[y[t - 1], y[t]]
        de[t][rows, y[t]] -= 1
    grad["t"] -= np.bincount((y[:-1] * TAGS + y[1:]).reshape(-1), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
    grad["o"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, TAGS)
    grad["ob"] = de.sum((0, 1))
    dboth = de @ p["o"].T
    for d, seen, kept, dout in (("f", x, kf, dboth[:, :, :HIDDEN]), ("b", x[::-1], kb, dboth[::-1, :, HIDDEN:])):
        dz, grad["h" + d] = lstm.back(dout, kept, p["h" + d])
        which = np.zeros((_SYMBOLS, seen.size), dtype=dz.dtype)
        which[seen.reshape(-1), np.arange(seen.size)] = 1
        grad["x" + d] = which @ dz.reshape(seen.size, -1)
        grad["c" + d] = dz.sum((0, 1))
    return float((z - score).mean()), {k: g / n for k, g in grad.items()}


def train(windows: list[tuple[str, list[tuple[str, int, int]]]], steps: int = STEPS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters from windows of at most WINDOW characters with their spans (Adam)."""
    p, r = {k: v.astype(np.float32) for k, v in initial(seed).items()}, np.random.default_rng(seed)
    adam = lstm.Adam(p)
    x = np.full((len(windows), WINDOW), 95)
    y = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for i, (text, spans) in enumerate(windows):
        x[i, :len(text)] = symbols(text)
        for kind, a, b in spans:
            k = KINDS.index(kind)
            y[i, a:b] = 2 + 2 * k
            y[i, a] = 1 + 2 * k
    letters = (x >= ord("A") - 32) & (x <= ord("z") - 32) & (y == 0)
    done = 0
    while done < steps:
        order = r.permutation(len(windows))
        # words around the spans are not to be learned: other letters in half of the windows
        seen = np.where(letters & (r.random((len(x), 1)) < 0.5), r.integers(65, 91, x.shape), x)
        for at in range(0, len(order), BATCH):
            pick, rate = order[at:at + BATCH], RATE * max(0.02, 1 - done / steps)
            done += 1
            _, grad = gradient(p, seen[pick].T, y[pick].T)
            adam.apply(grad, rate)
    return p


def decode(p: dict, texts: list[str]) -> list[np.ndarray]:
    """The best tags of each text of at most WINDOW characters."""
    size = max(map(len, texts))
    x = np.full((size, len(texts)), 95)
    for i, t in enumerate(texts):
        x[:len(t), i] = symbols(t)
    e, _, _ = _emissions(p, x)
    trans = p["t"] + _allowed().astype(p["t"].dtype)
    best, back = e[0], []
    for t in range(1, size):
        score = best[:, :, None] + trans
        back.append(score.argmax(1))
        best = score.max(1) + e[t]
    tags = np.empty((size, len(texts)), dtype=np.int64)
    tags[-1] = best.argmax(1)
    for t in range(size - 1, 0, -1):
        tags[t - 1] = back[t - 1][np.arange(len(texts)), tags[t]]
    return [tags[:len(t), i] for i, t in enumerate(texts)]


# ---- windows ----

def _reach(text: str, i: int) -> tuple[int, int]:
    """What a trigger's region takes in: AROUND characters, then on to white space; past one blank next to an at sign."""
    a, b = max(0, i - AROUND), min(len(text), i + 1 + AROUND)
    if text[i] == "@":
        if text[i - 1:i] == " ":
            a = min(a, i - 1)
        if text[i + 1:i + 2] == " ":
            b = max(b, i + 2)
    return a, b


def windows_of(text: str) -> list[tuple[int, int]]:
    """Overlapping windows over all that is near a digit or an at sign."""
    out, regions = [], []
    for m in _TRIGGER.finditer(text):
        a, b = _reach(text, m.start())
        if regions and b <= regions[-1][1]:
            continue
        low = regions[-1][1] if regions else 0
        while a > low and not text[a - 1].isspace():
            a -= 1
        end = _BLANK.search(text, b)
        b = end.start() if end else len(text)
        if regions and a <= low:
            regions[-1][1] = b
        else:
            regions.append([a, b])
    for a, b in regions:
        while b - a > WINDOW:
            out.append((a, a + WINDOW))
            a += WINDOW - OVERLAP
        out.append((a, b))
    return out


def reconcile(windows: list[tuple[int, int]], tags: list[np.ndarray]) -> list[tuple[str, int, int]]:
    """Spans of a text from the tags of its windows, each character tagged where it is farthest from an edge."""
    spans, i = [], 0
    while i < len(windows):
        j = i + 1
        while j < len(windows) and windows[j][0] < windows[j - 1][1]:
            j += 1
        lo, hi = windows[i][0], windows[j - 1][1]
        depth, tag = np.full(hi - lo, -1), np.zeros(hi - lo, dtype=np.int64)
        for (a, b), t in zip(windows[i:j], tags[i:j]):
            own = np.minimum(np.arange(b - a), np.arange(b - a)[::-1])
            wins = own > depth[a - lo:b - lo]
            tag[a - lo:b - lo][wins] = t[wins]
            depth[a - lo:b - lo][wins] = own[wins]
        begin = kind = None
        for at, t in enumerate([*tag.tolist(), 0]):
            if begin is not None and t != 2 + 2 * kind:
                spans.append((KINDS[kind], lo + begin, lo + at))
                begin = None
            if t % 2 == 1 or t and begin is None:       # an inside tag that lost its beginning to a seam begins
                begin, kind = at, (t - 1) // 2
        i = j
    return spans


_DOMAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.-")


def completed(text: str, kind: str, a: int, b: int) -> tuple[int, int]:
    """The span with the characters next to it that belong to it, without the punctuation around it."""
    if kind == "email":
        left, right = _LOCAL, _DOMAIN
    else:
        left = right = frozenset("0123456789")
    while a > 0 and text[a - 1] in left:
        a -= 1
    while b < len(text) and text[b] in right:
        b += 1
    if kind == "phone" and a > 0 and text[a - 1] == "(":
        a -= 1
    while b > a and not text[b - 1].isalnum():          # a seam or a full stop may be drawn in
        b -= 1
    while a < b and not (text[a].isalnum() or text[a] == "("):
        a += 1
    return a, b


def plausible(kind: str, found: str) -> bool:
    """The test of a kind for what the network alone has found."""
    digits = "".join(c for c in found if c in "0123456789")
    if kind == "phone":
        return 9 <= len(digits) <= 15 and bool(re.fullmatch(r"\(?[0-9]+\)?(?:[ ./-]{1,2}\(?[0-9]+\)?){2,5}", found)) and not re.search(
            r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}", found)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9]{4}(?:[ ./-]{1,2}[0-9]{3,6}){2,4}", found))
    if kind == "ip":
        parts = re.fullmatch(r"([0-9]{1,3})(?: ?[\[(]?\.[\])]? ?([0-9]{1,3}))(?: ?[\[(]?\.[\])]? ?([0-9]{1,3}))(?: ?[\[(]?\.[\])]? ?([0-9]{1,3}))", found)
        return parts is not None and all(map(_small, parts.groups()))
    return bool(re.fullmatch(r"[^\s@]+ ?@ ?[^\s@]+\.[^\s@.]{2,}", found))


# ---- training windows ----

def _labelled(text: str) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """Windows around base spans and around triggers without one; digits that only fail the check digit count as cards,
    since their shape is all that a network can learn."""
    spans = base_spans(text)
    taken = {i for _, a, b in spans for i in (a, b - 1)}
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and m.start() not in taken:
            spans.append(("card", *m.span()))
    for a, b in windows_of(text):
        yield text[a:b], [(k, i - a, j - a) for k, i, j in spans if a <= i and j <= b]


def _name(r: np.random.Generator, longest: int) -> str:
    """Letters and digits, in up to three parts."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    parts = ["".join(r.choice(list(letters), int(r.integers(2, longest)))) for _ in range(1 + int(r.integers(3)))]
    out = "._-"[r.integers(3)].join(parts)
    return (out.title() if r.random() < 0.2 else out) + (str(r.integers(100)) if r.random() < 0.2 else "")


def rewrite(kind: str, r: np.random.Generator) -> str:
    """A span of this kind in a shape that the rules do not know, with digits and names of its own."""
    some = r.integers(0, 10, 2) if r.random() < 0.3 else np.arange(10)      # digits may repeat
    digits = "".join(str(d) for d in r.choice(some, 19))
    if kind == "phone":
        d = digits[:10]
        return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"0{d[:3]} {d[3:6]} {d[6:]}",
                f"{d[:3]} {d[3:6]} {d[6:]}"][r.integers(5)]
    if kind == "card":
        sep = [".", " ", "-", "/"][r.integers(4)]
        return sep.join(digits[i:i + 4] for i in range(0, 16, 4))
    if kind == "ip":
        sep = ["[.]", " . ", "(.)", "[.]"][r.integers(4)]
        return sep.join(str(r.integers(256)) for _ in range(4))
    domain = ".".join([*_name(r, 10).replace("_", "-").replace(".", "-").split("-")[:1 + int(r.integers(2))],
                       ["com", "org", "net", "example", "co.uk", "de"][r.integers(6)]]).lower()
    return _name(r, 12) + [" @ ", "@ ", " @", " @ "][r.integers(4)] + domain


def _rewritten(text: str, spans: list[tuple[str, int, int]], r: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]] | None:
    """The window with its only span replaced by one of any kind in another shape."""
    if len(spans) != 1:
        return None
    _, a, b = spans[0]
    kind = KINDS[r.integers(len(KINDS))]
    new = rewrite(kind, r)
    before, after = text[:a], text[b:]
    room = WINDOW - len(new)
    before = before[-min(len(before), room // 2):] if room > 1 else ""
    return before + new + after[:room - len(before)], [(kind, len(before), len(before) + len(new))]


def _decoy(text: str, spans: list[tuple[str, int, int]], r: np.random.Generator) -> tuple[str, list[tuple[str, int, int]]] | None:
    """The window with its only span replaced by something that has an at sign or digits and is none."""
    if len(spans) != 1:
        return None
    _, a, b = spans[0]
    n = [str(x) for x in r.integers(0, 1000, 4)]
    new = [f"{_name(r, 8)} @ {_name(r, 6).split('.')[0]}", f"{n[0]} @ {n[1]}", f"{n[0]}-{n[1]}", f"{n[0]}.{n[1]}", f"{1900 + int(r.integers(130))}",
           f"{n[0]} {n[1]} {n[2]}", f"{n[0]},{n[1]}"][r.integers(7)]
    return (text[:a] + new + text[b:])[:WINDOW], []


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_WINDOWS) -> dict[str, np.ndarray] | None:
    """Train on at most ``most`` labelled windows, those with the smallest hash; Spark finds them in all documents."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(w, ",".join(f"{k}:{a}:{b}" for k, a, b in s)) for t in batch.column(0).to_pylist() for w, s in _labelled(t)]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["w", "s"])
    some = map_batches(docs.select(text_of(text_col).alias("text")).where(F.col("text").rlike("[0-9@]")), "w string, s string", run)
    picked = some.distinct().orderBy(F.xxhash64("w"), "w").limit(most).collect()
    if not picked:
        return None
    return train(augmented([(row.w, [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in row.s.split(",") if x)]) for row in picked]), STEPS)


def augmented(windows: list[tuple[str, list[tuple[str, int, int]]]], seed: int = SEED) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """The labelled windows, and from those with one span many with spans of every kind in other shapes, and decoys."""
    r = np.random.default_rng(seed)
    single = [w for w in windows if len(w[1]) == 1]
    made = [f(*single[r.integers(len(single))], r) for f, n in ((_rewritten, REWRITTEN), (_decoy, DECOYS)) for _ in range(n if single else 0)]
    return [(text[:WINDOW], [x for x in spans if x[2] <= WINDOW]) for text, spans in [*windows, *filter(None, made)]]


def find(texts: list[str], p: dict | None) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) for t in texts]
    if p is None:
        return [(b, []) for b in base]
    where = [windows_of(t) for t in texts]
    flat = sorted(((b - a, i, a, b) for i, w in enumerate(where) for a, b in w))
    tags: dict[tuple[int, int], np.ndarray] = {}
    for at in range(0, len(flat), DECODE):
        part = flat[at:at + DECODE]
        for (_, i, a, _), t in zip(part, decode(p, [texts[i][a:b] for _, i, a, b in part])):
            tags[i, a] = t
    out = []
    for i, text in enumerate(texts):
        added = []
        for kind, a, b in reconcile(where[i], [tags[i, a] for a, _ in where[i]]) if where[i] else ():
            a, b = completed(text, kind, a, b)
            if plausible(kind, text[a:b]) and not any(a < y and x < b for _, x, y in [*base[i], *added]):
                added.append((kind, a, b))
        out.append((base[i], added))
    return out


def listed(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1])))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256 and all spans of every text."""
    p = learn(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(p)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find(batch.column(1).to_pylist(), sent.value)
        counts = [pa.array([sum(k == kind for k, _, _ in b) for b, _ in found], pa.int64()) for kind in KINDS]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *counts, pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b, _ in found]),
             pa.array([listed([*b, *m]) for b, m in found], pa.string()), pa.array([len(m) for _, m in found], pa.int64())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(src, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
                            "n_added long", run)


def replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span's characters replaced by its kind; spans that overlap go together."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all spans replaced; null texts stay null."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, id_col, text_col))
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        found = find([t or "" for t in texts], sent.value)
        new = [t if t is None else replaced(t, [*b, *m]) for t, (b, m) in zip(texts, found)]
        return pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == at else c for i, c in enumerate(batch.columns)],
                                          batch.schema.names)
    return map_batches(docs, docs.schema, run)
