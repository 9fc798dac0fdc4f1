"""Word shingles as 64-bit hashes, for whole batches of texts at once.

Words are what white space separates, in lower case.  A text of fewer words
than a shingle has (but at least one) has one shingle, all its words; a text
without words has none.
"""

from __future__ import annotations

import numpy as np

from kestrel.llm.common import mix, seeds

#: Bytes hashed at once; keeps the work arrays inside the processor cache.
CHUNK = 1 << 18
_P = 0x5851F42D4C957F2D
_PINV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW[0]) < n:
        size = max(n, CHUNK + 4096)
        _POW[:] = [_powers(_P, size), _powers(_PINV, size)]
    return _POW[0], _POW[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes (mod 2**64, scrambled, length mixed in) of the byte spans of ``data``."""
    up, down = _tables(len(data) + 1)
    acc = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=acc[1:])
    h = (acc[ends] - acc[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts whose words one blank separates, and how many each text has."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    counts = np.array([t.count(b" ") + 1 for t in texts])
    return span_hashes(data, starts, ends), counts


def shingle_hashes(texts: list[str | None], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and the offsets (one more than texts) that part them.

    Repeated shingles of a text are not merged here.
    """
    clean = [" ".join((t or "").lower().split()).encode("utf-8", "surrogatepass") for t in texts]
    hashes, sizes = [], np.zeros(len(clean) + 1, dtype=np.int64)
    mult = seeds(width, 7)
    at = 0
    while at < len(clean):
        to, size = at, 0
        while to < len(clean) and (to == at or size + len(clean[to]) < CHUNK):
            size += len(clean[to]) + 1
            to += 1
        some = [i for i in range(at, to) if clean[i]]
        if some:
            words, counts = _words([clean[i] for i in some])
            n = len(words)
            total = np.zeros(n, dtype=np.uint64)
            left = np.repeat(np.cumsum(counts), counts) - np.arange(n)     # words to the text's end
            for j in range(width):
                shifted = np.zeros(n, dtype=np.uint64)
                shifted[:max(n - j, 0)] = words[j:]
                total += np.where(left > j, shifted, np.uint64(0)) * mult[j]
            first = np.repeat(np.cumsum(counts) - counts, counts) == np.arange(n)
            keep = (left >= width) | first
            hashes.append(mix(total[keep]))
            sizes[np.array(some) + 1] = np.maximum(counts - width + 1, 1)
        at = to
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), np.cumsum(sizes)
