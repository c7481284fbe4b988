"""Words of a text as 64-bit hashes, computed over whole byte arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z.
Its hash is a polynomial modulo 2**64 with a fixed odd base, cut out of prefix sums and
then mixed, so no Python object is made per word.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 20

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; kept and extended by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(1, U)
        while len(have) < size:
            have = np.concatenate([have, have * U(pow(base, len(have), 1 << 64))])
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit values that spreads every bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """n + 1 sums of (byte + 1) * BASE**i; differences give the hash of any substring."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers(INVERSE, len(sums))[start])


def pieces(raw: bytes):
    """Parts of about CHUNK bytes that end at white space, so long texts take no long arrays."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw) and not SPACE[raw[end]]:
            end += 1
        yield np.frombuffer(raw, np.uint8, end - at, at)
        at = end


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~SPACE[data]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word, in order; null counts as empty."""
    found = []
    for part in pieces((text or "").encode("utf-8", "surrogatepass")):
        data = LOWER[part]
        start, end = spans(data)
        if len(start):
            found.append(between(prefix_sums(data), start, end))
    return np.concatenate(found) if found else np.zeros(0, U)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a shorter text is one shingle, an empty
    one none."""
    if not len(words):
        return words
    width = min(size, len(words))
    n, out = len(words) - width + 1, np.full(len(words) - width + 1, U(width))
    for i in range(width):
        out = out * U(0xD6E8FEB86659FD93) + words[i:i + n]
        out = out ^ (out >> U(32))
    return np.unique(mix(out))


def word_batches(texts):
    """(first, bounds, hashes, endings) for runs of consecutive texts of about CHUNK bytes.

    bounds has one entry more than texts in the run; endings are the last two bytes of each
    word as one number.  A text beyond CHUNK bytes is a run of its own, hashed in pieces.
    """
    raws, first, size = [], 0, 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if raws and size + len(raw) > CHUNK:
            yield _run(first, raws)
            raws, first, size = [], i, 0
        raws.append(raw)
        size += len(raw) + 1
    if raws:
        yield _run(first, raws)


def _run(first: int, raws: list[bytes]):
    hashes, endings, starts, at = [], [], [], 0
    joined = b"\n".join(raws)
    for part in pieces(joined):
        data = LOWER[part]
        start, end = spans(data)
        if len(start):
            hashes.append(between(prefix_sums(data), start, end))
            before = np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.int64)
            endings.append(before << 8 | data[end - 1])
            starts.append(start + at)
        at += len(part)
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    ends = np.cumsum([len(r) + 1 for r in raws])
    bounds = np.concatenate([[0], np.searchsorted(start, ends)])
    return (first, bounds, np.concatenate(hashes) if hashes else np.zeros(0, U),
            np.concatenate(endings) if endings else none)
