"""Word shingles of whole texts as 64-bit fingerprints, computed on whole Arrow batches.

Words are runs of bytes other than the six ASCII white-space characters, after lower-casing A-Z.
A word's fingerprint folds its bytes, eight at a time, and its length; a shingle's folds the
fingerprints of its words in order.  Every step is a numpy operation over the concatenated bytes
of a batch, so no Python code runs per word.
"""

from __future__ import annotations

import numpy as np

#: A-Z to lower case, the six white-space characters to space.
_PLAIN = bytes(32 if b in (9, 10, 11, 12, 13, 32) else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Bytes handled at once; a longer text is handled alone.
CHUNK_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(joined: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and fingerprint of every word of the bytes given."""
    plain = joined.translate(_PLAIN) + b" " * 8
    data = np.frombuffer(plain, np.uint8)
    inside = np.concatenate(([False], data != 32))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    eights = np.ndarray(len(plain) - 7, "<u8", plain, strides=(1,))
    lengths = ends - starts
    prints = mix(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    live, at = np.arange(len(starts)), 0
    while len(live):
        left = np.minimum(lengths[live] - at, 8)
        prints[live] = mix(prints[live] ^ (eights[starts[live] + at] & _MASKS[left]))
        at += 8
        live = live[lengths[live] > at]
    return starts, ends, prints


def batches(texts: list[bytes]):
    """Runs of texts whose bytes come to about CHUNK_BYTES: (first index, texts)."""
    first, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > CHUNK_BYTES:
            yield first, texts[first:k]
            first, held = k, 0
        held += len(t)
    if first < len(texts):
        yield first, texts[first:]


def word_prints(texts: list[bytes]) -> list[np.ndarray]:
    """The fingerprints of each text's words, in order."""
    out: list[np.ndarray] = []
    for _, some in batches(texts):
        joined = b"\n".join(some) + b"\n"
        starts, _, prints = words_of(joined)
        bounds = np.cumsum([len(t) + 1 for t in some])
        out += np.split(prints, np.searchsorted(starts, bounds)[:-1])
    return out


def shingle_prints(words: np.ndarray, k: int = 5) -> np.ndarray:
    """One fingerprint for each run of k words; a shorter text counts as one shingle, an empty one has none."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    with np.errstate(over="ignore"):
        total = np.full(n - width + 1, np.uint64(width), np.uint64)
        for j in range(width):
            total = total * np.uint64(0x9FB21C651E98DF25) + words[j : n - width + 1 + j]
            total ^= total >> np.uint64(29)
        return mix(total)


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """The distinct shingles, in ascending order."""
    return np.unique(shingle_prints(words, k))
