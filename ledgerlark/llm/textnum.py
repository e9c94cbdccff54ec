"""Words and shingles of many texts as numpy arrays of 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+`` on the UTF-8 bytes, unchanged or with A-Z
lower-cased.  A word's hash is a polynomial in random byte weights modulo 2**64
with a mixing finish; shingle hashes fold word hashes in order.  Hashes only
propose: every operator confirms on the words themselves.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E6C63D0876A9A47)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words hashed at once; bounds the eight-byte temporaries per text byte.
_BLOCK = 1 << 17
_pow = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _pow
    if len(_pow) < n:
        _pow = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 2 * len(_pow)) - 1, _BASE)]), dtype=np.uint64)
    return _pow


class Words(NamedTuple):
    starts: np.ndarray   # byte offset of each word
    ends: np.ndarray
    hashes: np.ndarray   # uint64
    first: np.ndarray    # word index of each row's first word; one more entry than rows


def spans(buf: np.ndarray, offs: np.ndarray, is_break: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that are no break; a run never crosses a row boundary."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    brk = is_break[buf]
    before, after = np.empty(len(buf), bool), np.empty(len(buf), bool)
    before[0], before[1:] = True, brk[:-1]
    after[-1], after[:-1] = True, brk[1:]
    cuts = offs[(offs > 0) & (offs < len(buf))]
    before[cuts] = True
    after[cuts - 1] = True
    keep = ~brk
    return np.flatnonzero(keep & before), np.flatnonzero(keep & after) + 1


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span (spans ascending and disjoint)."""
    out = np.empty(len(starts), np.uint64)
    lens = ends - starts
    total = np.concatenate([[0], np.cumsum(lens)])
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + 8 * _BLOCK, "right")) - 1)
        hi = min(hi, lo + _BLOCK, len(starts))
        n = lens[lo:hi]
        at = total[lo:hi] - total[lo]
        pos = np.arange(total[hi] - total[lo]) - np.repeat(at, n)
        b = buf[pos + np.repeat(starts[lo:hi], n)]
        vals = _BYTE[_LOWER[b] if lower else b]
        vals *= _powers(int(n.max(initial=0)) + 1)[pos]
        full = n > 0
        out[lo:hi] = 0
        if full.any():
            out[lo:hi][full] = np.add.reduceat(vals, at[full])
        lo = hi
    return mix(out + lens.astype(np.uint64) * _FOLD)


def words_of(buf: np.ndarray, offs: np.ndarray, lower: bool = False) -> Words:
    starts, ends = spans(buf, offs, _SPACE)
    return Words(starts, ends, hash_spans(buf, starts, ends, lower), np.searchsorted(starts, offs))


def fold(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive hashes (empty when there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    g = hashes[:n] * _FOLD
    for j in range(1, k):
        g += hashes[j : n + j]
        g *= _FOLD
    return mix(g)


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct ``k``-word shingle hashes; fewer words: the whole sequence; none: empty."""
    grams, out = fold(w.hashes, k), []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(fold(w.hashes[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def word_list(text: str | None, lower: bool = False) -> list[bytes]:
    """The words of one text as bytes: ASCII white space parts them, lower-casing touches A-Z only."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()
