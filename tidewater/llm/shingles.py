"""Words and word shingles of UTF-8 texts as 64-bit hashes, computed with numpy.

Words are runs of bytes other than space and 0x09-0x0D after lower-casing A-Z. Two
different shingles share a hash with probability 2**-64.
"""

from __future__ import annotations

import numpy as np

from tidewater.llm.common import chunks, mix, powers

WORDS = 5
_B = 0x100000001B3
_B_INV = pow(_B, -1, 1 << 64)
_Q = np.uint64(0xD6E8FEB86659FD93)
_PIECE = 1 << 20  # bytes hashed at once
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(n - 1, 1).bit_length()
    if size not in _POW:
        _POW.clear()
        _POW[size] = powers(_B, size), powers(_B_INV, size)
    return _POW[size]


def lower(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    return np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return spans((b == 32) | ((b >= 9) & (b <= 13)))


def spans(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every run without a gap."""
    edge = np.diff(np.r_[True, gap, True].astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def hash_spans(b: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of every range of a sequence of small numbers."""
    up, down = _pow(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=total[1:])
    return mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _Q)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of every word of a text, in order."""
    b = lower(data)
    s, e = word_spans(b)
    if len(b) <= _PIECE or not len(s):
        return hash_spans(b, s, e)
    out, i = [], 0
    while i < len(s):  # by whole words; one word may be longer than a piece
        j = max(int(np.searchsorted(e, s[i] + _PIECE, "right")), i + 1)
        out.append(hash_spans(b[s[i]:e[j - 1]], s[i:j] - s[i], e[i:j] - s[i]))
        i = j
    return np.concatenate(out)


def chain(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words."""
    n = len(w) - k + 1
    h = w[:n].copy()
    for i in range(1, k):
        h = h * _Q + w[i:n + i]
    return mix(h + np.uint64(k))


def shingle_list(w: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Shingle hashes in text order; fewer words than ``k`` are one shingle."""
    if len(w) == 0:
        return w
    return chain(w, min(k, len(w)))


def shingle_set(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_list(word_hashes((text or "").encode("utf-8", "replace")), k))


def shingle_sets(texts: list[str | None], k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of many texts at once: all hashes, and where each
    text's begin (one more than texts)."""
    parts, sizes = [], []
    for lo, hi in chunks([len(t or "") for t in texts], _PIECE >> 2):
        if hi - lo == 1:
            s = shingle_set(texts[lo], k)
            parts.append(s)
            sizes.append(np.asarray([len(s)]))
            continue
        data = [(t or "").encode("utf-8", "replace") for t in texts[lo:hi]]
        ends = np.cumsum([len(d) + 1 for d in data])
        b = lower(b" ".join(data) + b" ")
        s, e = word_spans(b)
        w = hash_spans(b, s, e)
        edge = np.r_[0, np.searchsorted(s, ends)]  # words of each text
        n = np.diff(edge)
        owner = np.repeat(np.arange(hi - lo), n)
        if len(w) >= k:
            fine = np.flatnonzero(owner[:len(w) - k + 1] == owner[k - 1:])
            h, own = chain(w, k)[fine], owner[fine]
        else:
            h, own = np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.r_[0, np.cumsum(np.bincount(own, minlength=hi - lo))]
        for i in range(hi - lo):
            h[at[i]:at[i + 1]].sort()
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
        h, own = h[new], own[new]
        short = np.flatnonzero((n > 0) & (n < k))
        if len(short):
            few = np.asarray([chain(w[edge[i]:edge[i + 1]], int(n[i]))[0] for i in short],
                             np.uint64)
            place = np.searchsorted(own, short)
            h, own = np.insert(h, place, few), np.insert(own, place, short)
        parts.append(h)
        sizes.append(np.bincount(own, minlength=hi - lo))
    if not parts:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.r_[0, np.cumsum(np.concatenate(sizes))]
