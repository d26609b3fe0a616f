"""Vectorised hashing of words and word shingles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

U = np.uint64
#: Letters and digits of ASCII (as lower case) and every byte of a longer character belong to words; all else parts them.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)[_LOWER] * U(2) + U(1)
_P = 0x9E3779B97F4A7C15
#: Bytes that are hashed at a time, whatever the length of the texts.
SLICE = 1 << 16
_powers = np.cumprod(np.concatenate([np.ones(1, U), np.full(SLICE, _P, U)]))
_inverse = np.cumprod(np.concatenate([np.ones(1, U), np.full(SLICE, pow(_P, -1, 1 << 64), U)]))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def word_places(buf: np.ndarray, inside: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every run of ``inside`` bytes, ASCII letters as lower case.

    The bytes are read in slices; a word that goes on in the next slice is put
    together again, so that memory besides the result stays fixed.
    """
    sums, starts, ends = [], [], []
    for at in range(0, len(buf), SLICE):
        b = buf[at : at + SLICE]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside[b], [False]]).view(np.int8)))
        s, e = edge[::2], edge[1::2]
        if not len(s):
            continue
        total = np.concatenate([np.zeros(1, U), np.cumsum(_BYTE[b] * _powers[: len(b)])])
        h = (total[e] - total[s]) * _inverse[s]
        if s[0] == 0 and ends and ends[-1][-1] == at:
            far = U(pow(_P, int(at - starts[-1][-1]), 1 << 64))
            sums[-1][-1:] += h[:1] * far
            ends[-1][-1] = at + e[0]
            h, s, e = h[1:], s[1:], e[1:]
            if not len(s):
                continue
        sums.append(h)
        starts.append(at + s)
        ends.append(at + e)
    if not sums:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, start, end = map(np.concatenate, (sums, starts, ends))
    return mix(h + (end - start).astype(U)), start, end


def word_hashes(texts: Sequence[bytes], inside: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, start byte, end byte) of every word; bytes count from the start of its text."""
    h, start, end = word_places(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), inside)
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    doc = np.searchsorted(first, start, side="right") - 1
    return h, doc, start - first[doc], end - first[doc]


def shingles(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, position of its first word) of every run of ``n`` words; a text of fewer words is one run."""
    if not len(h):
        return h, doc, doc
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    size = np.diff(np.concatenate([start, [len(doc)]]))
    first, last = np.repeat(start, size), np.repeat(start + size - 1, size)
    at, padded = np.arange(len(h)), np.concatenate([h, np.zeros(n, U)])
    out = np.zeros(len(h), U)
    for i in range(n):
        out = out * U(0xD1342543DE82EF95) + padded[i : i + len(h)] * (at + i <= last)
    keep = (at + n - 1 <= last) | ((at == first) & (last - first + 1 < n))
    return mix(out[keep] + U(n)), doc[keep], at[keep] - first[keep]


def blocks(texts: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as UTF-8; null: empty) in groups of about ``limit`` bytes; a longer text is a group of its own."""
    at, held, size = 0, [], 0
    for i, t in enumerate(texts.cast(pa.binary())):
        b = t.as_py() or b""
        if held and size + len(b) > limit:
            yield at, held
            at, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield at, held
