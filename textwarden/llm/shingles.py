"""Word shingles of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

from .common import mix

_FACTOR = 0xD6E8FEB86659FD93
_PIECE = 1 << 19
_POWERS: list[np.ndarray] = []
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEPS = mix(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS.clear()
        for factor in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            steps = np.full(max(size, _PIECE + 1), factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def word_hashes(text: str) -> np.ndarray:
    """Hash of each word of the text: A-Z in lower case, split at ASCII white space only."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    out, at = [], 0
    while at < len(data):
        stop = min(len(data), at + _PIECE)
        if stop < len(data):
            # Pieces end at white space; one within a longer word is moved to its end.
            blanks = np.flatnonzero(_SPACE[data[at:stop]])
            if len(blanks):
                stop = at + int(blanks[-1]) + 1
            else:
                rest = np.flatnonzero(_SPACE[data[stop:]])
                stop = stop + int(rest[0]) + 1 if len(rest) else len(data)
        piece = data[at:stop]
        solid = ~_SPACE[piece]
        edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[piece] * up[:len(piece)], out=sums[1:])
        out.append(mix((sums[end] - sums[start]) * down[start]))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct shingles, sorted; a shorter text is one shingle of all its words."""
    h = word_hashes(text) if text else np.zeros(0, dtype=np.uint64)
    if not len(h):
        return h
    k = min(words, len(h))
    total = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        total += h[i:len(h) - k + 1 + i] * _STEPS[i]
    return np.unique(mix(total))
