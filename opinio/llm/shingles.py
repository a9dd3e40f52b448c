"""Shingle sets of texts, as sorted 64-bit hashes, computed in bulk.

A polynomial hash over a run of bytes gives every word's hash by one
subtraction and one multiplication, so a batch of texts is handled by a few
vector operations instead of a loop over words. Two different shingles of a
corpus share a hash with a probability of about 2^-64 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Words in a shingle.
SHINGLE = 5
#: Bytes of texts handled at a time; a longer text is handled alone.
RUN_BYTES = 1 << 21
#: Bytes whose words are hashed at a time; a longer word is hashed alone.
PIECE_BYTES = 1 << 18

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64) + 1
_LOWER[ord("A"):ord("Z") + 1] += 32


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) <= n:
        size = 1 << n.bit_length()
        for k, base in enumerate((_P, _P_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a run of bytes, A-Z lowered."""
    space = _SPACE[raw]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    words = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        at = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, at + PIECE_BYTES, "right")))
        piece = raw[at:ends[j - 1]]
        power, inverse = _power(len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_LOWER[piece] * power[:len(piece)], out=total[1:])
        first = starts[i:j] - at
        words[i:j] = mix((total[ends[i:j] - at] - total[first]) * inverse[first])
        i = j
    return starts, words


def _runs(texts: list[str]) -> Iterator[list[bytes]]:
    run: list[bytes] = []
    held = 0
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass")
        if run and held + len(raw) > RUN_BYTES:
            yield run
            run, held = [], 0
        run.append(raw)
        held += len(raw) + 1
    if run:
        yield run


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Words are runs without ``[\\x20\\x09-\\x0D]``, A-Z lowered. A text of fewer
    words than a shingle is one shingle; one without words has none.
    """
    for run in _runs(texts):
        raw = np.frombuffer(b" ".join(run), np.uint8)
        starts, words = _word_hashes(raw)
        bounds = np.cumsum([len(r) + 1 for r in run])
        counts = np.diff(np.searchsorted(starts, bounds), prepend=0)
        made = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            made = (made ^ words[k:k + len(made)]) * _P
            made ^= made >> np.uint64(32)
        made = mix(made)
        at = 0
        for n in counts.tolist():
            if n >= SHINGLE:
                found = np.sort(made[at:at + n - SHINGLE + 1])
                keep = np.ones(len(found), bool)
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                yield found[keep]
            elif n:
                h = np.uint64(n)
                for w in words[at:at + n]:
                    h = mix(np.array([(h ^ w)]) * _P)[0]
                yield np.array([h], np.uint64)
            else:
                yield np.empty(0, np.uint64)
            at += n


def set_id(found: np.ndarray) -> int:
    """A signed 64-bit identifier of a set, from a cryptographic digest."""
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)
