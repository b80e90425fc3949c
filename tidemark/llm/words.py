"""Hashes of all words of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Bytes of text that are hashed at once; more only where a single word is longer.
BLOCK = 1 << 20
#: Masks of the first so many bytes of eight.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: ASCII that belongs to no word of letters; bytes from 128 up do.
NON_LETTERS = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def _mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one map of 64-bit numbers that lets every bit reach every other."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def hashes(data: np.ndarray, gaps: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of each run of bytes that aren't gaps. The hash depends on the bytes of the run alone.

    Runs of at most 8 bytes are mapped one to one, of at most 16 by two mixed halves, longer ones by XXH64.
    After all runs come, for each length of prefixes, the first so many bytes of the runs that are longer.
    """
    inside = ~gaps[data]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if prefixes:
        longer = [starts[ends - starts > n] for n in prefixes]
        ends = np.concatenate([ends, *(x + n for x, n in zip(longer, prefixes, strict=True))])
        starts = np.concatenate([starts, *longer])
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    size = ends - starts
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded, (len(data) + 9, 8), (1, 1), writeable=False)
    h = eight[starts].view("<u8")[:, 0] & _FIRST[np.minimum(size, 8)]
    h = _mixed(h ^ (size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    more = np.flatnonzero(size > 8)
    second = eight[starts[more] + 8].view("<u8")[:, 0] & _FIRST[np.minimum(size[more] - 8, 8)]
    h[more] = _mixed(h[more] + second * np.uint64(0xD6E8FEB86659FD93))
    most = np.flatnonzero(size > 16)
    if len(most):
        raw = data.data
        h[most] = [xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(starts[most].tolist(), ends[most].tolist(), strict=True)]
    return starts, h


def blocks(texts: list[bytes], gap: bytes = b" ") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of the texts side by side: (bytes, number of the text that a piece comes from, where the piece starts).

    A text is cut only after white space, so that words stay whole.
    """
    held, owners, starts, size = [], [], [], 0
    for n, text in enumerate(texts):
        at = 0
        while at < len(text):
            to = len(text)
            if to - at > BLOCK:
                to = max(text.rfind(b" ", at, at + BLOCK), text.rfind(b"\n", at, at + BLOCK)) + 1
                if to <= at:
                    found = [x for x in (text.find(b" ", at + BLOCK), text.find(b"\n", at + BLOCK)) if x >= 0]
                    to = min(found) + 1 if found else len(text)
            if size and size + to - at + 1 > BLOCK:
                yield np.frombuffer(gap.join(held), np.uint8), np.array(owners), np.array(starts)
                held, owners, starts, size = [], [], [], 0
            held.append(text[at:to])
            owners.append(n)
            starts.append(size)
            size += to - at + len(gap)
            at = to
    if held:
        yield np.frombuffer(gap.join(held), np.uint8), np.array(owners), np.array(starts)


def word_hashes(texts: list[bytes], gaps: np.ndarray, prefixes: tuple[int, ...] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, hash) of all words, in the order of the texts, a block at a time; in each block, prefixes follow."""
    for data, owners, starts in blocks(texts):
        at, h = hashes(data, gaps, prefixes)
        yield owners[np.searchsorted(starts, at, side="right") - 1], h
