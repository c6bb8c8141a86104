"""Vectorised word and shingle hashing for whole Arrow batches of texts.

A batch is decoded once into a code-point array; word boundaries, 64-bit word
hashes and shingle hashes come from array operations, so no Python loop runs
per word.  Words are the longest runs of letters and digits of the lower-cased
text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_THIRD = np.uint64(0x165667B19E3779F9)
#: Number of code points Unicode can hold.
_CODE_SPACE = 0x110000
#: Characters turned into arrays at once; longer texts go block by block.
BLOCK_CHARS = 1 << 21


@lru_cache(maxsize=1)
def _word_table() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(_CODE_SPACE)), bool, _CODE_SPACE)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(32))
        values = values * _SECOND
        values = values ^ (values >> np.uint64(29))
        values = values * _THIRD
        return values ^ (values >> np.uint64(32))


def powers(count: int) -> np.ndarray:
    """Ascending powers of the multiplier, modulo 2**64."""
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(count - 1, 0), _MULTIPLIER)]))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, each followed by a line end, and the place after each text's line end."""
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))


def words_in(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and 64-bit hash of each word among code points of lower-cased text."""
    inside = _word_table()[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lengths = ends - starts
    held = np.flatnonzero(inside)
    first = np.cumsum(lengths) - lengths
    within = np.arange(len(held)) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        terms = (codes[held].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[within]
        sums = np.add.reduceat(terms, first)
        return starts, lengths, mix(sums + lengths.astype(np.uint64) * _SECOND)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the word offsets of each text.

    A null text has no words.  The second array has one entry more than there
    are texts: words ``offsets[i]:offsets[i + 1]`` belong to text ``i``.
    """
    lowered = [(t or "").lower() for t in texts]
    if sum(map(len, lowered)) > BLOCK_CHARS and (len(lowered) > 1 or len(lowered[0]) > BLOCK_CHARS):
        return _word_hashes_in_blocks(lowered)
    codes, bounds = code_points(lowered)
    starts, _, hashes = words_in(codes)
    return hashes, np.concatenate([[0], np.searchsorted(starts, bounds)]).astype(np.int64)


def _word_hashes_in_blocks(lowered: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same for very long texts, block by block; a block ends where no word does."""
    parts, counts = [], []
    for text in lowered:
        start = count = 0
        while start < len(text):
            end = min(len(text), start + BLOCK_CHARS)
            while end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
                end += 1
            _, _, hashes = words_in(code_points([text[start:end]])[0])
            parts.append(hashes)
            count += len(hashes)
            start = end
        counts.append(count)
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return hashes, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words and its text's number, runs never crossing texts."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    with np.errstate(over="ignore"):
        total = words[:count].copy()
        for i in range(1, width):
            total = total * _MULTIPLIER + words[i : i + count]
    keep = owner[:count] == owner[width - 1 : width - 1 + count]
    return mix(total[keep]), owner[:count][keep]


def shingle_sets(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, the set offsets, and the word counts."""
    words, offsets = word_hashes(texts)
    hashes, owner = shingle_hashes(words, offsets, width)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    return hashes, ends, np.diff(offsets)
