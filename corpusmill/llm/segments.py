"""Segments of word strings for an edit-distance join.

An evaluation text of ``n`` words is cut into ``k + m`` segments, ``k`` being
the edits to survive; a text within ``k`` edits of it holds at least ``m`` of
the segments unharmed.  A segment is sent as its first window of ``WINDOW``
words in an order that puts rare windows first.  A training text that holds the
segment holds the same window as the first of a run of consecutive windows, so
only windows that are first in some such run are sent from it: about
``2 / (run + 1)`` of all.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

from corpusmill.llm.shingles import mix, shingle_hashes, word_hashes

#: Words of a window.
WINDOW = 5
#: Least words of a segment, for evaluation texts of up to ``SHORT_WORDS`` words and for longer ones.
SHORT_SEGMENT, LONG_SEGMENT, SHORT_WORDS = 6, 9, 64

#: One in so many segments must be found.
NEEDED_SHARE = 4


def window_ranks(values: np.ndarray, loads: np.ndarray, frequent: int) -> np.ndarray:
    """The order in which windows are preferred: rarer counters first, then by hash; very frequent ones have the top bit."""
    held = loads[(values >> np.uint64(48)).astype(np.int64)]
    rarity = (np.log2(np.maximum(1, held)) * 4).astype(np.uint64) << np.uint64(55)
    return (mix(values + np.uint64(11)) >> np.uint64(9)) | rarity | ((held >= frequent).astype(np.uint64) << np.uint64(63))


def windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window hashes of all texts, the window offsets of each text, and the word counts."""
    words, offsets = word_hashes(texts)
    hashes, owner = shingle_hashes(words, offsets, WINDOW)
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1)), np.diff(offsets)


def evaluation_keys(values: np.ndarray, ranks: np.ndarray, words: int) -> np.ndarray:
    """The keys of ``evaluation_request``."""
    return evaluation_request(values, ranks, words)[0]


def evaluation_request(values: np.ndarray, ranks: np.ndarray, words: int) -> tuple[np.ndarray, int]:
    """The least window of each segment of one text, each once, and how many of them another text must have to be a candidate.

    Very frequent windows are left out, the most frequent first, but never as
    many as must be found; each lowers that number by one.  Whoever has enough
    of all windows so has enough of the rest.
    """
    if not len(values):
        return values, needed(0)
    pieces = max(1, words // (SHORT_SEGMENT if words <= SHORT_WORDS else LONG_SEGMENT))
    cuts = np.arange(pieces + 1) * words // pieces
    starts, lengths = cuts[:-1], np.diff(cuts) - WINDOW + 1
    at = np.minimum(starts[:, None] + np.minimum(np.arange(int(lengths.max())), lengths[:, None] - 1), len(values) - 1)
    keys, first = np.unique(values[at[np.arange(pieces), np.argmin(ranks[at], 1)]], return_index=True)
    order = ranks[at].min(1)[first]
    need = needed(len(keys))
    left_out = min(int((order >> np.uint64(63)).sum()), need - 1)
    return keys[np.sort(np.argsort(order, kind="stable")[: len(keys) - left_out])], need - left_out


def training_keys(values: np.ndarray, ranks: np.ndarray, words: int, threshold: float) -> np.ndarray:
    """All windows of one text that an evaluation text could have chosen from a segment the two share, each once."""
    # an evaluation text alike to the threshold can be short although this one is longer
    shortest = SHORT_SEGMENT if words * threshold <= SHORT_WORDS else LONG_SEGMENT
    run = shortest - WINDOW + 1
    if len(values) <= run:
        return values[[np.argmin(ranks)]] if len(values) else values
    best = np.arange(len(values) - run + 1) + np.argmin(sliding_window_view(ranks, run), 1)
    return np.unique(values[best])


def needed(keys: int) -> int:
    """How many of an evaluation text's keys another text must have to be a candidate."""
    return max(1, -(-keys // NEEDED_SHARE))


def word_distance(left: np.ndarray, right: np.ndarray, most: int) -> int | None:
    """Edit distance of two word strings by dynamic programming in a band, or None if above ``most``."""
    if abs(len(left) - len(right)) > most:
        return None
    if len(left) > len(right):
        left, right = right, left
    # equal ends cost nothing
    same = np.flatnonzero(left != right[: len(left)])
    head = int(same[0]) if len(same) else len(left)
    left, right = left[head:], right[head:]
    same = np.flatnonzero(left[::-1] != right[::-1][: len(left)])
    tail = int(same[0]) if len(same) else len(left)
    left, right = left[: len(left) - tail], right[: len(right) - tail]
    if not len(left):
        return len(right)
    width = 2 * most + 1
    far = most + 1
    # place j - i + most of a row holds the distance of the first i words to the first j
    shifts = np.arange(width)
    row = np.where(shifts >= most, shifts - most, far)
    padded = np.concatenate([np.full(most + 1, ~np.uint64(0)), right, np.full(most + 1, ~np.uint64(0))])
    for i in range(1, len(left) + 1):
        j = i - most + shifts
        inside = (j >= 0) & (j <= len(right))
        same = padded[j.clip(0, len(right)) + most] == left[i - 1]
        take = row + ~same
        drop = np.concatenate([row[1:], [far]]) + 1
        best = np.where(inside, np.minimum(take, drop), far)
        best = np.where(j == 0, i, best)
        # insertions run along the row: a running minimum of distance minus place
        row = np.minimum(np.minimum.accumulate(best - shifts) + shifts, far)
        row = np.where(inside, row, far)
        if row.min() > most:
            return None
    distance = int(row[len(right) - len(left) + most])
    return distance if distance <= most else None
