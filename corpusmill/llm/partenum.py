"""PartEnum signatures of shingle sets.

Sets are grouped into size bands such that two sets alike to the threshold lie
in the same or neighbouring bands; each set gets the signatures of its own band
and of the next, so such a pair has one band in common.  In a band the hashed
domain of shingles is divided into first-level partitions and each of these
into ``PARTS`` second-level ones; for each first-level partition every choice
of ``PARTS - MISSING`` second-level ones gives a signature, the hash of the
set's shingles in them.  Two sets share a signature wherever they agree on
such a choice, which similar sets do in several partitions.

Sets of few shingles fill no partitions; they get exact signatures by single
shingles as well.

Two deviations from the textbook scheme keep it selective on texts:

* Very frequent shingles say little.  They are left out of the domain, which
  only lowers the distance of two sets, unless they make up much of a set;
  such sets get the signatures of the whole domain too.
* The number of partitions follows the band's size up to ``GROUPS``; for
  larger sets the domain is first cut to the hashed share that fills them.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

from corpusmill.llm.shingles import mix

#: Second-level partitions of a first-level one, and how many of them may differ.
PARTS, MISSING = 3, 1
#: Most first-level partitions of a band.
GROUPS = 40
#: Expected shingles in a second-level partition, and the fewest in a signature, for small and for larger bands.
SMALL_BAND, FILL_SMALL, FILL, LEAST_SMALL, LEAST = 100, 1.5, 2.0, 2, 3
#: Sets of at most so many shingles have exact signatures, as have those that can be alike to them.
EXACT = 17
#: A set with a smaller share of shingles that are not very frequent gets the signatures of the whole domain too.
RARE_SHARE = 0.6
#: Counters for shingle frequencies, and the share of documents from which a counter marks its shingles as very frequent.
SLOTS = 1 << 16
FREQUENT_SHARE = 0.01


def slot(hashes: np.ndarray) -> np.ndarray:
    """The frequency counter of each shingle."""
    return (hashes >> np.uint64(48)).astype(np.int64)


def size_bands(largest: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest size of each band, so that a pair alike to the threshold spans two at most."""
    low, high, start = [], [], 1
    while start <= largest:
        end = max(start, int(start / threshold))
        low.append(start)
        high.append(end)
        start = end + 1
    return np.array(low), np.array(high)


def signatures(
    hashes: np.ndarray, ends: np.ndarray, frequent: np.ndarray, threshold: float, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of many sets and the number of the set each belongs to.

    ``hashes[ends[i]:ends[i + 1]]`` is set ``i``, ``frequent`` marks the
    counters of very frequent shingles.  Empty sets have no signature.
    """
    sizes = np.diff(ends)
    if not len(hashes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rare = ~frequent[slot(hashes)]
    rare_count = np.bincount(owner[rare], minlength=len(sizes))
    low, high = size_bands(int(sizes.max() / threshold**2) + 2, threshold)
    band = np.searchsorted(low, sizes, "right") - 1
    value = mix(hashes + np.uint64(seed * 1000003 + 1))
    found, owners = [], []
    full = rare_count < RARE_SHARE * sizes
    for domain, keep in ((1, rare), (2, full[owner])):
        if not keep.any():
            continue
        for step in (0, 1):
            got = _band_signatures(value[keep], owner[keep], (band + step)[owner[keep]], high, domain)
            found.append(got[0])
            owners.append(got[1])
    small = _small_signatures(hashes, owner, rare, sizes, threshold, seed)
    return np.concatenate([*found, small[0]]), np.concatenate([*owners, small[1]])


def _small_signatures(hashes, owner, rare, sizes, threshold, seed):
    """Exact signatures of the sets that can be alike to one of at most ``EXACT`` shingles.

    In an order of all shingles, the very frequent ones last, two sets alike to
    the threshold have a shingle in common among the first
    ``size - ceil(threshold * size) + 1`` of each.
    """
    keep = (sizes <= EXACT / threshold)[owner]
    value, owner, rare = hashes[keep], owner[keep], rare[keep]
    value = mix(value + np.uint64(seed * 1000003 + 3))
    order = np.lexsort((value, ~rare, owner))
    value, owner = value[order], owner[order]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    held = sizes[owner]
    use = place <= held - np.ceil(threshold * held - 1e-9)
    return value[use], owner[use]


def _band_signatures(value, owner, band, high, domain):
    reach = high[band]
    small = reach < SMALL_BAND
    wanted = np.maximum(1, np.round(reach / (PARTS * np.where(small, FILL_SMALL, FILL))))
    held = np.minimum(wanted, GROUPS).astype(np.uint64)
    inside = (mix(value + np.uint64(5)) >> np.uint64(40)).astype(np.float64) < 2.0**24 * np.minimum(1, GROUPS / wanted)
    value, owner, band, held, small = value[inside], owner[inside], band[inside], held[inside], small[inside]
    if not len(value):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    spread = mix(value ^ np.uint64(0x1234567))
    group = ((spread >> np.uint64(32)) % held).astype(np.int64)
    part = ((spread & np.uint64(0xFFFFFFFF)) % np.uint64(PARTS)).astype(np.int64)
    cell = (owner * GROUPS + group) * PARTS + part
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    cells = cell[start]
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mix(value[order] + np.uint64(77)), start)
        counts = np.diff(np.concatenate([start, [len(cell)]]))
        rows, at = np.unique(cells // PARTS, return_inverse=True)
        total = np.zeros((len(rows), PARTS), np.uint64)
        count = np.zeros((len(rows), PARTS), np.int64)
        total[at, cells % PARTS] = sums
        count[at, cells % PARTS] = counts
        first = np.searchsorted(cells // PARTS, rows)
        rep = order[start[first]]
        label = mix(
            (rows % GROUPS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + band[rep].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(domain)
        )
        least = np.where(small[rep], LEAST_SMALL, LEAST)
        found, owners = [], []
        for number, choice in enumerate(combinations(range(PARTS), PARTS - MISSING)):
            use = count[:, choice].sum(1) >= least
            found.append(mix(mix(total[:, choice].sum(1, dtype=np.uint64) + label) + np.uint64(number))[use])
            owners.append((rows // GROUPS)[use])
    return np.concatenate(found), np.concatenate(owners)
