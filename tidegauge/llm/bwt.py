"""Common prefixes of the suffixes of a block of strings, from its Burrows-Wheeler transform.

The boundaries between suffixes whose common prefix is shorter than a bound are found in
order of that length: starting from the interval of all suffixes, every interval of a
pattern is extended to the left by each letter; the right end of the new interval is a
boundary, and the interval goes on to the next round only if that end wasn't known yet
(Beller, Gog, Ohlebusch and Schnattinger, Computing the longest common prefix array based on
the Burrows-Wheeler transform, 2013). After ``least`` rounds the search stops: suffixes with
no boundary between them agree on ``least`` letters or more.

All arrays are as long as the block; the caller bounds the block.
"""

from __future__ import annotations

import numpy as np


def suffix_order(letters: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` letters at least, by doubling from eight letters."""
    n = len(letters)
    padded = np.concatenate([letters, np.zeros(8, letters.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : n + k]
    known = 8
    while True:
        order = np.argsort(key, kind="stable")
        own = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], own[1:] != own[:-1]])).astype(np.uint64)
        if known >= depth or int(rank[order[-1]]) == n:
            return order
        after = np.zeros(n, np.uint64)
        after[: max(0, n - known)] = rank[known:]
        key = rank << np.uint64(32) | after
        known *= 2


def boundaries(letters: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """True at i if the suffixes order[i - 1] and order[i] are known to agree on less than ``least`` letters.

    Letter 0 ends a string and is never part of a pattern: a boundary that only a 0 makes stays unknown.
    """
    n = len(letters)
    before = letters[order - 1]  # the transform; the first suffix follows the last letter, which is 0
    places, first = {}, {}
    total = np.concatenate([[0], np.cumsum(np.bincount(letters, minlength=256))])
    for c in np.unique(letters).tolist():
        if c:
            places[c], first[c] = np.flatnonzero(before == c), int(total[c])
    step = np.zeros(n, np.int64)  # where the suffix one letter longer stands
    for c, at in places.items():
        step[at] = first[c] + np.arange(len(at))
    found = np.zeros(n + 1, bool)
    found[0] = found[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        single = high - low == 1
        at = low[single]
        at = at[before[at] != 0]
        new_low, new_high = [step[at]], [step[at] + 1]
        wide_low, wide_high = low[~single], high[~single]
        if len(wide_low):
            for c, own in places.items():
                a, b = np.searchsorted(own, wide_low), np.searchsorted(own, wide_high)
                some = b > a
                new_low.append(first[c] + a[some])
                new_high.append(first[c] + b[some])
        low, high = np.concatenate(new_low), np.concatenate(new_high)
        fresh = ~found[high]
        # The last interval ends at n, which is no boundary between suffixes, but must go on.
        fresh |= high == n
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        found[high] = True
        turn = np.argsort(low)
        low, high = low[turn], high[turn]
    return found[:n]


def repeated(strings: list[bytes], rank: np.ndarray, least: int) -> list[np.ndarray]:
    """For each string, the starts of its substrings of ``least`` bytes that also start earlier.

    ``rank`` orders the strings (all different): of equal substrings, the one in the string
    of the smallest rank, and there the first, is the earliest.
    """
    sizes = np.array([len(s) for s in strings])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    # Bytes become letters from 1 on; a block has at most 255 different ones (0xFF is no UTF-8).
    used = np.zeros(256, bool)
    inside = np.ones(len(raw), bool)
    inside[ends - 1] = False
    used[raw[inside]] = True
    code = np.cumsum(used).astype(np.uint8)
    letters = np.where(inside, code[raw], 0).astype(np.uint8)
    order = suffix_order(letters, least)
    group = np.cumsum(boundaries(letters, order, least))
    string = np.searchsorted(ends, order, side="right")
    valid = order + least <= ends[string] - 1
    order, group, string = order[valid], group[valid], string[valid]
    offset = order - starts[string]
    turn = np.lexsort((offset, rank[string], group))
    group, string, offset = group[turn], string[turn], offset[turn]
    later = np.concatenate([[False], group[1:] == group[:-1]]) if len(group) else np.zeros(0, bool)
    string, offset = string[later], offset[later]
    turn = np.lexsort((offset, string))
    string, offset = string[turn], offset[turn]
    cut = np.searchsorted(string, np.arange(len(strings) + 1))
    return [offset[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
