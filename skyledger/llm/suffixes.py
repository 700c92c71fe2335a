"""Groups of equal substrings of one bucket of segments: suffix array, BWT, interval expansion.

``repeat_groups`` sorts the suffixes of a few megabytes of segments, forms their
Burrows-Wheeler transform, and finds common prefixes by increasing length: all intervals
of strings of length l are extended backwards by every character that precedes them, and
the right end of each new interval is a place where neighbouring suffixes share exactly l
characters. The expansion stops at the wanted length; places it has not reached share at
least that much. Each segment ends in an end mark of its own, so nothing spans segments.
"""

from __future__ import annotations

import numpy as np

OPEN = np.iinfo(np.uint16).max


def suffix_order(codes: np.ndarray, left: np.ndarray, longest: int) -> np.ndarray:
    """Places of all suffixes in order. ``codes``: 0 is an end mark; ``left``: characters up to it.

    Prefix doubling from the first eight characters on; only suffixes that are still tied are
    sorted again. Equal suffixes stay in order of place, as if end marks grew with the place.
    """
    n = len(codes)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        part = np.zeros(n, np.uint64)
        part[: max(0, n - k)] = codes[k:]
        part[left < k] = 0
        key = (key << np.uint64(8)) | part
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.append(True, sorted_key[1:] != sorted_key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
    step = 8
    while step <= longest:
        tied = ~head
        tied[:-1] |= ~head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        sub = order[slots]
        inside = left[sub] > step
        second = np.zeros(len(sub), np.int64)
        second[inside] = rank[sub[inside] + step]
        pair = (rank[sub] << 32) | second
        turn = np.argsort(pair, kind="stable")
        pair, sub = pair[turn], sub[turn]
        order[slots] = sub
        fresh = np.append(True, pair[1:] != pair[:-1])
        head[slots] = fresh
        rank[sub] = np.maximum.accumulate(np.where(fresh, slots, 0)) + 1
        step *= 2
    return order


class Wavelet:
    """Bit planes of a sequence, for the distinct characters of many intervals at once."""

    def __init__(self, values: np.ndarray, bits: int):
        self.zeros, self.before, self.bits = [], [], bits
        now = values
        for b in range(bits - 1, -1, -1):
            one = (now >> b) & 1
            count = np.zeros(len(now) + 1, np.int32)
            np.cumsum(one == 0, out=count[1:])
            self.before.append(count)
            self.zeros.append(int(count[-1]))
            now = np.concatenate((now[one == 0], now[one == 1]))
        firsts = np.flatnonzero(np.append(True, now[1:] != now[:-1]))
        self.start = np.zeros(1 << bits, np.int64)
        self.start[now[firsts]] = firsts

    def split(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(character, rank of its first, rank after its last) of every character of every interval."""
        char = np.zeros(len(low), np.int64)
        for count, zeros in zip(self.before, self.zeros):
            low0, high0 = count[low].astype(np.int64), count[high].astype(np.int64)
            low1, high1 = low - low0 + zeros, high - high0 + zeros
            has0, has1 = high0 > low0, high1 > low1
            char = np.concatenate((char[has0] << 1, (char[has1] << 1) | 1))
            low = np.concatenate((low0[has0], low1[has1]))
            high = np.concatenate((high0[has0], high1[has1]))
        return char, low - self.start[char], high - self.start[char]


def common_prefixes(bwt: np.ndarray, marks: int, length: int) -> np.ndarray:
    """Shared characters of neighbouring suffixes where fewer than ``length``, OPEN elsewhere."""
    n = len(bwt)
    lcp = np.full(n + 1, OPEN, np.uint16)
    lcp[: marks + 1] = 0
    lcp[n] = 0
    counts = np.bincount(bwt, minlength=256)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    back = np.empty(n, np.int64)
    back[np.argsort(bwt, kind="stable")] = np.arange(n)
    planes = Wavelet(bwt, max(1, int(bwt.max()).bit_length()))
    low, high = np.array([0]), np.array([n])
    for shared in range(length):
        one = high - low == 1
        single = low[one]
        single = back[single[bwt[single] > 0]]
        char, begin, end = planes.split(low[~one], high[~one])
        char, begin, end = char[char > 0], begin[char > 0], end[char > 0]
        low = np.concatenate((single, first[char] + begin))
        high = np.concatenate((single + 1, first[char] + end))
        new = lcp[high] == OPEN
        low, high = low[new], high[new]
        lcp[high] = shared
        if shared == 0:  # the end marks are strings of one character each
            low = np.concatenate((low, np.arange(marks)))
            high = np.concatenate((high, np.arange(marks) + 1))
        if not len(low):
            break
    return lcp[:n]


def smallest_owner(segments: list[bytes], owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every place of every segment the smallest owner of a segment with its ``length``
    bytes, over the segments one after another with an end mark each; and their starts."""
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    ends = starts + sizes
    mark = np.zeros(len(text), bool)
    mark[ends] = True
    used = np.flatnonzero(np.bincount(text[~mark], minlength=256))
    to = np.zeros(256, np.uint8)
    # Every byte gets a code above the end mark. UTF-8 has fewer than 255 different bytes.
    to[used] = np.arange(1, len(used) + 1)
    codes = to[text]
    codes[mark] = 0
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    left = ends[owner] - np.arange(len(text))
    order = suffix_order(codes, left, int(sizes.max()) + 1)
    bwt = codes[order - 1]  # before the first place stands the last end mark
    lcp = common_prefixes(bwt, len(segments), length)
    heads = np.flatnonzero(lcp != OPEN)
    least = np.minimum.reduceat(owners[owner[order]], heads)
    found = np.empty(len(text), np.int64)
    found[order] = np.repeat(least, np.diff(np.append(heads, len(text))))
    return found, starts
