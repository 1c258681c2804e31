"""Suffixes of a block of text, sorted with a difference cover.

Positions whose remainder is in the cover are ranked first, by prefix doubling
over the cover's period. Other suffixes are compared on their first bytes; for
any two places there is a distance below the period at which both are in the
cover, so a long tie is settled by two ranks and never by reading on.
"""

from __future__ import annotations

import numpy as np

#: A perfect difference set, every remainder is a difference of two members.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
_WORDS = 4  # of eight bytes, at least the period


def _distances() -> np.ndarray:
    """For two remainders, the smallest distance that takes both into the cover."""
    inside = np.zeros(PERIOD, bool)
    inside[list(COVER)] = True
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(d for d in range(PERIOD) if inside[(a + d) % PERIOD] and inside[(b + d) % PERIOD])
    return table


_DISTANCE = _distances().ravel()


def all_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as numbers whose order is that of the bytes."""
    return np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(">u8").ravel().astype(np.uint64)


def _dense(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Ranks from 1 by sorted order, ``new`` telling where a value differs from the one before."""
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def cover_ranks(words: np.ndarray, n: int) -> np.ndarray:
    """Rank of each cover place among the suffixes of the first ``n`` bytes; 0 elsewhere.

    Doubling ends when all ranks differ, so ranks are those of whole suffixes
    and comparisons by them agree with each other.
    """
    places = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    ranks = np.zeros(n + PERIOD, np.int64)
    # of suffixes that end within the words, the shorter one is first
    keys = [*(words[places + 8 * k] for k in range(_WORDS)), np.minimum(n - places, 8 * _WORDS)]
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    ranks[places] = _dense(order, new)
    reach = PERIOD
    while not new.all():
        pair = ranks[places] * (len(places) + 2) + ranks[np.minimum(places + reach, len(ranks) - 1)]
        order = np.argsort(pair, kind="stable")
        new[1:] = pair[order[1:]] != pair[order[:-1]]
        ranks[places] = _dense(order, new)
        reach *= 2
    return ranks


def _before(ranks: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether suffix a is before suffix b, both equal in their first bytes."""
    d = _DISTANCE[(a % PERIOD) * PERIOD + b % PERIOD]
    return ranks[a + d] < ranks[b + d]


def _merge_ties(order: np.ndarray, group: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Sort within runs of equal ``group`` by merging: all groups and runs of a width at once."""
    n = len(order)
    first = np.ones(n, bool)
    first[1:] = group[1:] != group[:-1]
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    ends = np.append(np.flatnonzero(first)[1:], n)
    size = (ends - np.flatnonzero(first))[np.cumsum(first) - 1]
    width = 1
    while True:
        at = np.flatnonzero(size > width)
        if not len(at):
            return order
        inside = at - begin[at]
        run = inside // width
        other = run ^ 1
        low = np.minimum(other * width, size[at])
        high = np.minimum(low + width, size[at])
        base, odd, own = begin[at], (run & 1).astype(bool), order[at]
        start = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            there = order[base[open_] + middle]
            # earlier runs stay in front of equal suffixes of later ones
            ahead = np.where(odd[open_], ~_before(ranks, own[open_], there), _before(ranks, there, own[open_]))
            low[open_[ahead]] = middle[ahead] + 1
            high[open_[~ahead]] = middle[~ahead]
        moved = order.copy()
        moved[base + (run >> 1) * 2 * width + (inside - run * width) + (low - start)] = own
        order = moved
        width *= 2


def repeated(data: np.ndarray, places: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """For each place, whether its next ``length`` bytes also start at another place of its bucket.

    ``data`` ends in at least ``length`` spare bytes. Places of a bucket are
    sorted as suffixes; equal strings are neighbours then.
    """
    if not len(places):
        return np.zeros(0, bool)
    words = all_words(data)
    keys = [words[places + 8 * k] for k in range(_WORDS)]
    by = np.lexsort([*keys[::-1], bucket])
    new = np.ones(len(by), bool)
    new[1:] = np.any([bucket[by[1:]] != bucket[by[:-1]], *[k[by[1:]] != k[by[:-1]] for k in keys]], axis=0)
    del keys
    tied = ~new | np.append(~new[1:], False)
    flagged = np.zeros(len(places), bool)
    if not tied.any():
        return flagged
    by, group = by[tied], np.cumsum(new)[tied]
    # suffixes are settled by place, so remember which entry a place was
    slot = np.argsort(places[by], kind="stable")
    merged = _merge_ties(places[by].copy(), group, cover_ranks(words, len(data) - length))
    entry = by[slot[np.searchsorted(places[by][slot], merged)]]
    a, b = merged[:-1], merged[1:]
    same = group[1:] == group[:-1]
    for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        left = np.flatnonzero(same)
        same[left] = words[a[left] + offset] == words[b[left] + offset]
    flagged[entry[:-1][same]] = True
    flagged[entry[1:][same]] = True
    return flagged
