"""Suffix arrays by induced sorting, in whole-array steps."""

from __future__ import annotations

import numpy as np

from snapline.llm.arrays import hash_words


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S); the last is larger than the empty suffix."""
    n = len(t)
    change = np.append(np.flatnonzero(t[1:] != t[:-1]), n - 1)
    end = change[np.searchsorted(change, np.arange(n))]
    after = np.minimum(end + 1, n - 1)
    return (end + 1 < n) & (t[end] < t[after])


def _ranks(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by group, and each element's number within its group, in that order."""
    order = np.argsort(groups, kind="stable")
    own = groups[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, int)
    return order, np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, alphabet: int) -> np.ndarray:
    """The suffix array that leftmost-smaller suffixes in the order ``lms`` induce.

    Buckets are filled a run of entries at a time: all entries of a bucket known so far place
    their predecessors at once, in order, which is what the scan entry by entry would do.
    """
    n = len(t)
    size = np.bincount(t, minlength=alphabet)
    stop = np.cumsum(size)
    start = stop - size
    sa = np.full(n, -1, dtype=np.int64)
    order, rank = _ranks(t[lms])
    seeds = lms[order]
    seeded = np.bincount(t[lms], minlength=alphabet)
    sa[stop[t[seeds]] - seeded[t[seeds]] + rank] = seeds
    head = start.copy()

    def larger(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[~small[before]]
        order, rank = _ranks(t[before])
        before = before[order]
        c = t[before]
        sa[head[c] + rank] = before
        head[:] += np.bincount(c, minlength=alphabet)

    larger(np.array([n]))
    used = np.flatnonzero(size)
    for c in used:
        low = start[c]
        while low < head[c]:
            low, entries = head[c], sa[low : head[c]]
            larger(entries)
        if seeded[c]:
            larger(sa[stop[c] - seeded[c] : stop[c]])
    tail = stop.copy()

    def smaller(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[small[before]]
        order, rank = _ranks(t[before])
        before = before[order]
        c = t[before]
        sa[tail[c] - 1 - rank] = before
        tail[:] -= np.bincount(c, minlength=alphabet)

    for c in used[::-1]:
        high = stop[c]
        while tail[c] < high:
            high, entries = tail[c], sa[tail[c] : high][::-1]
            smaller(entries)
        smaller(sa[start[c] : head[c]][::-1])
    return sa


def _order(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of the reduced string, equal names sorted by what follows.

    Its alphabet is too large for steps by bucket; ranks of doubled length do instead, up to
    ``depth`` names, beyond which the caller does not look.
    """
    rank, reach = names, 1
    while reach < depth and rank.max() + 1 < len(rank):
        later = np.concatenate([rank[reach:] + 1, np.zeros(min(reach, len(rank)), dtype=np.int64)])
        _, rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)
        reach *= 2
    return np.argsort(rank, kind="stable")


def suffix_array(t: np.ndarray, alphabet: int, depth: int) -> np.ndarray:
    """Suffixes of ``t`` (small non-negative integers) in the order of their first ``depth`` signs."""
    t = t.astype(np.uint16)
    n = len(t)
    if not n:
        return np.zeros(0, dtype=np.int64)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        sorted_once = _induce(t, small, lms, alphabet)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        found = sorted_once[is_lms[sorted_once]]
        place = np.searchsorted(lms, found)
        end = np.append(lms[1:] + 1, n)[place]  # a leftmost-smaller substring reaches to the next one
        digest = hash_words(t.view(np.uint8), 2 * found, 2 * end)
        # The last one reaches the end, which is like no other.
        new = (digest[1:] != digest[:-1]) | (place[1:] == len(lms) - 1) | (place[:-1] == len(lms) - 1)
        names = np.empty(len(lms), dtype=np.int64)
        names[place] = np.concatenate([[0], np.cumsum(new)])
        lms = lms[_order(names, -(-depth // 2))]
    return _induce(t, small, lms, alphabet)


def permuted_prefixes(data: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """In text order: how long, up to ``limit``, a suffix and the one before it in ``sa`` agree,
    in whole steps of eight signs (``data`` must have ``limit + 8`` spare bytes at its end)."""
    n = len(sa)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data.tobytes(), strides=(1,))
    length = np.zeros(n, dtype=np.int64)
    alive = np.flatnonzero(before >= 0)
    for step in range(0, limit, 8):
        alive = alive[words[alive + step] == words[before[alive] + step]]
        if not len(alive):
            break
        length[alive] = step + 8
    return length
