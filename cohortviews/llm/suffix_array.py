"""Suffix arrays by induced sorting, in numpy: whole buckets are induced at a time.

Suffixes are classified as smaller (S) or larger (L) than their successor; the leftmost S of each stretch start the
substrings that are sorted first, by inducing them from their first characters. Their names form a shorter text, sorted
by naming pairs of names again and again. From its order one pass over the buckets upwards induces the L suffixes and one
downwards the S suffixes. Permuted common prefixes are measured in text order against each suffix's predecessor.

Orders are only needed up to ``depth`` characters; suffixes alike for longer may come in any order.
"""

from __future__ import annotations

import numpy as np


def classify(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one; the last suffix counts as such."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int32)))
    at = np.where(step != 0, np.arange(n - 1), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]  # where the stretch of equal characters ends
    small = np.ones(n, bool)
    small[:-1] = np.where(nxt < n, step[np.minimum(nxt, n - 2)] > 0, False)
    return small


def _place(sa: np.ndarray, slots: np.ndarray, who: np.ndarray, text: np.ndarray, step: int) -> None:
    """Append suffixes to their buckets in the given order, upwards from heads or downwards from tails."""
    first = text[who]
    order = np.argsort(first, kind="stable")
    chars = first[order]
    counts = np.bincount(first, minlength=len(slots))
    before = np.cumsum(counts) - counts
    sa[slots[chars] + step * (np.arange(len(who)) - before[chars])] = who[order]
    slots += step * counts


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Suffix array from the leftmost-smaller suffixes in order (or substrings, if only their first characters are)."""
    n, letters = len(text), len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(n, -1, np.int32)
    seed_ends = np.cumsum(np.bincount(text[seeds], minlength=letters))
    seeds = seeds[np.argsort(text[seeds], kind="stable")]
    seed_starts = np.concatenate([[0], seed_ends[:-1]])
    heads = starts.copy()
    for c in range(letters):
        if not counts[c]:
            continue
        done = starts[c]
        while done < heads[c]:
            front = sa[done : heads[c]]
            done = heads[c]
            before = front[front > 0] - 1
            before = before[~small[before]]
            if len(before):
                _place(sa, heads, before, text, 1)
        front = seeds[seed_starts[c] : seed_ends[c]]
        before = front[front > 0] - 1
        if len(before):
            _place(sa, heads, before[~small[before]], text, 1)
    tails = ends - 1
    for c in reversed(range(letters)):
        if not counts[c]:
            continue
        done = ends[c] - 1
        if c == 0:  # the end mark is the one suffix that nothing induces
            sa[0] = n - 1
            tails[0] = -1
            done = 0
            front = sa[:1]
            before = front - 1
            before = before[(before >= 0) & small[np.maximum(before, 0)]]
            continue
        while done > tails[c]:
            front = sa[tails[c] + 1 : done + 1][::-1]
            done = tails[c]
            before = front[front > 0] - 1
            before = before[small[before]]
            if len(before):
                _place(sa, tails, before, text, -1)
        front = sa[starts[c] : heads[c]][::-1]
        before = front[front > 0] - 1
        before = before[small[before]]
        if len(before):
            _place(sa, tails, before, text, -1)
    return sa


def _names(text: np.ndarray, sorted_at: np.ndarray, until: np.ndarray) -> np.ndarray:
    """For substrings in order the number of different ones up to each. ``until``: where each one ends, inclusive."""
    a, b = sorted_at[:-1], sorted_at[1:]
    same = until[a] - a == until[b] - b
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        i, j = a[left] + k, b[left] + k
        equal = text[i] == text[j]
        same[left[~equal]] = False
        left = left[equal & (i < until[a[left]])]
        k += 1
    return np.concatenate([[0], np.cumsum(~same)])


def _reduced(names: np.ndarray, reach: int, depth: int) -> np.ndarray:
    """Ranks of the suffixes of ``names`` by their first ``depth`` / 2 names at least: pairs are named again."""
    if reach * 2 >= 2 * depth or names.max() == len(names) - 1:
        return names
    second = np.full(len(names), -1, np.int64)
    second[:-reach] = names[reach:] if reach < len(names) else second[:-reach]
    key = names.astype(np.int64) * (len(names) + 1) + second + 1
    order = np.argsort(key, kind="stable")
    fresh = np.empty(len(names), np.int64)
    fresh[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
    return _reduced(fresh, 2 * reach, depth)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``text`` by their first ``depth`` characters. Its last character must be 0, and no other."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    counts = np.bincount(text)
    small = classify(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    rough = induce(text, small, leftmost, counts)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    ordered = rough[is_leftmost[rough]]
    until = np.zeros(n, np.int64)
    until[leftmost] = np.append(leftmost[1:], n - 1)
    names = np.empty(n, np.int64)
    names[ordered] = _names(text, ordered, until)
    ranks = _reduced(names[leftmost], 1, depth)
    return induce(text, small, leftmost[np.argsort(ranks, kind="stable")], counts)


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, the first byte lowest; zeros beyond the end."""
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    out = padded[:-8].copy()
    for k in range(1, 8):
        out |= padded[k : k - 8 if k < 8 else None][: len(out)] << np.uint64(8 * k)
    return out


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """In text order, how many bytes each suffix shares with its predecessor in ``sa``, at most ``most``."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    word = words_at(text)
    out = np.zeros(n, np.int64)
    left = np.flatnonzero(before >= 0)
    k = 0
    while len(left) and k < most:
        i, j = left + k, before[left] + k
        inside = (i < n) & (j < n)
        differ = word[np.minimum(i, n - 1)] ^ word[np.minimum(j, n - 1)]
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) // 8)
        room = np.minimum(n - np.maximum(i, j), 8)
        equal = np.where(inside, np.minimum(equal, room), 0)
        out[left] += equal
        left = left[equal == 8]
        k += 8
    return np.minimum(out, most)
