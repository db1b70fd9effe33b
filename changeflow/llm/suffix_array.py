"""Suffix arrays by induced sorting, and capped permuted common prefixes, on numpy arrays.

``suffix_array`` classifies suffixes (S if smaller than the next one, else L), sorts the leftmost S substrings by inducing
from them in any order, names them, sorts the string of names, and induces the full order from the sorted ones. Inducing is
done a bucket at a time: what a bucket holds sends its left neighbours to their buckets in one vector step, so the cost is
linear with a small factor. The string of names is sorted by the same function while its alphabet is small, else by
doubling of ranks, since buckets of one entry each give vectors nothing to do.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 1024


def classify(s: np.ndarray) -> np.ndarray:
    """True for S suffixes. Runs of equal letters take the class of their last one."""
    n = len(s)
    is_s = np.zeros(n, bool)
    if n > 1:
        change = np.flatnonzero(s[1:] != s[:-1])
        if len(change):
            smaller = s[change] < s[change + 1]
            is_s[: change[-1] + 1] = np.repeat(smaller, np.diff(np.append(-1, change)))
    return is_s


def induce(s: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in order, from leftmost S suffixes that are in order within each letter."""
    n = len(s)
    letter = s[seeds]
    cut = np.searchsorted(letter, np.arange(sigma + 1)) if len(seeds) == 0 or (np.diff(letter.astype(np.int64)) >= 0).all() else None
    if cut is None:
        seeds = seeds[np.argsort(letter, kind="stable")]
        cut = np.searchsorted(s[seeds], np.arange(sigma + 1))
    present = np.flatnonzero(np.bincount(s, minlength=sigma)).tolist()

    def send(from_: np.ndarray, want_s: bool, here: int, lists: list[list[np.ndarray]]) -> np.ndarray:
        """Left neighbours of the wanted class go to their buckets; those of this bucket are returned."""
        p = from_[from_ > 0] - 1
        p = p[is_s[p] == want_s]
        if not len(p):
            return p
        c = s[p]
        stay = c == here
        own = p[stay]
        if len(own) < len(p):
            p, c = (p[~stay], c[~stay]) if len(own) else (p, c)
            order = np.argsort(c, kind="stable")
            p, c = p[order], c[order]
            edges = np.flatnonzero(c[1:] != c[:-1]) + 1
            for part, first in zip(np.split(p, edges), c[np.append(0, edges)].tolist(), strict=True):
                lists[first].append(part)
        return own

    left: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    left[int(s[n - 1])].append(np.asarray([n - 1]))
    larger: dict[int, np.ndarray] = {}
    for c in present:
        waves, done = left[c], []
        while waves:
            part = np.concatenate(waves) if len(waves) > 1 else waves[0]
            done.append(part)
            own = send(part, False, c, left)
            waves = [own] if len(own) else []
        larger[c] = np.concatenate(done) if done else np.zeros(0, np.int64)
        if cut[c] < cut[c + 1]:
            send(seeds[cut[c] : cut[c + 1]], False, c, left)
    right: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    out: list[np.ndarray] = []
    for c in reversed(present):
        waves, done = right[c], []
        while waves:
            part = np.concatenate(waves) if len(waves) > 1 else waves[0]
            done.append(part)
            own = send(part, True, c, right)
            waves = [own] if len(own) else []
        if done:
            out.append(np.concatenate(done))
        if len(larger[c]):
            back = larger[c][::-1]
            send(back, True, c, right)
            out.append(back)
    return np.concatenate(out)[::-1]


def by_doubling(s: np.ndarray) -> np.ndarray:
    """Suffix array of a string of numbers by doubling of ranks; only suffixes that still tie are sorted again."""
    n, h = len(s), 1
    rank = s.astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_ranks = rank[order]
        start = np.flatnonzero(np.append(True, sorted_ranks[1:] != sorted_ranks[:-1]))
        size = np.diff(np.append(start, n))
        rank = np.empty(n, np.int64)
        rank[order] = np.repeat(start, size) + 1
        open_ = np.repeat(size > 1, size)
        if not open_.any() or h >= 2 * n:
            return order
        at = np.flatnonzero(open_)
        who = order[at]
        after = np.where(who + h < n, rank[np.minimum(who + h, n - 1)], 0)
        again = np.lexsort((after, rank[who]))
        order[at] = who[again]
        # ties are refined by the pair of ranks
        full = np.zeros(n, np.int64)
        full[order[at]] = after[again]
        pair = rank[order], full[order]
        new = np.append(True, (pair[0][1:] != pair[0][:-1]) | (pair[1][1:] != pair[1][:-1]))
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        h *= 2


def suffix_array(s: np.ndarray, sigma: int = 256) -> np.ndarray:
    n = len(s)
    if n < 2:
        return np.arange(n)
    is_s = classify(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if not len(lms):
        return induce(s, is_s, lms, sigma)
    rough = induce(s, is_s, lms, sigma)
    mark = np.zeros(n, bool)
    mark[lms] = True
    sorted_lms = rough[mark[rough]]
    end = np.append(lms[1:], n - 1) + 1
    place = np.empty(n, np.int64)
    place[lms] = np.arange(len(lms))
    size = (end - lms)[place[sorted_lms]]
    # neighbours in order have one name if they are equal, letter by letter; that is at most one look at each letter
    differ = size[1:] != size[:-1]
    same = np.flatnonzero(~differ)
    step = size[same]
    inside = np.arange(int(step.sum())) - np.repeat(np.cumsum(step) - step, step)
    unlike = s[np.repeat(sorted_lms[same], step) + inside] != s[np.repeat(sorted_lms[same + 1], step) + inside]
    differ[same] = np.logical_or.reduceat(unlike, np.cumsum(step) - step) if len(same) else False
    names = np.cumsum(np.append(0, differ))
    reduced = np.empty(len(lms), np.int64)
    reduced[place[sorted_lms]] = names
    if names[-1] + 1 < len(lms):
        deeper = suffix_array(reduced, int(names[-1]) + 1) if names[-1] < SMALL_ALPHABET else by_doubling(reduced)
        sorted_lms = lms[deeper]
    return induce(s, is_s, sorted_lms, sigma)


def repeated_starts(s: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """True at valid starts whose next ``length`` letters also begin at another valid start.

    Permuted common prefixes, cut at ``length``: for each valid suffix in text order, the letters it shares with the one
    before it in suffix order (``phi``), eight at a time; suffixes that differ drop out.
    """
    order = suffix_array(s)
    order = order[valid[order]]
    twice = np.zeros(len(s), bool)
    if len(order) < 2:
        return twice
    phi = np.full(len(s), -1, np.int64)
    phi[order[1:]] = order[:-1]
    text = np.concatenate([s, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(s) + 1,), "<u8", text.tobytes(), strides=(1,))
    i = np.flatnonzero(phi >= 0)
    j = phi[i]
    for k in range(0, length, 8):
        step = min(k, length - 8)
        same = eight[i + step] == eight[j + step]
        i, j = i[same], j[same]
    twice[i] = True
    twice[j] = True
    return twice
