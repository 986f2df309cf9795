"""Suffix arrays by induced sorting, as array programs.

``suffix_array`` classifies suffixes as L or S, sorts the substrings between
leftmost S suffixes (LMS) by inducing from their first characters, names them,
sorts the string of names, and induces the whole array from it.  Inducing
walks the character buckets once up and once down; within a bucket all
suffixes found so far induce together.  A string of names with a small
alphabet is sorted the same way; with a large one (mostly distinct names, so
few ties) by doubling ranks.
"""

from __future__ import annotations

import numpy as np

SMALL_ALPHABET = 4096


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffix array of ``s``, whose last symbol 0 stands nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    # S suffixes: smaller than the suffix after them
    is_s = np.empty(n, bool)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1])
    step[-1] = 1
    ahead = np.where(step != 0, np.arange(n), n)
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]
    is_s = step[ahead] > 0
    lms_flag = is_s.copy()
    lms_flag[1:] &= ~is_s[:-1]
    lms_flag[0] = False
    lms = np.flatnonzero(lms_flag).astype(np.int32)
    size = np.bincount(s, minlength=alphabet)
    end = np.cumsum(size)
    sorted_lms = _lms_of(_induce(s, is_s, lms, size, end), lms_flag)
    names, distinct = _names(s, lms, sorted_lms)
    if distinct == len(lms):
        order = np.empty(len(lms), np.int32)
        order[names] = np.arange(len(lms), dtype=np.int32)
    elif distinct <= SMALL_ALPHABET:
        order = suffix_array(names, distinct)
    else:
        order = _by_doubling(names)
    return _induce(s, is_s, lms[order], size, end)


def _lms_of(sa: np.ndarray, lms_flag: np.ndarray) -> np.ndarray:
    return sa[lms_flag[sa]]


def _put(sa, ptr, chars, values, direction):
    """Append values to their characters' buckets, in order."""
    order = np.argsort(chars, kind="stable")
    chars, values = chars[order], values[order]
    head = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]])
    count = np.diff(np.r_[head, len(chars)])
    rank = np.arange(len(chars)) - np.repeat(head, count)
    if direction > 0:
        sa[ptr[chars] + rank] = values
        ptr[chars[head]] += count
    else:
        sa[ptr[chars] - 1 - rank] = values
        ptr[chars[head]] -= count


def _induce(s, is_s, lms, size, end):
    """Induce the array from LMS suffixes in order: L suffixes going up the
    buckets, then S suffixes going down."""
    n, start = len(s), end - size
    sa = np.full(n, -1, np.int32)
    first = s[lms]
    order = np.argsort(first, kind="stable")
    by_char, grouped = lms[order], first[order]
    lms_at = np.searchsorted(grouped, np.arange(len(size) + 1))
    key = s.astype(np.uint16) if len(size) <= 65536 else s
    ptr = start.copy()

    def induce(cur, want_s, direction):
        cur = cur[cur > 0]
        prev = cur - 1
        prev = prev[is_s[prev] == want_s]
        if len(prev):
            _put(sa, ptr, key[prev], prev, direction)

    used = np.flatnonzero(size)
    for c in used.tolist():
        done = int(start[c])
        while done < ptr[c]:
            cur = sa[done:ptr[c]]
            done = int(ptr[c])
            induce(cur, False, 1)
        a, b = lms_at[c], lms_at[c + 1]
        if b > a:
            induce(by_char[a:b], False, 1)
    l_end = ptr
    ptr = end.copy()
    for c in used[::-1].tolist():
        done = int(end[c])
        if c == 0:  # the last symbol alone
            sa[0] = n - 1
            continue
        while done > ptr[c]:
            cur = sa[ptr[c]:done][::-1]
            done = int(ptr[c])
            induce(cur, True, -1)
        cur = sa[start[c]:l_end[c]][::-1]
        if len(cur):
            induce(cur, True, -1)
    return sa


def _names(s, lms, sorted_lms):
    """Names of the LMS substrings in text order: equal ones share a name."""
    m = len(lms)
    length = np.ones(len(s), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1  # up to and with the next LMS character
    a, b = sorted_lms[:-1].astype(np.int64), sorted_lms[1:].astype(np.int64)
    same = length[a] == length[b]
    at = np.flatnonzero(same)
    k = 0
    while len(at):  # compare symbol by symbol; pairs that differ leave
        # equal symbols up to the closing S have equal types
        equal = s[a[at] + k] == s[b[at] + k]
        same[at[~equal]] = False
        k += 1
        at = at[equal & (k < length[a[at]])]
    name = np.r_[0, np.cumsum(~same)]
    out = np.empty(len(s), np.int32)
    out[sorted_lms] = name
    return out[lms], int(name[-1]) + 1 if m else 0


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string of names; a rank is its group's first place,
    and only suffixes that still tie are sorted again."""
    n, depth = len(names), 1
    size = np.bincount(names)
    rank = (np.cumsum(size) - size)[names].astype(np.int64)
    tied = np.flatnonzero(size[names] > 1)
    while len(tied):
        ahead = tied + depth
        key = rank[tied] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key)
        key, tied = key[order], tied[order]
        old = rank[tied]
        at = np.arange(len(tied))
        new_head = np.r_[True, key[1:] != key[:-1]]
        old_head = np.r_[True, old[1:] != old[:-1]]
        rank[tied] = old + np.maximum.accumulate(np.where(new_head, at, 0)) - np.maximum.accumulate(np.where(old_head, at, 0))
        alone = new_head & np.r_[new_head[1:], True]
        tied = tied[~alone]
        depth *= 2
    out = np.empty(n, np.int32)
    out[rank] = np.arange(n, dtype=np.int32)
    return out


def permuted_common_prefixes(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For the positions in ``order`` (a suffix array, or the part of one at
    some positions), in text order: the symbols that the suffix shares with the
    one before it in ``order``; -1 for the first and for other positions.

    A position whose predecessor follows that of its own left neighbour shares
    one symbol less than this neighbour, if that shared any: only the other
    (irreducible) positions are compared, four symbols a step."""
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[order[1:]] = order[:-1]
    known = phi >= 0
    reducible = np.zeros(n, bool)
    reducible[1:] = known[1:] & known[:-1] & (phi[1:] == phi[:-1] + 1) & (s[:-1] == s[phi[:-1]])
    todo = np.flatnonzero(known & ~reducible)
    shared = np.zeros(n, np.int64)
    # symbols past the end differ from all others and from each other's
    symbols = np.r_[s, 65535 - np.arange(4)].astype("<u2")
    words = np.ndarray(n, "<u8", symbols, 0, (2,))
    at, k = todo, 0
    while len(at):
        x, y = at + k, phi[at] + k
        equal = words[x] == words[y]
        done = at[~equal]
        i, j, more = done + k, phi[done] + k, np.ones(len(done), bool)
        shared[done] = k
        for m in range(3):
            more &= symbols[i + m] == symbols[j + m]
            shared[done] += more
        at, k = at[equal], k + 4
    head = np.maximum.accumulate(np.where(known & ~reducible, np.arange(n), 0))
    out = np.where(known, np.maximum(shared[head] - (np.arange(n) - head), 0), -1)
    return out
