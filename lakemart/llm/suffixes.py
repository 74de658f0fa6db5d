"""Suffix arrays by induced sorting, and permuted common prefixes, with vectorised steps.

Buckets are passed in order; what a bucket holds is induced in whole batches (a batch ends where an
entry would induce into its own bucket), so the number of steps follows the alphabet and the longest
run of one symbol, and the work the length of the text.
"""

from __future__ import annotations

import numpy as np

#: Largest alphabet whose buckets are passed one by one; names beyond it become two digits.
WIDE = 1024


def classify(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (the end of the text is smallest)."""
    n = len(text)
    step = np.empty(n, dtype=np.int8)
    step[-1] = -1
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1])
    moving = np.flatnonzero(step)
    following = np.repeat(moving, np.diff(moving, prepend=-1))  # next place that is not level
    return step[following] > 0


def _append(array, heads, texts, places, sign):
    """Put ``places`` at the heads of the buckets of their symbols, keeping their order; heads move on."""
    symbols = texts[places]
    order = np.argsort(symbols, kind="stable")
    sizes = np.bincount(symbols, minlength=len(heads))
    first = np.cumsum(sizes) - sizes
    nth = np.arange(len(places))
    if sign > 0:
        array[(heads - first)[symbols[order]] + nth] = places[order]
        heads += sizes
    else:
        array[(heads + first)[symbols[order]] - nth] = places[order]
        heads -= sizes


def induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in the order that follows from the order of the leftmost smaller ones (``seeds``)."""
    n = len(text)
    totals = np.bincount(text, minlength=alphabet)
    starts = np.cumsum(totals) - totals
    ends = starts + totals
    array = np.full(n, -1, dtype=np.int32)
    heads = starts.copy()
    seed_symbols = text[seeds]
    by_symbol = seeds[np.argsort(seed_symbols, kind="stable")]
    seed_sizes = np.bincount(seed_symbols, minlength=alphabet)
    seed_stops = np.cumsum(seed_sizes)
    used = np.flatnonzero(totals).tolist()
    if not smaller[n - 1]:
        _append(array, heads, text, np.array([n - 1]), 1)
    done = starts.copy()
    for c in used:  # larger suffixes, ascending
        while done[c] < heads[c]:
            batch = array[done[c]:heads[c]] - 1
            done[c] = heads[c]
            batch = batch[batch >= 0]
            batch = batch[~smaller[batch]]
            if len(batch):
                _append(array, heads, text, batch, 1)
        if seed_sizes[c]:
            batch = by_symbol[seed_stops[c] - seed_sizes[c]:seed_stops[c]] - 1
            _append(array, heads, text, batch, 1)
    larger_ends = heads
    tails = ends - 1
    done = tails.copy()
    for c in reversed(used):  # smaller suffixes, descending
        while done[c] > tails[c]:
            batch = array[tails[c] + 1:done[c] + 1][::-1] - 1
            done[c] = tails[c]
            batch = batch[batch >= 0]
            batch = batch[smaller[batch]]
            if len(batch):
                _append(array, tails, text, batch, -1)
        batch = array[starts[c]:larger_ends[c]][::-1] - 1
        batch = batch[batch >= 0]
        batch = batch[smaller[batch]]
        if len(batch):
            _append(array, tails, text, batch, -1)
    return array


def suffix_array(text: np.ndarray, alphabet: int, apart: bool = False, digits_left: bool = True) -> np.ndarray:
    """Starts of all suffixes of ``text`` (values below ``alphabet``) in ascending order.

    ``apart``: symbol 0 separates non-empty strings; it equals no other 0, and an earlier one is smaller.
    (The order of the suffixes that start with a separator is left open.)
    """
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    if alphabet > WIDE and digits_left:  # two digits a symbol sort as the symbols do
        base = int(np.ceil(alphabet ** 0.5))
        digits = np.empty(2 * n, dtype=np.uint16)
        digits[0::2], digits[1::2] = np.divmod(text, base)
        order = suffix_array(digits, base, digits_left=False)
        return order[order % 2 == 0] // 2
    text = text.astype(np.uint16)
    smaller = classify(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) < 2:
        return induce(text, smaller, leftmost, alphabet)
    rough = induce(text, smaller, leftmost, alphabet)
    is_leftmost = np.zeros(n, dtype=bool)
    is_leftmost[leftmost] = True
    ordered = rough[is_leftmost[rough]]
    if apart:
        ordered[:np.count_nonzero(text[ordered] == 0)].sort()
    number = np.empty(n, dtype=np.int32)
    number[leftmost] = np.arange(len(leftmost), dtype=np.int32)
    lengths = np.diff(leftmost, append=n) + 1  # up to and with the next leftmost place
    names = _name(text, ordered, lengths[number[ordered]], apart)
    if names[-1] + 1 == len(leftmost):
        return induce(text, smaller, ordered, alphabet)
    reduced = np.empty(len(leftmost), dtype=np.int32)
    reduced[number[ordered]] = names
    # A name that occurs once decides every comparison that reaches it, so what follows it is left
    # out of the recursion unless a repeated name stands there.
    repeated = np.bincount(names)[reduced] > 1
    kept = repeated.copy()
    kept[1:] |= repeated[:-1]
    places = np.flatnonzero(kept)
    dense = np.zeros(int(names[-1]) + 1, dtype=np.int32)
    dense[reduced[places]] = 1
    dense = np.cumsum(dense, dtype=np.int32) - 1
    inner = suffix_array(dense[reduced[places]], int(dense[-1]) + 1)
    rank = np.zeros(len(leftmost), dtype=np.int64)
    rank[places[inner]] = np.arange(len(places))
    return induce(text, smaller, leftmost[np.argsort(reduced.astype(np.int64) * (len(places) + 1) + rank)], alphabet)


def _name(text, ordered, lengths, apart) -> np.ndarray:
    """Ranks of the substrings that start at ``ordered`` (sorted); equal ones share a rank."""
    n = len(text)
    same = lengths[1:] == lengths[:-1]
    open_ = np.flatnonzero(same)
    stops = lengths[open_]
    a, b = ordered[open_], ordered[open_ + 1]
    offset = 0
    while len(open_):
        left, right = text[np.minimum(a + offset, n - 1)], text[np.minimum(b + offset, n - 1)]
        equal = (left == right) & (a + offset < n) & (b + offset < n)
        if apart:
            equal &= left != 0
        same[open_[~equal]] = False
        offset += 1
        going = equal & (stops > offset)
        open_, a, b, stops = open_[going], a[going], b[going], stops[going]
    return np.concatenate([[0], np.cumsum(~same)]).astype(np.int32)


def permuted_prefixes(text: np.ndarray, order: np.ndarray, limit: np.ndarray, apart: bool = False) -> np.ndarray:
    """By text place: length of the prefix shared with the next smaller suffix, at most ``limit``.

    Where the symbols before both suffixes agree, the value is one less than that of the place
    before; only the other places are compared symbol by symbol.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    place = np.arange(n, dtype=np.int32)
    follows = (before > 0) & (place > 0)
    follows[follows] = text[place[follows] - 1] == text[before[follows] - 1]
    if apart:
        follows[1:] &= text[:-1] != 0
    fresh = ~follows
    value = np.zeros(n, dtype=np.int32)
    open_ = np.flatnonzero(fresh & (before >= 0))
    other = before[open_]
    # How far both suffixes reach at most.
    reach = np.minimum(np.minimum(limit[open_], limit[other]), n - np.maximum(open_, other))
    offset = 0
    while len(open_):
        equal = reach > offset
        equal[equal] = text[open_[equal] + offset] == text[other[equal] + offset]
        value[open_[~equal]] = offset
        open_, other, reach = open_[equal], other[equal], reach[equal]
        offset += 1
    last = np.maximum.accumulate(np.where(fresh, place, 0))
    return np.maximum(value[last] - (place - last), 0)
