"""Periodic runs of words by branching tandem repeats of an enhanced suffix array.

The suffixes of the words are ranked by doubling (ranks of all lengths 2^k are kept), neighbours get
their common prefix, and equal prefixes form nested intervals. In an interval of depth d two suffixes
d words apart that lie in different children start a square whose last word is the last of its run.
Only members of the smaller children are looked up, on both sides, so the work is n log n. Rotating
such a square to the left as far as it goes gives the run; squares of a multiple of the period give
the same run again and are merged. Intervals are plain arrays, there are no tree nodes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import add_columns, as_bytes

#: A run repeats its period at least so often and has at least so many words.
REPEATS, LEAST_WORDS = 4, 6
#: Words searched in one suffix array, unless one document alone has more.
BATCH_WORDS = 500_000
FIELDS = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def split_words(text: bytes | None) -> list[bytes]:
    """Words between blanks, tabs, line and page breaks; null has none."""
    return text.split() if text else []


def suffix_ranks(codes: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4, ... symbols until all suffixes differ. Equal ranks in level k mean
    2^k equal symbols. The last symbol must occur once; only suffixes that still tie are sorted again."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    ordered = codes[order]
    fresh = np.r_[True, ordered[1:] != ordered[:-1]]
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, step = [rank], 1
    tied = order[~(fresh & np.r_[fresh[1:], True])]
    while len(tied):
        key = rank[tied] * (n + 1) + rank[tied + step] + 1
        sort = np.argsort(key, kind="stable")
        tied, key = tied[sort], key[sort]
        group = rank[tied]
        place = np.arange(len(tied))
        new_group = np.r_[True, group[1:] != group[:-1]]
        fresh = np.r_[True, key[1:] != key[:-1]]
        first_place = np.maximum.accumulate(np.where(new_group, place, 0))
        rank = rank.copy()
        rank[tied] = group + np.maximum.accumulate(np.where(fresh, place, 0)) - first_place
        levels.append(rank)
        step *= 2
        tied = tied[~(fresh & np.r_[fresh[1:], True])]
    return levels


def common_prefixes(levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order; 0 for the first."""
    a, b = order[:-1].copy(), order[1:].copy()
    start = b.copy()
    for k in range(len(levels) - 1, -1, -1):
        more = np.flatnonzero(levels[k][a] == levels[k][b])
        a[more] += 1 << k
        b[more] += 1 << k
    return np.r_[0, b - start]


def lcp_intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last place and depth of every interval with a common prefix, and for each place the
    interval whose depth its common prefix is (-1: none)."""
    lefts, rights, depths = [], [], []
    owner = [-1] * len(lcp)
    stack: list[tuple[int, int, int]] = [(0, 0, -1)]
    for j, depth in enumerate(lcp.tolist()):
        if not j:
            continue
        left = j - 1
        while stack[-1][0] > depth:
            _, left, number = stack.pop()
            rights[number] = j - 1
        if stack[-1][0] < depth:
            stack.append((depth, left, len(lefts)))
            lefts.append(left)
            rights.append(-1)
            depths.append(depth)
        owner[j] = stack[-1][2]
    for _, _, number in stack[1:]:
        rights[number] = len(lcp) - 1
    return np.array(lefts, np.int64), np.array(rights, np.int64), np.array(depths, np.int64), np.array(owner, np.int64)


def branching_squares(order: np.ndarray, place: np.ndarray, lcp: np.ndarray, longest: np.ndarray):
    """(start, period) of squares whose next word breaks the period. ``longest`` bounds, per suffix, the
    words of a run that holds it: what is too deep for that, or occurs too seldom, is not tested."""
    left, right, depth, owner = lcp_intervals(lcp)
    if not len(left):
        return np.empty((0, 2), np.int64)
    splits = np.flatnonzero(owner >= 0)
    first = np.r_[left, splits]
    inside = np.r_[np.arange(len(left)), owner[splits]]
    by = np.lexsort((first, inside))
    first, inside = first[by], inside[by]
    head = np.r_[True, inside[1:] != inside[:-1]]
    stop = np.where(np.r_[head[1:], True], right[inside] + 1, np.r_[first[1:], 0])
    size = stop - first
    heads = np.flatnonzero(head)
    largest = np.maximum.reduceat(size, heads)[inside]
    is_largest = size == largest
    counted = np.cumsum(is_largest)
    earlier = counted[heads[inside]] - is_largest[heads[inside]]  # inside is dense: one head per interval
    small = ~(is_largest & (counted - earlier == 1)) & (right[inside] - left[inside] >= REPEATS - 1)
    first, stop, inside, size = first[small], stop[small], inside[small], size[small]
    which = np.repeat(np.arange(len(first)), size)
    suffix = order[np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[which]]
    fits = REPEATS * depth[inside[which]] <= longest[suffix]
    which, suffix = which[fits], suffix[fits]
    d = depth[inside[which]]
    found = []
    for other, start in ((suffix + d, suffix), (suffix - d, suffix - d)):
        known = (other >= 0) & (other < len(order))
        at = place[np.where(known, other, 0)]
        interval = inside[which]
        met = known & (at >= left[interval]) & (at <= right[interval]) & ~((at >= first[which]) & (at < stop[which]))
        found.append(np.stack([start[met], d[met]], 1))
    return np.concatenate(found)


def runs_of(codes: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """Rows (start, stop, smallest period) of all runs in ``codes``, whose last symbol occurs once."""
    levels = suffix_ranks(codes)
    place = levels[-1]
    order = np.empty(len(codes), np.int64)
    order[place] = np.arange(len(codes))
    squares = branching_squares(order, place, common_prefixes(levels, order), longest)
    start, period = squares[:, 0].copy(), squares[:, 1]
    stop = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):  # rotate to the left
        back = start - (1 << k)
        ahead = np.maximum(back, 0)
        more = (back >= 0) & (levels[k][ahead] == levels[k][ahead + period])
        start = np.where(more, back, start)
    enough = stop - start >= np.maximum(LEAST_WORDS, REPEATS * period)
    start, stop, period = start[enough], stop[enough], period[enough]
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    new = np.r_[True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])][:len(start)]
    return np.stack([start[new], stop[new], period[new]], 1)


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    starts, stops = edges[::2], edges[1::2]
    long = stops - starts >= LEAST_WORDS
    return starts[long], stops[long]


class RunSearch:
    """Runs of many word sequences at once. A run holds each of its words ``REPEATS`` times, so words
    that occur less often in their sequence, then in their stretch between such words, are taken out
    beforehand; what is left is searched in shared suffix arrays in which sequences share no symbol."""

    def __init__(self):
        self.results: dict[int, list[tuple[int, int, int]]] = {}
        self._clear()

    def _clear(self):
        self.pieces, self.total, self.base = [], 0, 0

    def add(self, number: int, words: list[bytes]) -> bool:
        """Queue a sequence; False if it cannot hold a run."""
        if len(words) < LEAST_WORDS:
            return False
        codes = {}
        for word, n in Counter(words).items():
            if n >= REPEATS:
                codes[word] = len(codes)
        if not codes:
            return False
        every = np.array([codes.get(w, -1) for w in words])
        starts, stops = _stretches(every >= 0)
        if not len(starts):
            return False
        for a, b in zip(starts.tolist(), stops.tolist()):
            self.pieces.append((number, a, every[a:b] + self.base))
            self.total += b - a
        self.base += len(codes)
        if self.total >= BATCH_WORDS:
            self.flush()
        return True

    def flush(self) -> None:
        pieces = self.pieces
        while pieces:  # until every word occurs often enough in its stretch
            lengths = np.array([len(p[2]) for p in pieces])
            codes = np.concatenate([p[2] for p in pieces])
            key = np.repeat(np.arange(len(pieces)), lengths) * (self.base + 1) + codes
            _, back, times = np.unique(key, return_inverse=True, return_counts=True)
            often = times[back] >= REPEATS
            if often.all():
                break
            cut, end = [], np.cumsum(lengths)
            for (number, start, own), stop in zip(pieces, end.tolist()):
                starts, stops = _stretches(often[stop - len(own):stop])
                cut += [(number, start + a, own[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
            pieces = cut
        if pieces:
            lengths = np.array([len(p[2]) for p in pieces])
            # A symbol of its own behind every stretch.
            text = np.concatenate([np.r_[p[2], self.base + i] for i, p in enumerate(pieces)])
            begins = np.cumsum(lengths + 1) - lengths - 1
            runs = runs_of(text, np.repeat(lengths, lengths + 1))
            owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
            for (start, stop, period), i in zip(runs.tolist(), owner.tolist()):
                number, offset, _ = pieces[i]
                first = start - int(begins[i]) + offset
                self.results.setdefault(number, []).append((first, stop - start, period))
        self._clear()


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains behind its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find_runs(docs: DataFrame, text: str = "text", key: str = "doc_id",
              words: Callable[[bytes | None, object], list[bytes]] | None = None) -> DataFrame:
    """``docs`` with ``runs`` (word number, words, smallest period; by start, then period) and ``collapsed``
    (the words left when every run keeps its first period only, one blank between them).

    A run is a stretch of consecutive words in which words a period apart are equal, that holds its
    smallest period at least four times and six words at least, and that no neighbouring word extends.
    Every text is searched whole; rows stay where they are, nothing is shuffled. Null and empty texts
    have no runs and an empty ``collapsed``; repeated rows get the same answer each; an empty frame
    gives an empty one. Columns of the two result names are replaced, others pass through. ``words``
    may split texts in another way; it sees the text and the value of ``key``.
    """
    split = words or (lambda body, _: split_words(body))

    def start():
        def work(keys: pa.Array, texts: pa.Array):
            search = RunSearch()
            rows = list(zip(keys.to_pylist(), as_bytes(texts)))
            collapsed: list[bytes | None] = []
            for i, (name, body) in enumerate(rows):
                own = split(body, name)
                collapsed.append(None if search.add(i, own) else b" ".join(own))
            search.flush()
            found = []
            for i, (name, body) in enumerate(rows):
                runs = sorted(search.results.get(i, ()), key=lambda r: (r[0], r[2]))
                if collapsed[i] is None:
                    collapsed[i] = b" ".join(collapse(split(body, name), runs))
                found.append([{"start": a, "length": b, "period": c} for a, b, c in runs])
            return found, pa.array(collapsed, pa.binary()).view(pa.string())
        return work

    return add_columns(docs, [key, text], FIELDS, start)


def periodic_words(text: bytes | None, doc_id) -> list[bytes]:
    """Words of the registered query: for one id in ten, those behind a place repeat with a period, both
    taken from the checksum of the id. A text without an id is left as it is."""
    words = split_words(text)
    n = len(words)
    if not n or doc_id is None:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


def runs_report(docs: DataFrame) -> DataFrame:
    """Digest per document: number of runs, the run with the greatest exponent (ties: smallest start, then
    period; nulls without a run), and hashes of all runs and of the collapsed words."""
    found = find_runs(docs.select("doc_id", "text"), words=periodic_words)

    def better(best, r):
        ahead = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(best.isNull() | ahead, r).otherwise(best)  # runs come by start and period

    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text_of_runs = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", F.aggregate("runs", nothing, better)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text_of_runs, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
