"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within distance d agree, on at least one of m bit groups i, up to t_i differing bits, if
the thresholds sum to d - m + 1 (-1: the group is not probed). Correlated bits share a group, so the
groups are as independent as possible; each fingerprint gets the thresholds that promise the fewest
candidates, by dynamic programming over counts of group values. Probes enumerate the values within
t_i, meet stored values in an equi-join, and the whole distance decides.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.common import add_columns, as_bytes, store
from lakemart.llm.components import connected_components

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Shingles hashed at once; bounds the memory of one very long text.
CHUNK = 1 << 16
#: Fingerprints from which the grouping of bits is chosen (a documented bound; it affects speed only).
SAMPLE = 20_000
#: Low bits of a group's value that its count table tells apart.
TABLE_BITS = 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the shingle hashes; 0 without words."""
    words = text.lower().split() if text else []
    n = max(1, len(words) - shingle + 1) if words else 0
    ones = np.zeros(BITS, dtype=np.int64)
    for low in range(0, n, CHUNK):
        part = words[low:low + CHUNK + shingle - 1]
        line = b" ".join(part)
        lengths = np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1
        stops = np.cumsum(lengths) - 1
        starts = stops - lengths + 1
        take = min(CHUNK, n - low)
        width = min(shingle, len(part))
        hashes = np.array(
            [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[:take].tolist(), stops[width - 1:].tolist())],
            dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little") if n else 0


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint as a signed 64-bit number. Null text has fingerprint 0."""
    def start():
        return lambda texts: [[_signed(fingerprint(t, shingle)) for t in as_bytes(texts)]]
    return add_columns(docs, [text], "fp bigint", start)


def group_bits(sample: np.ndarray, groups: int) -> list[list[int]]:
    """Groups of bit positions, equally large up to one: each starts with the free bit of most even
    distribution and takes the free bits most correlated with it."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    spread = bits.std(axis=0) if len(sample) else np.zeros(BITS)
    centred = bits - bits.mean(axis=0) if len(sample) else bits
    scale = np.where(spread > 0, spread, 1) * max(1, len(sample)) ** 0.5
    linked = np.abs((centred / scale).T @ (centred / scale))
    free, out = set(range(BITS)), []
    for i in range(groups):
        size = (BITS - sum(map(len, out))) // (groups - i)
        first = max(free, key=lambda b: (spread[b], -b))
        chosen = [first]
        free.remove(first)
        while len(chosen) < size:
            best = max(free, key=lambda b: (linked[b, chosen].sum(), -b))
            chosen.append(best)
            free.remove(best)
        out.append(sorted(chosen))
    return out


def gather(values: np.ndarray, positions: Sequence[int]) -> np.ndarray:
    """The bits at ``positions`` of each value, packed from bit 0 on."""
    out = np.zeros(len(values), dtype=np.int64)
    for to, at in enumerate(positions):
        out |= ((values >> np.uint64(at)) & np.uint64(1)).astype(np.int64) << to
    return out


def ball(width: int, radius: int) -> np.ndarray:
    """Masks of at most ``radius`` of ``width`` bits."""
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << b for b in some) for some in combinations(range(width), r)]
    return np.array(masks, dtype=np.int64)


def threshold_choices(groups: int, distance: int) -> list[tuple[int, ...]]:
    """All thresholds of at least -1 that sum to ``distance - groups + 1``."""
    def spend(left, places):
        if places == 1:
            yield (left,)
            return
        for t in range(-1, left + places):
            for rest in spend(left - t, places - 1):
                yield (t, *rest)
    return list(spend(distance - groups + 1, groups))


def allocate(costs: np.ndarray, distance: int) -> np.ndarray:
    """Cheapest thresholds per row. ``costs``: rows x groups x (threshold + 1), where column 0 (not
    probed) is free. Dynamic programming over groups and spent threshold, all rows at once."""
    rows, groups, levels = costs.shape
    budget = distance + 1  # the sum of (threshold + 1) over all groups
    best = np.full((rows, budget + 1), np.inf)
    best[:, 0] = 0
    picks = np.zeros((groups, rows, budget + 1), dtype=np.int8)
    for g in range(groups):
        fresh = np.full((rows, budget + 1), np.inf)
        for level in range(min(levels, budget + 1)):
            offered = best[:, :budget + 1 - level] + costs[:, g, level, None]
            better = offered < fresh[:, level:]
            fresh[:, level:] = np.where(better, offered, fresh[:, level:])
            picks[g][:, level:][better] = level
        best = fresh
    chosen, left = np.zeros((rows, groups), dtype=np.int64), np.full(rows, budget)
    for g in reversed(range(groups)):
        chosen[:, g] = picks[g][np.arange(rows), left]
        left -= chosen[:, g]
    return chosen - 1


def choose_groups(rows: int, distance: int = DISTANCE) -> int:
    """Number of groups with the least expected work for evenly spread fingerprints: probes plus the
    candidates they meet."""
    def work(groups):
        width = BITS / groups
        even = distance - groups + 1
        best = np.inf
        for choice in threshold_choices(groups, distance):
            if max(choice) > 2:
                continue
            sizes = [len(ball(int(width), t)) if t >= 0 else 0 for t in choice]
            best = min(best, sum(sizes) * (8 + rows / 2 ** width))
        return best + groups * 2 if even >= -groups else np.inf
    return min(range(2, distance + 2), key=work)


def near_pairs(distinct: DataFrame, distance: int = DISTANCE, groups: int | None = None) -> DataFrame:
    """All pairs (a < b) of the distinct fingerprints in column ``fp`` with at most ``distance`` different bits.

    Count tables have at most 2 ** TABLE_BITS entries per group, whatever the data, and are broadcast;
    they steer the thresholds only. Hot group values raise their estimate, so fingerprints avoid them
    where they can. Pairs come out once.
    """
    spark = distinct.sparkSession
    rows = distinct.count()
    groups = groups or choose_groups(rows, distance)
    sample = np.array([r.fp for r in distinct.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()], dtype=np.int64)
    layout = group_bits(sample.view(np.uint64), groups)
    levels = 4  # thresholds -1, 0, 1, 2
    while (distance + 1) > groups * (levels - 1):
        levels += 1
    masks = [[ball(len(g), t) for t in range(levels - 1)] for g in layout]

    def values_of(column: np.ndarray) -> list[np.ndarray]:
        return [gather(column.view(np.uint64), g) for g in layout]

    def tally(batches):
        size = 1 << TABLE_BITS
        counts = np.zeros((groups, size), dtype=np.int64)
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for g, v in enumerate(values_of(fps)):
                counts[g] += np.bincount(v & (size - 1), minlength=size)
        for g in range(groups):
            at = np.flatnonzero(counts[g])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), g)), pa.array(at), pa.array(counts[g][at])], names=["g", "v", "n"])

    tables = np.zeros((groups, 1 << TABLE_BITS), dtype=np.float64)
    counted = distinct.select("fp").mapInArrow(tally, "g long, v long, n long").groupBy("g", "v").agg(F.sum("n").alias("n"))
    for r in counted.toLocalIterator():  # at most groups * 2 ** TABLE_BITS rows
        tables[r.g, r.v] = r.n
    shared = spark.sparkContext.broadcast(tables)

    def estimate(table: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
        """Probes plus expected candidates per threshold; unknown high bits count as evenly spread."""
        low = min(width, TABLE_BITS)
        thin = 1 / 2 ** (width - low)
        out = np.zeros((len(values), levels))
        around = table[values & ((1 << low) - 1)].copy()
        one_off = np.zeros(len(values))
        for bit in range(low):
            one_off += table[(values ^ (1 << bit)) & ((1 << low) - 1)]
        mean = table.sum() / 2 ** low
        high = width - low
        near = [around * thin, (around * (1 + high) + one_off) * thin]
        out[:, 1] = 1 + near[0]
        out[:, 2] = 1 + width + near[1]
        for level in range(3, levels):
            size = len(ball(width, level - 1))
            out[:, level] = size + near[1] + (size - 1 - width) * mean * thin
        return out

    def probe(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            values = values_of(fps)
            costs = np.stack([estimate(shared.value[g], v, len(layout[g])) for g, v in enumerate(values)], axis=1)
            chosen = allocate(costs, distance)
            for g, v in enumerate(values):
                for t in range(levels - 1):
                    own = np.flatnonzero(chosen[:, g] == t)
                    for low in range(0, len(own), 4096):
                        some = own[low:low + 4096]
                        spread = (v[some, None] ^ masks[g][t][None, :]).ravel()
                        yield _keyed(np.full(len(spread), g), spread, np.repeat(fps[some], len(masks[g][t])))

    def store(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for g, v in enumerate(values_of(fps)):
                yield _keyed(np.full(len(v), g), v, fps)

    probes = distinct.select("fp").mapInArrow(probe, "key long, fp long").withColumnRenamed("fp", "a")
    stored = distinct.select("fp").mapInArrow(store, "key long, fp long").withColumnRenamed("fp", "b")
    different = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    met = probes.join(stored, "key").filter((F.col("a") != F.col("b")) & (different <= distance))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _keyed(group: np.ndarray, value: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array((group.astype(np.int64) << 58) | value), pa.array(fps)], names=["key", "fp"])


def _classes(points: DataFrame, distance: int) -> DataFrame:
    """``points`` (distinct ``fp``) with ``class``, the smallest fingerprint that links reach."""
    links = store(near_pairs(points.select("fp"), distance), "simhash-links")
    classes = connected_components(links.select("a", "b"))
    return points.join(classes, F.col("fp") == F.col("node"), "left") \
        .select(*points.columns, F.coalesce("class", "fp").alias("class"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """``key``, ``fp``, ``component_id`` (smallest key reachable over links, itself included).

    Equal fingerprints collapse first, so any number of copies is one point. Links are found between
    distinct fingerprints only. Documents without words have fingerprint 0 and link like others.
    Repeated keys are kept row by row; a null key gets the component of its fingerprint and never
    names one, unless the component has no other key (then null).
    """
    done = store(fingerprints(docs.select(F.col(key), F.col(text)), text, shingle).select(key, "fp"), "simhash-fps")
    points = store(done.groupBy("fp").agg(F.min(key).alias("first")), "simhash-points")
    joined = _classes(points, distance)
    smallest = joined.groupBy("class").agg(F.min("first").alias("component_id"))
    named = joined.join(smallest, "class").select("fp", "component_id")
    return done.join(named, "fp").select(key, "fp", "component_id")


def with_class(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The other columns of ``docs``, row by row, and ``class``: a number shared by all documents that links reach.
    Columns named ``fp`` or ``class`` are replaced."""
    rows = fingerprints(docs.drop("fp", "class"), text, shingle).drop(text)
    done = store(rows, "simhash-rows")
    points = store(done.select("fp").distinct(), "simhash-points")
    return done.join(_classes(points, distance), "fp").drop("fp")


def simhash_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _row_key(key: str, text: str) -> list[Column]:
    """What tells documents apart, in the order in which one of a group is kept: documents with a key first, by
    key; of one key, the smallest digest of the text."""
    return [F.col(key).isNull().alias("_no"), F.col(key).alias("_k"), F.coalesce(F.md5(text), F.lit("")).alias("_d")]


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component of ``near_duplicates``: the one with the smallest key; columns as they came.

    Documents without words are near-duplicates of each other, so one of them stays. A document without a key
    stays only if no document of its component has one. Of different texts with one key, the smallest digest
    stays; of rows alike in key and text, the one whose other columns have the smallest hash.
    """
    place = [F.col(c) for c in ("_no", "_k", "_d")]
    done = fingerprints(docs.select(*_row_key(key, text), F.col(text).alias("_t")), "_t", shingle)
    done = store(done.groupBy("fp", *place).agg(F.count(F.lit(1)).alias("n")), "simhash-rows")
    points = store(done.groupBy("fp").agg(F.min(F.struct(*place)).alias("first")), "simhash-points")
    joined = _classes(points, distance)
    kept = joined.groupBy("class").agg(F.min("first").alias("kept"))
    named = joined.join(kept, "class").select("fp", "kept")
    first = F.struct(*place) == F.col("kept")
    # Most rows are documents that stay; only the others are joined with the texts.
    others = store(done.join(named, "fp").filter(~first | (F.col("n") > 1)).select(*place, first.alias("_first")), "simhash-others")
    return _without(docs, others.filter("not _first"), others.filter("_first"), key, text)


def _without(docs: DataFrame, losers: DataFrame, repeated: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` without the documents of ``losers``, and with one row of each document of ``repeated``."""
    own = "_" * (1 + max(map(len, docs.columns)))  # longer than any column's name, so no helper clashes with one

    def among(rows: DataFrame, how: str, left: DataFrame) -> DataFrame:
        left = left.withColumns({own + "key": F.col(key), own + "digest": _row_key(key, text)[2]})
        right = rows.select(F.col("_k").alias(own + "k"), F.col("_d").alias(own + "d"))
        same = F.col(own + "key").eqNullSafe(F.col(own + "k")) & (F.col(own + "digest") == F.col(own + "d"))
        return left.join(right, same, how).select(*docs.columns)

    left = among(losers, "left_anti", docs)
    if repeated.isEmpty():
        return left
    # JSON, since maps have no hash of their own.
    order = Window.partitionBy(key, F.md5(text)).orderBy(F.xxhash64(F.to_json(F.struct(*docs.columns))))
    one = among(repeated, "left_semi", left).withColumn(own, F.row_number().over(order)).filter(F.col(own) == 1).drop(own)
    return among(repeated, "left_anti", left).unionByName(one)
