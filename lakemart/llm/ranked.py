"""Ranked lexical search by presence-mask grouping.

Documents stay where they are; the queries (items) go to them. Within a block of documents every term
has a posting list. For an item, bitmaps of its terms give each document the mask of the terms it
holds; documents with one mask form a group, and the group's highest possible score is the sum of the
best contributions of the mask's terms in the block. Groups are scored from the highest bound down,
until the bound falls below the last place the item has filled in this task. Only the best documents
of each task are shuffled and ranked by item.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from lakemart.llm.common import as_bytes

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TOP = 20
#: Bytes of item texts searched in one pass over the documents; what is broadcast grows with this only.
PASS_BYTES = 16_000_000
#: A block of documents ends at so many of them or so many postings.
BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 4_000_000
#: Documents scored before the bound is looked at again.
STEP_DOCS = 64


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text: runs of digits, letters (A-Z lower-cased) and non-ASCII characters."""
    return TERM.findall(text.lower()) if text else []


class Items:
    """A bounded set of items: their terms numbered, their counts, and the ids of the items."""

    def __init__(self, rows: list[tuple[object, bytes | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.terms, self.times = [], [], []
        for name, text in rows:
            counts = Counter(terms_of(text))
            self.ids.append(name)
            self.terms.append(np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in counts], np.int64))
            self.times.append(np.array(list(counts.values()), np.int64))


def _count_terms(shared):
    """Per task: documents holding each term; -1 counts documents with a term, -2 all their terms."""
    def run(batches):
        vocabulary = shared.value.vocabulary
        held: Counter = Counter()
        for batch in batches:
            for body in as_bytes(batch.column(0)):
                words = terms_of(body)
                if words:
                    held[-1] += 1
                    held[-2] += len(words)
                    held.update(vocabulary[w] for w in vocabulary.keys() & set(words))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())],
                                         names=["term", "n"])
    return run


class Block:
    """Postings of some documents, by document and by term, with the contribution of each."""

    def __init__(self, counts: list[dict[int, int]], sizes: list[int], weights: np.ndarray, documents: int, words: int):
        lengths = np.array([len(c) for c in counts], np.int64)
        total = int(lengths.sum())
        self.n = len(counts)
        self.ends = np.cumsum(lengths)
        self.term = np.fromiter((t for c in counts for t in c), np.int64, total)
        times = np.fromiter((x for c in counts for x in c.values()), np.int64, total)
        m = 75 + (25 * np.array(sizes, np.int64) * documents) // max(words, 1)
        doc = np.repeat(np.arange(self.n), lengths)
        self.part = weights[self.term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
        order = np.argsort(self.term, kind="stable")
        self.by_term = doc[order]
        self.first = np.r_[0, np.cumsum(np.bincount(self.term, minlength=len(weights)))]
        self.best = np.zeros(len(weights), np.int64)
        np.maximum.at(self.best, self.term, self.part)

    def masks(self, terms: np.ndarray) -> np.ndarray:
        """Bitmap of the terms each document holds, in words of 64 bits."""
        masks = np.zeros((self.n, -(-len(terms) // 64)), np.uint64)
        for k, t in enumerate(terms.tolist()):
            masks[self.by_term[self.first[t]:self.first[t + 1]], k >> 6] |= np.uint64(1 << (k & 63))
        return masks

    def scores(self, docs: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``times`` is the item's count of every term."""
        stops = self.ends[docs]
        starts = np.where(docs > 0, self.ends[docs - 1], 0)
        sizes = stops - starts
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        return np.add.reduceat(times[self.term[at]] * self.part[at], np.cumsum(sizes) - sizes)


def _groups(masks: np.ndarray, best: np.ndarray):
    """Documents with a term, ordered by group; first place of each group; highest score of each group.
    Groups come by descending bound."""
    holders = np.flatnonzero(masks.any(axis=1))
    own = masks[holders]
    order = np.lexsort(own.T)
    own, holders = own[order], holders[order]
    heads = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]).any(axis=1)])[:len(holders)]
    weights = np.zeros(own.shape[1] * 64)
    weights[:len(best)] = best  # whole numbers far below 2^53
    step = max(1, 4_000_000 // len(weights))
    bounds = [np.unpackbits(np.ascontiguousarray(own[heads[i:i + step]]).view(np.uint8), axis=1, bitorder="little") @ weights
              for i in range(0, len(heads), step)]
    bound = np.concatenate(bounds) if bounds else np.empty(0)
    sizes = np.diff(np.r_[heads, len(holders)])
    by = np.argsort(-bound, kind="stable")
    sizes, starts = sizes[by], heads[by]
    ends = np.cumsum(sizes)
    at = np.arange(len(holders)) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)
    return holders[at], ends, bound[by]


def search_block(block: Block, terms: np.ndarray, times: np.ndarray, best: list[tuple], keys: list, k: int,
                 dense: np.ndarray) -> list[tuple]:
    """``best`` (negative score, id is null, id) brought up to date with the documents of a block."""
    if not len(terms) or not block.n:
        return best
    docs, ends, bounds = _groups(block.masks(terms), block.best[terms] * times)
    dense[terms] = times
    group = 0
    while group < len(ends):
        last = -best[-1][0] if len(best) == k else 1
        if bounds[group] < last:
            break  # no later group can reach a place; an equal score still may, by its id
        start = ends[group - 1] if group else 0
        upto = max(group + 1, int(np.searchsorted(ends, start + STEP_DOCS)))
        chosen = docs[start:ends[upto - 1]]
        scores = block.scores(chosen, dense)
        good = scores >= last
        found = [(-s, keys[d] is None, keys[d]) for d, s in zip(chosen[good].tolist(), scores[good].tolist())]
        best = sorted(best + found, key=_order)[:k]
        group = upto
    dense[terms] = 0
    return best


def _order(entry: tuple):
    return entry[:2] if entry[1] else entry


def _searcher(shared, weights, documents, words, k, key_type):
    def run(batches):
        items, weigh = shared.value, weights.value
        vocabulary, known = items.vocabulary, items.vocabulary.keys()
        best: list[list[tuple]] = [[] for _ in items.ids]
        dense = np.zeros(len(weigh), np.int64)
        keys, counts, sizes, postings = [], [], [], 0

        def flush():
            block = Block(counts, sizes, weigh, documents, words)
            for i, (terms, times) in enumerate(zip(items.terms, items.times)):
                best[i] = search_block(block, terms, times, best[i], keys, k, dense)
            keys.clear(), counts.clear(), sizes.clear()

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                found = Counter(terms_of(body))
                held = {vocabulary[t]: found[t] for t in found.keys() & known}
                if not held:
                    continue
                keys.append(name)
                counts.append(held)
                sizes.append(found.total())
                postings += len(held)
                if len(keys) >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    flush()
                    postings = 0
        if keys:
            flush()
        rows = [(i, name, -score) for i, own in enumerate(best) for score, _, name in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], key_type),
             pa.array([r[2] for r in rows], pa.int64())], names=["item", "key", "score"])
    return run


def rank_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                   item_text: str = "text", k: int = TOP, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``item``, ``rank`` (from 1), ``key`` and ``score`` of the ``k`` best documents of every item.

    Exact: every document is searched whole, counts cover all documents. A pass reads the documents
    twice (counts, search) and shuffles at most ``k`` rows per task and item. Items of more than
    ``pass_bytes`` bytes are searched in several passes of about that size, so what goes to a task is
    bounded. A null or empty text has no terms: such documents are not counted, such items get no rows.
    Equal rows of items count once; different texts under one item id are ranked one by one, each from
    1. Repeated documents count and rank row by row; equal scores go by id, a null id last. Only the
    four named columns are read; empty tables give an empty result.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item).alias("item"), F.col(item_text).cast("binary").alias("text")).distinct()
    size = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    key_type, item_type = docs.schema[key].dataType, items.schema[item].dataType
    found = None
    for number in range(passes):
        part = wanted.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == number) if passes > 1 else wanted
        block = Items([(r["item"], bytes(r["text"] or b"")) for r in part.collect()])  # at most some pass_bytes
        shared = spark.sparkContext.broadcast(block)
        counted = dict(docs.select(text).mapInArrow(_count_terms(shared), "term bigint, n bigint")
                       .groupBy("term").agg(F.sum("n")).collect())  # terms of the items only
        documents, words = counted.get(-1, 0), counted.get(-2, 0)
        weights = np.zeros(len(block.vocabulary), np.int64)
        for t in range(len(weights)):
            weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * counted.get(t, 0) + 1)))
        search = _searcher(shared, spark.sparkContext.broadcast(weights), documents, words, k, to_arrow_type(key_type))
        schema = StructType([StructField("item", LongType()), StructField("key", key_type), StructField("score", LongType())])
        best = docs.select(key, text).mapInArrow(search, schema)
        place = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
        names = StructType([StructField("item", LongType()), StructField("name", item_type)])
        ranked = best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k) \
            .join(F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), names)), "item") \
            .select(F.col("name").alias(item), "rank", F.col("key").alias(key), "score")
        found = ranked if found is None else found.unionAll(ranked)
    return found


def ranked_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 20 best documents of every item."""
    return rank_documents(docs, items).select("item_id", "rank", "doc_id", "score")
