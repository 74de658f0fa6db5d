"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are windows of benchmark items. For each pattern length there is one table set: a shift
table over blocks of words, which tells how far the search may jump when a block cannot end a
pattern, and buckets keyed by the last block, whose few patterns are compared word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import add_columns, as_bytes, store

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
BLOCK = 3
#: Benchmark characters searched in one pass; their tables take some 100 MB in a Python worker.
PASS_CHARS = 1_000_000
FIELDS = "n_words bigint, hit_spans array<struct<start:int,stop:int>>, items array<string>"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a UTF-8 text: runs of digits, letters and non-ASCII characters."""
    return WORD.findall(text.lower()) if text else []


def windows(words: list[bytes], size: int = WINDOW) -> Iterable[tuple[bytes, ...]]:
    """All runs of ``size`` words; one shorter run if there are fewer words."""
    if words:
        for i in range(max(1, len(words) - size + 1)):
            yield tuple(words[i:i + size])


class Patterns:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, length: int, block: int = BLOCK):
        self.length, self.block = length, min(block, length)
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list[tuple[list[bytes], set[str]]]] = {}
        self.default = length - self.block + 1

    def add(self, pattern: tuple[bytes, ...], items: set[str]) -> None:
        for end in range(self.block, self.length + 1):
            part = pattern[end - self.block:end]
            self.shift[part] = min(self.shift.get(part, self.default), self.length - end)
        self.buckets.setdefault(pattern[self.length - self.block:], []).append((list(pattern), items))

    def search(self, words: list[bytes]):
        """(first word, item ids) of every occurrence."""
        shift, default, block, length = self.shift, self.default, self.block, self.length
        end, n = length, len(words)
        while end <= n:
            last = tuple(words[end - block:end])
            jump = shift.get(last, default)
            if jump:
                end += jump
                continue
            first = end - length
            found = words[first:end]
            for pattern, items in self.buckets[last]:
                if pattern == found:
                    yield first, items
                    break  # patterns are distinct
            end += 1


def build_patterns(items: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW) -> list[Patterns]:
    """Tables for all windows of the items, one set per length. Items without an id are searched unnamed."""
    owners: dict[tuple, set[str]] = {}
    for item, text in items:
        for run in windows(words_of(text), window):
            owners.setdefault(run, set()).update(() if item is None else (item,))
    tables: dict[int, Patterns] = {}
    for run, names in owners.items():
        tables.setdefault(len(run), Patterns(len(run))).add(run, names)
    return list(tables.values())


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint, sorted spans with the same words; touching ones become one."""
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return merged


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, pass_chars: int = PASS_CHARS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word positions inside window occurrences) and ``items``.

    Every document is searched whole, without a shuffle. A benchmark of more than ``pass_chars``
    characters is searched in several passes of about that size, so what is broadcast is bounded;
    spans and items add up. A null or empty text has no words and no hit. Items with equal ids count
    once; an item without an id marks words but is not listed. Repeated documents are judged row by
    row. Columns of the three result names are replaced, all others pass through. An empty benchmark
    hits nothing.
    """
    spark = docs.sparkSession
    wanted = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).cast("binary").alias("text"))
    size = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-size // pass_chars))
    out = docs.withColumn("hit_spans", F.lit(None).cast("array<struct<start:int,stop:int>>")) \
        .withColumn("items", F.lit(None).cast("array<string>"))
    for number in range(passes):
        part = wanted.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == number) if passes > 1 else wanted
        rows = spark.sparkContext.broadcast([(r.item, bytes(r.text or b"")) for r in part.collect()])
        if number:
            out = store(out, "decontaminate-pass")
        out = add_columns(out, [text, "hit_spans", "items"], FIELDS, lambda rows=rows: _searcher(rows.value, window))
    return out


def _searcher(items, window):
    tables = build_patterns(items, window)

    def work(texts: pa.Array, spans: pa.Array, named: pa.Array):
        counts, all_spans, all_items = [], [], []
        for body, old_spans, old_items in zip(as_bytes(texts), spans.to_pylist(), named.to_pylist()):
            words = words_of(body)
            hits = [(s["start"], s["stop"]) for s in old_spans or ()]
            names = set(old_items or ())
            for table in tables:
                for first, owners in table.search(words):
                    hits.append((first, first + table.length))
                    names |= owners
            counts.append(len(words))
            all_spans.append([{"start": a, "stop": b} for a, b in merge_spans(hits)])
            all_items.append(sorted(names))
        return counts, all_spans, all_items
    return work


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest per document: word, hit and item counts, hash of the item ids, verdict."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]).cast("long"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("hit_spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, columns as they came, also those with names of the search."""
    own = {c: f"_own_{c}" for c in ("n_words", "hit_spans", "items") if c in docs.columns}
    found = find_contamination(docs.withColumnsRenamed(own), benchmark).filter(F.size("hit_spans") == 0)
    return found.drop(*own).withColumnsRenamed({new: old for old, new in own.items()}).select(*docs.columns)
