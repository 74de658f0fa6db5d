"""Conflict-constrained best-fit packing of documents into fixed-length training sequences.

Bins are ordered by residual space and carry the set of sources and of duplicate clusters they hold
as bitmaps. A document goes to the tightest bin that it fits and that holds neither its source nor
its cluster; the search moves on to the next larger residual until one is found, else a bin opens.
"""

from __future__ import annotations

from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm import simhash

CAPACITY = 2048
#: Documents packed together in one task; bins never cross such a shard.
SHARD_ROWS = 8192
RESULT = ("doc_id bigint, piece int, bin_id bigint, bin_offset int, doc_offset bigint, n_tokens int")


class Bins:
    """Open bins by residual. Bins of one residual and equal source bitmap share a list, so a document
    passes a whole list at once when its source is taken."""

    def __init__(self, capacity: int):
        self.capacity, self.used = capacity, []
        self.clusters: list[int] = []
        self.sources: list[int] = []
        self.by_residual: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]
        self.filled = 0  # bit r is set if some bin has residual r

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset. ``source`` and ``cluster`` are bitmaps with at most one bit."""
        candidates = self.filled >> length << length
        while candidates:
            residual = (candidates & -candidates).bit_length() - 1
            lists = self.by_residual[residual]
            for taken, bins in lists.items():
                if taken & source:
                    continue
                for i in range(len(bins) - 1, -1, -1):
                    if not self.clusters[bins[i]] & cluster:
                        return self._put(bins.pop(i), taken, residual, length, source, cluster)
            candidates &= candidates - 1
        self.used.append(0)
        self.clusters.append(0)
        self.sources.append(0)
        return self._put(len(self.used) - 1, None, self.capacity, length, source, cluster)

    def _put(self, bin_no, taken, residual, length, source, cluster):
        if taken is not None and not self.by_residual[residual][taken]:
            del self.by_residual[residual][taken]
            if not self.by_residual[residual]:
                self.filled &= ~(1 << residual)
        offset = self.used[bin_no]
        self.used[bin_no] += length
        self.sources[bin_no] |= source
        self.clusters[bin_no] |= cluster
        left = residual - length
        if left:
            self.by_residual[left].setdefault(self.sources[bin_no], []).append(bin_no)
            self.filled |= 1 << left
        return bin_no, offset


def pack_shard(rows: list[tuple], capacity: int = CAPACITY):
    """(id, length, source, cluster) rows to (id, piece, bin, bin offset, document offset, length), in
    best-fit decreasing order. Longer documents fill whole bins first; only the rest is fitted."""
    bins, bit_of, cluster_of, rest = Bins(capacity), {}, {}, []
    for doc, length, source, cluster in rows:
        whole = length // capacity
        for piece in range(whole):
            number, offset = bins.place(capacity, 0, 0)
            yield doc, piece, number, offset, piece * capacity, capacity
        if length % capacity or not length:
            rest.append((-(length % capacity), doc is None, doc or 0, whole, source, cluster))
    repeated = {}
    for _, _, _, _, _, cluster in rest:
        repeated[cluster] = repeated.get(cluster, 0) + 1
    for negative, unknown, doc, whole, source, cluster in sorted(rest, key=lambda r: (r[0], r[1], r[2], r[3], str(r[4]), str(r[5]))):
        doc = None if unknown else doc
        if not negative:  # an empty document takes no space and stands in no bin
            yield doc, whole, None, 0, 0, 0
            continue
        source_bit = 0 if source is None else 1 << bit_of.setdefault(source, len(bit_of))
        # A cluster with one document here cannot conflict and needs no bit.
        cluster_bit = 1 << cluster_of.setdefault(cluster, len(cluster_of)) if cluster is not None and repeated[cluster] > 1 else 0
        number, offset = bins.place(-negative, source_bit, cluster_bit)
        yield doc, whole, number, offset, whole * capacity, -negative


def pack(docs: DataFrame, length: Column, cluster: Column, key: str = "doc_id", source: str = "source",
         capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: the document, its bin, where it lies in bin and document, and its length.

    Documents are dealt by a hash of id and cluster to shards of about ``shard_rows`` rows, each packed
    by one task, so a hot source or a large group of copies is spread evenly and memory is bounded;
    the number of shards follows the number of rows. Bin ids are ``shard * 2**32 + bin``. No bin holds
    two documents of one source or of one cluster (whole-bin pieces stand alone). A null source or
    cluster conflicts with nothing. Empty and null texts give one row of length 0 without a bin.
    Repeated rows are packed as often as they occur. Extra columns are not read.
    """
    ready = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(length, F.lit(0)).cast("int").alias("n"),
                        F.col(source).cast("string").alias("source"), cluster.cast("long").alias("cluster"))
    shards = max(1, -(-docs.select(F.lit(1)).count() // shard_rows))
    dealt = ready.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))

    def work(key_: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        first = int(key_[0]) << 32
        cells = zip(*(frame[c].astype(object).where(frame[c].notna(), None) for c in ("doc_id", "n", "source", "cluster")))
        out = [(d, p, None if b is None else first + b, o, at, n) for d, p, b, o, at, n in pack_shard(list(cells), capacity)]
        made = pd.DataFrame(out, columns=["doc_id", "piece", "bin_id", "bin_offset", "doc_offset", "n_tokens"])
        return made.astype({"doc_id": "Int64", "bin_id": "Int64"})

    return dealt.groupBy("shard").applyInPandas(work, RESULT)


def word_length(text: str = "text") -> Column:
    """Number of runs without white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0))


def exact_cluster(text: str = "text") -> Column:
    """Class of equal texts; null for null text."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(text))


def pack_documents(docs: DataFrame) -> DataFrame:
    """For documents that are free of near copies: clusters are equal texts."""
    return pack(docs, word_length(), exact_cluster())


def pack_near(docs: DataFrame) -> DataFrame:
    """For any documents: clusters are the near-duplicate classes of the SimHash operator, equal texts included."""
    lean = docs.select("doc_id", "source", word_length().alias("n"), "text")
    return pack(simhash.with_class(lean), F.col("n"), F.col("class"))
