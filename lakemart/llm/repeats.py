"""Exact removal of repeated byte strings: content anchors, then suffix arrays of shards.

Every string of ``SPAN`` bytes selects one anchor, the place of its smallest hashed gram, by content
alone. Equal strings therefore share the anchor's gram, and only grams met in two documents matter.
The texts around those anchors (fragments) are dealt to shards by gram; the suffix array of a shard's
distinct fragments, with permuted common prefixes, tells which strings are equal and the smallest
document that holds each.
"""

from __future__ import annotations

import struct
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from lakemart.llm.common import add_columns, as_bytes, store
from lakemart.llm.suffixes import permuted_prefixes, suffix_array

SPAN = 50
GRAM = 16
#: Texts are scanned together up to so many bytes; arrays of eight times that stay in a core's cache.
BLOCK_BYTES = 1 << 16
#: Fragments sorted together reach about so many bytes; the grams of one shard are never parted.
SHARD_BYTES = 1 << 20


def gram_hashes(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hashes of grams given by their first and last 8 bytes."""
    h = low * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += high
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on, as numbers; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,))


def window_anchors(data: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """For each start of a ``span``-byte window, the place of its anchor; and the hash of each gram."""
    n = len(data)
    words = _words(data)
    count = n - gram + 1
    h = gram_hashes(words[:count], words[gram - 8:gram - 8 + count])
    # Hash above, place below: the smaller number is the smaller hash, or the earlier of equal ones.
    best = h & np.uint64(0xFFFFFFFF00000000) | np.arange(count, dtype=np.uint64)
    width = span - gram + 1  # grams in a window
    have = 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int32), h


def anchored(texts: list[bytes], span: int = SPAN, gram: int = GRAM):
    """Per block of texts: (text number, gram hash, where) of every anchor. ``where`` packs the first
    window (from the start of the text), the number of further windows and the place of the gram in the first."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= BLOCK_BYTES):
            size += len(texts[stop])
            stop += 1
        if size >= span:
            yield _anchored_block(texts[at:stop], at, span, gram)
        at = stop


def _anchored_block(texts, first, span, gram):
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    place, h = window_anchors(data, span, gram)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(lengths) - lengths
    valid = np.zeros(len(data), dtype=bool)
    long = lengths >= span
    edges = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(edges, starts[long], 1)
    np.add.at(edges, starts[long] + lengths[long] - span + 1, -1)
    valid = np.cumsum(edges)[:len(place)] > 0
    change = np.empty(len(place), dtype=bool)
    change[0] = True
    change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
    runs = np.flatnonzero(change)
    ends = np.append(runs[1:], len(place)) - 1
    keep = valid[runs]
    runs, ends = runs[keep], ends[keep]
    filled = np.flatnonzero(lengths)  # empty texts share a start with the next one
    owner = filled[np.searchsorted(starts[filled], runs, side="right") - 1]
    # A run never spans two texts, as the last span - 1 windows of a text are not valid.
    where = (runs - starts[owner] << 16) | (ends - runs << 8) | (place[runs] - runs)
    return first + owner, h[place[runs]], where


def _pack(gram: np.ndarray, doc: np.ndarray, where: np.ndarray) -> bytes:
    """Three columns as bytes, equal byte places together, so that block compression finds their runs."""
    columns = [np.ascontiguousarray(c, dtype=np.int64).view(np.uint8).reshape(-1, 8).T for c in (gram, doc, where)]
    return np.concatenate(columns).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    """Rows gram, doc, where."""
    planes = np.frombuffer(data, dtype=np.uint8).reshape(24, -1)
    return np.stack([np.ascontiguousarray(planes[8 * i:8 * i + 8].T).view(np.int64)[:, 0] for i in range(3)])


SUMMARY = -1
#: Packed pairs: document and start of an occurrence; smallest holder and first window of a run.
OCCURRENCE = "<qi"
PAIR = np.dtype([("doc", "<i8"), ("low", "<i4")])


def _emit_anchors(span, gram, buckets):
    """Rows (bucket, settled, anchors) for the texts of a batch: the packed anchors of each hash bucket.

    A gram met in two documents of the batch is settled: its anchors need no further proof and go to
    buckets in equal parts, so a hot gram is spread; its smallest and largest document (two summary
    entries) tell the other batches about it.
    """
    def run(batches):
        for number, batch in enumerate(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = list(anchored(as_bytes(batch.column(1)), span, gram))
            if not parts or not sum(len(p[0]) for p in parts):
                continue
            own, h, where = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h)  # of one gram, any order will do
            h, doc, where = h[order], ids[own[order]], where[order]
            heads = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            lo, hi = np.minimum.reduceat(doc, heads), np.maximum.reduceat(doc, heads)
            settled = np.repeat(lo < hi, np.diff(np.append(heads, len(h))))
            some = heads[lo < hi]
            told = np.full(2 * len(some), SUMMARY)
            keys = np.concatenate([h[~settled], h[some], h[some]])
            docs = np.concatenate([doc[~settled], lo[lo < hi], hi[lo < hi]])
            places = np.concatenate([where[~settled], told])
            bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
            order = _by_bucket(bucket, buckets)
            rows = _slices(bucket[order], keys[order].view(np.int64), docs[order], places[order])
            out = [(b, False, data) for b, data in rows]
            free = np.arange(settled.sum()) * buckets // max(1, settled.sum())
            turned = (free + number + int(ids[0] or 0)) % buckets
            order = _by_bucket(turned, buckets)
            rows = _slices(turned[order], h[settled].view(np.int64)[order], doc[settled][order], where[settled][order])
            out += [(b, True, data) for b, data in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out]), pa.array([o[2] for o in out], pa.binary())],
                names=["bucket", "settled", "anchors"])
    return run


def _by_bucket(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """Order by bucket, otherwise as it is. Small numbers are sorted by radix."""
    return np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")


def _slices(bucket, gram, doc, where):
    heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    ends = np.append(heads[1:], len(bucket)) if len(bucket) else []
    for a, b in zip(heads, ends):
        yield int(bucket[a]), _pack(gram[a:b], doc[a:b], where[a:b])


def _shared(batches):
    """Anchors (doc, where) of a partition of whole buckets whose gram two documents hold."""
    held: list[np.ndarray] = []
    for batch in batches:
        for settled, data in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            rows = _unpack(data)
            if settled:
                yield _pairs(rows[1], rows[2])
            else:
                held.append(rows)
    if held:
        gram, doc, where = np.concatenate(held, axis=1)
        held.clear()
        order = np.argsort(gram, kind="stable")
        gram, doc, where = gram[order], doc[order], where[order]
        heads = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        many = np.minimum.reduceat(doc, heads) < np.maximum.reduceat(doc, heads)
        keep = np.repeat(many, np.diff(np.append(heads, len(gram)))) & (where != SUMMARY)
        yield _pairs(doc[keep], where[keep])


def _pairs(doc, where):
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(where)], names=["doc", "where"])


def _digest(fragment: bytes) -> int:
    """Tells the fragments of one gram apart."""
    return xxhash.xxh3_64_intdigest(fragment) - (1 << 63)


def _cut(span, gram):
    """Distinct fragments of a batch with digest, place of the gram, smallest and largest document, and
    packed occurrences."""
    def run(batches):
        pack = struct.Struct(OCCURRENCE).pack
        for batch in batches:
            found: dict[bytes, list] = {}  # fragment: gram, place of it, smallest and largest document, occurrences
            places = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            ends = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).cumsum()
            low = 0
            for doc, text, end in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), ends.tolist()):
                own, low = places[low:end], end
                first, more, off = own >> 16, own >> 8 & 255, own & 255
                fits = first + more + span <= len(text)  # not so only where rows share a key
                first, more, off = first[fits], more[fits], off[fits]
                words = _words(np.frombuffer(text, dtype=np.uint8))
                keys = gram_hashes(words[first + off], words[first + off + gram - 8]).view(np.int64)
                for key, a, b, o in zip(keys.tolist(), first.tolist(), (first + more + span).tolist(), off.tolist()):
                    piece = text[a:b]
                    cell = found.get(piece)
                    if cell is None:
                        found[piece] = [key, o, doc, doc, pack(doc, a)]
                    else:
                        if doc < cell[2]:
                            cell[2] = doc
                        elif doc > cell[3]:
                            cell[3] = doc
                        cell[4] += pack(doc, a)
            pieces = list(found)
            for low in range(0, len(pieces), 50_000):
                some = pieces[low:low + 50_000]
                cells = [found[p] for p in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array([c[0] for c in cells], pa.int64()), pa.array(some, pa.binary()),
                    pa.array([_digest(p) for p in some], pa.int64()), pa.array([c[1] for c in cells], pa.int32()),
                    *(pa.array([c[i] for c in cells], t) for i, t in ((2, pa.int64()), (3, pa.int64()), (4, pa.binary())))],
                    names=["gram", "fragment", "digest", "off", "lo", "hi", "at"])
    return run


def smallest_holders(fragments: list[bytes], lows: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """For every window of every fragment, the smallest of the ``lows`` of fragments that hold its string."""
    lengths = np.fromiter(map(len, fragments), dtype=np.int64, count=len(fragments))
    text = np.frombuffer(b"\0".join(fragments), dtype=np.uint8).astype(np.uint16) + 1
    starts = np.cumsum(lengths + 1) - lengths - 1
    text[starts[1:] - 1] = 0
    left = np.repeat(starts + lengths, lengths + 1)[:len(text)] - np.arange(len(text))  # bytes left in the fragment
    order = suffix_array(text, 257, apart=True)
    shared = permuted_prefixes(text, order, left, apart=True)
    order = order[left[order] >= span]
    heads = np.flatnonzero(np.append(True, shared[order][1:] < span))
    owner = np.searchsorted(starts, order, side="right") - 1
    least = np.minimum.reduceat(lows[owner], heads)
    holder = np.empty(len(text), dtype=np.int64)
    holder[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
    return [holder[a:a + n - span + 1] for a, n in zip(starts.tolist(), lengths.tolist())]


#: Windows of a fragment are told apart in so many ranges by the place of their gram.
PLACES = 8


def _may_share(fragments: list[bytes], offs: list[int], span: int, gram: int) -> list[bool]:
    """Whether a fragment of one gram can share a window with another. Equal windows have the gram at one place, so
    for some range of places both fragments hold the bytes that all windows of that range have in common. Two ranges
    rule out most fragments; the others are told apart by more."""
    rest = span - gram  # bytes of a window before and behind the gram
    maybe, found = range(len(fragments)), set()
    for ranges in (2, PLACES):
        step = -(-(rest + 1) // ranges)
        found = set()
        for low in range(0, rest + 1, step):
            behind = gram + rest - min(low + step - 1, rest)
            seen: dict[bytes, int] = {}
            for i in maybe:
                piece, off = fragments[i], offs[i]
                if low <= off <= len(piece) - behind:
                    first = seen.setdefault(piece[off - low:off + behind], i)
                    if first != i:
                        found.add(first)
                        found.add(i)
        if not found:
            break
        maybe = sorted(found)
    return [i in found for i in range(len(fragments))]


def _judge(span, gram, shard_bytes):
    """Verdicts for the distinct fragments of a partition that is sorted by gram: the packed runs of
    windows with one smallest holder, for fragments of which a window has a smaller holder than some owner."""
    def weigh(same):
        """Rows (gram, fragment, lo, hi, off) of one gram: those to sort, and the verdicts of the others."""
        maybe = _may_share([r[1] for r in same], [r[4] for r in same], span, gram) if len(same) > 1 else [False]
        # Where no other fragment can hold a string of a fragment, its own smallest document decides.
        return [r for r, m in zip(same, maybe) if m], [(r, struct.pack(OCCURRENCE, r[2], 0)) for r, m in zip(same, maybe) if not m and r[2] < r[3]]

    def sort(rows):
        for row, least in zip(rows, smallest_holders([r[1] for r in rows], np.array([r[2] for r in rows]), span)):
            if (least < row[3]).any():
                heads = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
                runs = np.empty(len(heads), dtype=PAIR)
                runs["doc"], runs["low"] = least[heads], heads
                yield row, runs.tobytes()

    def verdicts(out):
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r, _ in out], pa.int64()), pa.array([_digest(r[1]) for r, _ in out], pa.int64()),
            pa.array([len(r[1]) for r, _ in out], pa.int32()), pa.array([runs for _, runs in out], pa.binary())],
            names=["gram", "digest", "size", "runs"])

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        many, size, out = [], 0, []
        for _, same in groupby(rows, key=lambda r: r[0]):
            some, settled = weigh(list(same))
            many += some
            size += sum(len(r[1]) for r in some)
            out += settled
            if size >= shard_bytes:
                out += sort(many)
                many, size = [], 0
            if len(out) >= 10_000:
                yield verdicts(out)
                out = []
        if many:
            out += sort(many)
        if out:
            yield verdicts(out)
    return run


def _pair_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All packed pairs of a binary column, and their number by row."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=PAIR), pc.binary_length(column).to_numpy(zero_copy_only=False) // PAIR.itemsize


def _mark(span):
    """Covered stretches (doc, start, stop) of the occurrences of judged fragments."""
    def run(batches):
        for batch in batches:
            at, places = _pair_column(batch.column(0))
            runs, pieces = _pair_column(batch.column(2))
            windows = batch.column(1).to_numpy(zero_copy_only=False) - span + 1
            ends = np.cumsum(pieces)
            high = np.append(runs["low"][1:], 0)  # a run ends where the next one starts
            high[ends - 1] = windows
            row = np.repeat(np.arange(len(places)), places)
            times = pieces[row]
            which = np.repeat(np.arange(len(at)), times)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
            run_no = (ends - pieces)[row][which] + nth
            own = at["doc"][which] > runs["doc"][run_no]
            which, run_no = which[own], run_no[own]
            first = at["low"][which]
            yield pa.RecordBatch.from_arrays([
                pa.array(at["doc"][which]), pa.array(first + runs["low"][run_no], pa.int32()),
                pa.array(first + high[run_no] + span - 1, pa.int32())], names=["doc", "start", "stop"])
    return run


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc, start, stop) of byte stretches whose strings of ``span`` bytes also start in a document
    with a smaller key. Stretches may overlap. Documents without a key, and empty or short texts, take no part.

    Anchors meet in as many hash buckets as there are shuffle partitions (a task holds some 1.5 bytes per
    byte of text and bucket); of a gram that a batch of documents shares, only two entries are sent there; equal fragments collapse before they are sorted, and their occurrences come back
    through a join, so a passage in a large part of all documents is one string for the sort.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("binary").alias("bytes"))         .filter(F.col("doc").isNotNull() & (F.length("bytes") >= span))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = source.mapInArrow(_emit_anchors(span, gram, buckets), "bucket int, settled boolean, anchors binary")
    shared = anchors.repartition(buckets, "bucket").select("settled", "anchors").mapInArrow(_shared, "doc long, where long")
    places = shared.groupBy("doc").agg(F.collect_list("where").alias("places"))
    fragments = "gram long, fragment binary, digest long, off int, lo long, hi long, at binary"
    # Neighbouring fragments overlap, so a strong codec makes the table small.
    pieces = store(source.join(places, "doc").mapInArrow(_cut(span, gram), fragments), "repeats-pieces", "zstd")
    distinct = pieces.select("gram", "fragment", "lo", "hi", "off").repartition("gram").groupBy("gram", "fragment") \
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("off").alias("off")).sortWithinPartitions("gram")
    judged = store(distinct.mapInArrow(_judge(span, gram, shard_bytes), "gram long, digest long, size int, runs binary"), "repeats-judged")
    marks = pieces.select("gram", "digest", "at").join(judged, ["gram", "digest"]).select("at", "size", "runs") \
        .mapInArrow(_mark(span), "doc long, start int, stop int")
    return marks


def _union(starts: np.ndarray, stops: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by the stretches; touching ones become one."""
    inside = starts < size  # not so only where rows share a key
    starts, stops = starts[inside], stops[inside]
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    heads = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return list(zip(starts[heads].tolist(), reach[np.append(heads[1:], len(starts)) - 1].tolist()))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``docs`` with ``kept`` (the bytes that remain) and ``removed_spans`` (maximal removed byte runs).

    Strings are judged on the input, so removal never depends on what else goes; cut characters are
    possible, hence bytes. Null text counts as empty; repeated rows of one key do not remove each other;
    rows without a key stay whole. Columns of the two result names are replaced.
    """
    marks = find_repeats(docs, key, text, span, gram)
    spans = marks.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("_marks"))
    kept = [c for c in docs.columns if c not in ("kept", "removed_spans")]
    joined = docs.select(*kept).join(spans.withColumnRenamed("doc", "_doc"), F.col(key).cast("long") == F.col("_doc"), "left").drop("_doc")
    joined = joined.withColumn("_bytes", F.col(text).cast("binary"))

    def start():
        def work(texts, marks_):
            remaining, runs = [], []
            ends = np.cumsum(pc.fill_null(marks_.value_lengths(), 0).to_numpy(zero_copy_only=False))
            starts, stops = (marks_.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(2))
            low = 0
            for body, end in zip(as_bytes(texts), ends.tolist()):
                body = body or b""
                spans = _union(starts[low:end], np.minimum(stops[low:end], len(body)), len(body))
                low, at, parts = end, 0, []
                for a, b in spans:
                    parts.append(body[at:a])
                    at = b
                remaining.append(b"".join([*parts, body[at:]]))
                runs.append([{"start": a, "stop": b} for a, b in spans])
            return remaining, runs
        return work

    done = add_columns(joined, ["_bytes", "_marks"], "kept binary, removed_spans array<struct<start:int,stop:int>>", start)
    return done.select(*kept, "kept", "removed_spans")


def repeats_report(docs: DataFrame) -> DataFrame:
    """Byte counts, removed runs and digest of what remains, per document."""
    done = remove_repeats(docs.select("doc_id", "text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"]).cast("long"))
    return done.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), removed.alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))
