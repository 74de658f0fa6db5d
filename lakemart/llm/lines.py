"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. Words are ordered by rarity; two lines of Jaccard similarity t or more
share k words within the first n - ceil(t n) + k words of each (the prefix), if they share as many at all.
Prefixes meet in an equi-join, length, number and position of the words met rule out most pairs, and the
word sets decide. A line goes if a similar line came before it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemart.llm.common import discard, store

SIMILARITY = 0.8
#: Shorter lines are not compared by default: headings and separators repeat in clean text. With 1, all lines
#: with a word take part.
MIN_WORDS = 5
#: Words are counted in so many hash classes; the counts order words by rarity. Any total order gives
#: the same result, so collisions cost time only, and the broadcast has this size for any corpus.
RARITY_CLASSES = 1 << 16
#: Prefixes are longer by one word, and lines must meet on two: one rare word in common is mostly chance.
LEAST_MET = 2
#: Prefix words meet in so many passes, by their code, so that one pass's share of the join is on disk at a time.
PASSES = 4
#: Lines of one size that share a prefix word count as a group from so many on: its earliest is compared with lines of
#: other sizes before the join, and a line is compared with so many of those. Both only save rows of the join.
GROUP, TRIED = 4, 4
#: Sets of so many words have a parity of so many times 64 bits (a power of two). With 64 alone, two sets of 100
#: words or more that met by chance would look alike, and their number grows with the square of the lines.
WIDE_FROM, WIDE = 64, 4
PARITIES = ("parity", *(f"parity{k}" for k in range(1, WIDE)))
PLACE = ("hi", "mid", "lo")
#: Set in the middle part of a place if the document has no key.
KEYLESS = 1 << 62
LARGEST = (1 << 63) - 1


def _rarity_class(h: Column) -> Column:
    return h.bitwiseAND(F.lit(RARITY_CLASSES - 1)).cast("int")


def rarity_ranks(docs: DataFrame, text: str = "text") -> list[int]:
    """Rank of each hash class of words, rarest first, counted over all words of all documents."""
    flat = F.replace(F.replace(F.lower(text), F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    words = docs.select(F.explode(F.split(flat, " ")).alias("w")).filter("w <> ''")
    counts = words.groupBy(_rarity_class(F.xxhash64("w")).alias("c")) \
        .agg(F.count(F.lit(1)).alias("n")).collect()  # at most RARITY_CLASSES rows
    ranks = [0] * RARITY_CLASSES
    for rank, row in enumerate(sorted(counts, key=lambda r: (r.n, r.c))):
        ranks[row.c] = rank
    return ranks


def word_codes(line: Column, ranks: Column) -> Column:
    """Sorted codes of the distinct lower-case words of a line, between spaces and tabs: rarity rank (``ranks`` holds
    them in place) above 47 bits of the word's hash."""
    words = F.split(F.replace(F.lower(line), F.lit("\t"), F.lit(" ")), " ")
    hashes = F.array_distinct(F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w)))
    return F.sort_array(F.transform(hashes, lambda h: F.get(ranks, _rarity_class(h)).bitwiseOR(F.shiftrightunsigned(h, 17))))


def _parity(codes: str, part: int | None = None) -> Column:
    """64 bits; each word of the set (of one in ``WIDE`` hash classes, with ``part``) turns the bit of its hash."""
    def turn(bits, code):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), code.bitwiseAND(F.lit(63)).cast("int"))
        if part is not None:
            bit = F.when(F.shiftright(code, 6).bitwiseAND(F.lit(WIDE - 1)) == part, bit).otherwise(F.lit(0).cast("long"))
        return bits.bitwiseXOR(bit)
    return F.aggregate(codes, F.lit(0).cast("long"), turn)


def _parities(codes: str, n: str) -> list[Column]:
    """``parity`` of the whole set and, for sets that fill 64 bits, those of all parts but the first, which follows."""
    return [_parity(codes).alias("parity")] + [F.when(F.col(n) >= WIDE_FROM, _parity(codes, k)).alias(f"parity{k}") for k in range(1, WIDE)]


def _odd_places() -> Column:
    """Odd places of the parities of ``_a`` and ``_b``: no more than the words that only one of both sets has."""
    whole, *parts = [F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b")) for p in PARITIES]
    first = reduce(Column.bitwiseXOR, parts, whole)
    # Null where one of both sets is short.
    return F.coalesce(reduce(Column.__add__, map(F.bit_count, parts), F.bit_count(first)), F.bit_count(whole))


def _literal(ranks: list[int]) -> Column:
    return F.split(F.lit(",".join(str(rank << 47) for rank in ranks)), ",").cast("array<bigint>")


def _least_overlap(n: Column | int, share: float) -> Column:
    """ceil(share * n), safe against rounding just above a whole number."""
    return F.ceil(n * share - 1e-9)


def _document(key: str, text: str) -> list[Column]:
    """``hi`` and ``mid``: the key, and 62 bits of a digest of the text. Different texts without a key, or with
    one key, are different documents. Documents without a key come last."""
    doc = F.col(key).cast("long")
    mid = F.shiftrightunsigned(F.xxhash64(text), 2) + F.when(doc.isNull(), F.lit(KEYLESS)).otherwise(F.lit(0))
    return [F.coalesce(doc, F.lit(LARGEST)).alias("hi"), mid.alias("mid")]


def split_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc``, ``no``, ``line`` and place ``at`` of every line; \\n ends a line. A place is a sortable struct: the
    document (``hi``, ``mid``), then the line within it (``lo``)."""
    # Digests are computed before lines are split off, once a document.
    known = docs.select(F.col(key).cast("long").alias("doc"), *_document(key, text), F.col(text).alias("_text"))
    lines = known.select("doc", "hi", "mid", F.posexplode(F.split("_text", "\n")).alias("no", "line"))
    return lines.select("doc", "no", "line", F.struct("hi", "mid", F.col("no").alias("lo")).alias("at"))


def _split_place(at: Column) -> list[Column]:
    return [at[c].alias(c) for c in PLACE]


def _joined_place(end: str) -> Column:
    return F.struct(*[F.col(c + end).alias(c) for c in PLACE])


def _only_equal(n: str, similarity: float) -> Column:
    """Whether a set of this size is similar to equal sets only: one word more or less is too much."""
    return F.col(n) < (F.col(n) + 1) * similarity - 1e-9


def _line_table(lines: DataFrame, ranks: Column, similarity: float, min_words: int) -> tuple[DataFrame, DataFrame]:
    """``doc``, ``no``, ``at`` and a digest (``h1``, ``h2``) of the text of every line to compare, and ``_prefixes``
    of the different ones. All texts are split and hashed once, for this; later steps read only these two."""
    coded = lines.select("doc", "no", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.reverse("line")).alias("h2"),
                         word_codes(F.col("line"), ranks).alias("codes")).withColumn("n", F.size("codes"))
    # The longer line offers its whole prefix; the shorter needs only n - ceil(2t/(1+t) n) words and one more
    # for each word that must be met.
    length = (F.col("n") - _least_overlap(F.col("n"), similarity) + LEAST_MET).cast("int")
    table = coded.select("doc", "no", "at", "h1", "h2", "n", *_parities("codes", "n"),
                         F.when(_only_equal("n", similarity), F.array(F.xxhash64("codes")))
                         .otherwise(F.slice("codes", F.lit(1), length)).alias("prefix"))
    # Sets that only equal ones resemble meet on their digest, in place of words that thousands of short lines share.
    # A filter before the store would be pushed below the codes and compute them twice.
    whole = store(table, "lines-table", "zstd")
    wanted = whole.filter(F.col("n") >= min_words)
    prefixes = _prefixes(wanted)
    known = store(wanted.select("doc", "no", "at", "h1", "h2"), "lines-known", "zstd")
    discard(whole)
    return known, prefixes


def _firsts(table: DataFrame) -> DataFrame:
    return table.groupBy("h1", "h2").agg(F.min("at").alias("first"))


def _prefixes(table: DataFrame) -> DataFrame:
    """Place, ``n``, parities and ``prefix`` of every different line, at its first place."""
    # A limit by rank is taken before the shuffle as well, so a common line sends one row a task.
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("at"))
    at_first = table.withColumn("nth", nth).filter("nth = 1")
    return store(at_first.select(*_split_place(F.col("at")), "n", *PARITIES, "prefix"), "lines-prefixes", "zstd")


def _exploded(prefixes: DataFrame, end: str) -> DataFrame:
    """One row for each prefix word; the columns' names end in ``end``, ``code`` aside."""
    kept = [F.col(c).alias(c + end) for c in prefixes.columns if c != "prefix"]
    return prefixes.select(*kept, F.posexplode("prefix").alias("pos" + end, "code"))


def _shorter_prefix(similarity: float, end: str = "_a") -> Column:
    """Positions with which the shorter line of a pair must be met; of equally long ones, both."""
    n = F.col("n" + end)
    return F.col("pos" + end) < LEAST_MET + n - _least_overlap(n, 2 * similarity / (1 + similarity))


def _in_passes(name: str, meet: Callable[[Column], DataFrame]) -> list[DataFrame]:
    """``meet`` stored for one share of the codes after the other; a pass frees its shuffle files before the next."""
    return [store(meet(F.pmod("code", F.lit(PASSES)) == share), name) for share in range(PASSES)]


def _later(x: str, y: str) -> Column:
    return _joined_place(x) > _joined_place(y)


def _close(similarity: float) -> Column:
    """Whether lengths, parities and the positions of a met word allow the similarity."""
    needed = _least_overlap(F.col("n_a") + F.col("n_b"), similarity / (1 + similarity))
    alike = _odd_places() <= F.col("n_a") + F.col("n_b") - 2 * needed
    placed = F.least("pos_a", "pos_b") + F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) >= needed
    sized = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - 1e-9
    return sized & alike & placed


def _meet(short: DataFrame, long: DataFrame, similarity: float, share: Column, wanted: Column | None = None) -> DataFrame:
    """Rows of two lines of which the shorter (of equal ones, the earlier) is in ``short``, one for each
    word of this share that their prefixes share, where the filters allow the similarity."""
    partitions = int(short.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes make many rows here
    a = _exploded(short, "_a").filter(_shorter_prefix(similarity) & share).repartition(partitions, "code")
    b = _exploded(long, "_b").filter(share).repartition(partitions, "code")
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & _later("_b", "_a"))
    condition = ordered & _close(similarity)
    met = a.join(b, "code").filter(condition if wanted is None else condition & wanted)
    return met.select(*[c + end for end in ("_a", "_b") for c in (*PLACE, "n", "pos")])


def _pairs_met(parts: list[DataFrame], similarity: float) -> DataFrame:
    """``a`` and ``b`` (places, a before b) of the lines that met on enough words."""
    met = reduce(DataFrame.union, parts).groupBy(*[c + end for end in ("_a", "_b") for c in (*PLACE, "n")]) \
        .agg(F.count(F.lit(1)).alias("m"), F.max("pos_a").alias("pos_a"), F.max("pos_b").alias("pos_b"))
    # Both prefixes are in one order, so words shared up to the last met ones have all met; the rest of
    # the shorter remainder must be able to fill the overlap.
    needed = _least_overlap(F.col("n_a") + F.col("n_b"), similarity / (1 + similarity))
    can_fill = F.col("m") + F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) - 1 >= needed
    met = met.filter(can_fill & (F.col("m") >= F.when(_only_equal("n_a", similarity), 1).otherwise(LEAST_MET))) \
        .select(_joined_place("_a").alias("x"), _joined_place("_b").alias("y"))
    pairs = store(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "lines-candidates")
    discard(*parts)
    return pairs


def _heads(words: DataFrame, least: int = 1) -> DataFrame:
    """Of ``least`` lines or more that share a prefix word and have one size, the earliest (``_a``)."""
    columns = [*PLACE, *PARITIES, "pos"]
    return words.groupBy("code", F.col("n_b").alias("n_a")) \
        .agg(F.min(F.struct(*[c + "_b" for c in columns])).alias("head"), F.count(F.lit(1)).alias("lines")).filter(F.col("lines") >= least) \
        .select("code", "n_a", *[F.col(f"head.{c}_b").alias(c + "_a") for c in columns])


def _meet_heads(words: DataFrame, heads: DataFrame, same: Column, similarity: float) -> DataFrame:
    met = words.join(heads, same).filter(_later("_b", "_a") & _close(similarity))
    return met.groupBy(_joined_place("_b").alias("b"), _joined_place("_a").alias("a")).agg(F.count(F.lit(1)).alias("m"))


def _likely(prefixes: DataFrame, similarity: float) -> DataFrame:
    """For a line, the earliest line of its size with which it shares most prefix words, if the filters
    allow it: one pair (a, b) a line at most, however large a group of near copies is."""
    def meet(share: Column) -> DataFrame:
        words = _exploded(prefixes, "_b").filter(_shorter_prefix(similarity, "_b") & share)
        heads = _heads(words).withColumnRenamed("code", "code_a")
        return _meet_heads(words, heads, (F.col("code") == F.col("code_a")) & (F.col("n_b") == F.col("n_a")), similarity)

    parts = _in_passes("lines-heads", meet)
    pairs = reduce(DataFrame.union, parts).groupBy("b", "a").agg(F.sum("m").alias("m"))
    likely = store(pairs.groupBy("b").agg(F.max(F.struct("m", "a")).alias("best")).select("best.a", "b"), "lines-likely")
    discard(*parts)
    return likely


def _likely_of_other_sizes(marked: DataFrame, similarity: float) -> DataFrame:
    """For an open line, ``TRIED`` of the earliest lines of all sizes (heads of a ``GROUP``) with which it shares most prefix words."""
    def meet(share: Column) -> DataFrame:
        words = _exploded(marked, "_b").filter(share)
        heads = _heads(words.filter(_shorter_prefix(similarity, "_b")), GROUP).withColumnRenamed("code", "code_a")
        return _meet_heads(words.filter("open_b"), heads, F.col("code") == F.col("code_a"), similarity)

    parts = _in_passes("lines-heads", meet)
    pairs = reduce(DataFrame.union, parts).groupBy("b", "a").agg(F.sum("m").alias("m"))
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("m")).alias("m"), "a"))), 1, TRIED)
    likely = store(pairs.groupBy("b").agg(best.alias("best")).select(F.explode("best.a").alias("a"), "b"), "lines-likely")
    discard(*parts)
    return likely


def _word_sets(pairs: DataFrame, lines: DataFrame, ranks: Column) -> DataFrame:
    """``at`` and ``codes`` of the lines in the pairs."""
    wanted = pairs.select(F.col("a").alias("at")).union(pairs.select(F.col("b").alias("at"))).distinct()
    found = lines.join(wanted, "at", "left_semi").groupBy("at").agg(F.min("line").alias("line"))
    return store(found.select("at", word_codes(F.col("line"), ranks).alias("codes")), "lines-sets")


def _verify(pairs: DataFrame, lines: DataFrame, ranks: Column, similarity: float) -> DataFrame:
    """The pairs whose word sets reach the similarity."""
    sets = _word_sets(pairs, lines, ranks)
    left = sets.select(F.col("at").alias("a"), F.col("codes").alias("ca"))
    right = sets.select(F.col("at").alias("b"), F.col("codes").alias("cb"))
    shared = F.size(F.array_intersect("ca", "cb"))
    alike = shared >= (F.size("ca") + F.size("cb") - shared) * similarity - 1e-9
    found = store(pairs.join(left, "a").join(right, "b").filter(alike).select("a", "b"), "lines-pairs")
    discard(sets, pairs)
    return found


def _similar_lines(lines: DataFrame, prefixes: DataFrame, ranks: Column, similarity: float) -> DataFrame:
    """All pairs. Both searches delete ``prefixes`` after their last reader."""
    parts = _in_passes("lines-met", lambda share: _meet(prefixes, prefixes, similarity, share))
    discard(prefixes)
    return _verify(_pairs_met(parts, similarity), lines, ranks, similarity)


def _marked(prefixes: DataFrame, settled: DataFrame) -> DataFrame:
    """``prefixes`` and whether a line is ``open``: no pair of ``settled`` has it as its later one, and it was open
    before, if ``prefixes`` say. They are deleted: tables as long as these are on disk once, the marking aside."""
    later = settled.select(*_split_place(F.col("b")), F.lit(True).alias("settled")).distinct()
    still = F.col("settled").isNull() & (F.col("open") if "open" in prefixes.columns else F.lit(True))
    marked = store(prefixes.join(later, list(PLACE), "left").withColumn("open", still).drop("settled"), "lines-marked", "zstd")
    discard(prefixes)
    return marked


def _earlier_matches(lines: DataFrame, prefixes: DataFrame, ranks: Column, similarity: float) -> DataFrame:
    """For every line that a different earlier one resembles, at least one such pair (a, b).

    First each line is compared with one likely earlier line of its size, and those still open with a few of other
    sizes. Lines settled by that need no other partner; they stay in the join only as possible earlier matches of the lines still open. So a large group of
    near copies costs a few pairs a line, and no match is missed.
    """
    first = _verify(_likely(prefixes, similarity), lines, ranks, similarity)
    half = _marked(prefixes, first)
    second = _verify(_likely_of_other_sizes(half, similarity), lines, ranks, similarity)
    settled = first.union(second)
    marked = _marked(half, second)
    still, done = marked.filter("open"), marked.filter("not open")
    # Pairs of two settled lines are not formed at all; of the others, those whose later line is open count.
    # The two joins share no pair.
    parts = _in_passes("lines-met", lambda share: _meet(marked, still, similarity, share, _later("_b", "_a") | F.col("open_a"))
                       .union(_meet(still, done, similarity, share, _later("_a", "_b"))))
    discard(marked)
    rest = _pairs_met(parts, similarity)
    return settled.union(_verify(rest, lines, ranks, similarity))


def similar_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """All pairs (a, b) of places of different lines, a before b, whose word sets reach ``similarity``.
    Equal lines are found by equality and need no pair."""
    ranks, lines = _literal(rarity_ranks(docs, text)), split_lines(docs, key, text)
    _, prefixes = _line_table(lines, ranks, similarity, min_words)
    return _similar_lines(lines, prefixes, ranks, similarity)


def judge_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                min_words: int = MIN_WORDS, all_links: bool = True) -> DataFrame:
    """``doc``, ``no``, ``at``, ``removed``, ``links`` (other texts alike) and ``class`` (place of the earliest line
    that it equals or resembles) of every line of at least ``min_words`` distinct words.

    Without ``all_links`` only what removal needs is searched: ``removed`` is the same, ``links`` and
    ``class`` come from the matches that were needed.
    """
    ranks, placed = _literal(rarity_ranks(docs, text)), split_lines(docs, key, text)
    lines, prefixes = _line_table(placed, ranks, similarity, min_words)
    search = _similar_lines if all_links else _earlier_matches
    pairs = search(placed, prefixes, ranks, similarity)
    sides = pairs.select(F.col("a").alias("at"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    linked = sides.groupBy("at").agg(F.count(F.lit(1)).alias("links"), F.min("other").alias("earliest"))
    known = _firsts(lines).join(linked, F.col("first") == F.col("at"), "left") \
        .select("h1", "h2", "first", F.coalesce("links", F.lit(0)).alias("links"), F.least("first", "earliest").alias("class"))
    return lines.join(known, ["h1", "h2"]).select(
        "doc", "no", "at", ((F.col("at") > F.col("first")) | (F.col("class") < F.col("first"))).alias("removed"), "links", "class")


def lines_report(docs: DataFrame) -> DataFrame:
    """Per document: lines with words (of any number), lines removed, links to other texts, and its earliest source: the
    document of the earliest line that one of its lines equals or resembles (its own id if none). Texts
    with one id are counted together, texts without an id each for itself."""
    docs = docs.select("doc_id", *_document("doc_id", "text"), "text")
    own = F.when(F.col("mid") >= KEYLESS, F.col("mid")).otherwise(F.lit(0))
    judged = judge_lines(docs.select("doc_id", "text"), min_words=1).select("*", *_split_place(F.col("at")))
    by_doc = judged.groupBy("hi", own.alias("mid")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("removed").alias("n_removed"), F.sum("links").alias("n_links"),
        F.min("class").alias("class"))
    return docs.select("doc_id", "hi", own.alias("mid")).join(by_doc, ["hi", "mid"], "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_lines", "n_removed", "n_links")],
        F.when(F.col("class.mid") < KEYLESS, F.col("class.hi")).alias("source_doc"))


def drop_similar_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents without the lines that repeat or resemble an earlier one; columns as they came, and
    ``n_chars``, where there is one, counted anew. A document of which only blank lines remain goes,
    unless nothing was removed from it. Different texts are different documents, also without a key or
    with the same key; exact repeats of a row stay or go together. Documents without a key come last."""
    judged = judge_lines(docs, key, text, all_links=False, **options)
    gone = judged.filter("removed").groupBy(F.col("at.hi").alias("_hi"), F.col("at.mid").alias("_mid")).agg(F.collect_set("no").alias("_gone"))
    hi, mid = _document(key, text)
    joined = docs.withColumns({"_hi": hi, "_mid": mid}).join(gone, ["_hi", "_mid"], "left")
    kept = F.array_compact(F.transform(F.split(text, "\n"), lambda l, i: F.when(~F.array_contains("_gone", i), l)))
    joined = joined.withColumn("_text", F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    joined = joined.filter(F.col("_gone").isNull() | (F.trim("_text") != ""))
    chars = {"n_chars": F.length("_text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return joined.withColumns({**chars, text: F.col("_text")}).select(*docs.columns)
