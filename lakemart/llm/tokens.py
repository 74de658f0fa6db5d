"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton lists all vocabulary pieces that end at each place of a segment; dynamic
programming carries the best score and its number of pieces, nothing else.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.common import add_columns

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_SEGMENTS = 300_000
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def read_vocabulary(path: str = DEFAULT_MODEL) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores, in id order, and the unknown id, from a public piece model file.

    Read on the driver; a vocabulary is some tens of thousands of pieces whatever the corpus.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class Counter:
    """Number of unigram tokens of a text.

    Ties: a later path replaces an earlier one only if its score is strictly greater, where paths to
    a place are met by ascending start of their last piece. A character that no piece of one
    character covers may be taken as unknown, at the lowest score less a penalty. Runs of unknown
    characters count as one token, or as their UTF-8 bytes if the vocabulary has all byte pieces.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int):
        self.pieces = ahocorasick.Automaton()
        scores: dict[str, float] = {}
        for piece, score in vocabulary:
            if piece:
                scores[piece] = score  # a repeated piece: the last counts
        for piece, score in scores.items():
            self.pieces.add_word(piece, (len(piece), score))
        if scores:
            self.pieces.make_automaton()
        self.empty = not scores
        self.unknown_score = min([s for _, s in vocabulary], default=0.0) - UNKNOWN_PENALTY
        self.bytes_known = all(f"<0x{b:02X}>" in scores for b in range(256))
        self.single = {p for p in scores if len(p) == 1}
        self.cache: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Tokens of one segment (a space mark and what follows up to the next)."""
        n = len(text)
        if not n:
            return 0
        ending: list[list] = [[] for _ in range(n + 1)]
        if not self.empty:
            for last, (length, score) in self.pieces.iter(text):
                ending[last + 1].append((length, score))
        best, count, fused = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for stop in range(1, n + 1):
            top = None
            # ascending start = descending length; an automaton lists the longest first
            for length, score in sorted(ending[stop], reverse=True):
                value = best[stop - length] + score
                if top is None or value > top:
                    top, pieces, unknown = value, count[stop - length] + 1, False
            if text[stop - 1] not in self.single:
                value = best[stop - 1] + self.unknown_score
                if top is None or value > top:
                    top, unknown = value, True
                    if self.bytes_known:
                        pieces = count[stop - 1] + len(text[stop - 1].encode("utf-8", "surrogatepass"))
                    else:
                        pieces = count[stop - 1] + (not fused[stop - 1])
            best[stop], count[stop], fused[stop] = top, pieces, unknown
        return count[n]

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        cache, total = self.cache, 0
        parts = text.split(" ")
        if len(parts) > 1 and not parts[0]:
            parts = parts[1:]  # a leading space is the mark itself
        elif parts[0].startswith(SPACE):
            parts[0] = parts[0][1:]
        for part in parts:
            known = cache.get(part)
            if known is None:
                known = sum(self.segment(SPACE + p) for p in part.split(SPACE)) if SPACE in part else self.segment(SPACE + part)
                if len(part) <= 64:
                    if len(cache) >= CACHE_SEGMENTS:
                        cache.clear()
                    cache[part] = known
            total += known
        return total


def count_tokens(docs: DataFrame, vocabulary: tuple[list[tuple[str, float]], int], text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``. Whole texts are counted, without a shuffle; null and empty texts have 0.

    Spaces become marks and begin a segment each; segments are counted on their own, frequent ones
    once per task (a cache of bounded size). The vocabulary is broadcast; it does not grow with the
    data. An existing ``n_tokens`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def start():
        counter = Counter(*shared.value)

        def work(texts: pa.Array):
            return [[counter(t) for t in texts.to_pylist()]]
        return work

    return add_columns(docs, [text], "n_tokens bigint", start)


def token_report(spark: SparkSession, docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    counted = count_tokens(docs.select("doc_id", "text"), read_vocabulary(model))
    return counted.select("doc_id", "n_tokens", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
