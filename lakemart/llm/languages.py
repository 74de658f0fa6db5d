"""Language of words and texts by a linear-chain conditional random field.

Every word is a place in the chain and every language a label. A word's evidence is the sum of learned
weights of its prefixes and suffixes, its letter n-grams, the word itself, and the language a lexicon of
frequent words gives it; learned transition weights tie neighbours together. Training sequences are
partly joined from pieces of texts in different languages, so that the transitions see switches.
Forward-backward over the whole text gives each word's label distribution.
"""

from __future__ import annotations

import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from lakemart.llm.common import add_columns

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: The same, faster, for texts without characters from U+0300 on (there, marks and other digits begin).
LATIN_WORD = re.compile(r"[^\W\d_²³¹¼½¾]+")
BEYOND_LATIN = re.compile("[^\x00-\u02ff]")
BITS = 18
#: Learned from at most so many texts of each language, the first by a hash of their id and text.
SAMPLE_ROWS = 120
#: Words of a training sequence, and the longest piece of one language in a mixed one.
SEQUENCE, PIECE = 64, 24
ROUNDS, RATE, DECAY = 16, 0.3, 1e-6
#: A lexicon word occurs so often in the sample, with this share in one language.
LEXICON_COUNT, LEXICON_SHARE = 3, 0.6
#: Words labelled together, and the length from which a text is cut into pieces joined exactly.
GROUP_WORDS, CUT = 1_000_000, 1024
CACHE_WORDS = 300_000
UNKNOWN = "und"
MODEL = "languages array<string>, lexicon array<string>, entries binary, places binary, weights binary, chain binary"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters and their marks."""
    if not text:
        return []
    text = text.lower()
    return WORD.findall(text) if BEYOND_LATIN.search(text) else LATIN_WORD.findall(text)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of many words, word by word, and their number per word: n-grams of two and three
    letters (with marks for both ends), affixes of three and four letters, and, last, the word itself."""
    code = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(w) + 2 for w in words])
    begin = np.cumsum(size) - size
    of = np.repeat(np.arange(len(words)), size)
    left = np.repeat(size, size) - (np.arange(len(code)) - begin[of])  # letters from here to the end of the word
    gram, found, owner = code, [], []
    for n in range(2, 6):
        gram = gram[:-1] * np.uint32(0x01000193) ^ code[n - 1:] * np.uint32(0x9E3779B1)
        inside = left[:len(gram)] >= n
        if n > 3:
            inside = inside & ((left[:len(gram)] == n) | (left[:len(gram)] == size[of[:len(gram)]]))
        at = np.flatnonzero(inside)
        found.append(gram[at] + np.uint32(n))
        owner.append(of[at])
    power = np.cumprod(np.full(int(size.max(initial=1)), 0x01000193, np.uint32), dtype=np.uint32)
    whole = np.add.reduceat(code * power[np.arange(len(code)) - begin[of]], begin) if len(words) else code
    found.append(whole.astype(np.uint32))
    owner.append(np.arange(len(words)))
    owner = np.concatenate(owner)
    every = np.concatenate(found) * np.uint32(0xC2B2AE35)
    every ^= every >> np.uint32(15)
    every = (every * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)
    by = np.argsort(owner, kind="stable")
    return every[by].astype(np.int64), np.bincount(owner, minlength=len(words))


def _transfers(evidence: np.ndarray, begin: np.ndarray, size: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """Per piece, the product of its steps: entering label (after the transition) to last label, up to scale."""
    by = np.argsort(-size, kind="stable")
    begin, size = begin[by], size[by]
    total = np.eye(chain.shape[0]) * evidence[begin][:, None, :]
    for t in range(1, int(size[0])):
        m = int(np.searchsorted(-size, -t, side="left"))
        step = (total[:m] @ chain) * evidence[begin[:m] + t][:, None, :]
        total[:m] = step / step.max(axis=(1, 2), keepdims=True)
    out = np.empty_like(total)
    out[by] = total
    return out


def marginals(evidence: np.ndarray, lengths: np.ndarray, start: np.ndarray, chain: np.ndarray, cut: int = CUT,
              pairs: np.ndarray | None = None) -> np.ndarray:
    """Label distribution of every word. ``evidence`` (positive, any scale per word) holds the words of all
    sequences one after the other. Long sequences are cut into pieces of ``cut`` words: products of their
    steps give what enters each piece from both sides, so the steps taken in turn stay few and the result
    is that of the whole chain. ``pairs`` receives the expected transitions inside the pieces."""
    k = len(start)
    n_pieces = -(-lengths // cut)
    owner = np.repeat(np.arange(len(lengths)), n_pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
    begin = np.repeat(np.cumsum(lengths) - lengths, n_pieces) + nth * cut
    size = np.minimum(lengths[owner] - nth * cut, cut)
    enter = np.tile(start, (len(owner), 1))
    leave = np.ones((len(owner), k))
    parts = np.flatnonzero(n_pieces[owner] > 1)
    if len(parts):
        product = dict(zip(parts.tolist(), _transfers(evidence, begin[parts], size[parts], chain)))
        followed = parts[nth[parts] + 1 < n_pieces[owner[parts]]].tolist()
        for i in followed:
            v = enter[i] @ product[i] @ chain
            enter[i + 1] = v / v.sum()
        for i in reversed(followed):
            v = chain @ (product[i + 1] @ leave[i + 1])
            leave[i] = v / v.sum()
    by = np.argsort(-size, kind="stable")
    size, begin, enter, leave = size[by], begin[by], enter[by], leave[by]
    active = np.searchsorted(-size, -np.arange(size[0]), side="left") if len(size) else np.empty(0, np.int64)
    base = np.cumsum(active) - active
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    packed = base[step] + np.repeat(np.arange(len(size)), size)  # word by word: place in order of steps
    source = np.repeat(begin, size) + step
    e = np.empty((len(packed), k))
    e[packed] = evidence[source]
    forward = np.empty_like(e)
    a = enter
    for t, m in enumerate(active.tolist()):
        if t:
            a = a[:m] @ chain
        a = a * e[base[t]:base[t] + m]
        a /= a.sum(axis=1, keepdims=True)
        forward[base[t]:base[t] + m] = a
    b = leave[:0]
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        if len(b):
            if pairs is not None:
                a = forward[base[t]:base[t] + len(b)]
                pairs += chain * ((a / ((a @ chain) * b).sum(axis=1, keepdims=True)).T @ b)
            b = b @ chain.T
            b /= b.sum(axis=1, keepdims=True)
        b = np.concatenate([b, leave[len(b):m]])
        rows = slice(base[t], base[t] + m)
        forward[rows] *= b
        b = b * e[rows]
    forward /= forward.sum(axis=1, keepdims=True)
    out = np.empty_like(e)
    out[source] = forward[packed]
    return out


class Words:
    """Incidence of features and words, and the lexicon's part."""

    def __init__(self, counts: np.ndarray, words: list[str]):
        self.feature, self.sizes = features(words)
        self.ends = np.cumsum(self.sizes)
        totals = counts.sum(axis=1)
        top = counts.argmax(axis=1)
        typical = (totals >= LEXICON_COUNT) & (counts.max(axis=1) >= LEXICON_SHARE * totals)
        self.entry = np.where(typical, top, -1)


def fit_chain(texts: list[tuple[int, str]], k: int, rounds: int = ROUNDS, seed: int = 7):
    """Weights by feature and label, lexicon and transitions, by gradient steps with adaptive rates.

    Half of the sequences are consecutive words of one text, the other half are joined from pieces of
    several. In each round the word itself and its lexicon entry are hidden for half of the words, so
    that affixes and n-grams learn to carry unseen words.
    """
    rnd = random.Random(seed)
    number: dict[str, int] = {}
    plain, pieces = [], []
    for label, text in texts:
        ids = [number.setdefault(w, len(number)) for w in words_of(text)]
        at = 0
        while at < len(ids):
            mixed = len(plain) > sum(len(p[1]) for p in pieces) / SEQUENCE
            size = rnd.randint(1, PIECE) if mixed else SEQUENCE
            (pieces if mixed else plain).append((label, ids[at:at + size]))
            at += size
    rnd.shuffle(pieces)
    sequences = [([label] * len(ids), ids) for label, ids in plain]
    labels, ids = [], []
    for label, own in pieces:
        labels, ids = labels + [label] * len(own), ids + own
        if len(ids) >= SEQUENCE:
            sequences.append((labels, ids))
            labels, ids = [], []
    if ids:
        sequences.append((labels, ids))
    lengths = np.array([len(s[1]) for s in sequences])
    word = np.concatenate([np.array(s[1]) for s in sequences])
    label = np.concatenate([np.array(s[0]) for s in sequences])
    wanted = np.eye(k)[label]
    firsts = np.cumsum(lengths) - lengths
    follows = np.ones(len(word), bool)
    follows[firsts] = False
    follows = np.flatnonzero(follows)
    counts = np.zeros((len(number), k))
    np.add.at(counts, (word, label), 1)
    table = Words(counts, list(number))
    used, own_feature = np.unique(table.feature, return_inverse=True)
    entry = np.where(table.entry >= 0, len(used) + table.entry, -1)
    n_weights = len(used) + k
    weights, start, chain = np.zeros((n_weights, k)), np.zeros(k), np.zeros((k, k))
    state = [np.zeros((n_weights, k)), np.zeros(k), np.zeros((k, k))]
    sees = np.bincount(label[follows - 1] * k + label[follows], minlength=k * k).reshape(k, k)
    owner = np.repeat(np.arange(len(number)), table.sizes)
    own_word = np.zeros(len(table.feature), bool)
    own_word[table.ends - 1] = True
    coins = np.random.RandomState(seed)
    for _ in range(rounds):
        shown = coins.rand(len(number)) < 0.5
        live = ~own_word | shown[owner]
        feature, at = own_feature[live], owner[live]
        lex = np.flatnonzero(shown & (entry >= 0))
        emission = np.stack([np.bincount(at, weights[feature, j], minlength=len(number)) for j in range(k)], 1)
        emission[lex] += weights[entry[lex]]
        evidence = np.exp(emission - emission.max(axis=1, keepdims=True))
        expected = np.zeros((k, k))
        p = marginals(evidence[word], lengths, _positive(start), _positive(chain), pairs=expected)
        error = p - wanted
        by_word = np.stack([np.bincount(word, error[:, j], minlength=len(number)) for j in range(k)], 1)
        g = np.stack([np.bincount(feature, by_word[at, j], minlength=n_weights) for j in range(k)], 1)
        np.add.at(g, entry[lex], by_word[lex])
        scale = 1.0 / len(sequences)
        for value, gradient, seen in ((weights, g, state[0]), (start, error[firsts].sum(axis=0), state[1]),
                                      (chain, expected - sees, state[2])):
            gradient = gradient * scale + DECAY * value
            seen += gradient * gradient
            value -= RATE * gradient / (np.sqrt(seen) + 1e-8)
    return list(number), table.entry, np.r_[used, (1 << BITS) + np.arange(k)], weights, start, chain


def _positive(scores: np.ndarray) -> np.ndarray:
    return np.exp(scores - scores.max())


def train_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                    sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> dict:
    """The model, learned in one task from at most ``sample_rows`` texts per language (a documented
    bound), taken by a hash of id and text and in that order, so that a repeat gives the same model. Rows
    without a language or without a letter teach nothing."""
    place = Window.partitionBy("lang").orderBy("o", "k", "t")
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")) \
        .select(F.col(lang).alias("lang"), F.col(key).cast("string").alias("k"), F.col(text).alias("t"),
                F.xxhash64(key, text).alias("o")) \
        .withColumn("place", F.row_number().over(place)).filter(F.col("place") <= sample_rows)

    def learn(batches):
        texts = [(r["lang"], r["t"]) for batch in batches for r in batch.to_pylist()]
        if not texts:
            return
        names = sorted({lang for lang, _ in texts})
        words, entry, used, weights, start, chain = fit_chain([(names.index(x), t) for x, t in texts], len(names), rounds)
        known = np.flatnonzero(entry >= 0)
        columns = [names, [words[i] for i in known.tolist()], entry[known].astype(np.int32).tobytes(),
                   used.astype(np.int32).tobytes(), weights.astype(np.float32).tobytes(),
                   np.concatenate([start[None], chain]).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in columns],
                                         names=["languages", "lexicon", "entries", "places", "weights", "chain"])

    model = rows.select("lang", "o", "k", "t").repartition(1).sortWithinPartitions("o", "k", "t", "lang") \
        .select("lang", "t").mapInArrow(learn, MODEL).first()
    if model is None:
        return {"languages": []}
    k = len(model["languages"])
    chain = np.frombuffer(model["chain"]).reshape(k + 1, k)
    return {"languages": model["languages"], "start": chain[0], "chain": chain[1:],
            "lexicon": dict(zip(model["lexicon"], np.frombuffer(model["entries"], np.int32).tolist())),
            "places": np.frombuffer(model["places"], np.int32),
            "weights": np.frombuffer(model["weights"], np.float32).reshape(-1, k)}


class Evidence(dict):
    """Word to row number; the rows hold the evidence of the words met so far. Cleared when full."""

    def __init__(self, model: dict):
        super().__init__()
        k = len(model["languages"])
        self.weights = np.zeros(((1 << BITS) + k, k), np.float32)
        self.weights[model["places"]] = model["weights"]
        self.lexicon = model["lexicon"]
        self.waiting: list[str] = []
        self.rows = np.empty((1024, k))

    def __missing__(self, word: str) -> int:
        self.waiting.append(word)
        self[word] = number = len(self)
        return number

    def table(self) -> np.ndarray:
        """Rows of all words, those of new words computed together."""
        if self.waiting:
            done = len(self) - len(self.waiting)
            while len(self.rows) < len(self):
                self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
            flat, sizes = features(self.waiting)
            total = np.add.reduceat(self.weights[flat].astype(np.float64), np.cumsum(sizes) - sizes)
            entry = np.array([self.lexicon.get(w, -1) for w in self.waiting])
            listed = np.flatnonzero(entry >= 0)
            total[listed] += self.weights[(1 << BITS) + entry[listed]]
            # Kept above zero, so that no word can rule a label out by rounding.
            self.rows[done:len(self)] = np.maximum(np.exp(total - total.max(axis=1, keepdims=True)), 1e-100)
            self.waiting = []
        return self.rows

    def trim(self) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()


def label_texts(texts: list[str | None], model: dict, evidence: Evidence) -> list[tuple[str, float, list[dict]]]:
    """Language, its share of the words, and spans of one language for each text."""
    names = model["languages"]
    out: list = [(UNKNOWN, 0.0, [])] * len(texts)
    start, chain = _positive(model["start"]), _positive(model["chain"])
    group, ids = [], []

    def flush():
        lengths = np.array([n for _, n in group])
        p = marginals(evidence.table()[np.array(ids)], lengths, start, chain)
        begins = np.cumsum(lengths) - lengths
        share = np.add.reduceat(p, begins) / lengths[:, None]
        best = share.argmax(axis=1)
        label = p.argmax(axis=1)
        heads = np.ones(len(label), bool)
        heads[1:] = label[1:] != label[:-1]
        heads[begins] = True
        heads = np.flatnonzero(heads)
        sizes = np.diff(np.r_[heads, len(label)])
        of = np.searchsorted(begins, heads, side="right") - 1
        spans: list[list[dict]] = [[] for _ in group]
        for i, first, n, at in zip(of.tolist(), (heads - begins[of]).tolist(), sizes.tolist(), label[heads].tolist()):
            spans[i].append({"start": first, "words": n, "lang": names[at]})
        for j, (i, _) in enumerate(group):
            out[i] = (names[best[j]], min(1.0, float(share[j, best[j]])), spans[j])
        group.clear(), ids.clear()
        evidence.trim()

    for i, text in enumerate(texts):
        own = words_of(text)
        if not own:
            continue
        ids.extend(map(evidence.__getitem__, own))
        group.append((i, len(own)))
        if len(ids) >= GROUP_WORDS:
            flush()
    if group:
        flush()
    return out


def identify_languages(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``language``, ``language_score`` and ``language_spans`` (word number, words, language).

    The language is the one with the largest expected share of the words (ties: first by name), the
    score that share. Whole texts are labelled where they are, in time and memory linear in their
    length. A null text, or one without a letter, is ``und`` with score 0 and no spans; so is every
    text if the model has no language. Repeated rows get equal answers. Columns of the three result
    names are replaced, others pass through. The model is broadcast: at most 2^18 weights a language
    and the frequent words of the bounded sample.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value
        evidence = Evidence(own) if own["languages"] else None

        def work(texts: pa.Array):
            if evidence is None:
                return [UNKNOWN] * len(texts), [0.0] * len(texts), [[]] * len(texts)
            found = label_texts(texts.to_pylist(), own, evidence)
            return [f[0] for f in found], [f[1] for f in found], [f[2] for f in found]
        return work

    fields = "language string, language_score double, language_spans array<struct<start:bigint,words:bigint,lang:string>>"
    return add_columns(docs, [text], fields, start)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def language_report(docs: DataFrame) -> DataFrame:
    """Predicted language and its share per document, learned from the rows that are not held out. A
    document without an id is not held out."""
    model = train_languages(docs.select("doc_id", "text", "lang").filter(~held_out()))
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), F.col("language").alias("lang_pred"),
                        F.col("language_score").alias("score"))
