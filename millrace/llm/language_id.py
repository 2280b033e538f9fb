"""Language of a text, word by word, by a linear-chain conditional random field.

Words are runs of letters (ASCII letters, or any byte from 0x80 on), in lower case. A word's
score for a language is a sum of learned weights: its affixes of one to three bytes, its
three-byte grams, and a lexicon of words seen in training. Learned transitions between the
languages of neighbouring words make runs of one language, so a text that switches between
languages gets a label for each of its words by forward-backward. A text's language is the one
with the most expected words, and the share of these words is its score.

The field is fitted on at most ``PER_LANGUAGE`` labelled texts of up to ``TRAIN_BYTES`` bytes
for each language, chosen by a hash of the id. Pieces of different texts are strung together,
so that it sees languages change. Prediction reads whole texts and nothing but the text.

The score only weighs the learned languages against each other. Whether a text is in any of them
(``accepted``) is told by the share of its three-byte grams that the labelled texts hold. A language's
limit is ``KNOWN`` times what all but one in a hundred of its pieces of ``PIECE`` words reach, when
the grams come from the other half of the labelled texts.

Defined results: a null text, and one without a letter, is ``und`` with score 0, as is every
text when nothing is labelled; repeated rows give repeated results; columns other than
``doc_id``, ``text`` and (for the fit) ``lang`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import crf
from millrace.llm.blocks import LETTER, U64, Words, blocks, byte_prefix, folded_words, lean, mix, ranges, span_hash
from millrace.llm.settings import tuned

PER_LANGUAGE, TRAIN_BYTES = 150, 8000
SLOTS = 1 << 16  # weights for each kind of affix and for the grams
KINDS = 7
LEXICON = 1 << 18
ROUNDS = 12
UNKNOWN = "und"
ACCEPTED = 0.3  # a short clean text may be this unsure
KNOWN, PIECE = 0.6, 4


def held_out() -> Column:
    """Documents no fit may see."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def letter_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return folded_words(data, offsets, LETTER)


def affixes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and its weight slots: three prefixes and three suffixes."""
    prefix = byte_prefix(words.data)
    slots = []
    for n in (1, 2, 3):
        for kind, a, b in ((2 * n - 2, words.starts, np.minimum(words.starts + n, words.ends)),
                           (2 * n - 1, np.maximum(words.ends - n, words.starts), words.ends)):
            slots.append(kind * SLOTS + (mix(span_hash(prefix, a, b)) >> U64(48)).astype(np.int64))
    return mix(span_hash(prefix, words.starts, words.ends)), np.stack(slots, 1)


def grams(words: Words) -> np.ndarray:
    """Slot of the three bytes around every byte, for words with a zero before and after them."""
    d = np.concatenate([[0], words.data, [0]]).astype(U64)
    code = d[:-2] | d[1:-1] << U64(8) | d[2:] << U64(16)
    return (KINDS - 1) * SLOTS + ((code * U64(0x9E3779B97F4A7C15)) >> U64(48)).astype(np.int64)


def _codes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The three bytes around every byte of a word as a number, and the places where the words begin."""
    d = np.concatenate([[0], words.data, [0]]).astype(np.int32)
    length = words.ends - words.starts
    at = np.repeat(words.starts, length) + ranges(length)
    return (d[:-2] | d[1:-1] << 8 | d[2:] << 16)[at], np.concatenate([[0], np.cumsum(length)])


def known_share(known: np.ndarray, words: Words, first: np.ndarray) -> np.ndarray:
    """Share of known grams among those of words ``first[i]`` to ``first[i + 1]``."""
    codes, begin = _codes(words)
    total = np.concatenate([[0], np.cumsum(known[codes])])[begin]
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(begin[first[1:]] - begin[first[:-1]], 1)


def _evidence(words: Words, label: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams of the labelled texts, least share of them for a text of each language)."""
    codes, begin = _codes(words)
    size = np.diff(begin)
    half = np.repeat(np.arange(len(words.first) - 1) % 2, np.diff(words.first))  # texts are sorted, so this splits each language
    first = np.unique(np.concatenate([words.first, *(np.arange(a, b, PIECE) for a, b in zip(words.first[:-1], words.first[1:]))]))
    first = first.astype(np.int64)
    known, shares = np.zeros(1 << 24, bool), np.zeros(len(first) - 1)
    for part in (0, 1):
        own = np.zeros(1 << 24, bool)
        own[codes[np.repeat(half == part, size)]] = True
        known |= own
        other = half[first[:-1]] != part
        shares[other] = known_share(own, words, first)[other]
    of = label[first[:-1]]
    least = [KNOWN * np.quantile(shares[of == k], 0.01) if (of == k).any() else 0.0 for k in range(languages)]
    return known, np.array(least)


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # affix and gram slots x languages
    lexicon: np.ndarray  # hash of the word in a lexicon slot
    entries: np.ndarray  # lexicon slots x languages
    transitions: np.ndarray
    known: np.ndarray  # whether the labelled texts hold these three bytes
    least: np.ndarray  # share of known grams that a text of each language has at least

    def scores(self, words: Words) -> np.ndarray:
        hashes, slots = affixes(words)
        at = (hashes >> U64(64 - 18)).astype(np.int64)
        out = np.where((self.lexicon[at] == hashes)[:, None], self.entries[at], 0).astype(np.float64)
        for k in range(slots.shape[1]):
            out += self.weights[slots[:, k]]
        around = self.weights[grams(words)]
        bounds = np.stack([words.starts, words.ends], 1).ravel()
        if len(bounds) and bounds[-1] == len(around):
            around = np.concatenate([around, np.zeros((1, around.shape[1]), around.dtype)])
        out += np.add.reduceat(around, bounds, axis=0)[::2] if len(bounds) else 0
        return out

    def languages_of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Words]:
        """(posteriors of the words, expected share of each language in each text, words of each text, words)."""
        words = letter_words(data, offsets)
        counts = np.diff(words.first)
        posterior = crf.marginals(self.scores(words), words.first, self.transitions)
        total = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(posterior, 0)])
        share = (total[words.first[1:]] - total[words.first[:-1]]) / np.maximum(counts, 1)[:, None]
        return posterior, share, counts, words


def training_sample(docs: DataFrame, allowed: Column, per_language: int = PER_LANGUAGE, most_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(text, lang): a bounded number of labelled texts for each language, the same whatever the partitions."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    ids = docs.filter(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & (F.octet_length("text") <= most_bytes) & F.col("text").rlike("[A-Za-z\\x{80}-\\x{10FFFF}]"))
    ranked = ids.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= per_language).select("text", "lang")


def fit(sample: list[tuple[str, str]], seed: int = 11) -> LanguageModel | None:
    """A field fitted on a bounded list of (text, language)."""
    sample = sorted(sample)
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return None
    raw = [text.encode() for text, _ in sample]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    words = letter_words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    label = np.repeat([languages.index(lang) for _, lang in sample], np.diff(words.first))
    hashes, slots = affixes(words)
    _, head, types, seen = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    # Features of each distinct word.
    lexical = np.flatnonzero(seen >= 2)
    at = (hashes[head[lexical]] >> U64(64 - 18)).astype(np.int64)
    lexicon = np.zeros(LEXICON, U64)
    lexicon[at] = hashes[head[lexical]]
    kept = lexicon[at] == hashes[head[lexical]]
    base = KINDS * SLOTS
    around = grams(words)
    length = (words.ends - words.starts)[head]
    features = np.concatenate([slots[head].ravel(), around[np.repeat(words.starts[head], length) + ranges(length)], base + at[kept]])
    owner = np.concatenate([np.repeat(np.arange(len(head)), slots.shape[1]), np.repeat(np.arange(len(head)), length), lexical[kept]])
    # Sequences of pieces of different texts.
    rng = np.random.default_rng(seed)
    pieces = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        while a < b:
            to = min(b, a + int(rng.integers(4, 40)))
            pieces.append(np.arange(a, to))
            a = to
    pieces = [pieces[i] for i in rng.permutation(len(pieces))]
    lengths = [sum(map(len, pieces[i : i + 6])) for i in range(0, len(pieces), 6)]
    order = np.concatenate(pieces)
    first = np.concatenate([[0], np.cumsum(lengths)])
    used, features = np.unique(features, return_inverse=True)
    learned, transitions = crf.fit(features, owner, types[order], label[order], first, len(languages), len(used), ROUNDS)
    weights = np.zeros((base + LEXICON, len(languages)), np.float32)
    weights[used] = learned
    return LanguageModel(languages, weights[:base], lexicon, weights[base:], transitions, *_evidence(words, label, len(languages)))


def fit_on(docs: DataFrame, allowed: Column) -> LanguageModel | None:
    return fit([(r.text, r.lang) for r in training_sample(docs, allowed).collect()])


def _texts(field: LanguageModel | None, data: np.ndarray, offsets: np.ndarray):
    """(language, score, words, switches) of a block of texts."""
    n = len(offsets) - 1
    names, score = [UNKNOWN] * n, np.zeros(n)
    counts, switches = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if field is not None:
        posterior, share, counts, words = field.languages_of(data, offsets)
        best = share.argmax(1)
        state = posterior.argmax(1)
        turn = np.concatenate([[0], np.cumsum(state[1:] != state[:-1])]) if len(state) else np.zeros(0, np.int64)
        ascii_letters = np.concatenate([[0], np.cumsum(LETTER[data] & (data < 128))])
        plain = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
        for i in np.flatnonzero(counts).tolist():
            text = data[offsets[i] : offsets[i + 1]]
            if plain[i] or any(map(str.isalpha, text.tobytes().decode("utf-8", "replace"))):
                names[i], score[i] = field.languages[best[i]], min(1.0, float(share[i, best[i]]))
                switches[i] = turn[words.first[i + 1] - 1] - turn[words.first[i]]
    return names, score, counts, switches


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches), one row for each row of ``docs``.

    ``n_switches`` counts neighbouring words of different most probable language.
    """
    spark = tuned(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            names, score, counts, switches = _texts(shared.value, data, offsets)
            yield pa.record_batch([rows.column("doc_id"), pa.array(names), pa.array(score), pa.array(counts), pa.array(switches)],
                                  ["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(lean(apply), "doc_id bigint, lang_pred string, score double, n_words bigint, n_switches bigint")


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the labelled texts that are not held out, predict for all."""
    tuned(docs.sparkSession)
    found = predict(docs, fit_on(docs, ~held_out()))
    return found.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))


def accepted(docs: DataFrame, least: float = ACCEPTED) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in a learned language by at least ``least`` of its words.

    A text with fewer known grams than its language's limit is in none of them.
    """
    shared = tuned(docs.sparkSession).sparkContext.broadcast(fit_on(docs, ~held_out()))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            field = shared.value
            names, score, _, _ = _texts(field, data, offsets)
            good = np.array([n != UNKNOWN and s >= least for n, s in zip(names, score)], bool)
            if good.any():
                words = letter_words(data, offsets)
                limit = dict(zip(field.languages, field.least))
                good &= known_share(field.known, words, words.first) >= np.array([limit.get(n, 0.0) for n in names])
            yield rows.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(lean(apply), docs.schema)
