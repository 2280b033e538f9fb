"""Removal of repeated word windows by super-k-mer partitioning.

Every window of ``span`` consecutive words goes, packed with its neighbours, to the
bucket of its minimiser (``superkmers``). There the windows are sorted by a 64-bit hash
and equal neighbours are compared word by word, so the counts are exact.

Defined results: a null or empty text has no words; a text of fewer than ``span`` words
loses none; repeated rows and equal texts lose all words that windows cover; an empty table
gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.blocks import U64, keyed, mix, prefix_hash, span_hash, word_bounds, word_hashes
from millrace.llm.settings import tuned
from millrace.llm.superkmers import Strings, Units, covered, repeated_windows

SPAN, SEED = 35, 4
BUCKET_BYTES = 16 << 20


def word_units(data: np.ndarray, offsets: np.ndarray) -> Units:
    starts, ends, first = word_bounds(data, offsets)
    return Units(prefix_hash(word_hashes(data, starts, ends)), first, starts, ends)


def count_windows(strings: Strings, span: int) -> np.ndarray:
    """Flags of the windows of a bucket, string after string, that occur more than once."""
    units = word_units(strings.data, strings.offsets)
    per = np.maximum(np.diff(units.first) - span + 1, 0)
    owner = np.repeat(np.arange(len(per)), per)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per) + units.first[owner]
    hashes = mix(span_hash(units.prefix, at, at + span))
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    heads = order.copy()  # the first window of each run of equal hashes
    begin = np.flatnonzero(np.append(True, ~same)) if len(order) else np.zeros(0, np.int64)
    heads[:] = np.repeat(order[begin], np.diff(np.append(begin, len(order))))
    head = np.empty_like(heads)
    head[order] = heads
    flags = strings.known[owner].copy()
    follows = np.flatnonzero(head != np.arange(len(head)))
    raw = strings.data.tobytes()

    def text(window: int, more: int) -> bytes:
        return raw[units.starts[at[window]] : units.ends[at[window + more] + span - 1]]

    # Runs of neighbouring windows whose heads are neighbours too are compared as one string.
    steps = np.diff(follows)
    joined = (steps == 1) & (np.diff(head[follows]) == 1) & (owner[follows[1:]] == owner[follows[:-1]]) & (
        owner[head[follows[1:]]] == owner[head[follows[:-1]]]) if len(follows) else np.zeros(0, bool)
    begin = np.flatnonzero(np.append(True, ~joined)) if len(follows) else np.zeros(0, np.int64)
    wrong: list[int] = []
    for i, j in zip(begin.tolist(), np.append(begin[1:], len(follows)).tolist()):
        p, more = int(follows[i]), j - i - 1
        q = int(head[p])
        one, other = text(p, more), text(q, more)
        if one == other or one.split() == other.split():
            flags[p : p + more + 1] = True
            flags[q : q + more + 1] = True
        else:
            wrong += follows[i:j].tolist()
    if wrong:  # a collision: those hashes are counted by their words
        counts: dict[bytes, list[int]] = {}
        for w in np.flatnonzero(np.isin(hashes, hashes[wrong])).tolist():
            counts.setdefault(b" ".join(text(w, 0).split()), []).append(w)
        for members in counts.values():
            flags[members] = len(members) > 1 or bool(strings.known[owner[members]].any())
    return flags


def repeated_word_windows(docs: DataFrame, span: int = SPAN, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(_k1, _k2, spans) of the texts that hold a window of ``span`` words that starts elsewhere too."""
    return repeated_windows(
        docs, seed, span, bucket_bytes, 6 * span, word_units,
        lambda strings: count_windows(strings, span),
        lambda strings: np.maximum(np.diff(word_bounds(strings.data, strings.offsets)[2]) - span + 1, 0),
    )


def remove_repeats(docs: DataFrame, span: int = SPAN, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every text without the words of its repeated windows, joined by one space."""
    return _kept(docs, span, seed, "kept string", lambda kept: kept.decode("utf-8", "replace"))


def repeat_digests(docs: DataFrame, span: int = SPAN, seed: int = SEED) -> DataFrame:
    """As ``remove_repeats`` with the SHA-256 of the kept text in its place."""
    return _kept(docs, span, seed, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest())


def _kept(docs: DataFrame, span: int, seed: int, column: str, shown) -> DataFrame:
    tuned(docs.sparkSession)
    name = column.split()[0]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text.encode().split()
                gone = covered(spans, len(words), span)
                totals.append(len(words))
                if gone is not None:
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                removed.append(totals[-1] - len(words))
                kept.append(shown(b" ".join(words)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                                   pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", name])

    return (
        keyed(docs).join(repeated_word_windows(docs, span, seed), ["_k1", "_k2"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(apply, f"doc_id bigint, n_words bigint, n_removed bigint, {column}")
    )
