"""Removal of repeated byte strings by a hash-compared suffix sort.

Every ``span``-byte window goes, packed with its neighbours, to the bucket of its
minimiser (``superkmers``), so equal windows meet. In a bucket the suffixes that start the
windows are sorted: first by minimiser and eight bytes, then by mergesort. Two suffixes are
compared through prefix polynomial hashes: a binary search finds the length they share, the
byte after it decides. Hashes may collide, so every pair of sorted neighbours is compared
byte by byte in the end; a group found out of order is sorted by its bytes.

Equal strings of a bucket are sorted once, and a string alone with its minimiser is not
sorted at all: none of its windows can occur elsewhere.

Defined results: a null text is empty; a text under ``span`` bytes keeps all of them; equal texts
and repeated rows lose all their bytes from ``span`` on; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not read. A kept text can end within a UTF-8
sequence, so it is binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.blocks import U64, byte_prefix, keyed, ranges, shift_factor
from millrace.llm.settings import tuned
from millrace.llm.superkmers import Strings, Units, covered, repeated_windows

SPAN, SEED = 200, 24
BUCKET_BYTES = 8 << 20


def byte_units(data: np.ndarray, offsets: np.ndarray) -> Units:
    at = np.arange(len(data) + 1)
    return Units(byte_prefix(data), offsets, at[:-1], at[1:])


class Suffixes:
    """The suffixes of a byte string, compared over their first ``span`` bytes."""

    def __init__(self, data: np.ndarray, span: int):
        self.span = span
        self.data = np.concatenate([data, np.zeros(span + 8, np.uint8)])
        self.prefix = byte_prefix(self.data)
        n = len(data) + span
        self.eight = np.zeros(n, U64)  # eight bytes from each position, in the order of bytes
        for j in range(8):
            self.eight = (self.eight << U64(8)) | self.data[j : j + n].astype(U64)

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common prefix, at most ``span``, by binary search over hashes."""
        p, q = np.minimum(p, q), np.maximum(p, q)
        factor = shift_factor(q - p, len(self.prefix))
        length = np.zeros(len(p), np.int64)
        at_p, at_q = self.prefix[p], self.prefix[q]
        step = 1 << (self.span.bit_length() - 1)
        while step:
            to = np.minimum(length + step, self.span)
            next_p, next_q = self.prefix[p + to], self.prefix[q + to]
            same = (length + step <= self.span) & ((next_p - at_p) * factor == next_q - at_q)
            length[same] += step
            at_p, at_q = np.where(same, next_p, at_p), np.where(same, next_q, at_q)
            step >>= 1
        return length

    def less(self, p: np.ndarray, q: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix p stands before q; equal ones do where ``or_equal`` says so."""
        length = self.common(p, q)
        whole = length == self.span
        return np.where(whole, or_equal, self.data[p + length] < self.data[q + length])

    def order(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 by the bytes themselves."""
        out = np.zeros(len(p), np.int8)
        open_ = np.arange(len(p))
        for at in range(0, self.span, 8):
            a, b = self.eight[p[open_] + at], self.eight[q[open_] + at]
            rest = self.span - at
            if rest < 8:
                a, b = a >> U64(8 * (8 - rest)), b >> U64(8 * (8 - rest))
            out[open_[a < b]], out[open_[a > b]] = -1, 1
            open_ = open_[a == b]
            if not len(open_):
                break
        return out

    def merge_sort(self, places: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Sort the suffixes within each group (neighbours of one ``group`` value); flags of those that occur twice.

        Runs are merged level by level, those of all groups at once: the new slot of a suffix is its
        rank in its own run plus its rank in the neighbouring run, found by binary search. Of
        equal suffixes one goes on, so a passage in many strings is not sorted over and over.
        A group that a colliding hash left out of order, or short of a suffix, is sorted by its bytes.
        """
        flags, wrong = np.zeros(len(places), bool), [group[:0]]
        order = run = np.arange(len(places))
        while True:
            begin = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            length = np.diff(np.append(begin, len(run)))
            owner = group[order[begin]]
            runs = np.arange(len(begin))
            odd = ((runs - np.searchsorted(owner, owner)) & 1) == 1
            other = np.where(odd, runs - 1, np.minimum(runs + 1, len(runs) - 1))
            paired = (other != runs) & (owner[other] == owner)
            if not paired.any():
                break
            own = np.repeat(runs, length)
            slots = np.flatnonzero(paired[own])
            mine, rival_run = own[slots], other[own[slots]]
            low, high = np.zeros(len(slots), np.int64), length[rival_run].copy()
            suffix, start, right = places[order[slots]], begin[rival_run], odd[mine]
            open_ = np.arange(len(slots))
            while len(open_):
                middle = (low[open_] + high[open_]) >> 1
                rival = places[order[start[open_] + middle]]
                before = self.less(rival, suffix[open_], right[open_])  # equal ones: the left run goes first
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            to = np.minimum(begin[mine], start) + slots - begin[mine] + low
            merged = order.copy()
            merged[to] = order[slots]
            twice = np.bincount(to, minlength=len(order)) > 1
            wrong.append(group[order[slots[twice[to]]]])
            run = np.repeat(np.where(odd & paired, runs - 1, runs), length)
            inner = np.flatnonzero(run[1:] == run[:-1])
            one, two = places[merged[inner]], places[merged[inner + 1]]
            like = np.flatnonzero(self.common(one, two) == self.span)
            equal = inner[like[self.order(one[like], two[like]) == 0]]
            flags[merged[equal]] = flags[merged[equal + 1]] = True
            keep = np.ones(len(merged), bool)
            keep[equal + 1] = False
            order, run = merged[keep], run[keep]
        inner = np.flatnonzero(run[1:] == run[:-1])
        signs = self.order(places[order[inner]], places[order[inner + 1]])
        wrong.append(group[order[inner[signs >= 0]]])
        for g in np.unique(np.concatenate(wrong)).tolist():
            members = np.flatnonzero(group == g)
            raw = [self.data[p : p + self.span].tobytes() for p in places[members].tolist()]
            by_bytes = sorted(range(len(raw)), key=raw.__getitem__)
            flags[members] = False
            for i, j in zip(by_bytes, by_bytes[1:]):
                if raw[i] == raw[j]:
                    flags[members[[i, j]]] = True
        return flags

    def repeated(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Which of the suffixes at ``starts`` agree with another one of their group over ``span`` bytes."""
        order = np.lexsort((self.eight[starts], group))
        key, part = self.eight[starts[order]], group[order]
        tie = np.cumsum(np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1]))) if len(order) else order
        tied = np.flatnonzero(np.bincount(tie)[tie] > 1) if len(order) else order
        flags = np.zeros(len(starts), bool)
        if len(tied):
            flags[order[tied]] = self.merge_sort(starts[order[tied]], tie[tied])
        return flags


def count_suffixes(strings: Strings, span: int) -> np.ndarray:
    """Flags of the windows of a bucket, string after string, that occur more than once."""
    lengths = np.diff(strings.offsets)
    windows = np.maximum(lengths - span + 1, 0)
    raw = strings.data.tobytes()
    seen: dict[bytes, int] = {}
    kind = np.empty(len(lengths), np.int64)  # equal strings of equal minimiser are one kind
    heads: list[int] = []
    for i, (a, b) in enumerate(zip(strings.offsets[:-1].tolist(), strings.offsets[1:].tolist())):
        kind[i] = seen.setdefault(raw[a:b], len(heads))
        if kind[i] == len(heads):
            heads.append(i)
    del seen
    head = np.array(heads, np.int64)
    known = np.bincount(kind, minlength=len(head)) > 1
    known[kind[strings.known]] = True
    multi = np.zeros(len(head), bool)
    multi[kind[strings.multi]] = True
    _, group, size = np.unique(strings.least[head], return_inverse=True, return_counts=True)
    flags = [np.full(n, k) for n, k in zip(windows[head].tolist(), known.tolist())]
    sort = np.flatnonzero((size[group] > 1) | multi & ~known)
    if len(sort):
        chosen = strings.take(head[sort])
        counts = windows[head[sort]]
        starts = np.repeat(chosen.offsets[:-1], counts) + ranges(counts)
        found = Suffixes(chosen.data, span).repeated(starts, np.repeat(group[sort], counts))
        found |= np.repeat(known[sort], counts)
        for i, part in zip(sort.tolist(), np.split(found, np.cumsum(counts)[:-1])):
            flags[i] = part
    return np.concatenate([flags[k] for k in kind.tolist()]) if len(kind) else np.zeros(0, bool)


def repeated_byte_windows(docs: DataFrame, span: int = SPAN, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(_k1, _k2, spans) of the texts that hold a string of ``span`` bytes that starts elsewhere too."""
    return repeated_windows(
        docs, seed, span, bucket_bytes, span, byte_units,
        lambda strings: count_suffixes(strings, span),
        lambda strings: np.maximum(np.diff(strings.offsets) - span + 1, 0),
    )


def remove_repeats(docs: DataFrame, span: int = SPAN, seed: int = SEED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every text without the bytes of its repeated strings."""
    return _kept(docs, span, seed, "kept binary", pa.binary(), lambda kept: kept)


def repeat_digests(docs: DataFrame, span: int = SPAN, seed: int = SEED) -> DataFrame:
    """As ``remove_repeats`` with the SHA-256 of the kept bytes in their place."""
    return _kept(docs, span, seed, "kept_sha256 string", pa.string(), lambda kept: hashlib.sha256(kept).hexdigest())


def _kept(docs: DataFrame, span: int, seed: int, column: str, kind: pa.DataType, shown) -> DataFrame:
    tuned(docs.sparkSession)
    name = column.split()[0]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, runs, kept = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                data = text.encode()
                gone = covered(spans, len(data), span)
                totals.append(len(data))
                removed.append(0 if gone is None else int(gone.sum()))
                runs.append(0 if gone is None else int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                if gone is not None:
                    data = np.frombuffer(data, np.uint8)[~gone].tobytes()
                kept.append(shown(data))
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (totals, removed, runs)), pa.array(kept, kind)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", name],
            )

    return (
        keyed(docs).join(repeated_byte_windows(docs, span, seed), ["_k1", "_k2"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(apply, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {column}")
    )
