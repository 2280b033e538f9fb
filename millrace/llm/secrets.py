"""Secrets in texts: three fixed patterns, and what a conditional random field adds to them.

Tokens are runs of letters, digits and ``_+/-`` (or other non-ASCII bytes), and runs of other
marks between white space. A linear-chain field tags each as B (a secret begins), I (it goes
on) or O, from its shape (length, kinds of characters, changes between them, share of
digits), the shapes and words around it and the look of the whole file, decoded by Viterbi. It is
fitted on a bounded sample of the documents themselves, labelled by the patterns: at most ``TEXTS`` that
match and ``TEXTS`` others, of up to ``TRAIN_BYTES`` bytes. Runs of tokens it tags that no
pattern covers become spans of kind ``crf``; the spans of the patterns always stay.

Positions count code points, the end is exclusive.

Defined results: a null text is empty and has no spans; where nothing matches there is nothing
to learn from and nothing is added; repeated rows give repeated results; columns other than
``doc_id`` and ``text`` are not read (``redacted`` passes the others on).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import crf
from millrace.llm.blocks import IS_SPACE, U64, WORD, blocks, byte_prefix, lean, mix, span_hash, text_arrays
from millrace.llm.settings import tuned

TEXTS, TRAIN_BYTES, ROUNDS = 300, 20_000, 40
KINDS = ("assign", "access", "hex", "crf")
MASK = "[SECRET]"

# The patterns every scan must report.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# Coarser than the patterns; chooses texts to learn from.
LIKELY = r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"

_TOKEN = WORD.copy()
_TOKEN[[ord(c) for c in "_+/-"]] = True
_CLASS = np.zeros(256, np.uint8)  # other, small, capital, digit, joining mark, high byte
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 5
_CLASS[[ord(c) for c in "_+/-"]] = 4
_NOT_HEX = np.ones(256, bool)
_NOT_HEX[[*range(48, 58), *range(97, 103)]] = False
_LENGTHS = np.array([2, 3, 6, 10, 16, 24, 40])

_SHAPES, _WORDS, _FILES = 8 * 32 * 2, 1 << 12, 64
# Where the slots of each feature begin: shape, changes, digits, shapes and words before and after, file.
_SIZES = [_SHAPES, 40, 40, _SHAPES, _SHAPES, _SHAPES, _WORDS, _WORDS, _FILES]
_STARTS = np.concatenate([[0], np.cumsum(_SIZES)])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _values(text: str) -> list[tuple[int, int]]:
    """The secrets proper: the value of an assignment, the whole of the others."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    return out + [(a, b) for a, kind, b in base_spans(text) if kind]


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    slots: np.ndarray  # tokens x features


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """The tokens of a block of texts and the weight slot of each of their features."""
    kind = np.where(IS_SPACE[data], 0, np.where(_TOKEN[data], 1, 2)).astype(np.uint8)
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    marks = np.flatnonzero(edge)
    starts, ends = marks[:-1], marks[1:]
    good = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[good], ends[good]
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Tokens(starts, ends, first, np.zeros((0, len(_SIZES)), np.int64))
    size = ends - starts
    length = np.searchsorted(_LENGTHS, size, "right")
    group = _CLASS[data]

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[ends] - total[starts]

    held = sum((count(group == c) > 0).astype(np.int64) << (c - 1) for c in range(1, 6))
    shape = (length * 32 + held) * 2 + (count(_NOT_HEX[data]) == 0)
    turn = np.zeros(len(data), bool)
    turn[1:] = group[1:] != group[:-1]
    digits = count(group == 3)
    changes = np.searchsorted([1, 2, 4, 8], count(turn) - turn[starts], "right")
    share = np.ceil(4 * digits / size).astype(np.int64)
    low = data | (((data >= 65) & (data < 91)).astype(np.uint8) << 5)
    word = (mix(span_hash(byte_prefix(low), starts, ends)) >> U64(52)).astype(np.int64)
    text = np.searchsorted(first, np.arange(len(starts)), "right") - 1

    def beside(values: np.ndarray, step: int) -> np.ndarray:
        """The value of a neighbour in the same text, else that of nothing (0)."""
        out = np.zeros_like(values)
        if step < 0:
            same = text[-step:] == text[:step]
            out[-step:][same] = values[:step][same]
        else:
            same = text[step:] == text[:-step]
            out[:-step][same] = values[step:][same]
        return out

    # The look of a file: how much of it is digits, and how much marks.
    def portion(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        part = (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)
        return np.searchsorted([0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2], part, "right")

    look = portion(group == 3) * 8 + portion((kind == 2))
    columns = [shape, length * 5 + changes, length * 5 + share, beside(shape, -1), beside(shape, -2), beside(shape, 1),
               beside(word, -1), beside(word, -2), look[text]]
    return Tokens(starts, ends, first, np.stack(columns, 1) + _STARTS[:-1])


def training_sample(docs: DataFrame) -> list[str]:
    """A bounded number of texts that may hold a secret and as many of all others, whatever the partitions.

    Hashes are ranked first, so that the task that merges the ranks reads no texts; the texts of the
    chosen ones are fetched by a second scan.
    """
    short = docs.filter(F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES))
    key = F.xxhash64("doc_id", "text")
    ranked = short.select(key.alias("key"), F.col("text").rlike(LIKELY).alias("likely"))
    picked = [ranked.filter(c).select("key").distinct().orderBy("key").limit(TEXTS) for c in ("likely", "not likely")]
    keys = [r.key for r in picked[0].unionAll(picked[1]).collect()]
    rows = short.select(key.alias("key"), "text").filter(F.col("key").isin(keys)).dropDuplicates(["key"])
    return sorted(r.text for r in rows.collect())


def fit(texts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
    """(weights, transitions) learned from a bounded list of texts, labelled by the patterns."""
    if not any(map(_values, texts)):
        return None
    data, offsets = text_arrays(pa.array(texts))
    found = tokens(data, offsets)
    labels = np.zeros(len(found.starts), np.int64)
    for i, text in enumerate(texts):
        a, b = found.first[i], found.first[i + 1]
        for start, end in _values(text):
            low = int(offsets[i]) + len(text[:start].encode())
            high = low + len(text[start:end].encode())
            inside = a + np.flatnonzero((found.starts[a:b] >= low) & (found.starts[a:b] < high))
            labels[inside] = 2
            labels[inside[:1]] = 1
    kinds, types = np.unique(found.slots, axis=0, return_inverse=True)
    used, features = np.unique(kinds.ravel(), return_inverse=True)
    owner = np.repeat(np.arange(len(kinds)), kinds.shape[1])
    learned, transitions = crf.fit(features, owner, types.ravel(), labels, found.first, 3, len(used), ROUNDS)
    weights = np.zeros((_STARTS[-1], 3))
    weights[used] = learned
    transitions[0, 2] = -1e9  # a secret goes on only where one is open
    return weights, transitions


def _added(model, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int]]]:
    """Byte ranges of the tagged runs of each text."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    if model is None:
        return out
    found = tokens(data, offsets)
    weights, transitions = model
    scores = sum((weights[found.slots[:, k]] for k in range(found.slots.shape[1])), np.zeros((len(found.starts), 3)))
    scores[found.first[:-1][np.diff(found.first) > 0], 2] = -1e9  # nothing is open where a text begins
    tags = crf.viterbi(scores, found.first, transitions)
    for i in np.flatnonzero(tags == 1).tolist():
        text = int(np.searchsorted(found.first, i, "right")) - 1
        j = i + 1
        while j < found.first[text + 1] and tags[j] == 2:
            j += 1
        out[text].append((int(found.starts[i] - offsets[text]), int(found.ends[j - 1] - offsets[text])))
    return out


def spans_of(texts: list[str], model, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of all spans of each text, in order."""
    out = []
    for text, ranges in zip(texts, _added(model, data, offsets)):
        spans = base_spans(text)
        if ranges:
            raw = text.encode()
            more = [(len(raw[:a].decode()), 3, len(raw[:b].decode("utf-8", "ignore"))) for a, b in ranges]
            spans = sorted(spans + [s for s in more if not any(s[0] < e and b < s[2] for b, _, e in spans)])
        out.append(spans)
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _run(docs: DataFrame, model, make, schema: str) -> DataFrame:
    shared = tuned(docs.sparkSession).sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            texts = rows.column("text").to_pylist()
            yield make(rows, texts, spans_of([t or "" for t in texts], shared.value, data, offsets))

    return docs.mapInArrow(lean(apply), schema)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): the secrets of every text as structs of kind, start, end and value."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def make(rows, texts, spans):
        found = [[{"kind": KINDS[k], "start": a, "end": b, "value": (t or "")[a:b]} for a, k, b in own] for t, own in zip(texts, spans)]
        return pa.record_batch([rows.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _run(texts, fit(training_sample(docs)), make, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,value:string>>")


def scan_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added) of every text."""

    def make(rows, texts, spans):
        base = [[s for s in own if s[1] < 3] for own in spans]
        counts = [pa.array([sum(s[1] == k for s in own) for own in spans], pa.int64()) for k in range(4)]
        return pa.record_batch(
            [rows.column("doc_id"), *counts[:3], pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]),
             pa.array(list(map(_joined, spans))), counts[3]],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"],
        )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _run(texts, fit(training_sample(docs)), make,
                "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_added bigint")


def redacted(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """All rows and columns of ``docs`` with every secret of the text replaced by ``mask``; a null text stays null."""

    def make(rows, texts, spans):
        out = []
        for text, own in zip(texts, spans):
            if own:
                parts, at = [], 0
                for a, _, b in own:
                    if a >= at:
                        parts += [text[at:a], mask]
                    at = max(at, b)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return rows.set_column(rows.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    return _run(docs, fit(training_sample(docs)), make, docs.schema)
