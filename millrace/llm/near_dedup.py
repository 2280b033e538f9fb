"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its shingles (``WORDS`` words in a row; a shorter text is one shingle).
The weight is the shingle's count times ``1 + ln(N / df) / ln(N + 1)``, between the
count and twice the count. Document frequencies are counted over all documents. Similarities take
them exactly, for each 64-bit shingle: the shingles of texts that share a bucket are counted in all
documents, packed by hash, and only those of two documents or more are sent back. The bands, which
only propose pairs, take them from ``CELLS`` hashed cells, less what a cell gathers on average from
other shingles, which bounds the table that goes to the executors.

``BANDS`` * ``ROWS`` weighted samples are banded; texts that agree in a band share a bucket. Two
texts of weighted Jaccard similarity 0.8 miss all bands with probability 0.0002.

Buckets may hold a third of all texts, so pairs are not formed within them. Up to ``PIVOTS``
members of a bucket, those with the most company in all their buckets, are compared with the
others. That is every pair of a bucket of up to ``PIVOTS`` + 1 texts. Where a larger bucket is
left with texts of different components, what hangs together through such buckets is
compared in full: the texts outside its largest component against all, in blocks of
bounded size, so that no link is lost and no task holds a whole group. All comparisons are exact
weighted Jaccard similarities. Links make components, and a component is a class.

Equal texts are one node from the start (told apart by a 64-bit hash).

Defined results: null and empty texts, and others without words, are alike only if they are equal
(null counts as empty); repeated rows share a class; ``class_id`` is the least id of the class, null
if no row of it has one; columns other than ``doc_id`` and ``text`` are not read
(``deduplicated`` passes all of them on).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blocks import U64, blocks, folded_words, gram_hashes, lean, lean_group, mix, prefix_hash, span_hash, text_bytes, whole_row, word_hashes
from millrace.llm.bloom import filled, shared_filter
from millrace.llm.bloom import plain as _plain
from millrace.llm.bloom import press as _press
from millrace.llm.components import components
from millrace.llm.settings import tuned
from millrace.operators.relational import one_per_key
from millrace.workspace import materialize

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 16, 4
CELLS = 1 << 20
PIVOTS = 4
MINOR_BLOCK, MAJOR_BLOCK = 64, 1024

SHARE = 8 << 20  # bytes of text whose shingles are counted in one task
BODY = 2 << 20  # bytes of text whose shingles are one packed row

_SLICES = 64  # of the table of cells
_DRAWS = 1 << 16
_ROUNDING = np.float32(1e-3)  # far more than single precision loses in a value


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of a block of texts, each shingle of a text once, in order."""
    words = folded_words(data, offsets)
    hashes = word_hashes(words.data, words.starts, words.ends)
    grams, text, _ = gram_hashes(hashes, words.first, WORDS)
    size = np.diff(words.first)
    short = np.flatnonzero((size > 0) & (size < WORDS))
    if len(short):
        whole = span_hash(prefix_hash(hashes), words.first[short], words.first[short + 1])
        grams, text = np.concatenate([grams, mix(whole)]), np.concatenate([text, short])
    order = np.argsort(grams)
    # By text then: numpy sorts 16-bit numbers by counting them.
    own = text[order]
    order = order[np.argsort(own.astype(np.uint16) if len(offsets) <= 1 << 16 else own, kind="stable")]
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    return text[heads], grams[heads], np.diff(np.append(heads, len(grams)))


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> U64(64 - 20)).astype(np.int64)


def _weight(df: np.ndarray, texts: int) -> np.ndarray:
    return 1 + np.log(texts / df) / math.log(texts + 1)


def _cell_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents of each cell, all documents): one bounded table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, texts = np.zeros(CELLS, np.int32), 0
        for _, data, offsets in blocks(batches, "text"):
            text, grams, _ = shingles(data, offsets)
            cell = _cell(grams)
            pairs = np.flatnonzero((text[1:] != text[:-1]) | (cell[1:] != cell[:-1])) + 1  # cells are in order within a text
            cells += np.bincount(cell[np.append(0, pairs)] if len(cell) else cell, minlength=CELLS).astype(np.int32)
            texts += len(offsets) - 1
        if texts:
            press = zstandard.ZstdCompressor(level=3)
            parts = [press.compress(x.tobytes()) for x in np.split(cells, _SLICES)]
            yield pa.record_batch([pa.array(np.arange(_SLICES)), pa.array([texts] * _SLICES, pa.int64()), pa.array(parts, pa.binary())],
                                  ["slice", "texts", "cells"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CELLS // _SLICES, np.int64)
        for part in table.column("cells"):
            total += np.frombuffer(zstandard.ZstdDecompressor().decompress(part.as_buffer()), np.int32)
        texts = sum(table.column("texts").to_pylist())
        return pa.table({"slice": table.column("slice")[:1], "texts": pa.array([texts], pa.int64()), "cells": pa.array([total.tobytes()], pa.binary())})

    schema = "slice bigint, texts bigint, cells binary"
    rows = docs.select("text").mapInArrow(lean(count), schema).groupBy("slice").applyInArrow(add, schema).collect()
    counts = np.zeros(CELLS, np.int64)
    texts = 1
    for row in rows:
        texts = row.texts
        at = row.slice * (CELLS // _SLICES)
        counts[at : at + CELLS // _SLICES] = np.frombuffer(row.cells, np.int64)
    return counts, texts


def _cell_weights(counts: np.ndarray, texts: int) -> np.ndarray:
    own = counts - (counts.sum() - counts) / (CELLS - 1)  # less the mean of the others
    return _weight(own.clip(1, texts), texts).astype(np.float32)


def cell_weights(docs: DataFrame) -> np.ndarray:
    """About the inverse document frequency of each cell's shingles, counted over all documents; the bands use it."""
    return _cell_weights(*_cell_counts(docs))


class Sampler:
    """Consistent weighted samples: a pair of shingle and level that two sets share as often as they are alike.

    The random numbers of a shingle come from a fixed table, addressed by a hash of the shingle
    for each sample. The shingle of the least value is the sample. One number of the table bounds a value
    from below, so values are worked out only where that bound does not rule a shingle out.
    """

    def __init__(self, samples: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2, 1, _DRAWS).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, _DRAWS)).astype(np.float32)
        self.beta = rng.random(_DRAWS, np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.floor = self.log_c - self.r - _ROUNDING
        self.factors = rng.integers(1, 1 << 62, samples, dtype=U64) * U64(2) + U64(1)

    def _values(self, draw: np.ndarray, log_w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        beta = self.beta[draw]
        level = np.floor(log_w * self.inverse[draw] + beta)
        return level, self.log_c[draw] - self.r[draw] * (level + np.float32(1) - beta)

    def samples(self, grams: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value for each sample of a weighted set."""
        best = np.full(len(self.factors), np.inf, np.float32)
        out = np.zeros(len(self.factors), U64)
        log_w = np.log(weights).astype(np.float32)
        sample = np.arange(len(best))
        for at in range(0, len(grams), 1024):  # bounded memory for long texts
            own, log_own = grams[at : at + 1024], log_w[at : at + 1024]
            draw = ((self.factors[:, None] * own) >> U64(48)).view(np.int64)
            value = self.floor.take(draw)
            value -= log_own
            likely = value.argmin(1)
            bound = np.minimum(best, self._values(draw[sample, likely], log_own[likely])[1])
            places = np.flatnonzero(value <= bound[:, None])
            value.fill(np.inf)
            value.ravel()[places] = self._values(draw.ravel()[places], log_own[places % len(own)])[1]
            first = value.argmin(1)
            low = value[sample, first]
            better = low < best
            level = self._values(draw[sample, first], log_own[first])[0]
            pick = mix(own[first] ^ (level.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15)))
            out[better], best[better] = pick[better], low[better]
        return out


def _bands(docs: DataFrame, idf) -> DataFrame:
    """(bucket, node), distinct: the bands of every text with a word."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(BANDS * ROWS)
        power = U64(0xD6E8FEB86659FD93)
        for rows, data, offsets in blocks(batches, "text"):
            text, grams, counts = shingles(data, offsets)
            if not len(text):
                continue
            weights = counts * idf.value[_cell(grams)]
            marks = np.append(np.flatnonzero(np.append(True, text[1:] != text[:-1])), len(text))
            nodes = rows.column("_node").to_numpy()[text[marks[:-1]]]
            drawn = np.empty((len(nodes), BANDS, ROWS), U64)
            for i, (a, b) in enumerate(zip(marks[:-1].tolist(), marks[1:].tolist())):
                drawn[i] = sampler.samples(grams[a:b], weights[a:b]).reshape(BANDS, ROWS)
            keys = np.broadcast_to(np.arange(BANDS).astype(U64), (len(nodes), BANDS))
            for k in range(ROWS):
                keys = mix(keys * power + drawn[:, :, k])
            yield pa.record_batch([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(nodes, BANDS))], ["bucket", "node"])

    return docs.select(_text_hash().alias("_node"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        lean(sign), "bucket bigint, node bigint").distinct()


_SENT = "bucket int, body bigint, grams binary, n binary"


def _sent(grams: np.ndarray, n: np.ndarray, buckets: int, body: int) -> pa.RecordBatch:
    """Sorted distinct shingles and a number for each, one row for each bucket; bodies ask, counts have -1."""
    bucket = (grams % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    marks = np.searchsorted(bucket[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(marks))
    parts = [order[marks[b] : marks[b + 1]] for b in used.tolist()]
    return pa.record_batch(
        [pa.array(used.astype(np.int32)), pa.array([body] * len(used), pa.int64()),
         pa.array([_press(np.diff(grams[x], prepend=U64(0))) for x in parts], pa.binary()),
         pa.array([_press(n[x].astype(np.int32)) for x in parts], pa.binary())],
        ["bucket", "body", "grams", "n"])


def _bodies(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(body, nodes, marks, grams, counts, size): shingles of the texts of ``nodes``, many texts in a row."""
    wanted = shared_filter(nodes, "node")

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.take(pa.array(wanted.value.hits(batch.column("node").to_numpy().view(U64))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, size = TaskContext.get().partitionId() << 32, 0, 0
        parts: list[tuple] = []

        def out() -> pa.RecordBatch:
            own, lengths, grams, counts = (np.concatenate(x) for x in zip(*parts))
            return pa.record_batch([pa.array([base + n]), *(pa.array([_press(x)], pa.binary()) for x in (own, lengths, grams, counts)),
                                    pa.array([len(grams)])], ["body", "nodes", "lengths", "grams", "counts", "size"])

        for rows, data, offsets in blocks(batches, "text"):
            text, grams, counts = shingles(data, offsets)
            parts.append((rows.column("node").to_numpy(), np.bincount(text, minlength=len(offsets) - 1).astype(np.int64),
                          grams, counts.astype(np.int32)))
            size += len(data)
            if size > BODY:
                yield out()
                parts, n, size = [], n + 1, 0
        if parts:
            yield out()

    texts = docs.select(_text_hash().alias("node"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(thin, "node bigint, text string")
    # Copies are put together in the tasks before they are shuffled.
    return texts.groupBy("node").agg(F.min("text").alias("text")).join(nodes, "node", "left_semi").mapInArrow(
        lean(build), "body bigint, nodes binary, lengths binary, grams binary, counts binary, size bigint")


def _gram_filter(bodies: DataFrame):
    """A broadcast Bloom filter of the shingles of all bodies."""
    members = bodies.agg(F.sum("size").alias("n")).first().n or 0
    return filled(bodies.select("grams"), lambda batch: (np.unique(_plain(raw.as_buffer(), U64)) for raw in batch.column("grams")), members)


def _vectors(docs: DataFrame, nodes: DataFrame, texts: int) -> DataFrame:
    """(node, vector): shingles and weights of the texts of ``nodes``, one row each, by exact document frequencies."""
    bodies = materialize(_bodies(docs, nodes), "bodies")
    wanted = _gram_filter(bodies)
    buckets = max(1, math.ceil(text_bytes(docs) / SHARE))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        size = 0
        for _, data, offsets in blocks(batches, "text"):
            _, grams, _ = shingles(data, offsets)
            seen.append(grams[wanted.value.hits(grams)])
            size += len(seen[-1])
            if size > 1 << 21:
                yield _sent(*np.unique(np.concatenate(seen), return_counts=True), buckets, -1)
                seen, size = [], 0
        if size:
            yield _sent(*np.unique(np.concatenate(seen), return_counts=True), buckets, -1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, raw in zip(batch.column("body").to_pylist(), batch.column("grams")):
                grams = np.unique(_plain(raw.as_buffer(), U64))
                yield _sent(grams, np.zeros(len(grams), np.int32), buckets, body)

    def answer(table: pa.Table) -> pa.Table:
        body = table.column("body").to_numpy()
        raw, numbers = ([x.as_buffer() for x in table.column(c)] for c in ("grams", "n"))
        known = np.flatnonzero(body < 0).tolist()
        out = []
        if known:
            grams = np.concatenate([np.cumsum(_plain(raw[i], U64)) for i in known])
            df = np.concatenate([_plain(numbers[i], np.int32) for i in known])
            order = np.argsort(grams, kind="stable")
            grams, df = grams[order], df[order]
            heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            grams, df = grams[heads], np.add.reduceat(df.astype(np.int64), heads)
            often = df > 1  # a shingle without an answer is in one document
            grams, df = grams[often], df[often]
            for i in np.flatnonzero(body >= 0).tolist():
                own = np.cumsum(_plain(raw[i], U64))
                at = np.searchsorted(grams, own)
                at[at == len(grams)] = 0
                good = grams[at] == own if len(grams) else np.zeros(len(own), bool)
                if good.any():
                    out.append((int(body[i]), _press(np.diff(own[good], prepend=U64(0))), _press(df[at[good]])))
        columns = list(zip(*out)) if out else [[]] * 3
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], ["body", "grams", "df"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a row unpacks to the shingles of ``BODY`` bytes of text; one at a time
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                grams, counts = _plain(row["grams"].as_buffer(), U64), _plain(row["counts"].as_buffer(), np.int32)
                df = np.ones(len(grams), np.int64)
                if row["answers"].is_valid:
                    answers = row["answers"].values
                    known = np.concatenate([np.cumsum(_plain(x.as_buffer(), U64)) for x in answers.field("grams")])
                    number = np.concatenate([_plain(x.as_buffer(), np.int64) for x in answers.field("df")])
                    order = np.argsort(known)
                    known, number = known[order], number[order]
                    at = np.searchsorted(known, grams).clip(max=len(known) - 1)
                    same = known[at] == grams
                    df[same] = number[at[same]]
                weights = (counts * _weight(df, texts)).astype(np.float32)
                marks = np.concatenate([[0], np.cumsum(_plain(row["lengths"].as_buffer(), np.int64))]).tolist()
                own = _plain(row["nodes"].as_buffer(), np.int64)
                for low in range(0, len(own), 128):
                    some = list(zip(marks[low : low + 128], marks[low + 1 : low + 129]))
                    yield pa.record_batch(
                        [pa.array(own[low : low + 128]), pa.array([grams[a:b].tobytes() + weights[a:b].tobytes() for a, b in some], pa.binary())],
                        ["node", "vector"])

    counted = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(lean(count), _SENT)
    asked = bodies.select("body", "grams").mapInArrow(lean(ask), _SENT)
    answers = counted.unionAll(asked).groupBy("bucket").applyInArrow(lean_group(answer), "body bigint, grams binary, df binary")
    per_body = answers.groupBy("body").agg(F.collect_list(F.struct("grams", "df")).alias("answers"))
    return bodies.join(per_body, "body", "left").select("nodes", "lengths", "grams", "counts", "answers").mapInArrow(
        lean(weigh), "node bigint, vector binary")


def _vector(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 12
    return np.frombuffer(raw, U64, n), np.frombuffer(raw, np.float32, n, 8 * n).astype(np.float64)


def similarity(one: bytes, other: bytes) -> float:
    """Weighted Jaccard similarity of two vectors."""
    (a, v), (b, w) = _vector(one), _vector(other)
    at = np.searchsorted(b, a).clip(max=len(b) - 1)
    same = b[at] == a
    shared = np.minimum(v[same], w[at[same]]).sum()
    return float(shared / (v.sum() + w.sum() - shared))


def _verified(pairs: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """(a, b): the pairs that are alike enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similarity(x, y) >= least for x, y in zip(batch.column("one").to_pylist(), batch.column("other").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return (
        pairs.join(vectors.select(F.col("node").alias("a"), F.col("vector").alias("one")), "a")
        .join(vectors.select(F.col("node").alias("b"), F.col("vector").alias("other")), "b")
        .select("a", "b", "one", "other").mapInArrow(lean(check), "a bigint, b bigint")
    )


def _rest(buckets: DataFrame, roots: DataFrame, vectors: DataFrame, least: float) -> DataFrame:
    """(a, b): links between components that large buckets hold together, all of them compared in blocks."""
    large = buckets.filter(F.col("size") > PIVOTS + 1).join(roots, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root"))
    spans = large.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    split = materialize(large.join(spans, "bucket").select("bucket", "node", "root", "low"), "split-buckets")
    groups = components(split.select(F.col("root").alias("a"), F.col("low").alias("b")).distinct())
    members = split.select("node", "root").distinct().join(groups.select(F.col("node").alias("root"), F.col("root").alias("group")), "root")
    per_root = members.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n"))
    main = per_root.groupBy("group").agg(
        F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("all")
    ).select("group", F.col("top.root").alias("main"), "all", (F.col("all") - F.col("top.n")).alias("minor"))
    own = F.pmod(F.xxhash64("node"), F.lit(1 << 40))
    minors, majors = F.ceil(F.col("minor") / MINOR_BLOCK).cast("int"), F.ceil(F.col("all") / MAJOR_BLOCK).cast("int")
    placed = members.join(main, "group").withColumn("x", (own % minors).cast("int")).withColumn("y", (own % majors).cast("int"))
    as_major = placed.select("group", "node", "root", F.explode(F.sequence(F.lit(0), minors - 1)).alias("x"), "y", F.lit(False).alias("minor"))
    as_minor = placed.filter(F.col("root") != F.col("main")).select(
        "group", "node", "root", "x", F.explode(F.sequence(F.lit(0), majors - 1)).alias("y"), F.lit(True).alias("minor"))
    cells = as_major.unionAll(as_minor).join(vectors, "node")

    def compare(table: pa.Table) -> pa.Table:
        minor = np.array(table.column("minor").to_pylist(), bool)
        node, root = table.column("node").to_numpy(), table.column("root").to_numpy()
        raw = table.column("vector").to_pylist()
        against = np.flatnonzero(~minor)
        out: list[tuple[int, int]] = []
        if len(against):
            parts = [_vector(raw[i]) for i in against.tolist()]
            grams = np.concatenate([p[0] for p in parts])
            weights = np.concatenate([p[1] for p in parts])
            owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            totals = np.array([p[1].sum() for p in parts])
            order = np.argsort(grams, kind="stable")
            grams, weights, owner = grams[order], weights[order], owner[order]
            for i in np.flatnonzero(minor).tolist():
                own, w = _vector(raw[i])
                low, high = np.searchsorted(grams, own, "left"), np.searchsorted(grams, own, "right")
                at = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(int((high - low).sum()))
                shared = np.bincount(owner[at], np.minimum(weights[at], np.repeat(w, high - low)), len(parts))
                alike = shared / (w.sum() + totals - shared) >= least
                _, first = np.unique(root[against][alike], return_index=True)  # one link to each other component
                out += [(int(node[i]), int(node[against[j]])) for j in np.flatnonzero(alike)[first].tolist() if root[against[j]] != root[i]]
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cells.groupBy("group", "x", "y").applyInArrow(compare, "a bigint, b bigint")


def roots(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(node, root) for the hashes of texts that are linked to a different text."""
    spark = tuned(docs.sparkSession)
    counts, texts = _cell_counts(docs.select(F.coalesce("text", F.lit("")).alias("text")))
    idf = spark.sparkContext.broadcast(_cell_weights(counts, texts))
    banded = _bands(docs, idf)
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = materialize(banded.join(sizes, "bucket"), "buckets")
    company = shared.groupBy("node").agg(F.sum("size").alias("company"))
    ranked = shared.join(company, "node").withColumn("_rank", F.row_number().over(
        Window.partitionBy("bucket").orderBy(F.col("company").desc(), "node")))
    pivots = ranked.filter(F.col("_rank") <= PIVOTS).select("bucket", F.col("node").alias("pivot"))
    pairs = (
        shared.join(pivots, "bucket").filter("node != pivot")
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    )
    vectors = materialize(_vectors(docs, shared.select("node").distinct(), texts), "vectors")
    links = materialize(_verified(pairs, vectors, least), "links")
    found = components(links)
    more = materialize(_rest(shared, found, vectors, least), "more-links")
    if more.isEmpty():
        return found
    return components(links.unionAll(more))


def with_root(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(row, root): every row of ``docs`` as a struct; ``root`` is equal for the texts of one class."""
    linked = roots(docs.select("text"), least)
    return docs.select(whole_row(docs), _text_hash().alias("node")).join(linked, "node", "left").select(
        "row", F.coalesce("root", "node").alias("root"))


def classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, class_id), one row for each row of ``docs``."""
    rows = with_root(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), least).select("row.doc_id", "root")
    # A class may hold a third of all rows; the join can split it (see ``one_per_key``).
    return rows.join(one_per_key(rows, ["root"], F.min("doc_id").alias("class_id")), "root").select("doc_id", "class_id")


def deduplicated(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row of each class, with all its columns: that of the least id (nulls last), then the least hash of the text.

    Which text stays is decided on ids and hashes; whole rows are shuffled once, one of each text, and the
    tasks cut their copies before.
    """
    linked = roots(docs.select("text"), least)
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    ids = one_per_key(docs.select("doc_id", _text_hash().alias("node")), ["node"], F.min(first).alias("first"))
    named = ids.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = one_per_key(named, ["root"], F.min(F.struct("first", "node")).alias("least")).select("least.node")
    order = Window.partitionBy("node").orderBy(F.col("row.doc_id").asc_nulls_last(), F.col("row.text").asc_nulls_last())
    texts = docs.select(whole_row(docs), _text_hash().alias("node")).withColumn("rank", F.row_number().over(order)).filter("rank = 1")
    return texts.join(kept, "node", "left_semi").select("row.*")
