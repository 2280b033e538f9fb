"""Training documents that hold test items, found by n-gram seeds and scored by alignment.

1. Every run of ``GRAM`` words of an item may be a seed, so an edited copy is found by any run that the
   edits left whole. Documents that hold a run are kept with its places. A Bloom filter of at most
   ``bloom.BITS`` bits thins them out on the way (with few items it lets one run in 200,000 pass that is none); the join on the
   run is exact, whatever the filter lets through.
2. The documents of each run are counted. A run is rare in up to ``RARE`` of them, or one in ``RARE`` of all that were kept. A rare run is a seed
   by itself: it proposes its documents to its items. A common run, a turn of phrase or a line that many texts
   share, proposes none alone, but to an item so short that the run may be all of its score; two different ones do that stand in a
   document as far apart as in the item, give or take the words that an edit may have put in or taken out.
3. Around the seeds of an item, Smith-Waterman aligns the words of the document with the
   words of the item (match 2, anything else -1). The score is that of the best alignment over
   that of the whole item, so edited and partly copied items are found too.

Words are runs of letters and digits in lower case.

Defined results: null and empty texts and items match nothing; an item of fewer than ``GRAM``
words is one run, found in texts as short only; repeated documents each have their row, repeated items of one id are joined;
an item without an id is left out; columns other than ``doc_id``, ``text``, ``item_id`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import U64, blocks, folded_words, gram_hashes, keyed, lean, mix, prefix_hash, span_hash, text_key, whole_row, word_hashes
from millrace.llm.bloom import shared_filter
from millrace.llm.settings import tuned
from millrace.operators.relational import one_per_key
from millrace.workspace import materialize

GRAM = 4
RARE = 1000
LEAST = 0.5
MATCH, MISS = 2, -1


def _hashes(data: np.ndarray, offsets: np.ndarray):
    words = folded_words(data, offsets)
    return words, word_hashes(words.data, words.starts, words.ends)


def _whole(hashes: np.ndarray, first: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Hash of all words of the given texts."""
    return mix(span_hash(prefix_hash(hashes), first[texts], first[texts + 1]))


def item_grams(items: DataFrame) -> DataFrame:
    """(item_id, place, gram) of every run of words of an item."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            words, hashes = _hashes(data, offsets)
            grams, text, at = gram_hashes(hashes, words.first, GRAM)
            place = at - words.first[text]
            short = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < GRAM))
            if len(short):  # too short for a run: all its words, found where a text is no longer either
                grams = np.concatenate([grams, _whole(hashes, words.first, short)])
                text, place = np.concatenate([text, short]), np.concatenate([place, np.zeros(len(short), np.int64)])
            yield pa.record_batch([rows.column("item_id").take(pa.array(text)), pa.array(place), pa.array(grams.view(np.int64))],
                                  ["item_id", "place", "gram"])

    return items.mapInArrow(lean(apply), "item_id bigint, place bigint, gram bigint")


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(best score, end in b) of a local alignment of two word sequences."""
    at = np.arange(1, len(b) + 1)
    row = np.zeros(len(b) + 1, np.int64)
    best, end = 0, 0
    for word in a:
        new = np.zeros_like(row)
        new[1:] = np.maximum(np.maximum(row[:-1] + np.where(b == word, MATCH, MISS), row[1:] + MISS), 0)
        # A gap along b costs one a word: a running maximum, shifted by the place.
        new[1:] = np.maximum.accumulate(new[1:] - MISS * at) + MISS * at
        row = new
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _score(text: np.ndarray, item: np.ndarray, hits: list[tuple[int, int]], least: float) -> tuple[float, int, int]:
    """(score, first word, word after the last) of the best place of an item in a text, if one has at least ``least``."""
    m = len(item)
    slack = m // 2 + 8
    lows = sorted({p - q for p, q in hits})
    spans: list[list[int]] = []
    for low in lows:  # places where the item could begin, close ones together
        if spans and low - slack <= spans[-1][1]:
            spans[-1][1] = low + m + slack
        else:
            spans.append([max(0, low - slack), low + m + slack])
    best = (0.0, 0, 0)
    for a, b in spans:
        part = text[a : min(b, len(text))]
        if np.isin(item, part).sum() / m < least:  # each word scores MATCH at most, and only if the part has it
            continue
        score, end = align(item, part)
        if score / (MATCH * m) > best[0]:
            _, back = align(item[::-1], part[:end][::-1])
            best = (score / (MATCH * m), a + end - back, a + end)
    return best


def _proposed(seeded: DataFrame, chosen: DataFrame, least: float) -> DataFrame:
    """(_k1, _k2, item_id, hits): the items that a document's seeds propose, with the places of all runs they share.

    Counts and pairs come from the runs that documents share with items, a small part of the texts. Hits of one pair are
    bounded by the document's own places of the item's runs.
    """
    hits = seeded.select("_k1", "_k2", F.inline("hits")).distinct()
    held = hits.join(one_per_key(chosen, ["gram"]), "gram", "left_semi")  # without what only the filter let through
    counted = one_per_key(held.select("_k1", "_k2", "gram").distinct(), ["gram"], F.count(F.lit(1)).alias("df"))
    kept = seeded.agg(F.count(F.lit(1))).scalar()
    runs = chosen.join(counted, "gram").withColumn("rare", F.col("df") <= F.greatest(F.lit(RARE), kept / RARE))
    length = one_per_key(chosen, ["item_id"], F.max("place").alias("last"))
    pairs = held.join(runs.join(length, "item_id"), "gram").groupBy("_k1", "_k2", "item_id").agg(
        F.collect_list(F.struct("at", "place")).alias("hits"), F.max("rare").alias("rare"),
        F.sort_array(F.collect_list(F.struct((F.col("at") - F.col("place")).alias("low"), "place"))).alias("lows"), F.max("last").alias("last"),
    )
    slack = F.floor((F.col("last") + GRAM) / 2) + 8
    # In order of where the item would begin, two neighbours that are close and of different places.
    close = F.exists(
        F.arrays_zip(F.slice("lows", F.lit(1), F.size("lows") - 1).alias("one"), F.slice("lows", F.lit(2), F.size("lows") - 1).alias("other")),
        lambda x: (x["other"]["low"] - x["one"]["low"] <= slack) & (x["other"]["place"] != x["one"]["place"]),
    )
    alone = (F.col("last") + GRAM) * least <= GRAM  # one run of so short an item may be all that its score needs
    return pairs.filter(F.col("rare") | close | alone).select("_k1", "_k2", "item_id", "hits")


def contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """(_k1, _k2, doc_id, item_id, score, first_word, end_word, passage): each test item that a document holds."""
    tuned(docs.sparkSession)
    texts = keyed(docs)
    items = (
        items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
        .filter("item_id is not null").groupBy("item_id").agg(F.array_join(F.sort_array(F.collect_set("text")), " ").alias("text"))
    )
    chosen = materialize(item_grams(items), "seeds")
    shared = shared_filter(chosen, "gram", each=1024)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "text"):
            words, hashes = _hashes(data, offsets)
            found, text, at = gram_hashes(hashes, words.first, GRAM)
            short = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < GRAM))
            hits = shared.value.hits(found)
            found, text, at = found[hits], text[hits], at[hits] - words.first[text[hits]]
            if len(short):
                whole = _whole(hashes, words.first, short)
                good = shared.value.hits(whole)
                found, text = np.concatenate([found, whole[good]]), np.concatenate([text, short[good]])
                at = np.concatenate([at, np.zeros(len(good), np.int64)])
            if not len(found):
                continue
            order = np.argsort(text, kind="stable")
            found, text, at = found[order], text[order], at[order]
            heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            marks = np.append(heads, len(text)).astype(np.int32)
            kept = rows.take(pa.array(text[heads]))
            hits = pa.StructArray.from_arrays([pa.array(found.view(np.int64)), pa.array(at)], ["gram", "at"])
            yield pa.record_batch([*(kept.column(c) for c in ("doc_id", "text", "_k1", "_k2")), pa.ListArray.from_arrays(pa.array(marks), hits)],
                                  ["doc_id", "text", "_k1", "_k2", "hits"])

    seeded = materialize(
        texts.mapInArrow(lean(find), "doc_id bigint, text string, _k1 bigint, _k2 bigint, hits array<struct<gram:bigint,at:bigint>>"), "seeded"
    )
    links = (
        _proposed(seeded, chosen, least)
        .join(items.withColumnRenamed("text", "item"), "item_id")
        .groupBy("_k1", "_k2").agg(F.collect_list(F.struct("item_id", "item", "hits")).alias("items"))
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
        names = ["_k1", "_k2", "doc_id", "item_id", "score", "first_word", "end_word", "passage"]
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                raw = np.frombuffer(row["text"].as_buffer(), np.uint8) if len(row["text"].as_buffer()) else np.zeros(0, np.uint8)
                words, text = _hashes(raw, np.array([0, len(raw)]))
                found = row["items"].values
                for item_id, item_text, hits in zip(found.field("item_id"), found.field("item"), found.field("hits")):
                    own = np.frombuffer(item_text.as_buffer(), np.uint8)
                    _, item = _hashes(own, np.array([0, len(own)]))
                    at, place = (hits.values.field(f).to_pylist() for f in ("at", "place"))
                    value, a, b = _score(text, item, list(zip(at, place)), least)
                    if value >= least:
                        passage = raw[words.starts[a] : words.ends[b - 1]].tobytes().decode("utf-8", "replace")
                        out.append((*(row[k].as_py() for k in names[:3]), item_id.as_py(), value, a, b, passage))
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return seeded.drop("hits").join(links, ["_k1", "_k2"]).mapInArrow(
        score, "_k1 bigint, _k2 bigint, doc_id bigint, item_id bigint, score double, first_word bigint, end_word bigint, passage string"
    )


def clean(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no test item."""
    found = contaminated(docs, items, least).select("_k1", "_k2").distinct()
    return docs.select(whole_row(docs), *text_key()).join(found, ["_k1", "_k2"], "left_anti").select("row.*")
