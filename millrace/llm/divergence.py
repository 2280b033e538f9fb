"""How the words of each source differ from those of its language and of the other sources: an audit in exact numbers.

A term is a run of ASCII letters and characters beyond ASCII, with A-Z in lower case. White space never
lies within a term, so a document is factored into whitespace chunks, and only distinct chunks are tokenized:

1. Texts are cut into blocks of ``BLOCK_BYTES``, and the chunks of each document are counted (``_count_chunks``). A block keeps
   its postings, (document, count) of each chunk, in the shared folder; its distinct chunks go as space-joined lists to buckets by
   the chunk's hash. A chunk travels once a block, and postings never leave their block, so no common chunk is a hot key.
2. A bucket numbers its globally distinct chunks (``_number_chunks``); each is tokenized once, by a pattern in Spark.
   The documents of a term's chunks together bound the documents it can be in; a term bounded below ``LEAST`` is
   dropped here, which loses none that is kept.
3. The terms are joined back to the chunk lists (``_place_terms``) and sent to the blocks, where a term's documents are united over
   its chunks (``_count_terms``): distinct documents and occurrences by language, source and term.
4. These are added up by language and bucket of terms (``_add_up``); terms in at least ``LEAST`` documents of the language are kept.
5. Shares p and the divergences f follow. Pairs of sources meet in tiles of ``TILE`` x ``TILE`` sources and a bucket of terms
   (``_pair_sums``); terms that neither source holds enter by their number.

Rows between these steps hold packed arrays (``_small``), each for a block and a bucket; the number of
buckets follows the bytes of text, and a group never holds more than a block, a bucket's lists or a bucket's counts.

Results: null text, lang and source are ''. A language without kept terms has pairs of value 0 and no term rows; a
source alone in its language has no pairs; an empty table gives no rows; repeated rows each count. Values that tie are
ranked by item. Extra columns are ignored. A group of occurrences beyond long is an error, not a wrong number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blocks import give_back, lean, lean_group, ranges, text_arrays, word_hashes
from millrace.operators.relational import one_per_key, top_n_per_group
from millrace.workspace import materialize

LEAST = 10  # documents of a language that a kept term is in
SCALE = 1_000_000_000
TOP = 10  # ranked terms of a group
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20  # of text, about, for each bucket of chunks or terms
LEAST_BUCKETS = 32
TILE = 64

BLOCKS = "block bigint, bucket int, chunks string, docs binary, packed binary, langs array<string>, sources array<string>"
NUMBERED = "bucket int, id int, chunk string, docs bigint, block bigint, ids binary"
PLACED = "block bigint, bucket int, places binary, terms string"
COUNTED = "lang string, part int, terms string, sources array<string>, groups binary, source binary, docs binary, n binary"
ADDED = "lang string, part int, source string, term string, n bigint, total bigint"
PAIRS = "lang string, source string, item string, none bigint, value bigint, seen bigint"


# --- packed arrays -----------------------------------------------------------------------------------

def _small(values: np.ndarray) -> bytes:
    """Whole numbers from 0, in as few bytes each as the largest needs; the width comes first."""
    width = next(w for w in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _joined(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Space-joined runs of ``words``."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words), " ")


def _split(joined: pa.Array) -> pa.Array:
    if isinstance(joined, pa.ChunkedArray):
        joined = joined.combine_chunks()
    return pc.split_pattern(joined, " ").flatten()


def _buckets_of(words: pa.Array, buckets: int) -> np.ndarray:
    data, offsets = text_arrays(words)
    return (word_hashes(data, offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int64)


def _encoded(words: pa.Array | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and the number of each word among them."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start, and the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [len(sorted_values)]])


# --- 1: chunks of blocks ---------------------------------------------------------------------------

def _texts_of_size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of consecutive rows of about ``BLOCK_BYTES`` of text; a longer text stands alone."""
    kept, size = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        start = 0
        for i, length in enumerate(lengths.tolist()):
            if size and size + length > BLOCK_BYTES:
                if i > start:
                    kept.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(kept)
                kept, size, start = [], 0, i
            size += length
        kept.append(batch.slice(start))
    if sum(b.num_rows for b in kept):
        yield pa.Table.from_batches(kept)


def _chunks_of(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of some texts, and of each chunk in them its number and its text's.

    The words themselves are let go of here; what stays is narrow, as blocks are what a task holds.
    """
    lists = pc.ascii_split_whitespace(texts.combine_chunks())
    coded = lists.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(lists), dtype=np.int32), pc.list_value_length(lists).to_numpy())
    del lists
    chunks, at = coded.dictionary, coded.indices.to_numpy()
    empty = pc.index(chunks, "").as_py()  # before and after white space at the ends of a text
    if empty >= 0:
        some = at != empty
        at, doc = at[some], doc[some]
        at -= at > empty
        chunks = pa.concat_arrays([chunks.slice(0, empty), chunks.slice(empty + 1)])
    return chunks, at, doc


def _count_chunks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, names = TaskContext.get().partitionId(), [f.split()[0] for f in BLOCKS.split(", ")]
        for number, table in enumerate(_texts_of_size(batches)):
            block = (task << 32) + number
            groups, group = _encoded(pc.binary_join_element_wise(
                pc.cast(pc.binary_length(table["lang"]), pa.string()), table["lang"], table["source"], " "))  # the length tells where lang ends
            first = np.zeros(len(groups), np.int64)
            first[group[::-1]] = np.arange(len(group))[::-1]
            langs, sources = table["lang"].take(pa.array(first)), table["source"].take(pa.array(first))
            yield pa.record_batch([
                pa.array([block]), pa.array([-1], pa.int32()), pa.array([None], pa.string()), pa.array([None], pa.binary()),
                pa.array([_small(group)], pa.binary()), pa.array([langs.to_pylist()], pa.list_(pa.string())),
                pa.array([sources.to_pylist()], pa.list_(pa.string())),
            ], names)
            chunks, at, doc = _chunks_of(table["text"])
            give_back()
            if not len(at):
                continue
            bucket = _buckets_of(chunks, buckets)
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            pair = rank[at]
            pair *= table.num_rows
            pair += doc
            del at, doc
            pair.sort()
            marks = _runs(pair)
            count = np.diff(marks)
            chunk_of, doc_of = np.divmod(pair[marks[:-1]], table.num_rows)
            del pair, marks
            per_chunk = np.bincount(chunk_of, minlength=len(order))
            bounds = _runs(bucket[order])
            ends = np.concatenate([[0], np.cumsum(per_chunk)])
            joined = _joined(chunks.take(pa.array(order)), bounds)
            for i, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                part = slice(ends[low], ends[high])
                counts = count[part]
                entries = doc_of[part] * 2 + (counts > 1)  # most counts are 1 and take no room
                one, more = _small(entries), _small(counts[counts > 1])
                packed = len(one).to_bytes(8, "little") + one + more
                yield pa.record_batch([
                    pa.array([block]), pa.array([bucket[order[low]]], pa.int32()), joined.slice(i, 1), pa.array([_small(per_chunk[low:high])], pa.binary()),
                    pa.array([packed], pa.binary()), pa.array([None], pa.list_(pa.string())), pa.array([None], pa.list_(pa.string())),
                ], names)

    return run


def _postings(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Documents and counts of a bucket's chunks, in the order of the chunks."""
    size = 8 + int.from_bytes(packed[:8], "little")
    entries = _large(packed[8:size])
    counts = np.ones(len(entries), np.int64)
    counts[(entries & 1).astype(bool)] = _large(packed[size:])
    return entries >> 1, counts


# --- 2 and 3: terms of distinct chunks -------------------------------------------------------------

def _number_chunks(table: pa.Table) -> pa.Table:
    """Of one bucket: its distinct chunks, numbered, with the documents they are in; and each block's list as these numbers."""
    chunks, ids = _encoded(_split(table["chunks"]))
    docs = [_large(d.as_buffer()) for d in table["docs"]]
    ends = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    total = np.zeros(len(chunks), np.int64)
    np.add.at(total, ids, np.concatenate(docs))
    bucket, n, rows = table["bucket"][0].as_py(), len(chunks), table.num_rows
    lists = [_small(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    return pa.table({
        "bucket": pa.array(np.full(n + rows, bucket), pa.int32()),
        "id": pa.concat_arrays([pa.array(np.arange(n), pa.int32()), pa.nulls(rows, pa.int32())]),
        "chunk": pa.concat_arrays([chunks, pa.nulls(rows, pa.string())]),
        "docs": pa.concat_arrays([pa.array(total), pa.nulls(rows, pa.int64())]),
        "block": pa.concat_arrays([pa.nulls(n, pa.int64()), table["block"].combine_chunks()]),
        "ids": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array(lists, pa.binary())]),
    })


def _place_terms(terms: pa.Table, lists: pa.Table) -> pa.Table:
    """Of one bucket: the places in each block's list that hold a term, with the terms."""
    ids = terms["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    sorted_ids, words = ids[order], terms["term"].combine_chunks().take(pa.array(order)) if len(ids) else pa.array([], pa.string())
    out: dict[str, list] = {"block": [], "bucket": [], "places": []}
    picked, bounds = [], [0]
    for block, bucket, packed in zip(lists["block"].to_pylist(), lists["bucket"].to_pylist(), lists["ids"]):
        own = _large(packed.as_buffer())
        low, high = np.searchsorted(sorted_ids, own), np.searchsorted(sorted_ids, own, "right")
        times = high - low
        if not times.any():
            continue
        out["block"].append(block)
        out["bucket"].append(bucket)
        out["places"].append(_small(np.repeat(np.arange(len(own)), times)))
        picked.append(np.repeat(low, times) + ranges(times))
        bounds.append(bounds[-1] + len(picked[-1]))
    chosen = words.take(pa.array(np.concatenate(picked))) if picked else pa.array([], pa.string())
    return pa.table({
        "block": pa.array(out["block"], pa.int64()), "bucket": pa.array(out["bucket"], pa.int32()),
        "places": pa.array(out["places"], pa.binary()), "terms": _joined(chosen, np.array(bounds)),
    })


def _count_terms(parts: int):
    def run(blocks: pa.Table, placed: pa.Table) -> pa.Table:
        out = count(blocks, placed)
        give_back()
        return out

    def count(blocks: pa.Table, placed: pa.Table) -> pa.Table:
        """Of one block: documents and occurrences of each term by language and source, for each language and bucket of terms."""
        names = [f.split()[0] for f in COUNTED.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.string()), *[pa.binary()] * 4]
        columns: list[list] = [[] for _ in names]
        rows = {b: i for i, b in enumerate(blocks["bucket"].to_pylist())}
        if placed.num_rows and -1 in rows:
            head = rows[-1]
            group = _large(blocks["packed"][head].as_buffer())
            langs, sources = blocks["langs"][head].as_py(), blocks["sources"][head].as_py()
            terms, term_at = _encoded(_split(placed["terms"]))
            keys, counts, at = [], [], 0
            for bucket, packed in zip(placed["bucket"].to_pylist(), placed["places"]):
                places, row = _large(packed.as_buffer()), rows[bucket]
                docs, often = _postings(blocks["packed"][row].as_py())
                per_chunk = _large(blocks["docs"][row].as_buffer())
                starts = np.cumsum(per_chunk) - per_chunk
                times = per_chunk[places]
                pick = np.repeat(starts[places], times) + ranges(times)
                keys.append(np.repeat(term_at[at : at + len(places)], times) * len(group) + docs[pick])
                counts.append(often[pick])
                at += len(places)
            key, often = np.concatenate(keys), np.concatenate(counts)
            del keys, counts
            order = np.argsort(key, kind="stable")
            key = key[order]
            runs = _runs(key)
            n = np.add.reduceat(often[order], runs[:-1])  # a document holds a term once, whatever the chunks
            del often, order
            term, doc = np.divmod(key[runs[:-1]], len(group))
            lang_names, lang_of = _encoded(pa.array(langs, pa.string()))
            lang_names = lang_names.to_pylist()
            part = _buckets_of(terms, parts)
            # Rows of (language, bucket), in them terms, in them groups.
            place = (lang_of[group[doc]] * parts + part[term]) * len(terms) + term
            order = np.lexsort((group[doc], place))
            place, own, n = place[order], group[doc][order], n[order]
            runs = _runs(place * len(langs) + own)
            docs, n = np.diff(runs), np.add.reduceat(n, runs[:-1])
            place, own = place[runs[:-1]], own[runs[:-1]]
            each = _runs(place)  # terms of a language
            super_rows = _runs(place[each[:-1]] // len(terms))
            joined = _joined(terms.take(pa.array(place[each[:-1]] % len(terms))), super_rows)
            for i, (low, high) in enumerate(zip(super_rows[:-1].tolist(), super_rows[1:].tolist())):
                entries = slice(each[low], each[high])
                used, source = np.unique(own[entries], return_inverse=True)
                where = int(place[each[low]] // len(terms))
                for column, value in zip(columns, (
                    lang_names[where // parts], where % parts, joined[i].as_py(), [sources[g] for g in used],
                    _small(np.diff(each[low : high + 1])), _small(source), _small(docs[entries]), _small(n[entries]),
                )):
                    column.append(value)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


# --- 4: counts of languages ------------------------------------------------------------------------

def _add_up(least: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one language and bucket: occurrences of each kept term by source, and with no source in the whole language."""
        terms, at = _encoded(_split(table["terms"]))
        groups = np.concatenate([_large(x.as_buffer()) for x in table["groups"]])
        term = np.repeat(at, groups)
        names, named = _encoded(table["sources"].combine_chunks().flatten())
        starts = np.cumsum([0, *[len(x) for x in table["sources"]]])
        source = named[np.concatenate([_large(x.as_buffer()) + s for x, s in zip(table["source"], starts)])]
        docs = np.concatenate([_large(x.as_buffer()) for x in table["docs"]])
        n = np.concatenate([_large(x.as_buffer()) for x in table["n"]])
        found = np.zeros(len(terms), np.int64)
        np.add.at(found, term, docs)
        kept = found >= least
        total = np.zeros(len(terms), np.int64)
        np.add.at(total, term, n)
        key = term * len(names) + source
        order = np.argsort(key, kind="stable")
        order = order[kept[term[order]]]
        runs = _runs(key[order])
        which, whose = np.divmod(key[order][runs[:-1]], max(1, len(names)))
        sums = np.add.reduceat(n[order], runs[:-1]) if len(order) else np.zeros(0, np.int64)
        whole = np.flatnonzero(kept)
        size = len(which) + len(whole)
        return pa.table({
            "lang": pa.array([table["lang"][0].as_py()] * size, pa.string()),
            "part": pa.array(np.full(size, table["part"][0].as_py()), pa.int32()),
            "source": pa.concat_arrays([names.take(pa.array(whose)), pa.nulls(len(whole), pa.string())]),
            "term": terms.take(pa.array(np.concatenate([which, whole]))),
            "n": pa.array(np.concatenate([sums, total[whole]])),
            "total": pa.array(np.concatenate([total[which], total[whole]])),
        })

    return run


def term_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Every occurring (lang, source), and ``ADDED`` rows: occurrences of the kept terms by source and, with no source, in the language."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = LEAST_BUCKETS + size // BUCKET_BYTES
    blocks = materialize(texts.mapInArrow(lean(_count_chunks(buckets)), BLOCKS), "chunks")
    lists = blocks.filter("bucket >= 0").select("block", "bucket", "chunks", "docs")
    numbered = materialize(lists.groupBy("bucket").applyInArrow(lean_group(_number_chunks), NUMBERED), "numbered-chunks")
    lowered = F.translate("chunk", UPPER, LOWER)
    terms = materialize(
        numbered.filter("id IS NOT NULL").select("bucket", "id", "docs", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")),
        "chunk-terms",
    )
    enough = one_per_key(terms, ["term"], F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("term")
    known = terms.join(enough, "term", "left_semi").select("bucket", "id", "term")
    ids = numbered.filter("id IS NULL").select("bucket", "block", "ids")
    placed = known.groupBy("bucket").cogroup(ids.groupBy("bucket")).applyInArrow(_place_terms, PLACED)
    postings = blocks.select("block", "bucket", "docs", "packed", "langs", "sources")
    counted = postings.groupBy("block").cogroup(placed.groupBy("block")).applyInArrow(_count_terms(buckets), COUNTED)
    added = materialize(counted.groupBy("lang", "part").applyInArrow(lean_group(_add_up(least)), ADDED), "term-counts")
    named = blocks.filter("bucket < 0").select(F.explode(F.arrays_zip("langs", "sources")).alias("g"))
    return named.select(F.col("g.langs").alias("lang"), F.col("g.sources").alias("source")).distinct(), added


# --- 5: divergences --------------------------------------------------------------------------------

def _share(count: Column, mass: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / mass) in whole numbers; null where there are no terms."""
    part = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + 2)
    return F.call_function("div", part.cast("decimal(38,0)"), F.nullif(mass, F.lit(0)).cast("decimal(38,0)")) + 1


def _pair_sums(table: pa.Table) -> pa.Table:
    """Of one language, bucket and pair of tiles: f of each two sources, summed over the terms that any source of the tiles holds."""
    names = [f.split()[0] for f in PAIRS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    base = table.filter(pc.is_null(table["term"]))
    numbers = base["number"].to_numpy()
    order = np.argsort(numbers)
    numbers, sources, least = numbers[order], base["source"].combine_chunks().take(pa.array(order)), base["p"].to_numpy()[order]
    held = table.filter(pc.is_valid(table["term"]))
    terms, at = _encoded(held["term"])
    p = np.repeat(least[:, None], len(terms), axis=1)
    p[np.searchsorted(numbers, held["number"].to_numpy()), at] = held["p"].to_numpy()
    tile, first, second = numbers // TILE, table["first"][0].as_py(), table["second"][0].as_py()
    columns: list[list] = [[] for _ in names]
    for i in np.flatnonzero(tile == first):
        others = np.flatnonzero((tile == second) & (numbers > numbers[i]))
        if not len(others):
            continue
        value = _f(p[i], p[others]).sum(axis=1)
        lang, one = table["lang"][0].as_py(), sources[int(i)].as_py()
        for column, more in zip(columns, (
            [lang] * len(others), [one] * len(others), sources.take(pa.array(others)).to_pylist(), _f(least[i], least[others]).tolist(),
            value.tolist(), [len(terms)] * len(others),
        )):
            column.extend(more)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _f(p, q):
    return (p - q) * (p - q) // (p + q)


def audit(docs: DataFrame, *, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every occurring (lang, source).

    ``pair``: each other source of the language, by falling divergence from it. ``term``: the ``top`` kept terms by which
    the source exceeds its language.
    """
    groups, added = term_counts(docs, least)
    by_lang = one_per_key(added.filter("source IS NULL"), ["lang"], F.count(F.lit(1)).alias("v"), F.sum("n").alias("whole"))
    by_group = one_per_key(added.filter("source IS NOT NULL"), ["lang", "source"], F.sum("n").alias("own"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    last = F.count(F.lit(1)).over(Window.partitionBy("lang")) - 1
    zero = F.lit(0).cast("bigint")
    groups = materialize(  # one row for each (lang, source)
        groups.withColumns({"number": number, "last": last})
        .join(by_lang, "lang", "left").join(by_group, ["lang", "source"], "left")
        .select("lang", "source", "number", "last", F.coalesce("v", zero).alias("v"), F.coalesce("whole", zero).alias("whole"), F.coalesce("own", zero).alias("own"))
        .withColumn("mass", F.col("own") + 2 * F.col("v")),
        "groups",
    )
    counts = added.filter("source IS NOT NULL").join(groups, ["lang", "source"])
    counts = counts.withColumn("p", _share(F.col("n"), F.col("mass")))

    # Terms above their language's share.
    q = _share(F.col("total"), F.col("whole") + 2 * F.col("v"))
    apart = F.col("p") - F.col("q")
    above = counts.withColumn("q", q).filter(apart > 0).select(
        "lang", "source", F.col("term").alias("item"), F.call_function("div", apart * apart, F.col("p") + F.col("q")).alias("value")
    )
    order = [F.desc("value"), F.asc("item")]
    terms = top_n_per_group(above, ["lang", "source"], top, *order).withColumn("part", F.lit("term"))

    # Pairs: a source's rows go to each pair of tiles that its own tile is in.
    own, tiles = F.floor(F.col("number") / TILE), F.sequence(zero, F.floor(F.col("last") / TILE))
    met = F.explode(F.transform(tiles, lambda t: F.struct(F.least(t, own).alias("first"), F.greatest(t, own).alias("second")))).alias("_met")
    fields = ["lang", "part", F.col("_met.first").alias("first"), F.col("_met.second").alias("second"), "number", "source", "term", "p"]
    parts = added.select("lang", "part").distinct()
    bare = groups.withColumn("p", F.coalesce(_share(zero, F.col("mass")), zero)).withColumn("term", F.lit(None).cast("string"))
    # A language without kept terms has no bucket of its own, so one is made up; its pairs are of value 0.
    bare = bare.join(parts, "lang", "left").withColumn("part", F.coalesce("part", F.lit(-1)))
    rows = counts.select("*", met).select(*fields).unionByName(bare.select("*", met).select(*fields))
    sums = (
        rows.groupBy("lang", "part", "first", "second").applyInArrow(_pair_sums, PAIRS)
        .groupBy("lang", "source", "item", "none").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
        .join(groups.select("lang", "source", "v"), ["lang", "source"])
        .withColumn("value", F.when(F.col("v") > 0, F.col("value") + (F.col("v") - F.col("seen")) * F.col("none")).otherwise(zero))
    )
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("_both")
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    pairs = sums.select("lang", "value", both).select("lang", "_both.source", "_both.item", "value").withColumns({"rank": ranked, "part": F.lit("pair")})
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
