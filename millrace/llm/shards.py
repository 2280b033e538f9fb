"""A uniform shuffle of a table larger than memory, written as numbered shards.

Two passes. The first counts the rows of ``buckets`` chosen by a seeded hash, which gives
every bucket its place in the order of the whole table. The second scatters the rows to
their buckets, sized to fit a task's memory, and each bucket is put in order by a
Fisher-Yates shuffle with a seed of its own. Rows of neighbouring places make a shard, so
shards differ by one row at most (law ``rows``).

The result depends on the rows, the seed and the number of buckets only, not on partitions
or on which executor did the work. Copies of a text are scattered by their ids.

Defined results: a null id or text is a value like any other; repeated rows all stay; an empty
table has no shards; existing columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.blocks import text_bytes, whole_row
from millrace.llm.settings import tuned
from millrace.workspace import fresh_path

SHARDS, SEED = 8, 20240817
BUCKET_BYTES = 64 << 20
# Smaller tables are cut finer, so that many tasks share them: up to MANY buckets of FINE_BYTES.
MANY, FINE_BYTES = 1024, 2 << 20
BROADCAST = 1 << 17  # buckets whose places are broadcast


def _hash(docs: DataFrame, salt: int) -> Column:
    """Hash of a row: its id and text, and whatever else can be hashed."""
    first = [c for c in ("doc_id", "text") if c in docs.columns]
    rest = [f.name for f in docs.schema if f.name not in first and isinstance(f.dataType, T.AtomicType)]
    return F.xxhash64(F.lit(salt), *[F.isnull(F.col(f"`{c}`")) for c in first], *[F.col(f"`{c}`") for c in [*first, *rest]])


def fisher_yates(n: int, seed: int) -> list[int]:
    """A uniform permutation of 0 .. n-1: every place swaps with one not yet settled."""
    order = list(range(n))
    draws = np.random.default_rng(seed).integers(0, np.arange(n, 0, -1)) if n else []
    for i, step in enumerate(draws):
        j = i + int(step)
        order[i], order[j] = order[j], order[i]
    return order


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` and ``slot``, their place in the shard."""
    tuned(docs.sparkSession)
    docs = docs.drop("shard", "slot")
    total = text_bytes(docs)
    buckets = max(1, math.ceil(total / bucket_bytes), min(MANY, math.ceil(total / FINE_BYTES)))
    bucket = F.pmod(_hash(docs, seed), F.lit(buckets)).cast("int")
    rows = docs.select(whole_row(docs), bucket.alias("_bucket"), _hash(docs, seed + 1).alias("_order"))

    # One row for each bucket: MANY, or one for each BUCKET_BYTES of text.
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = docs.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    places = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_first"),
        F.sum("_size").over(Window.partitionBy(F.lit(0))).alias("_all"),
    )
    names = docs.columns

    def settle(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, sort_keys=[("_order", "ascending")])
        own = (seed * 1_000_003 + table.column("_bucket")[0].as_py()) % (1 << 63)
        table = table.take(order.take(pa.array(fisher_yates(table.num_rows, own))))
        first, total = table.column("_first")[0].as_py(), table.column("_all")[0].as_py()
        place = np.arange(first, first + table.num_rows)
        shard = place * shards // total
        slot = place - -(-shard * total // shards)
        values = table.column("row").combine_chunks().flatten()
        return pa.table([*values, pa.array(shard, pa.int32()), pa.array(slot, pa.int64())],
                        names=[*names, "shard", "slot"])

    out = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    # A place is some 50 bytes; beyond BROADCAST of them they are joined like any table.
    sent = F.broadcast(places) if buckets <= BROADCAST else places
    return rows.join(sent, "_bucket").groupBy("_bucket").applyInArrow(settle, out)


def write_shards(docs: DataFrame, path: str | None = None, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Write the shuffled table below ``path`` (by default in the shared folder), a folder a shard, and read it back.

    The files are the result; who called owns them.
    """
    spark = tuned(docs.sparkSession)
    path = path or fresh_path(spark, "shards")
    ready = shuffled(docs, shards, seed)
    ready.write.partitionBy("shard").parquet(path)
    return spark.read.schema(ready.schema).parquet(path)


def shard_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of the written shards."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return write_shards(docs.select("doc_id", "text")).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
