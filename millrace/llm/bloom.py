"""A Bloom filter of bounded size that executors fill together.

It thins rows out before an exact join. Its size is bounded by ``BITS`` whatever it holds, so it
can be broadcast; overfull, it lets more rows through and the join stays right.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import U64, lean

BITS = 1 << 27
SLICES = 64


class Filter:
    """Two probes into some ``each`` bits for each member, up to ``BITS``; members are well-mixed 64-bit hashes.

    A hash that is no member passes with probability (2 / each)^2 or less, as long as ``BITS`` are enough.
    """

    def __init__(self, members: int, each: int = 16):
        bits = 1 << 16
        while bits < BITS and bits < each * members:
            bits *= 2
        self.mask = U64(bits - 1)
        self.bytes = np.zeros(bits // 8, np.uint8)

    def _probes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (hashes & self.mask).astype(np.int64), ((hashes >> U64(32)) & self.mask).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        for at in self._probes(hashes):
            np.bitwise_or.at(self.bytes, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be members."""
        one, two = self._probes(hashes)
        first = np.flatnonzero((self.bytes[one >> 3] >> (one & 7).astype(np.uint8)) & 1)
        two = two[first]
        return first[((self.bytes[two >> 3] >> (two & 7).astype(np.uint8)) & 1) == 1]


def press(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(x.tobytes())


def plain(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def filled(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], members: int, each: int = 16):
    """A broadcast filter of the hashes in all batches of ``rows``. Executors merge the tasks' filters in slices; only the whole comes back."""
    schema = "slice bigint, bits binary"

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Filter(members, each)
        for batch in batches:
            for hashes in hashes_of(batch):
                part.add(hashes)
        yield pa.record_batch([pa.array(np.arange(SLICES)), pa.array([press(x) for x in np.split(part.bytes, SLICES)], pa.binary())], ["slice", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        whole = None
        for raw in table.column("bits"):
            bits = plain(raw.as_buffer(), np.uint8)
            whole = bits.copy() if whole is None else np.bitwise_or(whole, bits, out=whole)
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([press(whole)], pa.binary())})

    whole = Filter(members, each)
    step = len(whole.bytes) // SLICES
    for row in rows.mapInArrow(lean(fill), schema).groupBy("slice").applyInArrow(merge, schema).collect():
        whole.bytes[row.slice * step : (row.slice + 1) * step] = plain(row.bits, np.uint8)
    return rows.sparkSession.sparkContext.broadcast(whole)


def shared_filter(rows: DataFrame, column: str, each: int = 16):
    """A broadcast filter of the distinct hashes in a bigint column."""
    members = rows.select(F.col(column).alias("_hash")).distinct()
    return filled(members, lambda batch: iter([batch.column("_hash").to_numpy().view(U64)]), members.count(), each)
