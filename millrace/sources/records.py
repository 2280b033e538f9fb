"""CSV records that run over line ends, from files cut into splits anywhere.

A quoted value may hold line ends, so whether a line begins a record depends on what stands before it, in
another split perhaps. A line is a function of two states, outside and inside a quoted value: it tells the state after
it for either state before. Functions of lines compose, so a first scan sums up each split in one row, a window over these
rows gives every split its own first state, and a second scan joins the lines of its records. A
record that crosses the border of splits leaves a fragment in each, and the fragments of a record, few and of its size, are
put together by its key. Files are never read whole by one task, and lines are handled as arrays.

A quote opens a value only at the start of a field; a doubled quote within a value is a quote, what
follows a closing quote up to the delimiter belongs to the value, and a quote in the middle of an unquoted field is a character. A quote that is
never closed makes the rest of its file one record.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A closed field; the fields of a line up to an open one; the contents of an open value.
_FIELD = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^",][^,]*)?'
_OPENS = rf'(?:{_FIELD},)*"(?:[^"]|"")*$'
_FROM_OUTSIDE = rf"^{_OPENS}"
_FROM_INSIDE = rf'^(?:[^"]|"")*(?:"(?:[^",][^,]*)?,{_OPENS}|$)'

_SPLITS = "file bigint, start bigint, kind int, starts0 boolean, starts1 boolean"
_RECORDS = "file bigint, start bigint, part int, value string"
_TO_OUTSIDE, _TO_INSIDE, _SAME, _OTHER = range(4)  # what a split does to the state


def _ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each line whether it ends inside a quoted value, begun outside and begun inside of one."""
    outside, inside = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quoted):
        some = lines.take(pa.array(quoted))
        outside[quoted] = pc.match_substring_regex(some, _FROM_OUTSIDE).to_numpy(zero_copy_only=False)
        inside[quoted] = pc.match_substring_regex(some, _FROM_INSIDE).to_numpy(zero_copy_only=False)
    return outside, inside


def _states(outside: np.ndarray, inside: np.ndarray, first: bool) -> np.ndarray:
    """The state before each line and after the last, from ``first``."""
    turned = np.cumsum(outside & ~inside)
    fixed = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    held = np.maximum(fixed, 0)
    since = np.where(fixed >= 0, turned - turned[held], turned) % 2 == 1
    return np.concatenate([[first], np.where(fixed >= 0, outside[held], first) ^ since])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array]]:
    """(file, start, lines) for the consecutive lines of one split."""
    if not batch.num_rows:
        return
    file, start = batch.column("file").to_numpy(), batch.column("start").to_numpy()
    bounds = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1).tolist(), batch.num_rows]
    for low, high in zip(bounds, bounds[1:]):
        yield int(file[low]), int(start[low]), batch.column("value").slice(low, high - low)


def _below_header(start: int, seen: int, lines: pa.Array, skip: int, header: str) -> pa.Array:
    """The lines without those of the preamble and the header, which only the first split of a file has."""
    if start or seen > skip:
        return lines
    if seen + len(lines) > skip:
        found = lines[skip - seen].as_py().rstrip("\r")
        if found != header:
            raise ValueError(f"a file has the header {found!r}, not {header!r}")
    return lines.slice(min(len(lines), skip + 1 - seen))


def _sum_up(skip: int, header: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            kind = _SAME if after == [False, True] else _OTHER if after == [True, False] else _TO_INSIDE if after[0] else _TO_OUTSIDE
            return pa.record_batch(
                [pa.array([own[0]]), pa.array([own[1]]), pa.array([kind], pa.int32()), pa.array([began[0]]), pa.array([began[1]])],
                ["file", "start", "kind", "starts0", "starts1"],
            )

        own, after, began, seen = None, [False, True], [False, False], 0
        for batch in batches:
            for file, start, lines in _runs(batch):
                if own != (file, start):
                    if own is not None:
                        yield row()
                    own, after, began, seen = (file, start), [False, True], [False, False], 0
                rest = _below_header(start, seen, lines, skip, header)
                seen += len(lines)
                ends = _ends(rest)
                for first in (0, 1):
                    states = _states(*ends, after[first])
                    began[first] |= bool((~states[:-1]).any())
                    after[first] = bool(states[-1])
        if own is not None:
            yield row()

    return run


def _records(skip: int, header: str, inside: dict[int, set[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(part: int, values: list[str] | pa.Array) -> pa.RecordBatch:
            values = values if isinstance(values, pa.Array) else pa.array(values, pa.string())
            n = len(values)
            return pa.record_batch(
                [pa.array(np.full(n, own[0])), pa.array(np.full(n, own[1])), pa.array(np.full(n, part), pa.int32()), values],
                ["file", "start", "part", "value"],
            )

        own, state, seen = None, False, 0
        held: list[str] | None = None  # lines of the record that is open so far
        lead = False  # whether it began in an earlier split
        for batch in batches:
            for file, start, lines in _runs(batch):
                if own != (file, start):
                    if own is not None and held is not None:
                        yield rows(1 if lead else 2, ["\n".join(held)])
                    own, seen = (file, start), 0
                    state = lead = start in inside.get(file, ())
                    held = [] if state else None
                rest = _below_header(start, seen, lines, skip, header)
                seen += len(lines)
                if not len(rest):
                    continue
                states = _states(*_ends(rest), state)
                state = bool(states[-1])
                first = np.flatnonzero(~states[:-1])  # lines that begin a record
                head = int(first[0]) if len(first) else len(rest)
                if head:  # they go on with the record that is open
                    held += rest.slice(0, head).to_pylist()
                if held is not None and (len(first) or not state):
                    yield rows(1 if lead else 0, ["\n".join(held)])
                    held, lead = None, False
                if not len(first):
                    continue
                last = int(first[-1]) if state else len(rest)  # where the record begins that stays open
                if state:
                    held, first = rest.slice(last).to_pylist(), first[:-1]
                if len(first) == last - head:
                    whole = rest.slice(head, last - head)
                else:
                    bounds = np.append(first, last) - head
                    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rest.slice(head, last - head)), "\n")
                yield rows(0, whole)
        if own is not None and held is not None:
            yield rows(1 if lead else 2, ["\n".join(held)])

    return run


def scan_records(spark: SparkSession, path: str, skip: int, header: str) -> DataFrame:
    """(value) of every record below the header of each file of ``path``; empty lines between records are none.

    Two scans. The driver learns which splits begin inside a quoted value, a pair of numbers each. Lines end
    with ``\\n`` or ``\\r\\n``; the preamble and the header lie in the first split of a file.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    splits = lines.mapInArrow(_sum_up(skip, header), _SPLITS)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # one row for each split
    turned = F.sum((F.col("kind") == _OTHER).cast("int")).over(before.rowsBetween(Window.unboundedPreceding, 0))
    fixed = F.when(F.col("kind").isin(_TO_OUTSIDE, _TO_INSIDE), F.struct((F.col("kind") == _TO_INSIDE).cast("int").alias("state"), F.col("turned").alias("at")))
    last = F.last("fixed", ignorenulls=True).over(before)
    turns = F.coalesce(F.lag("turned").over(Window.partitionBy("file").orderBy("start")), F.lit(0))
    inside = (F.coalesce("last.state", F.lit(0)) + turns - F.coalesce("last.at", F.lit(0))) % 2 == 1
    placed = splits.withColumn("turned", turned).withColumn("fixed", fixed).withColumns({"last": last, "turns": turns}).withColumn("inside", inside)
    begins = F.when(F.when(F.col("inside"), F.col("starts1")).otherwise(F.col("starts0")), F.col("start"))
    owned = placed.withColumn("owner", F.last(begins, ignorenulls=True).over(before)).filter("inside").select("file", "start", "owner").collect()
    if not owned:
        records = lines.mapInArrow(_records(skip, header, {}), _RECORDS).select("value")
    else:
        within: dict[int, set[int]] = {}
        for r in owned:
            within.setdefault(r["file"], set()).add(r["start"])
        found = lines.mapInArrow(_records(skip, header, within), _RECORDS)
        owners = spark.createDataFrame(owned, "file bigint, start bigint, owner bigint")
        parts = found.filter("part > 0").join(owners, ["file", "start"], "left").select(
            "file", F.when(F.col("part") == 1, F.col("owner")).otherwise(F.col("start")).alias("owner"), "start", "value"
        )
        joined = parts.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))
        across = joined.select(F.concat_ws("\n", F.transform("parts", lambda p: p["value"])).alias("value"))
        records = found.filter("part = 0").select("value").unionAll(across)
    return records.select(F.rtrim("value", F.lit("\r")).alias("value")).filter("value <> ''")
