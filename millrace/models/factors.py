"""Matrix factors as tables: alternating half steps, scores and ranked lists by plain joins and aggregates.

A factor table has one row for each key: (key, ``factors`` array of ``rank`` numbers). With one side fixed,
every key of the other side has its own small least-squares problem (sum vv' + reg n I) u = sum r v over its n ratings, whose
sums are mergeable: a key with a third of all ratings is summed in every task before it travels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.operators.relational import one_per_key, top_n_per_group
from millrace.workspace import materialize

BLOCK_ROWS = 2048  # factor rows of a block, about
USER_BLOCKS, ITEM_BLOCKS = 8, 32  # blocks that meet in a cell, at most
FEW_CELLS, MOST_ITEM_BLOCKS = 64, 128  # where there are more cells than a few, they have up to so many blocks of items
CELL_ROWS = 1 << 20  # listed rows of a cell, about
MOST_TASKS = 4096
SLICE_USERS, SLICE_ITEMS = 256, 2048  # factor rows scored at once
_TINY = 1e-290  # products above it keep their precision


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _solved(rank: int, reg: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = np.triu_indices(rank)
        for batch in batches:
            sums = np.stack([c.to_numpy() for c in batch.columns[2:]], axis=1)
            n = batch.column(1).to_numpy()
            a = np.zeros((len(n), rank, rank))
            a[:, upper[0], upper[1]] = a[:, upper[1], upper[0]] = sums[:, rank:]
            a += reg * n[:, None, None] * np.eye(rank)
            # Without regularisation the sums may be singular; then the shortest solution is taken.
            u = np.linalg.solve(a, sums[:, :rank, None])[:, :, 0] if reg > 0 else (np.linalg.pinv(a, hermitian=True) @ sums[:, :rank, None])[:, :, 0]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * rank, pa.int32()), pa.array(u.ravel()))
            yield pa.record_batch([batch.column(0), lists], [batch.schema.names[0], "factors"])

    return run


def half_step(ratings: DataFrame, fixed: DataFrame, *, on: str, solve: str, rank: int, reg: float, rating: str = "rating") -> DataFrame:
    """Best factors of every ``solve`` key with the factors of the ``on`` keys fixed: (solve, factors).

    Ratings whose ``on`` key has no factors are left out. One join and one aggregate, whose sums are solved by key.
    """
    v = [F.col("factors")[i] for i in range(rank)]
    r = F.col(rating).cast("double")
    sums = [F.sum(r * v[i]).alias(f"_b{i}") for i in range(rank)]
    sums += [F.sum(v[i] * v[j]).alias(f"_a{i}_{j}") for i in range(rank) for j in range(i, rank)]
    summed = ratings.select(solve, on, rating).join(fixed.select(on, "factors"), on).groupBy(solve).agg(F.count(F.lit(1)).cast("double").alias("_n"), *sums)
    if rank == 1:
        share = F.col("_b0") / (F.col("_a0_0") + F.lit(reg) * F.col("_n"))
        return summed.select(solve, F.array(share).alias("factors"))
    schema = T.StructType([summed.schema[solve], T.StructField("factors", T.ArrayType(T.DoubleType()))])
    return summed.mapInArrow(_solved(rank, reg), schema)


def seeded_factors(keys: DataFrame, key: str, rank: int, seed: int) -> DataFrame:
    """Starting factors between 0 and 1 / sqrt(rank), by a hash of the key: the same whatever the partitions."""
    parts = [F.pmod(F.xxhash64(F.lit(seed), F.lit(i), key), F.lit(1 << 30)) / float((1 << 30) * rank**0.5) for i in range(rank)]
    return one_per_key(keys.select(key), [key]).select(key, F.array(*parts).alias("factors"))


def alternate(
    ratings: DataFrame, *, rank: int, rounds: int, reg: float, seed: int = 0, start: DataFrame | None = None,
    user: str = "user", item: str = "item", rating: str = "rating",
) -> tuple[DataFrame, DataFrame]:
    """User and item factors after ``rounds`` of users from items, items from users.

    ``start`` gives the first item factors. Each half step's factors are stored in the shared folder, so a lost
    executor repeats one half step at most; ``ratings`` is scanned twice a round and should be stored as well.
    """
    users, items = None, start if start is not None else seeded_factors(ratings, item, rank, seed)
    for _ in range(rounds):
        users = materialize(half_step(ratings, items, on=item, solve=user, rank=rank, reg=reg, rating=rating), "user-factors")
        items = materialize(half_step(ratings, users, on=user, solve=item, rank=rank, reg=reg, rating=rating), "item-factors")
    return users, items


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, *, user: str = "user", item: str = "item", output: str = "prediction") -> DataFrame:
    """All pairs with the product of their factors, null where either has none."""
    u = users.select(user, F.col("factors").alias("_u"))
    v = items.select(item, F.col("factors").alias("_v"))
    return pairs.join(u, user, "left").join(v, item, "left").select(*pairs.columns, dot("_u", "_v").alias(output))


def loss(ratings: DataFrame, users: DataFrame, items: DataFrame, *, reg: float, user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """What the half steps lower, one row: squared errors, and reg times the squared factors of both sides for every rating."""
    u = users.select(user, F.col("factors").alias("_u"))
    v = items.select(item, F.col("factors").alias("_v"))
    error = F.col(rating) - dot("_u", "_v")
    return ratings.join(u, user).join(v, item).agg(F.sum(error * error + reg * (dot("_u", "_u") + dot("_v", "_v"))).alias("loss"))


# --- ranked lists ------------------------------------------------------------------------------------

def _blocked(table: DataFrame, key: str, output: str) -> tuple[DataFrame, int]:
    """Rows (slot, output list of (key, factors)), a block of about ``BLOCK_ROWS`` each, and the number of slots."""
    slots = -(-max(1, table.count()) // BLOCK_ROWS)
    slot = F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("slot")
    short = table.schema["factors"].dataType.elementType == T.FloatType()  # floats travel as they are
    factors = F.col("factors") if short else F.col("factors").cast("array<double>")
    blocks = table.select(slot, F.struct(F.col(key).alias("key"), factors.alias("factors")).alias("_row"))
    return blocks.groupBy("slot").agg(F.collect_list("_row").alias(output)), slots


def _matrix(rows: pa.StructScalar) -> tuple[pa.Array, np.ndarray]:
    values = rows.values
    factors = values.field("factors")
    return values.field("key"), factors.flatten().to_numpy().reshape(len(values), -1).astype(float, copy=False)


def _joined(blocks: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    parts = [_matrix(x) for x in blocks]
    return pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _best_rows(u: np.ndarray, v: np.ndarray, n: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``v`` and scores of the ``n`` best for each row of ``u``: by falling score, of equals the first row, NaN last.

    ``v`` is scored in slices. After the first, only scores above the n-th best so far are sorted, a few of each slice; in the
    first too where ``floor`` gives a score below the n best of each row of ``u``.
    """
    at, best = np.zeros((len(u), 0), np.int64), np.zeros((len(u), 0))
    if floor is not None:
        at, best = np.full((len(u), n), len(v)), np.repeat(floor[:, None], n, axis=1)
    for low in range(0, len(v), SLICE_ITEMS):
        scores = u @ v[low : low + SLICE_ITEMS].T
        if best.shape[1] < n:
            rows = np.broadcast_to(np.arange(low, low + scores.shape[1]), scores.shape)
            at, best = np.concatenate([at, rows], axis=1), np.concatenate([best, scores], axis=1)
            top = np.argsort(-best, axis=1, kind="stable")[:, :n]
            at, best = np.take_along_axis(at, top, 1), np.take_along_axis(best, top, 1)
            continue
        least = np.where(np.isnan(best[:, -1]), -np.inf, best[:, -1])
        row, column = np.divmod(np.flatnonzero(scores > least[:, None]), scores.shape[1])
        if not len(row):
            continue
        changed = np.unique(row)
        owner = np.concatenate([np.repeat(changed, n), row])
        place = np.concatenate([at[changed].ravel(), column + low])
        score = np.concatenate([best[changed].ravel(), scores[row, column]])
        order = np.lexsort((place, -score, owner))
        starts = np.searchsorted(owner[order], changed)
        first = order[starts[:, None] + np.arange(n)]
        at[changed], best[changed] = place[first], score[first]
    return at, best


def _bounds(u: np.ndarray, longest: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``u`` a score below the ``n`` best of ``longest``, and the norm a row needs to score more, as uv <= |u| |v|.

    Both leave room for rounding and are -inf where nothing follows: the n-th best is not positive, or numbers are out of range.
    """
    nth = np.concatenate([-np.partition(-(u[low : low + SLICE_USERS] @ longest.T), n - 1, axis=1)[:, n - 1] for low in range(0, len(u), SLICE_USERS)])
    norm = np.hypot.reduce(u, axis=1)
    with np.errstate(invalid="ignore", over="ignore"):
        floor = nth - 1e-9 * norm * np.hypot.reduce(longest, axis=1).max()
    known = np.isfinite(floor) & (floor > _TINY) & (norm > _TINY)
    unknown = np.full(len(u), -np.inf)
    return np.where(known, floor, unknown), np.divide(floor, norm, out=unknown.copy(), where=known)


def _best(n: int, schema: pa.Schema):
    def run(users: pa.Table, items: pa.Table) -> pa.Table:
        out = []
        if users.num_rows and items.num_rows:
            item, v = _joined(items["items"])
            by_key = pc.sort_indices(item)  # of equal scores the least item comes first
            item, v = item.take(by_key), v[by_key.to_numpy()]
            user, u = _joined(users["users"])
            norms = np.nan_to_num(np.hypot.reduce(v, axis=1), nan=np.inf, posinf=np.inf)
            probed = max(n, SLICE_ITEMS)
            unknown = np.full(len(u), -np.inf)
            floor, least = _bounds(u, v[np.argpartition(-norms, probed)[:probed]], n) if len(v) > probed else (unknown, unknown)
            order = np.argsort(least, kind="stable")
            for low in range(0, len(u), SLICE_USERS):
                mine = order[low : low + SLICE_USERS]
                long = np.flatnonzero(norms >= least[mine[0]])
                at, best = _best_rows(u[mine], v[long], n, floor[mine] if np.isfinite(least[mine[0]]) else None)
                whose = pa.array(np.repeat(mine, at.shape[1]))
                out.append(pa.record_batch([user.take(whose), item.take(pa.array(long[at.ravel()])), pa.array(best.ravel())], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def top_items(users: DataFrame, items: DataFrame, n: int, *, user: str = "user", item: str = "item") -> DataFrame:
    """The ``n`` best items of the whole catalogue for every user: (user, item, prediction, rank).

    Factors travel in blocks, and blocks meet in cells, up to ``USER_BLOCKS`` of users and ``ITEM_BLOCKS`` of items each, or
    ``MOST_ITEM_BLOCKS`` where that leaves enough cells. A cell leaves ``n`` items a user, and the lists of a user are merged
    and cut to ``n`` again in the tasks. No list above ``n`` is shuffled. Of equal scores the least item is first. An item is
    scored unless its norm shows that it cannot be listed, so the work is users times items at worst; no side is ever
    broadcast, since Spark cannot foresee how the copies of the blocks add up.
    """
    user_blocks, user_slots = _blocked(users, user, "users")
    item_blocks, item_slots = _blocked(items, item, "items")
    wide = max(1, min(USER_BLOCKS, CELL_ROWS // (n * BLOCK_ROWS)))
    across = -(-user_slots // wide)
    down = max(-(-item_slots // MOST_ITEM_BLOCKS), min(-(-item_slots // ITEM_BLOCKS), -(-FEW_CELLS // across)))
    spread = min(across * down, MOST_TASKS)
    own, all_x, all_y = F.col("slot"), F.explode(F.sequence(F.lit(0), F.lit(across - 1))), F.explode(F.sequence(F.lit(0), F.lit(down - 1)))
    left = user_blocks.select((own % across).alias("x"), all_y.alias("y"), "users").repartition(spread, "x", "y")
    right = item_blocks.select(all_x.alias("x"), (own % down).alias("y"), "items").repartition(spread, "x", "y")
    schema = T.StructType([
        T.StructField("user", users.schema[user].dataType), T.StructField("item", items.schema[item].dataType), T.StructField("prediction", T.DoubleType()),
    ])
    listed = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInArrow(_best(n, to_arrow_schema(schema)), schema)
    return top_n_per_group(listed, ["user"], n, F.col("prediction").desc(), F.col("item"))
