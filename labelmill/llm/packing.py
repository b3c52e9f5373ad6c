"""Problem 7: items of varying length in containers of fixed capacity.

Sum-of-squares packing: with N(g) the number of open containers that have room g left, each item
goes where the sum of all N(g)**2 becomes smallest: into an open container or a new one.  The rule
keeps the open containers spread over all gaps, so later items find one that they fill exactly.

Items are dealt at random into shards of about SHARD items, each packed by itself: a shard leaves a
few containers partly empty, which is a small part of the thousands that it fills.  An item larger
than the capacity is cut into parts that fill containers of their own and one remainder, which is
placed as an item; no other item is cut.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from labelmill.functions.names import free_name, row_hash

#: Items of a shard: enough for the waste at its end not to matter, few enough for one task.
SHARD = 50_000
#: Kinds of container that one call packs for.
MAX_BUDGETS = 1000


class SumOfSquares:
    """Open containers of one capacity."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[int]] = defaultdict(list)
        self.used = 0

    def place(self, size: int) -> int:
        """Number of the container that takes an item of 1 to capacity units.

        Of equal sums an open container is preferred to a new one, then the one with the least room.
        """
        counts = self.counts
        gaps = np.flatnonzero(counts[size:])
        after = self.capacity - size
        fresh = 2 * int(counts[after]) + 1 if after else 0
        if len(gaps):
            # Leaving gap g lowers its square by 2N(g) - 1; entering gap h raises it by 2N(h) + 1.
            change = np.where(gaps > 0, 2 * counts[gaps] + 1, 0) - 2 * counts[gaps + size] + 1
            best = int(change.argmin())
            if change[best] <= fresh:
                left = int(gaps[best])
                at = self.open[left + size].pop()
                counts[left + size] -= 1
                self._leave(at, left)
                return at
        at = self.used
        self.used += 1
        self._leave(at, after)
        return at

    def _leave(self, at: int, room: int) -> None:
        if room:
            self.open[room].append(at)
            self.counts[room] += 1

    def close_full(self, n: int) -> range:
        """n new containers that are full from the start."""
        self.used += n
        return range(self.used - n, self.used)


def pack_items(sizes: np.ndarray, capacity: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Parts in order: the item of each, its container, the unit of the item it starts at, its length.

    Items of no length go into the first container; one is opened for them if there is none.
    """
    bins = SumOfSquares(capacity)
    item, where, start, length = [], [], [], []
    nothing = []
    for i, size in enumerate(sizes.tolist()):
        if not size:
            nothing.append(i)
            continue
        at = 0
        if size > capacity:
            for c in bins.close_full(size // capacity):
                item.append(i), where.append(c), start.append(at), length.append(capacity)
                at += capacity
        if at < size:
            item.append(i), where.append(bins.place(size - at)), start.append(at), length.append(size - at)
    for i in nothing:
        item.append(i), where.append(0), start.append(0), length.append(0)
    return item, where, start, length


def _pack(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("uid")
    item, where, start, length = pack_items(rows["size"].to_numpy(), rows["capacity"][0].as_py())
    first = rows["shard"][0].as_py() << 32
    taken = rows.take(pa.array(item, pa.int64()))
    new = [pa.array(np.array(x, np.int64) + add) for x, add in ((where, first), (start, 0), (length, 0))]
    kept = [n for n in rows.column_names if n not in ("uid", "shard", "size")]
    return pa.Table.from_arrays([*[taken[n] for n in kept], *new], names=[*kept, "container", "start", "length"])


def pack(items: DataFrame, size: str, keep: list[str], budgets: list[tuple[int, int]], shard_items: int = SHARD, n_items: int | None = None) -> DataFrame:
    """For every budget (id, capacity) the container of each item.

    Gives budget_id, capacity, container_id (unique within a budget), the columns `keep`,
    start_token and n_tokens (the part of the item that is there).  Null and negative sizes count
    as 0; budgets without a positive capacity are left out; an empty table gives no rows.  Equal
    rows are items of their own.  n_items saves counting the items.
    """
    budgets = [(b, c) for b, c in budgets if c is not None and c > 0]
    if len(budgets) > MAX_BUDGETS:
        raise ValueError(f"more than {MAX_BUDGETS} budgets")
    n = items.count() if n_items is None else n_items
    shards = max(1, round(n / shard_items))
    own = items.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.greatest(F.coalesce(F.col(f"`{size}`"), F.lit(0)), F.lit(0)).cast("long").alias("size"))
    # By content and partition, so a task that is run again deals its items out as before.
    own = own.withColumn("uid", row_hash(own)).withColumn("shard", F.pmod("uid", F.lit(shards)))
    kinds = F.array(*[F.struct(F.lit(b).cast("long").alias("budget"), F.lit(c).cast("long").alias("capacity")) for b, c in budgets]) if budgets else F.array().cast("array<struct<budget:bigint,capacity:bigint>>")
    own = own.withColumn("kind", F.explode(kinds)).select("kind.budget", "kind.capacity", *[f"k{i}" for i in range(len(keep))], "size", "uid", "shard")
    new = [T.StructField(c, T.LongType()) for c in ("container", "start", "length")]
    schema = T.StructType([f for f in own.schema.fields if f.name not in ("size", "uid", "shard")] + new)
    packed = own.groupBy("budget", "shard").applyInArrow(_pack, schema)
    out, taken = [], []
    for source, name in (("budget", "budget_id"), ("capacity", "capacity"), ("container", "container_id"), *[(f"k{i}", c) for i, c in enumerate(keep)], ("start", "start_token"), ("length", "n_tokens")):
        taken.append(free_name(name, taken) if name not in keep else name)
        out.append(F.col(source).alias(taken[-1]))
    return packed.select(*out)


def usage(packed: DataFrame) -> DataFrame:
    """Containers, tokens and the share of unused room for each budget, with the fewest containers
    that any packing could need."""
    each = packed.groupBy("budget_id", "capacity", "container_id").agg(F.sum("n_tokens").alias("filled"))
    by = each.groupBy("budget_id", "capacity").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("filled").alias("n_tokens"), F.max("filled").alias("fullest"))
    return by.select("*", F.ceil(F.col("n_tokens") / F.col("capacity")).alias("least_containers"), (1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity"))).alias("unused_share"))
