"""Per-key results and joins when a handful of keys own most of the rows.

Fragment and replicate by estimated load.  One pass counts rows by hash bucket of their key: the
load of a key is at most that of its bucket, and the counters are `BUCKETS` for each task, however
many keys or rows there are.  A bucket that is heavier than a fraction of one task's share, which
is one with a large key, is split into shards in proportion to its load.  Shards and whole buckets
are bin-packed, longest first, into tasks of nearly equal load, and every row is sent to the
partition of its task.  The matching side of a join is copied only to the tasks that hold a shard
of its bucket.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from labelmill.functions.names import free_name, row_hash

#: A bucket is split once it is heavier than 1 / SPLIT of the mean load of a task.
SPLIT = 4
#: Hash buckets for each task: the light keys that share a bucket with a large one, and are
#: replicated with it, are this small a part of a task's keys.
BUCKETS = 64


@dataclass
class LoadPlan:
    """Where the rows of every key go.

    counts: rows of each bucket; places: its tasks, one for each shard; loads: planned rows of
    each task; total: all rows.
    """

    keys: list[str]
    tasks: int
    total: int = 0
    counts: list[int] = field(default_factory=list)
    places: list[list[int]] = field(default_factory=list)
    loads: list[int] = field(default_factory=list)

    def at_least(self, rows: float) -> list[int]:
        """Buckets that may hold a key of so many rows; all others cannot."""
        return [b for b, n in enumerate(self.counts) if n >= rows]


def pack_loads(items: list[int], tasks: int) -> tuple[list[int], list[int]]:
    """Longest-processing-time packing: the task of each item, and the load of each task."""
    heap = [(0, t) for t in range(tasks)]
    where, loads = [0] * len(items), [0] * tasks
    for i in sorted(range(len(items)), key=lambda i: (-items[i], i)):
        load, t = heapq.heappop(heap)
        where[i] = t
        loads[t] = load + items[i]
        heapq.heappush(heap, (loads[t], t))
    return where, loads


def bucket_of(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(n)).cast("int")


def default_tasks(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def plan_loads(df: DataFrame, keys: list[str], tasks: int | None = None) -> LoadPlan:
    """Count rows by bucket, in one pass over the keys, and pack buckets and shards into tasks.  A
    null key is a key of its own.  What reaches the driver are BUCKETS numbers for each task."""
    tasks = tasks or default_tasks(df)
    counts = [0] * (tasks * BUCKETS)
    for r in df.groupBy(bucket_of(keys, len(counts)).alias("bucket")).agg(F.count(F.lit(1)).alias("load")).collect():
        counts[r["bucket"]] = r["load"]
    plan = LoadPlan(list(keys), tasks, sum(counts), counts)
    limit = max(1, plan.total // (tasks * SPLIT))
    shards = [max(1, -(-n // limit)) for n in counts]
    where, plan.loads = pack_loads([-(-n // s) for n, s in zip(counts, shards) for _ in range(s)], tasks)
    at = 0
    for s in shards:
        plan.places.append(where[at : at + s])
        at += s
    return plan


def _with_places(df: DataFrame, plan: LoadPlan, name: str, keys: list[str] | None = None) -> DataFrame:
    """df with an array of the tasks that hold a shard of its key."""
    bucket, own = free_name("bucket", [*df.columns, name]), free_name("owners", [*df.columns, name])
    # BUCKETS rows and fewer than BUCKETS + SPLIT places for each task, whatever the size of df.
    known = df.sparkSession.createDataFrame(list(enumerate(plan.places)), f"`{bucket}` int, `{own}` array<int>")
    out = df.withColumn(bucket, bucket_of(keys or plan.keys, len(plan.places))).join(F.broadcast(known), bucket, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.col(own).alias(name))


def _assign(df: DataFrame, plan: LoadPlan, name: str, turn: Column) -> DataFrame:
    places = free_name("places_", [*df.columns, name])
    shard = F.pmod(turn, F.size(places).cast("long")).cast("int")
    return _with_places(df, plan, places).withColumn(name, F.element_at(places, shard + 1)).drop(places)


def assign_tasks(df: DataFrame, plan: LoadPlan, name: str, ordered: bool = False) -> DataFrame:
    """df with the task of each row; the rows of a split bucket are spread over its shards.

    The shard is a hash of the row and its partition, so a task that is run again sends every row
    where it went before, in whatever order its rows come.  Equal rows of one partition stay
    together, unless `ordered` says that rows come in the same order again, as they do from files:
    then they are dealt out one by one.
    """
    turn = row_hash(df)
    return _assign(df, plan, name, turn + F.monotonically_increasing_id() % F.lit(1 << 20) if ordered else turn)


def placed_totals(df: DataFrame, keys: list[str], sums: list[str], *, rows: str, plan: LoadPlan, task: str) -> DataFrame:
    """Totals of each shard of each key, in the partition of its planned task.

    Rows are combined before anything is shuffled; all rows of a key in one map task go to one
    shard, so what is moved is a row for each key of a map task, and then one for each key and shard.
    """
    own = df.select(*dict.fromkeys([*keys, *sums]))
    turn = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.spark_partition_id())
    shards = _assign(own, plan, task, turn).groupBy(*keys, task).agg(F.count(F.lit(1)).alias(rows), *[F.sum(s).alias(f"sum_{s}") for s in sums])
    return shards.repartitionById(plan.tasks, F.col(task))


def balanced_totals(df: DataFrame, keys: list[str], sums: list[str], *, rows: str = "n_rows", tasks: int | None = None, plan: LoadPlan | None = None) -> DataFrame:
    """Number of rows and sums of columns for every key, without a task that carries a hot key.

    Every shard of a key is totalled by itself in its planned task; the totals of the shards are
    then added.  Null keys form a group; null values are skipped, and a sum over nothing but nulls
    is null.  An empty table gives no rows.
    """
    plan = plan or plan_loads(df, keys, tasks)
    task = free_name("task", df.columns)
    rows = free_name(rows, [*keys, *[f"sum_{s}" for s in sums]])
    shards = placed_totals(df, keys, sums, rows=rows, plan=plan, task=task)
    return shards.groupBy(*keys).agg(F.sum(rows).alias(rows), *[F.sum(f"sum_{s}").alias(f"sum_{s}") for s in sums])


def balanced_rows(df: DataFrame, keys: list[str], *, tasks: int | None = None, plan: LoadPlan | None = None, task: str = "task", ordered: bool = False) -> DataFrame:
    """df with its rows in one partition for each planned task, and the task as a column.

    For work on the rows that cannot be combined beforehand: grouping by keys and task takes no
    further shuffle; then merge the results of the shards of a key.
    """
    plan = plan or plan_loads(df, keys, tasks)
    return assign_tasks(df, plan, task, ordered).repartitionById(plan.tasks, F.col(task))


def fragment_replicate_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", *, tasks: int | None = None, plan: LoadPlan | None = None, ordered: bool = False, task: str | None = None) -> DataFrame:
    """left joined with right on equal keys, the hot keys of left spread over many tasks.

    how: inner or left.  Rows of right go to every shard of their bucket and nowhere else, so those
    of a bucket without a large key are sent once.  Null keys match nothing.  Columns of right that
    clash with one of left get underscores appended.  The result lies where the plan put the rows
    of left; with `task` that column is kept, and grouping by it and more takes no further shuffle.
    ordered: see assign_tasks.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    plan = plan or plan_loads(left, keys, tasks)
    kept = task is not None
    task = free_name(task or "task", [*left.columns, *right.columns])
    names: dict[str, str] = {}
    for c in right.columns:
        names[c] = free_name(f"{c}_r" if c in keys else c, [*left.columns, task, *names.values()])
    places = free_name("places", right.columns)
    shard = free_name("shard", [*left.columns, *names.values(), task])
    other = _with_places(right, plan, places, keys).withColumn(shard, F.explode(F.array_distinct(places)))
    other = other.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], shard).repartitionById(plan.tasks, F.col(shard))
    on = F.col(task) == F.col(shard)
    for k in keys:
        on = on & (F.col(f"`{k}`") == F.col(f"`{names[k]}`"))
    joined = balanced_rows(left, keys, plan=plan, task=task, ordered=ordered).join(other.hint("shuffle_hash"), on, how)
    return joined.drop(shard, *([] if kept else [task]), *[names[k] for k in keys])
