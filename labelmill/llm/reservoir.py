"""Problem 1: a uniform sample of fixed size from data of unknown length.

Every input partition runs a skip-based reservoir (Algorithm L): once the reservoir is full, the
number of rows to pass over is drawn from its geometric law, so only rows that enter are touched.
The rows are counted on the way.  Reservoirs are then merged along a tree: how many rows of the
merged sample come from each reservoir is a hypergeometric draw over the numbers of rows that the
reservoirs stand for, and that many of its rows are taken at random.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from labelmill.llm.trees import merge_up

#: Reservoirs that one task merges: they are far larger than other states.
FAN_IN = 64
#: numpy draws hypergeometric numbers only from populations below this.
_NUMPY_LIMIT = 10**9


class Skipper:
    """Which rows of a stream enter a reservoir of k, and the slot that each one takes."""

    def __init__(self, k: int, rng: np.random.Generator) -> None:
        self.k, self.rng, self.seen = k, rng, 0
        self.log_w = np.log(rng.random()) / k if k else 0.0
        self.next = k + self._skip() if k else None  # number (from 0) of the next row to enter

    def _skip(self) -> int:
        w = np.exp(self.log_w)
        return int(np.log(self.rng.random()) / np.log1p(-w)) if 0 < w < 1 else (0 if w >= 1 else 1 << 62)

    def offer(self, n: int) -> dict[int, int]:
        """Of the next n rows those that enter: slot -> row within the n."""
        start, stop = self.seen, self.seen + n
        taken = {i: i - start for i in range(start, min(stop, self.k))}
        while self.k and self.next < stop:
            taken[int(self.rng.integers(self.k))] = self.next - start
            self.log_w += np.log(self.rng.random()) / self.k
            self.next += 1 + self._skip()
        self.seen = stop
        return taken


def split_draws(sizes: list[int], k: int, rng: np.random.Generator) -> list[int]:
    """How many of k rows, drawn without replacement from all, come from each population."""
    left, draws = sum(sizes), []
    k = min(k, left)
    for size in sizes:
        left -= size
        if not k or not size:
            got = 0
        elif not left:
            got = k
        elif size + left < _NUMPY_LIMIT:
            got = int(rng.hypergeometric(size, left, k))
        else:
            got = _large_hypergeometric(size, left, k, rng)
        draws.append(got)
        k -= got
    return draws


def _large_hypergeometric(good: int, bad: int, k: int, rng: np.random.Generator) -> int:
    """The same draw for populations of any size: k distinct positions, counted below `good`."""
    seen: set[int] = set()
    while len(seen) < k:
        seen.update(int(x) for x in rng.integers(good + bad, size=k - len(seen), dtype=np.int64))
    return sum(x < good for x in seen)


def _rng(seed: int, level: int, number: int) -> np.random.Generator:
    """The random numbers of one reservoir (level 0) or one merge: no two of them share a stream."""
    return np.random.default_rng(np.random.SeedSequence([seed & 0xFFFFFFFF, level, number & 0xFFFFFFFF, number >> 32]))


class _Fill:
    """One reservoir for each partition, as rows: slot, src, pop, rank and the sampled columns."""

    def __init__(self, k: int, seed: int, first: int) -> None:
        self.k, self.seed, self.first = k, seed, first

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() + self.first
        rng = _rng(self.seed, 0, number)
        skipper = Skipper(self.k, rng)
        held: dict[int, int] = {}  # slot -> row of `rows`
        rows: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if taken := skipper.offer(batch.num_rows):
                rows.append(batch.take(pa.array(list(taken.values()))))
                held.update(zip(taken, range(n, n + len(taken))))
                n += len(taken)
                if n > 4 * self.k + 4096:  # rows that were pushed out again are let go
                    kept = pa.Table.from_batches(rows).take(pa.array(list(held.values()))).combine_chunks()
                    rows, held = kept.to_batches(), dict(zip(held, range(len(held))))
                    n = len(held)
        if not held:
            return
        order = rng.permutation(len(held))
        kept = pa.Table.from_batches(rows).take(pa.array(np.fromiter(held.values(), np.int64, len(held))[order]))
        m = len(held)
        head = [pa.array(np.full(m, number)), pa.array(np.full(m, number)), pa.array(np.full(m, skipper.seen)), pa.array(np.arange(m))]
        out = pa.Table.from_arrays([*head, *kept.columns], names=["slot", "src", "pop", "rank", *kept.column_names])
        yield from out.combine_chunks().to_batches()


class _Union:
    def __init__(self, k: int, seed: int) -> None:
        self.k, self.seed = k, seed

    def __call__(self, rows: pa.Table, level: int, parent: int) -> pa.Table:
        src, pop, rank = (rows[c].to_numpy() for c in ("src", "pop", "rank"))
        names, first, where = np.unique(src, return_index=True, return_inverse=True)
        if len(names) == 1:
            return rows
        sizes = [int(p) for p in pop[first]]
        rng = _rng(self.seed, 1 + level, parent)
        draws = np.array(split_draws(sizes, self.k, rng))
        kept = np.flatnonzero(rank < draws[where])
        kept = kept[np.lexsort((rank[kept], src[kept]))][rng.permutation(len(kept))]
        out = rows.take(pa.array(kept))
        for name, values in (("src", np.full(len(kept), names[0])), ("pop", np.full(len(kept), sum(sizes))), ("rank", np.arange(len(kept)))):
            out = out.set_column(out.column_names.index(name), name, pa.array(values, pa.int64()))
        return out


def reservoir_states(df: DataFrame, k: int, seed: int = 0, first: int = 0) -> DataFrame:
    """A reservoir of at most k rows for every partition of df.

    Columns: slot, src, pop (rows that the reservoir stands for), rank (random order within it)
    and the columns of df as c0, c1, ...  States of further pieces may be added by union; give each
    piece its own range of numbers with `first` (one more than the largest src so far).
    """
    if k < 0:
        raise ValueError("the sample size is not negative")
    own = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    head = [T.StructField(n, T.LongType()) for n in ("slot", "src", "pop", "rank")]
    return own.mapInArrow(_Fill(k, seed, first), T.StructType([*head, *own.schema.fields]))


def merge_reservoirs(states: DataFrame, columns: list[str], k: int, seed: int = 0, fan_in: int = FAN_IN) -> DataFrame:
    """The sample of k rows that states of any number of pieces give together; a task merges
    `fan_in` reservoirs, and one more for each piece at most."""
    one = merge_up(states, "slot", [], _Union(k, seed), fan_in)
    return one.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])


def population(states: DataFrame) -> DataFrame:
    """The number of all rows (n_rows) that the states stand for, as counted on the way."""
    return states.filter("rank = 0").agg(F.coalesce(F.sum("pop"), F.lit(0)).alias("n_rows"))


def fixed_size_sample(df: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """k rows of df, every row (copies and rows full of nulls too) equally likely; all rows if df
    has no more than k, none if it is empty.  The same files and seed give the same sample."""
    return merge_reservoirs(reservoir_states(df, k, seed), df.columns, k, seed)
