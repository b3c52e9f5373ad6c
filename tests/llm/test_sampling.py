"""Reservoirs, frequent values, percentiles and packing against brute force."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelmill.llm import frequent, packing, quantiles, reservoir, trees


# ---- problem 1


def test_every_row_is_equally_likely():
    hits = np.zeros(50)
    for seed in range(4000):
        skip, held = reservoir.Skipper(5, np.random.default_rng(seed)), {}
        for start in range(0, 50, 7):
            held |= {slot: start + row for slot, row in skip.offer(min(7, 50 - start)).items()}
        hits[list(held.values())] += 1
    assert len(held) == 5 and abs(hits / 4000 - 0.1).max() < 0.025


def test_draws_follow_the_populations():
    rng = np.random.default_rng(1)
    draws = np.array([reservoir.split_draws([100, 300, 0, 600], 50, rng) for _ in range(3000)])
    assert (draws.sum(axis=1) == 50).all() and np.allclose(draws.mean(axis=0), [5, 15, 0, 30], atol=0.3)
    large = np.array([reservoir._large_hypergeometric(10**11, 3 * 10**11, 40, rng) for _ in range(2000)])
    assert abs(large.mean() - 10) < 0.3
    assert reservoir.split_draws([2, 1], 10, rng) == [2, 1] and reservoir.split_draws([], 3, rng) == []


def test_samples_over_partitions_are_uniform(spark):
    df = spark.range(400).repartition(7).withColumn("pop", F.col("id").cast("string"))
    hits = collections.Counter(r["id"] for s in range(12) for r in reservoir.fixed_size_sample(df, 100, seed=s).collect())
    assert sum(hits.values()) == 1200 and len(hits) > 350 and max(hits.values()) < 12


def test_sources_are_equally_likely_over_several_levels():
    """Chi-square over 16 sources whose reservoirs are merged in two levels of four."""
    k, sources, rounds = 10, 16, 1500
    assert trees.parents(sources, 4) == [4, 1]
    hits = np.zeros(sources)
    for seed in range(rounds):
        states = []
        for i in range(sources):
            rank = np.arange(k)
            states.append(pa.table({"slot": np.full(k, i), "src": np.full(k, i), "pop": np.full(k, 40), "rank": rank, "c0": np.full(k, i)}))
        union = reservoir._Union(k, seed)
        for level, n in enumerate(trees.parents(sources, 4)):
            states = [union(pa.concat_tables(states[p::n]), level, p) for p in range(n)]
        assert states[0]["pop"][0].as_py() == 40 * sources
        hits += np.bincount(states[0]["c0"].to_numpy(), minlength=sources)
    each = k * rounds / sources
    # Draws without replacement vary a little less than this; 15 degrees of freedom, 37.7 is the 0.1 % point.
    assert hits.sum() == k * rounds and ((hits - each) ** 2 / each).sum() < 37.7


def test_streams_of_random_numbers_are_all_different():
    firsts = {reservoir._rng(5, level, number).random() for level in range(4) for number in range(200)}
    assert len(firsts) == 800


@pytest.mark.parametrize("partitions", [1, 3, 64, 65, 4097, 300_000])
def test_no_task_merges_more_than_its_share(partitions):
    below = partitions
    for n in trees.parents(partitions, 64):
        assert -(-below // n) <= 64
        below = n
    assert below == 1


def test_sample_through_two_levels(spark):
    df = spark.range(300).repartition(9)
    hits = collections.Counter()
    for seed in range(10):
        states = reservoir.reservoir_states(df, 30, seed)
        hits.update(r["id"] for r in reservoir.merge_reservoirs(states, ["id"], 30, seed, fan_in=3).collect())
        assert seed or reservoir.population(states).collect()[0]["n_rows"] == 300
    assert sum(hits.values()) == 300 and max(hits.values()) <= 7


def test_small_empty_and_odd_tables(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), ("x", None, None)], "slot string, rank int, pop string")
    assert sorted(map(repr, reservoir.fixed_size_sample(df, 10).collect())) == sorted(map(repr, df.collect()))
    assert reservoir.fixed_size_sample(df.filter("false"), 10).count() == 0
    assert reservoir.fixed_size_sample(df, 0).count() == 0
    with pytest.raises(ValueError):
        reservoir.fixed_size_sample(df, -1)


def test_pieces_can_be_added(spark):
    df = spark.range(1000)
    parts = [reservoir.reservoir_states(df.filter(c), 50, 1, first) for c, first in (("id < 900", 0), ("id >= 900", 10_000))]
    got = [r["id"] for r in reservoir.merge_reservoirs(parts[0].unionByName(parts[1]), ["id"], 50, 1).collect()]
    assert len(set(got)) == 50 and sum(x >= 900 for x in got) < 20


# ---- problem 2


@pytest.mark.parametrize("k", [5, 50])
def test_counters_bound_the_counts(spark, k):
    rng = random.Random(3)
    values = [min(int(rng.paretovariate(0.7)), 10**6) for _ in range(6000)]
    df = spark.createDataFrame([(v, None if v == 2 else str(v)) for v in values], "head long, cnt string").repartition(6)
    exact = collections.Counter(v for v in values if v != 2)
    got = {r["head"]: r for r in frequent.frequent_values(df, ["head", "cnt"], k).collect()}
    assert len(got) <= k
    for v, r in got.items():
        assert r["rows_at_least"] <= exact[v] <= r["rows_at_most"] and r["all_rows"] == 6000
        assert r["rows_at_most"] - r["rows_at_least"] <= 6000 / (k + 1)
    assert {v for v, n in exact.items() if n > 6000 / (k + 1)} <= set(got)


def test_frequent_values_of_odd_tables(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a string, all_rows int")
    assert frequent.frequent_values(df, ["a"], 3).count() == 0
    assert frequent.frequent_values(df.filter("false"), ["a"], 3).count() == 0
    assert frequent.frequent_values(df, ["all_rows"], 3).columns == ["all_rows", "rows_at_least", "rows_at_most", "all_rows_"]


# ---- problem 4


def test_ranks_stay_within_the_bound():
    rng = np.random.default_rng(2)
    values = rng.normal(size=40_000).round(3)
    for order in (values, np.sort(values), np.sort(values)[::-1]):
        parts = []
        for piece in np.array_split(order, 7):
            s = quantiles.Sketch(128)
            for block in np.array_split(piece, 11):
                s.add(block)
            parts.append(s)
        whole = quantiles.Sketch(128)
        for s in parts:
            whole.merge(s.n, s.error, *s.rows())
        assert whole.n == len(values) and sum(len(b) << max(0, x) for x, b in zip(*whole.rows())) == whole.n
        assert whole.error < whole.n * np.log2(whole.n / 128) / 128
        ordered = np.sort(values)
        for q in (0.01, 0.1, 0.5, 0.9, 0.99):
            v = quantiles.weighted_quantile(*whole.rows(), q)
            low, high = np.searchsorted(ordered, v, "left"), np.searchsorted(ordered, v, "right")
            assert low - whole.error - 1 <= q * whole.n <= high + whole.error + 1


def test_percentiles_of_groups_and_of_states_that_are_combined(spark):
    df = spark.range(30_000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") / 100).alias("v")).repartition(5)
    states = [quantiles.sketches(df.filter(c), "f", F.col("g"), F.col("v"), 256) for c in ("v < 100", "v >= 100")]
    rows = quantiles.percentiles(quantiles.combine(states[0].unionByName(states[1]), 256), [0.5]).collect()
    exact = {str(r["g"]): r["m"] for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert len(rows) == 2
    for r in rows:
        assert r["value_low"] <= exact[r["group_value"]] + 0.05 and exact[r["group_value"]] - 0.05 <= r["value_high"] and abs(r["value"] - exact[r["group_value"]]) < 3
    none = df.filter("v is null")
    assert quantiles.percentiles(quantiles.combine(quantiles.sketches(none, "f", F.col("g"), F.col("v"))), [0.5]).count() == 0


# ---- problem 7


@pytest.mark.parametrize("capacity", [1, 7, 100])
def test_nothing_is_lost_or_split_without_need(capacity):
    rng = np.random.default_rng(capacity)
    sizes = np.where(rng.random(800) < 0.02, 0, rng.integers(1, 3 * capacity, 800))
    item, where, start, length = map(np.array, packing.pack_items(sizes, capacity))
    assert (np.bincount(where, length) <= capacity).all()
    assert (np.bincount(item, length, len(sizes)) == sizes).all()
    parts = np.bincount(item, minlength=len(sizes))
    assert (parts[sizes <= capacity] == 1).all() and (parts == np.maximum(1, -(-sizes // capacity))).all()
    assert len(set(where)) <= 1.15 * -(-sizes.sum() // capacity) + 2


def test_sum_of_squares_places_where_the_sum_is_least():
    rng = np.random.default_rng(0)
    bins = packing.SumOfSquares(20)
    for size in rng.integers(1, 21, 400):
        counts = bins.counts.copy()
        options = {}
        for gap in [g for g in range(size, 21) if counts[g]] + [None]:
            after = counts.copy()
            if gap is not None:
                after[gap] -= 1
            left = (20 if gap is None else gap) - size
            if left:
                after[left] += 1
            options[gap] = int((after**2).sum())
        bins.place(int(size))
        assert int((bins.counts**2).sum()) == min(options.values())


def test_pack_odd_tables(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (None, None), (2, 0), (3, -4), (4, 23)], "n_tokens long, budget_id int")
    got = packing.pack(df, "budget_id", ["n_tokens"], [(1, 10), (2, None), (3, 0)]).collect()
    assert len(got) == 8 and {r["budget_id"] for r in got} == {1}
    assert sum(r[-1] for r in got) == 33
    assert packing.pack(df.filter("false"), "budget_id", ["n_tokens"], [(1, 10)]).count() == 0
    assert packing.pack(df, "budget_id", ["n_tokens"], []).count() == 0
    use = packing.usage(packing.pack(df.select("budget_id"), "budget_id", ["budget_id"], [(1, 10)]).toDF("budget_id", "capacity", "container_id", "x", "start_token", "n_tokens")).collect()[0]
    assert use["n_containers"] == 4 and use["least_containers"] == 4
