"""Relational operators: edge cases, brute force and properties."""

from __future__ import annotations

import collections
import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelmill.functions.names import free_name
from labelmill.functions.sequences import BASE_COLUMNS, N_COLUMNS, complement, with_complements
from labelmill.functions.stats import binomial_pmf
from labelmill.operators import counting, estimators, filters, intervals, matrix, rates, sample, skew
from labelmill.sources import sinks, tables, technology

COUNTS = "read_id string, barcode string, umi string, gx string, " + ", ".join(f"{c} int" for c in [*N_COLUMNS, *BASE_COLUMNS]) + ", velocity string, transcriptome boolean, score int"


def count_row(read_id, barcode="c", umi="u", gx="g", velocity="spliced", transcriptome=True, score=5, bases=10, **n):
    return (read_id, barcode, umi, gx, *[n.get(c[2:], 0) for c in N_COLUMNS], *[bases] * 4, velocity, transcriptome, score)


def counts(spark, rows):
    return spark.createDataFrame(rows, COUNTS)


def test_names():
    assert free_name("a", ["A", "a_"]) == "a__"
    assert complement("TC") == "AG" and with_complements(["TC"]) == ["AG", "TC"]


# ---- skew


@pytest.mark.parametrize("tasks", [2, 5])
def test_balanced_totals_and_loads(spark, tasks):
    rng = random.Random(1)
    rows = [(None if rng.random() < 0.1 else "hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}", rng.choice([None, 1, 2])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    plan = skew.plan_loads(df, ["k"], tasks)
    assert plan.total == 3000 and sum(plan.loads) >= 3000
    assert max(plan.loads) <= 1.4 * 3000 / tasks
    want = collections.defaultdict(lambda: [0, None])
    for k, v in rows:
        want[k][0] += 1
        if v is not None:
            want[k][1] = (want[k][1] or 0) + v
    got = {r["k"]: [r["n_rows"], r["sum_v"]] for r in skew.balanced_totals(df, ["k"], ["v"], plan=plan).collect()}
    assert got == dict(want)
    sizes = [r["count"] for r in skew.balanced_rows(df, ["k"], plan=plan, ordered=True).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 1.4 * 3000 / tasks and sum(sizes) == 3000
    assert plan.at_least(400) and "hot" in {k for k, n in want.items() if n[0] >= 400}


def test_the_plan_places_the_rows_of_the_queries(spark, tmp_path):
    """Rows in each physical partition, of a table of which one gene holds half and copies abound."""
    from labelmill.operators import skew_queries

    rng = random.Random(3)
    rows = [count_row("r", barcode=f"c{rng.randrange(30)}", gx="hot" if rng.random() < 0.5 else f"g{rng.randrange(200)}", tc=1) for _ in range(8000)]
    counts(spark, rows).coalesce(2).write.parquet(f"{tmp_path}/counts_tc.parquet")
    spark.createDataFrame([("hot", "-"), ("g1", "+")], "gx string, strand string").write.parquet(f"{tmp_path}/genes.parquet")
    own = spark.read.parquet(f"{tmp_path}/counts_tc.parquet").select("gx", "n_tc")
    plan = skew.plan_loads(own, ["gx"], 4)
    genes = spark.read.parquet(f"{tmp_path}/genes.parquet")
    joined = skew.fragment_replicate_join(own, genes, ["gx"], "left", plan=plan, ordered=True, task="task")
    placed = joined.groupBy(F.spark_partition_id().alias("p"), "task").count().collect()
    assert all(r["p"] == r["task"] for r in placed) and len(placed) == 4 and sum(r["count"] for r in placed) == 8000
    for r in placed:
        assert abs(r["count"] - plan.loads[r["task"]]) <= 0.15 * 2000 and r["count"] <= 1.25 * 2000
    hot = [r["count"] for r in joined.filter("gx = 'hot'").groupBy("task").count().collect()]
    assert len(hot) == 4 and max(hot) <= 0.4 * sum(hot)
    shards = skew.placed_totals(own, ["gx"], ["n_tc"], rows="n", plan=plan, task="task").groupBy(F.spark_partition_id().alias("p"), "task").agg(F.sum("n").alias("n")).collect()
    assert all(r["p"] == r["task"] for r in shards) and sum(r["n"] for r in shards) == 8000
    assert {tuple(r) for r in skew_queries.found(spark, str(tmp_path)).collect() if r[0] == "gx"} == {("gx", "hot")}
    got = {r["gx"]: (r["n_rows"], r["sum_conversion"]) for r in skew_queries.gene_strand_totals(spark, str(tmp_path)).collect()}
    assert got["hot"] == (sum(r[3] == "hot" for r in rows), 0) and got["g1"][0] == got["g1"][1] == sum(r[3] == "g1" for r in rows)


def test_rows_with_maps_are_spread_too(spark):
    df = spark.range(100).select(F.lit("hot").alias("k"), F.create_map(F.lit("a"), "id").alias("m"), "id")
    assert skew.balanced_rows(df, ["k"], tasks=3).count() == 100


def test_balanced_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, v int, task int")
    assert skew.balanced_totals(empty, ["k"], ["v"]).count() == 0


def test_fragment_replicate_join_with_clashing_names(spark):
    left = spark.createDataFrame([("a", i) for i in range(300)] + [("b", 1), (None, 2), ("z", 3)], "k string, task int")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, task int")
    for how in ("inner", "left"):
        got = sorted(map(tuple, skew.fragment_replicate_join(left, right, ["k"], how, tasks=4).collect()), key=repr)
        want = sorted(map(tuple, left.join(right.withColumnRenamed("task", "task_"), "k", how).collect()), key=repr)
        assert got == want
    with pytest.raises(ValueError):
        skew.fragment_replicate_join(left, right, ["k"], "outer")


# ---- counting


def test_dedup_prefers_conversions_then_transcriptome_score_and_sum(spark):
    rows = [count_row("a", score=9), count_row("b", tc=1, transcriptome=False, score=1), count_row("c", umi="v", transcriptome=False, score=9), count_row("d", umi="v", score=1), count_row("e", umi="w", ga=1), count_row("f", umi="w"), count_row("g", umi=None), count_row("h", umi=None)]
    df = counts(spark, rows)
    assert {r["read_id"] for r in counting.deduplicate_counts(df, ["TC"]).collect()} == {"b", "d", "f", "h"}
    assert {r["read_id"] for r in counting.deduplicate_counts(df, None, False).collect()} == {"a", "d", "e", "h"}
    assert counting.deduplicate_counts(df.filter("false"), ["TC"]).count() == 0


def test_multimappers(spark):
    rows = [
        count_row("one", gx="g", transcriptome=False), count_row("one", gx="h", transcriptome=False),
        count_row("two", gx="g", transcriptome=True), count_row("two", gx="h", transcriptome=False, score=99),
        count_row("three", velocity="spliced", transcriptome=False, score=7), count_row("three", velocity="unspliced", transcriptome=False),
    ]
    got = {r["read_id"]: (r["gx"], r["velocity"], r["score"]) for r in counting.drop_multimappers(counts(spark, rows)).collect()}
    assert got == {"two": ("g", "spliced", 5), "three": ("g", "ambiguous", 7)}


def test_complement_is_an_involution_and_keeps_unknown_genes(spark):
    df = counts(spark, [count_row("a", tc=3, gx="m"), count_row("b", tc=2, gx="p"), count_row("c", tc=1, gx="?"), count_row("d", tc=1, gx=None)])
    genes = spark.createDataFrame([("m", "-"), ("p", "+"), ("m", "-")], "gx string, strand string")
    once = counting.complement_counts(df, genes)
    assert {r["read_id"]: (r["n_tc"], r["n_ag"]) for r in once.collect()} == {"a": (0, 3), "b": (2, 0), "c": (1, 0), "d": (1, 0)}
    assert sorted(map(tuple, counting.complement_counts(once, genes).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


# ---- intervals


def test_containing_genes_against_brute_force(spark):
    rng = random.Random(4)
    genes = [(f"g{i}", rng.choice("12"), rng.choice("+-"), s, s + rng.randrange(1, 400)) for i in range(60) for s in [rng.randrange(3000)]]
    reads = [(i, rng.choice("12"), s, s + rng.randrange(1, 60), rng.choice(["+", "-", None])) for i in range(200) for s in [rng.randrange(3000)]]
    found = intervals.containing_genes(spark.createDataFrame(reads, "read_id long, contig string, start long, end long, strand string"), spark.createDataFrame(genes, "gx string, contig string, strand string, seg_start long, seg_end long"), width=100)
    want = sorted((r[0], g[0]) for r in reads for g in genes if r[1] == g[1] and r[2] >= g[3] and r[3] <= g[4] and r[4] in (None, g[2]))
    assert sorted((r["read_id"], r["gene"]) for r in found.collect()) == want


def test_repeated_reads_and_genes_are_one_gene(spark):
    genes = spark.createDataFrame([("g", "1", "+", 0, 50), ("g", "1", "+", 0, 50), ("h", "1", "+", 40, 90)], "gx string, contig string, strand string, seg_start long, seg_end long")
    reads = spark.createDataFrame([("twice", "1", 5, 9, "+"), ("twice", "1", 5, 9, "+"), ("both", "1", 42, 45, "+"), ("none", "1", 95, 99, "+")], "read_id string, contig string, start long, end long, strand string")
    assert [tuple(r) for r in intervals.unique_gene(reads, genes, ["read_id"]).collect()] == [("twice", "g")]


@pytest.mark.parametrize("exonic,intronic,strict,lenient", [(True, False, "spliced", "spliced"), (True, True, "ambiguous", "spliced"), (False, True, "unspliced", "unspliced"), (False, False, "ambiguous", "ambiguous")])
def test_velocity_table(spark, exonic, intronic, strict, lenient):
    row = spark.range(1).select(intervals.velocity_class(F.lit(exonic), F.lit(intronic), True), intervals.velocity_class(F.lit(exonic), F.lit(intronic), False)).collect()[0]
    assert tuple(row) == (strict, lenient)


def test_segments_and_islands(spark):
    df = spark.createDataFrame([("a", [5, 1, 2, 2, 3, 9]), ("b", []), ("c", None)], "k string, p array<bigint>")
    got = {r["k"]: r["s"] and [tuple(x) for x in r["s"]] for r in df.select("k", intervals.segments_of(F.col("p")).alias("s")).collect()}
    assert got == {"a": [(1, 4), (5, 6), (9, 10)], "b": [], "c": None}
    edge = intervals.BIN
    rows = [("a", p) for p in [*range(edge - 2, edge + 3), *range(edge * 2 - 1, edge * 2 + 1), 7, None]]
    runs = intervals.islands(spark.createDataFrame(rows, "k string, p long"), ["k"], "p").collect()
    assert sorted((r["start"], r["end"], r["n_positions"]) for r in runs) == [(7, 8, 1), (edge - 2, edge + 3, 5), (edge * 2 - 1, edge * 2 + 1, 2)]


# ---- matrices and samples


def test_layers_keep_their_sums(spark):
    rng = random.Random(2)
    rows = [count_row(f"r{i}", barcode=rng.choice("ab"), gx=rng.choice("gh"), velocity=rng.choice(["spliced", "unspliced", "ambiguous"]), transcriptome=rng.random() < 0.5, tc=rng.choice([0, 0, 1])) for i in range(300)]
    wide = matrix.layers_wide(counts(spark, rows), [["TC"]]).collect()
    for r in wide:
        assert r["total"] == r["spliced"] + r["unspliced"] + r["ambiguous"] == r["unlabeled_TC"] + r["labeled_TC"]
        assert r["X"] == r["X_n_TC"] + r["X_l_TC"]


def test_alpha_split_never_exceeds_the_reads(spark):
    split = spark.createDataFrame([("a", "g", 4, 6), ("b", "g", 4, 6), ("c", "g", 4, 0), ("d", "g", 1, 1)], "barcode string, gx string, unlabeled long, labeled long")
    alpha = spark.createDataFrame([("a", 0.5), ("b", 2.0), ("c", 0.0)], "barcode string, alpha double")
    got = {r["barcode"]: (r["unlabeled_est"], r["labeled_est"]) for r in matrix.split_by_alpha(split, alpha).collect()}
    assert got == {"a": (0.0, 10.0), "b": (4.0, 6.0), "c": (4.0, 0.0)}


def test_downsample_is_exact(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") % 3).cast("string"))
    one = sample.downsample(df, ["id"], proportion=0.37, seed=1)
    assert one.count() == 1850 and one.distinct().count() == 1850
    assert set(map(tuple, one.collect())) != set(map(tuple, sample.downsample(df, ["id"], proportion=0.37, seed=2).collect()))
    grouped = sample.downsample(df, ["id"], count=1667, by=["g"], seed=1).groupBy("g").count().collect()
    assert sorted(r["count"] for r in grouped) == [1666, 1667, 1667]
    copies = spark.createDataFrame([("x",)] * 50, "k string")
    assert sample.downsample(copies, ["k"], count=20).count() == 20
    for n in (0, 1, 50, 51):
        assert sample.downsample(copies, ["k"], count=n).count() == min(n, 50)
    assert sample.downsample(df, ["id"], count=5000).count() == sample.downsample(df, ["id"], count=9999).count() == 5000
    assert sample.downsample(df.filter("false"), ["id"], proportion=0.5).count() == 0
    mixed = copies.unionByName(spark.range(300).select(F.col("id").cast("string").alias("k")))
    for n in range(1, 340, 23):
        assert sample.downsample(mixed, ["k"], count=n, seed=n).count() == n
    with pytest.raises(ValueError):
        sample.downsample(df, ["id"], count=1, proportion=0.1)


def test_matrix_market(spark):
    df = spark.createDataFrame([("b", "g", 2), ("a", "h", 1), ("b", "h", 5)], "barcode string, gx string, value long")
    text = "\n".join(r["value"] for r in sinks.matrix_market(df).collect())
    assert text == "%%MatrixMarket matrix coordinate integer general\n2 2 3\n1 2 1\n2 1 2\n2 2 5"


# ---- estimators


def test_pmf_sums_to_one():
    for n in (0, 1, 30, 400):
        assert abs(binomial_pmf(np.arange(n + 1), n, 0.03).sum() - 1) < 1e-9


def simulated(p_e, p_c, pi, n_reads, seed=0):
    rng = np.random.default_rng(seed)
    n = rng.integers(15, 40, n_reads)
    k = rng.binomial(n, np.where(rng.random(n_reads) < pi, p_c, p_e))
    keys, count = np.unique(np.stack([k, n]), axis=1, return_counts=True)
    return keys[0], keys[1], count


@pytest.mark.parametrize("p_c", [0.05, 0.12])
def test_rates_are_recovered(p_c):
    k, n, count = simulated(0.002, p_c, 0.4, 40_000)
    assert estimators.induced_rate(k, n, count, 0.002) == pytest.approx(p_c, rel=0.1)
    a, b, pi = estimators.new_share(k, n, count, 0.002, p_c)
    assert pi == pytest.approx(0.4, abs=0.02) and a > 0 and b > 0
    assert 0.5 * p_c < estimators.induced_rate_nasc(k, n, count, 0.002) < 2 * p_c


def test_no_rate_above_background():
    k, n, count = simulated(0.05, 0.05, 0.0, 2000)
    got = estimators.induced_rate(k, n, count, 0.2)
    assert got is None or got > 0.2


def test_a_background_of_nothing_is_no_error():
    a, b, pi = estimators.new_share([0, 2], [20, 20], [5, 5], 0.0, 0.1)
    assert np.isfinite([a, b, pi]).all() and 0.4 < pi < 0.8


def test_flat_prior_without_reads():
    assert estimators.new_share([], [], [], 0.01, 0.1)[2] == pytest.approx(0.5, abs=1e-6)
    assert estimators.beta_mode_of(2, 2) == 0.5 and estimators.beta_mode_of(2, 1) == 1 and estimators.beta_mode_of(1, 2) == 0 and np.isnan(estimators.beta_mode_of(0.5, 0.5))


def test_fits_by_group(spark):
    rows = []
    for cell, pi in (("a", 0.2), ("b", 0.7)):
        k, n, count = simulated(0.002, 0.1, pi, 5000, seed=3)
        rows += [(cell, "g", int(x), int(y), int(c)) for x, y, c in zip(k, n, count)]
    hist = spark.createDataFrame([*rows, ("small", "g", 1, 20, 3)], tables.HISTOGRAM)
    p_e = spark.createDataFrame([("a", 0.002), ("b", 0.002), ("small", 0.002)], "barcode string, p_e double")
    p_c = estimators.fit_induced(hist, p_e, ["barcode"]).cache()
    assert {r["barcode"] for r in p_c.collect()} == {"a", "b"}
    pi = {r["barcode"]: r["pi"] for r in estimators.fit_share(hist, p_e, p_c, ["barcode", "gx"], ["barcode"]).collect()}
    assert pi["a"] == pytest.approx(0.2, abs=0.05) and pi["b"] == pytest.approx(0.7, abs=0.05)


def test_queries_fit_every_cell_and_gene_and_all_read_groups(spark, tmp_path):
    from labelmill.plans import estimator_queries as queries

    rows = []
    for seed, (cell, gene, pi) in enumerate([("AA", "g", 0.2), ("AA", "h", 0.8), ("AC", "g", 0.7)]):
        for k, n, count in zip(*simulated(0.002, 0.2, pi, 1500, seed=seed)):
            rows += [count_row("r", cell, gx=gene, velocity=("spliced", "unspliced")[i % 2], transcriptome=i % 3 > 0, bases=int(n), tc=int(k), ca=int(i % 20 == 0)) for i in range(int(count))]
    rows += [count_row("r", "AG", gx="g", bases=30, tc=6 if i < 8 else 0) for i in range(16)]  # as few as are fitted
    counts(spark, rows).write.parquet(f"{tmp_path}/counts_tc.parquet")
    spark.createDataFrame([("g", "+", "G"), ("h", "+", "H")], "gx string, strand string, gene_name string").write.parquet(f"{tmp_path}/genes.parquet")
    got = {(r["barcode"], r["gx"]): r["pi"] for r in queries.pi_quadrature(spark, str(tmp_path)).collect()}
    assert set(got) == {("AA", "g"), ("AA", "h"), ("AC", "g"), ("AG", "g")}
    assert got["AA", "g"] == pytest.approx(0.2, abs=0.06) and got["AA", "h"] == pytest.approx(0.8, abs=0.06) and got["AC", "g"] == pytest.approx(0.7, abs=0.06)
    for layers in (queries.estimated_layers, queries.estimated_layers_pi_g):
        names = {r["layer"] for r in layers(spark, str(tmp_path)).select("layer").distinct().collect()}
        assert {n for n in names if n.endswith("_est")} == {f"{n}TC_est" for pair in matrix.LABEL_LAYERS.values() for n in pair}


def test_rates_that_differ_within_a_group_are_refused(spark):
    hist = spark.createDataFrame([("a", "g", 1, 20, 30), ("a", "h", 0, 20, 30), ("b", "g", 0, 21, 40)], tables.HISTOGRAM)
    by_gene = spark.createDataFrame([("g", 0.01), ("h", 0.02)], "gx string, p_e double")
    two = spark.createDataFrame([(0.01,), (0.02,)], "p_e double")
    p_c = spark.createDataFrame([("a", 0.2), ("b", 0.2)], "barcode string, p_c double")
    with pytest.raises(Exception, match="p_e differs"):
        estimators.fit_induced(hist, by_gene, ["barcode"], 1, p_e_by=["gx"]).collect()
    with pytest.raises(Exception, match="one p_e is wanted"):
        estimators.fit_share(hist, two, p_c, ["barcode"], ["barcode"], 1).collect()
    one = estimators.fit_share(hist, two.limit(1), p_c, ["barcode"], ["barcode"], 1).collect()
    assert len(one) == 2 and all(0 < r["pi"] < 1 for r in one)


def test_fits_of_many_groups_are_those_of_each():
    parts = [simulated(0.002, p_c, 0.4, 500, seed=i) for i, p_c in enumerate((0.05, 0.1, 0.2, 0.3))]
    group = np.concatenate([np.full(len(p[0]), i) for i, p in enumerate(parts)])
    k, n, count = (np.concatenate([p[i] for p in parts]) for i in range(3))
    background = [0.002, 0.001, 0.003, 0.9]
    many, pairs = estimators.induced_rates(group, k, n, count, background), estimators.induced_rates_nasc(group, k, n, count, background)
    for i, p in enumerate(parts):
        alone = estimators.induced_rate(*p, background[i])
        assert (alone is None and np.isnan(many[i])) or alone == pytest.approx(many[i], rel=1e-12)
        assert estimators.induced_rate_nasc(*p, background[i]) == pytest.approx(pairs[i], abs=1e-12)
    assert np.isnan(many[3])


def test_expectation_maximisation_against_a_plain_one():
    """The same steps written out cell by cell."""
    from math import comb

    k, n, count = simulated(0.002, 0.1, 0.4, 3000, seed=5)
    table = {(int(a), int(b)): float(c) for a, b, c in zip(k, n, count)}
    most, bases = max(k), sorted(set(map(int, n)))
    pmf = lambda i, m, p: comb(m, i) * p**i * (1 - p) ** (m - i)
    cells = [(i, m) for m in bases for i in range(most + 1)]
    missing = {(i, m) for i, m in cells if pmf(i, m, 0.002) * sum(table.get((j, m), 0) for j in range(i, most + 1)) > 0.01 * table.get((i, m), 0)}
    p = 0.1
    for _ in range(300):
        filled = dict(table)
        for m in bases:
            known = sum(pmf(i, m, p) for i in range(most + 1) if (i, m) not in missing)
            seen = sum(table.get((i, m), 0) for i in range(most + 1) if (i, m) not in missing)
            for i in range(most + 1):
                if (i, m) in missing and known > 0:
                    filled[i, m] = pmf(i, m, p) * seen / known
        p = sum(i * filled.get((i, m), 0) for i, m in cells) / sum(m * filled.get((i, m), 0) for i, m in cells)
    assert estimators.induced_rate(k, n, count, 0.002) == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize("reads", [17, 400, 60_000])
def test_shares_against_a_dense_integral(reads):
    from math import lgamma

    k, n, count = simulated(0.003, 0.08, 0.45, reads, seed=1)
    logit = np.arange(-90, 90, 1 / 1024)
    old, new = -np.logaddexp(0, logit), -np.logaddexp(0, -logit)
    odds = k * np.log(0.08 / 0.003) + (n - k) * (np.log1p(-0.08) - np.log1p(-0.003))
    fit = sum(c * np.logaddexp(old, new + o) for o, c in zip(odds, count))
    x, w = np.polynomial.legendre.leggauss(24)
    prior = np.zeros_like(logit)
    for a, u in zip(np.exp(3 * x), w):
        for b, v in zip(np.exp(3 * x), w):
            prior += u * v * np.exp(a * new + b * old - lgamma(a) - lgamma(b) + lgamma(a + b))
    mass = np.exp(fit - fit.max()) * prior
    assert estimators.new_share(k, n, count, 0.003, 0.08)[2] == pytest.approx((mass * np.exp(new)).sum() / mass.sum(), abs=2e-4)


def test_background_skips_rates_without_bases(spark):
    row = list(count_row("a", ac=1))
    row[COUNTS.split(", ").index("base_g int")] = 0
    got = rates.background(counts(spark, [tuple(row)]), [["TC"]], ["barcode"]).collect()
    assert got[0]["p_e"] == pytest.approx(0.1 / 6)
    assert rates.background_conversions([["TC"], ["AG"], ["GA"], ["CT"]]) == [c for c in ("AC", "AT", "CA", "CG", "GC", "GT", "TA", "TG")]


def test_detection_refuses_mixed_shares(spark):
    df = counts(spark, [count_row("a", barcode="x", tc=1), count_row("b", barcode="y")]).withColumn("group", F.lit("g"))
    pi = spark.createDataFrame([("x", 0.5), ("y", 0.5)], "barcode string, pi double")
    assert rates.detection(df, pi, ["TC"], ["group"], ["barcode"]).collect()[0]["alpha"] == pytest.approx(1.0)
    with pytest.raises(Exception, match="pi differs"):
        rates.detection(df, pi.withColumn("pi", F.when(F.col("barcode") == "x", 0.2).otherwise(0.4)), ["TC"], ["group"], ["barcode"]).collect()


# ---- files


def test_text_files(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert {r[0] for r in tables.read_list(spark, put("b.txt", "AC\n\n  \nGT \n")).collect()} == {"AC", "GT"}
    groups = put("g.csv", "AC,x\n\nGT,y\n")
    assert sorted(map(tuple, tables.read_groups(spark, groups).collect())) == [("AC", "x"), ("GT", "y")]
    with pytest.raises(ValueError):
        tables.read_groups(spark, put("h.csv", "AC,x\nAC,y\n"))
    assert tables.read_snp_csv(spark, put("s.csv", "contig,genome_i\n1,5\n")).count() == 12
    assert tables.read_snp_csv(spark, put("s2.csv", "1,5\n1,5\n")).count() == 12
    assert [tuple(r) for r in tables.read_snp_csv(spark, put("s3.csv", "contig,genome_i,conversion\n1,5,TC\n")).collect()] == [("1", 5, "TC")]
    with pytest.raises(ValueError):
        tables.read_snp_csv(spark, put("s4.csv", "1\n"))
    assert tables.read_values(spark, put("p.txt", "0.0012"), None, ["p_e"]).collect()[0]["p_e"] == 0.0012
    assert tables.read_values(spark, put("p.csv", "group,p_e\n1,0.5\n"), ["group"], ["p_e"]).collect()[0]["group"] == "1"
    assert tables.read_coverage(spark, put("c.csv", "contig,genome_i,coverage\n1,2,3\n")).count() == 1
    alignments = tables.read_alignments(spark, put("a.csv", "read_id,index,barcode,umi,GX,A,C,G,T,velocity,transcriptome,score\nr,1,NA,,g,1,2,3,4,spliced,True,7\n"), limit=5).collect()[0]
    assert (alignments["barcode"], alignments["umi"], alignments["transcriptome"], alignments["base_t"]) == (None, None, True, 4)
    tables.write_csv(spark.createDataFrame([("b", 1), ("a", 2)], "gx string, n_tc int"), str(tmp_path / "out"), ["gx"])
    assert spark.read.csv(str(tmp_path / "out"), header=True).columns == ["GX", "TC"]


def test_technologies_and_arguments(spark):
    assert technology.technologies(spark).count() == 5
    assert technology.detect_strand(["@HD\tVN:1", "@PG\tID:x\tPN:STAR\tCL:STAR --soloStrand=Unstranded"]) == "unstranded"
    assert technology.detect_strand(["@PG\tPN:other\tCL:--soloStrand Forward"]) is None
    merged = technology.merge_arguments({"--a": [1], "--b": 2}, {"--a": [3], "--b": 4, "--c": 5})
    assert merged == {"--a": [1, 3], "--b": 4, "--c": 5} and technology.argument_list({"--a": [1, 2], "--b": 3}) == ["--a", "1", "2", "--b", "3"]
    assert technology.parse_overrides("'--x 1 -2 --y z'") == {"--x": ["1", "-2"], "--y": "z"}


def test_filters(spark):
    df = spark.createDataFrame([("a", 0, {"CB": "x"}), ("b", 0x4, {"CB": "x"}), ("c", 0x400, {"CB": "x"}), ("d", 0, {})], "read_id string, flag int, tags map<string,string>")
    names = lambda d: [r["read_id"] for r in d.collect()]
    assert names(filters.primary_alignments(df, ["CB"])) == ["a"] and names(filters.primary_alignments(df, ["CB"], duplicates=True)) == ["a", "c"]
    assert filters.required_tags("UB", None, "GX", False) == ["UB", "GX"]
    with pytest.raises(ValueError):
        filters.require_unique(df.unionByName(df), ["read_id"], "reads")


# ---- pipelines


def pipeline_inputs(spark, tmp_path):
    from tests.test_reads import bam_bytes

    rng = random.Random(5)
    rows = []
    for i in range(400):
        cell, start = f"C{i % 2}", rng.randrange(0, 100)
        seq = "".join(rng.choice("ACGT") for _ in range(12))
        md, plain, ref = "", 0, ""
        for j, b in enumerate(seq):
            if b == "C" and rng.random() < (0.25 if i % 3 else 0.0):
                md, plain = f"{md}{plain}T", 0
            else:
                plain += 1
        rows.append((f"r{i}", 0, "1", start, 60, [(12, "M")], seq, [35] * 12, {"MD": f"{md}{plain}", "CB": cell, "UB": f"U{i}", "GX": f"g{i % 2}"}))
    bam, gtf = tmp_path / "in.bam", tmp_path / "in.gtf"
    bam.write_bytes(bam_bytes(rows, header="@PG\tID:a\tPN:STAR\tCL:STAR --soloStrand Forward\n"))
    gtf.write_text("".join(f'1\ts\texon\t1\t500\t.\t+\t.\tgene_id "g{i}"; transcript_id "t{i}"; gene_name "n{i}";\n' for i in range(2)))
    return str(bam), str(gtf)


def test_command_line_from_records_to_estimates(spark, tmp_path):
    from labelmill import cli

    bam, gtf = pipeline_inputs(spark, tmp_path)
    out, est, con = (str(tmp_path / x) for x in ("count", "estimate", "consensus"))
    assert cli.main(["count", "-g", gtf, "-o", out, "--umi-tag", "UB", "--barcode-tag", "CB", "--conversion", "TC", bam]) == 0
    counted = spark.read.parquet(f"{out}/counts")
    assert counted.count() == 400 and counted.agg(F.sum("n_tc")).collect()[0][0] > 100
    layers = spark.read.parquet(f"{out}/matrix/layers")
    total = {r["layer"]: r["n"] for r in layers.groupBy("layer").agg(F.sum("value").alias("n")).collect()}
    assert total["total"] == 400 == total["labeled_TC"] + total["unlabeled_TC"]
    assert any(f.startswith("run_info_") for f in os.listdir(out))
    for method in ("alpha", "pi_g"):
        assert cli.main(["estimate", "-o", est, "--cell-threshold", "50", "--method", method, "--p-e", str(_number(tmp_path)), out]) == 0
        assert spark.read.csv(f"{est}/p_c_TC", header=True).count() == 2
    assert cli.main(["estimate", "-o", str(tmp_path / "control"), "--control", out]) == 0
    assert cli.main(["consensus", "-g", gtf, "-o", con, "--umi-tag", "UB", "--barcode-tag", "CB", bam]) == 0
    assert spark.read.parquet(f"{con}/consensus").count() == 400
    parts = sorted(x for x in os.listdir(f"{con}/consensus.sam") if x.startswith("part"))
    text = "".join(open(f"{con}/consensus.sam/{x}").read() for x in parts).splitlines()
    assert text[0] == "@HD\tVN:1.6\tSO:coordinate" and text[1].startswith("@PG\tID:a")
    places = [int(x.split("\t")[3]) for x in text if not x.startswith("@")]
    assert len(places) == 400 and places == sorted(places) and sum(x.startswith("@") for x in text) == 3
    from labelmill.sources.sam import read_bam, read_sam

    assert read_sam(spark, f"{con}/consensus.sam").count() == 400
    again = read_bam(spark, f"{con}/consensus.bam")
    assert again.count() == 400 and [r["start"] + 1 for r in again.select("start").collect()] == places
    for bad in (["count", "-g", gtf, "--conversion", "TC,TC", bam], ["count", "-g", gtf, "--conversion", "XX", bam], ["count", "-g", gtf, "--quality", "42", "--conversion", "TC", bam]):
        with pytest.raises(SystemExit):
            cli.main(bad)
    assert cli.main(["--list"]) == 0


def _number(tmp_path):
    (tmp_path / "p_e.txt").write_text("0.01\n")
    return tmp_path / "p_e.txt"


def test_groups_and_snps_in_the_pipelines(spark, tmp_path):
    from labelmill.plans.count import count
    from labelmill.plans.estimate import estimate
    from labelmill.sources.annotation import read_gtf
    from labelmill.sources.sam import read_records

    bam, gtf = pipeline_inputs(spark, tmp_path)
    genes, transcripts = read_gtf(spark, gtf)
    run = count(read_records(spark, bam), genes, transcripts, [["TC"]], umi_tag="UB", barcode_tag="CB", snp_threshold=0.5, snp_min_coverage=2)
    assert run.coverage.agg(F.max("coverage")).collect()[0][0] > 2 and run.snps.count() >= 0
    run.counts.write.parquet(str(tmp_path / "counts"))
    own = spark.read.parquet(str(tmp_path / "counts"))
    groups = [spark.createDataFrame([("C0", "x"), ("C1", "x")], "barcode string, group string"), spark.createDataFrame([("C0", "y")], "barcode string, group string")]
    got = estimate([own, own], genes, [["TC"]], groups=groups, cell_threshold=20, known_p_e=0.01, downsample_count=100, downsample_by="barcode")
    cells = {r["barcode"]: (r["group"], r["count_dir"]) for r in got.cells.collect()}
    assert cells == {"C0-0": ("x", 0), "C1-0": ("x", 0), "C0-1": ("y", 1)}
    assert got.layers.filter("layer = 'total'").agg(F.sum("value")).collect()[0][0] == 300
    assert got.alpha["total", "TC"].count() if ("total", "TC") in got.alpha else got.alpha
    with pytest.raises(ValueError):
        estimate([own], genes, [["TC"]], reads=["unspliced"])


# ---- streaming


def test_streamed_matrix_equals_the_batch(spark, tmp_path):
    from labelmill.streaming import counts as streaming

    folder = tmp_path / "in"
    df = counts(spark, [count_row(f"r{i}", barcode=str(i % 3), tc=i % 2) for i in range(60)]).withColumn("at", F.lit(dt.datetime(2031, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.substring("read_id", 2, 9).cast("int")))
    df.repartition(3).write.parquet(str(folder))
    stream = streaming.read_stream(spark, str(folder), df.schema, 1)
    streaming.run_once(streaming.running_matrix(stream, ["TC"]), "m", "complete", str(tmp_path / "c1"))
    assert sorted(map(tuple, spark.table("m").collect())) == sorted(map(tuple, matrix.split_counts(df, ["TC"]).collect()))
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    one = streaming.read_stream(spark, str(tmp_path / "one"), df.schema)
    streaming.run_once(streaming.windowed_counts(one, "at", "10 seconds", "0 seconds", ["gx"]), "w", "append", str(tmp_path / "c2"))
    assert [r["n"] for r in spark.table("w").collect()] == [10] * 5  # the last window is still open
    streaming.run_once(streaming.unique_rows(streaming.read_stream(spark, str(folder), df.schema), ["barcode"], "at", "1 hour"), "u", "append", str(tmp_path / "c3"))
    assert spark.table("u").count() == 3


# ---- storage


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from labelmill.functions import storage

    def session(master, named=None):
        done = []
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=done.append)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: named), done=done)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            storage.use_checkpoints(session(master))
        named = session(master, "/shared")
        storage.use_checkpoints(named)
        assert named.done == ["/shared"]


def test_scratch_folders_are_apart(spark):
    from labelmill.functions.storage import scratch_folder

    assert len({scratch_folder(spark, "x") for _ in range(3)}) == 3


# ---- simulation


def test_a_batch_has_every_run_of_every_combination(spark):
    from labelmill.operators import simulate

    got = simulate.simulate_batch(spark, [0.002], [0.1, 0.2], [0.2, 0.7], runs=3, reads=400, estimate_p_c=True).collect()
    assert sorted({(r["p_c"], r["pi"]) for r in got}) == [(0.1, 0.2), (0.1, 0.7), (0.2, 0.2), (0.2, 0.7)] and sorted(r["run"] for r in got) == list(range(12))
    assert all(r["p_e_estimate"] == 0.002 and abs(r["pi_estimate"] - r["pi"]) < 0.15 for r in got)
    by = simulate.summarise(simulate.simulate_batch(spark, [0.002], [0.2], [0.4], runs=3, reads=400)).collect()
    assert len(by) == 1 and by[0]["n_runs"] == 3 and by[0]["mean_p_c_estimate"] == pytest.approx(0.2)
