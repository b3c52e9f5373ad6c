"""Queries of the fitted estimators; SQL cannot express them, tests hold them against known rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelmill.functions.storage import table
from labelmill.operators import counting, estimators, filters, rates, simulate
from labelmill.plans.estimate import estimate
from labelmill.sources.technology import technologies

SQL: dict[str, str] = {}
LABELS = [["TC"]]
#: p_e, p_c and pi of the simulation.
GRID = ([0.002, 0.005], [0.05, 0.1], [0.3, 0.6])
#: Reads that a share is fitted on, at least.
LEAST = 16


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "counts_tc").filter("barcode is not null and gx is not null and barcode not in ('NA', '-')")
    return counting.complement_counts(known, table(spark, folder, "genes"))


def _p_c(spark: SparkSession, folder: str, nasc: bool) -> DataFrame:
    counts = _counts(spark, folder)
    p_e = rates.background(counts, LABELS, ["barcode"]).filter("p_e is not null")
    return estimators.fit_induced(rates.aggregate_counts(counts, ["TC"]), p_e, ["barcode"], 50, nasc)


def p_c_em(spark: SparkSession, folder: str) -> DataFrame:
    return _p_c(spark, folder, False)


def p_c_em_nasc(spark: SparkSession, folder: str) -> DataFrame:
    return _p_c(spark, folder, True)


def pi_quadrature(spark: SparkSession, folder: str) -> DataFrame:
    """Share of new RNA of every cell and gene of LEAST or more reads, with the rates of its cell.

    Rates are fitted for every cell that has such a gene, however few its other reads are.
    """
    counts = _counts(spark, folder)
    hist = rates.aggregate_counts(counts, ["TC"])
    p_e = rates.background(counts, LABELS, ["barcode"]).filter("p_e is not null")
    cells = filters.at_least(hist, ["barcode", "gx"], "count", LEAST).select("barcode")
    p_c = estimators.fit_induced(hist.join(cells, "barcode", "left_semi"), p_e, ["barcode"], LEAST)
    return estimators.fit_share(hist, p_e, p_c, ["barcode", "gx"], ["barcode"], LEAST)


def pi_pooled(spark: SparkSession, folder: str) -> DataFrame:
    """Share of new RNA per gene and group of cells, pooled by the first letter of the barcode."""
    counts = _counts(spark, folder).withColumn("group", F.substring("barcode", 1, 1))
    hist = rates.aggregate_counts(counts, ["TC"], ["barcode", "gx", "group"])
    p_e = rates.background(counts, LABELS, ["group"])
    p_c = estimators.fit_induced(hist, p_e, ["group"], 1000)
    return estimators.fit_share(hist, p_e, p_c, ["group", "gx"], ["group"], LEAST)


def _estimated(spark: SparkSession, folder: str, method: str) -> DataFrame:
    known = table(spark, folder, "counts_tc").filter("barcode is not null and gx is not null and barcode not in ('NA', '-')")
    return estimate([known], table(spark, folder, "genes"), LABELS, cell_threshold=50, method=method).layers


def estimated_layers(spark: SparkSession, folder: str) -> DataFrame:
    """The whole of `estimate` with the detection rate, from counts to corrected layers of all read groups."""
    return _estimated(spark, folder, "alpha")


def estimated_layers_pi_g(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the share of every cell and gene."""
    return _estimated(spark, folder, "pi_g")


def simulate_reads(spark: SparkSession, folder: str) -> DataFrame:
    return simulate.simulate_reads(spark, 0.002, 0.08, 0.4, reads=20_000)


def simulated_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Every run of a grid of rates and shares, with all three estimated."""
    return simulate.simulate_batch(spark, *GRID, runs=4, reads=5000, estimate_p_e=True, estimate_p_c=True)


def simulated_recovery(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the mean estimates of each combination come near to what was simulated."""
    near = lambda n, off: F.abs(F.col(f"mean_{n}_estimate") - F.col(n)) <= off
    by = simulate.summarise(simulated_batch(spark, folder))
    return by.select("p_e", "p_c", "pi", "n_runs", near("p_e", 0.0005).alias("p_e_found"), near("p_c", 0.01).alias("p_c_found"), near("pi", 0.05).alias("pi_found"))


def technology_table(spark: SparkSession, folder: str) -> DataFrame:
    return technologies(spark)


QUERIES = {f.__name__: f for f in (p_c_em, p_c_em_nasc, pi_quadrature, pi_pooled, estimated_layers, estimated_layers_pi_g, simulate_reads, simulated_batch, simulated_recovery, technology_table)}
SQL["technology_table"] = """SELECT * FROM (VALUES ('dropseq', 0, 12, 12, 8, 'forward'), ('scifate', 0, 18, 8, 8, 'forward'), ('10xv2', 0, 16, 16, 10, 'forward'), ('10xv3', 0, 16, 16, 12, 'forward'),
    ('smartseq', NULL, NULL, NULL, NULL, 'unstranded')) t(name, barcode_start, barcode_length, umi_start, umi_length, strand)"""
SQL["simulated_recovery"] = f"""SELECT CAST(e AS DOUBLE) AS p_e, CAST(c AS DOUBLE) AS p_c, CAST(s AS DOUBLE) AS pi, CAST(4 AS BIGINT) AS n_runs, true AS p_e_found, true AS p_c_found, true AS pi_found
    FROM (SELECT unnest({GRID[0]}) AS e), (SELECT unnest({GRID[1]}) AS c), (SELECT unnest({GRID[2]}) AS s)"""
