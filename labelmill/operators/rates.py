"""Conversion rates, histograms of reads, SNPs and coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from labelmill.functions.sequences import BASES, CONVERSIONS, N_COLUMNS, QUALITY, base_col, n_col, ratio, total
from labelmill.operators.filters import is_labeled, mismatches


def rate_col(conversion: str) -> str:
    return f"rate_{conversion.lower()}"


RATES = [rate_col(c) for c in CONVERSIONS]


def mutation_rates(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of each base that was read as each other one, per group or over all rows."""
    return counts.groupBy(*(by or [])).agg(*[ratio(F.sum(n_col(c)), F.sum(base_col(c[0]))).alias(rate_col(c)) for c in CONVERSIONS])


def rates_long(rates: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key and conversion."""
    named = rates.select(*keys, *[F.col(rate_col(c)).alias(c) for c in CONVERSIONS])
    return named.unpivot(keys, list(CONVERSIONS), "conversion", "rate")


def rates_for(cells: DataFrame, rates: DataFrame) -> DataFrame:
    """Rates of every cell of a list, 0 where there are none."""
    return cells.select("barcode").distinct().join(rates, "barcode", "left").fillna(0.0, RATES)


def aggregate_counts(counts: DataFrame, conversions: list[str], keys: list[str] = ("barcode", "gx")) -> DataFrame:
    """Reads by how many conversions they have of how many bases that could be converted."""
    k, n = total([n_col(c) for c in sorted(conversions)]), total([base_col(b) for b in sorted({c[0] for c in conversions})])
    return counts.groupBy(*keys, k.alias("conversion"), n.alias("base")).agg(F.count(F.lit(1)).alias("count"))


def merge_aggregates(*parts: DataFrame) -> DataFrame:
    """Histograms of several inputs as one."""
    keys = [c for c in parts[0].columns if c != "count"]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum("count").alias("count"))


def conversion_sites(conversions: DataFrame, wanted: list[str] | None = None, quality: int = QUALITY) -> DataFrame:
    """Rows per site and conversion."""
    return mismatches(conversions, wanted, quality).groupBy("contig", "genome_i", "conversion").agg(F.count(F.lit(1)).alias("n"))


def site_coverage(coverage: DataFrame) -> DataFrame:
    """Coverage of each position, summed over deliveries."""
    return coverage.groupBy("contig", "genome_i").agg(F.sum("coverage").alias("coverage"))


def detect_snps(sites: DataFrame, coverage: DataFrame, threshold: float = 0.5, min_coverage: int = 1) -> DataFrame:
    """Sites where more than a share `threshold` of the coverage shows the conversion."""
    joined = sites.join(coverage, ["contig", "genome_i"])
    return joined.filter((F.col("coverage") >= min_coverage) & (ratio(F.col("n"), F.col("coverage")) > threshold)).select("contig", "genome_i", "conversion")


def all_conversions(positions: DataFrame) -> DataFrame:
    """Every conversion at each position: positions without a conversion exclude all of them."""
    return positions.select("contig", "genome_i").distinct().select("contig", "genome_i", F.explode(F.array(*[F.lit(c) for c in CONVERSIONS])).alias("conversion"))


def union_snps(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [p.select("contig", "genome_i", "conversion") for p in parts]).distinct()


def coverage_of(reads: DataFrame, positions: str = "positions", at: DataFrame | None = None) -> DataFrame:
    """How many reads cover each position; a read counts once for a position, mates included.

    `at` limits the result to positions of interest (contig, genome_i).
    """
    each = reads.select("contig", F.explode(F.array_distinct(positions)).alias("genome_i"))
    if at is not None:
        each = each.join(at.select("contig", "genome_i").distinct(), ["contig", "genome_i"], "left_semi")
    return each.groupBy("contig", "genome_i").agg(F.count(F.lit(1)).alias("coverage"))


def coverage_of_segments(reads: DataFrame, at: DataFrame | None = None) -> DataFrame:
    """The same for reads whose covered positions are disjoint half-open segments."""
    segment = reads.select("contig", F.explode("segments").alias("s")).select("contig", F.explode(F.sequence("s.start", F.col("s.end") - 1)).alias("genome_i"))
    if at is not None:
        segment = segment.join(at.select("contig", "genome_i").distinct(), ["contig", "genome_i"], "left_semi")
    return segment.groupBy("contig", "genome_i").agg(F.count(F.lit(1)).alias("coverage"))


def background_control(counts: DataFrame, labels: list[list[str]]) -> DataFrame:
    """One rate for a control without label: all label conversions over all their bases."""
    conversions = sorted({c for label in labels for c in label})
    hits = reduce(lambda a, b: a + b, [F.sum(n_col(c)) for c in conversions])
    tries = reduce(lambda a, b: a + b, [F.sum(base_col(b)) for b in sorted({c[0] for c in conversions})])
    return counts.agg(ratio(hits, tries).alias("p_e"))


def background_conversions(labels: list[list[str]]) -> list[str]:
    """Conversions that tell the background: of bases that no label converts, or, if the labels
    take all bases, all conversions that are no label."""
    label = {c for x in labels for c in x}
    free = [c for c in CONVERSIONS if c[0] not in {x[0] for x in label}]
    return free or [c for c in CONVERSIONS if c not in label]


def background(counts: DataFrame, labels: list[list[str]], by: list[str] | None = None) -> DataFrame:
    """Mean of the background rates of each group; rates without a base are left out."""
    names = [rate_col(c) for c in background_conversions(labels)]
    rates = mutation_rates(counts, by)
    known = F.array_compact(F.array(*names))
    mean = F.try_divide(F.aggregate(known, F.lit(0.0), lambda s, x: s + x), F.size(known).cast("double"))
    return rates.select(*(by or []), mean.alias("p_e"))


def background_nasc(rates: DataFrame, by: list[str] | None = None) -> DataFrame:
    return rates.select(*(by or []), ((F.col(rate_col("CT")) + F.col(rate_col("GA"))) / 2).alias("p_e"))


def detection(counts: DataFrame, pi_c: DataFrame, conversions: list[str], by: list[str], pi_by: list[str]) -> DataFrame:
    """Share of labeled reads of a group over the share pi of new RNA that its cells have.

    Groups whose cells disagree about pi are an error; groups with pi of 0 are left out.  The
    result may exceed 1.
    """
    joined = counts.join(pi_c.select(*pi_by, F.col("pi").alias("pi_")), pi_by)
    out = joined.groupBy(*by).agg(ratio(F.count_if(is_labeled(conversions)), F.count(F.lit(1))).alias("ntr"), F.min("pi_").alias("low"), F.max("pi_").alias("high"))
    checked = F.when(F.col("low") != F.col("high"), F.raise_error("pi differs within a group")).otherwise(F.col("low"))
    return out.withColumn("pi_", checked.cast("double")).filter("pi_ > 0").select(*by, (F.col("ntr") / F.col("pi_")).alias("alpha"))


def label_guess(histogram: DataFrame, by: list[str]) -> DataFrame:
    """First guess of the share of new reads: those with a conversion, within 0.01 and 0.99."""
    share = ratio(F.sum(F.when(F.col("conversion") > 0, F.col("count")).otherwise(0)), F.sum("count"))
    return histogram.groupBy(*by).agg(F.least(F.greatest(share, F.lit(0.01)), F.lit(0.99)).alias("guess"))


def base_content(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.groupBy(*by).agg(*[F.sum(base_col(b)).alias(f"sum_{base_col(b)}") for b in BASES], F.sum(total(N_COLUMNS)).alias("n_conversions"))
