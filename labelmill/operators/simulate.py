"""Synthetic reads with known rates, to see whether the estimators find them again."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelmill.functions.sequences import BASES, BASE_COLUMNS, CONVERSIONS, base_col, n_col


def sequence_base(position: Column, seed: int) -> Column:
    """Base of an endless random sequence at a position; the same whenever it is asked for."""
    return F.element_at(F.array(*[F.lit(b) for b in BASES]), (F.pmod(F.xxhash64(position, F.lit(seed)), F.lit(4)) + 1).cast("int"))


def _uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys alone, so a lost task gives the same again."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def _value(run: Column, values: list[float], runs: int) -> Column:
    """The value of the point that a run belongs to."""
    return F.element_at(F.lit([float(v) for v in values]), (F.floor(run / runs) + 1).cast("int"))


def simulate_runs(spark: SparkSession, points: list[tuple[float, float, float]], *, runs: int = 1, reads: int = 100, length: int = 100, genome: int = 10_000, label: str = "TC", seed: int = 0) -> DataFrame:
    """run, read_id, labeled, the twelve counts and the contents of reads drawn from a random sequence.

    points: p_e, p_c and pi of `runs` runs each, of `reads` reads.  Every base of an unlabeled read
    is changed with chance p_e, to each other base alike; in a labeled read (chance pi) the label's
    conversion has chance p_c.  All runs are one plan.
    """
    source, target = label
    ident, place = F.floor(F.col("id") / length), F.col("id") % length
    rows = spark.range(len(points) * runs * reads * length).select(ident.alias("ident"), place.alias("place"))
    run = F.floor(F.col("ident") / reads)
    p_e, p_c, pi = (_value(F.col("run"), [p[i] for p in points], runs) for i in range(3))
    start = F.floor(_uniform(seed + 1, F.col("ident")) * max(1, genome - length))
    rows = rows.withColumn("run", run).withColumn("labeled", _uniform(seed + 2, F.col("ident")) < pi).withColumn("base", sequence_base(start + F.col("place"), seed)).withColumn("p_e", p_e)
    draw = _uniform(seed + 3, F.col("ident"), F.col("place"))
    e, converted = F.col("p_e"), F.col("labeled") & (F.col("base") == source)
    others = F.array_remove(F.array(*[F.lit(b) for b in BASES]), F.col("base"))
    wrong = F.element_at(others, (F.floor(_uniform(seed + 4, F.col("ident"), F.col("place")) * 3) + 1).cast("int"))
    # p_e is the rate of each single conversion, so any of three happens three times as often.
    changed = F.when(converted, F.when(draw < p_c, F.lit(target)).when(draw < p_c + 2 * e, F.element_at(F.array_remove(others, target), (F.floor(draw * 1e9) % 2 + 1).cast("int")))).otherwise(F.when(draw < 3 * e, wrong))
    rows = rows.withColumn("read_base", F.coalesce(changed, "base"))
    pair = F.concat("base", "read_base")
    out = rows.groupBy("run", "ident", "labeled").agg(*[F.count_if(pair == c).alias(n_col(c)) for c in CONVERSIONS], *[F.count_if(F.col("base") == b).alias(base_col(b)) for b in BASES])
    return out.select("run", (F.col("ident") % reads).alias("read_id"), *[c for c in out.columns if c not in ("run", "ident")])


def simulate_reads(spark: SparkSession, p_e: float, p_c: float, pi: float, **options) -> DataFrame:
    """simulate_runs of one run."""
    return simulate_runs(spark, [(p_e, p_c, pi)], **options).drop("run")


def simulate_batch(spark: SparkSession, p_e: list[float], p_c: list[float], pi: list[float], *, runs: int = 16, reads: int = 100, length: int = 100, estimate_p_e: bool = False, estimate_p_c: bool = False, nasc: bool = False, seed: int = 0) -> DataFrame:
    """Estimates of every run of every combination of the rates and the share.

    Gives p_e, p_c, pi, run, p_e_estimate, p_c_estimate, guess, alpha_estimate, beta_estimate and
    pi_estimate.  A rate that is not estimated is taken as known; runs whose p_c cannot be told
    from the background are left out.
    """
    from labelmill.operators import estimators, rates

    points = list(product(p_e, p_c, pi))
    counts = simulate_runs(spark, points, runs=runs, reads=reads, length=length, seed=seed).select("run", *[n_col(c) for c in CONVERSIONS], *BASE_COLUMNS)
    known = spark.range(len(points) * runs).select(F.col("id").alias("run"), *[_value(F.col("id"), [p[i] for p in points], runs).alias(n) for i, n in enumerate(("p_e", "p_c", "pi"))])
    hist = rates.aggregate_counts(counts, ["TC"], ["run"])
    if not estimate_p_e:
        back = known.select("run", "p_e")
    elif nasc:
        back = rates.background_nasc(rates.mutation_rates(counts, ["run"]), ["run"])
    else:
        back = rates.background(counts, [["TC"]], ["run"])
    induced = estimators.fit_induced(hist, back, ["run"], 0, nasc) if estimate_p_c else known.select("run", "p_c")
    share = estimators.fit_share(hist, back, induced, ["run"], ["run"], 0, nasc)
    out = known.join(back.withColumnRenamed("p_e", "p_e_estimate"), "run").join(induced.withColumnRenamed("p_c", "p_c_estimate"), "run").join(rates.label_guess(hist.filter("base > 0"), ["run"]), "run").join(share, "run")
    return out.select("p_e", "p_c", known["pi"], "run", "p_e_estimate", "p_c_estimate", "guess", F.col("alpha").alias("alpha_estimate"), F.col("beta").alias("beta_estimate"), share["pi"].alias("pi_estimate"))


def summarise(estimates: DataFrame) -> DataFrame:
    """Number, mean and standard deviation of the estimates of each combination."""
    names = ("p_e_estimate", "p_c_estimate", "pi_estimate")
    return estimates.groupBy("p_e", "p_c", "pi").agg(F.count(F.lit(1)).alias("n_runs"), *[f(n).alias(f"{w}_{n}") for n in names for f, w in ((F.avg, "mean"), (F.stddev_pop, "sd"))])
