"""Rates of induced conversion and shares of new RNA, fitted on histograms of reads.

A histogram (conversion, base, count) is far smaller than the reads; it is made by Spark first, and
only the fits run in Python, for many cells or genes in one set of arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from labelmill.functions.stats import log_factorial

#: Rows of histograms that are fitted together.
BLOCK = 1 << 16


class _Tables:
    """Histograms of several groups side by side: a row for each group and number of bases that
    occurs in it, a column for each number of conversions up to the most.

    Numbers of bases without reads stay empty through all steps, so they need no row; a group has
    columns up to its own most conversions only.
    """

    def __init__(self, group, k, n, count) -> None:
        group, k, n = (np.asarray(x, np.int64) for x in (group, k, n))
        keys, row = np.unique(np.stack([group, n]), axis=1, return_inverse=True)
        self.group, self.bases = keys[0], keys[1][:, None]
        self.rows = np.arange(int(k.max(initial=0)) + 1)[None, :]
        self.reads = np.zeros((len(self.group), self.rows.shape[1]))
        np.add.at(self.reads, (row.ravel(), k), np.asarray(count, float))
        most = np.zeros(int(self.group.max(initial=-1)) + 1, np.int64)
        np.maximum.at(most, group, k)
        self.there = self.rows <= most[self.group][:, None]
        fits = (self.rows <= self.bases) & self.there
        rest = np.where(fits, self.bases - self.rows, 0)
        self.ways = np.where(fits, log_factorial(self.bases) - log_factorial(self.rows) - log_factorial(rest), -np.inf)
        self.rest = rest

    def pmf(self, p: np.ndarray) -> np.ndarray:
        """Binomial probabilities with the rate of each group."""
        own = p[self.group][:, None]
        inner = np.clip(own, 1e-300, 1 - 1e-16)
        out = np.exp(self.ways + self.rows * np.log(inner) + self.rest * np.log1p(-inner))
        if (own <= 0).any() or (own >= 1).any():
            out = np.where(own <= 0, (self.rows == 0) & self.there, np.where(own >= 1, (self.rows == self.bases) & self.there, out)).astype(float)
        return out

    def rates(self, before: np.ndarray) -> np.ndarray:
        """Conversions over bases of each group; the rate before where nothing was read."""
        n = len(before)
        tries = np.bincount(self.group, (self.reads * self.bases).sum(axis=1), n)
        hits = np.bincount(self.group, (self.reads * self.rows).sum(axis=1), n)
        return np.divide(hits, tries, out=before.copy(), where=tries > 0)

    def keep(self, groups: np.ndarray) -> None:
        """Go on with those groups alone (a flag for each)."""
        own = groups[self.group]
        for name in ("group", "bases", "reads", "there", "ways", "rest"):
            setattr(self, name, getattr(self, name)[own])


def induced_rates(group, k, n, count, p_e, p_c: float = 0.1, threshold: float = 0.01, rounds: int = 300) -> np.ndarray:
    """Conversion rates of labeled reads of groups 0, 1, ... by expectation maximisation.

    Cells of a histogram where unlabeled reads should make up more than `threshold` of what is seen
    are taken as missing and filled from the rest of their number of bases.  Groups leave the
    iteration when their rate stands still.  NaN where the rate does not exceed the background.
    """
    p_e = np.asarray(p_e, float)
    t = _Tables(group, k, n, count)
    above = np.cumsum(t.reads[:, ::-1], axis=1)[:, ::-1]
    missing = above * t.pmf(p_e) > threshold * t.reads
    seen = np.where(missing, 0.0, t.reads).sum(axis=1)
    p, moving = np.full(len(p_e), p_c), np.ones(len(p_e), bool)
    for _ in range(rounds):
        pmf = t.pmf(p)
        known = np.where(missing, 0.0, pmf).sum(axis=1)
        fill = np.divide(seen, known, out=np.zeros_like(seen), where=known > 0)[:, None] * pmf
        t.reads = np.where(missing & (known > 0)[:, None], fill, t.reads)
        rate = t.rates(p)
        moving &= rate != p
        p = np.where(moving, rate, p)
        if not moving.any():
            break
        own = moving[t.group]
        if own.sum() <= 0.75 * len(own):
            missing, seen = missing[own], seen[own]
            t.keep(moving)
    return np.where(p > p_e, p, np.nan)


def induced_rates_nasc(group, k, n, count, p_e, threshold: float = 0.01) -> np.ndarray:
    """The variant of paired-end protocols: missing cells are filled from each other, one after
    the other, within an interval of the rate that shrinks."""
    p_e = np.asarray(p_e, float)
    t = _Tables(group, k, n, count)
    above = np.cumsum(t.reads[:, ::-1], axis=1)[:, ::-1] - t.reads
    missing = above * t.pmf(p_e) > threshold * t.reads
    size = len(p_e)
    low, high, p, moving = np.zeros(size), np.ones(size), np.full(size, 0.5), np.ones(size, bool)
    while moving.any():
        pmf = t.pmf(p)
        known = np.where(missing, pmf, 0.0).sum(axis=1)
        held = np.where(missing, t.reads, 0.0).sum(axis=1)
        for i in range(t.reads.shape[1]):
            at = missing[:, i] & (known > 0)
            new = np.where(at, pmf[:, i] * np.divide(held, known, out=np.zeros_like(held), where=known > 0), t.reads[:, i])
            held += new - t.reads[:, i]
            t.reads[:, i] = new
        rate = t.rates(np.zeros(size))
        same = rate == p
        low, high = np.where(moving & ~same & (rate >= p), p, low), np.where(moving & ~same & (rate < p), p, high)
        p = np.where(moving, rate, p)
        moving &= ~same & (high - low >= 1e-8)
        own = moving[t.group]
        if own.sum() <= 0.75 * len(own):
            missing = missing[own]
            t.keep(moving)
    return p


def induced_rate(k, n, count, p_e: float, **options) -> float | None:
    """induced_rates of one histogram."""
    out = induced_rates(np.zeros(len(k), int), k, n, count, [p_e], **options)
    return None if np.isnan(out[0]) else float(out[0])


def induced_rate_nasc(k, n, count, p_e: float, **options) -> float:
    return float(induced_rates_nasc(np.zeros(len(k), int), k, n, count, [p_e], **options)[0])


#: Grid of logits of the share: beyond EDGE a share is 0 or 1 to the last digit and no likelihood
#: changes any more; within, FINE points a unit, of which every COARSE-th is looked at first.
EDGE, FINE, COARSE = 40, 128, 16
#: Nats below its highest point from which on the posterior is left out, and points it shall have.
DEEP, POINTS = 36.0, 256


@lru_cache(maxsize=1)
def _prior() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of the share, and the log of its prior weight at each, a row of weights each for
    nothing, alpha and beta.

    The share has a Beta(alpha, beta) prior whose parameters have logs uniform on [-3, 3]; both are
    integrated out by Gauss-Legendre quadrature once.  The first and the last point stand for all
    that lies beyond them.
    """
    x, w = np.polynomial.legendre.leggauss(32)
    a, b = (m.ravel() for m in np.meshgrid(np.exp(3 * x), np.exp(3 * x), indexing="ij"))
    norm = np.array([lgamma(p) + lgamma(q) - lgamma(p + q) for p, q in zip(a, b)])
    weight = np.outer(w, w).ravel()
    logit = np.arange(-EDGE * FINE, EDGE * FINE + 1) / FINE
    log_share, log_rest = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    rows = np.zeros((3, len(logit)))
    tails = np.zeros((3, 2))
    for p, q, m, z in zip(a, b, weight, norm):
        mass = m * np.exp(p * log_share + q * log_rest - z)
        beyond = m * np.exp(-z) * np.exp([-p * EDGE, -q * EDGE]) / [p, q]  # of exp(p t) below -EDGE, of exp(-q t) above EDGE
        for i, by in enumerate((1.0, p, q)):
            rows[i] += by * mass
            tails[i] += by * beyond
    return logit, np.log(rows), np.log(tails)


def new_share(k, n, count, p_e: float, p_c: float) -> tuple[float, float, float]:
    """Posterior means of alpha, beta and of the share of new reads in a mixture of two binomials."""
    logit, prior, tails = _prior()
    k, n, count = np.asarray(k, float), np.asarray(n, float), np.asarray(count, float)
    # A rate of 0 or 1 is taken as all but that, so that no read is quite impossible.
    p_e, p_c = (min(max(p, 1e-12), 1 - 1e-12) for p in (p_e, p_c))
    # Coefficients of the binomials cancel; the mixture is compared with its old part.
    odds = k * (np.log(p_c) - np.log(p_e)) + (n - k) * (np.log1p(-p_c) - np.log1p(-p_e))

    def fit(at: np.ndarray) -> np.ndarray:
        log_share, log_rest = -np.logaddexp(0, -at), -np.logaddexp(0, at)
        return count @ np.logaddexp(log_rest[None, :], log_share[None, :] + odds[:, None]) if len(odds) else np.zeros_like(at)

    step = COARSE
    at = np.arange(0, len(logit), step)
    height = fit(logit[at])
    # Where the posterior stands out from too few points, only that part is looked at, more closely.
    post = height + prior[0, at]
    high = np.flatnonzero(post >= post.max() - DEEP)
    low, top = max(0, at[high[0]] - step), min(len(logit) - 1, at[high[-1]] + step)
    whole = low == 0 or top == len(logit) - 1
    if not whole and (top - low) // step < POINTS:
        step = max(1, (top - low) // POINTS)
        at = np.arange(low, top + 1, step)
        height = fit(logit[at])
    rows = height + prior[:, at] + np.log(step / FINE)
    ends = np.stack([tails[:, 0], tails[:, 1] + (count * odds).sum()], axis=1)
    peak = max(rows[0].max(), ends[0].max())
    mass, beyond = np.exp(rows - peak), np.exp(ends - peak)
    total = mass.sum(axis=1) + beyond.sum(axis=1)
    share = (mass[0] / (1 + np.exp(-logit[at]))).sum() + beyond[0, 1]
    return float(total[1] / total[0]), float(total[2] / total[0]), float(share / total[0])


def beta_mode_of(a: float, b: float) -> float:
    if a > 1 and b > 1:
        return (a - 1) / (a + b - 2)
    return 1.0 if a > 1 else 0.0 if b > 1 else float("nan")


def _one_value(t: DataFrame, value: str) -> DataFrame:
    """A table of one row, as such; any other number of rows is an error."""
    n = F.count(F.lit(1))
    return t.agg(F.when(n == 1, F.max(value)).otherwise(F.raise_error(F.concat(F.lit(f"one {value} is wanted, not "), n.cast("string")))).cast("double").alias(f"{value}_"))


def _keyed(histogram: DataFrame, keys: list[str], threshold: int, rates: list[tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Histograms of the keys that have their rates and at least `threshold` reads, summed to one
    row for each key, conversion and base, with the rates; sorted, every key in one partition.

    The number of partitions is fixed: histograms are small, so partitions that are merged by size
    would leave all the costly fits to one task.
    """
    extra = [k for _, _, by in rates for k in by if k not in keys]
    spark = histogram.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = histogram.groupBy(*keys, *dict.fromkeys(extra), "conversion", "base").agg(F.sum("count").alias("count"))
    for t, value, by in rates:
        out = out.join(t.select(*by, F.col(value).cast("double").alias(f"{value}_")), by) if by else out.join(F.broadcast(_one_value(t, value)))
    out = out.repartition(n, *keys).withColumn("reads_", F.sum("count").over(W.partitionBy(*keys)))
    return out.filter((F.col("reads_") >= threshold) & (F.col("base") > 0) & (F.col("count") > 0)).drop("reads_").sortWithinPartitions(*keys)


class _Groups:
    """Runs a fit over the groups of sorted rows, many at a time.

    fit takes, for each row, the number of its group, and by column what the rows hold, and the
    rates of each group; it gives a column of results for each name, NaN in the first for groups
    that are left out.
    """

    def __init__(self, by: list[str], rates: list[str], names: list[str], fit: Callable) -> None:
        self.by, self.rates, self.names, self.fit = by, rates, names, fit

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.num_rows
            if size >= BLOCK:
                rows = pa.concat_tables(held).combine_chunks()
                starts = self.starts(rows)
                if len(starts) > 1:  # the last group may go on
                    yield from self.run(rows.slice(0, starts[-1]))
                    rows = rows.slice(starts[-1])
                held, size = [rows], rows.num_rows
        if size:
            yield from self.run(pa.concat_tables(held).combine_chunks())

    def starts(self, rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for name in self.by:
            own = rows[name].to_numpy()
            new[1:] |= own[1:] != own[:-1]
        return np.flatnonzero(new)

    def run(self, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        starts = self.starts(rows)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, rows.num_rows)))
        rates = []
        for name in self.rates:
            own = rows[f"{name}_"].to_numpy()
            if (own != own[starts][group]).any():
                raise ValueError(f"{name} differs within a group")
            rates.append(own[starts])
        out = self.fit(group, *(rows[c].to_numpy() for c in ("conversion", "base", "count")), *rates)
        kept = np.flatnonzero(~np.isnan(out[0]))
        keys = rows.select(self.by).take(pa.array(starts[kept]))
        columns = [*(c.combine_chunks() for c in keys.columns), *(pa.array(np.asarray(o, float)[kept], from_pandas=True) for o in out)]
        yield from pa.Table.from_arrays(columns, names=[*self.by, *self.names]).combine_chunks().to_batches()


def _fitted(rows: DataFrame, by: list[str], rates: list[str], names: list[str], fit: Callable) -> DataFrame:
    """rows of `_keyed`, fitted group by group."""
    own = rows.select(*by, "conversion", "base", "count", *[f"{r}_" for r in rates])
    return own.mapInArrow(_Groups(by, rates, names, fit), T.StructType([*(f for f in own.schema.fields if f.name in by), *[T.StructField(c, T.DoubleType()) for c in names]]))


def fit_induced(histogram: DataFrame, p_e: DataFrame, by: list[str], threshold: int = 1000, nasc: bool = False, p_e_by: list[str] | None = None) -> DataFrame:
    """p_c for each group of at least `threshold` reads; groups without a fit are left out.

    Groups with more than one p_e are an error, as is a p_e without keys that is not one row.
    """
    rows = _keyed(histogram, by, threshold, [(p_e, "p_e", by if p_e_by is None else p_e_by)])
    run = induced_rates_nasc if nasc else induced_rates
    return _fitted(rows, by, ["p_e"], ["p_c"], lambda group, k, n, count, p: [run(group, k, n, count, p)])


def fit_share(histogram: DataFrame, p_e: DataFrame, p_c: DataFrame, by: list[str], rates_by: list[str], threshold: int = 16, nasc: bool = False) -> DataFrame:
    """alpha, beta and pi for each group of at least `threshold` reads that has both rates.

    Groups with more than one p_e or p_c are an error.
    """
    rows = _keyed(histogram, by, threshold, [(p_e, "p_e", rates_by if set(rates_by) <= set(p_e.columns) else []), (p_c, "p_c", rates_by)])

    def fit(group, k, n, count, background, induced) -> list[np.ndarray]:
        ends = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
        found = [new_share(k[a:b], n[a:b], count[a:b], e, c) for a, b, e, c in zip(ends, ends[1:], background, induced)]
        alpha, beta, pi = np.array(found).reshape(-1, 3).T
        return [alpha, beta, np.array([beta_mode_of(a, b) for a, b in zip(alpha, beta)]) if nasc else pi]

    return _fitted(rows, by, ["p_e", "p_c"], ["alpha", "beta", "pi"], fit)
