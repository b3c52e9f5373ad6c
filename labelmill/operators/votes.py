"""Consensus of reads position by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labelmill.functions.sequences import BASES

#: Highest quality that is written.
MOST_QUALITY = 42


def vote(rows: DataFrame, keys: list[str], ref: str, base: str, quality: str, least: int = 27) -> DataFrame:
    """For each position the base with the greatest sum of qualities.

    Below `least` the reference base is taken; at a tie the reference if it is among the best,
    else the first base in the alphabet.  Gives keys, base and the sum clipped to 42.
    """
    sums = rows.groupBy(*keys).agg(F.min(ref).alias("ref_"), *[F.sum(F.when(F.col(base) == b, F.col(quality)).otherwise(0)).alias(f"q_{b}") for b in BASES])
    best = F.greatest(*[F.col(f"q_{b}") for b in BASES])
    first: Column = F.lit(None).cast("string")
    for b in reversed(BASES):
        first = F.when(F.col(f"q_{b}") == best, b).otherwise(first)
    tied = F.lit(False)
    for b in BASES:
        tied = tied | ((F.col("ref_") == b) & (F.col(f"q_{b}") == best))
    return sums.select(*keys, F.when((best < least) | tied, F.col("ref_")).otherwise(first).alias("base"), F.least(best, F.lit(MOST_QUALITY)).cast("long").alias("quality"))


def pseudo_umi(umi: Column, start: Column, end: Column) -> Column:
    """Pairs without UMI are told apart by where they lie."""
    return F.coalesce(umi, F.concat_ws("_", start.cast("string"), end.cast("string")))


def _digest(name: Column, first: int) -> Column:
    """Sum over rows of 15 hex digits of the MD5 of a name."""
    return F.sum(F.conv(F.substring(F.md5(name), first, 15), 16, 10).cast("decimal(38,0)")).cast("string")


def group_facts(rows: DataFrame, keys: list[str], name: str = "read_id", start: str = "start", end: str = "end", score: str = "score", names: str | None = None) -> DataFrame:
    """What a consensus read takes from its group: span, summed score, number and a hash of names.

    The hash is made of sums over the hashes of the names, so it is the same whatever order the
    rows come in and no group gathers its names.  names: a column; the ids of the reads (names)
    and that column (hits), in one order and each with semicolons between, are wanted as well.
    """
    facts = [
        F.min(start).alias("start"),
        F.max(end).alias("end"),
        F.sum(score).alias("score"),
        F.count(F.lit(1)).alias("n_reads"),
        F.sha2(F.concat_ws("/", _digest(F.col(name), 1), _digest(F.col(name), 16), F.count(F.lit(1)).cast("string")), 256).alias("name"),
    ]
    if names is None:
        return rows.groupBy(*keys).agg(*facts)
    each = F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), F.col(names).alias("h"))))
    out = rows.groupBy(*keys).agg(*facts, each.alias("each_"))
    return out.withColumn("names", F.array_join("each_.n", ";")).withColumn("hits", F.array_join("each_.h", ";")).drop("each_")


def consensus_strand(gene_strand: Column, protocol: str) -> Column:
    """Strand of a consensus read: that of the gene, the other one for a reverse protocol."""
    return F.when(gene_strand == "-", "+").otherwise("-") if protocol == "reverse" else gene_strand


def read_strand(flag: Column, protocol: str) -> Column:
    """Strand of the RNA that a record comes from; null for an unstranded protocol."""
    if protocol == "unstranded":
        return F.lit(None).cast("string")
    bit = lambda b: flag.bitwiseAND(F.lit(b)) != 0
    # The first mate of a pair lies the other way round than the second, or than a single read.
    turned = bit(0x10) != (bit(0x1) & bit(0x40))
    if protocol == "reverse":
        turned = ~turned
    return F.when(turned, "-").otherwise("+")
