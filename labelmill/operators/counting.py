"""Mismatches counted per read, strand by strand, and reads reduced to molecules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from labelmill.functions.names import free_name
from labelmill.functions.sequences import BASES, CONVERSIONS, N_COLUMNS, QUALITY, base_col, complement, n_col, total
from labelmill.operators.filters import is_labeled, mismatches

READ_KEY = ["read_id", "aln_index"]


def without_snps(conversions: DataFrame, snps: DataFrame) -> DataFrame:
    """Mismatches that are not a known SNP of the same conversion."""
    return conversions.join(snps.select("contig", "genome_i", "conversion"), ["contig", "genome_i", "conversion"], "left_anti")


def distinct_mismatches(conversions: DataFrame, quality: int = QUALITY) -> DataFrame:
    """Good mismatches without repeated deliveries, with the best quality of each.

    Rows are placed by read, which serves this step, the counts per read and their join alike.
    """
    good = mismatches(conversions, None, quality).repartition(*READ_KEY)
    return good.groupBy(*READ_KEY, "contig", "genome_i", "conversion").agg(F.max("quality").alias("quality"))


def count_per_read(conversions: DataFrame, key: list[str] = READ_KEY) -> DataFrame:
    """Twelve counts for every read that has a mismatch."""
    return conversions.groupBy(*key).agg(*[F.count_if(F.col("conversion") == c).alias(n_col(c)) for c in CONVERSIONS])


def count_conversions(alignments: DataFrame, conversions: DataFrame, snps: DataFrame | None = None, quality: int = QUALITY, key: list[str] = READ_KEY) -> DataFrame:
    """Alignments with their twelve counts of good mismatches; reads without any have zeros."""
    good = mismatches(conversions, None, quality)
    if snps is not None:
        good = without_snps(good, snps)
    own = [c for c in alignments.columns if c not in N_COLUMNS]
    return alignments.select(own).join(count_per_read(good, key), key, "left").fillna(0, N_COLUMNS)


def reads_without_mismatch(alignments: DataFrame, conversions: DataFrame, quality: int = QUALITY, key: list[str] = READ_KEY) -> DataFrame:
    return alignments.join(mismatches(conversions, None, quality).select(*key), key, "left_anti")


def only_selected(rows: DataFrame, selected: DataFrame, key: list[str] = READ_KEY) -> DataFrame:
    """Rows of the reads that were selected."""
    return rows.join(selected.select(*key), key, "left_semi")


def complement_counts(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """Counts as seen from the strand of the gene: genes on `-` have every conversion and base
    exchanged for its complement.  Unknown genes stay as they are.  Doing it twice undoes it."""
    strands = genes.select("gx", F.col("strand").alias("strand_")).dropDuplicates(["gx"])
    minus = F.col("strand_") == "-"
    swap = lambda own, other: F.when(minus, F.col(other)).otherwise(F.col(own)).alias(own)
    pairs = {n_col(c): n_col(complement(c)) for c in CONVERSIONS} | {base_col(b): base_col(complement(b)) for b in BASES}
    joined = counts.join(strands, "gx", "left")
    return joined.select(*[swap(c, pairs[c]) if c in pairs else F.col(c) for c in counts.columns])


def _best(df: DataFrame, keys: list[str], order: list[Column], ties: list[str]) -> DataFrame:
    """The row with the greatest tuple of `order` and `ties` for each key.

    Nulls are least; equal tuples are told apart by the other values.  Only the best row of each
    key leaves a map task, as the optimizer limits the groups of the window before the shuffle.
    """
    own = [*ties, *[c for c in df.columns if c not in keys and c not in ties]]
    place = free_name("place_", df.columns)
    by = W.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in [*order, *map(F.col, own)]])
    return df.withColumn(place, F.row_number().over(by)).filter(F.col(place) == 1).drop(place)


def _best_and(df: DataFrame, keys: list[str], order: list[Column], ties: list[str], extra: list[Column]) -> DataFrame:
    """The same with aggregates over all rows of the key, by one aggregate that combines before the shuffle."""
    own = [*ties, *[c for c in df.columns if c not in keys and c not in ties]]
    best = F.max(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c).alias(f"r{i}") for i, c in enumerate(own)])).alias("best_")
    out = df.groupBy(*keys).agg(best, *extra)
    names = [F.col(k) if k in keys else F.col(f"best_.r{own.index(k)}").alias(k) for k in df.columns]
    return out.select(*names, *[F.col(c) for c in out.columns if c not in keys and c != "best_"])


def _rank(conversions: list[str] | None) -> list[Column]:
    return [F.coalesce(F.col("transcriptome"), F.lit(False)), F.col("score"), total(N_COLUMNS if conversions is None else [n_col(c) for c in conversions])]


def deduplicate_counts(counts: DataFrame, conversions: list[str] | None = None, use_conversions: bool = True, ties: list[str] = ("read_id",)) -> DataFrame:
    """One read for each molecule (barcode, umi, gx).

    Preferred are reads with a wanted conversion (if use_conversions and conversions are given),
    then transcriptome reads, the higher score, more conversions; ties by the greatest of `ties`.
    A null key is a key of its own.
    """
    order = _rank(conversions)
    if use_conversions and conversions is not None:
        order = [is_labeled(conversions), *order]
    return _best(counts, ["barcode", "umi", "gx"], order, list(ties))


def drop_multimappers(counts: DataFrame, conversions: list[str] | None = None, ties: list[str] = ("gx", "velocity")) -> DataFrame:
    """One row for each read_id.

    If none of a read's rows is transcriptome, rows of several genes drop the read, and rows of
    several velocity classes make it ambiguous.  The row that stays is a transcriptome one, then
    the one of higher score, then of more conversions.
    """
    none = ~F.bool_or(F.coalesce(F.col("transcriptome"), F.lit(False)))
    several = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False))
    best = _best_and(counts, ["read_id"], _rank(conversions), list(ties), [(none & several("gx")).alias("many_genes_"), (none & several("velocity")).alias("many_velocities_")])
    return best.filter(~F.col("many_genes_")).withColumn("velocity", F.when(F.col("many_velocities_"), "ambiguous").otherwise(F.col("velocity"))).drop("many_genes_", "many_velocities_")


def select_alignments(alignments: DataFrame, umis: bool = True) -> DataFrame:
    """Keys of the alignments that stand for a molecule (with UMIs) or for a read (without)."""
    order = [F.coalesce(F.col("transcriptome"), F.lit(False)), F.col("score")]
    if umis:
        own = alignments.select("barcode", "umi", "gx", *READ_KEY, "transcriptome", "score")
        return _best(own, ["barcode", "umi", "gx"], order, READ_KEY).select(*READ_KEY)
    none = ~F.bool_or(F.coalesce(F.col("transcriptome"), F.lit(False)))
    many = (none & F.coalesce(F.min("gx") != F.max("gx"), F.lit(False))).alias("many_genes_")
    own = alignments.select("gx", *READ_KEY, "transcriptome", "score")
    return _best_and(own, ["read_id"], order, ["aln_index"], [many]).filter(~F.col("many_genes_")).select(*READ_KEY)


def split_by_velocity(counts: DataFrame, classes: list[str]) -> dict[str, DataFrame]:
    return {v: counts.filter(F.col("velocity") == v) for v in classes}
