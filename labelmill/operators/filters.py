"""Predicates over alignments, mismatches and counts, and checks of whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from labelmill.functions.sequences import QUALITY, UNUSABLE_VELOCITY, n_col, with_complements

#: Bits of the flag of an alignment record; fixed values of the SAM format.
PAIRED, PROPER, UNMAPPED, REVERSE, FIRST, LAST, SECONDARY, DUPLICATE = 0x1, 0x2, 0x4, 0x10, 0x40, 0x80, 0x100, 0x400

READ_GROUPS = ("total", "transcriptome", "spliced", "unspliced")


def primary_alignments(df: DataFrame, tags: list[str] = (), *, duplicates: bool = False, flag: str = "flag", tag_map: str = "tags") -> DataFrame:
    """Mapped, primary records that carry every tag of `tags`; duplicates only on request."""
    drop = SECONDARY | UNMAPPED | (0 if duplicates else DUPLICATE)
    keep = F.col(flag).bitwiseAND(F.lit(drop)) == 0
    for t in tags:
        keep = keep & F.map_contains_key(tag_map, t)
    return df.filter(keep)


def required_tags(umi: str | None, barcode: str | None, gene: str | None, velocity: bool) -> list[str]:
    """Tags that a record must have: the gene only if genes are not found by position."""
    return [t for t in (umi, barcode, None if velocity else gene) if t]


def proper_pairs(df: DataFrame, flag: str = "flag") -> DataFrame:
    """Unpaired records, and paired ones whose mate lies as it should."""
    bits = F.col(flag)
    return df.filter((bits.bitwiseAND(F.lit(PAIRED)) == 0) | (bits.bitwiseAND(F.lit(PROPER)) != 0))


def known_barcodes(df: DataFrame, whitelist: DataFrame | None = None, column: str = "barcode") -> DataFrame:
    """Rows with a barcode: not `-`, and on the list if one is given (its first column)."""
    out = df.filter(F.col(column) != "-")
    if whitelist is None:
        return out
    return out.join(whitelist.select(F.col(whitelist.columns[0]).alias(column)), column, "left_semi")


def mismatches(df: DataFrame, conversions: list[str] | None = None, quality: int = QUALITY, *, both_strands: bool = True) -> DataFrame:
    """Mismatches above a quality, of some conversions (as seen from either strand)."""
    out = df.filter(F.col("quality") > quality)
    if conversions is None:
        return out
    return out.filter(F.col("conversion").isin(with_complements(conversions) if both_strands else sorted(conversions)))


def assigned(df: DataFrame) -> DataFrame:
    """Reads that have a gene and a velocity class."""
    return df.filter(F.col("gx").isNotNull() & (F.col("gx") != "") & F.col("velocity").isNotNull())


def read_group(df: DataFrame, group: str) -> DataFrame:
    """Rows of one of READ_GROUPS; any velocity class may be named as well."""
    if group == "total":
        return df
    return df.filter(F.col("transcriptome") if group == "transcriptome" else F.col("velocity") == group)


def usable_velocity(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("velocity").isin(*UNUSABLE_VELOCITY))


def is_labeled(conversions: list[str]) -> Column:
    """At least one of the conversions; nulls count as none."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.col(n_col(c)) > 0 for c in sorted(conversions)]), F.lit(False))


def exclusive_to(df: DataFrame, own: list[str], labels: list[list[str]]) -> DataFrame:
    """Rows without any conversion of the labels other than `own`."""
    other = sorted({c for label in labels for c in label} - set(own))
    return df.filter(~is_labeled(other)) if other else df


def of_genes(df: DataFrame, genes: list[str] | DataFrame, column: str = "gx") -> DataFrame:
    if isinstance(genes, DataFrame):
        return df.join(genes.select(F.col(genes.columns[0]).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(genes))


def in_groups(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows whose barcode belongs to a group, with the group; others are dropped."""
    return df.join(groups.select("barcode", "group"), "barcode")


def at_least(df: DataFrame, keys: list[str], column: str, least: float) -> DataFrame:
    """Groups whose column sums to `least` or more, as keys and total."""
    return df.groupBy(*keys).agg(F.sum(column).alias("total")).filter(F.col("total") >= least)


def informative(df: DataFrame) -> DataFrame:
    """Histogram cells that can tell something: some bases and some reads."""
    return df.filter((F.col("base") > 0) & (F.col("count") > 0))


def table_facts(df: DataFrame) -> DataFrame:
    """One row of what a run decides by: any and all transcriptome, real barcodes and UMIs,
    velocity classes that occur (sorted), numbers of cells and of genes."""
    real = lambda c: F.col(c).isNotNull() & ~F.col(c).isin("NA", "-")
    return df.agg(
        F.bool_or("transcriptome").alias("any_transcriptome"),
        F.bool_and("transcriptome").alias("all_transcriptome"),
        F.bool_and(real("barcode")).alias("all_barcodes"),
        F.bool_and(real("umi")).alias("all_umis"),
        F.array_join(F.array_sort(F.collect_set("velocity")), ",").alias("velocities"),
        F.count_distinct("barcode").alias("n_cells"),
        F.count_distinct("gx").alias("n_genes"),
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; for uniqueness checks."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """df, or a ValueError naming a key that occurs twice."""
    if twice := repeated_keys(df, keys).limit(1).collect():
        raise ValueError(f"{what}: {[twice[0][k] for k in keys]} occurs {twice[0]['n_rows']} times")
    return df
