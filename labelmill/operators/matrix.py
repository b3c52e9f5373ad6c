"""Cell by gene matrices as rows of coordinates, and their layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labelmill.operators.filters import is_labeled

#: Prefix of the unlabeled and labeled layers of each read group.
LABEL_LAYERS = {"transcriptome": ("X_n_", "X_l_"), "total": ("unlabeled_", "labeled_"), "spliced": ("sn_", "sl_"), "unspliced": ("un_", "ul_")}


def counts_matrix(counts: DataFrame, gene: str = "gx") -> DataFrame:
    """Reads per cell and gene."""
    return counts.groupBy("barcode", gene).agg(F.count(F.lit(1)).alias("value"))


def split_counts(counts: DataFrame, conversions: list[str], gene: str = "gx") -> DataFrame:
    """Unlabeled and labeled reads per cell and gene."""
    labeled = is_labeled(conversions)
    return counts.groupBy("barcode", gene).agg(F.count_if(~labeled).alias("unlabeled"), F.count_if(labeled).alias("labeled"))


def label_name(label: list[str]) -> str:
    return "_".join(sorted(label))


def layer_conditions(labels: list[list[str]]) -> dict[str, Column]:
    """Layer -> which reads it counts.

    With several labels, the layers of one count only reads without conversions of the others.
    """
    group = {"transcriptome": F.coalesce(F.col("transcriptome"), F.lit(False)), "total": F.lit(True), "spliced": F.col("velocity") == "spliced", "unspliced": F.col("velocity") == "unspliced"}
    out = {"X": group["transcriptome"], "total": group["total"], "spliced": group["spliced"], "unspliced": group["unspliced"], "ambiguous": F.col("velocity") == "ambiguous"}
    for label in labels:
        others = sorted({c for x in labels for c in x} - set(label))
        alone = ~is_labeled(others) if others else F.lit(True)
        for g, (new, old) in LABEL_LAYERS.items():
            out[new + label_name(label)] = group[g] & alone & ~is_labeled(label)
            out[old + label_name(label)] = group[g] & alone & is_labeled(label)
    return out


def layers_wide(counts: DataFrame, labels: list[list[str]], gene: str = "gx") -> DataFrame:
    """All layers in one pass, one column each."""
    return counts.groupBy("barcode", gene).agg(*[F.count_if(c).alias(n) for n, c in layer_conditions(labels).items()])


def layers_long(counts: DataFrame, labels: list[list[str]], gene: str = "gx") -> DataFrame:
    """layer, barcode, gene, value; zeros are left out."""
    names = list(layer_conditions(labels))
    wide = layers_wide(counts, labels, gene)
    return wide.unpivot(["barcode", gene], names, "layer", "value").filter("value > 0").select("layer", "barcode", gene, "value")


def split_by_pi(matrix: DataFrame, pi: DataFrame, keys: list[str] = ("barcode", "gx")) -> DataFrame:
    """Values split into new and old RNA by the estimated share; pairs without one are left out."""
    known = pi.select(*keys, F.col("pi").try_cast("double").alias("pi_")).filter("pi_ is not null")
    joined = matrix.join(known, list(keys))
    return joined.select(*matrix.columns, (F.col("value") * (1 - F.col("pi_"))).alias("unlabeled_est"), (F.col("value") * F.col("pi_")).alias("labeled_est"))


def split_by_alpha(split: DataFrame, alpha: DataFrame, by: list[str] = ("barcode",), gene: str = "gx") -> DataFrame:
    """Labeled reads corrected for those that went undetected; alpha is clipped to [0, 1].

    The labeled estimate never exceeds all reads.  Cells without alpha are left out (0).
    """
    a = F.least(F.greatest(F.col("alpha_"), F.lit(0.0)), F.lit(1.0))
    joined = split.join(alpha.select(*by, F.col("alpha").alias("alpha_")), list(by))
    every = F.col("unlabeled") + F.col("labeled")
    # Where nothing can be detected, a labeled read tells that all may be new, and none that none is.
    est = F.when(a > 0, F.least(F.try_divide(F.col("labeled").cast("double"), a), every.cast("double"))).when(F.col("labeled") > 0, every.cast("double")).otherwise(0.0)
    return joined.withColumn("est_", est).select("barcode", gene, (every - F.col("est_")).alias("unlabeled_est"), F.col("est_").alias("labeled_est"))


def gene_names(rows: DataFrame, genes: DataFrame, gene: str = "gx") -> DataFrame:
    """rows with the gene's name in place of its id, where it has one."""
    names = genes.select(F.col("gx").alias("id_"), F.nullif(F.col("gene_name"), F.lit("")).alias("name_")).dropDuplicates(["id_"])
    joined = rows.join(names, F.col(gene) == F.col("id_"), "left")
    return joined.select(*[F.coalesce("name_", c).alias(c) if c == gene else F.col(c) for c in rows.columns])


def from_inputs(*parts: DataFrame) -> DataFrame:
    """Counts of several inputs as one; with more than one, barcodes get the input's number."""
    if len(parts) == 1:
        return parts[0]
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("barcode", F.concat("barcode", F.lit(f"-{i}")))
        out = p if out is None else out.unionByName(p)
    return out


def observations(cells: DataFrame, several: bool, groups: DataFrame | None = None, p_e: DataFrame | None = None, p_c: DataFrame | None = None) -> DataFrame:
    """One row for each cell: the input it came from, its group and its rates."""
    out = cells.select("barcode").distinct()
    if several:
        out = out.withColumn("count_dir", F.substring_index("barcode", "-", -1).cast("int"))
    if groups is not None:
        out = out.join(groups, "barcode", "left")
    for t in (p_e, p_c):
        if t is not None:
            out = out.join(t, [c for c in t.columns if c in out.columns], "left")
    return out


def fan_out(estimates: DataFrame, groups: DataFrame) -> DataFrame:
    """Estimates of groups given to each of their cells."""
    return groups.select("barcode", "group").join(estimates, "group").drop("group")
