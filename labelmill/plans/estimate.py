"""From counts to rates, shares of new RNA and corrected layers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from labelmill.functions.sequences import UNUSABLE_VELOCITY
from labelmill.functions.storage import checkpointed
from labelmill.operators import counting, estimators, filters, matrix, rates, sample


@dataclass
class EstimateResult:
    """p_e; p_c by label; histograms, pi, alpha by (read group, label); corrected layers; cells."""

    read_groups: list[str]
    p_e: DataFrame
    histograms: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    p_c: dict[str, DataFrame] = field(default_factory=dict)
    pi: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    alpha: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    layers: DataFrame | None = None
    cells: DataFrame | None = None


def choose_read_groups(facts, reads: list[str] | None) -> list[str]:
    """Read groups that can be estimated; those asked for must be among them."""
    velocities = [v for v in (facts["velocities"] or "").split(",") if v and v not in UNUSABLE_VELOCITY]
    can = (["transcriptome"] if facts["any_transcriptome"] else []) + ([] if facts["all_transcriptome"] else ["total"]) + velocities
    if not reads:
        return can
    for r in reads:
        if r not in can:
            raise ValueError(f"no reads to estimate `{r}` from" if r != "total" else "all reads are transcriptome, so `total` is not estimated")
    return list(reads)


def estimate(inputs: list[DataFrame], genes: DataFrame, labels: list[list[str]], *, reads: list[str] | None = None, barcodes: list[DataFrame] | None = None, groups: list[DataFrame] | None = None, ignore_groups: bool = False, only_genes: list[str] | DataFrame | None = None, downsample_count: int | None = None, downsample_share: float | None = None, downsample_by: str | None = None, cell_threshold: int = 1000, cell_gene_threshold: int = 16, known_p_e: float | None = None, control: bool = False, method: str = "alpha", nasc: bool = False, by_name: bool = False, seed: int = 0) -> EstimateResult:
    """inputs: counts on the forward strand, one for each run.

    With several inputs, barcodes get the number of their input, and groups are given for each.
    """
    if method not in ("alpha", "pi_g"):
        raise ValueError(f"no such method: {method}")
    if control and known_p_e is not None:
        raise ValueError("a control has no background given")
    if len(inputs) > 1 and (not groups or nasc):
        raise ValueError("several inputs need groups" if not groups else "nasc takes one input")
    for given in (groups, barcodes):
        if given and len(given) != len(inputs):
            raise ValueError("as many lists as inputs are needed")
    if ignore_groups and not groups:
        raise ValueError("there are no groups to ignore")
    if barcodes:
        inputs = [d.join(b.select("barcode"), "barcode", "left_semi") for d, b in zip(inputs, barcodes)]
    counts = matrix.from_inputs(*inputs)
    group_of = matrix.from_inputs(*groups) if groups else None
    if group_of is not None:
        counts = filters.in_groups(counts, group_of)
    if downsample_count is not None or downsample_share is not None:
        key = [c for c in counts.columns if c not in ("group",)]
        counts = sample.downsample(counts, key, count=downsample_count, proportion=downsample_share, by=[downsample_by] if downsample_by else None, seed=seed)
    # Facts, rates, histograms of all read groups and labels, and the layers are made of these rows.
    counts = checkpointed(counts)
    facts = filters.table_facts(counts.withColumns({c: F.lit(None).cast("string") for c in ("umi",) if c not in counts.columns})).collect()[0]
    chosen = choose_read_groups(facts, reads)
    forward, counts = counts, counting.complement_counts(counts, genes)
    if by_name:
        counts = matrix.gene_names(counts, genes)
    if only_genes is not None:
        counts = filters.of_genes(counts, only_genes)
    by = "group" if groups else "barcode"
    if known_p_e is not None:
        p_e = counts.select(by).distinct().withColumn("p_e", F.lit(float(known_p_e)))
    elif control:
        return EstimateResult(chosen, rates.background_control(counts, labels))
    elif nasc:
        p_e = rates.background_nasc(rates.mutation_rates(forward, [by]), [by])
    else:
        p_e = rates.background(counts, labels, [by])
    p_e = checkpointed(p_e.filter(F.col(by).isNotNull() & F.col("p_e").isNotNull()))
    out = EstimateResult(chosen, p_e)
    everything = "transcriptome" if facts["all_transcriptome"] else "total"
    keys = ["barcode", "gx", *(["group"] if groups else [])]
    corrected = []
    for label in labels:
        name = matrix.label_name(label)
        alone = filters.exclusive_to(counts, label, labels)
        for r in dict.fromkeys([everything, *chosen]):
            out.histograms[r, name] = rates.aggregate_counts(filters.read_group(alone, r), label, keys)
        # Fits are small and costly: they are kept, not run again for each table that needs them.
        out.p_c[name] = checkpointed(estimators.fit_induced(out.histograms[everything, name], p_e, [by], cell_threshold, nasc))
        for r in chosen:
            own = filters.read_group(alone, r)
            new, old = matrix.LABEL_LAYERS[r]
            if method == "pi_g":
                to = ["group" if groups and not ignore_groups else "barcode", "gx"]
                pi = checkpointed(estimators.fit_share(out.histograms[r, name], p_e, out.p_c[name], to, [by], cell_gene_threshold, nasc))
                out.pi[r, name] = pi
                per_cell = matrix.fan_out(pi, group_of) if to[0] == "group" else pi
                est = matrix.split_by_pi(matrix.counts_matrix(filters.read_group(counts, r)), per_cell)
            else:
                pi = checkpointed(estimators.fit_share(out.histograms[r, name], p_e, out.p_c[name], [by], [by], cell_gene_threshold, nasc))
                out.pi[r, name] = pi
                to = "group" if groups and not ignore_groups else "barcode"
                alpha = rates.detection(filters.read_group(counts, r), pi, label, [to], [by])
                out.alpha[r, name] = alpha
                per_cell = matrix.fan_out(alpha, group_of) if to == "group" else alpha
                est = matrix.split_by_alpha(matrix.split_counts(own, label), per_cell)
            for part, layer in (("unlabeled_est", new), ("labeled_est", old)):
                corrected.append(est.select(F.lit(f"{layer}{name}_est").alias("layer"), "barcode", "gx", F.col(part).alias("value")))
    out.layers = matrix.layers_long(counts, labels).withColumn("value", F.col("value").cast("double"))
    for c in corrected:
        out.layers = out.layers.unionByName(c.filter("value > 0"))
    cells = counts.select("barcode", *(["group"] if groups else [])).distinct()
    if len(inputs) > 1:
        cells = cells.withColumn("count_dir", F.substring_index("barcode", "-", -1).cast("int"))
    cells = cells.join(p_e, by, "left")
    for name, p_c in out.p_c.items():
        cells = cells.join(p_c.withColumnRenamed("p_c", f"p_c_{name}"), by, "left")
    out.cells = cells
    return out
