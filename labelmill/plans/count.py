"""From alignment records to counts, rates and layers: one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from labelmill.functions.sequences import QUALITY, UNUSABLE_VELOCITY, with_complements
from labelmill.functions.storage import checkpointed
from labelmill.operators import counting, filters, matrix, rates
from labelmill.operators.reads import countable, parse_reads, read_positions


@dataclass
class CountResult:
    """Named tables of a run; rates and layers are empty where they do not apply."""

    alignments: DataFrame
    conversions: DataFrame
    counts: DataFrame
    snps: DataFrame | None = None
    coverage: DataFrame | None = None
    rates: dict[str, DataFrame] = field(default_factory=dict)
    layers: DataFrame | None = None


def dedup_mode(mode: str, tags: list[str]) -> str:
    """`auto`: reads that are a consensus already (tag RN) have their exons preferred."""
    if mode not in ("auto", "conversion", "exon"):
        raise ValueError(f"no such deduplication: {mode}")
    return ("exon" if "RN" in tags else "conversion") if mode == "auto" else mode


def count_tables(alignments: DataFrame, conversions: DataFrame, genes: DataFrame, labels: list[list[str]], *, umis: bool, mode: str = "conversion", snps: DataFrame | None = None, quality: int = QUALITY, control: bool = False, by_name: bool = False, nasc: bool = False, velocities: list[str] | None = None) -> CountResult:
    """Counts, rates and layers of alignments and mismatches that are at hand.

    With UMIs molecules are deduplicated as seen from the strand of their gene, else multimapping
    reads are dropped.  The counts given are on the forward strand.
    """
    every = sorted({c for label in labels for c in label})
    key = [*counting.READ_KEY, *(c for c in ("part",) if c in alignments.columns)]
    counted = counting.count_conversions(alignments, conversions, snps, quality, key).drop("part")
    if umis:
        stranded = counting.complement_counts(counted, genes)
        own = counting.deduplicate_counts(stranded, every, mode == "conversion")
    else:
        own = counting.drop_multimappers(counting.complement_counts(counted, genes), every)
    # Counts, four tables of rates and the layers are all made of these rows.
    own = checkpointed(own)
    forward = counting.complement_counts(own, genes)  # undone
    out = CountResult(alignments, conversions, forward, snps)
    base = forward if nasc else own
    out.rates["all"] = rates.mutation_rates(base, ["barcode"])
    out.rates["X"] = rates.mutation_rates(filters.read_group(base, "transcriptome"), ["barcode"])
    for v in velocities or ["spliced", "unspliced"]:
        if v not in UNUSABLE_VELOCITY:
            out.rates[v] = rates.mutation_rates(filters.read_group(base, v), ["barcode"])
    if not control:
        out.layers = matrix.layers_long(matrix.gene_names(own, genes) if by_name else own, labels)
    return out


def count(records: DataFrame, genes: DataFrame, transcripts: DataFrame | None, labels: list[list[str]], *, strand: str = "forward", umi_tag: str | None = None, barcode_tag: str | None = None, gene_tag: str = "GX", barcodes: DataFrame | None = None, control: bool = False, quality: int = QUALITY, snp_threshold: float | None = None, snp_min_coverage: int = 1, known_snps: DataFrame | None = None, velocity: bool = True, strict: bool = True, mode: str = "auto", tags: list[str] = (), by_name: bool = False, nasc: bool = False, paired: bool | None = None) -> CountResult:
    """The whole way from records.  labels: conversions of each labeling, for instance [["TC"]]."""
    if not 0 <= quality <= 41:
        raise ValueError("the quality is between 0 and 41")
    every = [c for label in labels for c in label]
    if len(set(every)) != len(every):
        raise ValueError("a conversion belongs to one label only")
    if nasc and every != ["TC"]:
        raise ValueError("nasc takes TC only")
    if barcodes is not None and not barcode_tag:
        raise ValueError("a list of barcodes needs a barcode tag")
    alignments, conversions = parse_reads(records, genes, transcripts, strand=strand, umi_tag=umi_tag, barcode_tag=barcode_tag, gene_tag=gene_tag, barcodes=barcodes, nasc=nasc, velocity=velocity, strict=strict, paired=paired)
    snps, coverage = known_snps, None
    if snp_threshold is not None:
        selected = counting.select_alignments(alignments, umis=umi_tag is not None)
        theirs = counting.only_selected(conversions, selected)
        sites = rates.conversion_sites(theirs, every, quality)
        wanted = theirs.filter(F.col("conversion").isin(with_complements(every)))
        kept = countable(records, umi_tag=umi_tag, barcode_tag=barcode_tag, gene_tag=gene_tag, barcodes=barcodes, velocity=velocity)
        coverage = rates.coverage_of_segments(counting.only_selected(read_positions(kept, paired), selected), at=wanted)
        found = rates.detect_snps(sites, coverage, snp_threshold, snp_min_coverage)
        snps = found if known_snps is None else rates.union_snps(found, known_snps)
    out = count_tables(alignments, conversions, genes, labels, umis=umi_tag is not None, mode=dedup_mode(mode, list(tags)), snps=snps, quality=quality, control=control, by_name=by_name, nasc=nasc)
    out.coverage = coverage
    return out
