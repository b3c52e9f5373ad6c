"""Command line: python -m labelmill.cli ref|align|consensus|count|estimate ..."""

from __future__ import annotations

import argparse
import json
import os
import shutil
import subprocess
import sys

from pyspark.sql import SparkSession, functions as F

from labelmill.functions.sequences import CONVERSIONS, QUALITY
from labelmill.sources import annotation, sam, sinks, tables, technology

STRANDS = ["forward", "reverse", "unstranded", "auto"]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="labelmill", description="Labeled-RNA read analytics on Spark")
    p.add_argument("--list", action="store_true", help="show the known technologies")
    commands = p.add_subparsers(dest="command")
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--master", default=None, help="Spark master; the environment's by default")
    shared.add_argument("--verbose", action="store_true")

    ref = commands.add_parser("ref", parents=[shared], help="index a genome with the external aligner")
    ref.add_argument("-i", required=True, metavar="INDEX")
    ref.add_argument("-m", type=int, default=16, metavar="GB")
    ref.add_argument("-t", type=int, default=8, metavar="THREADS")
    ref.add_argument("fasta")
    ref.add_argument("gtf")

    align = commands.add_parser("align", parents=[shared], help="align reads with the external aligner")
    align.add_argument("-i", required=True, metavar="INDEX")
    align.add_argument("-o", default=".")
    align.add_argument("-x", required=True, choices=sorted(technology.TECHNOLOGIES))
    align.add_argument("-w", default=None, metavar="WHITELIST")
    align.add_argument("-t", type=int, default=8, metavar="THREADS")
    align.add_argument("--strand", default="auto", choices=STRANDS)
    align.add_argument("--overrides", default="", help="further arguments of the aligner")
    align.add_argument("--nasc", action="store_true", help=argparse.SUPPRESS)
    align.add_argument("fastqs", nargs="+")

    for name, text in (("consensus", "call one read for each molecule"), ("count", "count conversions per cell and gene")):
        c = commands.add_parser(name, parents=[shared], help=text)
        c.add_argument("-g", required=True, metavar="GTF")
        c.add_argument("-o", default=".")
        c.add_argument("--umi-tag")
        c.add_argument("--barcode-tag")
        c.add_argument("--gene-tag", default="GX")
        c.add_argument("--strand", default="auto", choices=STRANDS)
        c.add_argument("--quality", type=int, default=QUALITY)
        c.add_argument("--barcodes")
        c.add_argument("bam")
        if name == "consensus":
            c.add_argument("--add-RS-RI", action="store_true", dest="names")
            continue
        c.add_argument("--conversion", required=True, action="append", metavar="XY[,XY...]")
        c.add_argument("--snp-threshold", type=float)
        c.add_argument("--snp-min-coverage", type=int, default=1)
        c.add_argument("--snp-csv")
        c.add_argument("--gene-names", action="store_true")
        c.add_argument("--no-splicing", "--transcriptome-only", action="store_true", dest="no_splicing")
        c.add_argument("--exon-overlap", default="strict", choices=["lenient", "strict"])
        c.add_argument("--control", action="store_true")
        c.add_argument("--dedup-mode", default="auto", choices=["auto", "conversion", "exon"])
        c.add_argument("--nasc", action="store_true", help=argparse.SUPPRESS)
        c.add_argument("--overwrite", action="store_true")

    e = commands.add_parser("estimate", parents=[shared], help="estimate rates and shares of new RNA")
    e.add_argument("-o", default=".")
    e.add_argument("--reads", action="append", choices=["total", "transcriptome", "spliced", "unspliced"])
    e.add_argument("--barcodes", action="append")
    e.add_argument("--groups", action="append")
    e.add_argument("--method", default="alpha", choices=["pi_g", "alpha"])
    e.add_argument("--ignore-groups-for-est", action="store_true")
    e.add_argument("--genes")
    e.add_argument("--cell-threshold", type=int, default=1000)
    e.add_argument("--cell-gene-threshold", type=int, default=16)
    e.add_argument("--gene-names", action="store_true")
    e.add_argument("--downsample", type=float)
    e.add_argument("--downsample-mode", default="uniform", choices=["uniform", "cell", "group"])
    e.add_argument("--nasc", action="store_true", help=argparse.SUPPRESS)
    e.add_argument("--seed", type=int, default=0, help=argparse.SUPPRESS)
    e.add_argument("--control", action="store_true")
    e.add_argument("--p-e", dest="p_e")
    e.add_argument("count_dirs", nargs="+")
    return p


def labels_of(arguments: list[str], error) -> list[list[str]]:
    """Each --conversion is a label of one or more codes; no code may be in two labels."""
    labels = [sorted(a.upper().split(",")) for a in arguments]
    every = [c for label in labels for c in label]
    if unknown := sorted(set(every) - set(CONVERSIONS)):
        error(f"no such conversion: {', '.join(unknown)}")
    if len(set(every)) != len(every):
        error("a conversion is given twice")
    return sorted(labels)


def _aligner(error) -> str:
    return shutil.which("STAR") or error("the aligner STAR is not on the path")


def run_ref(spark: SparkSession, a, error) -> list[str]:
    n, length = annotation.fasta_facts(spark, a.fasta)
    own = annotation.index_parameters(n, length, a.m << 30)
    arguments = {"--runMode": "genomeGenerate", "--genomeDir": a.i, "--genomeFastaFiles": a.fasta, "--sjdbGTFfile": a.gtf, "--runThreadN": a.t} | {f"--{k}": v for k, v in own.items()}
    return technology.argument_list(arguments)


def run_align(spark: SparkSession, a, error) -> list[str]:
    t = technology.TECHNOLOGIES[a.x]
    strand = t.strand if a.strand == "auto" else a.strand
    arguments = {"--genomeDir": a.i, "--runThreadN": a.t, "--outFileNamePrefix": a.o.rstrip("/") + "/", "--soloStrand": strand.capitalize()}
    arguments = technology.merge_arguments(arguments, t.arguments)
    if t.name == "smartseq":
        if len(a.fastqs) != 1:
            error("one manifest is expected for smartseq")
        rows = tables.read_manifest(spark, a.fastqs[0]).collect()  # a line for each cell of a plate
        for r in rows:
            for f in (r["fastq_1"], r["fastq_2"]):
                if f and not os.path.exists(f):
                    error(f"{f} does not exist")
        manifest = os.path.join(a.o, "manifest.tsv")
        os.makedirs(a.o, exist_ok=True)
        with open(manifest, "w") as out:
            out.writelines(f"{r['fastq_1']}\t{r['fastq_2'] or '-'}\t{r['cell']}\n" for r in rows)
        arguments["--readFilesManifest"] = manifest
    else:
        if len(a.fastqs) != 2:
            error(f"two read files are expected, not {len(a.fastqs)}")
        (b, n), (u, m) = t.barcode, t.umi
        arguments |= {"--soloType": "CB_UMI_Simple", "--soloCBstart": b + 1, "--soloCBlen": n, "--soloUMIstart": u + 1, "--soloUMIlen": m, "--readFilesIn": list(a.fastqs)}
        if a.w:
            arguments["--soloCBwhitelist"] = a.w
    arguments.update(technology.parse_overrides(a.overrides))
    return technology.argument_list(arguments)


def _strand(a, error) -> str:
    if a.strand != "auto":
        return a.strand
    return technology.detect_strand(sam.read_header(a.bam)) or error("the strand is not told by the file; give --strand")


def _check_quality(a, error) -> None:
    if not 0 <= a.quality <= 41:
        error("--quality is between 0 and 41")
    if a.barcodes and not a.barcode_tag:
        error("--barcodes needs --barcode-tag")


def run_consensus(spark: SparkSession, a, error) -> None:
    from labelmill.plans.consensus import consensus

    _check_quality(a, error)
    genes, _ = annotation.read_gtf(spark, a.g)
    known = tables.read_list(spark, a.barcodes) if a.barcodes else None
    out = consensus(sam.read_records(spark, a.bam), genes, strand=_strand(a, error), umi_tag=a.umi_tag, barcode_tag=a.barcode_tag, gene_tag=a.gene_tag, barcodes=known, quality=a.quality, names=a.names)
    out.write.mode("overwrite").parquet(f"{a.o}/consensus")
    header = [*sam.header_lines(sam.read_header(a.bam)), "@PG\tID:labelmill\tPN:labelmill\tCL:" + " ".join(sys.argv)]
    written = spark.read.parquet(f"{a.o}/consensus")
    sam.write_sam(written, f"{a.o}/consensus.sam", header)
    sam.write_bam(written, f"{a.o}/consensus.bam", header)


def run_count(spark: SparkSession, a, error) -> None:
    from labelmill.plans.count import count

    _check_quality(a, error)
    labels = labels_of(a.conversion, error)
    genes, transcripts = annotation.read_gtf(spark, a.g)
    records = sam.read_records(spark, a.bam)
    known = tables.read_snp_csv(spark, a.snp_csv) if a.snp_csv else None
    barcodes = tables.read_list(spark, a.barcodes) if a.barcodes else None
    tags = sam.tag_names(records)
    if missing := sorted({t for t in (a.umi_tag, a.barcode_tag) if t} - set(tags)):
        error(f"tags not in the file: {', '.join(missing)}")
    paired = sam.file_facts(records)["paired"]
    out = count(records, genes, transcripts, labels, strand=_strand(a, error), umi_tag=a.umi_tag, barcode_tag=a.barcode_tag, gene_tag=a.gene_tag, barcodes=barcodes, control=a.control, quality=a.quality, snp_threshold=a.snp_threshold, snp_min_coverage=a.snp_min_coverage, known_snps=known, velocity=not a.no_splicing, strict=a.exon_overlap == "strict", mode=a.dedup_mode, tags=tags, by_name=a.gene_names, nasc=a.nasc, paired=None if paired else False)
    mode = "overwrite" if a.overwrite else "errorifexists"
    write = lambda df, name: df.write.mode(mode).parquet(f"{a.o}/{name}")
    for name, df in (("alignments", out.alignments), ("conversions", out.conversions), ("counts", out.counts), ("genes", genes), ("coverage", out.coverage), ("snps", out.snps)):
        if df is not None:
            write(df, name)
    for name, df in out.rates.items():
        write(df, "rates" if name == "all" else f"rates_{name}")
    if out.layers is not None:
        sinks.write_matrix(out.layers, f"{a.o}/matrix")
    with open(os.path.join(a.o, "labels.json"), "w") as f:
        json.dump(labels, f)


def run_estimate(spark: SparkSession, a, error) -> None:
    from labelmill.plans.estimate import estimate

    labels = []
    for d in a.count_dirs:
        with open(os.path.join(d, "labels.json")) as f:
            labels.append(json.load(f))
        if labels[-1] != labels[0]:
            error(f"the conversions of {d} differ from those of {a.count_dirs[0]}")
    if a.control and a.p_e:
        error("--control and --p-e exclude each other")
    known = None
    if a.p_e:
        row = tables.read_values(spark, a.p_e, None, ["p_e"]).limit(2).collect()
        known = row[0]["p_e"] if len(row) == 1 else error("--p-e is a file with one number")
    if a.downsample_mode != "uniform" and a.downsample and a.downsample != int(a.downsample):
        error("--downsample is a whole number for cells and groups")
    if a.downsample_mode == "group" and not a.groups:
        error("--downsample-mode group needs --groups")
    # A proportion lies below 1; any other number is a number of reads.
    share = a.downsample if a.downsample and a.downsample < 1 else None
    number = int(a.downsample) if a.downsample and share is None else None
    by = {"uniform": None, "cell": "barcode", "group": "group"}[a.downsample_mode]
    inputs = [spark.read.parquet(f"{d}/counts") for d in a.count_dirs]
    genes = spark.read.parquet(f"{a.count_dirs[0]}/genes")
    out = estimate(inputs, genes, labels[0], reads=a.reads, barcodes=[tables.read_list(spark, p) for p in a.barcodes] if a.barcodes else None, groups=[tables.read_groups(spark, p) for p in a.groups] if a.groups else None, ignore_groups=a.ignore_groups_for_est, only_genes=tables.read_list(spark, a.genes, "gx") if a.genes else None, downsample_count=number, downsample_share=share, downsample_by=by, cell_threshold=a.cell_threshold, cell_gene_threshold=a.cell_gene_threshold, known_p_e=known, control=a.control, method=a.method, nasc=a.nasc, by_name=a.gene_names, seed=a.seed)

    def write(df, name: str) -> None:
        keys = [c for c in ("barcode", "group", "gx") if c in df.columns]
        (df.orderBy(*keys) if keys else df).write.mode("overwrite").csv(f"{a.o}/{name}", header=True)

    write(out.p_e, "p_e")
    for prefix, parts in (("A", out.histograms), ("pi", out.pi), ("alpha", out.alpha)):
        for (r, label), df in parts.items():
            write(df, f"{prefix}_{r}_{label}")
    for label, df in out.p_c.items():
        write(df, f"p_c_{label}")
    if out.layers is not None:
        sinks.write_matrix(out.layers.filter(F.col("barcode").isNotNull()), f"{a.o}/matrix")
        write(out.cells, "cells")


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    if a.list or not a.command:
        for t in technology.TECHNOLOGIES.values():
            print(t.name, "barcode", t.barcode, "umi", t.umi, t.strand, sep="\t")
        return 0
    builder = SparkSession.builder.appName(f"labelmill {a.command}").config("spark.sql.session.timeZone", "UTC")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    spark.sparkContext.setLogLevel("INFO" if a.verbose else "WARN")
    info = sinks.RunInfo()
    if a.command in ("ref", "align"):
        arguments = (run_ref if a.command == "ref" else run_align)(spark, a, p.error)
        return subprocess.run([_aligner(p.error), *arguments], check=False).returncode
    os.makedirs(a.o, exist_ok=True)
    {"consensus": run_consensus, "count": run_count, "estimate": run_estimate}[a.command](spark, a, p.error)
    info.save(a.o)
    return 0


if __name__ == "__main__":
    sys.exit(main())
