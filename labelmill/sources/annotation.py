"""Genes and transcripts of a GTF file, and facts of a FASTA file."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

_COLUMNS = "contig string, source string, feature string, first long, last long, score string, strand string, frame string, attributes string"


def read_gtf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Genes (gx, contig, strand, seg_start, seg_end, gene_name) and transcripts (gx, transcript,
    exons, introns), half-open and counted from 0.

    Lines may come in any order and genes may lack a line of their own; a gene spans all its lines.
    Attributes are found wherever they stand, with any separators around them.
    """
    raw = spark.read.csv(path, schema=_COLUMNS, sep="\t", comment="#", quote="")
    attribute = lambda a: F.nullif(F.regexp_extract("attributes", rf'(?:^|[;,\s]){a} "([^"]*)"', 1), F.lit(""))
    rows = raw.filter("first is not null and last is not null").select("contig", "feature", "strand", (F.col("first") - 1).alias("start"), F.col("last").alias("end"), attribute("gene_id").alias("gx"), attribute("transcript_id").alias("transcript"), attribute("gene_name").alias("gene_name")).filter("gx is not null")
    genes = rows.groupBy("gx").agg(F.min("contig").alias("contig"), F.min("strand").alias("strand"), F.min("start").alias("seg_start"), F.max("end").alias("seg_end"), F.max("gene_name").alias("gene_name"))
    exons = rows.filter("feature = 'exon' and transcript is not null").select("gx", "transcript", "start", "end").distinct()
    order = W.partitionBy("gx", "transcript").orderBy("start", "end")
    gaps = exons.withColumn("before", F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)))
    gap = F.when(F.col("before") < F.col("start"), F.struct(F.col("before").alias("start"), F.col("start").alias("end")))
    transcripts = gaps.groupBy("gx", "transcript").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("exons"), F.array_sort(F.array_compact(F.collect_list(gap))).alias("introns"))
    return genes, transcripts


def fasta_facts(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of sequences and their whole length."""
    head = F.col("value").startswith(">")
    row = spark.read.text(path).agg(F.count_if(head).alias("n"), F.coalesce(F.sum(F.when(~head, F.length(F.trim("value")))), F.lit(0)).alias("length")).collect()[0]
    return row["n"], row["length"]


def index_parameters(sequences: int, length: int, memory: int = 16 << 30) -> dict[str, int]:
    """Parameters of an aligner's suffix array index for a genome of this size and this memory.

    The index of the array takes 8 bytes for each of 4**bases prefixes and the array 8 bytes a
    base, thinned out until it fits beside the genome and two spare gigabytes.
    """
    if sequences < 1 or length < 1:
        raise ValueError("a genome has sequences")
    bases = min(14, int(math.log2(length) / 2 - 1))
    prefixes = 8 * 4**bases
    least = length + prefixes + (3 << 30)
    if memory < least:
        raise ValueError(f"an index of this genome takes at least {least} bytes of memory")
    room = max(1, memory - (2 << 30)) - length - prefixes
    return {"genomeSAindexNbases": bases, "genomeChrBinNbits": min(18, int(math.log2(length / sequences))), "genomeSAsparseD": max(1, -(-8 * length // room)), "limitGenomeGenerateRAM": memory}
