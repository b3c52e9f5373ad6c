"""Consensus reads of molecules: one read for each gene, barcode and UMI."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from labelmill.functions.sequences import QUALITY
from labelmill.operators import filters, intervals, votes
from labelmill.operators.reads import call_consensus


def consensus(records: DataFrame, genes: DataFrame, *, strand: str = "forward", umi_tag: str | None = None, barcode_tag: str | None = None, gene_tag: str | None = "GX", barcodes: DataFrame | None = None, quality: int = QUALITY, names: bool = False) -> DataFrame:
    """Records with the consensus of every molecule in place of its reads.

    The gene of a read is its tag or the one gene of its strand that holds it; reads with several
    or no gene pass unchanged, as do molecules of one read.  Duplicates take part.
    """
    kept = filters.primary_alignments(records, filters.required_tags(umi_tag, barcode_tag, None, True), duplicates=True)
    tag = lambda t: F.try_element_at("tags", F.lit(t)) if t else F.lit("NA")
    rows = kept.withColumn("barcode", tag(barcode_tag)).withColumn("gx", F.nullif(tag(gene_tag), F.lit("")) if gene_tag else F.lit(None).cast("string"))
    if barcode_tag:
        rows = filters.known_barcodes(rows, barcodes)
    width = F.aggregate(F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), 1), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    rows = rows.withColumn("end", F.col("start") + width).withColumn("strand", votes.read_strand(F.col("flag"), strand))
    rows = rows.withColumn("umi", votes.pseudo_umi(tag(umi_tag) if umi_tag else F.lit(None).cast("string"), F.col("start"), F.col("end")))
    key = ["read_id", "flag", "contig", "start"]
    free = intervals.unique_gene(rows.filter("gx is null"), genes, key)
    rows = rows.join(free, key, "left").withColumn("gx", F.coalesce("gx", "gene")).drop("gene")
    molecule = ["contig", "gx", "barcode", "umi"]
    sizes = rows.filter("gx is not null").groupBy(*molecule).agg(F.count(F.lit(1)).alias("n_"))
    placed = rows.join(sizes, molecule, "left")
    many = placed.filter("n_ > 1").drop("n_")
    called = call_consensus(many, genes, strand=strand, quality=quality, names=names)
    text = lambda c: F.col(c).cast("string")
    pairs = [("AS", text("score")), ("NH", F.lit("1")), ("HI", F.lit("1")), ("RN", text("n_reads")), ("MD", text("md")), ("NM", text("mismatches")), ("GX", F.col("gx")), ("GN", F.col("gn"))]
    if barcode_tag:
        pairs.append((barcode_tag, F.col("barcode")))
    if umi_tag:
        pairs.append((umi_tag, F.col("umi")))
    if names:
        pairs += [("RS", F.col("names")), ("RI", F.col("hits"))]
    tags = F.map_filter(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    out = called.select(F.col("name").alias("read_id"), "flag", "contig", "start", F.lit(255).alias("mapq"), "cigar", "seq", "quality", tags.alias("tags"))
    single = placed.filter("n_ is null or n_ = 1").join(genes.select("gx", F.coalesce(F.nullif("gene_name", F.lit("")), "gx").alias("gn")), "gx", "left")
    swapped = F.when(F.col("gx").isNotNull(), F.map_concat(F.map_filter("tags", lambda k, v: ~k.isin("GX", "GN")), F.map_filter(F.create_map(F.lit("GX"), F.col("gx"), F.lit("GN"), F.coalesce("gn", "gx")), lambda k, v: v.isNotNull()))).otherwise(F.col("tags"))
    return out.unionByName(single.select("read_id", "flag", "contig", "start", "mapq", "cigar", "seq", "quality", swapped.alias("tags")))
