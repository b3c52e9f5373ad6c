"""Joins by position: reads within genes, segments against exons and introns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Bases of one bin of an interval join.
BIN = 1 << 16


def _bins(start: Column, end: Column, width: int) -> Column:
    """Bins that the half-open interval [start, end) touches."""
    return F.sequence((start / width).cast("long"), ((F.greatest(end, start + 1) - 1) / width).cast("long"))


def containing_genes(reads: DataFrame, genes: DataFrame, *, by_strand: bool = True, width: int = BIN) -> DataFrame:
    """reads (contig, start, end, strand, ...) joined with every gene that holds them wholly.

    A gene is sent to each bin that it touches; a read is looked up only in the bin of its start,
    so a pair is met once and no range join is needed.  A read without strand fits either.
    """
    right = genes.select(F.col("contig").alias("g_contig"), F.col("strand").alias("g_strand"), F.col("seg_start").alias("g_start"), F.col("seg_end").alias("g_end"), F.col("gx").alias("gene"))
    right = right.withColumn("g_bin", F.explode(_bins(F.col("g_start"), F.col("g_end"), width)))
    on = (F.col("contig") == F.col("g_contig")) & ((F.col("start") / width).cast("long") == F.col("g_bin"))
    on = on & (F.col("start") >= F.col("g_start")) & (F.col("end") <= F.col("g_end"))
    if by_strand:
        on = on & (F.col("strand").isNull() | (F.col("strand") == F.col("g_strand")))
    return reads.join(right, on).drop("g_contig", "g_bin", "g_strand")


def unique_gene(reads: DataFrame, genes: DataFrame, key: list[str], *, by_strand: bool = True, width: int = BIN) -> DataFrame:
    """Key and gene of the reads that exactly one gene holds; repeated reads and genes count once."""
    found = containing_genes(reads.select(*key, "contig", "start", "end", "strand"), genes, by_strand=by_strand, width=width)
    return found.groupBy(*key).agg(F.min("gene").alias("gene"), F.max("gene").alias("last_")).filter("gene = last_").drop("last_")


def overlaps(segments: Column, others: Column) -> Column:
    """Any of the half-open segments (start, end) overlaps any of the others."""
    return F.exists(segments, lambda s: F.exists(others, lambda o: (s["start"] < o["end"]) & (s["end"] > o["start"])))


def within(segments: Column, others: Column) -> Column:
    """Every segment lies within one of the others."""
    return F.forall(segments, lambda s: F.exists(others, lambda o: (s["start"] >= o["start"]) & (s["end"] <= o["end"])))


def velocity_class(exonic: Column, intronic: Column, strict: bool = True) -> Column:
    """Spliced, unspliced or ambiguous from: within exons, touches an intron."""
    both = F.lit("ambiguous" if strict else "spliced")
    return F.when(exonic & ~intronic, "spliced").when(exonic & intronic, both).when(intronic, "unspliced").otherwise("ambiguous")


def velocity_of(reads: DataFrame, transcripts: DataFrame, key: list[str], strict: bool = True) -> DataFrame:
    """Velocity class of each read from all transcripts of its gene.

    reads: key, gx, segments; transcripts: gx, exons, introns (arrays of start, end).  Reads of a
    gene without transcripts are ambiguous.
    """
    joined = reads.select(*key, "gx", "segments").join(transcripts.select("gx", "exons", "introns"), "gx", "left")
    exonic = F.bool_or(F.coalesce(within(F.col("segments"), F.col("exons")), F.lit(False))).alias("exonic")
    intronic = F.bool_or(F.coalesce(overlaps(F.col("segments"), F.col("introns")), F.lit(False))).alias("intronic")
    return joined.groupBy(*key).agg(exonic, intronic).select(*key, velocity_class(F.col("exonic"), F.col("intronic"), strict).alias("velocity"))


def segments_of(positions: Column) -> Column:
    """Sorted distinct positions as maximal half-open segments (start, end)."""
    sorted_ = F.array_sort(F.array_distinct(positions))
    start = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def grow(done: Column, p: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), (p.cast("long") + 1).alias("end"))))
        other = F.concat(done, F.array(F.struct(p.cast("long").alias("start"), (p.cast("long") + 1).alias("end"))))
        return F.when((F.size(done) > 0) & (last["end"] == p), longer).otherwise(other)

    return F.aggregate(sorted_, start, grow)


def islands(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Maximal runs of neighbouring positions within each key: start, end (half-open), n_positions.

    Runs are found within bins of positions first and those that touch a border are joined over
    bins, so no key's positions are sorted in one task.
    """
    p = F.col(position)
    each = rows.select(*keys, p.cast("long").alias("p_")).filter("p_ is not null").distinct().withColumn("bin_", F.floor(F.col("p_") / BIN))
    inner = W.partitionBy(*keys, "bin_").orderBy("p_")
    runs = each.withColumn("run_", F.col("p_") - F.row_number().over(inner)).groupBy(*keys, "bin_", "run_").agg(F.min("p_").alias("start"), (F.max("p_") + 1).alias("end"))
    # Within a bin only its first and its last run can go on in a neighbour.
    edge = (F.col("start") == F.col("bin_") * BIN) | (F.col("end") == (F.col("bin_") + 1) * BIN)
    order = W.partitionBy(*keys).orderBy("start")
    chained = runs.filter(edge).withColumn("new_", F.coalesce((F.lag("end").over(order) != F.col("start")).cast("int"), F.lit(1)))
    chained = chained.withColumn("run_", F.sum("new_").over(order)).groupBy(*keys, "run_").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    out = runs.filter(~edge).select(*keys, "start", "end").unionByName(chained.select(*keys, "start", "end"))
    return out.withColumn("n_positions", F.col("end") - F.col("start"))
