"""Queries through the text formats: test tables written as files of the pipeline and read again.

The SQL takes the tables themselves, so a row is right if nothing was lost or changed on the way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelmill.functions.sequences import BASE_COLUMNS, CONVERSIONS, N_COLUMNS, base_col, n_col
from labelmill.functions.storage import scratch_folder, table
from labelmill.operators import counting, filters, matrix, rates
from labelmill.sources import annotation, sinks, tables, technology

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = f(spark, folder)
            return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])

        QUERIES[f.__name__], SQL[f.__name__] = run, sql
        return f

    return add


def _through(df: DataFrame, name: str, read: Callable[[SparkSession, str], DataFrame], sort: list[str] = ()) -> DataFrame:
    """df written as a CSV file and read by a reader of the pipeline."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    tables.write_csv(df, path, sort)
    return read(spark, path)


def _lines(df: DataFrame, name: str) -> str:
    path = scratch_folder(df.sparkSession, name)
    df.write.text(path)
    return path


_KIND = "velocity, transcriptome, score"
_CELLS = "nullif(barcode, 'NA') AS barcode, nullif(umi, 'NA') AS umi, gx"


@query(f"SELECT read_id, aln_index, {_CELLS}, {', '.join(BASE_COLUMNS)}, {_KIND} FROM alignments")
def csv_alignments(spark: SparkSession, folder: str) -> DataFrame:
    return _through(table(spark, folder, "alignments").select(tables.ALIGNMENTS.fieldNames()), "alignments", tables.read_alignments)


@query("SELECT read_id, aln_index, contig, genome_i, conversion, quality FROM conversions")
def csv_conversions(spark: SparkSession, folder: str) -> DataFrame:
    return _through(table(spark, folder, "conversions").select(tables.MISMATCHES.fieldNames()), "conversions", tables.read_conversions)


@query(f"SELECT {_CELLS}, {', '.join(N_COLUMNS)}, {', '.join(BASE_COLUMNS)}, {_KIND} FROM counts_tc")
def csv_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _through(table(spark, folder, "counts_tc").select(tables.COUNTS.fieldNames()), "counts", tables.read_counts)


@query("SELECT contig, genome_i, coverage FROM coverage WHERE genome_i IS NOT NULL AND coverage IS NOT NULL")
def csv_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return _through(table(spark, folder, "coverage").select(tables.COVERAGE.fieldNames()), "coverage", tables.read_coverage)


@query("SELECT contig, genome_i, conversion FROM snps")
def csv_snps(spark: SparkSession, folder: str) -> DataFrame:
    return _through(table(spark, folder, "snps").select(tables.SNPS.fieldNames()), "snps", tables.read_snps)


@query("SELECT contig, genome_i, conversion FROM snps")
def csv_known_snps(spark: SparkSession, folder: str) -> DataFrame:
    """A list with three columns holds conversions."""
    return _through(table(spark, folder, "snps").select("contig", "genome_i", "conversion"), "snps3", tables.read_snp_csv)


@query("SELECT DISTINCT contig, genome_i, c AS conversion FROM snps, (VALUES " + ", ".join(f"('{c}')" for c in CONVERSIONS) + ") v(c)")
def csv_known_positions(spark: SparkSession, folder: str) -> DataFrame:
    """A list with two columns holds positions that exclude all conversions."""
    return _through(table(spark, folder, "snps").select("contig", "genome_i"), "snps2", tables.read_snp_csv)


_RATES = ", ".join(f"round(sum({n_col(c)}) * 1.0 / nullif(sum({base_col(c[0])}), 0), 6) AS {rates.rate_col(c)}" for c in CONVERSIONS)


@query(f"SELECT nullif(barcode, 'NA') AS barcode, {_RATES} FROM counts_tc WHERE barcode IS NOT NULL GROUP BY ALL")
def csv_rates(spark: SparkSession, folder: str) -> DataFrame:
    own = rates.mutation_rates(table(spark, folder, "counts_tc").filter("barcode is not null"), ["barcode"])
    return _through(own, "rates", tables.read_rates, ["barcode"])


@query("SELECT nullif(barcode, 'NA') AS barcode, gx, n_tc AS conversion, base_t AS base, count(*) AS count FROM counts_tc GROUP BY counts_tc.barcode, gx, n_tc, base_t")
def csv_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _through(rates.aggregate_counts(table(spark, folder, "counts_tc"), ["TC"]), "histogram", tables.read_aggregates)


_SHARE = "count(*) FILTER (n_tc > 0) * 1.0 / count(*)"


@query(f"SELECT barcode, round({_SHARE}, 6) AS p_e FROM counts_tc WHERE barcode NOT IN ('NA') GROUP BY barcode")
def csv_values_by_cell(spark: SparkSession, folder: str) -> DataFrame:
    """One value for each key, sorted by key as they are written."""
    known = table(spark, folder, "counts_tc").filter("barcode <> 'NA'")
    own = known.groupBy("barcode").agg((F.count_if(F.col("n_tc") > 0) / F.count(F.lit(1))).alias("p_e"))
    return _through(own, "p_e", lambda s, p: tables.read_values(s, p, ["barcode"], ["p_e"]), ["barcode"])


@query(f"SELECT barcode, gx, CAST(count(*) AS DOUBLE) AS alpha, CAST(max(score) AS DOUBLE) AS beta, round({_SHARE}, 6) AS pi FROM counts_tc WHERE barcode NOT IN ('NA') AND gx IS NOT NULL GROUP BY ALL")
def csv_values_by_cell_gene(spark: SparkSession, folder: str) -> DataFrame:
    known = table(spark, folder, "counts_tc").filter("barcode <> 'NA' and gx is not null")
    n = F.count(F.lit(1))
    own = known.groupBy("barcode", "gx").agg(n.cast("double").alias("alpha"), F.max("score").cast("double").alias("beta"), (F.count_if(F.col("n_tc") > 0) / n).alias("pi"))
    return _through(own, "pi", lambda s, p: tables.read_values(s, p, ["barcode", "gx"], ["alpha", "beta", "pi"]), ["barcode", "gx"])


@query("SELECT round(avg(n_tc), 6) AS p_e FROM counts_tc")
def text_single_value(spark: SparkSession, folder: str) -> DataFrame:
    """A file that holds one bare number."""
    own = table(spark, folder, "counts_tc").agg(F.avg("n_tc").cast("string").alias("value"))
    return tables.read_values(spark, _lines(own, "p_e"), None, ["p_e"])


@query("SELECT DISTINCT trim(barcode) AS barcode FROM alignments WHERE trim(barcode) <> ''")
def text_barcodes(spark: SparkSession, folder: str) -> DataFrame:
    """One id a line, blank lines between them."""
    ids = table(spark, folder, "alignments").filter("barcode is not null").select(F.explode(F.array("barcode", F.lit(""), F.lit("  "))).alias("value"))
    return tables.read_list(spark, _lines(ids, "barcodes"))


_REAL = "SELECT DISTINCT barcode FROM counts_tc WHERE barcode NOT IN ('NA', '-')"


@query(f"SELECT barcode, 'g' || substr(barcode, 1, 1) AS \"group\" FROM ({_REAL})")
def csv_groups(spark: SparkSession, folder: str) -> DataFrame:
    cells = table(spark, folder, "counts_tc").filter(~F.col("barcode").isin("NA", "-")).select("barcode").distinct()
    lines = cells.select(F.explode(F.array(F.concat("barcode", F.lit(",g"), F.substring("barcode", 1, 1)), F.lit(""))).alias("value"))
    return tables.read_groups(spark, _lines(lines, "groups"))


@query(f"SELECT barcode AS cell, barcode || '_1.fq' AS fastq_1, CASE WHEN barcode < 'C' THEN NULL ELSE barcode || '_2.fq' END AS fastq_2 FROM ({_REAL})")
def csv_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A line for each cell of a plate; a hyphen where there is no second file."""
    cells = table(spark, folder, "counts_tc").filter(~F.col("barcode").isin("NA", "-")).select("barcode").distinct()
    second = F.when(F.col("barcode") < "C", "-").otherwise(F.concat("barcode", F.lit("_2.fq")))
    return tables.read_manifest(spark, _lines(cells.select(F.concat_ws(",", "barcode", F.concat("barcode", F.lit("_1.fq")), second).alias("value")), "manifest"))


# ---- annotation


def _gtf(spark: SparkSession, folder: str) -> str:
    """Two exons for each gene, a quarter of it at either end; a comment between them."""
    part = F.expr("(seg_end - seg_start) div 4")
    start, end = F.col("seg_start"), F.col("seg_end")
    name = F.when(F.col("gene_name").isNotNull(), F.concat(F.lit(' gene_name "'), "gene_name", F.lit('";'))).otherwise("")
    line = lambda a, b: F.concat_ws("\t", "contig", F.lit("s"), F.lit("exon"), (a + 1).cast("string"), b.cast("string"), F.lit("."), "strand", F.lit("."), F.concat(F.lit('gene_id "'), "gx", F.lit('"; transcript_id "t_'), "gx", F.lit('";'), name))
    lines = F.array(line(end - part, end), F.lit("#comment"), line(start, start + part))
    return _lines(table(spark, folder, "genes").select(F.explode(lines).alias("value")), "gtf")


@query("SELECT gx, contig, strand, seg_start, seg_end, gene_name FROM genes")
def gtf_genes(spark: SparkSession, folder: str) -> DataFrame:
    return annotation.read_gtf(spark, _gtf(spark, folder))[0]


@query("""SELECT gx, 't_' || gx AS transcript, seg_start AS exon_start, seg_start + (seg_end - seg_start) // 4 AS intron_start, seg_end - (seg_end - seg_start) // 4 AS intron_end, seg_end AS exon_end FROM genes""")
def gtf_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    _, found = annotation.read_gtf(spark, _gtf(spark, folder))
    at = lambda c, i, f: F.col(c)[i][f]
    return found.select("gx", "transcript", at("exons", 0, "start").alias("exon_start"), at("introns", 0, "start").alias("intron_start"), at("introns", 0, "end").alias("intron_end"), at("exons", 1, "end").alias("exon_end"))


@query("SELECT count(*) AS sequences, CAST(sum(32 + length(gx)) AS BIGINT) AS length FROM genes")
def fasta_size(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.array(F.concat(F.lit(">"), "gx"), F.md5("gx"), "gx")
    path = _lines(table(spark, folder, "genes").select(F.explode(lines).alias("value")), "fasta")
    return spark.createDataFrame([annotation.fasta_facts(spark, path)], "sequences long, length long")


@query("""SELECT n, l AS length, CAST(least(14, floor(log2(l) / 2 - 1)) AS INT) AS bases, CAST(least(18, floor(log2(l * 1.0 / n))) AS INT) AS bits FROM (SELECT row_number() OVER (ORDER BY gx) AS n, seg_end + 1000 AS l FROM genes)""")
def index_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Index parameters for genomes of many sizes."""
    from pyspark.sql import Window

    sizes = table(spark, folder, "genes").select(F.row_number().over(Window.orderBy("gx")).cast("long").alias("n"), (F.col("seg_end") + 1000).alias("l"))
    found = [(r["n"], r["l"], annotation.index_parameters(r["n"], r["l"], 1 << 40)) for r in sizes.collect()]  # genes are few
    return spark.createDataFrame([(n, x, p["genomeSAindexNbases"], p["genomeChrBinNbits"]) for n, x, p in found], "n long, length long, bases int, bits int")


@query("SELECT * FROM (VALUES ('Forward', 'forward'), ('Reverse', 'reverse'), ('Unstranded', 'unstranded'), ('Other', NULL)) v(written, strand)")
def strand_of_header(spark: SparkSession, folder: str) -> DataFrame:
    words = ["Forward", "Reverse", "Unstranded", "Other"]
    rows = [(w, technology.detect_strand(["@HD\tVN:1.4", f"@PG\tID:a\tPN:STAR\tCL:STAR --soloStrand {w} --x"])) for w in words]
    return spark.createDataFrame(rows, "written string, strand string")


# ---- sinks


@query("""WITH m AS (SELECT barcode, gx, count(*) AS value FROM counts_tc WHERE barcode IS NOT NULL AND gx IS NOT NULL GROUP BY ALL)
    SELECT CAST(dense_rank() OVER (ORDER BY barcode) AS BIGINT) AS "row", CAST(dense_rank() OVER (ORDER BY gx) AS BIGINT) AS "column", value FROM m""")
def matrix_market_file(spark: SparkSession, folder: str) -> DataFrame:
    """The entries of a MatrixMarket file that was written and read again."""
    known = table(spark, folder, "counts_tc").filter("barcode is not null and gx is not null")
    path = _lines(sinks.matrix_market(matrix.counts_matrix(known)), "mtx")
    entry = F.split("value", " ")
    entries = spark.read.text(path).filter(~F.col("value").startswith("%")).select(*[entry[i].cast("long").alias(c) for i, c in enumerate(("row", "column", "value"))])
    # The line of sizes is the greatest in all three numbers.
    sizes = F.struct("row", "column", "value")
    top = entries.agg(F.max("row").alias("r"), F.max("column").alias("c"), F.max("value").alias("v"))
    own = entries.select(sizes.alias("s")).join(F.broadcast(top), (F.col("s.row") == F.col("r")) & (F.col("s.column") == F.col("c")) & (F.col("s.value") == F.col("v")), "left_anti")
    return own.select("s.*")


@query("SELECT 'spliced' AS layer, barcode, gx, count(*) AS value FROM counts_tc WHERE velocity = 'spliced' AND barcode IS NOT NULL AND gx IS NOT NULL GROUP BY ALL UNION ALL SELECT 'unspliced', barcode, gx, count(*) FROM counts_tc WHERE velocity = 'unspliced' AND barcode IS NOT NULL AND gx IS NOT NULL GROUP BY ALL")
def matrix_files(spark: SparkSession, folder: str) -> DataFrame:
    """Layers as files, read again."""
    known = table(spark, folder, "counts_tc").filter("barcode is not null and gx is not null")
    layers = None
    for name, part in counting.split_by_velocity(known, ["spliced", "unspliced"]).items():
        one = matrix.counts_matrix(part).select(F.lit(name).alias("layer"), "barcode", "gx", "value")
        layers = one if layers is None else layers.unionByName(one)
    path = scratch_folder(spark, "matrix")
    sinks.write_matrix(layers, path)
    cells, genes = (spark.read.csv(f"{path}/{c}", schema=f"{c} string") for c in ("barcode", "gx"))
    # Every entry is on both axes.
    return spark.read.schema(layers.schema).parquet(f"{path}/layers").join(cells, "barcode", "left_semi").join(genes, "gx", "left_semi").select("layer", "barcode", "gx", "value")


@query("SELECT true AS versioned, true AS in_order, 'one,two' AS steps")
def run_record(spark: SparkSession, folder: str) -> DataFrame:
    """The record of a run as JSON, read again."""
    info = sinks.RunInfo()
    for step in ("one", "two"):
        with info.step(step):
            pass
    read = spark.createDataFrame([(info.text(),)], "value string").select(F.from_json("value", "version string, start_time timestamp, end_time timestamp, elapsed double, steps map<string,double>").alias("j"))
    return read.select((F.col("j.version") != "").alias("versioned"), ((F.col("j.end_time") >= F.col("j.start_time")) & (F.col("j.elapsed") >= 0)).alias("in_order"), F.array_join(F.array_sort(F.map_keys("j.steps")), ",").alias("steps"))


@query("SELECT read_id, barcode, umi, gx FROM alignments WHERE velocity IS NOT NULL AND gx IS NOT NULL AND (score * 37) % 2048 & 260 = 0 AND barcode IS NOT NULL")
def filter_consensus_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records that take part in a consensus: duplicates stay."""
    tags = F.map_filter(F.create_map(F.lit("CB"), F.col("barcode")), lambda k, v: v.isNotNull())
    rows = table(spark, folder, "alignments").withColumn("flag", F.col("score") * 37 % 2048).withColumn("tags", tags)
    return filters.assigned(filters.primary_alignments(rows, ["CB"], duplicates=True)).select("read_id", "barcode", "umi", "gx")
