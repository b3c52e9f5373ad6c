"""Text files of the pipeline with fixed schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from labelmill.functions.sequences import BASES, BASE_COLUMNS, CONVERSIONS, N_COLUMNS
from labelmill.operators.filters import require_unique
from labelmill.operators.rates import RATES, all_conversions

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_READ = [("read_id", _S), ("aln_index", _I)]
_CELL = [("barcode", _S), ("umi", _S), ("gx", _S)]
_KIND = [("velocity", _S), ("transcriptome", _B), ("score", _I)]
ALIGNMENTS = _schema(*_READ, *_CELL, *[(c, _I) for c in BASE_COLUMNS], *_KIND)
MISMATCHES = _schema(*_READ, ("contig", _S), ("genome_i", _L), ("conversion", _S), ("quality", _I))
COUNTS = _schema(*_CELL, *[(c, _I) for c in N_COLUMNS], *[(c, _I) for c in BASE_COLUMNS], *_KIND)
COVERAGE = _schema(("contig", _S), ("genome_i", _L), ("coverage", _I))
SNPS = _schema(("contig", _S), ("genome_i", _L), ("conversion", _S))
HISTOGRAM = _schema(("barcode", _S), ("gx", _S), ("conversion", _I), ("base", _I), ("count", _L))
#: Names in files that differ from the columns here.
FILE_NAMES = {"aln_index": "index", "gx": "GX"} | dict(zip(N_COLUMNS, CONVERSIONS)) | dict(zip(BASE_COLUMNS, BASES)) | dict(zip(RATES, CONVERSIONS))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Columns by position; empty fields are null, and so are `NA` barcodes and UMIs."""
    df = spark.read.csv(path, schema=schema, header=header, enforceSchema=True)
    return df.withColumns({c: F.nullif(F.col(c), F.lit("NA")) for c in ("barcode", "umi") if c in df.columns})


def read_alignments(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    df = read_csv(spark, path, ALIGNMENTS)
    return df if limit is None else df.limit(limit)


def read_conversions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, MISMATCHES)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, COUNTS)


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    """With or without a header line: rows whose numbers are none are left out."""
    return read_csv(spark, path, COVERAGE, header=False).filter("genome_i is not null and coverage is not null")


def read_snps(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, SNPS)


def read_snp_csv(spark: SparkSession, path: str) -> DataFrame:
    """Three columns: sites with a conversion.  Two, with or without header: sites that exclude all
    twelve.  Anything else is an error."""
    first = spark.read.text(path).limit(1).collect()
    width = len(first[0][0].split(",")) if first else 2
    if width == 3:
        return read_csv(spark, path, SNPS, header=False).filter("genome_i is not null")
    if width == 2:
        return all_conversions(read_csv(spark, path, _schema(("contig", _S), ("genome_i", _L)), header=False).filter("genome_i is not null"))
    raise ValueError(f"{path}: a list of SNPs has 2 or 3 columns, not {width}")


def read_rates(spark: SparkSession, path: str, by: list[str] = ("barcode",)) -> DataFrame:
    return read_csv(spark, path, _schema(*[(k, _S) for k in by], *[(c, _D) for c in RATES]))


def read_aggregates(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, HISTOGRAM)


def read_values(spark: SparkSession, path: str, by: list[str] | None, names: list[str]) -> DataFrame:
    """p_e, p_c, alpha or pi with their keys as strings; without keys the file is one bare number."""
    if by:
        return read_csv(spark, path, _schema(*[(k, _S) for k in by], *[(n, _D) for n in names]))
    return spark.read.text(path).select(F.trim("value").try_cast("double").alias(names[0])).filter(f"{names[0]} is not null")


def read_list(spark: SparkSession, path: str, name: str = "barcode") -> DataFrame:
    """One id a line; blank lines are skipped."""
    return spark.read.text(path).select(F.trim("value").alias(name)).filter(F.col(name) != "").distinct()


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """barcode,group without header; a barcode in two lines is an error."""
    df = read_csv(spark, path, _schema(("barcode", _S), ("group", _S)), header=False).filter("barcode is not null and group is not null")
    return require_unique(df, ["barcode"], path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """cell,first file,second file or `-`; a cell in two lines is an error."""
    df = read_csv(spark, path, _schema(("cell", _S), ("fastq_1", _S), ("fastq_2", _S)), header=False)
    return require_unique(df.withColumn("fastq_2", F.nullif("fastq_2", F.lit("-"))), ["cell"], path)


def write_csv(df: DataFrame, path: str, sort: list[str] = ()) -> None:
    """df with the names that files have; sorted by key where asked."""
    out = df.orderBy(*sort) if sort else df
    out.select(*[F.col(c).alias(FILE_NAMES.get(c, c)) for c in out.columns]).write.mode("overwrite").csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
