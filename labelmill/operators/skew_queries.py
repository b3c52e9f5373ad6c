"""Problem 3: totals per cell and per gene of counts_tc, where a few keys own most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelmill.functions.storage import table
from labelmill.operators.skew import balanced_totals, bucket_of, fragment_replicate_join, plan_loads

TOTALS = ["n_tc", "n_ag", "base_t", "base_a", "score"]
#: p3_found: share of all rows from which a value counts as hot.
HOT_SHARE = 0.02


def _keyed(counts: DataFrame, values: list[str]) -> DataFrame:
    """Each row once for its cell and once for its gene."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("key_value")) for f in ("barcode", "gx")]))
    return counts.select(pairs.alias("pair"), *values).select("pair.field_name", "pair.key_value", *values)


def totals(spark: SparkSession, folder: str) -> DataFrame:
    return balanced_totals(_keyed(table(spark, folder, "counts_tc"), TOTALS), ["field_name", "key_value"], TOTALS)


def found(spark: SparkSession, folder: str) -> DataFrame:
    """Only rows of buckets that may hold a hot key are totalled; the totals are exact."""
    keyed = _keyed(table(spark, folder, "counts_tc"), [])
    plan = plan_loads(keyed, ["field_name", "key_value"])
    bound = HOT_SHARE * (plan.total // 2)  # each row was counted once for either field
    # The loads of all buckets sum to two for each row, so no more than 2 / HOT_SHARE reach the bound.
    near = keyed.filter(bucket_of(plan.keys, len(plan.counts)).isin(plan.at_least(bound)) & F.col("key_value").isNotNull())
    return balanced_totals(near, plan.keys, [], plan=plan).filter(F.col("n_rows") >= bound).select("field_name", "key_value")


def gene_strand_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Label counts per gene on the gene's own strand; genes that are not annotated count as +.

    The joined rows are totalled where the join left them, shard by shard.
    """
    counts = table(spark, folder, "counts_tc").select("gx", "n_tc", "n_ag", "base_t", "base_a")
    genes = table(spark, folder, "genes").select("gx", "strand")
    minus = F.coalesce(F.col("strand") == "-", F.lit(False))
    joined = fragment_replicate_join(counts, genes, ["gx"], "left", ordered=True, task="task")
    own = joined.select("gx", "task", F.when(minus, F.col("n_ag")).otherwise(F.col("n_tc")).alias("conversion"), F.when(minus, F.col("base_a")).otherwise(F.col("base_t")).alias("base"))
    shards = own.groupBy("gx", "task").agg(F.count(F.lit(1)).alias("n"), F.sum("conversion").alias("conversion"), F.sum("base").alias("base"))
    return shards.groupBy("gx").agg(F.sum("n").alias("n_rows"), F.sum("conversion").alias("sum_conversion"), F.sum("base").alias("sum_base"))


QUERIES = {"p3_found": found, "p3_totals": totals, "p3_gene_strand_totals": gene_strand_totals}

_KEYED = "SELECT 'barcode' AS field_name, barcode AS key_value, * FROM counts_tc UNION ALL SELECT 'gx', gx, * FROM counts_tc"
SQL = {
    "p3_found": f"SELECT field_name, key_value FROM ({_KEYED}) WHERE key_value IS NOT NULL GROUP BY ALL HAVING count(*) >= 0.02 * (SELECT count(*) FROM counts_tc)",
    "p3_totals": f"SELECT field_name, key_value, count(*) AS n_rows, {', '.join(f'CAST(sum({c}) AS BIGINT) AS sum_{c}' for c in TOTALS)} FROM ({_KEYED}) GROUP BY ALL",
    "p3_gene_strand_totals": """SELECT c.gx, count(*) AS n_rows, CAST(sum(CASE WHEN g.strand = '-' THEN n_ag ELSE n_tc END) AS BIGINT) AS sum_conversion,
        CAST(sum(CASE WHEN g.strand = '-' THEN base_a ELSE base_t END) AS BIGINT) AS sum_base FROM counts_tc c LEFT JOIN genes g ON c.gx = g.gx GROUP BY c.gx""",
}
