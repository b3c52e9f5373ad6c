"""The queries of problems 1, 2 and 4 to 8, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelmill.functions.storage import table
from labelmill.llm.frequent import frequent_values
from labelmill.llm.mojibake import repair_texts
from labelmill.llm.packing import MAX_BUDGETS, pack, usage
from labelmill.llm.quantiles import combine, percentiles, sketches
from labelmill.llm.reservoir import fixed_size_sample, population, reservoir_states
from labelmill.llm.survivors import MARGIN, SUPPORT, best_representatives
from labelmill.llm.transducer import check_round_trip, count_tokens, encode_texts

SAMPLE_SIZE = 25_000
SITE = ["contig", "genome_i", "conversion"]
SITE_SHARE = 0.002
#: Counters of the summary of sites: counts are too low by at most 1/4001 of all rows.
SITE_COUNTERS = 4000


P1_COLUMNS = ["read_id", "piece", "barcode", "umi", "gx"]


def p1_sample(spark: SparkSession, folder: str) -> DataFrame:
    return fixed_size_sample(table(spark, folder, "counts_tc").select(*P1_COLUMNS), SAMPLE_SIZE, seed=20)


def p1_size(spark: SparkSession, folder: str) -> DataFrame:
    """Rows counted while sampling, rows of the sample, and how many of these the table does not
    hold as often as the sample does."""
    rows = table(spark, folder, "counts_tc").select(*P1_COLUMNS)
    counted = population(reservoir_states(rows, SAMPLE_SIZE, seed=20))
    times = lambda df, name: df.groupBy(*P1_COLUMNS).agg(F.count(F.lit(1)).alias(name))
    drawn = times(fixed_size_sample(rows, SAMPLE_SIZE, seed=20), "drawn")
    # The sample is of fixed size, so only that many rows of the table are counted by value.
    known = times(rows.join(F.broadcast(drawn.select("read_id").distinct()), "read_id", "left_semi"), "there")
    same = [drawn[c].eqNullSafe(known[c]) for c in P1_COLUMNS]
    odd = drawn.join(known, same, "left").agg(F.sum("drawn").alias("n_sampled"), F.count_if(F.coalesce(F.col("there"), F.lit(0)) < F.col("drawn")).alias("n_strange"))
    return counted.crossJoin(odd)  # one row each


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """The sites that the summary cannot rule out, then their exact counts."""
    rows = table(spark, folder, "conversions").select(*SITE)
    likely = frequent_values(rows, SITE, SITE_COUNTERS, SITE_SHARE).select(*SITE, F.col("all_rows").alias("of_rows"))
    # At most SITE_COUNTERS rows, whatever the input.
    exact = rows.join(F.broadcast(likely), SITE).groupBy(*SITE, "of_rows").agg(F.count(F.lit(1)).alias("n"))
    return exact.filter(F.col("n") >= SITE_SHARE * F.col("of_rows")).select(*SITE)


def p2_frequent_sites(spark: SparkSession, folder: str) -> DataFrame:
    """All sites with a counter, with both bounds of their number of rows."""
    return frequent_values(table(spark, folder, "conversions"), SITE, SITE_COUNTERS)


def p2_within_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Every site of more rows than the counters leave room for: its exact number of rows, and
    whether it has a counter and both bounds hold."""
    rows = table(spark, folder, "conversions").select(*SITE)
    total = rows.agg(F.count(F.lit(1)).alias("all_rows"))
    exact = rows.dropna().groupBy(*SITE).agg(F.count(F.lit(1)).alias("n_rows"))
    heavy = exact.join(F.broadcast(total), F.col("n_rows") * (SITE_COUNTERS + 1) > F.col("all_rows")).select(*SITE, "n_rows")  # one row
    bounds = frequent_values(rows, SITE, SITE_COUNTERS).drop("all_rows")
    held = F.coalesce(F.col("n_rows").between(F.col("rows_at_least"), F.col("rows_at_most")), F.lit(False))
    return heavy.join(bounds, SITE, "left").select(*SITE, "n_rows", held.alias("within"))


#: table, value, group.
P4_FIELDS = (("conversions", "quality", "contig"), ("coverage", "coverage", "contig"), ("alignments", "score", "run_day"))
P4_QS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


def _states(spark: SparkSession, folder: str) -> DataFrame:
    first, *rest = [sketches(table(spark, folder, t), v, F.col(g), F.col(v)) for t, v, g in P4_FIELDS]
    for other in rest:
        first = first.unionByName(other)
    return combine(first)


#: field, percentile, bound, and whether the groups below the bound or those from it on are wanted.
P4_CASES = (("quality", 0.5, 27.0, True), ("coverage", 0.9, 50.0, False), ("score", 0.1, 20.0, True))


def p4_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return percentiles(_states(spark, folder), P4_QS)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Groups whose percentile, read from the combined sketches, is on the wanted side of its bound."""
    wanted = F.lit(False)
    for field, q, bound, below in P4_CASES:
        wanted = wanted | ((F.col("field_name") == field) & (F.col("q") == q) & ((F.col("value") < bound) if below else (F.col("value") >= bound)))
    read = percentiles(_states(spark, folder), sorted({q for _, q, _, _ in P4_CASES}))
    return read.filter(wanted).select("field_name", "group_value")


def p4_within_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """For every group and percentile the exact number of values, and whether the rank wanted lies
    between the ranks of value_low and value_high.  Rows are counted by value before they meet the
    bounds."""
    out = None
    for name, value, group in P4_FIELDS:
        rows = table(spark, folder, name)
        read = percentiles(combine(sketches(rows, value, F.col(group), F.col(value))), P4_QS)
        counted = rows.groupBy(F.col(group).cast("string").alias("group_value"), F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c")).dropna()
        total = lambda c, n: F.sum(F.when(c, F.col("c")).otherwise(0)).alias(n)
        sides = read.join(counted, "group_value").groupBy("field_name", "group_value", "q", "n_values").agg(F.sum("c").alias("n"), total(F.col("v") < F.col("value_low"), "under"), total(F.col("v") <= F.col("value_high"), "upto"))
        rank = F.col("q") * F.col("n")
        part = sides.select("field_name", "group_value", "q", F.col("n").alias("n_values"), ((F.col("n") == F.col("n_values")) & (F.col("under") <= rank) & (F.col("upto") >= rank)).alias("within"))
        out = part if out is None else out.unionByName(part)
    return out


def _clean(name: str, suffix: bool = False) -> Column:
    text = F.upper(F.trim(F.col(name)))
    if suffix:
        text = F.regexp_replace(text, "-[0-9]+$", "")
    return F.when(~text.isin("NA", "-"), text)


#: Fields that a survivor takes from its companions where it lacks them, and those filled by precedence.
P5_FILL, P5_CATEGORIES = ["velocity", "transcriptome", "score"], ["velocity", "transcriptome"]
P5_KEPT = ["read_id", "aln_index", "base_a", "base_c", "base_g", "base_t", "run_day", "piece", "loaded_at"]


def _molecules(spark: SparkSession, folder: str, keep: list[str], fill: list[str]) -> DataFrame:
    # No negated score or moment is as great as the greatest long, which stands for nulls.
    late = lambda c: F.coalesce(-c.cast("long"), F.lit(2**63 - 1))
    order = [
        F.when(F.col("transcriptome"), 0).when(~F.col("transcriptome"), 1).otherwise(2),
        late(F.col("score")),
        F.col("velocity").isNull(),
        late(F.unix_micros(F.col("loaded_at").cast("timestamp"))),
        "read_id",
        "aln_index",
    ]
    keys = {"barcode": _clean("barcode", suffix=True), "umi": _clean("umi"), "gx": F.when(~F.col("gx").isin("NA", "-"), F.col("gx"))}
    return best_representatives(table(spark, folder, "alignments"), keys, order, keep, fill, P5_CATEGORIES, "loaded_at", least=2)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The survivors of the whole reduction, gaps filled.

    Their order is complete, so what is filled changes none of the columns asked for, and Spark
    would leave it out.  It is made and looked at here: a gap that companions could fill and that
    is still open is an error.
    """
    rows = _molecules(spark, folder, ["read_id", "aln_index"], P5_FILL)
    left_open = F.array_compact(F.array(*[F.when(F.array_contains("filled", f) & F.col(f).isNull(), F.lit(f)) for f in P5_FILL]))
    whole = F.when(F.size(left_open) == 0, True).otherwise(F.raise_error(F.concat(F.lit("not filled: "), F.array_join(left_open, ","))).cast("boolean"))
    return rows.filter(whole).select("barcode", "umi", "gx", "read_id", "aln_index")


def p5_survivors(spark: SparkSession, folder: str) -> DataFrame:
    """The survivors with all their fields, gaps filled."""
    return _molecules(spark, folder, P5_KEPT, P5_FILL).withColumn("filled", F.array_join("filled", ","))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_texts(table(spark, folder, "documents"), "text", ["doc_id"])


def p6_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return check_round_trip(table(spark, folder, "documents"), "text", ["doc_id"])


def p7_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    # packing_budgets has four rows; more than MAX_BUDGETS are refused.
    budgets = [(r["budget_id"], r["capacity_tokens"]) for r in table(spark, folder, "packing_budgets").limit(MAX_BUDGETS + 1).collect()]
    return pack(count_tokens(documents, "text", ["doc_id"]), "n_tokens", ["doc_id"], budgets, n_items=documents.count())


def p7_usage(spark: SparkSession, folder: str) -> DataFrame:
    return usage(p7_packing(spark, folder))


def p7_intact(spark: SparkSession, folder: str) -> DataFrame:
    """For each budget: documents and tokens that came through, containers beyond their capacity,
    documents that are split though they fit a container, and documents whose parts do not make
    up the whole."""
    packed = p7_packing(spark, folder)
    sizes = count_tokens(table(spark, folder, "documents"), "text", ["doc_id"], name="whole")
    over = packed.groupBy("budget_id", "capacity", "container_id").agg(F.sum("n_tokens").alias("n")).groupBy("budget_id").agg(F.count_if(F.col("n") > F.col("capacity")).alias("n_overfull"))
    each = packed.groupBy("budget_id", "capacity", "doc_id").agg(F.count(F.lit(1)).alias("parts"), F.sum("n_tokens").alias("n")).join(sizes, "doc_id", "full")
    by = each.groupBy("budget_id", "capacity").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if((F.col("whole") <= F.col("capacity")) & (F.col("parts") > 1)).alias("n_split"),
        F.count_if(~F.col("n").eqNullSafe(F.col("whole"))).alias("n_incomplete"),
    )
    return by.join(over, "budget_id").select("budget_id", "capacity", "n_documents", "n_overfull", "n_split", "n_incomplete")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return repair_texts(table(spark, folder, "documents"), "text", ["doc_id"]).filter("garbled").select("doc_id")


def p8_restored(spark: SparkSession, folder: str) -> DataFrame:
    """Garbled documents with what could be restored."""
    return repair_texts(table(spark, folder, "documents"), "text", ["doc_id"]).filter("garbled").select("doc_id", "restored", "complete")


QUERIES = {
    "p1_sample": p1_sample,
    "p1_size": p1_size,
    "p2_found": p2_found,
    "p2_frequent_sites": p2_frequent_sites,
    "p2_within_bounds": p2_within_bounds,
    "p4_found": p4_found,
    "p4_percentiles": p4_percentiles,
    "p4_within_bounds": p4_within_bounds,
    "p5_found": p5_found,
    "p5_survivors": p5_survivors,
    "p6_ids": p6_ids,
    "p6_round_trip": p6_round_trip,
    "p7_packing": p7_packing,
    "p7_usage": p7_usage,
    "p7_intact": p7_intact,
    "p8_found": p8_found,
    "p8_restored": p8_restored,
}

_BARCODE = "regexp_replace(upper(trim(barcode)), '-[0-9]+$', '')"
#: The rows of all molecules, cleaned, with the size of their molecule and their place in it.
_RANKED = f"""m AS (SELECT * REPLACE ({_BARCODE} AS barcode, upper(trim(umi)) AS umi) FROM alignments),
    r AS (SELECT *, count(*) OVER (PARTITION BY barcode, umi, gx) AS n, row_number() OVER (PARTITION BY barcode, umi, gx ORDER BY
        CASE WHEN transcriptome THEN 0 WHEN NOT transcriptome THEN 1 ELSE 2 END, score DESC NULLS LAST, velocity IS NULL, loaded_at DESC NULLS LAST, read_id, aln_index, base_a, base_c, base_g, base_t, run_day, piece) AS k
        FROM m WHERE barcode NOT IN ('NA', '-') AND umi NOT IN ('NA', '-') AND gx NOT IN ('NA', '-') AND barcode IS NOT NULL AND umi IS NOT NULL AND gx IS NOT NULL)"""
SQL = {
    "p1_size": f"SELECT count(*) AS n_rows, least(count(*), {SAMPLE_SIZE}) AS n_sampled, CAST(0 AS BIGINT) AS n_strange FROM counts_tc",
    "p2_within_bounds": f"""SELECT contig, genome_i, conversion, count(*) AS n_rows, true AS within FROM conversions WHERE contig IS NOT NULL AND genome_i IS NOT NULL AND conversion IS NOT NULL
        GROUP BY ALL HAVING count(*) * {SITE_COUNTERS + 1} > (SELECT count(*) FROM conversions)""",
    "p4_within_bounds": " UNION ALL ".join(
        f"SELECT '{v}' AS field_name, CAST({g} AS VARCHAR) AS group_value, CAST({q} AS DOUBLE) AS q, count(*) AS n_values, true AS within FROM {t} WHERE {g} IS NOT NULL AND {v} IS NOT NULL GROUP BY {g}"
        for t, v, g in P4_FIELDS for q in P4_QS
    ),
    "p7_intact": """SELECT CAST(budget_id AS BIGINT) AS budget_id, CAST(capacity_tokens AS BIGINT) AS capacity, (SELECT count(*) FROM documents) AS n_documents,
        CAST(0 AS BIGINT) AS n_overfull, CAST(0 AS BIGINT) AS n_split, CAST(0 AS BIGINT) AS n_incomplete FROM packing_budgets WHERE capacity_tokens > 0""",
    "p6_round_trip": "SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, true AS same FROM documents",
    "p2_found": """SELECT contig, genome_i, conversion FROM conversions WHERE contig IS NOT NULL AND genome_i IS NOT NULL AND conversion IS NOT NULL
        GROUP BY ALL HAVING count(*) >= 0.002 * (SELECT count(*) FROM conversions)""",
    "p4_found": """SELECT 'quality' AS field_name, contig AS group_value FROM conversions WHERE contig IS NOT NULL AND quality IS NOT NULL GROUP BY contig HAVING quantile_cont(quality, 0.5) < 27
        UNION ALL SELECT 'coverage', contig FROM coverage WHERE contig IS NOT NULL AND coverage IS NOT NULL GROUP BY contig HAVING quantile_cont(coverage, 0.9) >= 50
        UNION ALL SELECT 'score', CAST(run_day AS VARCHAR) FROM alignments WHERE run_day IS NOT NULL AND score IS NOT NULL GROUP BY run_day HAVING quantile_cont(score, 0.1) < 20""",
    "p5_found": f"WITH {_RANKED} SELECT barcode, umi, gx, read_id, aln_index FROM r WHERE k = 1 AND n >= 2",
    "p5_survivors": f"""WITH RECURSIVE {_RANKED},
        dated AS ({" UNION ALL ".join(f"SELECT barcode, umi, gx, '{f}' AS field, CAST({f} AS VARCHAR) AS v, min(loaded_at) AS t FROM r WHERE loaded_at IS NOT NULL AND {f} IS NOT NULL GROUP BY ALL" for f in P5_CATEGORIES)}),
        moved AS (SELECT field, a, v AS b FROM (SELECT *, lag(v) OVER w AS a, lag(t) OVER w AS s FROM dated WINDOW w AS (PARTITION BY barcode, umi, gx, field ORDER BY t, v)) WHERE s < t),
        counted AS (SELECT field, least(a, b) AS a, greatest(a, b) AS b, count(*) FILTER (a < b) AS there, count(*) FILTER (a > b) AS back FROM moved GROUP BY ALL),
        pairs AS (SELECT field, CASE WHEN there > back THEN a ELSE b END AS a, CASE WHEN there > back THEN b ELSE a END AS b FROM counted
            WHERE there + back >= {SUPPORT} AND greatest(there, back) >= {MARGIN} * least(there, back)),
        reach AS (SELECT field, a, b FROM pairs UNION SELECT r.field, r.a, p.b FROM reach r JOIN pairs p ON r.field = p.field AND r.b = p.a),
        prec AS (SELECT * FROM reach x WHERE NOT EXISTS (SELECT 1 FROM reach y WHERE y.field = x.field AND y.a = x.b AND y.b = x.a)),
        node AS (SELECT DISTINCT field, v, (SELECT count(*) FROM prec p WHERE p.field = n.field AND p.b = n.v) AS depth FROM (SELECT field, a AS v FROM pairs UNION SELECT field, b FROM pairs) n),
        facts AS ({" UNION ALL ".join(f"""SELECT barcode, umi, gx, '{f}' AS field, CAST({f} AS VARCHAR) AS v, loaded_at AS t, CAST(coalesce(TRY_CAST(CAST({f} AS VARCHAR) AS INT), 0) AS INT) AS i FROM r WHERE n >= 2 AND {f} IS NOT NULL""" for f in P5_FILL)}),
        newest AS (SELECT barcode, umi, gx, field, v FROM (SELECT *, row_number() OVER (PARTITION BY barcode, umi, gx, field ORDER BY t DESC, i DESC, v DESC) AS q FROM facts WHERE t IS NOT NULL) WHERE q = 1),
        greatest_undated AS (SELECT barcode, umi, gx, field, v FROM (SELECT *, row_number() OVER (PARTITION BY barcode, umi, gx, field ORDER BY i DESC, v DESC) AS q FROM facts WHERE t IS NULL) WHERE q = 1),
        latest AS (SELECT barcode, umi, gx, field, v FROM (SELECT f.barcode, f.umi, f.gx, f.field, f.v, row_number() OVER (PARTITION BY f.barcode, f.umi, f.gx, f.field ORDER BY d.depth DESC, f.v DESC) AS q
            FROM facts f JOIN node d ON d.field = f.field AND d.v = f.v LEFT JOIN newest l ON l.barcode = f.barcode AND l.umi = f.umi AND l.gx = f.gx AND l.field = f.field
            WHERE f.t IS NULL AND (l.v IS NULL OR EXISTS (SELECT 1 FROM prec p WHERE p.field = f.field AND p.a = l.v AND p.b = f.v))) WHERE q = 1),
        given AS (SELECT barcode, umi, gx, field, v, rank FROM (SELECT *, row_number() OVER (PARTITION BY barcode, umi, gx, field ORDER BY rank) AS q FROM
            (SELECT *, 1 AS rank FROM latest UNION ALL SELECT *, 2 FROM newest UNION ALL SELECT *, 3 FROM greatest_undated)) WHERE q = 1)
        SELECT s.barcode, s.umi, s.gx, {", ".join(P5_KEPT)}, {", ".join(f"coalesce({f}, CAST(g_{f}.v AS {t})) AS {f}" for f, t in zip(P5_FILL, ("VARCHAR", "BOOLEAN", "INT")))}, n AS n_rows,
        concat_ws(',', {", ".join(f"CASE WHEN {f} IS NULL AND g_{f}.v IS NOT NULL THEN '{f}' END" for f in P5_FILL)}) AS filled
        FROM (SELECT * FROM r WHERE k = 1 AND n >= 2) s {" ".join(f"LEFT JOIN given g_{f} ON g_{f}.field = '{f}' AND g_{f}.barcode = s.barcode AND g_{f}.umi = s.umi AND g_{f}.gx = s.gx" for f in P5_FILL)}""",
}
