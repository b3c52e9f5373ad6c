"""Queries over the test tables for every relational operator, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelmill.functions.sequences import BASE_COLUMNS, BASES, CONVERSIONS, N_COLUMNS, base_col, complement, complement_of, content, n_col, total
from labelmill.functions.stats import beta_mean, beta_mode, binomial_pmf_col, clip, guess_beta
from labelmill.functions.storage import scratch_folder, table
from labelmill.operators import counting, filters, intervals, matrix, rates, sample, votes
from labelmill.streaming import counts as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

LABELS = [["TC"]]
TWO_LABELS = [["TC"], ["GA", "AG"]]


class Tables:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    def mismatches(self) -> DataFrame:
        """Mismatches without repeated deliveries."""
        return self.conversions.groupBy(*MISMATCH).agg(F.max("quality").alias("quality"))

    def groups(self) -> DataFrame:
        """A group for each real barcode, by its first letter."""
        real = self.counts_tc.filter(~F.col("barcode").isin("NA", "-")).select("barcode").distinct()
        return real.withColumn("group", F.concat(F.lit("g"), F.substring("barcode", 1, 1)))

    def spans(self) -> DataFrame:
        """Reads as the span of their mismatches on a contig."""
        return self.conversions.filter("contig is not null and genome_i is not null").groupBy("read_id", "aln_index", "contig").agg(F.min("genome_i").alias("start"), (F.max("genome_i") + 1).alias("end"), F.lit(None).cast("string").alias("strand"))


MISMATCH = ["read_id", "aln_index", "contig", "genome_i", "conversion"]


def query(sql: str | None) -> Callable:
    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = f(Tables(spark, folder))
            return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])

        QUERIES[f.__name__] = run
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _counts(alias: str = "", table_: str = "") -> str:
    return ", ".join(f"{alias}{c}" for c in N_COLUMNS)


_M = f"SELECT {', '.join(MISMATCH)}, max(quality) AS quality FROM conversions GROUP BY ALL"
_GOOD = f"SELECT * FROM ({_M}) m WHERE quality > 27 AND NOT EXISTS (SELECT 1 FROM snps s WHERE s.contig = m.contig AND s.genome_i = m.genome_i AND s.conversion = m.conversion)"
_PIVOT = ", ".join(f"count(*) FILTER (conversion = '{c}') AS {n_col(c)}" for c in CONVERSIONS)
_ALIGN = ["read_id", "aln_index", "barcode", "umi", "gx", *BASE_COLUMNS, "velocity", "transcriptome", "score"]


def _filled(prefix: str) -> str:
    return ", ".join(f"coalesce({prefix}{c}, 0) AS {c}" for c in N_COLUMNS)


def _swapped(columns: list[str]) -> str:
    pair = {n_col(c): n_col(complement(c)) for c in CONVERSIONS} | {base_col(b): base_col(complement(b)) for b in BASES}
    return ", ".join(f"CASE WHEN g.strand = '-' THEN c.{pair[c]} ELSE c.{c} END AS {c}" if c in pair else f"c.{c}" for c in columns)


_COUNTED = f"SELECT {', '.join('a.' + c for c in _ALIGN)}, {_filled('p.')} FROM alignments a LEFT JOIN (SELECT read_id, aln_index, {_PIVOT} FROM ({_GOOD}) GROUP BY ALL) p ON a.read_id = p.read_id AND a.aln_index = p.aln_index"
_TOTAL = " + ".join(N_COLUMNS)


def _dedup_sql(source: str, keys: list[str], order: list[str], columns: list[str]) -> str:
    rest = [c for c in columns if c not in keys]
    ranked = ", ".join(f"{o} DESC NULLS LAST" for o in [*order, *rest])
    return f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ranked}) AS rn FROM ({source})) WHERE rn = 1"


_C_COLUMNS = ["read_id", "barcode", "umi", "gx", *N_COLUMNS, *BASE_COLUMNS, "velocity", "transcriptome", "score"]
_T = "coalesce(transcriptome, false)"


def _c(t: Tables) -> DataFrame:
    return t.counts_tc.select(*_C_COLUMNS)


_C = f"SELECT {', '.join(_C_COLUMNS)} FROM counts_tc"
_COMPLEMENTED = f"SELECT {_swapped(_C_COLUMNS)} FROM counts_tc c LEFT JOIN genes g ON c.gx = g.gx"
_SPANS = "SELECT read_id, aln_index, contig, min(genome_i) AS start, max(genome_i) + 1 AS \"end\" FROM conversions WHERE contig IS NOT NULL AND genome_i IS NOT NULL GROUP BY ALL"
_GROUPS = "SELECT DISTINCT barcode, 'g' || substr(barcode, 1, 1) AS \"group\" FROM counts_tc WHERE barcode NOT IN ('NA', '-')"


# ---- counting


@query(f"""WITH counted AS ({_COUNTED}), stranded AS (SELECT {_swapped([*_ALIGN, *N_COLUMNS])} FROM counted c LEFT JOIN genes g ON c.gx = g.gx),
    one AS ({_dedup_sql('SELECT * FROM stranded', ['barcode', 'umi', 'gx'], ['n_tc > 0', _T, 'score', 'n_tc', 'read_id'], [*_ALIGN, *N_COLUMNS])})
    SELECT barcode, gx, count(*) FILTER (n_tc = 0) AS unlabeled, count(*) FILTER (n_tc > 0) AS labeled FROM one GROUP BY ALL""")
def flagship_labeled_matrix(t: Tables) -> DataFrame:
    counted = counting.count_conversions(t.alignments.select(*_ALIGN), counting.distinct_mismatches(t.conversions), t.snps)
    stranded = counting.complement_counts(counted.select(*_ALIGN, *N_COLUMNS), t.genes)
    return matrix.split_counts(counting.deduplicate_counts(stranded, ["TC"]), ["TC"])


@query(_COUNTED)
def conversion_counts(t: Tables) -> DataFrame:
    return counting.count_conversions(t.alignments.select(*_ALIGN), counting.distinct_mismatches(t.conversions), t.snps)


@query(f"SELECT a.* FROM alignments a WHERE NOT EXISTS (SELECT 1 FROM ({_M}) m WHERE quality > 27 AND m.read_id = a.read_id AND m.aln_index = a.aln_index)")
def reads_without_mismatch(t: Tables) -> DataFrame:
    return counting.reads_without_mismatch(t.alignments, counting.distinct_mismatches(t.conversions))


@query("SELECT * FROM conversions m WHERE NOT EXISTS (SELECT 1 FROM snps s WHERE s.contig = m.contig AND s.genome_i = m.genome_i AND s.conversion = m.conversion)")
def snp_anti_join(t: Tables) -> DataFrame:
    return counting.without_snps(t.conversions, t.snps)


_SELECTED = _dedup_sql("SELECT barcode, umi, gx, read_id, aln_index, transcriptome, score FROM alignments", ["barcode", "umi", "gx"], [_T, "score", "read_id", "aln_index"], ["barcode", "umi", "gx", "read_id", "aln_index"])


@query(f"SELECT m.* FROM conversions m WHERE EXISTS (SELECT 1 FROM ({_SELECTED}) s WHERE s.read_id = m.read_id AND s.aln_index = m.aln_index)")
def conversions_of_selected(t: Tables) -> DataFrame:
    return counting.only_selected(t.conversions, counting.select_alignments(t.alignments))


@query(f"SELECT read_id, aln_index FROM ({_SELECTED})")
def select_alignments_umi(t: Tables) -> DataFrame:
    return counting.select_alignments(t.alignments)


@query(f"""SELECT read_id, aln_index FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY {_T} DESC, score DESC NULLS LAST, aln_index DESC) AS rn,
    bool_or({_T}) OVER (PARTITION BY read_id) AS any_t, min(gx) OVER (PARTITION BY read_id) AS lo, max(gx) OVER (PARTITION BY read_id) AS hi FROM alignments)
    WHERE rn = 1 AND (any_t OR coalesce(lo = hi, true))""")
def select_alignments_reads(t: Tables) -> DataFrame:
    return counting.select_alignments(t.alignments, umis=False)


@query(_COMPLEMENTED)
def complement_counts(t: Tables) -> DataFrame:
    return counting.complement_counts(_c(t), t.genes)


@query(_C)
def complement_involution(t: Tables) -> DataFrame:
    return counting.complement_counts(counting.complement_counts(_c(t), t.genes), t.genes)


@query(_dedup_sql(_C, ["barcode", "umi", "gx"], ["n_tc > 0", _T, "score", "n_tc", "read_id"], _C_COLUMNS))
def dedup_conversion_mode(t: Tables) -> DataFrame:
    return counting.deduplicate_counts(_c(t), ["TC"])


@query(_dedup_sql(_C, ["barcode", "umi", "gx"], [_T, "score", _TOTAL, "read_id"], _C_COLUMNS))
def dedup_exon_mode(t: Tables) -> DataFrame:
    return counting.deduplicate_counts(_c(t), None, use_conversions=False)


_MULTI = [c for c in _C_COLUMNS if c not in ("read_id", "velocity")]


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY {', '.join(f'{o} DESC NULLS LAST' for o in [_T, 'score', _TOTAL, 'gx', 'velocity', *[c for c in _C_COLUMNS if c != 'read_id']])}) AS rn,
    NOT bool_or({_T}) OVER w AS none, coalesce(min(gx) OVER w <> max(gx) OVER w, false) AS genes_differ, coalesce(min(velocity) OVER w <> max(velocity) OVER w, false) AS velocities_differ FROM counts_tc WINDOW w AS (PARTITION BY read_id))
    SELECT read_id, {', '.join(_MULTI)}, CASE WHEN none AND velocities_differ THEN 'ambiguous' ELSE velocity END AS velocity FROM r WHERE rn = 1 AND NOT (none AND genes_differ)""")
def drop_multimappers(t: Tables) -> DataFrame:
    return counting.drop_multimappers(_c(t))


# ---- filters


@query(f"SELECT * FROM conversions WHERE quality > 27 AND conversion IN ('TC', 'AG')")
def filter_quality(t: Tables) -> DataFrame:
    return filters.mismatches(t.conversions, ["TC"])


@query("SELECT * FROM counts_tc WHERE barcode <> '-' AND barcode IN (SELECT barcode FROM counts_tc WHERE n_tc > 0)")
def filter_barcode_semi(t: Tables) -> DataFrame:
    return filters.known_barcodes(t.counts_tc, t.counts_tc.filter("n_tc > 0").select("barcode").distinct())


@query("SELECT * FROM (SELECT *, (score * 37) % 2048 AS flag FROM alignments) WHERE (flag & 1284) = 0 AND barcode IS NOT NULL AND umi IS NOT NULL")
def filter_flags(t: Tables) -> DataFrame:
    tags = F.map_filter(F.create_map(F.lit("CB"), F.col("barcode"), F.lit("UB"), F.col("umi")), lambda k, v: v.isNotNull())
    rows = t.alignments.withColumn("flag", F.col("score") * 37 % 2048).withColumn("tags", tags)
    return filters.primary_alignments(rows, filters.required_tags("UB", "CB", "GX", True)).drop("tags")


@query("SELECT * FROM (SELECT *, (score * 37) % 2048 AS flag FROM alignments) WHERE (flag & 1) = 0 OR (flag & 2) <> 0")
def filter_proper_pairs(t: Tables) -> DataFrame:
    return filters.proper_pairs(t.alignments.withColumn("flag", F.col("score") * 37 % 2048))


@query("SELECT * FROM alignments WHERE gx <> '' AND velocity IS NOT NULL")
def filter_assigned(t: Tables) -> DataFrame:
    return filters.assigned(t.alignments)


@query("SELECT 'total' AS read_group, count(*) AS n FROM counts_tc UNION ALL SELECT 'transcriptome', count(*) FROM counts_tc WHERE transcriptome UNION ALL SELECT velocity, count(*) FROM counts_tc WHERE velocity IN ('spliced', 'unspliced') GROUP BY velocity")
def read_groups(t: Tables) -> DataFrame:
    parts = [filters.read_group(t.counts_tc, g).agg(F.count(F.lit(1)).alias("n")).select(F.lit(g).alias("read_group"), "n") for g in filters.READ_GROUPS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("SELECT velocity, count(*) AS n, count(*) FILTER (n_tc > 0) AS labeled FROM counts_tc WHERE velocity NOT IN ('unassigned', 'ambiguous') GROUP BY velocity")
def velocity_blacklist(t: Tables) -> DataFrame:
    return filters.usable_velocity(t.counts_tc).groupBy("velocity").agg(F.count(F.lit(1)).alias("n"), F.count_if(filters.is_labeled(["TC"])).alias("labeled"))


@query("SELECT barcode, count(*) FILTER (n_tc = 0) AS unlabeled, count(*) FILTER (n_tc > 0) AS labeled FROM counts_tc WHERE n_ag = 0 AND n_ga = 0 GROUP BY barcode")
def exclusive_label(t: Tables) -> DataFrame:
    labeled = filters.is_labeled(["TC"])
    return filters.exclusive_to(t.counts_tc, ["TC"], TWO_LABELS).groupBy("barcode").agg(F.count_if(~labeled).alias("unlabeled"), F.count_if(labeled).alias("labeled"))


@query("SELECT * FROM counts_tc WHERE gx IN (SELECT gx FROM genes WHERE strand = '-')")
def gene_filter(t: Tables) -> DataFrame:
    return filters.of_genes(t.counts_tc, t.genes.filter("strand = '-'").select("gx"))


@query(f"SELECT c.barcode, c.gx, c.n_tc, g.\"group\" FROM counts_tc c JOIN ({_GROUPS}) g ON c.barcode = g.barcode")
def group_filter(t: Tables) -> DataFrame:
    return filters.in_groups(t.counts_tc.select("barcode", "gx", "n_tc"), t.groups())


@query("""SELECT bool_or(transcriptome) AS any_transcriptome, bool_and(transcriptome) AS all_transcriptome, bool_and(barcode IS NOT NULL AND barcode NOT IN ('NA', '-')) AS all_barcodes,
    bool_and(umi IS NOT NULL AND umi NOT IN ('NA', '-')) AS all_umis, string_agg(DISTINCT velocity, ',' ORDER BY velocity) AS velocities, count(DISTINCT barcode) AS n_cells, count(DISTINCT gx) AS n_genes FROM counts_tc""")
def exists_flags(t: Tables) -> DataFrame:
    return filters.table_facts(t.counts_tc)


@query("SELECT read_id, aln_index, count(*) AS n_rows FROM alignments GROUP BY ALL HAVING count(*) > 1")
def duplicate_key_check(t: Tables) -> DataFrame:
    return filters.repeated_keys(t.alignments, ["read_id", "aln_index"])


_HIST = "SELECT barcode, gx, n_tc AS conversion, base_t AS base, count(*) AS count FROM counts_tc GROUP BY ALL"


@query(f"SELECT barcode, CAST(sum(count) AS BIGINT) AS total FROM ({_HIST}) GROUP BY barcode HAVING sum(count) >= 20")
def threshold_cells(t: Tables) -> DataFrame:
    return filters.at_least(rates.aggregate_counts(t.counts_tc, ["TC"]), ["barcode"], "count", 20)


@query(f"SELECT barcode, gx, CAST(sum(count) AS BIGINT) AS total FROM ({_HIST}) WHERE base > 0 AND count > 0 GROUP BY ALL HAVING sum(count) >= 4")
def threshold_cell_genes(t: Tables) -> DataFrame:
    return filters.at_least(filters.informative(rates.aggregate_counts(t.counts_tc, ["TC"])), ["barcode", "gx"], "count", 4)


# ---- functions


@query("SELECT doc_id, " + ", ".join(f"length(u) - length(replace(u, '{b}', '')) AS {base_col(b)}" for b in BASES) + " FROM (SELECT doc_id, upper(text) AS u FROM documents)")
def content_counts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", *content(F.col("text")))


@query("SELECT conversion, translate(conversion, 'ACGT', 'TGCA') AS other, substr(conversion, 1, 1) AS genome_base, substr(conversion, 2, 1) AS read_base, count(*) AS n FROM conversions GROUP BY ALL")
def translate_complement(t: Tables) -> DataFrame:
    return t.conversions.groupBy("conversion").agg(F.count(F.lit(1)).alias("n")).select("conversion", complement_of(F.col("conversion")).alias("other"), F.substring("conversion", 1, 1).alias("genome_base"), F.substring("conversion", 2, 1).alias("read_base"), "n")


@query("""SELECT read_id, aln_index, flag, CASE WHEN ((flag & 16) <> 0) <> ((flag & 1) <> 0 AND (flag & 64) <> 0) THEN '-' ELSE '+' END AS forward_strand,
    CASE WHEN ((flag & 16) <> 0) <> ((flag & 1) <> 0 AND (flag & 64) <> 0) THEN '+' ELSE '-' END AS reverse_strand FROM (SELECT *, (score * 37) % 2048 AS flag FROM alignments WHERE score IS NOT NULL)""")
def read_strand(t: Tables) -> DataFrame:
    rows = t.alignments.filter("score is not null").select("read_id", "aln_index", (F.col("score") * 37 % 2048).alias("flag"))
    return rows.withColumn("forward_strand", votes.read_strand(F.col("flag"), "forward")).withColumn("reverse_strand", votes.read_strand(F.col("flag"), "reverse"))


@query("SELECT coalesce(nullif(g.gene_name, ''), c.gx) AS gx, c.barcode, c.n_tc FROM counts_tc c LEFT JOIN genes g ON c.gx = g.gx")
def gene_name_fallback(t: Tables) -> DataFrame:
    return matrix.gene_names(t.counts_tc.select("gx", "barcode", "n_tc"), t.genes)


@query("""SELECT barcode || '-0' AS barcode, gx, n_tc, 0 AS count_dir FROM counts_tc WHERE piece < 20 UNION ALL SELECT barcode || '-1', gx, n_tc, 1 FROM counts_tc WHERE piece >= 20""")
def suffix_union_dirs(t: Tables) -> DataFrame:
    cols = t.counts_tc.select("barcode", "gx", "n_tc", "piece")
    rows = matrix.from_inputs(*[cols.filter(c).drop("piece") for c in ("piece < 20", "piece >= 20")])
    dirs = F.when(F.col("barcode").isNotNull(), F.substring_index("barcode", "-", -1).cast("int"))
    return rows.withColumn("count_dir", dirs).filter("barcode is not null").unionByName(rows.filter("barcode is null").withColumn("count_dir", F.lit(None).cast("int")))


SQL["suffix_union_dirs"] = """SELECT barcode || '-0' AS barcode, gx, n_tc, CASE WHEN barcode IS NOT NULL THEN 0 END AS count_dir FROM counts_tc WHERE piece < 20
    UNION ALL SELECT barcode || '-1', gx, n_tc, CASE WHEN barcode IS NOT NULL THEN 1 END FROM counts_tc WHERE piece >= 20"""

_GUESS = f"SELECT barcode, least(greatest(sum(CASE WHEN conversion > 0 THEN count ELSE 0 END) * 1.0 / sum(count), 0.01), 0.99) AS guess FROM ({_HIST}) GROUP BY barcode"


@query(f"SELECT barcode, round(guess, 6) AS guess FROM ({_GUESS})")
def naive_guess(t: Tables) -> DataFrame:
    return rates.label_guess(rates.aggregate_counts(t.counts_tc, ["TC"]), ["barcode"])


@query(f"SELECT barcode, round(greatest(5 * guess, 0.1), 6) AS alpha, round(greatest(5 - greatest(5 * guess, 0.1), 0.1), 6) AS beta FROM ({_GUESS})")
def beta_params(t: Tables) -> DataFrame:
    a, b = guess_beta(F.col("guess"))
    return rates.label_guess(rates.aggregate_counts(t.counts_tc, ["TC"]), ["barcode"]).select("barcode", a.alias("alpha"), b.alias("beta"))


_AB = "SELECT DISTINCT base_a / 8.0 AS a, base_c / 8.0 AS b FROM counts_tc WHERE base_a > 0 AND base_c > 0"


@query(f"SELECT round(a, 6) AS a, round(b, 6) AS b, round(a / (a + b), 6) AS mean, round(CASE WHEN a > 1 AND b > 1 THEN (a - 1) / (a + b - 2) WHEN a > 1 THEN 1.0 WHEN b > 1 THEN 0.0 END, 6) AS mode, round(least(greatest(a, 0.0), 1.0), 6) AS clipped FROM ({_AB})")
def beta_mode_mean(t: Tables) -> DataFrame:
    ab = t.counts_tc.filter("base_a > 0 and base_c > 0").select((F.col("base_a") / 8.0).alias("a"), (F.col("base_c") / 8.0).alias("b")).distinct()
    a, b = F.col("a"), F.col("b")
    return ab.select("a", "b", beta_mean(a, b).alias("mean"), beta_mode(a, b).alias("mode"), clip(a, 0.0, 1.0).alias("clipped"))


@query("""SELECT n_tc AS k, base_t AS n, round(CASE WHEN n_tc > base_t THEN 0.0 ELSE exp(lgamma(base_t + 1) - lgamma(n_tc + 1) - lgamma(base_t - n_tc + 1) + n_tc * ln(0.05) + (base_t - n_tc) * ln(0.95)) END, 6) AS p
    FROM (SELECT DISTINCT n_tc, base_t FROM counts_tc WHERE n_tc IS NOT NULL AND base_t IS NOT NULL)""")
def binomial_pmf(t: Tables) -> DataFrame:
    kn = t.counts_tc.select(F.col("n_tc").alias("k"), F.col("base_t").alias("n")).dropna().distinct()
    return kn.select("k", "n", binomial_pmf_col(F.col("k"), F.col("n"), F.lit(0.05)).alias("p"))


# ---- rates


def _rate(c: str) -> str:
    return f"round(sum({n_col(c)}) * 1.0 / nullif(sum({base_col(c[0])}), 0), 6) AS {rates.rate_col(c)}"


_RATES = ", ".join(_rate(c) for c in CONVERSIONS)


@query(f"SELECT barcode, {_RATES} FROM ({_COMPLEMENTED}) GROUP BY barcode")
def mutation_rates(t: Tables) -> DataFrame:
    return rates.mutation_rates(counting.complement_counts(_c(t), t.genes), ["barcode"])


@query(f"SELECT {_RATES} FROM counts_tc")
def mutation_rates_global(t: Tables) -> DataFrame:
    return rates.mutation_rates(t.counts_tc)


@query(f"SELECT velocity, barcode, {_RATES} FROM counts_tc WHERE velocity NOT IN ('unassigned', 'ambiguous') GROUP BY ALL")
def mutation_rates_by_velocity(t: Tables) -> DataFrame:
    return rates.mutation_rates(filters.usable_velocity(t.counts_tc), ["velocity", "barcode"])


@query(" UNION ALL ".join(f"SELECT velocity, '{c}' AS conversion, round(sum({n_col(c)}) * 1.0 / nullif(sum({base_col(c[0])}), 0), 6) AS rate FROM counts_tc GROUP BY velocity" for c in CONVERSIONS))
def rates_long(t: Tables) -> DataFrame:
    return rates.rates_long(rates.mutation_rates(t.counts_tc, ["velocity"]), ["velocity"])


@query(f"SELECT a.barcode, {', '.join(f'coalesce({rates.rate_col(c)}, 0.0) AS {rates.rate_col(c)}' for c in CONVERSIONS)} FROM (SELECT DISTINCT barcode FROM alignments) a LEFT JOIN (SELECT barcode, {_RATES} FROM counts_tc WHERE velocity = 'unspliced' GROUP BY barcode) r ON a.barcode = r.barcode")
def rates_reindexed(t: Tables) -> DataFrame:
    return rates.rates_for(t.alignments, rates.mutation_rates(filters.read_group(t.counts_tc, "unspliced"), ["barcode"]))


@query(_HIST)
def aggregate_counts(t: Tables) -> DataFrame:
    return rates.aggregate_counts(t.counts_tc, ["TC"])


@query("SELECT barcode, gx, n_tc + n_ga AS conversion, base_g + base_t AS base, count(*) AS count FROM counts_tc GROUP BY ALL")
def merge_aggregates(t: Tables) -> DataFrame:
    return rates.merge_aggregates(*[rates.aggregate_counts(t.counts_tc.filter(c), ["TC", "GA"]) for c in ("piece < 20", "piece >= 20")])


@query("SELECT round(sum(n_tc) * 1.0 / nullif(sum(base_t), 0), 6) AS p_e FROM counts_tc")
def p_e_control(t: Tables) -> DataFrame:
    return rates.background_control(t.counts_tc, LABELS)


def _mean_sql(conversions: list[str], by: str, source: str) -> str:
    parts = " UNION ALL ".join(f"SELECT {by}, sum({n_col(c)}) * 1.0 / nullif(sum({base_col(c[0])}), 0) AS rate FROM ({source}) GROUP BY {by}" for c in conversions)
    return f"SELECT {by}, round(avg(rate), 6) AS p_e FROM ({parts}) GROUP BY {by}"


@query(_mean_sql(rates.background_conversions(LABELS), "barcode", _COMPLEMENTED))
def p_e(t: Tables) -> DataFrame:
    return rates.background(counting.complement_counts(_c(t), t.genes), LABELS, ["barcode"])


_ALL_BASES = [["TC"], ["AG"], ["GA"], ["CT"]]


@query(_mean_sql(rates.background_conversions(_ALL_BASES), "barcode", _C))
def p_e_all_bases(t: Tables) -> DataFrame:
    return rates.background(t.counts_tc, _ALL_BASES, ["barcode"])


@query("SELECT barcode, round((sum(n_ct) * 1.0 / nullif(sum(base_c), 0) + sum(n_ga) * 1.0 / nullif(sum(base_g), 0)) / 2, 6) AS p_e FROM counts_tc GROUP BY barcode")
def p_e_nasc(t: Tables) -> DataFrame:
    return rates.background_nasc(rates.mutation_rates(t.counts_tc, ["barcode"]), ["barcode"])


_PI = "SELECT barcode, (count(*) % 7 + 1) / 10.0 AS pi FROM counts_tc WHERE barcode IS NOT NULL GROUP BY barcode"


def _pi(t: Tables) -> DataFrame:
    """A stand-in for fitted shares that SQL can compute as well."""
    return t.counts_tc.filter("barcode is not null").groupBy("barcode").agg(((F.count(F.lit(1)) % 7 + 1) / 10.0).alias("pi"))


_ALPHA = f"SELECT c.barcode, count(*) FILTER (n_tc > 0) * 1.0 / count(*) / min(pi) AS alpha FROM counts_tc c JOIN ({_PI}) p ON c.barcode = p.barcode GROUP BY c.barcode"


@query(f"SELECT barcode, round(alpha, 6) AS alpha FROM ({_ALPHA})")
def alpha(t: Tables) -> DataFrame:
    return rates.detection(t.counts_tc, _pi(t), ["TC"], ["barcode"], ["barcode"])


# ---- SNPs and coverage

_SITES = f"SELECT contig, genome_i, conversion, count(*) AS n FROM ({_M}) WHERE quality > 27 AND conversion IN ('TC', 'AG') GROUP BY ALL"
_COVERAGE = "SELECT contig, genome_i, CAST(sum(coverage) AS BIGINT) AS coverage FROM coverage GROUP BY ALL"
_SNPS = f"SELECT contig, genome_i, conversion FROM ({_SITES}) JOIN ({_COVERAGE}) USING (contig, genome_i) WHERE coverage >= 2 AND n * 1.0 / nullif(coverage, 0) > 0.1"


@query(_SITES)
def conversion_sites(t: Tables) -> DataFrame:
    return rates.conversion_sites(counting.distinct_mismatches(t.conversions), ["TC"])


@query(_COVERAGE)
def coverage_totals(t: Tables) -> DataFrame:
    return rates.site_coverage(t.coverage)


@query("SELECT contig, genome_i, count(DISTINCT (read_id, aln_index)) AS coverage FROM conversions WHERE contig IS NOT NULL AND genome_i IS NOT NULL AND (contig, genome_i) IN (SELECT contig, genome_i FROM snps) GROUP BY ALL")
def coverage_of_reads(t: Tables) -> DataFrame:
    reads = t.conversions.filter("contig is not null and genome_i is not null").groupBy("read_id", "aln_index", "contig").agg(F.collect_list("genome_i").alias("positions"))
    return rates.coverage_of(reads, at=t.snps)


@query(_SNPS)
def snp_call(t: Tables) -> DataFrame:
    return rates.detect_snps(rates.conversion_sites(counting.distinct_mismatches(t.conversions), ["TC"]), rates.site_coverage(t.coverage), 0.1, 2)


@query(f"SELECT contig, genome_i, conversion FROM ({_SNPS}) UNION SELECT contig, genome_i, conversion FROM snps")
def snp_union(t: Tables) -> DataFrame:
    return rates.union_snps(rates.detect_snps(rates.conversion_sites(counting.distinct_mismatches(t.conversions), ["TC"]), rates.site_coverage(t.coverage), 0.1, 2), t.snps)


@query("SELECT s.contig, s.genome_i, v.conversion FROM (SELECT DISTINCT contig, genome_i FROM snps) s CROSS JOIN (VALUES " + ", ".join(f"('{c}')" for c in CONVERSIONS) + ") v(conversion)")
def snp_cross_conversions(t: Tables) -> DataFrame:
    return rates.all_conversions(t.snps)


@query("SELECT m.* FROM conversions m WHERE EXISTS (SELECT 1 FROM coverage c WHERE c.contig = m.contig AND c.genome_i = m.genome_i AND c.coverage >= 10)")
def covered_mismatches(t: Tables) -> DataFrame:
    return counting.only_selected(t.conversions, t.coverage.filter("coverage >= 10"), ["contig", "genome_i"])


# ---- positions

_INSIDE = f"""SELECT r.read_id, r.aln_index, r.contig, g.gx AS gene FROM ({_SPANS}) r JOIN genes g ON r.contig = g.contig AND r.start >= g.seg_start AND r."end" <= g.seg_end"""


@query(f"SELECT read_id, aln_index, contig, min(gene) AS gene FROM ({_INSIDE}) GROUP BY ALL HAVING count(*) = 1")
def gene_containment(t: Tables) -> DataFrame:
    return intervals.unique_gene(t.spans(), t.genes, ["read_id", "aln_index", "contig"], by_strand=False)


_PART = "(seg_end - seg_start) // 4"
_TRANSCRIPTS = f"SELECT gx, seg_start AS e1, seg_start + {_PART} AS e2, seg_end - {_PART} AS e3, seg_end AS e4 FROM genes"


@query(f"""SELECT read_id, aln_index, contig, gene, CASE WHEN exonic AND NOT intronic THEN 'spliced' WHEN exonic THEN 'ambiguous' WHEN intronic THEN 'unspliced' ELSE 'ambiguous' END AS velocity FROM (
    SELECT i.read_id, i.aln_index, i.contig, i.gene, (r.start >= e1 AND r."end" <= e2) OR (r.start >= e3 AND r."end" <= e4) AS exonic, r.start < e3 AND r."end" > e2 AS intronic
    FROM ({_INSIDE}) i JOIN ({_SPANS}) r ON i.read_id = r.read_id AND i.aln_index = r.aln_index AND i.contig = r.contig JOIN ({_TRANSCRIPTS}) t ON i.gene = t.gx)""")
def exon_intron_class(t: Tables) -> DataFrame:
    inside = intervals.containing_genes(t.spans(), t.genes, by_strand=False)
    reads = inside.select("read_id", "aln_index", "contig", F.col("gene").alias("gx"), F.array(F.struct("start", "end")).alias("segments"))
    part = F.expr("(seg_end - seg_start) div 4")
    seg = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    start, end = F.col("seg_start"), F.col("seg_end")
    transcripts = t.genes.select("gx", F.array(seg(start, start + part), seg(end - part, end)).alias("exons"), F.array(seg(start + part, end - part)).alias("introns"))
    key = ["read_id", "aln_index", "contig", "gene"]
    return intervals.velocity_of(reads.withColumn("gene", F.col("gx")), transcripts, key)


@query("""SELECT contig, min(p) AS start, max(p) + 1 AS "end", max(p) + 1 - min(p) AS n_positions FROM (SELECT contig, p, p - row_number() OVER (PARTITION BY contig ORDER BY p) AS run FROM (SELECT DISTINCT contig, genome_i // 50 AS p FROM coverage WHERE genome_i IS NOT NULL)) GROUP BY contig, run""")
def segments_from_positions(t: Tables) -> DataFrame:
    return intervals.islands(t.coverage.select("contig", F.expr("genome_i div 50").alias("p")), ["contig"], "p")


_VOTES = ", ".join(f"sum(CASE WHEN b = '{b}' THEN quality ELSE 0 END) AS q{b}" for b in BASES)


@query(f"""SELECT contig, genome_i, ref, CASE WHEN best < 60 OR (ref = 'A' AND qA = best) OR (ref = 'C' AND qC = best) OR (ref = 'G' AND qG = best) OR (ref = 'T' AND qT = best) THEN ref
    WHEN qA = best THEN 'A' WHEN qC = best THEN 'C' WHEN qG = best THEN 'G' ELSE 'T' END AS base, CAST(least(best, 42) AS BIGINT) AS quality
    FROM (SELECT *, greatest(qA, qC, qG, qT) AS best FROM (SELECT contig, genome_i, substr(conversion, 1, 1) AS ref, {_VOTES} FROM (SELECT *, substr(conversion, 2, 1) AS b FROM conversions WHERE quality IS NOT NULL) GROUP BY ALL))""")
def consensus_base(t: Tables) -> DataFrame:
    rows = t.conversions.filter("quality is not null").select("contig", "genome_i", F.substring("conversion", 1, 1).alias("ref"), F.substring("conversion", 1, 1).alias("r"), F.substring("conversion", 2, 1).alias("b"), "quality")
    return votes.vote(rows, ["contig", "genome_i", "ref"], "r", "b", "quality", 60)


_PLACED = f"SELECT a.barcode, coalesce(a.umi, CAST(r.start AS VARCHAR) || '_' || CAST(r.\"end\" AS VARCHAR)) AS umi, a.gx, a.read_id, a.score, r.contig, r.start, r.\"end\" FROM alignments a JOIN ({_SPANS}) r ON a.read_id = r.read_id AND a.aln_index = r.aln_index"


def _digest(first: int) -> str:
    return f"CAST(sum(CAST(('0x' || substr(md5(read_id), {first}, 15)) AS BIGINT)::DECIMAL(38, 0)) AS DECIMAL(38, 0))"


@query(f"""SELECT barcode, umi, gx, contig, min(start) AS start, max("end") AS "end", CAST(sum(score) AS BIGINT) AS score, count(*) AS n_reads, sha256(concat_ws('/', {_digest(1)}, {_digest(16)}, count(*))) AS name FROM ({_PLACED}) GROUP BY ALL""")
def consensus_groups(t: Tables) -> DataFrame:
    placed = t.alignments.select("read_id", "aln_index", "barcode", "umi", "gx", "score").join(t.spans().drop("strand"), ["read_id", "aln_index"])
    return votes.group_facts(placed.withColumn("umi", votes.pseudo_umi(F.col("umi"), F.col("start"), F.col("end"))), ["barcode", "umi", "gx", "contig"])


# ---- sampling and matrices


def _md5(seed: int) -> str:
    return f"md5(concat_ws('|', '{seed}', coalesce(read_id, ''), coalesce(gx, ''), coalesce(CAST(piece AS VARCHAR), '')))"


@query(f"SELECT read_id, gx, piece FROM (SELECT *, row_number() OVER (ORDER BY {_md5(7)}) AS rn FROM counts_tc) WHERE rn <= (SELECT CAST(floor(count(*) * 0.3) AS BIGINT) FROM counts_tc)")
def downsample_exact(t: Tables) -> DataFrame:
    return sample.downsample(t.counts_tc.select("read_id", "gx", "piece"), ["read_id", "gx", "piece"], proportion=0.3, seed=7)


@query(f"SELECT barcode, read_id, gx, piece FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY {_md5(3)}) AS rn FROM counts_tc) WHERE rn <= 25")
def downsample_per_cell(t: Tables) -> DataFrame:
    return sample.downsample(t.counts_tc.select("barcode", "read_id", "gx", "piece"), ["read_id", "gx", "piece"], count=25, by=["barcode"], seed=3)


@query("SELECT barcode, gx, count(*) AS value FROM counts_tc GROUP BY ALL")
def counts_matrix(t: Tables) -> DataFrame:
    return matrix.counts_matrix(t.counts_tc)


_SPLIT = "SELECT barcode, gx, count(*) FILTER (n_tc = 0) AS unlabeled, count(*) FILTER (n_tc > 0) AS labeled FROM counts_tc GROUP BY ALL"


@query(_SPLIT)
def split_counts(t: Tables) -> DataFrame:
    return matrix.split_counts(t.counts_tc, ["TC"])


def _layers_sql() -> str:
    group = {"transcriptome": _T, "total": "true", "spliced": "velocity = 'spliced'", "unspliced": "velocity = 'unspliced'"}
    parts = [("X", _T), ("total", "true"), ("spliced", group["spliced"]), ("unspliced", group["unspliced"]), ("ambiguous", "velocity = 'ambiguous'")]
    for label in TWO_LABELS:
        others = [c for x in TWO_LABELS for c in x if c not in label]
        own, other = (" OR ".join(f"{n_col(c)} > 0" for c in x) for x in (label, others))
        for g, (new, old) in matrix.LABEL_LAYERS.items():
            parts += [(new + matrix.label_name(label), f"{group[g]} AND NOT ({other}) AND NOT ({own})"), (old + matrix.label_name(label), f"{group[g]} AND NOT ({other}) AND ({own})")]
    return " UNION ALL ".join(f"SELECT '{n}' AS layer, barcode, gx, count(*) AS value FROM counts_tc WHERE {c} GROUP BY ALL" for n, c in parts)


@query(_layers_sql())
def layers_long(t: Tables) -> DataFrame:
    return matrix.layers_long(t.counts_tc, TWO_LABELS)


@query(f"SELECT m.barcode, m.gx, m.value, round(m.value * (1 - pi), 6) AS unlabeled_est, round(m.value * pi, 6) AS labeled_est FROM (SELECT barcode, gx, count(*) AS value FROM counts_tc GROUP BY ALL) m JOIN ({_PI}) p ON m.barcode = p.barcode")
def split_matrix_pi(t: Tables) -> DataFrame:
    return matrix.split_by_pi(matrix.counts_matrix(t.counts_tc), _pi(t), ["barcode"])


@query(f"""SELECT barcode, gx, round(unlabeled + labeled - est, 6) AS unlabeled_est, round(est, 6) AS labeled_est FROM (SELECT s.barcode, s.gx, unlabeled, labeled,
    CASE WHEN alpha > 0 THEN least(labeled / least(alpha, 1.0), unlabeled + labeled) WHEN labeled > 0 THEN unlabeled + labeled ELSE 0 END AS est FROM ({_SPLIT}) s JOIN ({_ALPHA}) a ON s.barcode = a.barcode)""")
def split_matrix_alpha(t: Tables) -> DataFrame:
    return matrix.split_by_alpha(matrix.split_counts(t.counts_tc, ["TC"]), rates.detection(t.counts_tc, _pi(t), ["TC"], ["barcode"], ["barcode"]))


@query(f"SELECT g.barcode, round(min(a), 6) AS alpha FROM ({_GROUPS}) g JOIN (SELECT \"group\", count(*) FILTER (n_tc > 0) * 1.0 / count(*) AS a FROM counts_tc c JOIN ({_GROUPS}) x ON c.barcode = x.barcode GROUP BY \"group\") e ON g.\"group\" = e.\"group\" GROUP BY g.barcode")
def group_rollforward(t: Tables) -> DataFrame:
    grouped = filters.in_groups(t.counts_tc, t.groups())
    est = grouped.groupBy("group").agg(F.try_divide(F.count_if(filters.is_labeled(["TC"])).cast("double"), F.count(F.lit(1)).cast("double")).alias("alpha"))
    return matrix.fan_out(est, t.groups())


@query(f"""SELECT o.barcode, g."group", e.p_e FROM (SELECT DISTINCT barcode FROM alignments) o LEFT JOIN ({_GROUPS}) g ON o.barcode = g.barcode LEFT JOIN ({_mean_sql(rates.background_conversions(LABELS), 'barcode', _C)}) e ON o.barcode = e.barcode""")
def observations(t: Tables) -> DataFrame:
    return matrix.observations(t.alignments, False, t.groups(), rates.background(t.counts_tc, LABELS, ["barcode"]))


@query("""SELECT 'only_alignments' AS what, count(*) AS n FROM (SELECT barcode FROM alignments EXCEPT SELECT barcode FROM counts_tc) UNION ALL
    SELECT 'both', count(*) FROM (SELECT barcode FROM alignments INTERSECT SELECT barcode FROM counts_tc) UNION ALL SELECT 'either', count(*) FROM (SELECT barcode FROM alignments UNION SELECT barcode FROM counts_tc)""")
def set_differences(t: Tables) -> DataFrame:
    a, c = t.alignments.select("barcode"), t.counts_tc.select("barcode")
    out = None
    for name, rows in (("only_alignments", a.subtract(c)), ("both", a.intersect(c)), ("either", a.union(c).distinct())):
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT velocity, {', '.join(f'CAST(sum({base_col(b)}) AS BIGINT) AS sum_{base_col(b)}' for b in BASES)}, CAST(sum({_TOTAL}) AS BIGINT) AS n_conversions FROM counts_tc GROUP BY velocity")
def base_content(t: Tables) -> DataFrame:
    return rates.base_content(t.counts_tc, ["velocity"])


# ---- streams


@query(_SPLIT)
def streamed_matrix(t: Tables) -> DataFrame:
    """The matrix of counts that arrive as files, a few at a time."""
    stream = streaming.read_stream(t.spark, f"{t.folder}/counts_tc.parque[t]", t.counts_tc.schema)
    out = scratch_folder(t.spark, "matrix")
    streaming.run_to_table(streaming.running_matrix(stream, ["TC"]), out, scratch_folder(t.spark, "progress"))
    return t.spark.read.parquet(out)
