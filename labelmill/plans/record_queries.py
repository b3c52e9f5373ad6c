"""Queries over alignment records, which are made of the test tables: one for each mismatch.

A record has one of a few CIGARs with insertions, deletions, gaps and clips; its bases come from a
hash of its name, and two places of its alignment differ from the reference.  The SQL knows the
CIGARs only as tables of places, base by base, and neither CIGAR nor MD strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labelmill.functions.sequences import BASE_COLUMNS, BASES, base_col
from labelmill.functions.storage import scratch_folder, table
from labelmill.operators import rates, reads
from labelmill.sources import sam

#: CIGAR, number of aligned bases, how many of these lie before a deletion, and what is deleted.
SHAPES = [("24M", 24, 0, ""), ("4S20M", 20, 0, ""), ("10M2I12M", 22, 0, ""), ("10M3D14M", 24, 10, "ACG"), ("9M50N15M", 24, 0, ""), ("2H12M1D8M4S", 20, 12, "T")]
LENGTH = 24


def _walk(cigar: str, lost: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, str]]]:
    """(place in the read, place from the start, number) of the aligned bases; the deleted ones."""
    i, p, aligned, gone, n = 0, 0, [], [], ""
    for c in cigar:
        if c.isdigit():
            n += c
            continue
        for _ in range(int(n)):
            if c == "M":
                aligned.append((i, p, len(aligned)))
            elif c == "D":
                gone.append((p, lost[len(gone)]))
            i, p = i + (c in "MIS"), p + (c in "MDN")
        n = ""
    return aligned, gone


def _segments(aligned: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    at = sorted(p for _, p, _ in aligned)
    starts = [p for p in at if p - 1 not in at]
    return [(s, next(p for p in at if p >= s and p + 1 not in at) + 1) for s in starts]


_WALKS = [_walk(c, d) for c, _, _, d in SHAPES]
_OTHER = ("ACGTN", "CGTAA")

# ---- records in Spark


def _of(k: Column, values: list) -> Column:
    return F.element_at(F.lit(values), k + 1)


def _body(name: Column, at: Column) -> list[Column]:
    """cigar, seq, quality and MD of a record by its name and place."""
    k = ((at + F.length(name)) % len(SHAPES)).cast("int")
    seq = F.translate(F.substring(F.md5(name), 1, LENGTH), "0123456789abcdef", "ACGTACGTACGTACGN")
    n, d = _of(k, [s[1] for s in SHAPES]), _of(k, [s[2] for s in SHAPES])
    one, two = (at % 8).cast("int"), n - 1 - (at % 5).cast("int")
    places = F.element_at(F.lit([[p for p, _, _ in w] for w, _ in _WALKS]), k + 1)
    ref = lambda a: F.translate(F.substring(seq, F.element_at(places, a + 1) + 1, 1), *_OTHER)
    plain = F.concat(one.cast("string"), ref(one), (two - one - 1).cast("string"), ref(two), (n - 1 - two).cast("string"))
    cut = F.concat(one.cast("string"), ref(one), (d - one - 1).cast("string"), F.lit("^"), _of(k, [s[3] for s in SHAPES]), (two - d).cast("string"), ref(two), (n - 1 - two).cast("string"))
    quality = F.transform(F.sequence(F.lit(0), F.lit(LENGTH - 1)), lambda i: (20 + (i * 7 + at) % 21).cast("int"))
    return [_of(k, [s[0] for s in SHAPES]).alias("cigar"), seq.alias("seq"), quality.alias("quality"), F.when(d > 0, cut).otherwise(plain).alias("md")]


def _base(spark: SparkSession, folder: str) -> DataFrame:
    """name, contig and place of each mismatch, with what is known of its read."""
    key = ["read_id", "aln_index", "contig", "genome_i", "conversion"]
    known = table(spark, folder, "conversions").filter("contig is not null and genome_i is not null").select(*key).distinct()
    facts = table(spark, folder, "alignments").groupBy("read_id", "aln_index").agg(*[F.max(c).alias(c) for c in ("barcode", "umi", "gx", "score")])
    named = known.withColumn("name", F.concat_ws("/", *key)).join(facts, ["read_id", "aln_index"], "left")
    return named.select("name", "contig", "genome_i", "barcode", "umi", "gx", "score")


def _record(rows: DataFrame, name: Column, start: Column, flag: int) -> DataFrame:
    """Records of rows that have name, contig, genome_i, barcode, umi, gx and score."""
    cigar, seq, quality, md = _body(name, F.col("genome_i"))
    pairs = [("MD", F.col("md")), ("CB", F.col("barcode")), ("UB", F.col("umi")), ("GX", F.col("gx")), ("AS", F.col("score").cast("string"))]
    own = rows.select("name", "contig", "genome_i", "barcode", "umi", "gx", "score", start.alias("start"), cigar, seq, quality, md)
    tags = F.map_filter(F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
    return own.select(F.col("name").alias("read_id"), F.lit(flag).alias("flag"), "contig", "start", F.lit(255).alias("mapq"), "cigar", "seq", "quality", tags.alias("tags"), "barcode", "umi", "gx")


def single_records(spark: SparkSession, folder: str) -> DataFrame:
    return _record(_base(spark, folder), F.col("name"), F.col("genome_i"), 0)


def paired_records(spark: SparkSession, folder: str) -> DataFrame:
    """Two mates for each mismatch, which lie apart by up to 29 places and overlap more or less."""
    rows = _base(spark, folder)
    first = _record(rows, F.concat("name", F.lit("1")), F.col("genome_i"), 0x1 | 0x2 | 0x40)
    return first.unionByName(_record(rows, F.concat("name", F.lit("2")), F.col("genome_i") + F.col("genome_i") % 30, 0x1 | 0x2 | 0x80))


# ---- the same in SQL, base by base

_PLACES = ", ".join(f"({k}, {i}, {p}, {a})" for k, (w, _) in enumerate(_WALKS) for i, p, a in w)
_GONE = ", ".join(f"({k}, {p}, '{b}')" for k, (_, g) in enumerate(_WALKS) for p, b in g)
_SEGMENTS = ", ".join(f"({k}, {a}, {b})" for k, (w, _) in enumerate(_WALKS) for a, b in _segments(w))
_SIZES = ", ".join(f"({k}, {s[1]})" for k, s in enumerate(SHAPES))
_COMMON = f"""shape(k, n) AS (VALUES {_SIZES}), place(k, i, off, a) AS (VALUES {_PLACES}), gone(k, off, b) AS (VALUES {_GONE}), segment(k, s, e) AS (VALUES {_SEGMENTS}),
    facts AS (SELECT read_id, aln_index, max(barcode) AS barcode, max(umi) AS umi, max(gx) AS gx, max(score) AS score FROM alignments GROUP BY ALL),
    base AS (SELECT concat_ws('/', c.read_id, c.aln_index, contig, genome_i, conversion) AS name, contig, genome_i, barcode, umi, gx, score
        FROM (SELECT DISTINCT read_id, aln_index, contig, genome_i, conversion FROM conversions WHERE contig IS NOT NULL AND genome_i IS NOT NULL) c LEFT JOIN facts f ON c.read_id = f.read_id AND c.aln_index = f.aln_index)"""


def _rows(name: str, label: str, start: str) -> str:
    """Tables r (records), b (their aligned bases) and d (their deleted ones), named with a label."""
    return f"""r{label} AS (SELECT base.*, {start} AS start, CAST((genome_i + length({name})) % {len(SHAPES)} AS INT) AS k,
        translate(substr(md5({name}), 1, {LENGTH}), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq FROM base),
    b{label} AS (SELECT name, contig, r.start + off AS pos, substr(seq, i + 1, 1) AS b, CASE WHEN a = genome_i % 8 OR a = n - 1 - genome_i % 5 THEN translate(substr(seq, i + 1, 1), '{_OTHER[0]}', '{_OTHER[1]}') ELSE substr(seq, i + 1, 1) END AS ref,
        CAST(20 + (i * 7 + genome_i) % 21 AS INT) AS q FROM r{label} r JOIN shape USING (k) JOIN place USING (k)),
    d{label} AS (SELECT name, contig, start + off AS pos, b AS ref FROM r{label} JOIN gone USING (k))"""


_SINGLE = f"{_COMMON}, {_rows('name', '', 'genome_i')}"
_PAIR = f"""{_COMMON}, {_rows("name || '1'", '1', 'genome_i')}, {_rows("name || '2'", '2', 'genome_i + genome_i % 30')},
    c1 AS (SELECT b1.*, b2.pos IS NOT NULL AS there, coalesce(b2.ref <> 'N' AND b2.b <> 'N', false) AS called, b2.q AS q2 FROM b1 LEFT JOIN b2 ON b1.name = b2.name AND b1.pos = b2.pos),
    early AS (SELECT * FROM c1 WHERE ref <> b AND ref <> 'N' AND b <> 'N' AND (NOT there OR NOT called OR q > q2))"""


def _content(rows: str) -> str:
    return ", ".join(f"CAST(sum(CASE WHEN ref = '{b}' THEN w ELSE 0 END) AS INT) AS {base_col(b)}" for b in BASES) + f", min(start) AS start, max(\"end\") AS \"end\", CAST(sum(covered) AS BIGINT) AS n_covered FROM ({rows}) GROUP BY name"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _contents(decoded: DataFrame) -> DataFrame:
    covered = F.aggregate("segments", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return decoded.select(F.col("read_id").alias("name"), *BASE_COLUMNS, F.col("segments")[0]["start"].alias("start"), F.try_element_at("segments", F.lit(-1))["end"].alias("end"), covered.alias("n_covered"))


def _found(decoded: DataFrame) -> DataFrame:
    return decoded.select(F.col("read_id").alias("name"), "contig", F.explode("found").alias("f")).select("name", "contig", "f.genome_i", "f.conversion", "f.quality")


@query(f"WITH {_SINGLE} SELECT name, {_content('SELECT name, ref, 1 AS w, pos AS start, pos + 1 AS \"end\", 1 AS covered FROM b UNION ALL SELECT name, ref, 1, NULL, NULL, 0 FROM d')}")
def decoded_content(spark: SparkSession, folder: str) -> DataFrame:
    return _contents(reads.decode_reads(single_records(spark, folder), paired=False))


@query(f"WITH {_SINGLE} SELECT name, contig, pos AS genome_i, ref || b AS conversion, q AS quality FROM b WHERE ref <> b AND ref <> 'N' AND b <> 'N'")
def decoded_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return _found(reads.decode_reads(single_records(spark, folder)))


#: Every base of either mate, and once more, taken away, those called by the earlier one where the later lies.
_BOTH = """SELECT name, ref, 1 AS w, pos AS start, pos + 1 AS "end", CASE WHEN there THEN 0 ELSE 1 END AS covered FROM c1 UNION ALL SELECT name, ref, 1, pos, pos + 1, 1 FROM b2
    UNION ALL SELECT name, ref, 1, NULL, NULL, 0 FROM d1 UNION ALL SELECT name, ref, 1, NULL, NULL, 0 FROM d2 UNION ALL SELECT name, ref, -1, NULL, NULL, 0 FROM c1 WHERE there AND ref <> 'N' AND b <> 'N'"""


@query(f"WITH {_PAIR} SELECT name, {_content(_BOTH)}")
def mate_content(spark: SparkSession, folder: str) -> DataFrame:
    return _contents(reads.decode_reads(paired_records(spark, folder), paired=True))


@query(f"""WITH {_PAIR} SELECT name, contig, pos AS genome_i, ref || b AS conversion, q AS quality FROM early
    UNION ALL SELECT name, contig, pos, ref || b, q FROM b2 WHERE ref <> b AND ref <> 'N' AND b <> 'N' AND NOT EXISTS (SELECT 1 FROM early e WHERE e.name = b2.name AND e.pos = b2.pos)""")
def mate_pairing(spark: SparkSession, folder: str) -> DataFrame:
    return _found(reads.decode_reads(paired_records(spark, folder)))


@query(f"WITH {_SINGLE} SELECT contig, pos AS genome_i, count(*) AS coverage FROM b GROUP BY ALL")
def coverage_from_records(spark: SparkSession, folder: str) -> DataFrame:
    return rates.coverage_of_segments(reads.read_positions(single_records(spark, folder), paired=False))


@query(f"WITH {_PAIR} SELECT contig, pos AS genome_i, count(*) AS coverage FROM (SELECT name, contig, pos FROM b1 UNION SELECT name, contig, pos FROM b2) WHERE pos IN (SELECT genome_i FROM snps s WHERE s.contig = contig) AND (contig, pos) IN (SELECT (contig, genome_i) FROM snps) GROUP BY ALL")
def coverage_of_pairs_at_snps(spark: SparkSession, folder: str) -> DataFrame:
    return rates.coverage_of_segments(reads.read_positions(paired_records(spark, folder), paired=True), table(spark, folder, "snps"))


@query("""SELECT tag FROM (SELECT 'AS' AS tag, count(score) AS n FROM alignments UNION ALL SELECT 'CB', count(barcode) FROM alignments UNION ALL SELECT 'GX', count(gx) FROM alignments
    UNION ALL SELECT 'UB', count(umi) FROM alignments UNION ALL SELECT 'RN', count(*) FILTER (piece < 0) FROM alignments) WHERE n > 0""")
def scan_tags_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the tags that any record has; what is asked for and missing is told from them."""
    rows = table(spark, folder, "alignments")
    pairs = [("CB", "barcode"), ("UB", "umi"), ("GX", "gx"), ("AS", "score")]
    tags = F.map_filter(F.create_map(*[x for k, c in pairs for x in (F.lit(k), F.col(c).cast("string"))]), lambda k, v: v.isNotNull())
    return spark.createDataFrame([(t,) for t in sam.tag_names(rows.select(tags.alias("tags")))], "tag string")


@query("SELECT bool_or(score % 2 = 1) AS paired, bool_or((score * 37) % 2048 & 256 <> 0) AS secondary, bool_or((score * 37) % 2048 & 1024 <> 0) AS duplicate, bool_or((score * 37) % 2048 & 4 <> 0) AS unmapped FROM alignments")
def file_facts(spark: SparkSession, folder: str) -> DataFrame:
    flags = table(spark, folder, "alignments").select((F.col("score") * 37 % 2048).alias("flag"))
    return spark.createDataFrame([sam.file_facts(flags)])


@query(f"""WITH {_SINGLE} SELECT name AS read_id, CAST(0 AS INT) AS flag, contig, start, ['{"', '".join(s[0] for s in SHAPES)}'][k + 1] AS cigar, seq, CAST(list_sum([20 + (i * 7 + genome_i) % 21 FOR i IN range({LENGTH})]) AS BIGINT) AS quality_sum,
    barcode, umi, gx, CAST(score AS VARCHAR) AS score FROM r""")
def sam_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Records written as SAM text and read again."""
    out = scratch_folder(spark, "sam")
    sam.sam_lines(single_records(spark, folder)).write.text(out)
    tag = lambda t, name: F.try_element_at("tags", F.lit(t)).alias(name)
    total = F.aggregate("quality", F.lit(0).cast("long"), lambda s, q: s + q)
    return sam.read_sam(spark, out).select("read_id", "flag", "contig", "start", "cigar", "seq", total.alias("quality_sum"), tag("CB", "barcode"), tag("UB", "umi"), tag("GX", "gx"), tag("AS", "score"))


_PART = "(seg_end - seg_start) // 4"


SQL["bam_round_trip"] = SQL["sam_round_trip"]


def bam_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Records written as BAM files and read again."""
    out = scratch_folder(spark, "bam").removeprefix("file:")
    sam.write_bam(single_records(spark, folder), out, ["@HD\tVN:1.6\tSO:coordinate"])
    tag = lambda t, name: F.try_element_at("tags", F.lit(t)).alias(name)
    total = F.aggregate("quality", F.lit(0).cast("long"), lambda s, q: s + q)
    return sam.read_bam(spark, out).select("read_id", "flag", "contig", "start", "cigar", "seq", total.alias("quality_sum"), tag("CB", "barcode"), tag("UB", "umi"), tag("GX", "gx"), tag("AS", "score"))


QUERIES["bam_round_trip"] = bam_round_trip


@query(f"""WITH {_SINGLE}, sums AS (SELECT name, {", ".join(f"count(*) FILTER (ref = '{b}') AS {base_col(b)}" for b in BASES)} FROM (SELECT name, ref FROM b UNION ALL SELECT name, ref FROM d) GROUP BY name),
    ends AS (SELECT name, min(pos) AS lo, max(pos) + 1 AS hi FROM b GROUP BY name),
    span AS (SELECT r.name, r.contig, r.k, r.start AS s, lo, hi, {", ".join(BASE_COLUMNS)} FROM r JOIN sums ON sums.name = r.name JOIN ends ON ends.name = r.name),
    inside AS (SELECT x.name, min(g.gx) AS gene FROM span x JOIN genes g ON x.contig = g.contig AND x.lo >= g.seg_start AND x.hi <= g.seg_end AND g.strand = '+' GROUP BY x.name HAVING count(DISTINCT g.gx) = 1),
    placed AS (SELECT x.*, r.barcode, r.umi, r.gx IS NOT NULL AS transcriptome, coalesce(r.gx, i.gene) AS gene, coalesce(r.score, 0) AS score FROM span x JOIN r ON r.name = x.name LEFT JOIN inside i ON i.name = x.name WHERE coalesce(r.gx, i.gene) IS NOT NULL AND r.barcode <> '-' AND r.umi IS NOT NULL),
    met AS (SELECT p.name, bool_and((p.s + g.s >= seg_start AND p.s + g.e <= seg_start + {_PART}) OR (p.s + g.s >= seg_end - {_PART} AND p.s + g.e <= seg_end)) AS exonic, bool_or(p.s + g.s < seg_end - {_PART} AND p.s + g.e > seg_start + {_PART}) AS intronic
        FROM placed p JOIN segment g USING (k) JOIN genes t ON t.gx = p.gene GROUP BY p.name)
    SELECT p.name, barcode, umi, gene AS gx, {", ".join(f"CAST({c} AS INT) AS {c}" for c in BASE_COLUMNS)}, transcriptome, CAST(score AS INT) AS score,
    CASE WHEN exonic AND NOT intronic THEN 'spliced' WHEN exonic THEN 'ambiguous' WHEN intronic THEN 'unspliced' ELSE 'ambiguous' END AS velocity FROM placed p LEFT JOIN met m ON m.name = p.name""")
def parsed_alignments(spark: SparkSession, folder: str) -> DataFrame:
    """From records to alignments: tags, genes by tag or place, velocity by exons and introns."""
    genes = table(spark, folder, "genes")
    seg = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    start, end, part = F.col("seg_start"), F.col("seg_end"), F.expr("(seg_end - seg_start) div 4")
    transcripts = genes.select("gx", F.array(seg(start, start + part), seg(end - part, end)).alias("exons"), F.array(seg(start + part, end - part)).alias("introns"))
    found, _ = reads.parse_reads(single_records(spark, folder), genes, transcripts, umi_tag="UB", barcode_tag="CB", paired=False)
    return found.select(F.col("read_id").alias("name"), "barcode", "umi", "gx", *BASE_COLUMNS, "transcriptome", "score", "velocity")


_KEYS = ["contig", "gx", "barcode", "umi"]


@query(f"""WITH {_SINGLE}, w AS (SELECT {", ".join("r." + k for k in _KEYS)}, x.pos, x.ref, x.b, x.q FROM (SELECT name, pos, ref, b, q FROM b WHERE ref <> 'N' AND b <> 'N' UNION ALL SELECT name, pos, ref, NULL, 0 FROM d) x JOIN r ON r.name = x.name),
    s AS (SELECT {", ".join(_KEYS)}, pos, min(ref) AS ref, {", ".join(f"sum(CASE WHEN b = '{b}' THEN q ELSE 0 END) AS q{b}" for b in BASES)} FROM w GROUP BY ALL),
    t AS (SELECT *, greatest({", ".join(f"q{b}" for b in BASES)}) AS best FROM s),
    u AS (SELECT *, best > 0 AS there, CASE WHEN best < 27 OR {" OR ".join(f"(ref = '{b}' AND q{b} = best)" for b in BASES)} THEN ref {" ".join(f"WHEN q{b} = best THEN '{b}'" for b in BASES)} END AS base FROM t),
    v AS (SELECT *, pos - coalesce(lag(pos) OVER g, pos - 1) - 1 AS gap, lag(there) OVER g AS before, sum(CASE WHEN there AND base = ref THEN 1 ELSE 0 END) OVER g AS matched FROM u WINDOW g AS (PARTITION BY {", ".join(_KEYS)} ORDER BY pos)),
    runs AS (SELECT *, sum(CASE WHEN gap > 0 OR before IS DISTINCT FROM there THEN 1 ELSE 0 END) OVER g AS run FROM v WINDOW g AS (PARTITION BY {", ".join(_KEYS)} ORDER BY pos)),
    ops AS (SELECT {", ".join(_KEYS)}, run, max(gap) AS gap, count(*) AS n, bool_and(there) AS there FROM runs GROUP BY ALL),
    cigars AS (SELECT {", ".join(_KEYS)}, string_agg(CASE WHEN gap > 0 THEN CAST(gap AS VARCHAR) || 'N' ELSE '' END || CAST(n AS VARCHAR) || CASE WHEN there THEN 'M' ELSE 'D' END, '' ORDER BY run) AS cigar FROM ops GROUP BY ALL),
    ev AS (SELECT *, matched - coalesce(lag(matched) OVER g, 0) AS since FROM v WHERE NOT there OR base <> ref WINDOW g AS (PARTITION BY {", ".join(_KEYS)} ORDER BY pos)),
    mds AS (SELECT {", ".join(_KEYS)}, string_agg(CASE WHEN there THEN CAST(since AS VARCHAR) || ref WHEN before = false THEN ref ELSE CAST(since AS VARCHAR) || '^' || ref END, '' ORDER BY pos) AS head, max(matched) AS upto FROM ev GROUP BY ALL),
    whole AS (SELECT {", ".join(_KEYS)}, min(pos) AS start, string_agg(CASE WHEN there THEN base ELSE '' END, '' ORDER BY pos) AS seq, count(*) FILTER (there AND base <> ref) AS mismatches, max(matched) AS matched, CAST(sum(CASE WHEN there THEN least(best, 42) ELSE 0 END) AS BIGINT) AS quality_sum FROM v GROUP BY ALL)
    SELECT {", ".join("x." + k for k in _KEYS)}, x.start, x.seq, x.quality_sum, c.cigar, coalesce(m.head, '') || CAST(x.matched - coalesce(m.upto, 0) AS VARCHAR) AS md, CAST(x.mismatches AS INT) AS mismatches, f.n_reads, f.score,
    CAST(CASE WHEN g.strand = '-' THEN 16 ELSE 0 END AS INT) AS flag FROM whole x JOIN cigars c ON {" AND ".join(f"c.{k} IS NOT DISTINCT FROM x.{k}" for k in _KEYS)} LEFT JOIN mds m ON {" AND ".join(f"m.{k} IS NOT DISTINCT FROM x.{k}" for k in _KEYS)}
    JOIN (SELECT {", ".join(_KEYS)}, count(*) AS n_reads, CAST(sum(coalesce(score, 0)) AS BIGINT) AS score FROM r GROUP BY ALL) f ON {" AND ".join(f"f.{k} IS NOT DISTINCT FROM x.{k}" for k in _KEYS)} LEFT JOIN genes g ON g.gx = x.gx""")
def consensus_reads(spark: SparkSession, folder: str) -> DataFrame:
    """One read for each molecule, called from all its records."""
    called = reads.call_consensus(single_records(spark, folder), table(spark, folder, "genes"))
    total = F.aggregate("quality", F.lit(0).cast("long"), lambda s, q: s + q)
    return called.select(*_KEYS, "start", "seq", total.alias("quality_sum"), "cigar", "md", "mismatches", "n_reads", "score", "flag")
