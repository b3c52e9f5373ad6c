"""Base-level operators on hand-made records."""

from __future__ import annotations

import collections
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelmill.operators import counting
from labelmill.operators.reads import Record, consensus_read, decode_reads, merge_pair, parse_reads
from labelmill.plans.consensus import consensus
from labelmill.plans.count import count
from labelmill.sources import sam
from labelmill.sources.annotation import fasta_facts, index_parameters, read_gtf

RECORDS = "read_id string, flag int, contig string, start bigint, mapq int, cigar string, seq string, quality array<int>, tags map<string,string>"


def record(name, start, cigar, seq, quality, md, flag=0, contig="1", **tags):
    return (name, flag, contig, start, 255, cigar, seq, quality if isinstance(quality, list) else [quality] * len(seq), {"MD": md} | tags)


# ---- decoding against a walk base by base


def walk(start, ops, seq, reference, lost):
    """(place in the read or None, position, base of the reference): reference has the bases of the
    aligned places, lost those of the deleted ones."""
    out, i, p, ref, gone = [], 0, start, iter(reference), iter(lost)
    for n, op in ops:
        for _ in range(n):
            if op == "M":
                out.append((i, p, next(ref)))
            elif op == "D":
                out.append((None, p, next(gone)))
            i, p = i + (op in "MIS"), p + (op in "MDN")
    return out


def random_record(rng, start):
    """ops, sequence, qualities, MD, and the walk."""
    ops = [(rng.randint(1, 6), "M")]
    for _ in range(rng.randrange(4)):
        ops += [(rng.randint(1, 4), rng.choice("IDN")), (rng.randint(1, 6), "M")]
    ops = [(2, "S")] * rng.randrange(2) + ops + [(1, "S")] * rng.randrange(2)
    seq = "".join(rng.choices("ACGTN", [5, 5, 5, 5, 1], k=sum(n for n, op in ops if op in "MIS")))
    md, run, reference, lost, i = "", 0, "", "", 0
    for n, op in ops:
        if op == "M":
            for b in seq[i : i + n]:
                r = rng.choice("ACGT") if rng.random() < 0.2 else b
                reference += r
                md, run = (md, run + 1) if r == b else (f"{md}{run}{r}", 0)
        elif op == "D":
            own = "".join(rng.choices("ACGT", k=n))
            md, run, lost = f"{md}{run}^{own}", 0, lost + own
        i += n if op in "MIS" else 0
    quality = [rng.randint(0, 40) for _ in seq]
    return "".join(f"{n}{op}" for n, op in ops), seq, quality, f"{md}{run}", walk(start, ops, seq, reference, lost)


def facts_of(pairs, seq, quality):
    content, called, positions = collections.Counter(), {}, []
    for i, p, ref in pairs:
        content[ref] += 1
        if i is not None:
            positions.append(p)
            if ref != "N" and seq[i] != "N":
                called[p] = (ref, seq[i], quality[i])
    return content, called, positions


def spread(segments):
    return [p for a, b in segments for p in range(a, b)]


def test_records_are_decoded_as_base_by_base():
    rng = random.Random(7)
    for _ in range(400):
        start = rng.randrange(50)
        cigar, seq, quality, md, pairs = random_record(rng, start)
        record = Record(start, cigar, md, seq)
        content, called, positions = facts_of(pairs, seq, quality)
        assert record.content(True) == [content[b] for b in "ACGT"]
        assert record.mismatches(np.array(quality)) == {p: x for p, x in called.items() if x[0] != x[1]}
        assert spread(record.segments()) == positions and all(a[1] < b[0] for a, b in zip(record.segments(), record.segments()[1:]))


@pytest.mark.parametrize("nasc", [False, True])
def test_mates_are_merged_as_base_by_base(nasc):
    rng = random.Random(8)
    for _ in range(400):
        starts = sorted(rng.randrange(12) for _ in range(2))
        (c1, s1, q1, m1, w1), (c2, s2, q2, m2, w2) = (random_record(rng, x) for x in starts)
        content1, called1, positions1 = facts_of(w1, s1, q1)
        content2, called2, positions2 = facts_of(w2, s2, q2)
        want = content1 + content2
        want.subtract(ref for p, (ref, _, _) in called1.items() if p in positions2)
        found = {p: x for p, x in called2.items() if x[0] != x[1]}
        for p, x in called1.items():
            if x[0] != x[1] and (p not in positions2 or (not nasc and (p not in called2 or x[2] > called2[p][2]))):
                found[p] = x
        got = merge_pair(Record(starts[0], c1, m1, s1), np.array(q1), Record(starts[1], c2, m2, s2), np.array(q2), nasc=nasc)
        assert got[0] == [want[b] for b in "ACGT"] and got[1] == found and spread(got[2]) == sorted({*positions1, *positions2})


def test_records_with_missing_parts():
    nothing = Record(3, None, "", None)
    assert nothing.segments() == [] and nothing.content(True) == [0] * 4 and nothing.mismatches(np.empty(0)) == {}
    assert Record(0, "2M2D1M", "", "ACG").content(True) == [1, 1, 1, 0]  # what is deleted is unknown without MD
    assert Record(0, "2M", "5A", "ac").content(False) == [1, 1, 0, 0]


def test_consensus_of_votes_with_a_wide_gap():
    position = np.array([5, 6, 7, 3_000_000, 3_000_001])
    sums = np.array([[60, 0, 0, 0], [0, 0, 30, 30], [0, 0, 0, 0], [0, 0, 0, 0], [10, 0, 0, 0]])
    assert consensus_read(position, ["A", "T", "C", "G", "T"], sums) == (5, "ATT", [42, 30, 10], "2M1D2999992N1D1M", "2^CG1", 0)
    assert consensus_read(position[:2], ["C", "A"], sums[:2]) == (5, "AG", [42, 30], "2M", "0C0A0", 2)


@pytest.fixture
def records(spark):
    return spark.createDataFrame(
        [
            record("spliced", 2, "3M", "ACC", 30, "1T1", GX="g", CB="c1", UB="u1", AS="9"),
            record("pair", 1, "2M", "AA", 30, "2", flag=0x3 | 0x40 | 0x20, GX="g", CB="c1", UB="u2"),
            record("pair", 4, "2M", "AG", 30, "1A0", flag=0x3 | 0x80 | 0x10, GX="g", CB="c1", UB="u2"),
            record("lonely", 4, "2M", "AG", 30, "1A0", flag=0x3 | 0x80, GX="g", CB="c1", UB="u2"),
            record("intron", 11, "2M", "TT", 30, "2", CB="c1", UB="u3"),
            record("nowhere", 90, "2M", "TT", 30, "2", CB="c1", UB="u4"),
            record("secondary", 2, "2M", "TT", 30, "2", flag=0x100, GX="g", CB="c1", UB="u5"),
            record("no_cell", 2, "2M", "TT", 30, "2", GX="g", CB="-", UB="u6"),
        ],
        RECORDS,
    )


@pytest.fixture
def genes(spark):
    return spark.createDataFrame([("g", "1", "+", 0, 40, "Name"), ("h", "1", "-", 0, 40, None)], "gx string, contig string, strand string, seg_start bigint, seg_end bigint, gene_name string")


@pytest.fixture
def transcripts(spark):
    return spark.createDataFrame([("g", "t", [(0, 10), (20, 40)], [(10, 20)])], "gx string, transcript string, exons array<struct<start:bigint,end:bigint>>, introns array<struct<start:bigint,end:bigint>>")


def test_parse_reads(spark, records, genes, transcripts):
    alignments, found = parse_reads(records, genes, transcripts, umi_tag="UB", barcode_tag="CB")
    rows = {r["read_id"]: r for r in alignments.collect()}
    assert {k: (r["gx"], r["velocity"], r["transcriptome"]) for k, r in rows.items()} == {"spliced": ("g", "spliced", True), "pair": ("g", "spliced", True), "intron": ("g", "unspliced", False)}
    assert rows["spliced"]["score"] == 9 and rows["spliced"]["base_t"] == 1 and rows["pair"]["base_a"] == 4
    assert {(r["read_id"], r["genome_i"], r["conversion"]) for r in found.collect()} == {("spliced", 3, "TC"), ("pair", 5, "AG")}


def test_repeats_and_supplementary_records_stay(spark, genes):
    own = dict(GX="g", CB="c1")
    paired = dict(flag=0x3 | 0x40), dict(flag=0x3 | 0x80)
    rows = [
        *[record("twice", 2, "2M", "CA", 30, "T1", UB="u1", **own)] * 2,
        record("chimera", 2, "2M", "CA", 30, "T1", UB="u2", **own),
        record("chimera", 9, "3M", "AAG", 30, "2A", flag=0x800, UB="u2", **own),
        *[record("pair", 1, "2M", "AG", 30, "1A0", UB="u3", **paired[0], **own), record("pair", 4, "2M", "AA", 30, "2", UB="u3", **paired[1], **own)] * 2,
        *[record("odd", p, "1M", "A", 30, "1", UB="u4", **paired[p > 1], **own) for p in (1, 2, 3)],
        *[record("apart", 1, "1M", "A", 30, "1", contig=c, UB="u5", **paired[0], **own) for c in "12"],
    ]
    records = spark.createDataFrame(rows, RECORDS).repartition(3)
    got = sorted((r["read_id"], spread(r["segments"]), [tuple(f) for f in r["found"]]) for r in decode_reads(records).collect())
    assert got == [
        ("chimera", [2, 3], [(2, "TC", 30)]),
        ("chimera", [9, 10, 11], [(11, "AG", 30)]),
        ("odd", [1, 2], []),
        ("pair", [1, 2], [(2, "AG", 30)]),
        ("pair", [4, 5], []),
        ("twice", [2, 3], [(2, "TC", 30)]),
        ("twice", [2, 3], [(2, "TC", 30)]),
    ]
    # Counts of one record do not leak into another of its key, and coverage has every read.
    out = count(records, genes, None, [["TC"]], barcode_tag="CB", velocity=False, snp_threshold=0.9, quality=27)
    alignments = out.alignments.collect()
    assert sorted(r["read_id"] for r in alignments) == ["chimera"] * 2 + ["odd"] + ["pair"] * 2 + ["twice"] * 2
    key = ["read_id", "aln_index", "part"]
    each = counting.count_conversions(out.alignments, out.conversions, key=key).collect()
    assert sorted((r["read_id"], r["n_tc"], r["n_ag"]) for r in each if r["read_id"] in ("chimera", "twice")) == [("chimera", 0, 1), ("chimera", 1, 0), ("twice", 1, 0), ("twice", 1, 0)]
    kept = {r["read_id"]: (r["n_tc"], r["n_ag"]) for r in out.counts.collect()}
    assert kept == {"chimera": (1, 0), "odd": (0, 0), "pair": (0, 1), "twice": (1, 0)}
    assert {(r["genome_i"], r["coverage"]) for r in out.coverage.collect()} == {(2, 5), (11, 1)}


def test_decode_of_no_records(spark, records):
    assert decode_reads(records.filter("false")).count() == 0


def test_consensus_of_the_worked_example(spark, genes):
    both = dict(GX="g", CB="c", UB="u")
    rows = [
        record("read1", 1, "4M", "ACTG", 30, "4", **both),
        record("read2", 3, "4M", "TGCT", 30, "4", **both),
        record("read3", 5, "4M", "ACAG", [30, 40, 30, 30], "0C0T2", **both),
        record("read4", 7, "4M1I", "AGCTA", 30, "4", **both),
        record("read5", 9, "2M1D1M", "CTG", 30, "2^A1", **both),
        record("read6", 12, "2M", "GG", 20, "1C", **both),
        record("alone", 12, "2M", "GG", 20, "1C", GX="g", CB="c", UB="other"),
    ]
    out = {r["cigar"]: r for r in consensus(spark.createDataFrame(rows, RECORDS), genes, umi_tag="UB", barcode_tag="CB").collect()}
    one = out["10M1D2M"]
    assert (one["seq"], one["start"], one["tags"]["MD"], one["tags"]["RN"]) == ("ACTGCCAGCTGC", 1, "5T4^A2", "6")
    assert out["2M"]["read_id"] == "alone" and out["2M"]["tags"]["GN"] == "Name"


def test_a_repeated_record_keeps_its_gene_in_the_consensus(spark, genes):
    rows = [*[record("twice", 1, "4M", "ACTG", 30, "4", CB="c", UB="u")] * 2, record("other", 3, "2M", "TG", 30, "2", CB="c", UB="u")]
    out = consensus(spark.createDataFrame(rows, RECORDS), genes, umi_tag="UB", barcode_tag="CB").collect()
    assert len({r["tags"]["GX"] for r in out}) == 1 and [r["tags"]["RN"] for r in out] == ["3"]


def bam_bytes(rows, names=("1",), header="@PG\tID:a\tPN:STAR\tCL:STAR --soloStrand Reverse\n"):
    """A BAM file of one data block and the empty last block."""

    def block(data):
        pack = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = pack.compress(data) + pack.flush()
        return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))

    out = b"BAM\1" + struct.pack("<i", len(header)) + header.encode() + struct.pack("<i", len(names))
    for n in names:
        out += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 1000)
    parts = [out]
    for name, flag, contig, start, mapq, cigar, seq, quality, tags in rows:
        ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(op)) for n, op in cigar)
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0] * (len(seq) % 2)
        packed = bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2]))
        extra = b"".join(k.encode() + b"Z" + v.encode() + b"\0" for k, v in tags.items())
        body = struct.pack("<iiBBHHHiiii", names.index(contig), start, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + bytes(quality) + extra
        parts.append(struct.pack("<i", len(body)) + body)
    return b"".join(block(p) for p in parts) + block(b"")


def test_bam_and_sam(spark, tmp_path):
    path = tmp_path / "x.bam"
    path.write_bytes(bam_bytes([("r1", 0, "1", 5, 60, [(3, "M")], "ACG", [30, 31, 32], {"GX": "g"}), ("r2", 16, "1", 7, 60, [(2, "M"), (1, "S")], "ACN", [1, 2, 3], {})]))
    bam = sam.read_records(spark, str(path)).cache()
    rows = sorted(bam.collect())
    assert [(r["read_id"], r["start"], r["cigar"], r["seq"], r["quality"], r["tags"]) for r in rows] == [("r1", 5, "3M", "ACG", [30, 31, 32], {"GX": "g"}), ("r2", 7, "2M1S", "ACN", [1, 2, 3], {})]
    assert sam.read_header(str(path))[0].startswith("@PG")
    assert sam.tag_names(bam) == ["GX"] and sam.missing_tags(bam, ["GX", "CB"]) == ["CB"]
    assert sam.file_facts(bam) == {"paired": False, "secondary": False, "duplicate": False, "unmapped": False}
    text = tmp_path / "sam"
    sam.sam_lines(bam).write.text(str(text))
    again = sorted(sam.read_sam(spark, str(text)).collect())
    assert [tuple(r) for r in again] == [tuple(r) for r in rows]


def test_tags_and_flags_of_the_last_record_are_seen(spark):
    last = F.col("id") == 500_000
    records = spark.range(0, 500_001, 1, 1).select(F.when(last, 0x501).otherwise(0).alias("flag"), F.when(last, F.create_map(F.lit("RN"), F.lit("2"))).otherwise(F.create_map(F.lit("GX"), F.lit("g"))).alias("tags"))
    assert sam.tag_names(records) == ["GX", "RN"] and sam.missing_tags(records, ["RN", "CB"]) == ["CB"]
    assert sam.file_facts(records) == {"paired": True, "secondary": True, "duplicate": True, "unmapped": False}


def test_gtf_without_gene_lines_and_odd_separators(spark, tmp_path):
    path = tmp_path / "a.gtf"
    path.write_text('# c\n1\ts\texon\t21\t30\t.\t-\t.\tgene_id "B"; transcript_id "t"; ;gene_name "N"\n1\ts\texon\t1\t10\t.\t-\t.\tgene_id "B", transcript_id "t"\n2\ts\tgene\t5\t9\t.\t+\t.\tgene_id "A";\n')
    genes, transcripts = read_gtf(spark, str(path))
    assert {tuple(r) for r in genes.collect()} == {("B", "1", "-", 0, 30, "N"), ("A", "2", "+", 4, 9, None)}
    t = transcripts.collect()[0]
    assert [tuple(x) for x in t["exons"]] == [(0, 10), (20, 30)] and [tuple(x) for x in t["introns"]] == [(10, 20)]


def test_fasta_and_index_parameters(spark, tmp_path):
    path = tmp_path / "a.fa"
    path.write_text(">a\nACGT\nAC\n>b\nA\n")
    assert fasta_facts(spark, str(path)) == (2, 7)
    assert index_parameters(194, 3_099_750_718) == {"genomeSAindexNbases": 14, "genomeChrBinNbits": 18, "genomeSAsparseD": 3, "limitGenomeGenerateRAM": 16 << 30}
    with pytest.raises(ValueError):
        index_parameters(1, 10**9, 1 << 30)


def test_bam_files_hold_what_was_written(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        cigar, seq, quality, md, _ = random_record(rng, 0)
        rows.append(record(f"r{i}", rng.randrange(1 << 20), cigar, seq, quality, md, flag=rng.choice([0, 16]), contig=rng.choice("12"), CB="c\u00e9", NH="3", XX="007"))
    rows.append(("nowhere", 4, None, None, 0, None, None, None, {}))
    records = spark.createDataFrame(rows, RECORDS).repartition(3)
    header = ["@HD\tVN:1.6", "@SQ\tSN:2\tLN:2000000"]
    assert sam.write_bam(records, str(tmp_path / "out.bam"), header) == 3001
    again = sam.read_bam(spark, str(tmp_path / "out.bam"))
    plain = lambda r: (r["read_id"], r["flag"], r["contig"], r["start"] if r["start"] is not None and r["start"] >= 0 else None, r["mapq"], r["cigar"], r["seq"], r["quality"], r["tags"])
    assert sorted(map(repr, map(plain, again.collect()))) == sorted(map(repr, map(plain, records.collect())))
    assert sam.read_header(str(tmp_path / "out.bam")) == [*header, "@SQ\tSN:1\tLN:" + str(max(r[3] for r in rows if r[2] == "1") + 1)]
    order = [(r["contig"], r["start"]) for r in again.select("contig", "start").collect()]
    assert order[:-1] == sorted(order[:-1], key=lambda x: ("21".index(x[0]), x[1])) and order[-1][0] is None
    assert again.filter("contig = '1'").count() == sum(r[2] == "1" for r in rows)
    assert sam.write_bam(records.filter("false"), str(tmp_path / "empty.bam"), header) == 0 and sam.read_bam(spark, str(tmp_path / "empty.bam")).count() == 0


def test_bins_of_the_index():
    for start, end in ((0, 1), (16_383, 16_385), (70_000, 70_100), (1 << 26, (1 << 26) + 5), ((1 << 26) - 1, (1 << 26) + 1), (5_000_000, 6_500_000)):
        sizes = [(4681, 14), (585, 17), (73, 20), (9, 23), (1, 26)]
        want = next((first + (start >> size) for first, size in sizes if start >> size == end - 1 >> size), 0)
        assert sam._bin(start, end) == want
