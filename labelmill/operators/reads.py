"""Alignment records decoded: mismatches, base contents, velocity, coverage, consensus.

Records have read_id, flag, contig, start (from 0), cigar, seq, quality (array of int), and tags
(map of strings).  CIGAR and MD are read in Python on Arrow batches, operation by operation: an
aligned stretch is a piece of text, so the work grows with the number of stretches and mismatches
of a read and not with its bases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from labelmill.functions.sequences import BASES, BASE_COLUMNS
from labelmill.functions.storage import checkpointed
from labelmill.operators import filters, intervals, votes

_CIGAR = re.compile(r"(\d+)([MIDNSHP=X])")
_MD = re.compile(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])")


@lru_cache(maxsize=1 << 14)
def stretches(cigar: str) -> tuple[tuple[tuple[int, int, int], ...], tuple[tuple[int, int], ...]]:
    """Aligned stretches (place in the read, place from the start of the alignment, length) and
    deletions (place, length)."""
    aligned, gone, i, p = [], [], 0, 0
    for n, op in _CIGAR.findall(cigar):
        n = int(n)
        if op in "M=X":
            aligned.append((i, p, n))
            i, p = i + n, p + n
        elif op == "D":
            gone.append((p, n))
            p += n
        elif op == "N":
            p += n
        elif op in "IS":
            i += n
    return tuple(aligned), tuple(gone)


class Record:
    """A record along its alignment: the bases read and those of the reference as two texts of
    equal length, of all aligned stretches one after the other."""

    __slots__ = ("start", "runs", "gone", "read", "reference", "deleted", "changed")

    def __init__(self, start: int, cigar: str, md: str, seq: str) -> None:
        self.start = start
        self.runs, self.gone = stretches(cigar or "")
        seq = (seq or "").upper()
        self.read = "".join(seq[i : i + n] for i, _, n in self.runs)
        self.deleted, self.changed = "", []
        if md.isdigit() or not md:
            self.reference = self.read
            self.deleted = "N" * sum(n for _, n in self.gone)
            return
        at, letters, gone = 0, list(self.read), []
        for same, lost, other in _MD.findall(md):
            if same:
                at += int(same)
            elif lost:
                gone.append(lost.upper())
            else:
                if at < len(letters):
                    letters[at] = other.upper()
                    self.changed.append(at)
                at += 1
        self.reference, self.deleted = "".join(letters), "".join(gone)
        self.deleted = self.deleted.ljust(sum(n for _, n in self.gone), "N")

    def segments(self) -> list[tuple[int, int]]:
        """Covered positions as half-open segments, as long as possible."""
        out: list[tuple[int, int]] = []
        for _, p, n in self.runs:
            p += self.start
            if out and out[-1][1] == p:
                out[-1] = out[-1][0], p + n
            else:
                out.append((p, p + n))
        return out

    def position(self, at: int) -> tuple[int, int]:
        """The position and the place in the read of a place in the two texts."""
        for i, p, n in self.runs:
            if at < n:
                return self.start + p + at, i + at
            at -= n
        raise IndexError(at)

    def place(self, position: int) -> int | None:
        """The place in the two texts of a covered position."""
        before = 0
        for _, p, n in self.runs:
            off = position - self.start - p
            if 0 <= off < n:
                return before + off
            before += n
        return None

    def called(self, at: int) -> bool:
        return self.read[at] != "N" and self.reference[at] != "N"

    def content(self, deleted: bool) -> list[int]:
        return [self.reference.count(b) + (self.deleted.count(b) if deleted else 0) for b in BASES]

    def mismatches(self, quality: np.ndarray) -> dict[int, tuple[str, str, int]]:
        """position -> bases of reference and read, and the quality of the latter."""
        out = {}
        for at in self.changed:
            if self.reference[at] != self.read[at] and self.called(at):
                p, i = self.position(at)
                out[p] = self.reference[at], self.read[at], int(quality[i])
        return out


def merge_pair(first: Record, first_quality: np.ndarray, second: Record, second_quality: np.ndarray, *, nasc: bool = False, deleted: bool = True) -> tuple[list[int], dict[int, tuple[str, str, int]], list[tuple[int, int]]]:
    """Content, mismatches and covered segments of two mates as of one read.

    In the overlap the later mate's mismatch counts, unless the earlier one has a mismatch of
    higher quality there; a position where the later mate has no called base keeps the earlier
    one's mismatch.  nasc: mismatches of the earlier mate within the overlap never count.
    """
    content = [a + b for a, b in zip(first.content(deleted), second.content(deleted))]
    # Bases of the earlier mate that are called count once where the later one lies as well.
    known = first.reference
    if "N" in first.read:
        known = "".join(r if b != "N" else "N" for r, b in zip(known, first.read))
    before = 0
    for _, p, n in first.runs:
        start = first.start + p
        for low, high in second.segments():
            piece = known[before + max(0, low - start) : before + max(0, min(n, high - start))]
            if piece:
                content = [c - piece.count(b) for c, b in zip(content, BASES)]
        before += n
    found = second.mismatches(second_quality)
    for p, x in first.mismatches(first_quality).items():
        at = second.place(p)
        if at is None:
            found[p] = x
        elif not nasc and (not second.called(at) or x[2] > second_quality[second.position(at)[1]]):
            found[p] = x
    segments: list[tuple[int, int]] = []
    for low, high in sorted(first.segments() + second.segments()):
        if segments and low <= segments[-1][1]:
            segments[-1] = segments[-1][0], max(high, segments[-1][1])
        else:
            segments.append((low, high))
    return content, found, segments


_ALIGNED = T.StructType([T.StructField(n, t) for n, t in (("start", T.LongType()), ("cigar", T.StringType()), ("md", T.StringType()), ("seq", T.StringType()), ("quality", T.ArrayType(T.IntegerType())))])
_SEGMENT = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.struct([("genome_i", pa.int64()), ("conversion", pa.string()), ("quality", pa.int32())])
_OUT = [T.StructField(c, T.IntegerType()) for c in BASE_COLUMNS] + [
    T.StructField("segments", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "end")]))),
    T.StructField("found", T.ArrayType(T.StructType([T.StructField("genome_i", T.LongType()), T.StructField("conversion", T.StringType()), T.StructField("quality", T.IntegerType())]))),
]


def _records(column: pa.StructArray) -> Iterator[tuple[Record, np.ndarray] | None]:
    """Records of a column of structs, with their qualities; None for a null."""
    start, cigar, md, seq = (column.field(n).to_pylist() for n in ("start", "cigar", "md", "seq"))
    quality = column.field("quality")
    ends, values = quality.offsets.to_numpy(), quality.values.fill_null(0).to_numpy(zero_copy_only=False)
    there = column.is_valid().to_pylist()
    for i, ok in enumerate(there):
        if not ok:
            yield None
            continue
        own = values[ends[i] : ends[i + 1]]
        lacking = len(seq[i] or "") - len(own)  # qualities may be missing
        yield Record(start[i], cigar[i], md[i] or "", seq[i]), own if lacking <= 0 else np.concatenate([own, np.zeros(lacking, own.dtype)])


def _lists(parts: list[list[tuple]], kind: pa.StructType) -> pa.ListArray:
    flat = [x for part in parts for x in part]
    columns = list(zip(*flat)) if flat else [()] * kind.num_fields
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, kind[i].type) for i, c in enumerate(columns)], fields=list(kind)))


class _Decode:
    """The last two columns of a batch, both mates, as contents, segments and mismatches."""

    def __init__(self, nasc: bool, deleted: bool) -> None:
        self.nasc, self.deleted = nasc, deleted

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, segments, found = [], [], []
            for one, two in zip(_records(batch.column(batch.num_columns - 2)), _records(batch.column(batch.num_columns - 1))):
                if two is None:
                    record, quality = one
                    content, mismatches, covered = record.content(self.deleted), record.mismatches(quality), record.segments()
                else:
                    content, mismatches, covered = merge_pair(*one, *two, nasc=self.nasc, deleted=self.deleted)
                contents.append(content)
                segments.append(covered)
                found.append([(p, r + a, q) for p, (r, a, q) in sorted(mismatches.items())])
            bases = np.array(contents, np.int32).reshape(-1, len(BASES))
            new = [*(pa.array(bases[:, i]) for i in range(len(BASES))), _lists(segments, _SEGMENT), _lists(found, _FOUND)]
            names = batch.schema.names[:-2] + [f.name for f in _OUT]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *new], names=names)


def _aligned(tags: str = "tags") -> Column:
    """What decoding needs of a record."""
    return F.struct(F.col("start").cast("long").alias("start"), "cigar", F.try_element_at(tags, F.lit("MD")).alias("md"), "seq", F.coalesce(F.col("quality").cast("array<int>"), F.array().cast("array<int>")).alias("quality"))


def decode_reads(records: DataFrame, *, paired: bool | None = None, nasc: bool = False, deleted: bool = True) -> DataFrame:
    """Reads (pairs as one) with base contents, covered segments and mismatches.

    Every unpaired record is a read, supplementary and repeated ones too; none of them is shuffled.
    The paired records of one read_id, HI tag and contig are put in order (start, flag, then their
    other values) and paired two by two; an odd last one has no mate and is dropped.  So n repeats
    of an unpaired read give n reads, and a pair delivered twice gives two, of which, mates of one
    start being neighbours in the order, each may hold one mate twice.  `part` tells reads of one
    read_id and HI apart.  Of two mates the one that starts further left (then the first mate) is
    the earlier one.  `deleted`: bases of the reference that a read lacks count in its content.
    paired: whether all (True) or no (False) records are paired, where that is known.
    """
    tag = lambda t, d: F.coalesce(F.try_element_at("tags", F.lit(t)).try_cast("int"), F.lit(d))
    pair = F.col("flag").bitwiseAND(F.lit(filters.PAIRED)) != 0
    facts = ["read_id", "aln_index", "part", "contig", "flag", "tags", "score", "start"]
    rows = records.select("read_id", tag("HI", 1).alias("aln_index"), "contig", F.col("flag").cast("int").alias("flag"), "tags", tag("AS", 0).alias("score"), F.col("start").cast("long").alias("start"), _aligned().alias("mate_"), pair.alias("pair_"))
    parts = []
    if paired is not True:
        # Numbers above those of pairs; they hold for as long as the result is kept.
        number = F.monotonically_increasing_id() + F.lit(1 << 62)
        parts.append(rows.filter(~F.col("pair_")).withColumn("part", number).select(*facts, F.col("mate_").alias("one"), F.lit(None).cast(_ALIGNED).alias("two")))
    if paired is not False:
        # Both windows need one order; tags are compared only between records that are else the same.
        key = W.partitionBy("read_id", "aln_index", "contig")
        own = key.orderBy("start", "flag", "mate_", F.array_sort(F.map_entries("tags")))
        mates = rows.filter("pair_").withColumn("in_", F.row_number().over(own)).withColumn("next_", F.lead(F.struct("flag", "tags", "score", "mate_")).over(own))
        mates = mates.filter("in_ % 2 = 1 and next_ is not null").withColumn("part", F.col("in_").cast("long"))
        later = [F.col(f"next_.{c}").alias(c) if c in ("flag", "tags") else F.greatest("score", "next_.score").alias(c) if c == "score" else F.col(c) for c in facts]
        parts.append(mates.select(*later, F.col("mate_").alias("one"), F.col("next_.mate_").alias("two")))
    reads = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return reads.mapInArrow(_Decode(nasc, deleted), T.StructType([*reads.schema.fields[:-2], *_OUT]))


def countable(records: DataFrame, *, umi_tag: str | None = None, barcode_tag: str | None = None, gene_tag: str | None = "GX", barcodes: DataFrame | None = None, velocity: bool = True) -> DataFrame:
    """Records that counts and coverage are made of: the same for both, so that mates pair alike."""
    kept = filters.proper_pairs(filters.primary_alignments(records, filters.required_tags(umi_tag, barcode_tag, gene_tag, velocity)))
    if not barcode_tag:
        return kept
    return filters.known_barcodes(kept.withColumn("barcode_", F.try_element_at("tags", F.lit(barcode_tag))), barcodes, "barcode_").drop("barcode_")


def parse_reads(records: DataFrame, genes: DataFrame, transcripts: DataFrame | None, *, strand: str = "forward", umi_tag: str | None = None, barcode_tag: str | None = None, gene_tag: str | None = "GX", barcodes: DataFrame | None = None, nasc: bool = False, velocity: bool = True, strict: bool = True, paired: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Alignments and mismatches of mapped records.

    A read's gene is its gene tag; with velocity, a read without tag gets the one gene of its
    strand that holds it and of which it touches an exon or an intron, and reads with none or
    several are dropped.  Missing barcodes and UMIs are null.  A read is told by read_id, aln_index
    and part (see decode_reads) in both tables.
    """
    kept = countable(records, umi_tag=umi_tag, barcode_tag=barcode_tag, gene_tag=gene_tag, barcodes=barcodes, velocity=velocity)
    reads = decode_reads(kept, nasc=nasc, paired=paired)
    tag = lambda t: F.try_element_at("tags", F.lit(t)) if t else F.lit(None).cast("string")
    reads = reads.withColumn("barcode", tag(barcode_tag)).withColumn("umi", tag(umi_tag)).withColumn("gx", F.nullif(tag(gene_tag), F.lit("")))
    reads = reads.withColumn("transcriptome", F.col("gx").isNotNull()).withColumn("strand", votes.read_strand(F.col("flag"), strand))
    key = ["read_id", "aln_index", "part"]
    if velocity and transcripts is not None:
        # Decoded once, though the reads with and without a gene of their own part ways below.
        placed = checkpointed(reads.withColumn("start", F.col("segments")[0]["start"]).withColumn("end", F.try_element_at("segments", F.lit(-1))["end"]).drop("tags"))
        tagged = placed.filter("gx is not null")
        free = placed.filter("gx is null").select(*key, "contig", "start", "end", "strand", "segments")
        near = intervals.containing_genes(free, genes).select(*key, "segments", F.col("gene").alias("gx"))
        touches = near.join(transcripts, "gx").filter(intervals.overlaps(F.col("segments"), F.concat("exons", "introns")))
        only = touches.groupBy(*key).agg(F.count_distinct("gx").alias("n_"), F.min("gx").alias("gene_")).filter("n_ = 1").drop("n_")
        placed = tagged.unionByName(placed.filter("gx is null").join(only, key).withColumn("gx", F.col("gene_")).drop("gene_"))
        classes = intervals.velocity_of(placed, transcripts, key, strict)
        reads = placed.join(classes, key).drop("segments", "end")
    else:
        reads = reads.filter("gx is not null").withColumn("velocity", F.lit("unassigned"))
    # Both tables come from the same reads, with the same numbers.
    reads = checkpointed(reads.select(*key, "contig", "barcode", "umi", "gx", *BASE_COLUMNS, "velocity", "transcriptome", "score", "found"))
    alignments = reads.select("read_id", "aln_index", "barcode", "umi", "gx", *BASE_COLUMNS, "velocity", "transcriptome", "score", "part")
    found = reads.select(*key, "contig", F.explode("found").alias("f")).select("read_id", "aln_index", "contig", "f.genome_i", "f.conversion", "f.quality", "part")
    return alignments, found


def read_positions(records: DataFrame, paired: bool | None = None) -> DataFrame:
    """read_id, aln_index, contig and covered segments, mates as one; for coverage."""
    return decode_reads(records, paired=paired).select("read_id", "aln_index", "contig", "segments")


def consensus_read(position: np.ndarray, ref: list[str], sums: np.ndarray, quality: int = 27) -> tuple[int, str, list[int], str, str, int]:
    """One read from the votes of a group: start, sequence, qualities, CIGAR, MD and number of mismatches.

    position: sorted positions that any read covers; ref: the base of the reference at each; sums:
    a column for each base, the summed quality with which it was read there (none: deleted).
    Stretches that no read covers are gaps, however long.
    """
    best = sums.max(axis=1)
    known = np.array([BASES.index(r) if r in BASES else -1 for r in ref])
    tied = sums == best[:, None]
    base = np.where((best < quality) | ((known >= 0) & tied[np.arange(len(known)), known]), known, tied.argmax(axis=1))
    there = best > 0
    ops: list[list] = []
    gaps = np.diff(position, prepend=position[0] - 1) - 1
    edge = np.flatnonzero((gaps > 0) | (np.diff(there, prepend=~there[:1]) != 0))
    for at, end in zip(edge, [*edge[1:], len(position)]):
        if gaps[at]:
            ops.append([int(gaps[at]), "N"])
        ops.append([int(end - at), "M" if there[at] else "D"])
    md, run, after_gap, last = [], 0, False, 0
    differs = there & (base != known)
    for at in np.flatnonzero(differs | ~there):
        if at > last:
            run, after_gap = run + int(at - last), False
        last = at + 1
        if there[at]:
            md.append(f"{run}{ref[at]}")
            run, after_gap = 0, False
        else:
            md.append(ref[at] if after_gap else f"{run}^{ref[at]}")
            run, after_gap = 0, True
    md.append(str(run + len(position) - last))
    seq = "".join(ref[i] if k < 0 else BASES[k] for i, k in enumerate(base) if there[i])
    return int(position[0]), seq, np.minimum(best[there], votes.MOST_QUALITY).tolist(), "".join(f"{n}{op}" for n, op in ops), "".join(md), int(differs.sum())


class _Votes:
    """Every base of the records in the last column of a batch as a row."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, position, ref, base, qualities = [], [], [], [], []
            for i, (record, quality) in enumerate(_records(batch.column(batch.num_columns - 1))):
                where = [np.arange(p, p + n) + record.start for _, p, n in record.runs]
                own = [quality[a : a + n] for a, _, n in record.runs]
                lost = [np.arange(p, p + n) + record.start for p, n in record.gone]
                size, gone = len(record.read), sum(map(len, lost))
                row.append(np.full(size + gone, i))
                position += [*where, *lost]
                ref.append(record.reference + record.deleted[:gone])
                base.append(record.read + "-" * gone)
                qualities += [*own, np.zeros(gone, np.int32)]
            letters = lambda parts: np.frombuffer("".join(parts).encode("ascii", "replace"), "S1")
            join = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts]).astype(kind)
            r, b = letters(ref), letters(base)
            keep = np.flatnonzero((r != b"N") & (b != b"N"))
            text = lambda x, none=None: pa.array(x[keep].astype("U1"), pa.string(), mask=None if none is None else x[keep] == none)
            kept = batch.select(range(batch.num_columns - 1)).take(pa.array(join(row, np.int64)[keep]))
            new = [pa.array(join(position, np.int64)[keep]), text(r), text(b, b"-"), pa.array(join(qualities, np.int32)[keep])]
            yield pa.RecordBatch.from_arrays([*kept.columns, *new], names=[*kept.schema.names, "position", "ref", "base", "base_quality"])


def base_votes(records: DataFrame, keys: list[str]) -> DataFrame:
    """Every aligned base of every record as a row: keys, position, ref, base (null: deleted) and
    base_quality.  Bases of which either side is N and insertions are left out."""
    own = records.select(*keys, _aligned().alias("mate_"))
    new = [T.StructField("position", T.LongType()), T.StructField("ref", T.StringType()), T.StructField("base", T.StringType()), T.StructField("base_quality", T.IntegerType())]
    return own.mapInArrow(_Votes(), T.StructType([*own.schema.fields[:-1], *new]))


_CALLED = [("start", T.LongType()), ("seq", T.StringType()), ("quality", T.ArrayType(T.IntegerType())), ("cigar", T.StringType()), ("md", T.StringType()), ("mismatches", T.IntegerType())]


class _Call:
    """The consensus read of the sorted votes in the last column of a batch."""

    def __init__(self, quality: int) -> None:
        self.quality = quality

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.string(), pa.int32()]
        for batch in batches:
            rows = batch.column(batch.num_columns - 1)
            ends, flat = rows.offsets.to_numpy(), rows.values
            position, ref = flat.field("position").to_numpy(), flat.field("ref").to_pylist()
            sums = np.stack([flat.field(b).to_numpy() for b in BASES], axis=1) if len(flat) else np.empty((0, len(BASES)))
            out = [consensus_read(position[a:b], ref[a:b], sums[a:b], self.quality) for a, b in zip(ends, ends[1:])]
            new = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], *[n for n, _ in _CALLED]])


def call_consensus(records: DataFrame, genes: DataFrame, *, strand: str = "forward", quality: int = 27, names: bool = False) -> DataFrame:
    """One read for each molecule: gene, barcode and UMI (records with barcode, umi, gx columns).

    Votes are summed by Spark for each position first, so what a group gathers is one row for each
    position that any of its reads covers.  names: also the ids and HI tags of its reads, which
    makes a row of a molecule as large as all its ids.
    """
    keys = ["contig", "gx", "barcode", "umi"]
    own = records.withColumn("score", F.coalesce(F.try_element_at("tags", F.lit("AS")).try_cast("int"), F.lit(0))).withColumn("end", F.col("start") + 1)
    facts = votes.group_facts(own.withColumn("hit", F.coalesce(F.try_element_at("tags", F.lit("HI")), F.lit("1"))), keys, names="hit" if names else None)
    sums = base_votes(records, keys).groupBy(*keys, "position").agg(F.min("ref").alias("ref"), *[F.sum(F.when(F.col("base") == b, F.col("base_quality")).otherwise(0)).alias(b) for b in BASES])
    gathered = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("position", "ref", *BASES))).alias("columns_"))
    called = gathered.mapInArrow(_Call(quality), T.StructType([*gathered.schema.fields[:-1], *[T.StructField(n, t) for n, t in _CALLED]]))
    known = genes.select("gx", F.col("strand").alias("gene_strand"), F.coalesce(F.nullif("gene_name", F.lit("")), "gx").alias("gn"))
    more = ["names", "hits"] if names else []
    same = F.lit(True)
    for k in keys:
        same = same & called[k].eqNullSafe(facts[k])
    joined = called.join(facts.select(*keys, "score", "n_reads", "name", *more), same).select(*[called[c] for c in called.columns], "score", "n_reads", "name", *more).join(known, "gx", "left")
    reverse = votes.consensus_strand(F.col("gene_strand"), strand) == "-"
    return joined.withColumn("flag", F.when(reverse, filters.REVERSE).otherwise(0)).drop("gene_strand")
