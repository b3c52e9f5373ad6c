"""Alignment records from SAM text and from BAM files, and both as output.

A BAM file, or a folder of them, is read by `spark.read.format("bam")` after `register(spark)`.  A
file with a .bai index beside it is split at the record starts that the index names; one without
is a single partition.  Files lie on any file system that all executors reach: paths with a scheme
are opened by Arrow, others on the machine's own file system.
"""

from __future__ import annotations

import gzip
import io
import os
import re
import struct
import zlib
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

SCHEMA = "read_id string, flag int, contig string, start bigint, mapq int, cigar string, seq string, quality array<int>, tags map<string,string>"
_OPS, _LETTERS = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
_NUMBERS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Records of SAM text; unmapped places and missing sequences are null."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("@") & (F.col("value") != ""))
    p = F.split("value", "\t")
    tags = F.transform(F.slice(p, 12, F.greatest(F.size(p) - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.substring(t, 6, 1 << 30)))
    quality = F.when(p[10] != "*", F.transform(F.split(p[10], ""), lambda c: F.ascii(c) - 33))
    text = lambda i: F.nullif(p[i], F.lit("*"))
    return lines.select(p[0].alias("read_id"), p[1].cast("int").alias("flag"), text(2).alias("contig"), (p[3].cast("long") - 1).alias("start"), p[4].cast("int").alias("mapq"), text(5).alias("cigar"), text(9).alias("seq"), quality.alias("quality"), F.map_from_entries(tags).alias("tags"))


def sam_lines(records: DataFrame) -> DataFrame:
    """Records as lines of SAM text; tags are written as strings, whole numbers as such."""
    tags = F.transform(F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>"))), lambda e: F.concat(e["key"], F.when(e["value"].rlike("^-?[0-9]+$"), ":i:").otherwise(":Z:"), e["value"]))
    quality = F.coalesce(F.nullif(F.array_join(F.transform("quality", lambda q: F.char(q + 33)), ""), F.lit("")), F.lit("*"))
    star = lambda c: F.coalesce(F.col(c), F.lit("*"))
    fixed = ["read_id", F.col("flag").cast("string"), star("contig"), (F.coalesce("start", F.lit(-1)) + 1).cast("string"), F.coalesce("mapq", F.lit(255)).cast("string"), star("cigar"), F.lit("*"), F.lit("0"), F.lit("0"), star("seq"), quality]
    return records.select(F.concat_ws("\t", *fixed, tags).alias("value"))


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def _open(path: str) -> IO[bytes]:
    """A file to read at any place."""
    if "://" not in path:
        return open(path, "rb")
    system, own = _place(path)
    return system.open_input_file(own)


def _exists(path: str) -> bool:
    system, own = _place(path)
    return system.get_file_info(own).type != fs.FileType.NotFound


def _bam_files(path: str) -> list[str]:
    """The file itself, or the BAM files of a folder."""
    system, own = _place(path)
    if system.get_file_info(own).type != fs.FileType.Directory:
        return [path]
    names = [x.base_name for x in system.get_file_info(fs.FileSelector(own))]
    return [f"{path.rstrip('/')}/{n}" for n in sorted(names) if n.endswith(".bam") and not n.startswith((".", "_"))]


class _Blocks:
    """Bytes of a block-compressed file from a virtual offset on."""

    def __init__(self, path: str, offset: int = 0) -> None:
        self.file = _open(path)
        self.block, self.at, self.data = offset >> 16, 0, b""
        self._load(self.block)
        self.at = offset & 0xFFFF

    def _load(self, place: int) -> bool:
        self.file.seek(place)
        head = self.file.read(12)
        if len(head) < 12:
            self.data, self.at, self.block = b"", 0, place
            return False
        extra = self.file.read(struct.unpack("<H", head[10:12])[0])
        i, size = 0, None
        while i < len(extra):
            n = struct.unpack("<H", extra[i + 2 : i + 4])[0]
            if extra[i : i + 2] == b"BC":
                size = struct.unpack("<H", extra[i + 4 : i + 6])[0] + 1
            i += 4 + n
        if size is None:
            raise ValueError("not a block-compressed file")
        self.data = zlib.decompress(self.file.read(size - len(extra) - 20), -15)  # 12 before the extra field, 8 after the data
        self.block, self.following, self.at = place, place + size, 0
        return True

    def tell(self) -> int:
        return self.block << 16 | self.at

    def read(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            if self.at >= len(self.data):
                if not self._load(getattr(self, "following", self.block)):
                    return out
                continue
            piece = self.data[self.at : self.at + n - len(out)]
            self.at += len(piece)
            out += piece
        if self.at >= len(self.data) and hasattr(self, "following"):
            self._load(self.following)  # the next record starts in the next block
        return out


def _header(blocks: _Blocks) -> tuple[list[str], list[str]]:
    if blocks.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    text = blocks.read(struct.unpack("<i", blocks.read(4))[0]).split(b"\0")[0].decode()
    names = []
    for _ in range(struct.unpack("<i", blocks.read(4))[0]):
        names.append(blocks.read(struct.unpack("<i", blocks.read(4))[0])[:-1].decode())
        blocks.read(4)
    return text.splitlines(), names


def read_header(path: str) -> list[str]:
    """Header lines of a BAM or SAM file, of a folder of BAM files those of the first."""
    if path.rstrip("/").endswith(".bam"):
        files = _bam_files(path)
        return _header(_Blocks(files[0]))[0] if files else []
    with _open(path) as raw:
        packed = raw.read(2) == b"\x1f\x8b"
        raw.seek(0)
        lines = []
        for line in io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if packed else raw):
            if not line.startswith("@"):
                break
            lines.append(line.rstrip("\n"))
        return lines


def header_lines(lines: list[str]) -> list[str]:
    """Header lines for records that were sorted anew."""
    kept = [x for x in lines if not x.startswith("@HD")]
    return ["@HD\tVN:1.6\tSO:coordinate", *kept]


def _tags(data: bytes) -> dict[str, str]:
    out, i = {}, 0
    while i + 3 <= len(data):
        name, kind = data[i : i + 2].decode(), chr(data[i + 2])
        i += 3
        if kind == "A":
            value, i = chr(data[i]), i + 1
        elif kind in "ZH":
            end = data.index(0, i)
            value, i = data[i:end].decode(), end + 1
        elif kind == "B":
            form = _NUMBERS[chr(data[i])]
            n, size = struct.unpack("<i", data[i + 1 : i + 5])[0], struct.calcsize(form)
            value = ",".join(str(struct.unpack_from(form, data, i + 5 + size * j)[0]) for j in range(n))
            i += 5 + size * n
        else:
            form = _NUMBERS[kind]
            value, i = str(struct.unpack_from(form, data, i)[0]), i + struct.calcsize(form)
        out[name] = value
    return out


def _record(data: bytes, names: list[str]) -> tuple:
    ref, start, n_name, mapq, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", data, 0)
    i = 32
    name = data[i : i + n_name - 1].decode()
    i += n_name
    cigar = "".join(f"{c >> 4}{_OPS[c & 15]}" for c in struct.unpack_from(f"<{n_cigar}I", data, i))
    i += 4 * n_cigar
    packed = data[i : i + (n_seq + 1) // 2]
    i += len(packed)
    seq = "".join(_LETTERS[b >> 4] + _LETTERS[b & 15] for b in packed)[:n_seq]
    quality = list(data[i : i + n_seq])
    i += n_seq
    return name, flag, names[ref] if ref >= 0 else None, start, mapq, cigar or None, seq or None, quality if quality and quality[0] != 255 else None, _tags(data[i:])


def _index_starts(path: str) -> list[int]:
    """Virtual offsets of record starts named by a .bai index, one for each 16 kb of a contig."""
    with _open(path) as f:
        data = f.read()
    if data[:4] != b"BAI\1":
        return []
    n, i, out = struct.unpack_from("<i", data, 4)[0], 8, set()
    for _ in range(n):
        bins = struct.unpack_from("<i", data, i)[0]
        i += 4
        for _ in range(bins):
            i += 8 + 16 * struct.unpack_from("<i", data, i + 4)[0]
        linear = struct.unpack_from("<i", data, i)[0]
        out.update(struct.unpack_from(f"<{linear}Q", data, i + 4))
        i += 4 + 8 * linear
    return sorted(x for x in out if x)


class _Span(InputPartition):
    def __init__(self, path: str, start: int | None, end: int | None) -> None:
        self.path, self.start, self.end = path, start, end


class BamReader(DataSourceReader):
    #: Compressed bytes of a partition.
    SPLIT = 64 << 20

    def __init__(self, path: str) -> None:
        self.path, self.contig = path, None

    def pushFilters(self, filters):  # noqa: N802
        """An equality on contig skips the records of others before they are decoded."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("contig",):
                self.contig = f.value
            yield f

    def partitions(self) -> list[_Span]:
        spans = []
        for p in _bam_files(self.path):
            index = next((x for x in (p + ".bai", p[:-4] + ".bai") if _exists(x)), None)
            cuts: list[int] = []
            for s in _index_starts(index) if index else []:
                if (s >> 16) - ((cuts[-1] >> 16) if cuts else 0) >= self.SPLIT:
                    cuts.append(s)
            edges = [None, *cuts, None]
            spans += [_Span(p, a, b) for a, b in zip(edges, edges[1:])]
        return spans

    def read(self, partition: _Span) -> Iterator[pa.RecordBatch]:
        rows = []
        if partition is None:  # a folder without files
            return
        for row in self.rows(partition):
            rows.append(row)
            if len(rows) == 4096:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    def rows(self, partition: _Span) -> Iterator[tuple]:
        blocks = _Blocks(partition.path)
        names = _header(blocks)[1]
        if partition.start is not None:
            blocks = _Blocks(partition.path, partition.start)
        wanted = names.index(self.contig) if self.contig in names else None
        if self.contig is not None and wanted is None:
            return
        while partition.end is None or blocks.tell() < partition.end:
            size = blocks.read(4)
            if len(size) < 4:
                return
            data = blocks.read(struct.unpack("<i", size)[0])
            if wanted is None or struct.unpack_from("<i", data)[0] == wanted:
                yield _record(data, names)


_KINDS = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.map_(pa.string(), pa.string())]
_NAMES = ["read_id", "flag", "contig", "start", "mapq", "cigar", "seq", "quality", "tags"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)]
    columns[-1] = [list(t.items()) for t in columns[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_NAMES)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        return BamReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("bam").load(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return read_bam(spark, path) if path.endswith(".bam") else read_sam(spark, path)


def tag_names(records: DataFrame) -> list[str]:
    """Names of the tags in all records, sorted."""
    rows = records.select(F.explode(F.map_keys("tags")).alias("t")).distinct().collect()
    return sorted(r["t"] for r in rows)


def missing_tags(records: DataFrame, tags: list[str]) -> list[str]:
    return sorted(set(tags) - set(tag_names(records)))


def file_facts(records: DataFrame) -> dict[str, bool]:
    """Whether there are paired, secondary, duplicate and unmapped records anywhere."""
    bit = lambda b: F.coalesce(F.bool_or(F.col("flag").bitwiseAND(F.lit(b)) != 0), F.lit(False))
    return records.agg(bit(0x1).alias("paired"), bit(0x100).alias("secondary"), bit(0x400).alias("duplicate"), bit(0x4).alias("unmapped")).collect()[0].asDict()


def write_sam(records: DataFrame, path: str, header: list[str]) -> None:
    """Records as SAM text in order of place: a folder of parts, of which the first has the header;
    put together in the order of their names they are one file."""
    lines = sam_lines(sorted_records(records))

    def headed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [pa.array(header)] if TaskContext.get().partitionId() == 0 and header else []
        for column in [*own, *(p.column(0) for p in parts)]:
            yield pa.RecordBatch.from_arrays([column], names=["value"])

    lines.mapInArrow(headed, "value string").write.mode("overwrite").text(path)


#: Most bytes of a block before it is compressed, and the empty block that ends a file; fixed values.
_BLOCK = 0xFF00


def _packed(data: bytes) -> bytes:
    """A block of a block-compressed file."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0"
    return head + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def _bin(start: int, end: int) -> int:
    """Number of the smallest bin of the index scheme that holds [start, end): bins of 2**14 to
    2**29 bases, eight of each size in the next one."""
    for level, size in enumerate((14, 17, 20, 23, 26)):
        if start >> size == (end - 1) >> size:
            return ((1 << (15 - 3 * level)) - 1) // 7 + (start >> size)
    return 0


def _encoded(row: dict, numbers: dict[str, int]) -> bytes:
    """A record as it stands in a BAM file."""
    ops = [(int(n), _OPS.index(op)) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", row["cigar"] or "")]
    seq, start = row["seq"] or "", row["start"] if row["start"] is not None else -1
    width = sum(n for n, op in ops if _OPS[op] in "MDN=X") or 1
    codes = [_LETTERS.index(c) if c in _LETTERS else 15 for c in seq.upper()] + [0] * (len(seq) % 2)
    quality = row["quality"] if row["quality"] is not None else [255] * len(seq)
    tags = b""
    for key, value in row["tags"] or []:
        number = re.fullmatch(r"-?[0-9]{1,9}", value) is not None and str(int(value)) == value
        tags += key.encode() + (b"i" + struct.pack("<i", int(value)) if number else b"Z" + value.encode() + b"\0")
    name = row["read_id"].encode() + b"\0"
    fixed = struct.pack("<iiBBHHHiiii", numbers.get(row["contig"], -1), start, len(name), row["mapq"] if row["mapq"] is not None else 255, _bin(max(start, 0), max(start, 0) + width), len(ops), row["flag"], len(seq), -1, -1, 0)
    body = fixed + name + b"".join(struct.pack("<I", n << 4 | op) for n, op in ops) + bytes(a << 4 | b for a, b in zip(codes[::2], codes[1::2])) + bytes(quality) + tags
    return struct.pack("<i", len(body)) + body


def write_bam(records: DataFrame, path: str, header: list[str]) -> int:
    """Records in order of place as a folder of BAM files, one for each range; gives their number.

    Contigs come in the order of the header's @SQ lines, then those it lacks.  Read ids are at most
    254 bytes, as the format has it.  A task writes its file under a name of its own and renames it
    when it is whole, so one that is run again does no harm.
    """
    named = {f[3:]: next((int(x[3:]) for x in line.split("\t") if x.startswith("LN:")), 0) for line in header if line.startswith("@SQ") for f in line.split("\t") if f.startswith("SN:")}
    more = {r["contig"]: r["end"] for r in records.filter(F.col("contig").isNotNull()).groupBy("contig").agg((F.max("start") + 1).alias("end")).collect() if r["contig"] not in named}  # a row for each contig
    lines = [*header, *[f"@SQ\tSN:{c}\tLN:{n}" for c, n in sorted(more.items())]]
    sizes = named | dict(sorted(more.items()))
    text = "".join(x + "\n" for x in lines).encode()
    head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(sizes))
    head += b"".join(struct.pack("<i", len(c.encode()) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in sizes.items())
    numbers = {c: i for i, c in enumerate(sizes)}
    system, folder = _place(path)
    if system.get_file_info(folder).type != fs.FileType.NotFound:
        system.delete_dir(folder)
    system.create_dir(folder, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, (place, own) = TaskContext.get(), _place(path)
        name = f"part-{task.partitionId():05d}.bam"
        draft, n, waiting = f"{own}/.{name}.{task.taskAttemptId()}", 0, bytearray(head)
        with place.open_output_stream(draft) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    waiting += _encoded(row, numbers)
                    n += 1
                    while len(waiting) > _BLOCK:
                        out.write(_packed(bytes(waiting[:_BLOCK])))
                        del waiting[:_BLOCK]
            out.write(_packed(bytes(waiting)) + _packed(b""))
        place.move(draft, f"{own}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    order = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for item in numbers.items() for x in item]), F.col("contig")), F.lit(len(numbers))) if numbers else F.lit(0)
    rows = records.select(*_NAMES).withColumn("order_", order)
    parts = rows.repartitionByRange("order_", "start").sortWithinPartitions("order_", "start", "read_id", "flag").drop("order_")
    n = parts.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect()[0]["n"]
    if not _bam_files(path):  # without records there are no tasks either
        with system.open_output_stream(f"{folder}/part-00000.bam") as out:
            out.write(_packed(head[:_BLOCK]) + b"".join(_packed(head[i : i + _BLOCK]) for i in range(_BLOCK, len(head), _BLOCK)) + _packed(b""))
    return n


def sorted_records(records: DataFrame) -> DataFrame:
    """Records by contig and place, over all partitions."""
    return records.orderBy("contig", "start", "read_id", "flag")
