"""Sequencing technologies, strandedness, and arguments of the external aligner."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Technology:
    """Where barcode and UMI lie in their read (start, length), and the protocol's strand."""

    name: str
    barcode: tuple[int, int] | None
    umi: tuple[int, int] | None
    strand: str
    arguments: dict = field(default_factory=dict)


#: Layouts of the public protocols; fixed values.
TECHNOLOGIES = {
    t.name: t
    for t in (
        Technology("dropseq", (0, 12), (12, 8), "forward"),
        Technology("scifate", (0, 18), (8, 8), "forward"),
        Technology("10xv2", (0, 16), (16, 10), "forward"),
        Technology("10xv3", (0, 16), (16, 12), "forward"),
        Technology("smartseq", None, None, "unstranded", {"--soloUMIdedup": "Exact", "--outSAMattributes": ["RG"]}),
    )
}

_STRAND = re.compile(r"--(?:read|solo)Strand(?:=| +)(Forward|Reverse|Unstranded)")


def technologies(spark: SparkSession) -> DataFrame:
    rows = [(t.name, *(t.barcode or (None, None)), *(t.umi or (None, None)), t.strand) for t in TECHNOLOGIES.values()]
    return spark.createDataFrame(rows, "name string, barcode_start int, barcode_length int, umi_start int, umi_length int, strand string")


def detect_strand(header: list[str]) -> str | None:
    """Strand option of the aligner's command line in the @PG lines of a header; None if not told."""
    for line in header:
        fields = dict(f.split(":", 1) for f in line.rstrip("\n").split("\t")[1:] if ":" in f)
        if line.startswith("@PG") and fields.get("PN") == "STAR" and (m := _STRAND.search(fields.get("CL", ""))):
            return m[1].lower()
    return None


def merge_arguments(first: dict, second: dict) -> dict:
    """Both; of an argument in both, lists are joined and other values taken from the second."""
    out = {k: list(v) if isinstance(v, list) else v for k, v in first.items()}
    for k, v in second.items():
        out[k] = out[k] + v if isinstance(v, list) and isinstance(out.get(k), list) else v
    return out


def argument_list(arguments: dict) -> list[str]:
    return [str(x) for k, v in arguments.items() for x in (k, *(v if isinstance(v, list) else [v]))]


def parse_overrides(text: str) -> dict:
    """`--name value value ...` as arguments; negative numbers are values."""
    out: dict[str, list[str]] = {}
    name = None
    for word in text.strip("'\"").split():
        if word.startswith("-") and not re.fullmatch(r"-?[0-9.]+(e-?[0-9]+)?", word):
            name = word
            out.setdefault(name, [])
        elif name is not None:
            out[name].append(word)
    return {k: v[0] if len(v) == 1 else v for k, v in out.items()}
