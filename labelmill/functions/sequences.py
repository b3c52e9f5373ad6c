"""Bases, mismatch codes and the columns that hold them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

BASES = ("A", "C", "G", "T")
#: Mismatch codes: base of the genome, base that was read.
CONVERSIONS = tuple(x + y for x in BASES for y in BASES if x != y)
_OTHER = str.maketrans("ACGT", "TGCA")
#: Velocity classes that say nothing about splicing.
UNUSABLE_VELOCITY = ("unassigned", "ambiguous")
#: Strict lower limit of base quality for a mismatch to count; the reference method's default.
QUALITY = 27


def complement(code: str) -> str:
    """The code as seen from the other strand, base by base (not reversed)."""
    return code.translate(_OTHER)


def complement_of(code: Column) -> Column:
    return F.translate(code, "ACGT", "TGCA")


def n_col(conversion: str) -> str:
    return f"n_{conversion.lower()}"


def base_col(base: str) -> str:
    return f"base_{base.lower()}"


N_COLUMNS = [n_col(c) for c in CONVERSIONS]
BASE_COLUMNS = [base_col(b) for b in BASES]


def with_complements(conversions: Iterable[str]) -> list[str]:
    """The conversions and what they are on the other strand."""
    return sorted({d for c in conversions for d in (c, complement(c))})


def content(sequence: Column) -> list[Column]:
    """How often each base occurs in a sequence, N and case left aside; one column a base."""
    s = F.upper(sequence)
    return [(F.length(s) - F.length(F.replace(s, F.lit(b), F.lit("")))).alias(base_col(b)) for b in BASES]


def ratio(over: Column, under: Column) -> Column:
    """A quotient that is null where nothing was counted."""
    return F.try_divide(over.cast("double"), under.cast("double"))


def total(columns: Iterable[str]) -> Column:
    """Sum over columns; nulls count as 0."""
    out = F.lit(0)
    for c in columns:
        out = out + F.coalesce(F.col(c), F.lit(0))
    return out
