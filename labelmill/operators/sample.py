"""Exact random subsets of counts, without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from labelmill.functions.names import free_name

#: Hex digits of the hash that are looked at in one pass: rows fall into 16**DIGITS buckets.
DIGITS, GROUP_DIGITS = 4, 3


def _hash(columns: list[Column], seed: int) -> Column:
    """A random-looking string for each row; equal in any engine that has MD5."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def _cut(rows: DataFrame, h: str, count: int | None, proportion: float | None) -> tuple[str, int | None]:
    """A beginning of hashes such that the rows wanted are those whose hash begins with it or with
    something less; or a whole hash of which only so many rows, given as well, are wanted.

    Rows are counted by bucket; the bucket in which the cut falls is looked at more closely until
    the cut lies at its end, so a pass over 16**DIGITS times more rows is one more.
    """
    begun, left = "", count
    while True:
        at = F.substring(h, len(begun) + 1, DIGITS)
        own = rows if not begun else rows.filter(F.col(h).startswith(begun))
        sizes = sorted((r["b"], r["n"]) for r in own.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most 16**DIGITS
        if left is None:
            left = int(sum(n for _, n in sizes) * proportion)
        if left <= 0:
            return "", None
        for bucket, n in sizes:
            if left <= n:
                break
            left -= n
        else:
            return "g", None  # all rows: no hash begins with anything as great
        begun += bucket
        if left == n:
            return begun, None
        if len(begun) == 32:
            return begun, left


def downsample(df: DataFrame, key: list[str], *, count: int | None = None, proportion: float | None = None, by: list[str] | None = None, seed: int = 0) -> DataFrame:
    """Exactly `count` rows, or `proportion` of the rows rounded down, at random without replacement.

    With `by`, groups of more than `count` rows are cut to `count` and others kept whole.  The rows
    are those with the least hash of `key` and seed; rows of equal key are in any order.  Without
    groups the cut is found first, by counts of buckets of the hash, and nothing is sorted; of
    groups only the one bucket each in which the cut falls is sorted.
    """
    if (count is None) == (proportion is None) or (by and count is None):
        raise ValueError("give either a count or a proportion; groups need a count")
    by = by or []
    h, b = free_name("hash_", df.columns), free_name("bucket_", df.columns)
    rows = df.withColumn(h, _hash([F.col(k) for k in key], seed))
    if not by:
        begun, ties = _cut(rows.select(h), h, count, proportion)
        start = F.substring(h, 1, len(begun))
        if ties is None:
            return rows.filter(start <= begun if begun else F.lit(False)).drop(h)
        return rows.filter(start < begun).unionByName(rows.filter(F.col(h) == begun).limit(ties)).drop(h)
    rows = rows.withColumn(b, F.substring(h, 1, GROUP_DIGITS))
    sizes = rows.groupBy(*by, b).agg(F.count(F.lit(1)).alias("n_"))
    upto = F.sum("n_").over(W.partitionBy(*by).orderBy(b))  # at most 16**GROUP_DIGITS rows a group
    cuts = sizes.withColumn("upto_", upto).withColumn("before_", F.col("upto_") - F.col("n_")).filter(F.col("before_") < count)
    cuts = cuts.select(*[F.col(k).alias(f"{k}_cut") for k in [*by, b]], (F.lit(count) - F.col("before_")).alias("left_"), "n_")
    on = F.col(b) == F.col(f"{b}_cut")
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_cut"))
    kept = rows.join(cuts, on)
    whole = kept.filter(F.col("left_") >= F.col("n_"))
    border = kept.filter(F.col("left_") < F.col("n_")).withColumn("rank_", F.row_number().over(W.partitionBy(*by, b).orderBy(h)))
    return whole.select(*df.columns).unionByName(border.filter(F.col("rank_") <= F.col("left_")).select(*df.columns))
