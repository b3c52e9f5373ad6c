"""Problem 2: the most frequent values among very many, in bounded memory.

Misra-Gries summaries of `k` counters: when more than k values have a counter, the (k+1)-th
largest counter is subtracted from all and those that reach zero are dropped.  Each subtraction of
d removes at least (k+1)*d from the sum of the counters, so a counter is below the true number of
rows by no more than the sum of the subtractions, which is at most rows / (k+1); every value with
more rows than that has a counter.  Summaries of partitions are merged by the same step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from labelmill.functions.names import free_name
from labelmill.llm.trees import merge_up

#: Rows of a partition that are counted exactly before they go into its summary.
_BLOCK = 1 << 18


def cut_to(counts: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Counters after subtracting the (k+1)-th largest one, and what was subtracted."""
    if len(counts) <= k:
        return counts, 0
    cut = int(np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1])
    return counts - cut, cut


class _Summaries:
    """The summary of a partition, as rows: slot, head, cnt, cut and the value's columns.

    The head row holds the number of all rows in cnt and the sum of the subtractions in cut.
    """

    def __init__(self, k: int, names: list[str]) -> None:
        self.k, self.names = k, names

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary: pa.Table | None = None
        cut = rows = waiting = 0
        block: list[pa.RecordBatch] = []
        schema = None

        def absorb() -> None:
            nonlocal summary, cut, block, waiting
            if not block:
                return
            new = pa.Table.from_batches(block)
            for n in self.names:
                new = new.filter(pc.is_valid(new[n]))
            counted = new.group_by(self.names).aggregate([([], "count_all")]).rename_columns([*self.names, "cnt"])
            if summary is not None:
                counted = pa.concat_tables([summary, counted]).group_by(self.names).aggregate([("cnt", "sum")]).rename_columns([*self.names, "cnt"])
            left, d = cut_to(counted["cnt"].to_numpy(), self.k)
            summary = counted.set_column(len(self.names), "cnt", pa.array(left, pa.int64())).filter(pa.array(left > 0)) if d else counted
            cut += d
            block, waiting = [], 0

        for batch in batches:
            schema = batch.schema
            rows += batch.num_rows
            waiting += batch.num_rows
            block.append(batch)
            if waiting >= _BLOCK:
                absorb()
        absorb()
        if schema is None:
            return
        number = TaskContext.get().partitionId()
        m = summary.num_rows
        head = pa.Table.from_arrays([pa.array([number]), pa.array([True]), pa.array([rows]), pa.array([cut]), *[pa.nulls(1, schema.field(n).type) for n in self.names]], names=["slot", "head", "cnt", "cut", *self.names])
        body = pa.Table.from_arrays([pa.array(np.full(m, number)), pa.array(np.zeros(m, bool)), summary["cnt"], pa.array(np.zeros(m, np.int64)), *[summary[n] for n in self.names]], names=head.column_names)
        yield from pa.concat_tables([head, body.cast(head.schema)]).combine_chunks().to_batches()


class _Add:
    def __init__(self, k: int, names: list[str]) -> None:
        self.k, self.names = k, names

    def __call__(self, rows: pa.Table, level: int = 0, parent: int = 0) -> pa.Table:
        heads, body = rows.filter(rows["head"]), rows.filter(pc.invert(rows["head"]))
        body = body.group_by(self.names).aggregate([("cnt", "sum")])
        counts, d = cut_to(body["cnt_sum"].to_numpy(), self.k)
        body, counts = body.filter(pa.array(counts > 0)), counts[counts > 0]
        m = len(counts)
        columns = {"slot": pa.nulls(m + 1, pa.int64()), "head": pa.array([True] + [False] * m), "cnt": pa.array([pc.sum(heads["cnt"]).as_py(), *counts.tolist()], pa.int64()), "cut": pa.array([pc.sum(heads["cut"]).as_py() + d] + [0] * m, pa.int64())}
        for name in self.names:
            kind = rows.schema.field(name).type
            columns[name] = pa.chunked_array([pa.nulls(1, kind), *body[name].chunks], kind)
        return pa.table(columns).select(rows.column_names)


def summaries(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """A Misra-Gries summary of at most k counters for each partition of df (columns v0, v1, ...)."""
    if k < 1:
        raise ValueError("a summary has a counter at least")
    own = df.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])
    head = [T.StructField("slot", T.LongType()), T.StructField("head", T.BooleanType()), T.StructField("cnt", T.LongType()), T.StructField("cut", T.LongType())]
    return own.mapInArrow(_Summaries(k, own.columns), T.StructType([*head, *own.schema.fields]))


def frequent_values(df: DataFrame, columns: list[str], k: int, share: float = 0.0) -> DataFrame:
    """Values of `columns` taken together with their approximate numbers of rows.

    Gives the columns, rows_at_least (the counter), rows_at_most (counter and all subtractions)
    and all_rows (rows of df).  Every value with more than all_rows / (k+1) rows is there, and with
    `share` only values that may have that share of all rows stay.  Rows with a null in one of the
    columns hold no value but count in all_rows.  An empty table gives no rows.
    """
    names = [f"v{i}" for i in range(len(columns))]
    one = merge_up(summaries(df, columns, k), "slot", [], _Add(k, names))
    head = one.filter("head").select(F.col("cnt").alias("all_rows"), F.col("cut").alias("all_cut"))
    # The head is a single row.
    body = one.filter("not head").join(F.broadcast(head), F.col("cnt") + F.col("all_cut") >= F.lit(share) * F.col("all_rows"))
    out = [F.col(n).alias(c) for n, c in zip(names, columns)]
    taken = list(columns)
    for name, value in (("rows_at_least", F.col("cnt")), ("rows_at_most", F.col("cnt") + F.col("all_cut")), ("all_rows", F.col("all_rows"))):
        taken.append(free_name(name, taken))
        out.append(value.alias(taken[-1]))
    return body.select(*out)
