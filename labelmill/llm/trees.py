"""Merging one state per input partition into one state, with a bounded number in any task."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: States that one task merges.
FAN_IN = 128


def parents(partitions: int, fan_in: int) -> list[int]:
    """Number of merged states after each level, the last being 1, so that every task of every
    level takes at most `fan_in` states of the level before."""
    if fan_in < 2:
        raise ValueError("a task merges two states at least")
    out = [-(-max(1, partitions) // fan_in)]
    while out[-1] > 1:
        out.append(-(-out[-1] // fan_in))
    return out


def merge_up(states: DataFrame, slot: str, groups: list[str], merge: Callable, fan_in: int = FAN_IN, partitions: int | None = None) -> DataFrame:
    """`states` merged along a tree; `slot` numbers the partitions and is 0 at the root.

    merge takes an Arrow table with all rows of some states of one group, the level (0 at the
    leaves) and the number of the parent within its level, and gives the rows of one state with
    the same columns.  There are as many levels as the number of partitions needs; it is asked of
    the plan unless it is given (of a plan with a shuffle that runs the stages before it).
    """
    for level, n in enumerate(parents(partitions or states.rdd.getNumPartitions(), fan_in)):
        states = states.withColumn("parent", F.pmod(F.col(slot), F.lit(n)).cast("long"))
        states = states.groupBy(*groups, "parent").applyInArrow(_step(merge, slot, level), states.drop("parent").schema)
    return states


def _step(merge: Callable, slot: str, level: int) -> Callable:
    """merge over one group; afterwards the states carry the number of their parent."""

    def step(rows: pa.Table) -> pa.Table:
        parent = rows["parent"][0].as_py()
        out = merge(rows.drop_columns(["parent"]), level, parent)
        at = out.column_names.index(slot)
        return out.set_column(at, slot, pa.array([parent] * out.num_rows, pa.int64()))

    return step
