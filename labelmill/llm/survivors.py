"""Problem 5: one surviving row for each group of duplicates, its gaps filled by currency reasoning.

The survivor is the least row by a fixed order of trust.  A field that the survivor lacks comes
from its companions: with arrival times, the value that arrived last.  Where times are missing,
value transitions decide.  They are learned from the dated rows of all groups: the values of a
field in the order in which a group first had them, each with the one before it.  A pair that was
seen often enough, and clearly more often in one direction, gives a precedence, which is closed
transitively; values that would precede each other mutually, on a cycle, have none.

Within a group, dated values are ordered by time, and an undated value comes after a dated one that
precedes it.  Of the undated values that come after the newest dated one (all of them, if there is
none) the topologically latest is taken: none of the others comes after it.  If none comes after
it, the newest dated value stands.

Everything about a group is kept in aggregates that combine before the shuffle, so a group of any
size ends up as one row and no group is ever gathered.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from labelmill.functions.names import free_name

#: A pair of values counts from so many transitions on, and if one direction is so many times the other.
SUPPORT, MARGIN = 30, 2.0
#: More pairs of a field than this are refused with an error: such a field is no category.  Their
#: closure, which the driver makes and the plan holds, has no more than this many values squared.
MAX_PAIRS = 2_000


@dataclass(frozen=True)
class Currency:
    """after[a]: the values that come after a, learned for one field; values as strings."""

    field: str
    after: dict[str, frozenset[str]]

    @property
    def values(self) -> list[str]:
        return sorted(self.after)

    def depth(self, value: str) -> int:
        """How many values come before it: more than before any of these, so of some values one of
        the greatest depth has none of the others after it."""
        return sum(value in later for later in self.after.values())


def close_precedence(pairs: set[tuple[str, str]]) -> dict[str, frozenset[str]]:
    """All values with those reached from them and from which they are not reached."""
    direct: dict[str, set[str]] = {}
    for a, b in pairs:
        direct.setdefault(a, set()).add(b)
        direct.setdefault(b, set())
    reached = {}
    for a in direct:
        seen, todo = set(), list(direct[a])
        while todo:
            b = todo.pop()
            if b not in seen:
                seen.add(b)
                todo += direct[b]
        reached[a] = seen
    return {a: frozenset(b for b in seen if a not in reached[b]) for a, seen in reached.items()}


def transitions(df: DataFrame, keys: list[Column], fields: list[str], time: str) -> DataFrame:
    """field (its number), a, b and n: in how many groups b was the next value to appear after a.

    Only rows with a time count.  Rows of a group that have the same values are one before they are
    shuffled.  Of values that appeared at one moment the least follows and the greatest precedes.
    """
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    rows = df.select(F.xxhash64(*keys).alias("group"), moment.alias("t"), *[F.col(f).cast("string").alias(f"v{i}") for i, f in enumerate(fields)]).filter("t is not null")
    known = [f"v{i}" for i in range(len(fields))]
    first = rows.groupBy("group", *known).agg(F.min("t").alias("t")).repartition("group")
    each = first.select("group", "t", F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(v).alias("v")) for i, v in enumerate(known)])).alias("p")).filter("p.v is not null")
    each = each.groupBy("group", "p.field", "p.v").agg(F.min("t").alias("t"))
    order = W.partitionBy("group", "field").orderBy("t", "v")
    moved = each.select("field", F.lag("v").over(order).alias("a"), F.col("v").alias("b"), F.lag("t").over(order).alias("s"), "t").filter("s < t")
    return moved.groupBy("field", "a", "b").agg(F.count(F.lit(1)).alias("n"))


def learn_currency(df: DataFrame, keys: list[Column], fields: list[str], time: str, support: int = SUPPORT, margin: float = MARGIN) -> dict[str, Currency]:
    """The precedence of the values of each field, from all groups.

    Only pairs with a clear direction reach the driver; a field with more than MAX_PAIRS of them
    raises an error.
    """
    if not fields:
        return {}
    a, b, n = F.least("a", "b"), F.greatest("a", "b"), F.col("n")
    sides = transitions(df, keys, fields, time).groupBy("field", a.alias("a"), b.alias("b")).agg(F.sum(F.when(F.col("a") < F.col("b"), n).otherwise(0)).alias("there"), F.sum(F.when(F.col("a") > F.col("b"), n).otherwise(0)).alias("back"))
    clear = F.greatest("there", "back") >= F.lit(margin) * F.least("there", "back")
    pairs = sides.filter((F.col("there") + F.col("back") >= support) & clear).select("field", F.when(F.col("there") > F.col("back"), F.col("a")).otherwise(F.col("b")).alias("a"), F.when(F.col("there") > F.col("back"), F.col("b")).otherwise(F.col("a")).alias("b"))
    found: dict[int, set[tuple[str, str]]] = {i: set() for i in range(len(fields))}
    # If rows are left out here, some field has more than MAX_PAIRS, which is refused below.
    for r in pairs.limit(MAX_PAIRS * len(fields) + 1).collect():
        found[r["field"]].add((r["a"], r["b"]))
    for i, f in enumerate(fields):
        if len(found[i]) > MAX_PAIRS:
            raise ValueError(f"`{f}` has too many values to be a category")
    return {f: Currency(f, close_precedence(found[i])) for i, f in enumerate(fields) if found[i]}


def latest_value(field: str, time: str, currency: Currency | None, like: str) -> list[tuple[str, Column]]:
    """Aggregates from which `resolve_latest` takes the topologically latest value of a field.

    The newest value is the greatest undated one where no value is dated, as nulls come first.
    The set of undated values holds only those of the precedence, however large the group is.
    """
    value, moment = F.col(field), F.unix_micros(F.col(time).cast("timestamp"))
    parts = [(f"{like}_newest", F.max(F.when(value.isNotNull(), F.struct(moment.alias("t"), value.alias("v")))))]
    if currency:
        parts.append((f"{like}_open", F.collect_set(F.when(moment.isNull() & value.cast("string").isin(currency.values), value.cast("string")))))
    return parts


def resolve_latest(kind: str, currency: Currency | None, like: str) -> Column:
    """The newest dated value, unless an undated one comes after it; see the module's text.

    Without any dated value, undated values that no precedence mentions only count when there is
    nothing else (then the greatest is taken).  Of several latest values the greatest is taken.
    """
    newest = F.col(f"{like}_newest.v")
    if not currency:
        return newest
    timed = F.when(F.col(f"{like}_newest.t").isNotNull(), newest)
    known = currency.values
    after = F.create_map(*[x for v in known for x in (F.lit(v), F.array(*map(F.lit, sorted(currency.after[v]))).cast("array<string>"))])
    depth = F.create_map(*[x for v in known for x in (F.lit(v), F.lit(currency.depth(v)))])
    later = F.coalesce(F.try_element_at(after, timed.cast("string")), F.array().cast("array<string>"))
    candidates = F.when(timed.isNull(), F.col(f"{like}_open")).otherwise(F.array_intersect(f"{like}_open", later))
    latest = F.array_max(F.transform(candidates, lambda v: F.struct(F.try_element_at(depth, v).alias("d"), v.alias("v"))))
    return F.coalesce(latest["v"].cast(kind), newest)


def best_representatives(df: DataFrame, keys: dict[str, Column], order: list[Column | str], keep: list[str], fill: list[str], categories: list[str], time: str, *, least: int = 1, support: int = SUPPORT, margin: float = MARGIN) -> DataFrame:
    """One row for each group of at least `least` rows.

    keys: output name -> expression; rows with a null key belong to no group.  order: the survivor
    is the row with the least tuple of these, nulls first; a name stands for that column.  keep:
    columns of the survivor as they are.  fill: columns of the survivor whose nulls are filled,
    and given as `<name>`; the categories among them by currency reasoning, the others by the
    newest value (undated values only if no dated one exists, then the greatest).  Also given:
    n_rows, and filled, the names of the fields that came from companions.  Copies of a row count
    as rows.  If several rows are equal in all of `order`, the one of the least kept and filled
    values survives, nulls first.  Precedence is learned only if a category is to be filled.
    """
    own = df.select(*[e.alias(f"key_{k}") for k, e in keys.items()], *dict.fromkeys([*keep, *fill, time]), F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]).alias("order_"))
    own = own.filter(reduce(lambda a, b: a & b, [F.col(f"key_{k}").isNotNull() for k in keys]))
    cols = [F.col(f"key_{k}") for k in keys]
    learned = learn_currency(own, cols, [c for c in categories if c in fill], time, support, margin)
    kept = list(dict.fromkeys([*keep, *fill]))
    # A column that is in the order already is not carried twice.
    at = {c: f"best_.s{i}" for i, c in enumerate(kept)} | {o: f"best_.o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    survivor = F.min(F.struct("order_.*", *[F.col(c).alias(f"s{i}") for i, c in enumerate(kept) if at[c] == f"best_.s{i}"])).alias("best_")
    parts = [a.alias(n) for i, f in enumerate(fill) for n, a in latest_value(f, time, learned.get(f), f"f{i}")]
    groups = own.groupBy(*cols).agg(F.count(F.lit(1)).alias("size_"), survivor, *parts)
    if least > 1:
        groups = groups.filter(F.col("size_") >= least)
    out, taken = [F.col(f"key_{k}").alias(k) for k in keys], list(keys)
    for c in kept:
        value = F.col(at[c])
        if c in fill:
            j = fill.index(c)
            value = F.coalesce(value, resolve_latest(df.schema[c].dataType.simpleString(), learned.get(c), f"f{j}"))
        taken.append(free_name(c, taken))
        out.append(value.alias(taken[-1]))
    filled = F.array_compact(F.array(*[F.when(F.col(at[f]).isNull() & F.col(f"f{i}_newest").isNotNull(), F.lit(f)) for i, f in enumerate(fill)])) if fill else F.array().cast("array<string>")
    for name, value in (("n_rows", F.col("size_")), ("filled", filled)):
        taken.append(free_name(name, taken))
        out.append(value.alias(taken[-1]))
    return groups.select(*out)
