"""Running sums in (day, tie-break) order within a contract; a very large contract is spread over tasks.

Rows are counted per contract first (map-side combined, a number for each
contract).  The rows of an ordinary contract meet in one task: one shuffle of the
rows, no table of days beside them.  What lies on earlier days is a window over the
contract's days, what lies before a row on its own day a window within the day.

A contract with more than its share of all rows (see :func:`large_keys`) would
run on a single core that way, so its sums are computed in two levels:

1. per-(contract, day) totals are aggregated with partial (map-side)
   aggregation, so only one row per contract, day and map task crosses the
   network, and the running sum over *days* is a window over this per-day
   table.  A contract has at most one row per calendar day in it, so that
   window's partition size is bounded by the calendar, not by data volume;
2. the rows are hash-partitioned once on (contract, day); the per-day prefix
   is joined on those keys and the remainder within the day comes from a
   window partitioned by (contract, day), both on the rows' partitioning,
   so the rows themselves are shuffled exactly once.

An optional per-contract table (e.g. the payment pool) is attached at the day
level there, so it is joined to the per-day table instead of to every row.

Sums are taken over 64-bit integers: callers pass exact money as unscaled
units (see :func:`units`), which keeps the window and aggregate buffers on
Spark's fixed-width fast path instead of wide decimals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_SCALE = 4
#: A contract is large with more rows than this part of all of them, ...
LARGE_PART = 1000
#: ... but never with fewer rows than the first number, and always with more than the second.
LARGE_ROWS = (100, 100_000)
#: At most so many contracts are large.
LARGE_KEYS = 10_000


def units(c: Column, scale: int = MONEY_SCALE) -> Column:
    """Money → unscaled ``long`` (amount × 10^scale).

    The amount is first fixed to ``decimal(18, scale)``, HALF_UP: nothing happens to
    sanitised money, and a double 1.13 is 11300 units, not 11299.
    """
    return (c.cast(T.DecimalType(18, scale)) * F.lit(10**scale)).cast("long")


def from_units(c: Column, scale: int = MONEY_SCALE) -> Column:
    """Unscaled ``long`` → ``decimal(18, scale)``."""
    return (c.cast(T.DecimalType(18, 0)) * F.lit(Decimal(1).scaleb(-scale))).cast(T.DecimalType(18, scale))


def known(keys: Sequence[str]) -> Column:
    """No part of the key is null."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def large_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys that hold more rows than one task should have together; None where there are none.

    Runs a job that counts the rows of each key (a second one, of all rows, where some key has more than the least of
    ``LARGE_ROWS``).  The driver gets at most ``LARGE_KEYS`` keys, the largest.
    """
    least, most = LARGE_ROWS
    rows = df.where(known(keys)).select(*keys)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > least)
    found = sizes.orderBy(F.col("__n").desc()).limit(LARGE_KEYS).collect()
    if found:
        limit = min(max(rows.count() / LARGE_PART, least), most)
        found = [r for r in found if r["__n"] > limit]
    return df.sparkSession.createDataFrame([tuple(r)[:-1] for r in found], rows.schema) if found else None


def apart(df: DataFrame, keys: Sequence[str], large: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of large keys); rows without a key are among the first."""
    if large is None:
        return df, None
    marks = F.broadcast(large)
    return df.join(marks, list(keys), "left_anti"), df.join(marks, list(keys), "left_semi")


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    tiebreak: str,
    values: Mapping[str, Column],
    per_key: DataFrame | None = None,
    following: Mapping[str, Column] | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add ``name`` = Σ value over rows of the same key strictly before the row.

    ``values`` are integer columns (counts, or money as :func:`units`).
    Order is ``(day, tiebreak)`` ascending.  Rows with a null day or a null
    key are dropped (callers keep them aside).  Columns of ``per_key`` (one
    row per key) are added to every row, null when the key is absent there.
    ``following`` adds the value that the key's next row has (null on the last):
    from the row's own day, or else from the first row of the key's next day.
    ``sized_by`` is a table to count the keys' rows in where that is cheaper than in ``df``;
    what counts as large changes the work, never the result.
    """
    keys = list(keys)
    following = dict(following or {})
    df = df.where(F.col(day).isNotNull() & known(keys))
    ordinary, large = apart(df, keys, large_keys(df if sized_by is None else sized_by, keys))
    extra = [c for c in (per_key.columns if per_key is not None else []) if c not in keys]
    columns = [*keys, day, *[c for c in df.columns if c not in (*keys, day)], *extra, *values, *following]
    out = before_in_key(ordinary.repartition(*keys), keys, day, tiebreak, values, following)
    if per_key is not None:
        out = out.join(per_key, keys, "left")
    out = out.select(*columns)
    return out if large is None else out.unionByName(_by_days(large, keys, day, tiebreak, values, per_key, following).select(*columns))


def before_in_key(df: DataFrame, keys: Sequence[str], day: str, tiebreak: str, values: Mapping[str, Column],
                  following: Mapping[str, Column] | None = None) -> DataFrame:
    """:func:`running_before` for rows that are dealt by key already and have dates as days: they are not shuffled again.

    Rows without a day stay; their values do not count.
    """
    following = dict(following or {})
    tmp = {name: f"__v_{name}" for name in values}
    nxt = {name: f"__f_{name}" for name in following}
    rows = df.withColumns({tmp[n]: F.when(F.col(day).isNotNull(), c.cast("long")) for n, c in values.items()} | {nxt[n]: c for n, c in following.items()})
    a_day = Window.partitionBy(*keys, day)
    in_day = a_day.orderBy(tiebreak)
    rows = rows.withColumns(
        {f"__d_{n}": F.sum(tmp[n]).over(in_day.rowsBetween(Window.unboundedPreceding, -1)) for n in values}
        | {f"__n_{n}": F.lead(nxt[n]).over(in_day) for n in following}
        | {f"__f_first_{n}": F.min_by(nxt[n], tiebreak).over(a_day) for n in following}
    )
    by = ", ".join(f"`{k}`" for k in keys)

    def other_days(function: str, order: str = "ASC") -> Column:  # as text: the API's bounds are longs, which days do not take
        return F.expr(f"{function} OVER (PARTITION BY {by} ORDER BY `{day}` {order} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")

    rows = rows.withColumns(
        {n: F.coalesce(other_days(f"sum(`{tmp[n]}`)"), F.lit(0)) + F.coalesce(F.col(f"__d_{n}"), F.lit(0)) for n in values}
        | {n: F.coalesce(F.col(f"__n_{n}"), other_days(f"last(`__f_first_{n}`)", "DESC")) for n in following}  # the next day comes last
    )
    return rows.drop(*tmp.values(), *nxt.values(), *[f"__d_{n}" for n in values],
                     *[f"{p}_{n}" for n in following for p in ("__n", "__f_first")])


def _by_days(df: DataFrame, keys: list[str], day: str, tiebreak: str, values: Mapping[str, Column],
             per_key: DataFrame | None, following: Mapping[str, Column]) -> DataFrame:
    """:func:`running_before` in two levels: days of a key, then rows of a day."""
    tmp = {name: f"__v_{name}" for name in values}
    nxt = {name: f"__f_{name}" for name in following}
    base = df.withColumns({tmp[n]: c.cast("long") for n, c in values.items()} | {nxt[n]: c for n, c in following.items()})

    per_day = base.groupBy(*keys, day).agg(
        *[F.sum(tmp[n]).alias(tmp[n]) for n in values],
        *[F.min_by(nxt[n], tiebreak).alias(nxt[n]) for n in following],
    )
    if per_key is not None:
        per_day = per_day.join(per_key, keys, "left")
    days = Window.partitionBy(*keys).orderBy(day)  # a row for each calendar day of a contract
    extra = [c for c in (per_key.columns if per_key is not None else []) if c not in keys]
    per_day = per_day.select(
        *keys,
        day,
        *extra,
        *[F.coalesce(F.sum(tmp[n]).over(days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"__d_{n}") for n in values],
        *[F.lead(nxt[n]).over(days).alias(f"__n_{n}") for n in following],
    )

    rows = base.repartition(*keys, day)  # the one shuffle of the rows
    out = rows.join(per_day, [*keys, day], "inner")
    in_day = Window.partitionBy(*keys, day).orderBy(tiebreak)
    out = out.withColumns(
        {n: F.col(f"__d_{n}") + F.coalesce(F.sum(tmp[n]).over(in_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) for n in values}
        | {n: F.coalesce(F.lead(nxt[n]).over(in_day), F.col(f"__n_{n}")) for n in following}
    )
    return out.drop(*tmp.values(), *nxt.values(), *[f"__d_{n}" for n in values], *[f"__n_{n}" for n in following])
