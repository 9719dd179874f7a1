"""Running values per key that stay bounded when one key owns most of the log.

``Window.partitionBy(key).orderBy(bookmark)`` sorts a whole key in one task.  That is right for all
keys but the hot ones, so hot keys (more than ``HOT`` rows) are found by a count and are cut into
*segments* of some ``WIDTH`` consecutive rows:

1. rows of hot keys are aggregated per (key, segment) with map-side combine;
2. a window over those few rows gives each segment what came before it (its *lead*);
3. the lead joins its segment as one extra first row, and the window runs per (key, segment).

A task then holds at most ``HOT`` rows of a cold key, a segment of a hot one, or one lead per
segment.  The full rows are shuffled once.  Without hot keys the leads are an empty branch, which
adaptive execution drops.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that make a key hot.  A log of n rows has fewer than n / HOT hot keys (200,000 in two hundred
#: billion rows), which bounds what ``split_hot_keys`` broadcasts.
HOT = 1 << 20

#: Rows per segment of a hot key, on average.
WIDTH = 1 << 16

#: Room for the parts of a stretch that is cut again.
PARTS = 1 << 20

SEGMENT, _HOT, _LEAD = "__segment", "__hot", "__lead"


def whole_part(value: Column, size: int) -> Column:
    """``value div size`` in 64-bit integers, exact at any size."""
    return F.call_function("div", value, F.lit(int(size)))


def split_hot_keys(df: DataFrame, keys: Sequence[str], order: str, *, hot: int = HOT,
                   width: int = WIDTH) -> DataFrame:
    """Tag each row with its segment: 0 for a cold key, a stretch of the key's order range for a hot
    one, as long as holds ``width`` of its rows on average (positions may be dense or sparse).

    Negative positions come before all messages and do not count towards the range.  A stretch that
    still holds over twice ``width`` rows (a burst, or everything but one far message) is cut again over
    the range of its own rows.  Without keys the whole frame is one sequence, cut in the same way.
    """
    if not keys:
        return _split_whole(df, order, width)
    facts = df.groupBy(*keys).agg(*map(F.expr, (
        "count(1) AS __rows", f"min(CASE WHEN `{order}` >= 0 THEN `{order}` END) AS __low",
        f"max(`{order}`) AS __high")))
    hot_keys = facts.filter(f"__rows > {int(hot)}").selectExpr(
        *[f"`{k}` AS `__hot_{k}`" for k in keys], f"true AS {_HOT}", "coalesce(__low, 0L) AS __low",
        f"greatest(1L, (__high - coalesce(__low, 0L) + 1) div greatest(1L, __rows div {int(width)})) AS __step")
    same = F.expr(" AND ".join(f"`{k}` <=> `__hot_{k}`" for k in keys))
    # bounded by the row count over HOT, see above
    tagged = df.join(F.broadcast(hot_keys), same, "left").selectExpr(
        *_quoted(df.columns), _HOT,
        f"CASE WHEN {_HOT} THEN (`{order}` - __low) div __step ELSE 0L END AS {SEGMENT}")
    crowded = tagged.filter(f"{_HOT} AND `{order}` >= 0").groupBy(*keys, SEGMENT).agg(*map(F.expr, (
        "count(1) AS __rows", f"min(`{order}`) AS __from", f"max(`{order}`) AS __upto"))).filter(
        f"__rows > {2 * int(width)}").selectExpr(
        *[f"`{k}` AS `__in_{k}`" for k in keys], f"{SEGMENT} AS __in", "__from",
        f"greatest(1L, (__upto - __from + 1) div greatest(1L, __rows div {int(width)})) AS __part")
    inside = F.expr(" AND ".join([*[f"`{k}` <=> `__in_{k}`" for k in keys], f"{SEGMENT} = __in"]))
    # fewer than the rows of hot keys over twice the width
    return tagged.join(F.broadcast(crowded), inside, "left").selectExpr(
        *_quoted(df.columns), _HOT,
        f"CASE WHEN {_HOT} THEN {SEGMENT} * {PARTS} + greatest(0L, least({PARTS - 1}L, "
        f"coalesce((`{order}` - __from) div __part, 0L))) ELSE 0L END AS {SEGMENT}")


def _split_whole(df: DataFrame, order: str, width: int) -> DataFrame:
    """The segments of one sequence of all rows; the few numbers that decide them are scalar subqueries."""
    low = df.agg(F.min(order)).scalar()
    step = df.agg(F.expr(f"greatest(1L, (max(`{order}`) - min(`{order}`) + 1) div greatest(1L, count(1) div {int(width)}))")).scalar()
    tagged = df.withColumn(SEGMENT, F.call_function("div", F.col(order) - low, step))
    crowded = tagged.groupBy(SEGMENT).agg(*map(F.expr, (
        "count(1) AS __rows", f"min(`{order}`) AS __from", f"max(`{order}`) AS __upto"))).filter(
        f"__rows > {2 * int(width)}").selectExpr(
        f"{SEGMENT} AS __in", "__from", f"greatest(1L, (__upto - __from + 1) div greatest(1L, __rows div {int(width)})) AS __part")
    # fewer than all rows over twice the width
    return tagged.join(F.broadcast(crowded), F.col(SEGMENT) == F.col("__in"), "left").selectExpr(
        *_quoted(df.columns), f"true AS {_HOT}",
        f"{SEGMENT} * {PARTS} + greatest(0L, least({PARTS - 1}L, coalesce((`{order}` - __from) div __part, 0L))) AS {SEGMENT}")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    sums: Mapping[str, Column | str] | None = None,
    lasts: Mapping[str, Column | str] | None = None,
    maxes: Mapping[str, Column | str] | None = None,
    hot: int = HOT,
    width: int = WIDTH,
) -> DataFrame:
    """Add running values in ``order`` per ``keys``.

    Each name gives two columns: ``name`` (this row included) and ``name__before`` (rows strictly
    before); a column of that name is replaced.  ``lasts`` keeps the last non-null value.  Columns
    that go unused are pruned, with their windows, by Catalyst.  Values are columns or SQL text.
    ``order`` is integral, unique per key and never null; sums must be integral or decimal where
    even the last digit must not depend on how rows are grouped.  Rows that ``split_hot_keys`` has
    tagged keep their tags.
    """
    sums, lasts, maxes = dict(sums or {}), dict(lasts or {}), dict(maxes or {})
    inputs = {**sums, **lasts, **maxes}
    kept = _quoted(c for c in df.columns if c not in inputs)
    tagged = df if SEGMENT in df.columns else split_hot_keys(df, keys, order, hot=hot, width=width)
    rows = tagged.withColumns({n: F.expr(c) if isinstance(c, str) else c for n, c in inputs.items()})

    def per(columns: Sequence[str], by: str) -> str:
        partition = f"PARTITION BY {', '.join(_quoted(columns))} " if columns else ""
        return f"({partition}ORDER BY {by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    def carry(window: str, tail: str = "") -> list[str]:
        return [*[f"sum(`{n}`) OVER {window} AS `{n}{tail}`" for n in sums],
                *[f"last(`{n}`, true) OVER {window} AS `{n}{tail}`" for n in lasts],
                *[f"max(`{n}`) OVER {window} AS `{n}{tail}`" for n in maxes]]

    group = [*keys, SEGMENT]
    totals = rows.filter(_HOT).groupBy(*group).agg(*map(F.expr, [
        *[f"sum(`{n}`) AS `{n}`" for n in sums],
        *[f"max_by(`{n}`, CASE WHEN `{n}` IS NOT NULL THEN `{order}` END) AS `{n}`" for n in lasts],
        *[f"max(`{n}`) AS `{n}`" for n in maxes]]))
    leads = totals.selectExpr(*_quoted(group), f"true AS {_LEAD}", *carry(per(keys, SEGMENT)))
    both = rows.selectExpr("*", f"false AS {_LEAD}").unionByName(leads, allowMissingColumns=True)
    scanned = both.selectExpr(*kept, *_quoted(inputs), _LEAD,
                              *carry(per(group, f"`{order}` ASC NULLS FIRST"), "__before"))
    # the row itself is added to what came before it, which saves a second window per value
    return scanned.filter(f"NOT {_LEAD}").selectExpr(
        *kept, *_quoted(f"{n}__before" for n in inputs),
        *[f"coalesce(`{n}__before` + `{n}`, `{n}`, `{n}__before`) AS `{n}`" for n in sums],
        *[f"coalesce(`{n}`, `{n}__before`) AS `{n}`" for n in lasts],
        *[f"greatest(`{n}`, `{n}__before`) AS `{n}`" for n in maxes])


def running_row_number(df: DataFrame, keys: Sequence[str], order: str, name: str, *,
                       hot: int = HOT, width: int = WIDTH) -> DataFrame:
    """``row_number`` per key in ``order`` without bringing a hot key into one task."""
    return running(df, keys, order, sums={name: "1L"}, hot=hot,
                   width=width).drop(f"{name}__before")


def previous(df: DataFrame, keys: Sequence[str], order: str, values: Mapping[str, str], *,
             hot: int = HOT, width: int = WIDTH) -> DataFrame:
    """``lag`` per key: add column ``name`` holding the previous row's ``column`` for each pair."""
    packed = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    out = running(df, keys, order, lasts={"__prev": packed}, hot=hot, width=width)
    return out.select(*df.columns, *[F.col(f"__prev__before.{n}").alias(n) for n in values])


def _quoted(names: Iterable[str]) -> list[str]:
    return [f"`{n}`" for n in names]
