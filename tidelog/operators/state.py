"""The latest record per key ("state of the world"), as of any point of a log.

A publish or a delete *resets* a key; a partial update keeps the fields it does not carry.  So the
record at a point is, per field, the newest value carried at or after the newest reset, and all of it
comes from one aggregate per key: partial on the map side, so a hot key moves one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.segments import previous
from tidelog.operators.aggregate import AMOUNT, exact_text
from tidelog.operators.read import predicate
from tidelog.sources.topics import PUBLISH, SOW_DELETE


# SQL texts: rows that start a key's record anew, and the reset of a key never reset.
RESET = f"command IN ('{PUBLISH}', '{SOW_DELETE}')"
NO_RESET = "-4611686018427387904L"

#: SQL text: folded records that are not deleted.
LIVE = "__deleted IS NULL OR __deleted < __last"


def carried(field: str, present: Mapping[str, str] | None = None) -> str:
    """SQL text: whether a row carries a field.  By default a null field counts as left out; give
    ``present`` (for example ``map_contains_key(raw, 'f')``) where an explicit null must overwrite."""
    carries = (present or {}).get(field, f"`{field}` IS NOT NULL")
    return f"({carries} AND command <> '{SOW_DELETE}')"


def fold(fields: Sequence[str], present: Mapping[str, str] | None = None, reset: str = RESET) -> list[Column]:
    """The aggregates that determine a key's record.  They merge, so they serve partial aggregation,
    history grids and streaming state alike.  ``reset`` is SQL text for the rows that start it anew."""
    at = {f: f"CASE WHEN {carried(f, present)} THEN bookmark END" for f in fields}
    return [F.expr(text) for text in (
        "max(bookmark) AS __last",
        f"max(CASE WHEN command = '{SOW_DELETE}' THEN bookmark END) AS __deleted",
        f"max(CASE WHEN {reset} THEN bookmark END) AS __reset",
        *[f"max_by(`{f}`, {at[f]}) AS `{f}`" for f in fields],
        *[f"max({at[f]}) AS `__at_{f}`" for f in fields])]


def current(field: str) -> str:
    """SQL text: a folded value, null if it is older than the reset."""
    return f"CASE WHEN `__at_{field}` >= coalesce(__reset, {NO_RESET}) THEN `{field}` END"


def unfold(folded: DataFrame, keys: Sequence[str], fields: Sequence[str],
           keep: Sequence[str] = ()) -> DataFrame:
    """Records from folded aggregates: drop deleted keys, blank the values older than the reset."""
    return folded.filter(LIVE).selectExpr(
        *keys, *[f"{current(f)} AS `{f}`" for f in fields], "__last AS bookmark", *keep)


def state_at(log: DataFrame, keys: Sequence[str], fields: Sequence[str], *,
             upto: Column | None = None, content_filter: str | Column | None = None,
             present: Mapping[str, str] | None = None, expires: bool = False, now: Column | None = None) -> DataFrame:
    """The record of every live key after the rows that satisfy ``upto``.

    ``content_filter`` looks at the records, not at the history, so it comes after the aggregate;
    Spark pushes only its key parts below.  With ``expires`` the rule of ``with_expiry`` holds and
    expired records are left out; otherwise ``expiration_s`` is not read.
    """
    rows = log if upto is None else log.filter(upto)
    if expires:
        records = with_expiry(rows, keys, fields, now, present=present).filter("NOT expired").drop("expired", "last_ts")
    else:
        records = unfold(rows.groupBy(*keys).agg(*fold(fields, present)), keys, fields)
    return records.filter(predicate(content_filter))


def latest(log: DataFrame, keys: Sequence[str], columns: Sequence[str], *,
           upto: Column | None = None) -> DataFrame:
    """The last full message per key, deleted keys left out, for topics without partial updates.

    Each task keeps one row per key before the shuffle, so rows of any width move only as often as
    their key occurs in another task.
    """
    rows = log if upto is None else log.filter(upto)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns, "command", "bookmark"), "bookmark").alias("r"))
    return last.select("r.*").filter(F.col("command") != SOW_DELETE).drop("command")


def page(records: DataFrame, order: Sequence[Column | str], n: int, skip: int = 0) -> DataFrame:
    """A page of ordered records: ``skip`` then ``n`` (one TakeOrderedAndProject)."""
    ordered = records.orderBy(*order)
    return (ordered.offset(skip) if skip else ordered).limit(n)


#: SQL text: rows that start a record anew where records expire.
RESET_OR_LAPSED = f"({RESET} OR __lapsed)"


def expiries(log: DataFrame, keys: Sequence[str], **limits: int) -> DataFrame:
    """Rows with ``__lapsed``, whether their key's record had expired when they came."""
    before = previous(log, keys, "bookmark", {"__ts": "ts", "__exp": "expiration_s", "__cmd": "command"}, **limits)
    ends = F.col("__ts") + F.make_dt_interval(secs=F.col("__exp"))
    lapsed = (F.col("__exp") >= 0) & (ends <= F.col("ts")) & (F.col("__cmd") != SOW_DELETE)
    return before.withColumn("__lapsed", F.coalesce(lapsed, F.lit(False))).drop("__ts", "__exp", "__cmd")


def newest_time(rows: DataFrame) -> Column:
    """The newest time of a log to the millisecond, as a scalar subquery: the clock of its expiries."""
    return rows.agg(F.date_trunc("millisecond", F.max("ts"))).scalar()


def with_expiry(log: DataFrame, keys: Sequence[str], fields: Sequence[str], now: Column | None = None, *,
                upto: Column | None = None, present: Mapping[str, str] | None = None) -> DataFrame:
    """Live records with ``expired``, whether they have left the state at ``now`` (the newest time of the
    rows read, if not given), and ``last_ts``, the time of their last write.

    A record leaves ``expiration_s`` seconds after its last write; without an expiration it stays.  One
    that left before the next write of its key is gone: a partial update then starts a new record.
    """
    seen = log if upto is None else log.filter(upto)
    rows = expiries(seen, keys)
    folded = rows.groupBy(*keys).agg(*fold(fields, present, RESET_OR_LAPSED), *map(F.expr, (
        "max_by(ts, bookmark) AS last_ts",
        "max_by(coalesce(expiration_s, -1), bookmark) AS __exp")))
    ends = F.col("last_ts") + F.make_dt_interval(secs=F.col("__exp"))
    expired = (F.col("__exp") >= 0) & (ends <= (newest_time(seen) if now is None else now))
    return unfold(folded.withColumn("expired", expired), keys, fields, keep=["last_ts", "expired"])


def states_at_points(log: DataFrame, keys: Sequence[str], fields: Sequence[str], first_seen: Column,
                     points: int, *, expires: bool = False) -> DataFrame:
    """The state at each of ``points`` numbered moments, tagged ``point``, from one pass over the log.

    ``first_seen`` is the number of the first moment that sees a row; rows from ``points`` on (or
    null) come after all of them.  Rows are folded per key and number before anything else, so a key
    has at most ``points`` rows in the window that carries records forward.  With ``expires`` a record
    that expired before the next write of its key is gone with that write, and ``__ends`` says when
    the record of a point leaves (null: never); the caller leaves out what has left by then.
    """
    rows = log.withColumn("__cell", first_seen.cast("int"))
    ends = "CASE WHEN expiration_s >= 0 THEN ts + make_dt_interval(0, 0, 0, expiration_s) END"
    life = [F.expr(f"max_by({ends}, bookmark) AS __ends")] if expires else []
    reset = RESET_OR_LAPSED if expires else RESET
    folded = ((expiries(rows, keys) if expires else rows).filter(F.col("__cell") < points)
              .groupBy(*keys, "__cell").agg(*fold(fields, reset=reset), *life))
    so_far = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy(*keys).orderBy("__cell")
    at_cell = folded.select(
        *keys, "__cell",
        *[F.max(c).over(so_far).alias(c) for c in ("__last", "__deleted", "__reset")],
        *[F.max_by(f, f"__at_{f}").over(so_far).alias(f) for f in fields],
        *[F.max(f"__at_{f}").over(so_far).alias(f"__at_{f}") for f in fields],
        *(["__ends"] if expires else []),  # of the last write, so not carried
        F.lead("__cell", 1, points).over(onward).alias("__next"))
    spread = at_cell.withColumn("point", F.explode(F.sequence("__cell", F.col("__next") - 1)))
    return unfold(spread, keys, fields, keep=["point", *(["__ends"] if expires else [])])


def history_grid(log: DataFrame, keys: Sequence[str], fields: Sequence[str], *,
                 start: Column, step_s: int, points: int, expires: bool = False) -> DataFrame:
    """The state at each of ``points`` moments ``start + i * step_s``, tagged ``grid_ts``.  With ``expires``
    records leave as ``with_expiry`` says, by the moment's time."""
    step = F.lit(step_s * 1_000_000).cast("bigint")
    # the first moment at or behind a row, in whole numbers
    first_seen = -F.call_function("div", F.unix_micros(start) - F.unix_micros("ts"), step)
    first_seen = F.when(F.col("ts") <= start, F.lit(0)).otherwise(
        first_seen + F.when((F.unix_micros("ts") - F.unix_micros(start)) % step != 0, 1).otherwise(0))
    records = states_at_points(log, keys, fields, first_seen, points, expires=expires)
    grid_ts = F.timestamp_micros(F.unix_micros(start) + F.col("point") * step)
    records = records.withColumn("grid_ts", grid_ts).drop("point")
    if expires:
        records = records.filter("__ends IS NULL OR __ends > grid_ts").drop("__ends")
    return records


def grouped_view(records: DataFrame, group: str = "grp", key: str = "id") -> DataFrame:
    """``sum(ask), sum(bid), count(key)`` of the live records by group; null is a group of its own."""
    return records.groupBy(group).agg(
        F.sum("ask").alias("sum_ask"), F.sum("bid").alias("sum_bid"), F.count(key).alias("n"))


def view_delta(log: DataFrame, keys: Sequence[str], fields: Sequence[str], old: Column, new: Column,
               group: str = "grp", amount: str = AMOUNT) -> DataFrame:
    """Groups of the view that differ between two points of a log, with both values.

    ``old`` and ``new`` say which rows each point has seen.  The log is read once, and null groups
    meet without a join.  Sums are compared, so they are added as ``amount``; a value that does not
    fit is an error.
    """
    records = states_at_points(log, keys, fields, F.when(old, 0).when(new, 1), 2)
    views = records.groupBy(group, "point").agg(*map(F.expr, (
        f"sum({exact_text('ask', amount)}) AS sum_ask", f"sum({exact_text('bid', amount)}) AS sum_bid",
        f"count(`{keys[0]}`) AS n")))
    values = ("sum_ask", "sum_bid", "n")
    both = views.groupBy(group).agg(*[
        F.expr(f"max(CASE WHEN point = {i} THEN {v} END) AS {p}_{v}")
        for v in values for i, p in ((0, "old"), (1, "new"))])
    return both.filter(" OR ".join(f"NOT old_{v} <=> new_{v}" for v in values))


def delete_keys(records: DataFrame, deleted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records without those whose key a deletion names."""
    return records.join(deleted.select(*keys).distinct(), list(keys), "left_anti")


def delete_where(log: DataFrame, keys: Sequence[str], fields: Sequence[str],
                 condition: str | Column, before: Column) -> DataFrame:
    """The state after a delete by filter that took effect behind the rows satisfying ``before``.

    Records that matched the filter then are gone, unless later rows rebuild them.  The log is
    folded per key on each side of the point, the matching folds are dropped, and what is left (at
    most two rows per key) is merged.
    """
    folded = (log.withColumn("__later", ~before).groupBy(*keys, "__later").agg(*fold(fields))
              .withColumns({f: F.expr(current(f)) for f in fields}))
    gone = F.coalesce(predicate(condition), F.lit(False))
    kept = folded.filter(F.col("__later") | ~gone)
    merged = kept.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("__last", "__deleted", "__reset")],
        *[F.max_by(f, f"__at_{f}").alias(f) for f in fields],
        *[F.max(f"__at_{f}").alias(f"__at_{f}") for f in fields])
    return unfold(merged, keys, fields)
