"""Change reads: merged records, field deltas, out-of-focus events and changelogs of aggregates.

All of them need, per row, the key's record before and after it.  ``history`` derives both from one
segmented scan, so no task ever holds a whole key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.payload import to_json_text
from tidelog.functions.segments import running, whole_part
from tidelog.operators.read import predicate
from tidelog.operators.state import NO_RESET, RESET, RESET_OR_LAPSED, carried, expiries, state_at, with_expiry
from tidelog.sources.topics import EXPIRED, OOF, SOW, SOW_DELETE


def history(log: DataFrame, keys: Sequence[str], fields: Sequence[str], *,
            present: Mapping[str, str] | None = None, expires: bool = False, **limits: int) -> DataFrame:
    """Each row with the record after it (``fields``) and before it (``prev_<field>``); ``had`` says
    whether the key was live before.

    With ``expires`` a record leaves ``expiration_s`` after its last write: a row that comes later finds
    no record before it, and one more row, of command ``expired`` and the position of that write, holds
    the record that left as its ``prev_`` values (its other columns are those of the row that found it
    gone).  Records that leave behind their key's last row are not told here.
    """
    rows = expiries(log, keys, **limits) if expires else log
    lapsed = {"__pos": "bookmark"} if expires else {}
    scanned = running(
        rows, keys, "bookmark",
        lasts={**{f"__v_{f}": f"CASE WHEN {carried(f, present)} "
                              f"THEN struct(bookmark AS at, `{f}` AS v) END" for f in fields},
               "__cmd": "command", **lapsed},
        maxes={"__reset": f"CASE WHEN {RESET_OR_LAPSED if expires else RESET} THEN bookmark END"}, **limits)

    def value(field: str, tail: str, name: str) -> str:
        cell = f"__v_{field}{tail}"
        return f"CASE WHEN `{cell}`.at >= coalesce(__reset{tail}, {NO_RESET}) THEN `{cell}`.v END AS `{name}`"

    out = scanned.selectExpr(
        *[f"`{c}`" for c in log.columns if c not in fields],
        *[value(f, "", f) for f in fields], *[value(f, "__before", f"prev_{f}") for f in fields],
        f"coalesce(__cmd__before, '{SOW_DELETE}') <> '{SOW_DELETE}' AS had",
        *(["__lapsed", "__pos__before AS __pos"] if expires else []))
    return _with_expired_rows(out, fields) if expires else out


def _with_expired_rows(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One more row in front of each that found its key's record expired."""
    columns = [c for c in rows.columns if c not in ("__lapsed", "__pos")]
    own = {c: f"`{c}`" for c in columns}
    after_lapse = {f"prev_{f}": f"CASE WHEN NOT __lapsed THEN `prev_{f}` END" for f in fields}
    gone = {"bookmark": "__pos", "command": f"'{EXPIRED}'", **{f: f"CASE WHEN false THEN `{f}` END" for f in fields}}

    def row(values: Mapping[str, str]) -> str:
        return "struct(" + ", ".join(f"{values[c]} AS `{c}`" for c in columns) + ")"

    message = row({**own, **after_lapse, "had": "had AND NOT __lapsed"})
    both = f"array_compact(array(CASE WHEN __lapsed THEN {row({**own, **gone})} END, {message}))"
    return rows.selectExpr(f"explode({both}) AS r").select("r.*")


def _updates(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("command").isin(SOW_DELETE, EXPIRED))


def merged_records(log: DataFrame, keys: Sequence[str], fields: Sequence[str], *, expires: bool = False,
                   **limits: int) -> DataFrame:
    """The full record right after every publish and partial update.  ``expires``: see ``history``."""
    rows = _updates(history(log, keys, fields, expires=expires, **limits))
    return rows.select("bookmark", "command", *keys, *fields)


def delta_subscribe(log: DataFrame, keys: Sequence[str], fields: Sequence[str], *,
                    since: Column | None = None, content_filter: str | Column | None = None, expires: bool = False,
                    **limits: int) -> DataFrame:
    """After each update: the key and the fields whose value changed, as JSON; all fields when the
    key was not live.  Rows before ``since`` count as history only; the filter sees the updated record.
    With ``expires`` (see ``history``) a key whose record had expired was not live."""
    rows = history(log, keys, fields, expires=expires, **limits).filter(predicate(content_filter))
    return deltas(rows if since is None else rows.filter(since), keys, fields)


def deltas(history: DataFrame, keys: Sequence[str], fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Field deltas of rows that have the records before and after them."""
    rows = _updates(history)
    changed = [f"CASE WHEN NOT had OR NOT `{f}` <=> `prev_{f}` THEN `{f}` END AS `{f}`" for f in fields]
    record = ", ".join([*keys, *changed])
    return rows.selectExpr("bookmark", "command", *keys, f"to_json(struct({record})) AS delta", *keep)


def sow_and_subscribe(log: DataFrame, keys: Sequence[str], fields: Sequence[str], upto: Column, *,
                      content_filter: str | Column | None = None, top: int | None = None, expires: bool = False,
                      **limits: int) -> DataFrame:
    """The records at a point (command ``sow``), then every later publish and partial update as the
    full record.  No row is missed or repeated: one for which ``upto`` is null comes later.  The filter
    sees records; ``top`` limits only the snapshot, in key order.  With ``expires`` the snapshot leaves
    out what has expired by its newest row, and later rows follow ``history``."""
    upto = F.coalesce(upto, F.lit(False))
    snapshot = state_at(log, keys, fields, upto=upto, content_filter=content_filter, expires=expires)
    if top is not None:
        snapshot = snapshot.orderBy(*keys).limit(top)
    columns = ["bookmark", "command", *keys, *fields]
    later = (_updates(history(log, keys, fields, expires=expires, **limits))
             .filter(~upto).filter(predicate(content_filter)))
    return (snapshot.withColumn("command", F.lit(SOW)).select(*columns)
            .unionByName(later.select(*columns)))


def sow_and_delta_subscribe(log: DataFrame, keys: Sequence[str], fields: Sequence[str],
                            upto: Column, *, content_filter: str | Column | None = None, expires: bool = False,
                            **limits: int) -> DataFrame:
    """The records at a point in full, then field deltas, all as JSON.  A row for which ``upto`` is null
    comes later.  The filter sees records.  ``expires``: as in ``sow_and_subscribe``."""
    upto = F.coalesce(upto, F.lit(False))
    snapshot = state_at(log, keys, fields, upto=upto, content_filter=content_filter, expires=expires).select(
        "bookmark", F.lit(SOW).alias("command"), *keys, to_json_text(*keys, *fields).alias("delta"))
    return snapshot.unionByName(delta_subscribe(log, keys, fields, since=~upto, content_filter=content_filter,
                                                expires=expires, **limits))


def snapshot_with_markers(records: DataFrame, label: Column) -> DataFrame:
    """A snapshot framed by its begin and end markers: ``seq`` 0, 1 and 2 order the three parts."""
    spark = records.sparkSession
    ends = spark.createDataFrame([(0, "group_begin"), (2, "group_end")], "seq INT, command STRING")
    body = records.select(F.lit(1).alias("seq"), F.lit(SOW).alias("command"), label.alias("label"))
    return body.unionByName(ends, allowMissingColumns=True)


def out_of_focus(log: DataFrame, keys: Sequence[str], fields: Sequence[str],
                 content_filter: str | Column, *, since: Column | None = None, expires: bool = False,
                 now: Column | None = None, **limits: int) -> DataFrame:
    """Rows that take a matching record out of a reader's sight, with the reason: ``deleted``, or
    ``match`` when the updated record no longer satisfies the filter.  A null predicate is no match.

    With ``expires`` also, reason ``expired`` and the position of its last write, each matching record whose
    time was over before its key's next row, or by ``now`` (the newest time of the log, if not given) if
    there was none.  ``since`` looks at the row that finds the record gone; for one that no row finds, at
    its last write."""
    rows = history(log, keys, fields, expires=expires, **limits)
    gone = left_sight(rows if since is None else rows.filter(since), keys, fields, content_filter)
    if not expires:
        return gone
    at_end = with_expiry(log, keys, fields, now).filter("expired")
    if since is not None:
        at_end = at_end.withColumn("ts", F.col("last_ts")).filter(since)
    return gone.unionByName(_expired(at_end, keys, content_filter))


def left_sight(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], content_filter: str | Column) -> DataFrame:
    """Out-of-focus events of rows that have the records before and after them."""
    test = F.coalesce(predicate(content_filter), F.lit(False))
    after = [F.col(f).alias(f"__new_{f}") for f in fields]
    rows = (rows.select("bookmark", "command", "had", *keys,
                        *after, *[F.col(f"prev_{f}").alias(f) for f in fields])
            .filter(F.col("had") & test)
            .withColumns({f: F.col(f"__new_{f}") for f in fields}))
    gone = F.when(F.col("command") == SOW_DELETE, "deleted").when(F.col("command") == EXPIRED, EXPIRED)
    return rows.filter(gone.isNotNull() | ~test).select(
        "bookmark", *keys, F.lit(OOF).alias("command"), F.coalesce(gone, F.lit("match")).alias("reason"))


def expired_out_of_focus(log: DataFrame, keys: Sequence[str], fields: Sequence[str],
                         content_filter: str | Column, now: Column) -> DataFrame:
    """Matching records that left a reader's sight at ``now`` because they expired."""
    return _expired(with_expiry(log, keys, fields, now).filter("expired"), keys, content_filter)


def _expired(records: DataFrame, keys: Sequence[str], content_filter: str | Column) -> DataFrame:
    return records.filter(predicate(content_filter)).select(
        "bookmark", *keys, F.lit(OOF).alias("command"), F.lit(EXPIRED).alias("reason"))


def aggregate_changelog(rows: DataFrame, keys: Sequence[str], order: str,
                        measures: Mapping[str, Column], **limits: int) -> DataFrame:
    """The changelog of running totals: ``+I`` for a key's first row, then ``-U`` with the old and
    ``+U`` with the new totals.  Measures are integral or decimal."""
    scanned = running(rows, keys, order, sums={**measures, "__n": "1L"},
                      **limits)
    first = F.col("__n") == 1

    def change(op: str, tail: str) -> Column:
        return F.struct(F.lit(op).alias("op"), *[F.col(m + tail).alias(m) for m in measures])

    entries = F.when(first, F.array(change("+I", ""))).otherwise(
        F.array(change("-U", "__before"), change("+U", "")))
    return (scanned.select(*keys, order, F.explode(entries).alias("__e"))
            .select(*keys, order, "__e.op", *[f"__e.{m}" for m in measures]))


def aggregate_changelog_batched(rows: DataFrame, keys: Sequence[str], order: str,
                                measures: Mapping[str, Column], batch_size: int, **limits: int) -> DataFrame:
    """The same changelog with the changes of a batch collapsed: one step per key and batch.  Rows
    are summed per key and batch before anything else, on the map side."""
    batch = whole_part(F.col(order), batch_size)
    totals = rows.groupBy(*keys, batch.alias("batch")).agg(
        *[F.sum(c).alias(m) for m, c in measures.items()])
    return aggregate_changelog(totals, keys, "batch", {m: F.col(m) for m in measures}, **limits)
