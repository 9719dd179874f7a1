"""Read positions as predicates over a log's ``bookmark`` and ``ts`` columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.payload import BROKER_TIME_LENIENT

# The epoch position, the time form and the range form of a position.
EPOCH = "0"
_TIME = re.compile(r"\d{8}T\d{6}(\.\d+)?Z?")
_RANGE = re.compile(r"([\[(])([^:]+):([^:]+)([\])])")


def time_literal(text: str) -> Column:
    """``yyyyMMddTHHmmss[.ffffff][Z]`` (UTC) as a timestamp literal; folded before the scan."""
    return F.to_timestamp(F.lit(text), BROKER_TIME_LENIENT)


def is_range(position: str | None) -> bool:
    return bool(position) and _RANGE.fullmatch(position) is not None


def after(position: str | None) -> Column:
    """Rows a replay from ``position`` returns.

    ``""`` and ``"0"`` are the whole log, a time is inclusive, ``[a:b)`` and ``[a:b]`` bound both
    ends, and a number is a stored bookmark: the replay goes on with the message after it.
    """
    if not position or position == EPOCH:
        return F.lit(True)
    found = _RANGE.fullmatch(position)
    if found:
        opens, low, high, closes = found.groups()
        a, low_name = _bound(low)
        b, high_name = _bound(high)
        from_column, to_column = F.col(low_name), F.col(high_name)
        return ((from_column >= a if opens == "[" else from_column > a)
                & (to_column <= b if closes == "]" else to_column < b))
    bound, name = _bound(position)
    return F.col(name) >= bound if _TIME.fullmatch(position) else F.col(name) > bound


def may_hold(position: str | None) -> Column:
    """Which parts of a log can hold rows that ``after(position)`` returns, by the parts' ``least_`` and
    ``greatest_`` bookmark and ts."""
    if not position or position == EPOCH:
        return F.lit(True)
    found = _RANGE.fullmatch(position)
    low, high = (found.group(2), found.group(3)) if found else (position, None)
    a, name = _bound(low)
    holds = F.col(f"greatest_{name}") >= a
    if high:
        b, name = _bound(high)
        holds &= F.col(f"least_{name}") <= b
    return holds


def upto(position: str) -> Column:
    """Rows whose effects a state read at ``position`` (a time or a bookmark, inclusive) shows; no
    position is the whole log."""
    if not position:
        return F.lit(True)
    bound, name = _bound(position)
    return F.col(name) <= bound


def _bound(text: str) -> tuple[Column, str]:
    """A position as a literal, and the name of the column it bounds."""
    if _TIME.fullmatch(text):
        return time_literal(text), "ts"
    if text.isdigit():
        return F.lit(int(text)), "bookmark"
    raise ValueError(f"not a position: {text!r}")
