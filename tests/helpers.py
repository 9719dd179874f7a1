"""Small logs and a row-by-row model of keyed state to compare the operators with."""

from __future__ import annotations

from datetime import datetime, timedelta

LOG_SCHEMA = ("bookmark BIGINT, ts TIMESTAMP, command STRING, id BIGINT, data STRING, num BIGINT, "
              "topic STRING, expiration_s INT, sow_key STRING")
START = datetime(2024, 1, 1)


def make_log(spark, rows, topic="t"):
    """Rows are (command, id, data, num); position and time follow from the order."""
    full = [(i, START + timedelta(seconds=i), c, k, d, n, topic, None, str(k))
            for i, (c, k, d, n) in enumerate(rows)]
    return spark.createDataFrame(full, LOG_SCHEMA)


def walk(rows, fields=2):
    """Per row: record before and after, walking the log in order."""
    state, out = {}, []
    for command, key, *values in rows:
        before = state.get(key)
        if command == "sow_delete":
            after = None
        else:
            base = before if command == "delta_publish" and before else (None,) * fields
            after = tuple(b if v is None else v for v, b in zip(values, base))
        if after is None:
            state.pop(key, None)
        else:
            state[key] = after
        out.append((before, after))
    return state, out
