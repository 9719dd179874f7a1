"""SQL fragments the oracles share: the event log, its merged history, and states of it."""

#: ``events`` as a log, with the payload fields and the JSON text.
LOG = """WITH log AS (
  SELECT event_type AS topic, event_id AS bookmark, ts,
    CASE event_type WHEN 'error' THEN 'sow_delete' WHEN 'click' THEN 'delta_publish'
      ELSE 'publish' END AS command,
    user_id AS id, event_id AS num,
    CASE WHEN event_type <> 'click' OR event_id % 2 = 0 THEN value END AS bid,
    CASE WHEN event_type <> 'click' OR event_id % 3 = 0
      THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS ask,
    event_type AS grp, event_type = 'purchase' AS flag,
    CAST(user_id AS VARCHAR) AS sow_key,
    CASE WHEN event_id % 4 = 0 THEN 'c' || event_id END AS correlation_id,
    CASE WHEN event_id % 5 <> 0 THEN event_id % 5 * 86400 END AS expiration_s,
    '{"id":' || user_id || ',"num":' || event_id
      || CASE WHEN event_type <> 'click' OR event_id % 2 = 0
           THEN ',"bid":' || CAST(value AS VARCHAR) ELSE '' END
      || CASE WHEN event_type <> 'click' OR event_id % 3 = 0
           THEN ',"ask":' || CAST(CAST(json_extract(props, '$.k') AS DOUBLE) AS VARCHAR)
           ELSE '' END
      || ',"grp":"' || event_type || '"}' AS data
  FROM events)"""

#: Per row the record after it (m_*) and before it (p_*), walked key by key.
HISTORY = LOG + """, epochs AS (
  SELECT *, count(*) FILTER (WHERE command <> 'delta_publish')
    OVER (PARTITION BY id ORDER BY bookmark) AS epoch FROM log),
m AS (
  SELECT *,
    last_value(CASE WHEN command <> 'sow_delete' THEN num END IGNORE NULLS) OVER w AS m_num,
    last_value(CASE WHEN command <> 'sow_delete' THEN bid END IGNORE NULLS) OVER w AS m_bid,
    last_value(CASE WHEN command <> 'sow_delete' THEN ask END IGNORE NULLS) OVER w AS m_ask,
    last_value(CASE WHEN command <> 'sow_delete' THEN grp END IGNORE NULLS) OVER w AS m_grp
  FROM epochs WINDOW w AS (PARTITION BY id, epoch ORDER BY bookmark)),
h AS (
  SELECT *, lag(m_num) OVER k AS p_num, lag(m_bid) OVER k AS p_bid, lag(m_ask) OVER k AS p_ask,
    lag(m_grp) OVER k AS p_grp, coalesce(lag(command) OVER k, 'sow_delete') <> 'sow_delete' AS had
  FROM m WINDOW k AS (PARTITION BY id ORDER BY bookmark))"""


def crc32(text: str) -> str:
    """CRC32 of an ASCII text, byte by byte: the polynomial's table is linear in the bits of its index."""
    terms = []
    for bit in range(8):
        value = 1 << bit
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        terms.append(f"((xor(a, b) >> {bit}) & 1) * {value}")
    entry = "0"
    for term in terms:
        entry = f"xor({entry}, {term})"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            f"lambda a, b: xor(a >> 8, {entry})), 4294967295)")


#: The same walk where a record that expired before a row starts anew with it.
EXPIRING = HISTORY.replace(LOG, LOG + """, timed AS (SELECT *, coalesce(lag(command) OVER k <> 'sow_delete'
  AND lag(ts) OVER k + INTERVAL 1 SECOND * lag(expiration_s) OVER k <= ts, false) AS lapsed
  FROM log WINDOW k AS (PARTITION BY id ORDER BY bookmark))""").replace(
    "FILTER (WHERE command <> 'delta_publish')", "FILTER (WHERE command <> 'delta_publish' OR lapsed)").replace(
    "AS epoch FROM log)", "AS epoch FROM timed)")

#: Records over 20 that leave sight: by a message, and by their time, to the newest one of the log.
OOF_EXPIRING = EXPIRING + """, placed AS (SELECT *, lag(bookmark) OVER k AS p_bookmark,
  row_number() OVER (PARTITION BY id ORDER BY bookmark DESC) AS rn FROM h WINDOW k AS (PARTITION BY id ORDER BY bookmark))
SELECT bookmark, id, 'oof' AS command, CASE command WHEN 'sow_delete' THEN 'deleted' ELSE 'match' END AS reason
FROM placed WHERE had AND NOT lapsed AND p_bid > 20 AND (command = 'sow_delete' OR NOT coalesce(m_bid > 20, false))
UNION ALL SELECT p_bookmark, id, 'oof', 'expired' FROM placed WHERE lapsed AND p_bid > 20
UNION ALL SELECT bookmark, id, 'oof', 'expired' FROM placed WHERE rn = 1 AND command <> 'sow_delete' AND m_bid > 20
  AND ts + INTERVAL 1 SECOND * expiration_s <= (SELECT date_trunc('milliseconds', max(ts)) FROM log)"""


def state(condition: str = "true") -> str:
    """The live records after the rows that satisfy a condition."""
    return f"""SELECT id, m_num AS num, m_bid AS bid, m_ask AS ask, m_grp AS grp, bookmark
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY bookmark DESC) AS rn
        FROM m WHERE {condition}) WHERE rn = 1 AND command <> 'sow_delete'"""


#: JSON of the key and some of (num, bid, ask, grp), each under a condition.
def delta_json(num: str, bid: str, ask: str, grp: str) -> str:
    def part(name: str, value: str, shown: str) -> str:
        return f"""|| CASE WHEN ({shown}) AND {value} IS NOT NULL
      THEN ',"{name}":' || CAST({value} AS VARCHAR) ELSE '' END"""

    return ("'{\"id\":' || id " + part("num", "m_num", num) + part("bid", "m_bid", bid)
            + part("ask", "m_ask", ask)
            + f"""|| CASE WHEN ({grp}) AND m_grp IS NOT NULL
      THEN ',"grp":"' || m_grp || '"' ELSE '' END || '}}'""")


CHANGED = delta_json(*[f"NOT had OR m_{f} IS DISTINCT FROM p_{f}"
                       for f in ("num", "bid", "ask", "grp")])
WHOLE = delta_json("true", "true", "true", "true")
