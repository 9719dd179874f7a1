"""Shards by a Feistel permutation with cycle walking over global row numbers.

Built-in functions only: no Python runs on the executors.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import column

#: Modulus and multiplier of the round function; all products stay below 2^62.
PRIME, FACTOR = 2147483647, 48271
ROUNDS = 6
#: Steps of the cycle walk that are written out.  The domain exceeds the rows by less than a root of
#: their number, so a walk of n steps has a chance of about rows^(-n/2).
WALK = 64
#: Rows that get their numbers together; the number of such groups is the size of the offsets table.
GROUP_ROWS, MIN_GROUPS, MAX_GROUPS = 4096, 64, 1 << 20


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Two numbers below PRIME for each round."""
    digests = [hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(ROUNDS)]
    return [(int.from_bytes(d[:8], "big") % PRIME, int.from_bytes(d[8:16], "big") % PRIME) for d in digests]


def domain(rows: int) -> tuple[int, int]:
    """Sides of the smallest nearly square grid that holds all row numbers."""
    a = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return a, max(1, -(-rows // a))


def group_count(rows: int) -> int:
    return min(MAX_GROUPS, max(MIN_GROUPS, -(-rows // GROUP_ROWS)))


def divided(x, by: int):
    """Whole part of a quotient, exact for every long."""
    return F.call_function("div", x, F.lit(by).cast("long"))


def permuted(number, rows: int, seed: int):
    """The place of row ``number`` (0 to rows - 1) in the shuffle, as a column."""
    a, b = domain(rows)
    keys = F.array(*[
        F.struct(F.lit(k).cast("long").alias("k"), F.lit(q).cast("long").alias("q"),
                 F.lit(b if i % 2 else a).cast("long").alias("m"))
        for i, (k, q) in enumerate(round_keys(seed))])

    def one_round(half, key):
        mixed = (half["r"] * FACTOR + key["k"]) % PRIME
        return F.struct(half["r"].alias("l"), ((half["l"] + (mixed * mixed + key["q"]) % PRIME) % key["m"]).alias("r"))

    def once(x):
        start = F.struct(divided(x, b).alias("l"), (x % b).alias("r"))
        return F.aggregate(keys, start, one_round, lambda half: half["l"] * b + half["r"])

    steps = min(WALK, a * b - rows)
    place = once(number)
    if steps > 0:
        place = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), place,
                            lambda x, _: F.when(x < rows, x).otherwise(once(x)))
    return F.when(place < rows, place).otherwise(F.raise_error(F.lit("cycle walk did not end")))


def numbered(df: DataFrame, id_col: str, order: list[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with a global row number from 0 without gaps, and the number of rows.

    Rows are numbered by a mixed group of the id, then by ``order``; the number depends on the rows
    alone, not on files or partitions.  Equal rows are interchangeable.
    """
    rows = df.count()
    groups = group_count(rows)
    group = F.pmod(F.pmod(F.coalesce(column(id_col).cast("long"), F.lit(0)), F.lit(PRIME)) * FACTOR, F.lit(PRIME)) % groups
    counts = df.groupBy(group.alias("__group")).agg(F.count(F.lit(1)).alias("__n"))
    # at most MAX_GROUPS rows: one task adds them up, and every task gets them
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__group").orderBy(*[column(c).asc_nulls_first() for c in order])
    return (df.withColumn("__group", group)
            .withColumn("__at", F.row_number().over(within))
            .join(F.broadcast(offsets), "__group")
            .withColumn(name, F.col("__before") + F.col("__at") - 1)
            .drop("__group", "__at", "__before")), rows


def shards(df: DataFrame, shard_count: int = 8, seed: int = 20240229, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Shard and slot of every row, in a shuffled order that the seed alone decides.

    The rows are numbered, the number is permuted, and place p goes to shard p mod n, slot p div n:
    counts differ by one at most and slots have no gaps.  A null text has size 1 and checksum 0; a null
    id is numbered first of its group; rows that repeat get a place each; no rows give no rows.  Other
    columns are not read.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    narrow = df.select(column(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows, n = numbered(narrow, "doc_id", ["doc_id", "size", "text_crc32"], "__number")
    return (rows.withColumn("__place", permuted(F.col("__number"), n, seed))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    (F.col("__place") % shard_count).cast("int").alias("shard"),
                    divided(F.col("__place"), shard_count).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def oracle(shard_count: int = 8, seed: int = 20240229) -> str:
    """The same law for DuckDB, with the checksum computed byte by byte."""
    bits = []
    for i in range(8):
        c = 1 << i
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        bits.append(f"((x >> {i}) & 1) * {c}")
    table = "0"
    for term in bits:
        table = f"xor({table}, {term})"
    spread = table.replace("x >>", "xor(a, b) >>")
    steps = "SELECT id, p, x // b AS l0, x % b AS r0, a, b, n FROM {src}"
    for i, (k, q) in enumerate(round_keys(seed)):
        mod = "b" if i % 2 else "a"
        t = f"((r{i} * {FACTOR} + {k}) % {PRIME})"
        steps = (f"SELECT id, p, a, b, n, r{i} AS l{i + 1}, (l{i} + ({t} * {t} + {q}) % {PRIME}) % {mod} AS r{i + 1} FROM ({steps})")
    once = f"SELECT id, l{ROUNDS} * b + r{ROUNDS} AS x, a, b, n FROM ({steps})"
    first = once.replace("{src}", "(SELECT id, 0 AS p, id AS x, a, b, n FROM grid)")
    again = once.replace("{src}", "(SELECT id, 0 AS p, x, a, b, n FROM walk WHERE x >= n)")
    groups = f"least({MAX_GROUPS}, greatest({MIN_GROUPS}, (n + {GROUP_ROWS - 1}) // {GROUP_ROWS}))"
    return f"""
WITH RECURSIVE parts AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, count(*) OVER () AS n,
    list_transform(list_filter(string_split(regexp_replace(hex(coalesce(text, '')), '(..)', '\\1,', 'g'), ','),
      lambda h: h <> ''), lambda h: CAST(('0x' || h) AS BIGINT)) AS bytes
  FROM documents),
sums AS (
  SELECT doc_id, size, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda a, b: xor(a >> 8, {spread})), 4294967295) AS text_crc32 FROM parts),
numbered AS (
  SELECT doc_id, size, text_crc32, n, row_number() OVER (ORDER BY
    (((coalesce(doc_id, 0) % {PRIME} + {PRIME}) % {PRIME}) * {FACTOR} % {PRIME}) % {groups},
    doc_id NULLS FIRST, size, text_crc32) - 1 AS id FROM sums),
sides AS (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM numbered),
grid AS (SELECT *, (n + a - 1) // a AS b FROM sides),
walk AS ({first} UNION ALL {again})
SELECT g.doc_id, g.size, g.text_crc32, 'rows' AS law, CAST(w.x % {shard_count} AS INTEGER) AS shard,
  w.x // {shard_count} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM grid g JOIN walk w ON g.id = w.id AND w.x < w.n"""
