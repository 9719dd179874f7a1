"""Generated messages, a pure function of a row number: the same number gives the same message.

Works on any frame with an integral column: ``spark.range``, a ``rate`` stream (which also limits
the rate), or the bookmarks of a stored topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.segments import whole_part

# Symbols, item names, user names and filler lengths of the generated messages.
SYMBOLS = [
    "MMM", "ABBV", "ALV", "GOOGL", "AMZN", "AMGN", "ABI", "APPL", "BHP", "BA", "BP", "BATS", "CVX",
    "CSCO", "C", "KO", "DD", "XOM", "FB", "GE", "GSK", "HSBA", "INTC", "IBM", "JNJ", "JPM", "MA",
    "MCD", "MRK", "MSFT", "NESN", "NOVN", "NVDA", "ORCL", "PEP", "PFE", "PM", "PG", "ROG", "RY",
    "RDSA", "SMSN", "SAN", "SIE", "TSM", "TOT", "V", "WMT", "DIS",
]
ORDER_NAMES = ["A", "AA", "CSB", "LSL", "GQ", "WO", "ZES", "CX", "OVS", "EN"]
USER_NAMES = ["abb", "al", "joe", "steve", "charles", "bob", "peter"]
MARKET_FILLER, ORDER_FILLER, SOAK_FILLER = 450, 390, 1000
MAX_PRICE, MAX_BUYER_NUMBER, GROUPS = 1000, 100000, 9

_MODULUS = 2147483647  # 2^31 - 1, prime
_FACTOR = 48271        # a full-period multiplier for it


def draw(number: str, stream: int, bound: int) -> Column:
    """A repeatable draw from 0..bound-1 for a row number; ``stream`` keeps fields independent.

    Two rounds of multiply-and-reduce in 64-bit integers, inside generated code; no state and no
    ``rand``, so a recomputed task yields the same rows.
    """
    x = (F.col(number) % _MODULUS + 7919 * stream + 1) * _FACTOR % _MODULUS
    x = (x + 104729 * stream) * _FACTOR % _MODULUS
    return whole_part(x, 1024) % bound


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def market_data(rows: DataFrame, number: str = "id") -> DataFrame:
    """symbol, bid, ask (whole cents below the price limit) and filler text."""
    cents = MAX_PRICE * 100
    return rows.select(
        F.col(number).alias("num"), _pick(SYMBOLS, draw(number, 1, len(SYMBOLS))).alias("symbol"),
        (draw(number, 2, cents) / 100).alias("bid"), (draw(number, 3, cents) / 100).alias("ask"),
        F.repeat(F.lit("a"), MARKET_FILLER).alias("data"))


def orders_with_buyer(rows: DataFrame, number: str = "id") -> DataFrame:
    return rows.select(
        F.md5(F.col(number).cast("string")).alias("id"),
        _pick(ORDER_NAMES, draw(number, 1, len(ORDER_NAMES))).alias("name"),
        (F.col(number) + 1).alias("itemId"),
        F.struct(F.repeat(F.lit("a"), ORDER_FILLER).alias("str"),
                 _pick(USER_NAMES, draw(number, 2, len(USER_NAMES))).alias("username"),
                 draw(number, 3, MAX_BUYER_NUMBER).cast("int").alias("num")).alias("buyer"))


def counter_lines(rows: DataFrame, number: str = "id", filler: int = SOAK_FILLER) -> DataFrame:
    return rows.select(F.col(number).alias("num"), F.repeat(F.lit("a"), filler).alias("data"))


def grouped_counters(rows: DataFrame, number: str = "id") -> DataFrame:
    """counter, a group 1..9 and text."""
    return rows.select(F.col(number).alias("counter"),
                       (draw(number, 1, GROUPS) + 1).cast("int").alias("group"),
                       F.concat(F.lit("Message "), F.col(number)).alias("data"))


def block_breaks(rows: DataFrame, number: str = "id", players: int = 10, per_second: int = 2,
                 start_ms: int = 0, flag_chance: float = 0.025,
                 fast_player_chance: float = 0.6) -> DataFrame:
    """Block-break events of ``players`` players in turn; player 0 finds diamonds far too often."""
    player = F.col(number) % players
    chance = F.when(player == 0, fast_player_chance).otherwise(flag_chance)
    tick = whole_part(F.col(number), players)
    return rows.select(
        player.cast("int").alias("playerId"),
        (F.lit(start_ms) + tick * (1000 // per_second)).cast("bigint").alias("timestamp"),
        (draw(number, 1, 1_000_000) < chance * 1_000_000).alias("isDiamond"))


def numbers(spark: SparkSession, count: int, partitions: int | None = None) -> DataFrame:
    """Row numbers for a bounded generator, split over executors by Spark."""
    return spark.range(0, count, 1, partitions)


def ticking_numbers(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """Row numbers arriving at a fixed rate."""
    return (spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
            .select(F.col("value").alias("id"), F.col("timestamp").alias("ts")))
