"""URL filter: rules on host and path, and a logistic regression on hashed character n-grams.

The model learns from a small labelled table of URLs: n-grams of the host (between boundary marks) and
of the path, hashed to a fixed number of weights.  Rules come first; the model judges the rest.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import appended, column, double

#: (host, path, verdict): the longest host, then path, that fits decides.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))
LENGTHS = (3, 4, 5)
DIMENSIONS = 1 << 16
#: Parts of the labelled rows, each scored by a model of the others to set the threshold.
FOLDS = 5
#: At most so many labelled rows train the model: those of the smallest checksum.
MAX_LABELLED = 20_000

#: Labelled hosts with a path: 1 to block.
BLOCKED = """casino-royal.example/slots/ free-casino.example/en/ bet-online.example/odds/ best-bets.example/
    poker-night.example/play/ jackpot-win.example/en/1 mega-slots.example/ win-cash.example/now
    cheap-pills.example/buy/ buy-viagra.example/ online-pharmacy-cheap.example/de/ pills-now.example/
    replica-watches.example/ cheap-replica.example/shop fast-loans.example/apply payday-loan.example/
    spam-farm.example/ link-farm.example/en/2 seo-farm.example/links click-farm.example/ spam-mail.example/en/
    xxx-video.example/watch adult-cams.example/ hot-singles.example/ escort-girls.example/ porn-tube.example/
    free-money.example/ crypto-giveaway.example/claim free-iphone.example/win lottery-win.example/
    warez-crack.example/keygen torrent-free.example/ casino-bonus.example/fr/ sports-bets.example/es/
    cheap-meds.example/ diet-pills.example/en/3 win-prize.example/ free-bets.example/ spam-blog.example/
    casino.example/ bets.example/ pills.example/ spam.example/ farm-links.example/
    ad-track.example/pixel ads-server.example/banner m.track-click.example/ www.ads-network.example/en/12
    adult-video.example/ www.adult-chat.example/en/5 m.adult-x.example/de/17 popup-ads.example/fr/9?page=2
    blog.casino-online.example/en/41.html www.casino-win.example/es/77 m.free-bets.example/de/3#top
    www.cheap-pills.example/en/808?utm_source=feed blog.spam-site.example/en/19/ www.spam-farm.example/fr/61
    m.poker-win.example/en/2005 blog.pills-shop.example/es/6/ www.bets-casino.example/en/7?page=2
    ads-tracker.example/en/63 track.ads-click.example/en/8126.html""".split()
ALLOWED = """news.example/en/2024 www.library.example/books blog.garden.example/roses university.example/physics
    docs.python.example/3/ wiki.example/en/History shop.example/cart/ www.museum.example/visit m.weather.example/today
    city-council.example/minutes recipes.example/bread/ blog.travel.example/italy forum.linux.example/kernel
    journal.example/article/17 maps.example/de/ hospital.example/contact school.example/timetable
    www.theatre.example/tickets blog.kitchen.example/soup.html data.example/fr/8811 www.river.example/es/42
    m.station.example/en/1203.html thesis.example/en/77 theory.example/en/505?page=2 other.example/en/9?utm_source=feed
    thermal.example/de/391/ thistle.example/en/18.html blog.motion.example/en/2220 nation.example/en/2755
    www.healthy.example/en/341 station.example/fr/823 weather.example/es/4000 m.thread.example/en/7500
    northern.example/en/4635/ www.ringing.example/en/7209.html together.example/en/6375/ blog.ashen.example/en/1313
    earth-science.example/en/1 farmers-market.example/stalls window-repair.example/ winter.example/en/22
    bethany-church.example/ between.example/en/95 freedom.example/en/31 pillar-news.example/ cheaptrick-fans.example/
    www.tension.example/en/6559 tithe.example/de/6864 that.example/en/5706#top thin.example/en/486
    there.example/en/8868 m.therapy.example/en/5508 anthem.example/fr/1175 mention.example/es/7096""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: url, label (1: block)."""
    rows = [(f"http://{u}", 1) for u in BLOCKED] + [(f"http://{u}", 0) for u in ALLOWED]
    return spark.createDataFrame(rows, "url string, label int")


def host_of(url):
    """Between the first :// and the next /, ? or #, with A to Z in lower case; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url):
    """Behind the host up to ? or #; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host, path, rules=RULES):
    """Name and verdict of the rule that fits with the longest host and path, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), r[0], r[1]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in ordered]
    return tuple(F.coalesce(*[F.when(f, F.lit(value(r))) for f, r in zip(fits, ordered)])
                 for value in (lambda r: r[0] + r[1], lambda r: r[2]))


def hashed_grams(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed n-gram) of every n-gram of ``^host$`` and ``path`` of all rows, by rolling hashes."""
    parts = [b"^" + h.encode() + b"$" for h in hosts] + [p.encode() for p in paths]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    sizes = np.array(list(map(len, parts)), np.int64)
    part = np.repeat(np.arange(len(parts)), sizes)
    rows, found = [], []
    for n in LENGTHS:
        if len(data) < n:
            continue
        code = np.zeros(len(data) - n + 1, np.uint64)
        for i in range(n):
            code = code * np.uint64(0x100000001B3) + data[i:len(data) - n + 1 + i] + np.uint64(1)
        inside = part[n - 1:] == part[:len(code)]
        own = part[:len(code)][inside]
        kind = (own >= len(hosts)).astype(np.uint64) + np.uint64(2 * n)  # hosts and paths apart
        code = (code[inside] ^ (kind << np.uint64(57))) * np.uint64(0x9E3779B97F4A7C15)
        rows.append(own % max(1, len(hosts)))
        found.append((code >> np.uint64(40)).astype(np.int64) % DIMENSIONS)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(found)


def _margins(weights: np.ndarray, bias: float, hosts: list[str], paths: list[str]) -> np.ndarray:
    rows, grams = hashed_grams(hosts, paths)
    n = np.bincount(rows, minlength=len(hosts))
    return np.bincount(rows, weights[grams], len(hosts)) / np.sqrt(np.maximum(n, 1)) + bias


@dataclass(frozen=True)
class Model:
    """Weights of the n-grams, bias, and the score from which a URL is blocked."""

    weights: np.ndarray
    bias: float
    threshold: float

    def scores(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-_margins(self.weights, self.bias, hosts, paths)))


def train(hosts: list[str], paths: list[str], y: np.ndarray, steps: int = 800, rate: float = 4.0,
          penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps; either label counts as much as the other."""
    weights, bias = np.zeros(DIMENSIONS), -1.0
    if len(set(y.tolist())) < 2:
        return weights, bias
    at, grams = hashed_grams(hosts, paths)
    share = 1 / np.sqrt(np.maximum(np.bincount(at, minlength=len(y)), 1))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        margin = np.bincount(at, weights[grams], len(y)) * share + bias
        error = (1 / (1 + np.exp(-margin)) - y) * balance / len(y)
        weights -= rate * (np.bincount(grams, (error * share)[at], DIMENSIONS) + penalty * weights)
        bias -= rate * error.sum()
    return weights, bias


def fold_threshold(hosts: list[str], paths: list[str], y: np.ndarray) -> float:
    """The middle between two scores that best parts the labels (mean of the shares told rightly) where each row is scored by
    a model of the other folds; of equally good ones the lowest, 0.5 without rows of both labels."""
    fold, scores = np.arange(len(y)) % FOLDS, np.zeros(len(y))
    for k in range(FOLDS):
        others, own = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        model = Model(*train([hosts[i] for i in others], [paths[i] for i in others], y[others]), 0.5)
        scores[own] = model.scores([hosts[i] for i in own], [paths[i] for i in own])
    if len(set(y.tolist())) < 2:
        return 0.5
    seen = np.unique(scores)
    between = np.append(seen[0], (seen[1:] + seen[:-1]) / 2)
    rightly = [((scores[y == 1] >= t).mean() + (scores[y == 0] < t).mean(), -t) for t in between]
    return -max(rightly)[1]


def fit(labelled: DataFrame, max_rows: int = MAX_LABELLED) -> Model:
    """Train on a bounded number of labelled rows (url, label), the threshold by folds of them.

    Rows with a null url or label are left out; without rows of both labels everything is allowed.
    """
    url = F.col("url")
    rows = (labelled.where(url.isNotNull() & F.col("label").isNotNull())
            .select(host_of(url).alias("host"), path_of(url).alias("path"), F.col("label").cast("int").alias("label"),
                    F.xxhash64(url).alias("order"))
            .orderBy("order", "host", "path").limit(max_rows).collect())
    y = np.array([r["label"] for r in rows], float)
    hosts, paths = [r["host"] for r in rows], [r["path"] for r in rows]
    return Model(*train(hosts, paths, y), fold_threshold(hosts, paths, y))


def _start(model: Model):
    def work(hosts, paths):
        return [model.scores([h or "" for h in hosts], [p or "" for p in paths]).tolist()]

    return work


def judged(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES, threshold: float | None = None,
           id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Host, path, rule, verdict and score of every url.

    A null url, or one without ``://``, has an empty host and path and is judged by the model's bias
    alone (allowed).  Repeated rows each get a row; no rows give none.  Other columns are not read.
    """
    model = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    url = column(url_col)
    parts = pages.select(column(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    scored = appended(parts, ["host", "path"], ["page_id", "host", "path"], [double("score")],
                      partial(_start, model))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # an empty host says nothing: it isn't blocked
    least = model.threshold if threshold is None else threshold
    by_model = F.when((F.col("score") >= least) & (F.col("host") != ""), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"),
                         "score")
