"""Substring dedup, periodic runs and importance resampling against brute-force versions and on odd rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import catalog, doubling, periodic, resampling
from tidelog.llm.wordtable import words_of

DOCS = "doc_id bigint, text string"


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def frame(spark, rows, schema=DOCS, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


# words of texts


@pytest.mark.parametrize("texts", [[], [None], ["", " \t\n"], ["a b", "b", None, "ü\x0bü  b\r", "no\x1cbreak here"], [" x", "x "]])
def test_words_of_texts_are_those_between_ascii_spaces(texts):
    found = words_of(pa.array(texts, pa.string()))
    spelled = [found.spellings[c].as_py().decode() for c in found.codes.tolist()]
    assert [spelled[a:b] for a, b in zip(found.bounds, found.bounds[1:])] == [spaced(t) for t in texts]


def test_words_of_a_part_of_a_column():
    whole = pa.array(["one two", "three", None, "Four FIVE Ü"])
    found = words_of(whole.slice(1), lower=True)
    assert [found.spellings[c].as_py().decode() for c in found.codes.tolist()] == ["three", "four", "five", "Ü"]


# substring dedup


def brute_dedup(rows, length):
    first = {}
    for key, text in rows:
        words = spaced(text)
        for i in range(len(words) - length + 1):
            gram = tuple(words[i:i + length])
            if key is not None:
                first[gram] = min(first.get(gram, key), key)
    out = []
    for key, text in rows:
        words = spaced(text)
        gone = set()
        for i in range(len(words) - length + 1):
            if key is not None and first[tuple(words[i:i + length])] < key:
                gone |= set(range(i, i + length))
        out.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def by_text(rows):
    return sorted(rows, key=repr)


def corpus(seed, n=60):
    """Texts that share passages, starts and ends of passages, and repeat words, ids and rows."""
    rng = random.Random(seed)
    passages = [[f"p{k}w{rng.randrange(9)}" for _ in range(rng.choice([5, 13, 14, 30, 90]))] for k in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a = rng.choice([0, 0, rng.randrange(len(p))])
            words += p[a:rng.choice([len(p), len(p), a + rng.randrange(1, len(p) + 1)])]
            words += [f"x{rng.randrange(4)}" for _ in range(rng.randrange(20))]
        rows.append((rng.choice([i, i, i, None, -i, i // 2]), " ".join(words)))
    rows += [(5, None), (6, ""), (None, None), (7, " \n")]
    return rows + rng.sample(rows, 8)


@pytest.mark.parametrize("length", [2, 3, 13, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_windows_are_removed(spark, length, seed):
    rows = corpus(seed)
    got = doubling.without_repeats(frame(spark, rows, parts=4), length=length)
    found = [tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert by_text(found) == by_text(brute_dedup(rows, length))


def test_a_passage_shared_by_all_documents_over_many_slices(spark):
    passage = " ".join(f"s{i}" for i in range(25))
    rows = [(i, f"a{i} b{i} {passage} c{i}") for i in range(300)] + [(i, passage) for i in range(300, 600)]
    got = {r["doc_id"]: r for r in doubling.without_repeats(frame(spark, rows, parts=40)).collect()}
    assert got[0]["n_removed"] == 0
    assert {got[i]["kept_text"] for i in range(300, 600)} == {""}
    assert all(got[i]["kept_text"] == f"a{i} b{i} c{i}" for i in range(1, 300))


def test_dedup_keeps_other_columns_and_replaces_clashing_ones(spark):
    rows = [("b", "x " * 13, 1, 2, 3, 4), ("a", "x " * 13, 5, 6, 7, 8)]
    docs = spark.createDataFrame(rows, "name string, body string, N_Words int, tid int, id int, marks int")
    got = doubling.without_repeats(docs, "body", "name")
    assert got.columns == ["name", "body", "tid", "id", "marks", "n_words", "n_removed", "kept_text"]
    assert sorted(tuple(r)[2:] for r in got.collect()) == [(2, 3, 4, 13, 13, ""), (6, 7, 8, 13, 0, "x " * 12 + "x")]


def test_dedup_of_an_empty_table(spark):
    assert doubling.without_repeats(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError, match="two words"):
        doubling.without_repeats(spark.createDataFrame([], DOCS), length=1)


# periodic runs


def brute_runs(w, least=6, power=4):
    out = []
    for p in range(1, len(w) // power + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            s, e = i, j + p
            if j > i and e - s >= max(least, power * p) and not any(
                    all(w[k] == w[k + q] for k in range(s, e - q)) for q in range(1, p)):
                out.append((s, e - s, p))
            i = max(j, i + 1)
    out.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, n, p in out for i in range(s + p, s + n)}
    return out, [x for i, x in enumerate(w) if i not in gone]


def periodic_words(rng):
    a = rng.choice([1, 2, 3, 5, 30, 300])
    w = [rng.randrange(a) for _ in range(rng.randrange(260))]
    for _ in range(rng.randrange(4)):
        q = rng.choice([1, 2, 3, 5, 8, 13, 40, 50, 64, 70])
        u = [rng.randrange(a) for _ in range(q)]
        at = rng.randrange(len(w) + 1)
        w[at:at] = (u * 7)[:rng.randrange(q, 6 * q + 1)]
    return [f"w{x}" for x in w]


@pytest.mark.parametrize("short, rounds", [(31, 12), (1, 12), (7, 1), (31, 0)])
def test_runs_by_brute_force(monkeypatch, short, rounds):
    monkeypatch.setattr(periodic, "SHORT", short)
    monkeypatch.setattr(periodic, "ROUNDS", rounds)
    rng = random.Random(short + rounds)
    for _ in range(25):
        texts = [periodic_words(rng) for _ in range(5)]
        words = words_of(pa.array([" ".join(t) for t in texts]))
        rows, stay = periodic.detected(words)
        spelled = [words.spellings[c].as_py().decode() for c in words.codes.tolist()]
        for i, text in enumerate(texts):
            runs, kept = brute_runs(text)
            assert [tuple(r[1:]) for r in rows.tolist() if r[0] == i] == runs
            a, b = words.bounds[i:i + 2]
            assert [spelled[k] for k in range(a, b) if stay[k]] == kept


def split_by_rare_words(words, low, high, least=6, power=4):
    if high - low < least:
        return []
    part = words[low:high]
    cuts = [low + i for i, w in enumerate(part) if part.count(w) < power]
    if not cuts:
        return [(low, high)]
    edges = [low - 1, *cuts, high]
    return [s for a, b in zip(edges, edges[1:]) for s in split_by_rare_words(words, a + 1, b, least, power)]


@pytest.mark.parametrize("rounds", [0, 1, 12])
def test_segments_by_recursion(monkeypatch, rounds):
    monkeypatch.setattr(periodic, "ROUNDS", rounds)
    rng = random.Random(rounds)
    for _ in range(60):
        words = [rng.randrange(rng.choice([2, 8, 20])) for _ in range(rng.randrange(1, 160))]
        want = split_by_rare_words(words, 0, len(words))
        assert sorted(periodic.settled(words, 6, 4)) == want
        assert sorted(periodic.stable_segments(np.array(words), np.zeros(len(words), np.int32), 6, 4)) == want


@pytest.mark.parametrize("words", [["a"] * 200_000, ["a", "b", "c"] * 70_000, [f"x{i}" for i in range(50_000)] * 4,
                                   [random.Random(3).choice("ab") for _ in range(200_000)]])
def test_very_long_texts(words):
    rows, _ = periodic.detected(words_of(pa.array([" ".join(words)])))
    for _, start, length, period in rows.tolist()[:2000]:
        w = words[start:start + length]
        assert length >= max(6, 4 * period) and w[period:] == w[:-period]


def brute_digest(key, text):
    w = spaced(text)
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(w)
    if key is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs, kept = brute_runs(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    return (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(kept)))


def test_digests_of_runs(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(periodic_words(rng))) for i in range(120)] + [(1000, None), (1001, ""), (None, "a " * 9), (3, "a " * 9)]
    got = [tuple(r) for r in periodic.digests(frame(spark, rows)).collect()]
    assert by_text(got) == by_text([brute_digest(*r) for r in rows])
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(120))


def test_op13_on_a_table_of_its_own(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(periodic_words(rng))) for i in range(40)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in catalog.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert by_text(got) == by_text([brute_digest(*r) for r in rows])


def test_runs_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "b b b b b b c", 9)], "doc_id int, body string, Runs int")
    got = periodic.runs(docs, "body")
    assert got.columns == ["doc_id", "body", "n_words", "runs", "collapsed"]
    row = got.collect()[0]
    assert (row["n_words"], [tuple(r) for r in row["runs"]], row["collapsed"]) == (7, [(0, 6, 1)], "b c")
    assert periodic.digests(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError, match="four periods"):
        periodic.runs(docs, "body", power=3)


# importance resampling


def brute_resampled(rows, target, grams=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    def words(text):
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)

    def slots(ws):
        return [zlib.crc32(" ".join(ws[i:i + n]).encode()) % buckets for n in range(1, grams + 1) for i in range(len(ws) - n + 1)]

    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for b in slots(words(t)):
                out[b] += 1
        return out

    s, t = counts([r[1] for r in rows]), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for key, text in rows:
        ws = words(text)
        f = slots(ws)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(ws), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    rank = {id(r): i + 1 for i, r in enumerate(able[:percent * len(able) // 100])}
    return [(*r, rank.get(id(r))) for r in out]


def some_texts(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"Wort{i}" for i in range(40)] + ["über", "ÄRGER", "a_b", "3x", "日本", "x y", "\x1c", "don't", "—", "\U0001f600"]
    return [" ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".\n", "-"]) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("grams, percent, min_words, coarse", [(1, 10, 20, 4096), (3, 50, 1, 4), (2, 100, 0, 1)])
def test_resampling_by_brute_force(spark, monkeypatch, grams, percent, min_words, coarse):
    monkeypatch.setattr(resampling, "COARSE", coarse)
    monkeypatch.setattr(resampling, "AT_ONCE", 64)
    rows = [(i, t) for i, t in enumerate(some_texts(4, 150))] + [(900, None), (901, ""), (None, "wort1 " * 30)]
    target = [*some_texts(5, 10), None, ""]
    got = resampling.resampled(frame(spark, rows), frame(spark, [(1, t) for t in target]), grams=grams, percent=percent,
                               min_words=min_words, buckets=997)
    found = [tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    assert by_text(found) == by_text(brute_resampled(rows, target, grams, 997, percent=percent, min_words=min_words))


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, 7) for i in (5, 3, 9)] + [(1, 4), (2, 8), (4, -3)]
    scored = spark.createDataFrame(rows, "doc_id bigint, score bigint")
    got = resampling.drawn(scored, scored["score"] > -5, "score", "doc_id", 3)
    assert {r["doc_id"]: r["rank"] for r in got.collect()} == {2: 1, 3: 2, 5: 3, 9: None, 1: None, 4: None}


def test_resampling_of_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2), (1, "a b", 1, 2)], "doc_id bigint, text string, Rank int, n int")
    got = resampling.resampled(docs, docs, min_words=1, percent=50)
    assert got.columns == ["doc_id", "text", "n", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(r["rank"] or 0 for r in got.collect()) == [0, 1]


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert resampling.resampled(none, none).collect() == []
    one = spark.createDataFrame([(1, "a a")], DOCS)
    assert [tuple(r) for r in resampling.resampled(one, none, keep=["doc_id"], min_words=1, percent=100).collect()] == [
        tuple(r) for r in brute_resampled([(1, "a a")], [], min_words=1, percent=100)]
