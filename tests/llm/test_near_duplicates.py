"""Fingerprints, BK-trees and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import bk_simhash, near_copies
from tidelog.llm.components import components


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("shard_rows", [1, 1024])
def test_links_lose_no_component(spark, shard_rows):
    rnd = random.Random(9)
    prints = {0, 2 ** 64 - 1, 3, 5}
    for _ in range(60):
        value = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 6)):  # chains of near ones
            prints.add(value)
            for _ in range(rnd.randint(0, 3)):
                value ^= 1 << rnd.randrange(64)
    prints |= {7 << 60 | rnd.getrandbits(10) for _ in range(200)}  # one crowded shard
    prints = sorted(prints)
    near = [(signed(a), signed(b)) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 2]
    expected = brute_components(near, [signed(p) for p in prints])
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = bk_simhash.links(df, shard_rows)
    assert all((r["a"] ^ r["b"]) for r in links.collect())
    got = brute_components([(r["a"], r["b"]) for r in links.collect()], [signed(p) for p in prints])
    assert got == expected
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    assert {n: roots.get(n, n) for n in expected} == expected


def test_components_of_a_long_chain_loops_and_repeats(spark):
    edges = [(i, i + 1) for i in range(300)] + [(500, 500), (None, 3), (7, 8), (8, 7)] + [(1000, 1000 + i) for i in range(1, 200)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {roots[i] for i in range(301)} == {0} and {roots[1000 + i] for i in range(200)} == {1000} and 500 not in roots


def test_bk_tree_finds_all_within_the_radius():
    rnd = random.Random(4)
    values = [rnd.getrandbits(64) for _ in range(50)]
    values += [v ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for v in values]
    tree = bk_simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.within(v, 2)) == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= 2]


def test_documents(spark):
    long_text = " ".join(f"w{i}" for i in range(5000))
    texts = [None, "", " \n", "One two", "one TWO", "a b c d e f", "A b c d e f", long_text, long_text + " x", "É b", "é b"]
    rows = [(10 + i, t, 5) for i, t in enumerate(texts)] + [(15, "A b c d e f", 5), (None, "one two", 6), (None, "alone here", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("text_hash", F.lit("clash"))
    out = bk_simhash.clustered(docs).collect()
    assert len(out) == len(rows)
    prints = {}
    for i, t, _ in rows:
        prints.setdefault(brute_fingerprint(t or ""), []).append(i)
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    group = brute_components(near, list(prints))
    for r in out:
        fp = r["fp"] % (1 << 64)
        ids = [i for p, own in prints.items() if group[p] == group[fp] for i in own if i is not None]
        assert r["component_id"] == (min(ids) if ids else None)
    kept = bk_simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    wanted = [min((i for p, own in prints.items() if group[p] == g for i in own if i is not None), default=None)
              for g in set(group.values())]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, wanted))
    assert bk_simhash.clustered(docs.where("false")).count() == 0
    assert bk_simhash.deduplicated(docs.where("false")).count() == 0


def test_deduplicated_tells_ids_from_fingerprints(spark):
    rows = [(0, "the first text of three words"), (None, ""), (5, "another text with other words")]
    kept = bk_simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {0, None, 5}


def test_deduplicated_keeps_one_row_of_a_component_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(4000))
    rows = [(None, text), (None, text + " x"), (None, text + " x")]
    found = bk_simhash.clustered(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found.select("root").distinct().count() == 1 and found.select("fp").distinct().count() >= 1
    assert bk_simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


@pytest.mark.parametrize("dedup", [bk_simhash.deduplicated, near_copies.without_near_copies])
def test_columns_named_like_inner_ones_keep_their_values(spark, dedup):
    rows = [(1, "some words that stay here", 77, "keep", "a", "b", "c")]
    schema = "doc_id long, text string, __n int, __text_hash string, __node string, __id string, root string"
    kept = dedup(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "__n", "__text_hash", "__node", "__id", "root"]
    assert [tuple(r) for r in kept.collect()] == rows


# near copies by similarity


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def similarity(a, b):
    return len(a & b) / len(a | b)


def one_of_each_group(texts):
    """The smallest ids of the groups of texts (by id) that links of similarity 0.8 connect."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = {}
    for i, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(i)
    pairs = {(min(i, j), max(i, j)) for own in holders.values() for i in own for j in own[:50] if i != j}
    root = brute_components([p for p in pairs if similarity(sets[p[0]], sets[p[1]]) >= 0.8], list(texts))
    return set(root.values())


def planted(seed, originals=40, per=6):
    """Texts with copies in which some words are changed, dropped or added."""
    rnd = random.Random(seed)
    out = {}
    for _ in range(originals):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([3, 8, 30, 120, 400]))]
        for _ in range(rnd.randint(1, per)):
            copy = list(words)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 5, 12])):
                at = rnd.randrange(len(copy))
                copy[at:at + 1] = rnd.choice([["new"], [], [copy[at].upper(), "more"]])
                copy = copy or ["left"]
            out[len(out)] = " ".join(copy)
    return out


@pytest.mark.parametrize("seed, tree_rows", [(1, 1 << 15), (2, 1 << 15), (3, 4)])
def test_planted_near_copies(spark, monkeypatch, seed, tree_rows):
    monkeypatch.setattr(near_copies, "PIVOTS", 2)
    texts = planted(seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    kept = {r["doc_id"] for r in near_copies.without_near_copies(docs, tree_rows=tree_rows).collect()}
    want = one_of_each_group(texts)
    gone = set(texts) - want
    assert want <= kept  # nothing that has no near copy goes
    assert len(gone & kept) <= 0.1 * len(gone) and len(gone) > 30
    if tree_rows > 4:
        assert kept == want


def test_groups_of_near_copies_on_odd_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(400))
    rows = [(3, long_text), (None, long_text + " x"), (2, long_text.upper() + " y"), (9, None), (8, ""), (8, ""), (7, " \n"),
            (None, "only without an id"), (None, "ONLY without an id"), (5, "one two"), (4, "two one"), (4, "two one"), (4, "and four")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n int")
    kept = near_copies.without_near_copies(docs).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(map(str, [2, 7, None, 5, 4, 4]))
    assert {r["text"] for r in kept if r["doc_id"] == 4} == {"two one", "and four"}
    assert near_copies.without_near_copies(docs.where("false")).collect() == []


def test_trees_hold_many_values_and_follow_only_edges_in_reach():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 60, 50)]))
    tree = near_copies.Tree(values)
    query, node, distance = (np.concatenate(c) for c in zip(*tree.within(4, np.arange(len(values)))))
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    earlier = np.arange(len(values))[None, :] < np.arange(len(values))[:, None]
    assert set(zip(query.tolist(), node.tolist())) == set(zip(*(x.tolist() for x in np.nonzero((apart <= 4) & earlier))))
    assert (apart[query, node] == distance).all()
    assert len(values) > 1000 and tree.compared < 0.5 * len(values) ** 2


@pytest.mark.parametrize("sample, cell_rows", [(1 << 13, 1 << 12), (40, 1)])
def test_what_the_trees_do_not_link_is_found_exactly(spark, monkeypatch, sample, cell_rows):
    """With a radius of 0 the trees link next to nothing; one line that all texts have is frequent."""
    monkeypatch.setattr(near_copies, "SAMPLE_ROWS", sample)
    monkeypatch.setattr(near_copies, "CELL_ROWS", cell_rows)
    rnd, line = random.Random(12), " ".join(f"common{i}" for i in range(12))
    texts = []
    for _ in range(40):
        words = [f"v{rnd.randrange(900)}" for _ in range(rnd.choice([3, 9, 40, 120]))]
        texts.append(" ".join(words))
        for _ in range(3):
            near = list(words)
            near[rnd.randrange(len(near))] = f"z{rnd.randrange(900)}"
            texts.append(" ".join(near) + rnd.choice(["", " more", " " + line]))
        texts.append(line + " " + " ".join(words))
    rows = dict(enumerate(texts))
    kept = near_copies.without_near_copies(spark.createDataFrame(list(rows.items()), "doc_id long, text string"), radius=0)
    assert {r["doc_id"] for r in kept.collect()} == one_of_each_group(rows)


def compared_pairs(spark, monkeypatch, texts):
    """The ids kept, and how many pairs of texts were compared whole."""
    counts, confirmed = [], near_copies._confirmed

    def counted(rows, texts, links, *rest):
        counts.append(links.count())
        return confirmed(rows, texts, links, *rest)

    monkeypatch.setattr(near_copies, "_confirmed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in near_copies.without_near_copies(docs, radius=0).collect()}
    monkeypatch.setattr(near_copies, "_confirmed", confirmed)
    return kept, sum(counts)


def test_a_large_group_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    rnd = random.Random(21)
    words = [f"g{i}" for i in range(150)]
    texts = []
    for _ in range(160):
        near = list(words)
        for _ in range(rnd.randint(1, 3)):
            near[rnd.randrange(150)] = f"z{rnd.randrange(10 ** 6)}"
        texts.append(" ".join(near))
    kept, compared = compared_pairs(spark, monkeypatch, texts)
    assert kept == one_of_each_group(dict(enumerate(texts))) and len(kept) < 10
    assert compared < 10 * len(texts)  # there are 79 pairs a text


def test_passages_that_a_sample_does_not_show_are_no_meeting_place(spark, monkeypatch):
    """Each passage is in 16 of 800 texts, most in less than three rows of the sample."""
    monkeypatch.setattr(near_copies, "SAMPLE_ROWS", 40)
    rnd, found, cells = random.Random(22), [], near_copies._cells
    passages = [" ".join(f"p{k}x{i}" for i in range(40)) for k in range(50)]
    texts = [" ".join(f"u{rnd.randrange(10 ** 9)}" for _ in range(60)) + " " + passages[i % 50] for i in range(800)]
    monkeypatch.setattr(near_copies, "_cells", lambda *args: found.append(cells(*args)) or found[0])
    kept, compared = compared_pairs(spark, monkeypatch, texts)
    assert len(kept) == 800 and compared == 0 and found[0].count() == 0
