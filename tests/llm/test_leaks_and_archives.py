"""Benchmark leaks and archives: brute force, planted cases, round trips and broken files."""

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidelog.llm import latent, warc
from tidelog.llm.common import table

DATA = "/root/testdata/sf0.01"


def words_of(text):
    edges = latent.EDGES.decode()
    return [w.strip(edges) or w for w in text.lower().split()]


def brute_leaks(docs, items):
    """Items of which a text holds 80 % of the five-word runs."""
    runs = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, w in ((i, words_of(t)) for i, t in items)}
    for d, text in docs:
        w = words_of(text)
        own = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
        yield from ((d, i) for i, r in runs.items() if len(r & own) >= 0.8 * len(r))


def test_every_leak_of_the_given_tables(spark):
    docs, items = table(spark, DATA, "documents"), table(spark, DATA, "benchmark")
    found = {(r["doc_id"], r["item_id"]) for r in latent.leaked(docs, latent.indexes(docs, items)).collect()}
    pairs = brute_leaks([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert found == set(pairs) and found


def test_paraphrases_odd_rows_and_blocks(spark, monkeypatch):
    rnd = random.Random(1)
    common = "the of and to in is it that was for".split()
    rare = [f"word{rnd.getrandbits(30):x}" for _ in range(4000)]
    sentence = lambda n: [rnd.choice(common if k % 2 else rare) for k in range(n)]
    items = [(i, " ".join(sentence(rnd.randint(15, 60)))) for i in range(40)] + [(100, ""), (101, None), (102, "..."), (None, "x")]
    filler = lambda: " ".join(sentence(rnd.randint(30, 400)))
    docs, leaks = [(i, filler()) for i in range(60)], set()
    for k in range(40):
        words = items[k][1].split()
        if k % 3 == 1:  # a fifth of the words changed, and another case
            words = [w.upper() + "!" if j % 7 else "changed" for j, w in enumerate(words)]
        docs.append((1000 + k, f"{filler()} {' '.join(words)} {filler()}"))
        leaks.add((1000 + k, k))
    docs += [(2000, None), (2001, ""), (2002, " "), (2003, filler() * 50), (None, items[3][1]), (1000, docs[60][1])]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (2000, 15):
        monkeypatch.setattr(latent, "BLOCK_ITEMS", block)
        indexes = latent.indexes(frame, bench)
        got = [(r["doc_id"], r["item_id"]) for r in latent.leaked(frame, indexes).collect()]
        assert set(got) == leaks | {(None, 3)} and got.count((1000, 0)) == 2
        clean = latent.clean(frame, indexes)
        assert clean.columns == frame.columns
        assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs if d is not None and d < 1000 or d and d >= 2000}
    assert latent.leaked(frame, latent.indexes(frame, bench.where("false"))).count() == 0
    assert latent.leaked(frame.where("false"), latent.indexes(frame.where("false"), bench)).count() == 0


@pytest.mark.parametrize("count", [300, 1000, 2000])
def test_exact_copies_of_many_items(spark, count):
    docs = [r["text"] for r in table(spark, DATA, "documents").where("text is not null").orderBy("doc_id").collect()]
    rnd = random.Random(count)
    items, pool = [], [w for w in (t.split() for t in docs) if len(w) >= 80]
    while len(items) < count:
        words = rnd.choice(pool)
        n, at = rnd.randint(15, 59), rnd.randrange(len(words) - 60)
        items.append((len(items), " ".join(words[at:at + n])))
    items.append((count, "rather short item of seven words here"))  # among words of far more weight
    copies = []
    for k, text in [*rnd.sample(items[:-1], 200), items[-1]]:
        words = rnd.choice(pool)
        at = rnd.randrange(len(words))
        own = [f"rare{k}x{j}" for j in range(200)] if k == count else words
        copies.append((10_000_000 + k, " ".join([*own[:at % len(own)], *text.split(), *own[at % len(own):]])))
    frame = spark.createDataFrame(copies, "doc_id long, text string")
    weighed = table(spark, DATA, "documents").select("doc_id", "text").unionAll(frame)
    bench = spark.createDataFrame(items, "item_id long, text string")
    indexes = latent.indexes(weighed, bench)
    found = {(r["doc_id"], r["item_id"]) for r in latent.leaked(frame, indexes).collect()}
    lost = [d for d, _ in copies if (d, d - 10_000_000) not in found]
    assert not lost


def test_latent_spaces_lose_no_passage(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(900)]
    bench = spark.createDataFrame([(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(5, 90)))) for i in range(400)],
                                  "item_id long, text string")
    (index,) = latent.indexes(bench, bench)
    assert len(index.parts) > 2
    for part in index.parts:
        assert len(part.passages) <= latent.RANK
    # a text that is a passage has cosine 1 with it, in the space of its part
    number = {k: i for i, k in enumerate(index.terms)}
    for part in index.parts:
        for p, i in zip(part.passages[:20], part.item_of[:20]):
            keys = index.items[i][1]
            best = 0
            for a, b in latent.passages_of(len(keys)):
                rows = [part.rows[number[k]] for k in set(keys[a:b]) if part.rows[number[k]] >= 0]
                norm = sum(float(index.weights[k % latent.COUNTERS]) ** 2 for k in set(keys[a:b])) ** 0.5
                best = max(best, float(part.latent[rows].sum(axis=0) @ p) / norm)
            assert best > 0.99


def test_common_subsequence():
    rnd = random.Random(6)
    for _ in range(200):
        a, b = ([rnd.randrange(5) for _ in range(rnd.randint(0, 12))] for _ in range(2))
        table_ = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table_[i + 1][j + 1] = table_[i][j] + 1 if x == y else max(table_[i][j + 1], table_[i + 1][j])
        masks = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        assert latent.lcs_length(masks, len(a), b) == table_[-1][-1]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_archives_there_and_back(spark, tmp_path):
    tricky = "WARC/1.0\r\nWARC-Type: response\r\n\r\n\r\n\r\n\nhttp://x 0.0.0.0 2 text/html 5\n"
    pages = [(5, "http://a/ b\n", "<p>é</p>"), (3, "http://b", "<p>é</p>"), (9, "http://c", "<p>é</p>"), (1, None, None), (2, "", ""),
             (4, "http://d", tricky), (6, "filedesc://e", "x" * 300_000), (7, "http://f", "\r\n\r\n"), (7, "http://f", "\r\n\r\n"),
             (None, "http://g", "<p>é</p>"), (None, "http://h", "alone")]
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    out = warc.archived(frame).collect()
    assert len(out) == len(pages)
    expected = []
    for page, _, html in pages:
        same = [p for p, _, h in pages if (h or "") == (html or "")]
        least = min((p for p in same if p is not None), default=None)
        revisit = len(same) > 1 and least is not None and page != least
        expected.append((page, len((html or "").encode()), digest(html), "revisit" if revisit else "response", least if revisit else None))
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in out)
    assert warc.archived(frame.where("false")).count() == 0
    # the join by a shuffle gives what the sent table gives
    arc = str(tmp_path / "arc")
    warc.write_arc(frame, arc)
    results = []
    for most in (0, 100):
        warc.convert(spark, arc, str(tmp_path / f"warc{most}"), max_sent=most)
        results.append(sorted(str(tuple(r)) for r in warc.read_warc(spark, str(tmp_path / f"warc{most}")).collect()))
    assert results[0] == results[1] == sorted(map(str, expected))


@pytest.mark.parametrize("version", [1, 2])
def test_versions_and_broken_files(version):
    block = warc.arc_version_block(version, "20240101000000").encode() + b"\n"
    data = block + warc.arc_record(version, 8, "http://a b", "20240101000000", "<é>") + b"\n"
    (record,) = warc.parse_arc(data, "f")
    assert record[0] == 8 and record[1] == "http://a%20b" and record[5] == "<é>".encode() and record[6] == digest("<é>")
    legacy = block + b"http://old url/ 1.2.3.4 19990101000000 image/gif" + (b" 404 - - 0 f.arc" if version == 2 else b"") + b" 3\n\xff\x00\n\n"
    (record,) = warc.parse_arc(legacy, "f")
    assert record[:4] == (None, "http://old url/", "19990101000000", "image/gif") and record[5] == b"\xff\x00\n"
    for broken in (data[:-6], data[len(block):], block.replace(b" 0 tidelog", b" 9 tidelog").replace(str(version).encode() + b" 9", b"3 9")):
        with pytest.raises(ValueError):
            list(warc.parse_arc(broken, "f"))
    good = warc.warc_record("response", 8, "http://a", "20240101000000", b"HTTP/1.1 200 OK\r\nX-Page-Id: 8\r\n\r\n", b"\xff", digest(None), None) + b"\n"
    with pytest.raises(ValueError):  # the digest is another payload's
        list(warc.parse_warc(good, "f"))


def test_archives_of_the_given_pages(spark):
    pages = table(spark, DATA, "pages")
    # every page twice: the second half are revisits
    doubled = pages.unionAll(pages.withColumn("page_id", F.col("page_id") + 100_000))
    out = warc.archived(doubled)
    assert out.where("record_type = 'revisit' and refers_to = page_id - 100000").count() == pages.count()
    assert out.where("record_type = 'response' and refers_to is null").count() == pages.count()
