"""Shards, tokens, repetition rules: brute-force versions, and rows that are null, empty, long or repeated."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelog.llm import feistel_shards, pieces, repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "a", "a  b ", "▁", "the cat\n\nthe cat\n", "é漢字 😀 <s> </s> <0x0A>\x00", "word " * 3000, "x" * 30000,
         "one two three four five six seven eight nine ten\n" * 4, "# * $ % & | < >"]


def documents(spark, texts=TEXTS):
    rows = [(i, t, "other") for i, t in enumerate(texts)] + [(1, texts[1] if len(texts) > 1 else None, "again"), (None, "null id", "n")]
    return spark.createDataFrame(rows, "doc_id long, text string, size string").withColumn("kept", F.lit("clash"))


def test_shards_are_even_gapless_and_independent_of_partitions(spark):
    docs = documents(spark)
    rows = feistel_shards.shards(docs, shard_count=3).collect()
    again = feistel_shards.shards(docs.repartition(5), shard_count=3).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and sum(counts.values()) == len(TEXTS) + 2
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    for r in rows:
        text = "null id" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(spark, rows):
    place = spark.range(rows).select("id", feistel_shards.permuted(F.col("id"), rows, 7).alias("p")).collect()
    assert sorted(r["p"] for r in place) == list(range(rows))
    if rows >= 64:
        assert sum(r["id"] == r["p"] for r in place) < rows / 8


def test_shards_use_no_python(spark):
    plan = feistel_shards.shards(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_empty_tables(spark):
    docs = documents(spark).where("false")
    assert feistel_shards.shards(docs).count() == 0
    assert pieces.digests(docs).count() == 0
    assert repetition.repeated(docs).count() == 0


def test_pieces_equal_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "▁", "\n", "\t", "é", "漢字", "\x00", "<s>", "the ", "ing", "😀", "　", "﻿"]
    texts = TEXTS + ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    docs = documents(spark, texts)
    for r in pieces.encode(docs, keep=["doc_id"]).where("doc_id is not null").collect():
        ids = model.encode(texts[r["doc_id"]] or "")
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), model.decode(ids))
    for r in pieces.digests(docs).where("doc_id is not null").collect():
        ids = model.encode(texts[r["doc_id"]] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def brute_repetition(text):
    words = WORD.findall(text)
    inside = {}
    for n in (5, 6, 7, 8, 9, 10):
        grams = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        marked = [False] * len(words)
        for i in range(len(words) - n + 1):
            if grams[tuple(words[i:i + n])] > 1:
                marked[i:i + n] = [True] * n
        inside[n] = sum(len(w) for w, m in zip(words, marked) if m), sum(marked)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return words, inside, len(lines) - len(set(lines))


def test_repetition_equals_brute_force(spark):
    rnd = random.Random(2)
    texts = TEXTS + ["".join(rnd.choice(["a ", "b ", "cc ", "é ", "\n", "d|"]) for _ in range(rnd.randint(0, 200))) for _ in range(200)]
    rows = {r["doc_id"]: r for r in repetition.repeated(documents(spark, texts), keep=["doc_id"]).collect()}
    for i, text in enumerate(texts):
        words, inside, dup_lines = brute_repetition(text or "")
        r, chars = rows[i], sum(map(len, words))
        assert (r["n_words"], r["word_chars"]) == (len(words), chars)
        assert r["n_symbols"] == sum((text or "").count(c) for c in "#*$%&|<>")
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (dup_lines, inside[8][1])
        assert r["base_failed"] == (len(words) < 20 or 100 * inside[8][1] > 30 * len(words))
        assert r["ngram_share"] == pytest.approx(max(v[0] for v in inside.values()) / max(1, chars))
        assert not (r["kept"] and r["base_failed"])


def test_clashing_columns_are_replaced(spark):
    out = repetition.repeated(documents(spark))
    assert out.columns.count("kept") == 1 and dict(out.dtypes)["kept"] == "boolean"


def test_outputs_of_pieces_are_arrow_arrays():
    """No Python number per piece: ids of many texts come as one Arrow array."""
    import pyarrow as pa

    from tidelog.llm import pieces

    texts = [None, "", " ", "a  b", "words and ▁ marks", "tab\tand line\n"] * 3
    ids, n, decoded = pieces._start(pieces.default_model(), ("ids", "n_tokens", "decoded"))(texts)
    assert all(isinstance(v, pa.Array) for v in (ids, n, decoded))
    model = pieces.ChunkTable(pieces.default_model()).model
    want = [model.encode(t or "") for t in texts]
    assert ids.to_pylist() == want and n.to_pylist() == list(map(len, want))
    assert decoded.to_pylist() == [model.decode(w) for w in want]
