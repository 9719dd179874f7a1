"""Personal data: base spans against the plain patterns, and the field's own additions."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import skip_chain

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRAINING = [f"Call +1 (0{i}7) 555-77{i:02d} or mail me.{i}@mail{i}.example.com from 10.0.{i}.7, card 4111111111111111 end {i}."
            for i in range(60)]


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and skip_chain.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(3)
    parts = ["a", "1", "9", "@", ".", "+", "-", " ", "(", ")", "b.c", "%", "12.3", "4111111111111111", "é", "\n", "1.2.3.4",
             "+1 (555) 555-7713 ", "x@y.z", "٣", "0000000001.2.3.4"]
    for _ in range(5000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        assert skip_chain.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "a@" * 150_000, "+" * 300_000, "0" * 9000 + ".1.1.1"):
        skip_chain.base_spans(text)
        skip_chain.tokens(text)


def test_a_repeated_token_takes_the_label_of_the_marked_one():
    model = skip_chain.train(TRAINING)
    text = "Call +1 (017) 555-7713 now. Later (017) 555-7713 again, version 3. and 4.0 stay."
    base, every = next(skip_chain.all_spans([text], model))
    assert [text[a:b] for a, b, _ in base] == ["+1 (017) 555-7713"]
    assert [(text[a:b], k) for a, b, k in every] == [("+1 (017) 555-7713", "phone"), ("(017) 555-7713", "phone")]
    assert skip_chain.masked(text, every) == "Call [PHONE] now. Later [PHONE] again, version 3. and 4.0 stay."


def test_all_of_many_repeats_take_the_label_of_the_one_marked():
    # factors under which a shape alone says other, and similar tokens share their label
    n = len(skip_chain.LABELS)
    node = np.zeros((skip_chain.FEATURES, n))
    node[0, 0] = 3.0
    model = skip_chain.Model(node, np.zeros((n, n)), 4.0 * (2 * np.eye(n) - 1))
    marked, bare = "+10175557713", "10175557713"
    for before, after in ((0, 50), (50, 0), (25, 25), (0, 1)):
        text = " was sent and then ".join([*[bare] * before, marked, *[bare] * after])
        _, every = next(skip_chain.all_spans([text], model))
        assert [k for *_, k in every] == ["phone"] * (before + 1 + after)
        assert "555" not in skip_chain.masked(text, every)
    _, every = next(skip_chain.all_spans([" and then ".join([bare] * 51)], model))
    assert every == []


def test_beliefs_do_not_depend_on_the_slice():
    model = skip_chain.train(TRAINING)
    texts = [" and ".join(["(017) 555-7713"] * 50 + ["+1 (017) 555-7713"]), *TRAINING, "version 3. and 4.0 stay " * 40, "none"]
    assert list(skip_chain.all_spans(texts, model)) == [next(skip_chain.all_spans([t], model)) for t in texts]


def test_documents(spark):
    texts = [None, "", "no data", "mail a@b.co twice a@b.co", "é 4111 1111 1111 1111", "x " * 20000 + "1.2.3.4", *TRAINING]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 2), (None, "9.9.9.9", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int").withColumn("n_ip", F.lit("clash"))
    model = skip_chain.fit(docs)
    out = skip_chain.detected(docs, model).collect()
    assert len(out) == len(rows)
    for r, (_, text, _) in zip(sorted(out, key=lambda r: (r["doc_id"] is None, r["doc_id"])), sorted(rows, key=lambda x: (x[0] is None, x[0]))):
        expected = brute(text or "")
        said = ",".join(f"{k}:{a}:{b}" for a, b, k in expected)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[2] == k for s in expected) for k in PATTERNS]
        assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))
    masked = skip_chain.redacted(docs, model)
    assert masked.columns == docs.columns
    seen = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert seen[0] is None and seen[2] == "no data" and seen[3] == "mail [EMAIL] twice [EMAIL]" and seen[4] == "é [CARD]"
    empty = docs.where("false")
    assert skip_chain.detected(empty, skip_chain.fit(empty)).count() == 0
