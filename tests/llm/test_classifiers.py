"""Quality, toxicity and URL models: held-out accuracy on the given tables, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import additive, toxicity, url_filter
from tidelog.llm.common import table

DATA = "/root/testdata/sf0.1"


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    order = np.argsort(scores, kind="stable")
    _, inverse, counts = np.unique(scores[order], return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    rank = np.empty(len(scores))
    rank[order] = (ends - (counts - 1) / 2)[inverse]
    ones = labels.sum()
    return (rank[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


ODD = [None, "", " ", "x" * 40000, "word " * 20000, "a|b % &", "Ordinary words stand here."]


@pytest.mark.parametrize("module, label, least", [(additive, "quality", 0.97), (toxicity, "toxic", 0.88)])
def test_held_out_accuracy_and_odd_rows(spark, module, label, least):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    model = module.fit(docs, labels)
    rows = (module.scored(docs, model, keep=["doc_id"]).join(labels, "doc_id")
            .where(module.held_out(F.col("doc_id"))).select("score", "predicted", label).collect())
    truth = np.array([r[label] for r in rows])
    assert auc([r["score"] for r in rows], truth) >= least
    clean = [r["predicted"] for r in rows if r[label] == (1 if label == "quality" else 0)]
    assert np.mean(clean) >= 0.97 if label == "quality" else np.mean(clean) <= 0.03

    odd = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(ODD)] + [(1, "", 1.0), (None, None, 2.0)],
                                "doc_id long, text string, score double")
    out = module.scored(odd, model)
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == len(ODD) + 2
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in out.collect())
    assert len({r["score"] for r in out.where("coalesce(text, '') = ''").collect()}) == 1
    # no labels, or no documents: a model that scores all the same
    for some_docs, some_labels in ((odd, labels.where("false")), (odd.where("false"), labels)):
        bare = module.fit(some_docs, some_labels)
        assert len({r["score"] for r in module.scored(odd, bare).collect()}) == 1


def test_toxic_rows_go(spark):
    ordinary = [f"the river runs by the old mill number {i} and the people walk there" for i in range(200)]
    toxic = [f"you are a stupid idiot and a worthless moron number {i} by the river" for i in range(60)]
    model = toxicity.train(toxic[:50], ordinary[:150])
    rows = [(i, t) for i, t in enumerate(ordinary[150:] + toxic[50:])] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["doc_id"] for r in toxicity.accepted(docs, model).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [*range(50), None]))


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host, tail = (rest[:min(ends)], rest[min(ends):]) if ends else (rest, "")
    ends = [tail.find(c) for c in "?#" if c in tail]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:min(ends)] if ends else tail


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y", "http://example.net/fr/", "http://notexample.net/en/",
            "http://example.com/de/1", "http://xexample.com/de/1", "http://b.org/fr/x", "http://b.org/de/x", "http://net",
            "http://x.net#a", "http://x.net?q=/en/", "a://b://c/d", "http://É.com/É\n/x", "http://casino-bets.example/free",
            "http://garden.example/roses", "http://h/" + "p" * 50000]
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(None, urls[7], "x"), (7, urls[7], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = url_filter.judged(pages).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path = brute_url(urls[7 if r["page_id"] is None else r["page_id"]])
        fits = [x for x in url_filter.RULES if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        best = max(fits, key=lambda x: len(x[0] + x[1]), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0] + best[1])
        assert r["verdict"] == best[2] if best else r["verdict"] in ("allow", "block")
    by_id = {r["page_id"]: r["verdict"] for r in out}
    assert by_id[16] == "block" and by_id[17] == "allow" and by_id[0] == by_id[3] == "allow"
    assert url_filter.judged(pages.where("false")).count() == 0
    nothing = spark.createDataFrame([(None, 1), ("http://x", None)], "url string, label int")
    assert {r["verdict"] for r in url_filter.judged(pages, nothing).where("rule is null").collect()} == {"allow"}


def test_hashed_grams_do_not_cross_rows():
    together = url_filter.hashed_grams(["ab.example", "", "ü"], ["/en/1", "", "/"])
    alone = [url_filter.hashed_grams([h], [p]) for h, p in zip(["ab.example", "", "ü"], ["/en/1", "", "/"])]
    for i, (_, grams) in enumerate(alone):
        assert sorted(grams) == sorted(together[1][together[0] == i])


def test_url_threshold_comes_from_folds_of_the_labelled_rows():
    rows = [(f"{w}{i}.example", "/x", label) for i in range(30) for w, label in (("casino", 1), ("garden", 0))]
    hosts, paths, y = [r[0] for r in rows], [r[1] for r in rows], np.array([r[2] for r in rows], float)
    threshold = url_filter.fold_threshold(hosts, paths, y)
    model = url_filter.Model(*url_filter.train(hosts, paths, y), threshold)
    scores = model.scores(["casino-new.example", "garden-new.example"], ["/x", "/x"])
    assert scores[0] >= threshold > scores[1]
    # each score by brute force: the sum over the row's n-grams
    for host, path, score in zip(hosts[:4], paths[:4], model.scores(hosts[:4], paths[:4])):
        _, grams = url_filter.hashed_grams([host], [path])
        assert abs(np.log(score / (1 - score)) - model.weights[grams].sum() / len(grams) ** 0.5 - model.bias) < 1e-9
    assert url_filter.fold_threshold(hosts[:1], paths[:1], y[:1]) == 0.5
