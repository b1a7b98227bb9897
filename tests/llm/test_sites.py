"""Site posteriors next to plain arithmetic, and accuracy on held-out labels."""

import math
import os

import pytest
from pyspark.sql import functions as F

from weftline.llm import sites
from weftline.llm.sites import SHAPES, shape, site_quality

SF_DIR = "/root/testdata/sf0.01"


def plain_strength(groups):
    """Method of moments for [(n, mean, prior)]."""
    n = sum(g[0] for g in groups)
    free = n - sum(g[0] ** 2 for g in groups) / n
    variance = sum(g[0] * g[2] * (1 - g[2]) for g in groups)
    if free <= 0 or variance <= 0:
        return 1e4
    within = variance / n
    between = (sum(g[0] * (g[1] - g[2]) ** 2 for g in groups) - (len(groups) - 1) * within) / free
    return min(1e4, max(1.0, within / between - 1)) if between > 0 else 1e4


def plain_posteriors(rows):
    """(host, path, p) rows -> (host posterior, path posterior) of each."""
    hosts, paths = {}, {}
    for host, path, p in rows:
        for table, key in ((hosts, host), (paths, (host, path))):
            n, s = table.get(key, (0, 0.0))
            table[key] = (n + 1, s + p)
    mean = sum(p for _, _, p in rows) / len(rows)
    kh = plain_strength([(n, s / n, mean) for n, s in hosts.values()])
    prior = {h: (mean * kh + s) / (kh + n) for h, (n, s) in hosts.items()}
    kp = plain_strength([(n, s / n, prior[h]) for (h, _), (n, s) in paths.items()])
    out = []
    for host, path, p in rows:
        (hn, hs), (pn, ps) = hosts[host], paths[host, path]
        host_posterior = (mean * kh + hs - p) / (kh + hn - 1)
        out.append((host_posterior, (host_posterior * kp + ps - p) / (kp + pn - 1)))
    return out


def test_posteriors_equal_plain_arithmetic(spark, documents):
    good = "Plain words of a fine text that reads well and goes on.\nAnother line of it."
    bad = "$$$ ### BUY!! BUY!! BUY!! <<>> 123"
    rows = []
    for i in range(160):
        host = ["a", "b", None, "c"][i % 4]
        text = bad if (host == "b" and i % 8 != 1) or i % 29 == 0 else good
        rows.append((i, f"{text} {'x' * (i % 5)}", ["p", "q", None][i % 3], host))
    labels = spark.createDataFrame([(i, int("Plain" in t)) for i, t, _, _ in rows[:80]], "doc_id bigint, quality int")
    found = site_quality(documents(rows), labels, carry=["doc_id", "source", "lang"]).collect()
    plain = plain_posteriors([(r["row"]["source"], r["row"]["lang"], r.doc_probability) for r in found])
    for r, (host, path) in zip(found, plain, strict=True):
        assert r.host_posterior == pytest.approx(host, abs=1e-9)
        assert r.path_posterior == pytest.approx(path, abs=1e-9)
        assert (r.quality >= 0.5) == ("Plain" in rows[r["row"]["doc_id"]][1])
    by_host = {r["row"]["source"]: r.host_posterior for r in found}
    assert by_host["b"] < by_host["a"]


def test_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame([(1, 0), (4, 1), (5, 1), (6, None), (None, 1)], "doc_id bigint, quality int")
    found = site_quality(awkward, labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.quality <= 1 for r in found)
    none = site_quality(awkward, labels.filter("false")).collect()
    assert {round(r.quality, 9) for r in none} == {0.5}
    assert site_quality(no_documents, labels).count() == 0


def test_shapes():
    assert len(shape(b"a b\nc")) == len(SHAPES)
    assert shape(None) == shape(b" \n") == [0.0] * (len(SHAPES) - 1) + [1.0]
    values = dict(zip(SHAPES, shape(b"AB ab ab\nab #1"), strict=True))
    assert values["distinct"] == pytest.approx(3 / 5) and values["capitals"] == pytest.approx(2 / 14)
    assert values["log_words"] == pytest.approx(math.log(6))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the benchmark tables")
def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = site_quality(docs, labels.filter("doc_id % 4 > 0")).select("row.doc_id", "quality")
    rows = found.join(labels.filter("doc_id % 4 = 0").select("doc_id", F.col("quality").alias("truth")), "doc_id").collect()
    assert len(rows) > 50 and sum((r.quality >= 0.5) == bool(r.truth) for r in rows) / len(rows) > 0.95


def test_repeated_rows_stay_out_of_the_driver(spark, documents, monkeypatch):
    """A labelled document that is there thousands of times is one row of the fit."""
    fitted = []
    real = sites.fit_logistic
    monkeypatch.setattr(sites, "fit_logistic", lambda x, y, **k: fitted.append(len(y)) or real(x, y, **k))
    docs = documents([(1, "Again. And again.")] * 3_000 + [(i, f"word{i % 3} here.") for i in range(2, 60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id bigint, quality int")
    assert site_quality(docs, labels, sample=40).count() == 3_058
    assert fitted == [40]
