from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterfold.llm import quality

SCHEMA = "doc_id long, text string, source string, lang string"


def sample(n=900, seed=1):
    """Plain, shouted and insulting texts; one host has far more bad texts than the others."""
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        host = "hot" if i % 3 == 0 else f"h{i % 7}"
        kind = rng.choices(("plain", "shout", "toxic"), (0.3, 0.5, 0.2) if i % 7 == 3 else (0.8, 0.1, 0.1))[0]
        text = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        if kind == "shout":
            text = [w.upper() + "!!" for w in text]
        if kind == "toxic":
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(("nastyword", "vileword")))
        docs.append((i, " ".join(text), host, "en"))
        labels.append((i, int(kind != "shout"), int(kind == "toxic"), kind))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = sample()
    truth = {i: kind != "plain" for i, _, _, kind in labels}
    frame = spark.createDataFrame([(*d, "x") for d in docs], SCHEMA + ", p_bad string")
    known = spark.createDataFrame([r[:3] for r in labels if r[0] % 3], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in quality.classified(frame, known).collect()}
    assert len(found) == len(docs)
    unseen = [i for i in found if i % 3 == 0]
    assert np.mean([found[i]["kept"] != truth[i] for i in unseen]) > 0.97
    rates = {r["host"]: r["host_rate"] for r in found.values()}
    assert max(rates, key=rates.get) == "h3"
    kept = quality.kept(frame, known)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in found if found[i]["kept"]}


def test_rates_are_shrunk_by_grouped_sums(spark):
    docs, labels = sample(300)
    heads = quality.fit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([r[:3] for r in labels], "doc_id long, quality int, toxic int"))
    rows = quality.scored(spark.createDataFrame(docs, SCHEMA), heads, F.col("source"), F.col("lang")).collect()
    mean = np.mean([r["p_document"] for r in rows])
    own = {}
    for r in rows:
        own.setdefault(r["host"], []).append(r["p_document"])
    for r in rows:
        low, high = sorted((mean, np.mean(own[r["host"]])))
        assert low - 1e-9 <= r["host_rate"] <= high + 1e-9
        odds = np.log(r["path_rate"] / (1 - r["path_rate"])) + r["evidence"]
        assert r["p_bad"] == pytest.approx(1 / (1 + np.exp(-odds)))


def shrunk(groups):
    """Rates of groups (n, s, rate above them), the spread of the groups setting the prior's weight."""
    n = sum(g[0] for g in groups)
    single = sum(g[0] * g[2] * (1 - g[2]) for g in groups) / n
    between = (sum(g[0] * (g[1] / g[0] - g[2]) ** 2 for g in groups) - len(groups) * single) / n
    weight = min(1e4, max(2.0, single / between - 1)) if between > 0 else 1e4
    return [(g[1] + weight * g[2]) / (g[0] + weight) for g in groups]


def test_rates_and_verdicts_against_brute_force(spark):
    docs, labels = sample(500, seed=4)
    docs = [(i, t, h, ("en", "de", None)[i % 3] if h == "h3" else "en") for i, t, h, _ in docs]
    docs += [(None, docs[0][1], None, None), docs[7], (903, None, "lonely", "en")]
    frame = spark.createDataFrame(docs, SCHEMA)
    known = spark.createDataFrame([r[:3] for r in labels if r[0] % 2], "doc_id long, quality int, toxic int")
    heads = quality.fit(frame, known)
    own, sums = [], {}
    prior = np.prod([1 / (1 + np.exp(heads[h].base)) for h in quality.HEADS])
    for doc_id, text, host, path in docs:
        x = np.array(quality.features(text, [heads[h].lexicon for h in quality.HEADS]))
        good = 1.0
        for head in (heads[h] for h in quality.HEADS):
            z = np.clip((x - head.mean) / head.scale, -8, 8)
            odds = np.clip(head.weights[0] + sum(a * b for a, b in zip(head.weights[1:], z)) - head.base, -30, 30)
            good *= 1 / (1 + np.exp(odds + head.base))
        bad = min(1 - 1e-12, max(1e-12, 1 - good))
        site = (host or "", path or "")
        own.append((doc_id, site, bad, np.log(bad / (1 - bad)) - np.log((1 - prior) / prior)))
        for key in (None, site[0], site):
            n, s = sums.get(key, (0, 0.0))
            sums[key] = (n + 1, s + bad)
    mean = sums[None][1] / sums[None][0]
    hosts = sorted(k for k in sums if isinstance(k, str))
    host_rate = dict(zip(hosts, shrunk([(*sums[h], mean) for h in hosts])))
    paths = sorted(k for k in sums if isinstance(k, tuple))
    path_rate = dict(zip(paths, shrunk([(*sums[p], host_rate[p[0]]) for p in paths])))
    want = []
    for doc_id, site, bad, evidence in own:
        p_bad = 1 / (1 + np.exp(-(np.log(path_rate[site] / (1 - path_rate[site])) + evidence)))
        want.append((doc_id or -1, *site, bad, evidence, host_rate[site[0]], path_rate[site], p_bad, p_bad < quality.REJECT_FROM))
    columns = ["p_document", "evidence", "host_rate", "path_rate", "p_bad", "kept"]
    found = [(r["doc_id"] or -1, r["host"], r["path"], *(r[c] for c in columns)) for r in quality.classified(frame, known).collect()]
    assert len(found) == len(want)
    for a, b in zip(sorted(found), sorted(want)):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-6, abs=1e-9)


def test_odd_rows(spark):
    docs, labels = sample(200)
    docs += [(None, docs[0][1], None, None), (901, None, "h1", None), (902, "", None, "en"), docs[5]]
    labels = [r[:3] for r in labels] + [(None, 0, 1), (901, None, None), (5, 1, None), (7777, 0, 0)]
    frame = spark.createDataFrame(docs, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.classified(frame, known).collect()
    assert len(found) == len(docs) and all(0 <= r["p_bad"] <= 1 for r in found)
    assert quality.kept(frame, known).count() == sum(r["kept"] for r in found)


def test_without_labels_nothing_is_rejected(spark):
    docs, _ = sample(60)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.kept(spark.createDataFrame(docs, SCHEMA), none).count() == 60
    good = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    assert quality.kept(spark.createDataFrame(docs, SCHEMA), good).count() == 60
    assert quality.classified(spark.createDataFrame([], SCHEMA), good).count() == 0


def test_logistic_recovers_weights():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 2))
    y = rng.random(20_000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))
    assert quality._logistic(x, y.astype(float)) == pytest.approx([0.5, 2, -1], abs=0.1)
