from __future__ import annotations

from collections import Counter

import xxhash

import brute
import corpus_pipeline
from meterfold import scratch
from meterfold.llm import quality

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = scratch.stored(stage(spark, docs, FOLDER), "stage")
        rows[name] = (before, docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    before, after = rows["quality classifier"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    verdict = quality.classified(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels)
    assert {r.doc_id for r in after} == {r.doc_id for r in verdict.where("kept").collect()}
    assert 0 < len(after) < len(before)

    before, after = rows["SimHash near-dedup"]
    prints = {r.doc_id: brute.simhash(r.text, xxhash.xxh64_intdigest) for r in before}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {r.doc_id for r in after} == set(brute.roots(prints, near).values())

    before, after = rows["substring dedup"]
    want = brute.word_repeats([(r.doc_id, r.text) for r in before])
    texts = {r.doc_id: r for r in after}
    assert set(texts) == {r.doc_id for r in before}
    for r in before:
        n, removed, _ = want[r.doc_id]
        assert len(texts[r.doc_id].text.split()) == n - removed and texts[r.doc_id].n_chars == len(texts[r.doc_id].text)
        if not removed:
            assert texts[r.doc_id].text == r.text

    before, after = rows["benchmark decontamination"]
    items = [tuple(r)[:2] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute.contamination([(r.doc_id, r.text) for r in before], items) if r[-1]}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - bad

    before, after = rows["best-fit packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    filled = Counter()
    for r in after:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048

    found = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(*key).collect())) == sorted(tuple(r[k] for k in key) for r in after)


def test_clashing_columns_and_empty_documents(spark, tmp_path):
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    clashing = ["kept", "n_words", "first_id", "bad_id", "bad_digest", "label_id", "digest", "root", "fp", "kept_row"]
    clashing += ["several_id", "variant", "repeats", "own_id", "component_id", "host", "path", "contaminated"]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {n} int" for n in clashing)
    more = tuple(range(len(clashing)))
    odd = [(1, None, None, None, None, *more), (2, "", "en", "s", 0, *more), (None, "some words", "en", None, 10, *more)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = scratch.stored(stage(spark, docs, str(tmp_path)), "stage")
            assert name == "best-fit packing" or docs.columns[5:] == clashing
        assert docs.count() == (2 if rows else 0)
