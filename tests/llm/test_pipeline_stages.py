from __future__ import annotations

import os
import random
import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from odd_rows import odd_rows, prose
from strata.llm import packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def planted_rows():
    rng = random.Random(9)
    items = {k: prose(8_000 + k, 40).replace("\n", " ") for k in range(5)}
    texts, labels = {}, {}
    for k in range(600):
        texts[k] = prose(k, 80 + k % 200, vocabulary=900)
        labels[k] = (1, 0)
    toxic = set()
    for k in range(600, 900):
        spread = prose(k, 90, vocabulary=900).split(" ")
        spread.insert(rng.randrange(len(spread)), rng.choice(["grumpfelik", "schnorzbat"]) + rng.choice(["", "en", "us"]))
        texts[k] = " ".join(spread)
        labels[k] = (1, 1)
        toxic.add(k)
    short = {900: "too short", 901: "", 902: None, 903: "again and again " * 60}
    copies = {910 + k: texts[3] for k in range(4)}
    near = {}
    for k in range(5):
        ws = texts[7].split(" ")
        ws[10 + 9 * k] = "edited"
        near[920 + k] = " ".join(ws)
    leaks = {930 + k: prose(700 + k, 70, vocabulary=900) + "\n" + items[k] for k in range(5)}
    return texts | short | copies | near | leaks, labels, items, {"toxic": toxic, "short": set(short), "copies": set(copies) | set(near), "leaks": set(leaks)}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    texts, labels, items, planted = planted_rows()
    base = str(tmp_path_factory.mktemp("corpus"))
    rows = [(k, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, t in texts.items()]
    spark.createDataFrame(rows, DOCS).write.parquet(os.path.join(base, "documents.parquet"))
    spark.createDataFrame([(k, *v) for k, v in labels.items()], "doc_id long, quality int, toxic int").write.parquet(
        os.path.join(base, "labels.parquet")
    )
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(
        os.path.join(base, "benchmark.parquet")
    )
    return base, texts, planted


def test_each_stage_drops_what_it_should_and_keeps_the_rest(spark, corpus, tmp_path):
    base, texts, planted = corpus
    docs = spark.read.parquet(f"{base}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality", "near_dedup", "decontamination", "packing"]
    drops = dict(zip(names, ["toxic", "short", "copies", "leaks"], strict=False))
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        out = stage(spark, docs, base)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name in drops:
            assert out.columns == docs.columns
            gone = before - {r["doc_id"] for r in out.collect()}
            bad = planted[drops[name]] & before
            if name == "toxicity":  # learned, so held to shares
                assert len(gone & bad) >= 0.95 * len(bad) and len(gone - bad) <= 0.02 * len(before)
            else:
                assert gone == bad
            docs = out
    pieces = out.collect()
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    coder = packing.WordEncoder(packing.vocabulary_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(left)
    for d, rows in by_doc.items():
        ids = coder.encode((left[d] or "").encode())
        assert sum(r["length"] for r in rows) * 4 == len(ids)
        for r in rows:
            assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    total = sum(r["length"] for r in pieces)
    assert len(by_sequence) <= 1.02 * total / packing.CAPACITY + 1


def test_odd_and_empty_tables_pass_all_stages(spark, corpus, tmp_path):
    base, _, _ = corpus
    for name, rows in (("odd", [r[:5] for r in odd_rows()]), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{base}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert {r["doc_id"] for r in out} == ({1, 5, None, 8} if rows else set())
