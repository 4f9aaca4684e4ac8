from __future__ import annotations

import random
import zlib

import numpy as np

from odd_rows import doc_rows, make_docs, odd_rows, prose
from strata.llm import toxicity


def brute_grams(word):
    marked = b"<" + word + b">"
    return sum(max(0, len(marked) - n + 1) for n in toxicity.GRAMS)


def test_grams_stay_within_their_word():
    words = [b"a", b"idiot", "été".encode(), b"x" * 40]
    buckets, bounds = toxicity.word_grams(words)
    assert np.diff(bounds).tolist() == [brute_grams(w) for w in words]
    for k, w in enumerate(words):
        alone, _ = toxicity.word_grams([w])
        assert sorted(alone.tolist()) == sorted(buckets[bounds[k] : bounds[k + 1]].tolist())
    assert buckets.min() >= 0 and buckets.max() < toxicity.BUCKETS


def test_batch_scores_are_those_of_each_text():
    rng = np.random.default_rng(0)
    weight = rng.normal(size=toxicity.BUCKETS).astype(np.float32)
    texts = ["", None, "one", prose(1, 500), prose(2, 13)]
    together = toxicity.Scorer(weight, -0.3).score(texts)
    for text, score in zip(texts, together, strict=True):
        words = toxicity.words_in(text)
        z = toxicity.word_scores(words, weight)
        windows = [z[k : k + toxicity.WINDOW].mean() for k in range(0, len(z), toxicity.WINDOW)] or [0.0]
        assert np.isclose(score, 1 / (1 + np.exp(-(max(windows) - 0.3))))


def toxic_set(n, inflections):
    rng = random.Random(5)
    rows, labels = {}, {}
    for k in range(n):
        words = prose(k, 60 + k % 400, vocabulary=900).split(" ")
        labels[k] = k % 3 == 0
        if labels[k]:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumpfelik", "schnorzbat"]) + rng.choice(inflections))
        rows[k] = " ".join(words)
    return rows, labels


def test_unseen_inflections_share_grams(spark):
    rows, labels = toxic_set(900, ["", "en", "ish", "us"])
    docs = make_docs(spark, doc_rows(rows))
    table = spark.createDataFrame([(k, 1, int(v)) for k, v in labels.items()], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs, table).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (1 if r["score"] >= 0.5 else 0) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)
    weight, bias = toxicity.fit(docs, table)
    new = toxicity.Scorer(weight, bias).score(["grumpfeliking schnorzbatten", prose(7_777, 80, vocabulary=900)])
    assert new[0] >= 0.5 > new[1]
    kept = toxicity.drop_toxic(docs, table)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["score"] < 0.5}


def test_held_out_labels_and_other_columns_change_nothing(spark):
    rows, labels = toxic_set(90, ["", "en"])
    docs = make_docs(spark, doc_rows(rows))
    schema = "doc_id long, quality int, toxic int"
    table = spark.createDataFrame([(k, 1, int(v)) for k, v in labels.items()], schema)
    flipped = spark.createDataFrame(
        [(k, 0, int(v) ^ (zlib.crc32(str(k).encode()) % 5 == 0)) for k, v in labels.items()], schema
    )
    one = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, table).collect()}
    two = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs.drop("lang", "source"), flipped).collect()}
    assert one == two


def test_sample_is_bounded(spark):
    docs = make_docs(spark, doc_rows({k: "w" for k in range(300)}))
    table = spark.createDataFrame([(k, 1, k % 2) for k in range(300)] * 2, "doc_id long, quality int, toxic int")
    sample = toxicity.labelled_sample(docs, table, per_class=20).collect()
    assert sum(r["toxic"] == 1 for r in sample) == 20 and sum(r["toxic"] == 0 for r in sample) == 40
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0 for r in sample)


def test_odd_rows_and_missing_labels(spark, odd_docs, no_docs):
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    got = toxicity.score_documents(odd_docs, none).collect()
    assert len(got) == len(odd_rows()) and all(r["score"] < 1e-300 and r["predicted"] == 0 for r in got)
    table = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (6, None, None), (None, 1, 1), (5, 1, 0), (77, 1, 1)], schema)
    got = toxicity.score_documents(odd_docs, table).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_documents(no_docs, table).count() == 0


def test_embeddings_have_directions_of_their_own_and_catch_misspellings():
    rows, labels = toxic_set(400, [""])
    model = toxicity.train([rows[k] for k in rows], np.array([labels[k] for k in rows]))
    sizes = np.linalg.svd(model.embedding[np.abs(model.embedding).sum(axis=1) > 0], compute_uv=False)
    assert model.softmax.shape == (2, toxicity.DIMENSIONS)
    assert (sizes > 0.01 * sizes[0]).sum() == toxicity.DIMENSIONS  # not one weight a bucket in disguise
    assert np.linalg.matrix_rank(model.embedding) == toxicity.DIMENSIONS
    score = toxicity.Scorer(model.weight, model.bias).score
    unseen = ["grumpfelikk", "ggrumpfelik", "schnorzbatt", "schnorzzbat", "grumpfeli", "schnorzba"]
    clean = [prose(5_000 + k, 60, vocabulary=900) for k in range(40)]
    assert all(score([f"{c} {w}"])[0] >= 0.5 for w, c in zip(unseen, clean, strict=False))
    assert (score(clean) >= 0.5).sum() <= 2


def test_one_row_an_id_and_bytes_are_bounded(spark, monkeypatch):
    rows = [(1, f"many rows {k}") for k in range(5_000)] + [(k, "x" * (100 + k)) for k in range(2, 200)] + [(999, "y" * 5_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(k, 1, k % 2) for k in [*range(200), 999]], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "LONGEST_BYTES", 4_000)
    sample = toxicity.labelled_sample(docs, labels).collect()
    ids = [r["doc_id"] for r in sample]
    assert len(ids) == len(set(ids)) > 100 and 999 not in ids
    assert [r["text"] for r in sample if r["doc_id"] == 1] == [r["text"] for r in toxicity.labelled_sample(
        docs.repartition(3), labels).collect() if r["doc_id"] == 1]
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 6_000)
    few = toxicity.labelled_sample(docs, labels).collect()
    assert 0 < sum(len(r["text"]) for r in few if r["toxic"] == 1) <= 2_000
    assert 0 < sum(len(r["text"]) for r in few if r["toxic"] == 0) <= 4_000
    assert {r["doc_id"] for r in few} < set(ids)
