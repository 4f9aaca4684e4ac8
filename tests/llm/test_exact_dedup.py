from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from odd_rows import make_docs, odd_rows, prose
from strata.llm import exact_dedup

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def expected(rows):
    """(doc_id, keep_id, group_size, sha) of every row, and how many rows stay a group: one."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, max(known) if known else None, len(ids), sha) for i in ids]
    return sorted(out, key=repr), len(groups)


def check(got, rows):
    want, n_groups = expected(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == n_groups == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def many_rows():
    rows = [(k, prose(k % 40, 30 + k % 7)) for k in range(300)]
    rows += [(1_000 + k, prose(5, 35).upper() if k % 2 else prose(5, 35)) for k in range(200)]  # two fifths are copies
    return rows


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dedup") / "documents.parquet")
    spark.createDataFrame(many_rows(), "doc_id long, text string").repartition(7).write.parquet(path)
    return path


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_equals_brute_force_whatever_the_batches(spark, many, tmp_path, batches):
    folder = str(tmp_path / "state")
    check(exact_dedup.exact_classes(spark, many, folder=folder, batches=batches).collect(), many_rows())
    parts = spark.read.parquet(f"{folder}/ledger").where("batch >= 0").select("batch").distinct().count()
    assert parts == {1: 1, 3: 3, 7: 7}[batches]


@pytest.mark.parametrize("digest_bytes", [0, 1])
def test_unequal_texts_of_one_digest_fall_apart(spark, many, digest_bytes):
    check(exact_dedup.exact_classes(spark, many, digest_bytes=digest_bytes).collect(), many_rows())


def test_collisions_without_the_filter(spark, many):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(exact_dedup.exact_classes(spark, many, digest_bytes=1).collect(), many_rows())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_state_outlives_a_run_and_takes_new_files(spark, tmp_path):
    path, folder = str(tmp_path / "documents.parquet"), str(tmp_path / "state")
    first = [(k, prose(k % 10, 20)) for k in range(50)]
    spark.createDataFrame(first, "doc_id long, text string").write.parquet(path)
    check(exact_dedup.exact_classes(spark, path, folder=folder).collect(), first)
    more = [(100 + k, prose(k, 20)) for k in range(20)]
    spark.createDataFrame(more, "doc_id long, text string").write.mode("append").parquet(path)
    check(exact_dedup.exact_classes(spark, path, folder=folder).collect(), first + more)
    state = spark.read.format("statestore").load(f"{folder}/state")
    assert state.count() == len({normal(t) for _, t in first + more})  # nothing has expired


def test_the_session_keeps_its_state_settings(spark):
    now = lambda: {k: spark.conf.get(k, None) for k in exact_dedup.STATE_CONF}
    before = now()
    with exact_dedup.state_on_disk(spark):
        assert now() == exact_dedup.STATE_CONF
    assert now() == before


def test_odd_and_empty_tables(spark, tmp_path):
    for name, rows in (("odd", odd_rows()), ("none", [])):
        path = str(tmp_path / f"{name}.parquet")
        make_docs(spark, rows).withColumn("file", F.lit("f")).withColumn("digest", F.lit(1)).write.parquet(path)
        check(exact_dedup.exact_classes(spark, path).collect(), [(r[0], r[1]) for r in rows])
