import pytest
from pyspark.sql import functions as F

from strata.operators.keyfilter import BITS_PER_KEY, filter_bytes, key_filter, may_hold


@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_every_key_passes_and_few_others(spark, n):
    keys = spark.range(n).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    rows = spark.range(40_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"), "id")
    kept = may_hold(rows, "key", key_filter(keys, "key", n), n)
    assert kept.columns == rows.columns
    ids = {r["id"] for r in kept.collect()}
    assert ids >= set(range(n))
    assert len(ids) - n <= 2 * (40_000 - n) / BITS_PER_KEY


def test_size_follows_the_keys():
    assert filter_bytes(1) == 4_096
    assert filter_bytes(10_000_000) <= 2 * 10_000_000 + 4_096


def test_null_keys_pass_only_if_the_set_holds_one(spark):
    rows = spark.createDataFrame([(None,), ("a",)], "key string")
    assert may_hold(rows, "key", key_filter(rows, "key", 2), 2).count() == 2
