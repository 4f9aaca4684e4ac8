"""Why rows are rejected, and the mask that says so."""

import itertools

import pytest
from pyspark.sql import functions as F

from strata.contracts import QUARANTINE_COLUMNS, SILVER_RULES, RuleSet
from strata.operators.quality import FAILED_MASK, VALID_FLAG, failed_names, flag_failed, flag_valid
from strata.plans import run_pipeline
from strata.sources import read_layer

EXPECTED = {
    204: ["shipment_mode_allowed"], 205: ["shipment_date_on_or_after_order_date"], 206: ["order_date_valid"],
    207: ["shipment_date_valid"], 208: ["customer_id_not_null"], 209: ["customer_name_not_null"],
    210: ["segment_not_null"], 211: ["country_not_null"], 212: ["city_not_null"], 213: ["row_id_unique"],
    214: ["order_id_unique"], 215: ["order_id_unique"],
}


def test_quarantine_names_rules_and_keeps_the_texts(spark, tmp_path, dirty_csv):
    lake = run_pipeline(spark, dirty_csv, str(tmp_path / "lake")).lake
    rejected = read_layer(spark, lake.rejected)
    assert tuple(rejected.columns) == QUARANTINE_COLUMNS
    rows = rejected.collect()
    assert {r.row_id: r.failed_rules for r in rows} == EXPECTED
    texts = {r.row_id: (r.order_date_text, r.shipment_date_text) for r in rows}
    assert texts[206] == ("soon", "2024-05-11") and texts[207] == ("2024-05-11", "2024-13-40")


@pytest.mark.parametrize("required", [("a", "first", "second"), ("a",)])
def test_no_bit_is_set_exactly_on_valid_rows(spark, required):
    """Every combination of null, good and bad values of every rule; dates required or not."""
    rules = RuleSet(required=required, unique=("k",), dates=("first", "second"), chronology=(("first", "second"),),
                    allowed={"mode": ("x", "y")})
    values = itertools.product(["v", None], ["2024-01-02", None], ["2024-01-01", "2024-01-02", None], ["x", "z", None])
    rows = [(*v, k if k % 5 else 1) for k, v in enumerate(values)] + [("v", "2024-01-01", "2024-01-01", "x", None)]
    df = spark.createDataFrame(rows, "a string, first string, second string, mode string, k int")
    df = df.select("a", F.col("first").cast("date"), F.col("second").cast("date"), "mode", "k")
    key = lambda r: tuple(map(str, r[:6]))
    masked = flag_failed(df, rules)
    got = sorted((key(r) for r in masked.select(*df.columns, VALID_FLAG).collect()))
    assert got == sorted(key(r) for r in flag_valid(df, rules).select(*df.columns, VALID_FLAG).collect())
    named = masked.withColumn("names", failed_names(FAILED_MASK, rules)).collect()
    assert all((r[VALID_FLAG] and not r["names"]) or (not r[VALID_FLAG] and r["names"]) for r in named)


def test_every_rule_has_a_bit_of_its_own(spark):
    masks = spark.range(13).select(F.shiftleft(F.lit(1).cast("bigint"), 0).alias("one"), "id")
    names = [masks.where(f"id = {i}").select(failed_names(F.lit(1 << i), SILVER_RULES)).first()[0] for i in range(13)]
    assert len({n[0] for n in names}) == 13 and all(len(n) == 1 for n in names)
