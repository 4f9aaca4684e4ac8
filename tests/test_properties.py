"""Property checks of the split against a brute-force model of its semantics."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.contracts import ALLOWED_SHIP_MODES, SILVER_RULES
from strata.operators.quality import split_valid_rejected

SCHEMA = ("row_id long, order_id string, customer_id string, customer_name string, country string, segment string, "
          "city string, order_date string, shipment_date string, shipment_mode string")

maybe = lambda s: st.one_of(st.none(), s)
row = st.tuples(
    maybe(st.integers(0, 6)),
    maybe(st.sampled_from(["A", "B", "C", "D", "E"])),
    maybe(st.just("C1")),
    maybe(st.just("Ann Lee")),
    st.just("INDIA"),
    st.just("CONSUMER"),
    st.just("PUNE"),
    maybe(st.sampled_from(["2025-01-01", "2025-01-02"])),
    maybe(st.sampled_from(["2025-01-01", "2025-01-02"])),
    maybe(st.sampled_from(list(ALLOWED_SHIP_MODES) + ["Express"])),
)


def model(rows):
    """The reference's formulation: two anti-joins, a filter, and the complement by row_id."""
    rid = Counter(r[0] for r in rows)
    oid = Counter(r[1] for r in rows)
    valid = [
        r for r in rows
        if not (r[0] is not None and rid[r[0]] > 1) and not (r[1] is not None and oid[r[1]] > 1)
        and all(v is not None for v in r[:9]) and r[8] >= r[7] and r[9] in ALLOWED_SHIP_MODES
    ]
    valid_ids = {r[0] for r in valid}
    rejected = [r for r in rows if r[0] is None or r[0] not in valid_ids]
    return sorted(valid, key=repr), sorted(rejected, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=14))
def test_split_matches_model_and_partitions_input(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    valid, rejected = split_valid_rejected(df, SILVER_RULES)
    got_valid = sorted((tuple(r) for r in valid.collect()), key=repr)
    got_rejected = sorted((tuple(r) for r in rejected.collect()), key=repr)
    want_valid, want_rejected = model(rows)
    assert got_valid == want_valid
    assert got_rejected == want_rejected
    assert len(got_valid) + len(got_rejected) == len(rows)
