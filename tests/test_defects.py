"""The planted defects reach every rule."""

import pytest

from spendlens.plans.defects import query  # noqa: F401  registers the queries
from spendlens.plans.queries import CHECK_SQL, QUERIES


@pytest.mark.parametrize("name", ["defects_incrementality", "defects_scd", "defects_money", "defects_relations", "checks_intervals"])
def test_every_rule_finds_something(spark, name):
    rows = QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert {r.check_name: r.status for r in rows if not r.failure_count} == {}
    assert name in CHECK_SQL


def test_both_sides_of_the_tolerance(spark, small):
    rows = QUERIES["defects_reconciliation"](spark, small).collect()
    assert {r.reconciliation_status for r in rows} == {"matched", "mismatched"} and len({r.settlement_delta for r in rows}) == 4
    assert all((r.reconciliation_status == "matched") == (abs(r.settlement_delta) <= 0.01) for r in rows)


def test_quarantine_queries_count_something(spark, small):
    balance = QUERIES["quarantine_balance"](spark, small).first()
    assert balance.lost_rows == 0 and min(balance.clean_rows, balance.rejected_rows, balance.duplicate_rows) > 0
    assert {r.code for r in QUERIES["quarantine_codes"](spark, small).collect()} == {"E01", "E02", "E03"}
    assert {r.risk_rule_name for r in QUERIES["detected_hits"](spark, "/root/testdata/sf0.01").collect()} == {
        "duplicate_redemption", "refund_after_reward", "high_redemption_velocity", "merchant_location_anomaly", "reward_gaming_pattern"}
