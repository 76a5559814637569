"""Every validator must stay silent on sound data and fire on a planted defect."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_goldens import DAY, feature_row, groups, rates

from spendlens.functions.exprs import stamp
from spendlens.operators import cleaning, incrementality, marts, quality, risk, scd
from spendlens.sources import contracts as C


def failures(checks):
    return {r.check_name: r.failure_count for r in checks.collect() if r.status == "failed"}


@pytest.fixture(scope="module")
def merchant_daily(spark):
    tx = spark.createDataFrame([("t1", "m", DAY, 100.0), ("t2", "m", DAY + dt.timedelta(1), 50.0)],
                               "transaction_id string, merchant_id string, transaction_date date, "
                               "transaction_amount double")
    red = spark.createDataFrame([("r1", "t1", "m", DAY, 10.0)],
                                "matched_redemption_id string, transaction_id string, merchant_id string, "
                                "transaction_date date, calculated_reward_amount double")
    return marts.merchant_daily_economics(
        marts.merchant_daily_spend(tx), marts.merchant_daily_rewards(red), rates(spark, 0.3, 0.03)).cache()


@pytest.fixture(scope="module")
def offer_daily(spark):
    test, _, offers = groups(spark, [120.0, 100.0], [80.0], reward=5.0)
    campaigns = spark.createDataFrame([("c", "name", DAY, DAY)], "campaign_id string, campaign_name string, "
                                      "campaign_start_date date, campaign_end_date date")
    return marts.offer_daily_economics(marts.offer_daily_spend(test), offers, campaigns).cache()


@pytest.fixture(scope="module")
def inc(spark):
    test, control, offers = groups(spark, [120.0, 100.0, 80.0], [80.0, 90.0, 70.0], reward=2.0)
    return incrementality.incrementality(test, control, offers, rates(spark, 0.4, 0.02)).cache()


@pytest.fixture(scope="module")
def feat(spark):
    return incrementality.features(feature_row(spark, 300.0, 0.2, 0.02, 2000.0, avg_test=104.0)).cache()


@pytest.fixture(scope="module")
def risks(feat):
    return risk.cannibalization(feat).cache()


def test_sound_marts_pass(merchant_daily, offer_daily, inc, feat, risks):
    for check, df in ((quality.check_merchant_daily, merchant_daily), (quality.check_offer_daily, offer_daily),
                      (quality.check_incrementality, inc), (quality.check_features, feat),
                      (quality.check_cannibalization, risks)):
        assert failures(check(df)) == {}


def broken(df, column, value):
    return df.withColumn(column, F.expr(value).cast(df.schema[column].dataType))


MERCHANT = [
    ("null_required", "merchant_id", "null"), ("negative_metric", "gross_spend_amount", "-1"),
    ("invalid_rate", "platform_fee_rate", "1.2"), ("redeemed_over_transactions", "redeemed_transaction_count", "9"),
    ("formula_mismatch", "merchant_net_after_reward", "merchant_net_after_reward + 0.02"),
    ("formula_mismatch", "platform_fee_amount", "null"),
]
OFFER = [
    ("null_required", "offer_id", "null"), ("negative_metric", "reward_cost_amount", "-1"),
    ("invalid_ratio", "reward_to_redeemed_spend_ratio", "1.5"),
    ("redeemed_over_matched", "redeemed_transaction_count", "9"),
    ("formula_mismatch", "reward_to_redeemed_spend_ratio", "reward_to_redeemed_spend_ratio + 0.001"),
]
INC = [
    ("null_required", "lift_per_cardmember", "null"), ("invalid_count", "control_cardmember_count", "0"),
    ("negative_amount", "total_test_reward_amount", "-1"), ("invalid_rate", "merchant_margin_rate", "1.2"),
    ("invalid_direction", "lift_direction", "'upward'"), ("lift_formula", "lift_per_cardmember", "lift_per_cardmember + 0.02"),
    ("revenue_formula", "incremental_revenue_amount", "incremental_revenue_amount + 0.02"),
    ("lift_percentage_formula", "lift_percentage", "lift_percentage + 0.001"),
    ("value_formula", "estimated_incremental_value_after_reward", "estimated_incremental_value_after_reward - 0.02"),
]
FEAT = [
    ("null_required", "efficiency_status", "null"), ("invalid_rate", "normalized_platform_fee_rate", "-0.1"),
    ("negative_cost", "funded_reward_cost_amount", "-1"), ("invalid_profitability_status", "profitability_status", "'ok'"),
    ("invalid_efficiency_status", "efficiency_status", "'ok'"),
    ("margin_formula", "estimated_incremental_margin_amount", "estimated_incremental_margin_amount + 0.02"),
    ("cogs_formula", "estimated_incremental_cogs_amount", "estimated_incremental_cogs_amount + 0.02"),
    ("platform_fee_formula", "platform_fee_revenue_base_amount", "0"),
    ("net_profit_formula", "net_merchant_profit_amount", "net_merchant_profit_amount + 0.02"),
    ("total_cost_formula", "total_offer_cost_amount", "total_offer_cost_amount + 0.02"),
    ("roas_formula", "margin_roas", "margin_roas + 0.001"), ("profitability_label", "profitability_status", "'profitable'"),
    ("decision_flags", "spend_lift_but_profit_loss_flag", "false"),
    ("decision_flags", "negative_lift_and_unprofitable_flag", "null"),
]
RISK = [
    ("null_required", "cannibalization_risk_reason", "null"), ("invalid_risk_level", "cannibalization_risk_level", "'huge'"),
    ("invalid_primary_driver", "primary_cannibalization_risk_driver", "'moon'"),
    ("negative_score", "cannibalization_risk_score", "-5"), ("risk_points", "weak_lift_risk_points", "14"),
    ("risk_score", "cannibalization_risk_score", "cannibalization_risk_score + 1"),
    ("risk_level", "cannibalization_risk_level", "'low'"), ("merchant_review_flag", "requires_merchant_review_flag", "false"),
    ("offer_redesign_flag", "requires_offer_redesign_flag", "false"), ("safe_to_scale_flag", "safe_to_scale_flag", "true"),
    ("primary_driver", "primary_cannibalization_risk_driver", "'weak_lift'"),
]
PLANTED = (
    [("merchant_daily", *p) for p in MERCHANT] + [("offer_daily", *p) for p in OFFER] + [("inc", *p) for p in INC]
    + [("feat", *p) for p in FEAT] + [("risks", *p) for p in RISK]
)
CHECK = {"merchant_daily": quality.check_merchant_daily, "offer_daily": quality.check_offer_daily,
         "inc": quality.check_incrementality, "feat": quality.check_features, "risks": quality.check_cannibalization}


@pytest.mark.parametrize("mart,check,column,value", PLANTED)
def test_planted_defect_fires(request, mart, check, column, value):
    df = request.getfixturevalue(mart)
    assert failures(CHECK[mart](broken(df, column, value))).get(check, 0) > 0


def test_duplicate_grain_fires(merchant_daily, risks):
    assert failures(quality.check_merchant_daily(merchant_daily.unionByName(merchant_daily))) == {"duplicate_grain": 2}
    assert failures(quality.check_cannibalization(risks.unionByName(risks))) == {"duplicate_grain": 1}


def test_metadata_checks(inc):
    checks = quality.with_metadata(quality.INCREMENTALITY_CHECKS, "incrementality", C.INCREMENTALITY_RULES)
    good = stamp(inc, "incrementality", C.INCREMENTALITY_RULES, "run")
    assert failures(quality.check_incrementality(good, checks)) == {}
    old = stamp(inc, "incrementality", "rules_v0", "run")
    assert failures(quality.check_incrementality(old, checks)) == {"rule_version": 1}
    lost = broken(good, "incrementality_pipeline_run_id", "null")
    assert failures(quality.check_incrementality(lost, checks)) == {"null_metadata": 1}


SPEC = C.ScdSpec("dim", "dim_scd", "k", ("v",))


def test_scd_checks(spark):
    good = scd.first_snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), SPEC, "r")
    assert failures(quality.check_scd(good, SPEC)) == {}
    ended = good.withColumn("effective_end_date", F.date_sub("effective_start_date", 5))
    assert failures(quality.check_scd(ended, SPEC)) == {"end_before_start": 2, "current_with_end_date": 2}
    assert failures(quality.check_scd(good.withColumn("is_current", F.lit(False)), SPEC)) == {"not_exactly_one_current": 2}
    twice = good.unionByName(good.filter("k = 1"))
    assert failures(quality.check_scd(twice, SPEC)) == {"not_exactly_one_current": 1, "duplicate_surrogate": 1}
    shared = good.withColumn("surrogate_scd_id", F.lit("scd_x"))
    assert failures(quality.check_scd(shared, SPEC)) == {"duplicate_surrogate": 1}
    assert failures(quality.check_scd(broken(good, "scd_record_hash", "null"), SPEC)) == {"null_required": 2}


def test_keys_and_relations(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    row = quality.key_quality(df, "t", "k").first()
    assert (row.row_count, row.null_count, row.duplicate_count) == (4, 1, 1)
    parent = spark.createDataFrame([("a",)], "p string")
    assert [r.orphan_key for r in quality.orphan_keys(df, "k", parent, "p").collect()] == ["b"]
    relation = C.Relation("child_to_parent", "child", "k", "parent", "p")
    assert failures(quality.check_relations({"child": df, "parent": parent}, [relation])) == {"child_to_parent": 1}


def test_release_checks(spark):
    spec = C.TableSpec("t", "k", "k string, v int")
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert failures(quality.check_release(good, spec)) == {}
    assert failures(quality.check_release(good.limit(0), spec)) == {"minimum_row_count": 1}
    assert failures(quality.check_release(good.drop("v"), spec)) == {"required_columns": 1}
    assert failures(quality.check_release(good.unionByName(good.limit(1)), spec)) == {"primary_key_uniqueness": 1}
    assert set(failures(quality.check_release(good.drop("k"), spec))) == {"required_columns", "primary_key_uniqueness"}
    assert quality.check_release(None, spec) is None


def test_money_identities(spark):
    liability = spark.createDataFrame([(10.0, 7.5, 2.5), (10.0, 7.5, 2.49), (10.0, 7.5, 2.48)],
                                      "reward_amount double, merchant_funded_amount double, platform_funded_amount double")
    # a cent of rounding is tolerated, two are not
    assert failures(quality.check_money({"fact_reward_liability": liability})) == {"reward_funding_split": 1}


def test_gates_and_summary(spark):
    df = spark.createDataFrame([(1, -1.0), (None, 2.0)], "k int, x double")
    checks = quality.check_rows(df, "t", [
        quality.Check("key", "k IS NULL", "critical"), quality.Check("amount", "x < 0", "medium"),
        quality.Check("fine", "x > 100", "high")])
    assert failures(checks) == {"key": 1, "amount": 1}
    assert quality.summarize(checks).first().asDict() == {"total": 3, "passed": 1, "failed": 2}
    gate = quality.promotion(checks).first()
    assert (gate.action, gate.may_promote, gate.failed_checks) == ("fail", False, 2)
    soft = quality.promotion(checks.filter("check_name <> 'key'")).first()
    assert (soft.action, soft.may_promote) == ("flag", True)
    with pytest.raises(ValueError, match="t.key=1"):
        quality.ensure_passed(checks)


def test_drift(spark):
    df = spark.createDataFrame([(1, "a", None)], "k int, v string, extra string")
    got = {r.column_name: (r.drift, r.value_count) for r in quality.schema_drift(df, "k bigint, v string, w date").collect()}
    assert got == {"k": ("type_changed", 1), "v": ("matched", 1), "w": ("missing", 0), "extra": ("unexpected", 0)}


def test_quarantine_keeps_the_record(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 5.0), (None, -1.0)], "k int, x double")
    rules = [cleaning.RowRule("E1", "no key", "k IS NULL"), cleaning.RowRule("E2", "negative", "x < 0")]
    bad = cleaning.quarantined(df, rules, "t", "run", "path")
    assert sorted((r.validation_error_code, r.record_payload) for r in bad.collect()) == [
        ("E1", '{"x":-1.0}'), ("E2", '{"k":1,"x":-5.0}'), ("E2", '{"x":-1.0}')]
    assert [r.k for r in cleaning.accepted(df, rules).collect()] == [2]


def test_group_integrity(spark):
    assigned = spark.createDataFrame([("c1", "o", "test"), ("c1", "o", "control"), ("c2", "o", "control")],
                                     "tokenized_cardmember_id string, offer_id string, assignment_group string")
    seen = spark.createDataFrame([("c2", "o"), ("c2", "o")], "tokenized_cardmember_id string, offer_id string")
    assert [r.tokenized_cardmember_id for r in quality.mixed_groups(assigned).collect()] == ["c1"]
    assert [r.tokenized_cardmember_id for r in quality.exposed_controls(assigned, seen).collect()] == ["c2"]
    bought = spark.createDataFrame([("c1", "o"), ("c3", "o")], "tokenized_cardmember_id string, offer_id string")
    lost = quality.control_without_assignment(bought, assigned).collect()
    assert [r.tokenized_cardmember_id for r in lost] == ["c3"]


def test_missing_columns_raise_before_any_job(spark):
    with pytest.raises(ValueError, match="lacks required columns: merchant_id"):
        marts.merchant_daily_spend(spark.createDataFrame([("t", DAY, 1.0)],
                                   "transaction_id string, transaction_date date, transaction_amount double"))


def test_absent_tables_and_unknown_severities_fail(spark):
    df = spark.createDataFrame([(1,)], "k int")
    relation = C.Relation("child_to_parent", "child", "k", "parent", "k")
    assert failures(quality.check_relations({"child": df}, [relation])) == {"child_to_parent: table absent": 1}
    rows = spark.createDataFrame(
        [("a", "c", 1, "odd", "failed"), ("b", "c", 1, None, "failed"), ("c", "c", 0, "odd", "passed")],
        "table_name string, check_name string, failure_count long, severity string, status string")
    assert {r.table_name: r.may_promote for r in quality.promotion(rows).collect()} == {"a": False, "b": False, "c": True}
