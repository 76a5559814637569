"""Hand-checkable cases of every business rule."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spendlens.functions import rules as R
from spendlens.functions.exprs import derive, fingerprint, money_mean, money_sum, ratio_nz, ratio_pos
from spendlens.operators import abuse, cleaning, experiment, finance, incrementality, lineage, marts, privacy, risk, scd
from spendlens.sources.contracts import TABLE, ScdSpec

DAY = dt.date(2026, 3, 1)


def one(df):
    return df.first().asDict()


def test_ratios(spark):
    df = spark.createDataFrame([(6.0, 2.0), (6.0, -2.0), (6.0, 0.0), (6.0, None)], "n double, d double")
    got = derive(df, {"p": ratio_pos("n", "d"), "z": ratio_nz("n", "d")}).select("p", "z").collect()
    assert [tuple(r) for r in got] == [(3.0, 3.0), (0.0, -3.0), (0.0, 0.0), (0.0, 0.0)]


def test_money_sum_is_exact_and_keeps_parts_of_a_cent(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(10.0050,), (None,)], "x double")
    got = df.agg(money_sum("x").alias("s"), money_mean("x").alias("m")).first()
    assert got.s == 11.005 and got.m == pytest.approx(11.005 / 11)


def test_silver_cleaning(spark):
    raw = spark.createDataFrame(
        [("tx_001", "2026-03-01 10:00:00", "2026-03-01", "42.50"), ("tx_001", "2026-03-01 10:00:00", "2026-03-01", "42.50"),
         ("tx_002", "broken", "2026-03-01", "15.25"), (None, None, None, None)],
        "transaction_id string, transaction_timestamp string, transaction_date string, transaction_amount string")
    rows = cleaning.clean(raw, TABLE["fact_transactions"]).orderBy("transaction_id").collect()
    assert [r.transaction_amount for r in rows] == [42.5, 15.25]
    assert rows[0].transaction_date == DAY and rows[1].transaction_timestamp is None


def test_dedupe_is_deterministic_and_idempotent(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, None, "z"), (2, 1, "q")], "k int, v int, t string")
    once = cleaning.first_per_key(df, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, None, "z"), (2, 1, "q")]
    again = cleaning.first_per_key(once.unionByName(once), ["k"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_fingerprint_collision_and_its_cure(spark):
    df = spark.createDataFrame([("a", ""), ("a", None)], "x string, y string")
    plain = {r.h for r in df.select(fingerprint(["x", "y"]).alias("h")).collect()}
    cured = {r.h for r in df.select(fingerprint(["x", "y"], length_prefixed=True).alias("h")).collect()}
    assert len(plain) == 1 and len(cured) == 2


def test_merchant_daily(spark):
    tx = spark.createDataFrame(
        [("t1", "m_001", DAY, 100.0), ("t2", "m_001", DAY, 50.0), ("t3", "m_002", DAY, 200.0)],
        "transaction_id string, merchant_id string, transaction_date date, transaction_amount double")
    red = spark.createDataFrame(
        [("r1", "t1", "m_001", DAY, 10.0), ("r2", "t3", "m_002", DAY, 20.0)],
        "matched_redemption_id string, transaction_id string, merchant_id string, transaction_date date, "
        "calculated_reward_amount double")
    merchants = spark.createDataFrame(
        [("m_001", 0.30, 0.03), ("m_002", 0.25, 0.04)],
        "merchant_id string, merchant_margin_rate double, platform_fee_rate double")
    for unique in (False, True):
        mart = marts.merchant_daily_economics(
            marts.merchant_daily_spend(tx, unique), marts.merchant_daily_rewards(red, unique), merchants)
        rows = {r.merchant_id: r for r in mart.collect()}
        a, b = rows["m_001"], rows["m_002"]
        assert (a.transaction_count, a.gross_spend_amount, a.reward_cost_amount) == (2, 150.0, 10.0)
        assert (a.platform_fee_amount, a.estimated_merchant_margin_amount) == pytest.approx((4.5, 45.0))
        assert a.merchant_net_after_reward == pytest.approx(30.5) and a.redemption_rate == 0.5
        assert b.merchant_net_after_reward == pytest.approx(22.0)


def groups(spark, test_spend, control_spend, reward=0.0):
    test = spark.createDataFrame(
        [(f"r{i}", f"t{i}", "o", "c", "m", f"card{i}", DAY, s, reward) for i, s in enumerate(test_spend)],
        "matched_redemption_id string, transaction_id string, offer_id string, campaign_id string, merchant_id string, "
        "tokenized_cardmember_id string, transaction_date date, transaction_amount double, "
        "calculated_reward_amount double")
    control = spark.createDataFrame(
        [(f"k{i}", "o", "c", "m", f"ctl{i}", DAY, s) for i, s in enumerate(control_spend)],
        "control_transaction_id string, offer_id string, campaign_id string, merchant_id string, "
        "tokenized_cardmember_id string, transaction_date date, transaction_amount double")
    offers = spark.createDataFrame([("o", "c", "m", 10.0, 5.0)],
                                   "offer_id string, campaign_id string, merchant_id string, "
                                   "minimum_spend_amount double, reward_amount double")
    return test, control, offers


def rates(spark, margin, fee):
    return spark.createDataFrame([("m", margin, fee)],
                                 "merchant_id string, merchant_margin_rate double, platform_fee_rate double")


def test_lift(spark):
    test, control, offers = groups(spark, [120.0, 100.0, 80.0], [80.0, 90.0, 70.0])
    row = one(incrementality.incrementality(test, control, offers, rates(spark, 0.4, 0.02)))
    assert row["average_test_spend_per_cardmember"] == 100.0
    assert row["average_control_spend_per_cardmember"] == 80.0
    assert row["lift_per_cardmember"] == 20.0 and row["incremental_revenue_amount"] == 60.0
    assert row["lift_direction"] == "positive_lift"


def test_recorded_positive_row(spark):
    test, control, offers = groups(spark, [73.93], [70.38], reward=5.0)
    row = one(incrementality.incrementality(test, control, offers, rates(spark, 0.1279, 0.0288)))
    assert row["lift_per_cardmember"] == pytest.approx(3.55)
    assert row["lift_percentage"] == pytest.approx(0.05044, abs=1e-5)
    assert row["estimated_incremental_margin_amount"] == pytest.approx(0.454045)
    assert row["estimated_incremental_platform_fee_amount"] == pytest.approx(0.10224)
    assert row["estimated_incremental_value_after_reward"] == pytest.approx(-4.648195)


def test_recorded_negative_row_floors_the_fee(spark):
    test, control, offers = groups(spark, [83.26], [325.62], reward=5.0)
    inc = incrementality.incrementality(test, control, offers, rates(spark, 0.13276, 0.0248))
    row, feat = one(inc), one(incrementality.features(inc))
    assert row["lift_per_cardmember"] == pytest.approx(-242.36)
    assert row["estimated_incremental_platform_fee_amount"] == pytest.approx(-6.010528)
    assert feat["estimated_incremental_platform_fee_amount"] == 0.0
    assert feat["net_merchant_profit_amount"] == pytest.approx(-242.36 * 0.13276 - 5)
    assert feat["efficiency_status"] == "negative_incrementality"
    assert feat["profitability_explanation"].startswith("Offer underperformed")


def feature_row(spark, revenue, margin, fee, reward, cards=100, avg_test=130.0, avg_control=100.0):
    given = {
        "business_date": DAY, "offer_id": "o", "campaign_id": "c", "merchant_id": "m", "minimum_spend_amount": 10.0,
        "reward_amount": 5.0, "merchant_margin_rate": margin, "platform_fee_rate": fee, "test_cardmember_count": cards,
        "test_transaction_count": cards, "test_redemption_count": cards, "total_test_spend_amount": avg_test * cards,
        "total_test_reward_amount": reward, "control_cardmember_count": cards, "control_transaction_count": cards,
        "total_control_spend_amount": avg_control * cards, "average_test_spend_per_cardmember": avg_test,
        "average_control_spend_per_cardmember": avg_control, "lift_per_cardmember": avg_test - avg_control,
        "lift_direction": "positive_lift", "lift_percentage": (avg_test - avg_control) / avg_control,
        "incremental_revenue_amount": revenue, "incremental_revenue_direction": "positive_incremental_revenue",
    }
    return spark.createDataFrame([Row(**given)])


def test_roas_example(spark):
    row = one(incrementality.features(feature_row(spark, 10_000.0, 0.30, 0.03, 500.0)))
    assert row["estimated_incremental_margin_amount"] == 3000 and row["net_merchant_profit_amount"] == 2200
    assert (row["reward_roas"], row["total_cost_roas"], row["margin_roas"], row["net_profit_roas"]) == (
        20.0, 12.5, 3.75, 2.75)
    assert row["cost_per_incremental_revenue_dollar"] == pytest.approx(0.08)
    assert row["efficiency_status"] == "highly_efficient" and row["profitability_status"] == "profitable"


@pytest.mark.parametrize("revenue,margin,fee,reward,profit,status", [
    (10_000.0, 0.30, 0.03, 500.0, 2200.0, "profitable"),
    (1_000.0, 0.25, 0.0, 950.0, -700.0, "unprofitable"),
    (-2_000.0, 0.25, 0.03, 300.0, -800.0, "unprofitable"),
    (0.0, 0.25, 0.03, 0.0, 0.0, "break_even"),
])
def test_net_profit(spark, revenue, margin, fee, reward, profit, status):
    row = one(incrementality.features(feature_row(spark, revenue, margin, fee, reward)))
    assert row["net_merchant_profit_amount"] == pytest.approx(profit) and row["profitability_status"] == status


def test_risk_score_and_driver(spark):
    # loss with positive lift, reward above margin, low returns, weak lift
    df = incrementality.features(feature_row(spark, 300.0, 0.2, 0.02, 2000.0, avg_test=104.0)).withColumn(
        "reward_cost_share_of_incremental_revenue", F.lit(0.1)).withColumn(
        "average_test_spend_per_cardmember", F.lit(150.0))
    row = one(risk.cannibalization(df))
    assert row["cannibalization_risk_score"] == 95 and row["cannibalization_risk_level"] == "critical"
    assert row["primary_cannibalization_risk_driver"] == "positive_spend_lift_but_profit_loss"
    assert row["requires_offer_redesign_flag"] and not row["safe_to_scale_flag"]
    assert row["cannibalization_risk_detail"].startswith("Risk level: critical | Score: 95 | Driver: positive_spend")


def test_safe_offer(spark):
    row = one(risk.cannibalization(incrementality.features(feature_row(spark, 10_000.0, 0.30, 0.03, 500.0))))
    assert row["cannibalization_risk_score"] == 0 and row["safe_to_scale_flag"]
    assert row["primary_cannibalization_risk_driver"] == "low_risk_profitable_offer"


def test_practice_score(spark):
    df = spark.createDataFrame(
        [(2200.0, 0.3, 12.5, False), (-700.0, 0.05, 1.0, True), (-740.0, -0.2, 0.0, False)],
        "net_merchant_profit_amount double, lift_percentage double, total_cost_roas double, "
        "spend_lift_but_profit_loss_flag boolean")
    got = [(r.cannibalization_risk_score, r.cannibalization_risk_level) for r in risk.practice_score(df).collect()]
    assert got == [(0, "low"), (100, "critical"), (85, "critical")]


def test_rewards_and_funding(spark):
    df = spark.createDataFrame(
        [("percent_cashback", 400.0, 0.0, 0.10, 25.0), ("percent_cashback", 100.0, 0.0, 0.10, 25.0),
         ("fixed_cashback", 400.0, 15.0, 0.10, 25.0)],
        "offer_type string, transaction_amount double, reward_amount double, reward_multiplier double, "
        "max_reward_amount double")
    assert [r.x for r in derive(df, {"x": R.reward_amount()}).collect()] == [25.0, 10.0, 15.0]
    split = spark.createDataFrame([(10.01, "shared"), (10.01, "merchant"), (10.01, "platform")],
                                  "reward_amount double, liability_owner string")
    got = [(r.merchant_funded_amount, r.platform_funded_amount) for r in derive(split, R.funding_split()).collect()]
    assert got == [(7.51, 2.5), (10.01, 0.0), (0.0, 10.01)]
    with pytest.raises(Exception, match="unsupported liability_owner"):
        derive(split.withColumn("liability_owner", F.lit("bank")), R.funding_split()).collect()


def test_settlement_and_reconciliation(spark):
    tx = spark.createDataFrame([("t1", "m", DAY, 100.0), ("t2", "m", DAY, 100.0), ("t3", "gone", DAY, 9.0)],
                               "transaction_id string, merchant_id string, transaction_date date, "
                               "transaction_amount double")
    red = spark.createDataFrame(
        [(r, "t1", "a", "card", "o", "c", "m", DAY, dt.datetime(2026, 3, 1, h), 10.0) for r, h in (("r1", 1), ("r2", 2))],
        "redemption_id string, transaction_id string, activation_id string, tokenized_cardmember_id string, "
        "offer_id string, campaign_id string, merchant_id string, redemption_date date, "
        "redemption_timestamp timestamp_ntz, calculated_reward_amount double")
    settled = finance.settlements(tx, rates(spark, 0.3, 0.03), finance.reward_liability(red))
    rows = {r.transaction_id: r for r in settled.collect()}
    assert set(rows) == {"t1", "t2"} and rows["t1"].redemption_id == "r2"
    assert (rows["t1"].platform_fee_amount, rows["t1"].merchant_settlement_amount,
            rows["t1"].merchant_net_after_reward) == (3.0, 97.0, 87.0)
    assert rows["t2"].liability_owner == "none" and rows["t2"].redemption_id is None
    off = settled.withColumn("merchant_settlement_amount", F.when(F.col("transaction_id") == "t2", 90.0).otherwise(
        F.col("merchant_settlement_amount")))
    rec = {r.transaction_id: r for r in finance.reconciliation(tx, off).collect()}
    assert (rec["t1"].settlement_delta, rec["t1"].reconciliation_status) == (0.0, "matched")
    assert (rec["t2"].settlement_delta, rec["t2"].reconciliation_reason) == (7.0, finance.OFF_TOLERANCE)
    assert (rec["t3"].settlement_delta, rec["t3"].reconciliation_reason) == (9.0, finance.NO_SETTLEMENT)


SPEC = ScdSpec("dim", "dim_scd", "k", ("v",))


def test_scd_life(spark):
    def state(rows):
        return spark.createDataFrame(rows, "k int, v string")

    def view(df):
        return sorted((r.k, r.v, str(r.effective_start_date), str(r.effective_end_date), r.is_current)
                      for r in df.collect())

    first = scd.first_snapshot(state([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "x")]), SPEC, "r")
    assert view(first) == [(1, "a", "2026-01-01", "None", True), (2, "b", "2026-01-01", "None", True),
                           (3, "c", "2026-01-01", "None", True)]
    assert first.select("surrogate_scd_id").distinct().count() == 3
    second = scd.merge(first, state([(1, "a"), (2, "B"), (4, "d")]), SPEC, "2026-05-01", "r")
    second = spark.createDataFrame(second.collect(), second.schema)  # as a published table would be
    assert view(second) == [
        (1, "a", "2026-01-01", "None", True), (2, "B", "2026-05-01", "None", True),
        (2, "b", "2026-01-01", "2026-04-30", False), (3, "c", "2026-01-01", "None", True),
        (4, "d", "2026-05-01", "None", True)]
    assert view(scd.merge(second, state([(1, "a"), (2, "B"), (4, "d")]), SPEC, "2026-06-01", "r")) == view(second)
    same_day = scd.merge(second, state([(2, "BB")]), SPEC, "2026-05-01", "r", close_missing=True)
    assert (2, "BB", "2026-05-01", "None", True) in view(same_day)
    assert (2, "B", "2026-05-01", "None", True) not in view(same_day)
    assert (1, "a", "2026-01-01", "2026-04-30", False) in view(same_day)

    facts = spark.createDataFrame([(2, dt.date(2026, 4, 30)), (2, dt.date(2026, 5, 1)), (2, dt.date(2025, 1, 1)),
                                   (9, DAY)], "k int, day date")
    got = sorted((r.k, str(r.day), r.v) for r in scd.as_of_join(facts, second, "k", "day", ["v"]).collect())
    assert got == [(2, "2025-01-01", None), (2, "2026-04-30", "b"), (2, "2026-05-01", "B"), (9, "2026-03-01", None)]


def test_scd_late_snapshots(spark):
    def state(rows):
        return spark.createDataFrame(rows, "k int, v string")

    def view(df):
        return sorted((r.k, r.v, str(r.effective_start_date), str(r.effective_end_date), r.is_current) for r in df.collect())

    def held(df):
        return spark.createDataFrame(df.collect(), df.schema)  # as a published table would be

    first = held(scd.merge(scd.first_snapshot(state([(1, "x")]), SPEC, "r").limit(0), state([(1, "a")]), SPEC, "2026-01-01", "r"))
    two = held(scd.merge(first, state([(1, "b")]), SPEC, "2026-06-01", "r"))
    late = scd.merge(two, state([(1, "c")]), SPEC, "2026-03-01", "r")
    assert view(late) == [
        (1, "a", "2026-01-01", "2026-02-28", False), (1, "b", "2026-06-01", "None", True), (1, "c", "2026-03-01", "2026-05-31", False)]
    assert view(scd.merge(two, state([(1, "a")]), SPEC, "2026-03-01", "r")) == view(two)
    assert view(scd.merge(two, state([(1, "c")]), SPEC, "2026-01-01", "r"))[1] == (1, "c", "2026-01-01", "2026-05-31", False)
    assert view(scd.merge(two, state([(1, "z")]), SPEC, "2025-12-01", "r"))[2] == (1, "z", "2025-12-01", "2025-12-31", False)
    opened = held(scd.merge(first, state([(2, "n")]), SPEC, "2026-02-01", "r"))
    gone = scd.merge(opened, state([(1, "a")]), SPEC, "2026-02-01", "r", close_missing=True)
    assert [r for r in view(gone) if r[0] == 2] == []


def test_calendar(spark):
    days = spark.createDataFrame([(dt.date(2026, 1, 1) + dt.timedelta(n),) for n in range(365)], "calendar_date date")
    for r in derive(days, R.calendar_columns()).collect():
        d = r.calendar_date
        assert r.week_of_year == int(d.strftime("%U")) and r.day_of_week == d.strftime("%A")
        assert r.date_id == d.strftime("%Y%m%d") and r.month_name == d.strftime("%B")
        assert r.is_weekend == (d.weekday() >= 5) and r.is_holiday == (r.holiday_name is not None)
        assert r.quarter == (d.month - 1) // 3 + 1


def test_first_look_economics(spark):
    df = spark.createDataFrame([(120_000.0, 1000, 90_000.0, 1000, 0.4, 7000.0, 1000.0)],
                               "test_spend double, test_users int, control_spend double, control_users int, "
                               "margin_rate double, reward_cost double, platform_fee double")
    row = one(derive(df, R.simple_economics()))
    assert (row["lift_per_user"], row["incremental_revenue"], row["incremental_profit"]) == (30.0, 30_000.0, 4_000.0)
    assert row["simple_roas"] == pytest.approx(4.2857142857) and row["simple_risk"] == "low"
    label = derive(spark.createDataFrame([(10.0, 20.0)], "l double, r double"),
                   {"q": R.incrementality_quality("l", "r")})
    assert one(label)["q"] == "weak_lift_possible_cannibalization"


def test_velocity_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    rows = [(i, rnd.randrange(3), dt.datetime(2026, 1, 1) + dt.timedelta(seconds=rnd.randrange(4000)))
            for i in range(200)]
    df = spark.createDataFrame(rows, "transaction_id int, tokenized_cardmember_id int, ts timestamp_ntz")
    got = {r.transaction_id: r.events_in_window for r in abuse.redemption_velocity(df, "ts", 300, 5).collect()}
    want = {}
    for i, c, t in rows:
        n = sum(1 for _, c2, t2 in rows if c2 == c and t - dt.timedelta(seconds=300) <= t2 <= t)
        if n >= 5:
            want[i] = n
    assert got == want


def test_suppression_and_its_gate(spark):
    test, control, _ = groups(spark, [10.0] * 30, [8.0] * 30)
    shown = privacy.cohort_lift(test, control, ["merchant_id"])
    assert one(shown)["protected_cohort_size"] == 60 and not one(shown)["is_suppressed"]
    assert all(one(shown)[c] is None for c in privacy.VISIBLE)
    shown = privacy.cohort_lift(test, control, ["merchant_id"], min_cohort=30)
    assert one(shown)["visible_incremental_spend"] == pytest.approx(60.0)
    hidden = privacy.cohort_lift(test, control, ["merchant_id"], min_cohort=61)
    row = one(hidden)
    assert row["is_suppressed"] and all(row[c] is None for c in privacy.VISIBLE)
    assert privacy.exposed_small_cohorts(hidden).count() == 0
    leaky = hidden.withColumn("visible_reward_cost", F.lit(1.0))
    assert privacy.exposed_small_cohorts(leaky).count() == 1


def test_one_card_of_an_arm_is_not_shown(spark):
    test, control, _ = groups(spark, [777.0], [8.0] * 60)
    row = one(privacy.cohort_lift(test, control, ["merchant_id"]))
    assert row["protected_cohort_size"] is not None and row["visible_control_spend"] == pytest.approx(480.0)
    assert row["visible_test_spend"] is None and row["visible_incremental_spend"] is None
    assert row["visible_reward_cost"] is None


def test_masks_need_their_salt(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    a, b = ([r.id for r in privacy.masked(df, ["id"], salt).collect()] for salt in ("a", "b"))
    assert a[0] == a[1] != a[2] and a[3] is None and not set(a[:3]) & set(b[:3])
    with pytest.raises(ValueError):
        privacy.masked(df, ["id"], "")


def test_pii_and_columns(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.org or +1 (212) 555-0100", "4111 1111 1111 1111"), (2, None, "none")],
                               "id int, note string, email string")
    got = {(r.column_name, r.info_type): r.match_count for r in privacy.pii_scan(df, ["note", "email"]).collect()}
    assert got[("note", "email_address")] == 1 and got[("note", "phone_number")] == 1
    assert got[("email", "credit_card_number")] == 1 and got[("email", "email_address")] == 0
    quotes = {r.quote for r in privacy.pii_quotes(df, "id", "note").collect()}
    assert quotes == {"a.b@c.org", "+1 (212) 555-0100"}
    gate = privacy.column_gate(df).collect()
    assert [(r.column_name, r.kind, r.exposed_values) for r in gate] == [("email", "prohibited", 2)]
    assert privacy.column_gate(df.select("id")).count() == 0


def test_lineage_names_every_source_row(spark):
    tx = spark.createDataFrame([("t1", DAY, "m"), ("t2", DAY, "m")],
                               "transaction_id string, transaction_date date, merchant_id string")
    rows = lineage.detail(tx, "mart", "gmd", ["transaction_date", "merchant_id"], "tx", "transaction_id", "input")
    assert {r.gold_row_id for r in rows.collect()} == {"gmd_2026-03-01_m"}
    assert one(lineage.summary(rows, "all", "sum"))["source_row_count"] == 2


def test_control_matching_is_one_to_one_and_close(spark):
    cards = spark.range(400).select(
        F.col("id").alias("tokenized_cardmember_id"), (F.col("id") % 3).alias("segment_id"),
        ((F.col("id") * 37) % 101).cast("double").alias("spend"), ((F.col("id") * 11) % 17).cast("double").alias("visits"))
    test, control = cards.filter("tokenized_cardmember_id < 250"), cards.filter("tokenized_cardmember_id >= 250")
    pairs = experiment.match_controls(test, control, ["segment_id"], {"spend": 80.0, "visits": 20.0}).collect()
    tests = [r.test_tokenized_cardmember_id for r in pairs]
    controls = [r.control_tokenized_cardmember_id for r in pairs]
    assert pairs and len(set(tests)) == len(tests) and len(set(controls)) == len(controls)
    assert min(r.match_quality_score for r in pairs) >= experiment.MATCH_THRESHOLD


def test_positions_are_a_permutation(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.concat(F.lit("k"), "id").alias("key"))
    got = experiment.number_within(df, ["g"], "key", slices=7).collect()
    for g in range(3):
        positions = sorted(r.position for r in got if r.g == g)
        assert positions == list(range(1, len(positions) + 1))


def test_significance_matches_the_textbook(spark):
    import statistics as stats

    a, b = [10.0, 12.5, 9.75, 14.0, 11.0], [8.0, 9.5, 7.25, 10.0]
    test, control, _ = groups(spark, a, b)
    row = one(experiment.significance(test, control, ["offer_id"]))
    se = (stats.variance(a) / len(a) + stats.variance(b) / len(b)) ** 0.5
    assert row["mean_difference"] == pytest.approx(stats.mean(a) - stats.mean(b))
    assert row["standard_error"] == pytest.approx(se) and row["is_significant"]


def test_money_sums_of_uncommon_amounts(spark):
    """Every group's amounts, in two orders and two numbers of partitions, against exact decimal arithmetic."""
    from decimal import Decimal, getcontext
    import math

    getcontext().prec = 60
    big, nan = float("inf"), float("nan")
    groups = {
        "cents": [0.1, 0.2, 0.3, 1e9 + 0.01], "broken": [1 / 3, 2 / 3, 1e-7, -0.00012345, 123456.7891234], "large": [1e16, 0.1, -1e16, 9.9e16, 12345678901234.25],
        "tiny": [1e-18] * 9, "edge": [1e10, 9999999999.9999, -1e10, 0.0, -0.0], "one": [None, 5.5], "none": [None, None],
        "nan": [1.0, nan], "infinite": [1.0, big], "too_large": [1.0, 1e17], "below": [-big, 3.0], "both": [big, -big],
    }
    rows = [(k, x) for k, xs in groups.items() for x in xs]
    seen = set()
    for order, parts in ((rows, 1), (rows[::-1], 4)):
        df = spark.createDataFrame(order, "k string, x double").repartition(parts)
        got = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(money_sum("x").alias("s"), money_mean("x").alias("m")).collect()}
        seen.add(str(sorted(got.items())))
        for k in ("cents", "broken", "large", "tiny", "edge", "one"):
            exact = float(sum(Decimal(repr(x)) for x in groups[k] if x is not None))
            assert abs(got[k][0] - exact) <= math.ulp(exact), k
        assert got["none"] == (None, None) and math.isnan(got["nan"][0]) and math.isnan(got["both"][0])
        assert got["infinite"][0] == got["too_large"][0] == big and got["below"][0] == -big
    assert len(seen) == 1
    many = spark.range(200_000).select(F.lit(9.9e9).alias("x")).agg(money_sum("x").alias("s")).first()
    assert many.s == 9.9e9 * 200_000


def test_rates_keep_their_digits(spark):
    from spendlens.functions.exprs import cents, rate, round_money

    df = spark.createDataFrame([(1000000.0, 0.123456789), (1e16, 0.5), (10.0, float("nan")), (float("inf"), 0.1)], "a double, r double")
    got = [r.v for r in df.selectExpr(f"{round_money(cents('a') + ' * ' + rate('r'))} AS v").collect()]
    assert got == [123456.79, 5e15, None, None]
