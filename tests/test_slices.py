"""Intervals, velocity and quantiles: the sliced and sketched ways against plain ones, with hot keys."""

import datetime as dt
import random

from pyspark.sql import functions as F

from spendlens.operators import abuse, experiment, quality, scd
from spendlens.sources.contracts import ScdSpec


def plain_faults(rows):
    out, by_key = [], {}
    for key, start, end in rows:
        if key is not None and start is not None:
            by_key.setdefault(key, []).append((start, end or dt.date(9999, 12, 31), end))
    for key, versions in by_key.items():
        until = None
        for start, last, end in sorted(versions, key=lambda v: v[:2]):
            if until is not None and start <= until:
                out.append((key, start, end, until, "overlap"))
            elif until is not None and start > until + dt.timedelta(days=1):
                out.append((key, start, end, until, "gap"))
            until = last if until is None else max(until, last)
    return sorted(out, key=str)


def test_interval_faults_of_a_hot_key(spark):
    draw = random.Random(5)
    day = dt.date(2020, 1, 1)
    rows = [(draw.choice(["hot", "hot", f"k{draw.randrange(40)}"]), day + dt.timedelta(days=draw.randrange(4000)), None) for _ in range(900)]
    rows = [(k, s, None if draw.random() < 0.002 else s + dt.timedelta(days=draw.choice([0, 1, 5, 30, 900]))) for k, s, _ in rows]
    rows += [(None, day, day), ("k1", None, day)]
    df = spark.createDataFrame(rows, "k string, effective_start_date date, effective_end_date date")
    expected = plain_faults(rows)
    assert len(expected) > 300
    for days in (1, 30, 366, 100_000):
        assert sorted(map(tuple, scd.interval_faults(df, "k", slice_days=days).collect()), key=str) == expected


def test_planted_interval_faults_fail(spark):
    spec = ScdSpec("x", "x_scd", "k", ())
    good = [("a", "2020-01-01", "2020-01-31"), ("a", "2020-02-01", None), ("b", "2020-01-01", None)]
    def statuses(rows):
        df = spark.createDataFrame(rows, "k string, s string, e string").selectExpr("k", "DATE(s) AS effective_start_date", "DATE(e) AS effective_end_date")
        return {r.check_name: (r.failure_count, r.status) for r in quality.check_intervals(df, spec).collect()}
    assert statuses(good) == {"overlapping_versions": (0, "passed"), "gaps_between_versions": (0, "passed")}
    assert statuses([*good, ("b", "2021-01-01", None), ("c", "2020-01-01", "2020-01-02"), ("c", "2020-01-04", None)]) == {
        "overlapping_versions": (1, "failed"), "gaps_between_versions": (1, "failed")}


def test_velocity_of_a_burst(spark):
    draw = random.Random(6)
    start = dt.datetime(2024, 1, 1)
    rows = [(1, i, start + dt.timedelta(seconds=draw.randrange(7200))) for i in range(800)]  # one card's burst within one window
    rows += [(draw.randrange(2, 30), 1000 + i, start + dt.timedelta(seconds=draw.choice([0, 3600, 86400, 86401, draw.randrange(400_000)]))) for i in range(300)]
    rows += [(None, 5000, start), (3, 5001, None)]
    df = spark.createDataFrame(rows, "tokenized_cardmember_id long, transaction_id long, at timestamp")
    window = dt.timedelta(seconds=86400)
    expected = set()
    for card, tx, at in rows:
        if card is not None and at is not None:
            n = sum(c == card and a is not None and at - window <= a <= at for c, _, a in rows)
            if n >= 4:
                expected.add((card, tx, n))
    for parts in (1, 24, 1000):
        got = abuse.redemption_velocity(df, "at", 86400, 4, parts=parts).collect()
        assert {(r.tokenized_cardmember_id, r.transaction_id, r.events_in_window) for r in got} == expected and len(got) == len(expected)
    plan = abuse.redemption_velocity(df, "at", 86400, 4)
    sizes = plan.select(F.floor(F.unix_seconds("at") / 3600).alias("slice")).filter("true").distinct().count()
    assert sizes > 2


def test_quantile_sketch_within_its_error(spark):
    """More cards than the sketch holds apart: ranks stay within the stated error."""
    n, accuracy = 60_000, 100
    df = spark.range(n).select(F.lit("x").alias("campaign_id"), F.col("id").alias("tokenized_cardmember_id"), (F.col("id") * 7919 % n).cast("double").alias("transaction_amount"))
    row = experiment.spend_quantiles(df, ["campaign_id"], accuracy).first()
    for value, share in ((row.first_quartile, 0.25), (row.median_spend, 0.5), (row.third_quartile, 0.75)):
        assert abs(value - share * n) <= n / accuracy + 1
    exact = experiment.spend_quantiles(df.limit(999), ["campaign_id"]).first()
    spends = sorted(r.transaction_amount for r in df.limit(999).collect())
    assert exact.median_spend == spends[499]
    far = df.limit(999).unionByName(spark.createDataFrame([("x", -1, 1e9)], df.schema))
    assert [r.tokenized_cardmember_id for r in experiment.quantile_outliers(far, ["campaign_id"]).collect()] == [-1]


def test_detected_hits_have_one_row_for_each_rule(spark):
    at = dt.datetime(2024, 1, 1, 12)
    day = at.date()
    tx = spark.createDataFrame(
        [(i, 1, 10 + i % 4, at + dt.timedelta(minutes=i), day, "refunded" if i == 0 else "settled") for i in range(8)],
        "transaction_id long, tokenized_cardmember_id long, merchant_id long, transaction_timestamp timestamp, transaction_date date, transaction_status string",
    ).withColumn("transaction_amount", F.lit(5.0))
    redeemed = tx.select("transaction_id", "tokenized_cardmember_id", F.lit(7).alias("offer_id"), "transaction_timestamp", "transaction_date")
    liability = tx.select("transaction_id", F.lit("l").alias("reward_liability_id"), "tokenized_cardmember_id", "merchant_id", F.lit(1.0).alias("reward_amount"))
    places = spark.createDataFrame([(10 + i, i) for i in range(4)], "merchant_id long, location_id long")
    hits = abuse.detected_hits(tx, redeemed, liability, places).collect()
    assert len({(h.transaction_id, h.risk_rule_name) for h in hits}) == len(hits)
    by_rule = {}
    for h in hits:
        by_rule.setdefault(h.risk_rule_name, {})[h.transaction_id] = (h.evidence, h.risk_score)
    assert by_rule["refund_after_reward"] == {0: (4.0, 0.9)}
    assert set(by_rule["duplicate_redemption"]) == set(range(1, 8)) and by_rule["duplicate_redemption"][1] == (7.0, 1.0)
    assert by_rule["high_redemption_velocity"] == {4: (1.0, 0.6), 5: (2.0, 0.7), 6: (3.0, 0.8), 7: (4.0, 0.9)}
    assert set(by_rule["merchant_location_anomaly"]) == set(range(8)) and by_rule["merchant_location_anomaly"][3] == (2.0, 0.7)
    assert set(by_rule["reward_gaming_pattern"]) == set(range(8))
