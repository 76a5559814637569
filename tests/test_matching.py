"""Redemption matching against brute force, skew and literal cases."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlens.operators import matching

T0 = dt.datetime(2026, 3, 1)
TX = "transaction_id long, tokenized_cardmember_id long, merchant_id long, transaction_timestamp {t}, " \
     "transaction_date date, transaction_amount double"
ACT = "activation_id long, tokenized_cardmember_id long, offer_id long, activation_timestamp {t}, " \
      "offer_expiry_timestamp {t}"
OFFER = "offer_id long, campaign_id long, merchant_id long, minimum_spend_amount double, reward_amount double"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def frames(spark, tx, act, offers, kind="timestamp_ntz"):
    txs = [(i, c, m, at(h), at(h).date(), float(a)) for i, c, m, h, a in tx]
    acts = [(i, c, o, at(h), at(h + w)) for i, c, o, h, w in act]
    return (
        spark.createDataFrame(txs, TX.format(t=kind)),
        spark.createDataFrame(acts, ACT.format(t=kind)),
        spark.createDataFrame([(o, 1, m, float(s), float(r)) for o, m, s, r in offers], OFFER),
    )


def brute(tx, act, offers):
    rules = {o: (m, s, r) for o, m, s, r in offers}
    out = {}
    for i, c, m, h, a in tx:
        best = None
        for j, c2, o, h2, w in act:
            if o not in rules:
                continue
            m2, spend, reward = rules[o]
            if c == c2 and m == m2 and h2 <= h <= h2 + w and a >= spend:
                rank = (-reward, h2, o, j)
                best = rank if best is None or rank < best else best
        if best is not None:
            out[i] = (best[3], best[2])
    return out


def found(df):
    return {r.transaction_id: (r.activation_id, r.offer_id) for r in df.collect()}


rows = st.integers(0, 1)
hour = st.integers(0, 900)
transactions = st.lists(st.tuples(rows, rows, hour, st.integers(0, 9)), max_size=14)
activations = st.lists(st.tuples(rows, st.integers(0, 3), hour, st.integers(0, 500)), max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(transactions, activations, st.lists(st.integers(0, 2), min_size=4, max_size=4))
def test_sorted_choice_equals_brute_force(spark, tx, act, rewards):
    tx = [(i, *t) for i, t in enumerate(tx)]
    act = [(i, *a) for i, a in enumerate(act)]
    offers = [(o, o % 2, 3 * (o % 3), r) for o, r in enumerate(rewards)]
    t, a, o = frames(spark, tx, act, offers)
    assert found(matching.match_redemptions(t, a, o, "r")) == brute(tx, act, offers)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(transactions, activations)
def test_counts_and_first_redemptions_equal_brute_force(spark, tx, act):
    tx = [(i, *t) for i, t in enumerate(tx)]
    act = [(i, *a) for i, a in enumerate(act)]
    offers = [(o, o % 2, 3 * (o % 3), 1) for o in range(4)]
    rules = {o: (m, s) for o, m, s, _ in offers}
    pairs = {}
    for i, c, m, h, amount in tx:
        for j, c2, o, h2, w in act:
            if c == c2 and rules[o][0] == m and h2 <= h <= h2 + w and amount >= rules[o][1]:
                pairs.setdefault((i, o), []).append((j, h))
    t, a, o = frames(spark, tx, act, offers)
    live = matching.activation_offers(a, matching.offer_rules(o))
    counted = {(r.transaction_id, r.offer_id): r.candidate_count for r in matching.candidate_counts(t, live).collect()}
    assert counted == {k: len(v) for k, v in pairs.items()}

    first = {}
    for (i, _), hits in pairs.items():
        for j, h in hits:
            first[j] = min(first.get(j, (h, i)), (h, i))
    full = o.withColumns({"offer_type": F.lit("fixed_cashback"), "reward_multiplier": F.lit(0.1),
                          "max_reward_amount": F.lit(5.0)})
    red = matching.first_redemption(t.withColumn("transaction_status", F.lit("settled")), a, full)
    assert {r.activation_id: r.transaction_id for r in red.collect()} == {j: i for j, (_, i) in first.items()}


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_nested_and_touching_windows(spark, kind):
    # 2 lies inside 1; 3 begins exactly when 1 ends; both ends count; 4 lasts over several slices
    act = [(1, 1, 7, 0, 100), (2, 1, 7, 10, 20), (3, 1, 7, 100, 50), (4, 1, 7, 160, 900)]
    tx = [(i, 1, 5, h, 50) for i, h in enumerate((0, 15, 100, 101, 150, 151, 160, 700, 1060, 1061))]
    t, a, o = frames(spark, tx, act, [(7, 5, 10, 2)], kind)
    got = found(matching.match_redemptions(t, a, o, "r"))
    assert got == brute(tx, act, [(7, 5, 10, 2)])
    assert got[2] == (1, 7) and got[3] == (3, 7) and got[8] == (4, 7) and 5 not in got and 9 not in got


def test_mixed_timestamp_types(spark):
    tx, act, offers = [(1, 1, 5, 3, 50)], [(9, 1, 7, 0, 10)], [(7, 5, 10, 2)]
    t, _, o = frames(spark, tx, act, offers, "timestamp_ntz")
    _, a, _ = frames(spark, tx, act, offers, "timestamp")
    assert found(matching.match_redemptions(t, a, o, "r")) == {1: (9, 7)}


def test_one_hot_card_and_merchant(spark):
    """A card with 20,000 purchases and 20,000 activations: 4e8 pairs if they were built."""
    n = 20_000
    ids = spark.range(n)
    base = F.lit(T0)
    tx = ids.select(
        F.col("id").alias("transaction_id"), F.lit(1).cast("long").alias("tokenized_cardmember_id"),
        F.lit(5).cast("long").alias("merchant_id"),
        (base + F.make_dt_interval(mins=F.col("id"))).alias("transaction_timestamp"),
        F.lit(T0.date()).alias("transaction_date"), F.lit(50.0).alias("transaction_amount"))
    act = ids.select(
        F.col("id").alias("activation_id"), F.lit(1).cast("long").alias("tokenized_cardmember_id"),
        F.lit(7).cast("long").alias("offer_id"),
        (base + F.make_dt_interval(mins=F.col("id"))).alias("activation_timestamp"),
        (base + F.make_dt_interval(mins=F.col("id") + 60)).alias("offer_expiry_timestamp"))
    _, _, offers = frames(spark, [(0, 0, 0, 0, 0)], [(0, 0, 0, 0, 0)], [(7, 5, 10, 2)])
    got = matching.match_redemptions(tx, act, offers, "r")
    # the earliest live activation is the one an hour before, or the very first
    wrong = got.filter(F.col("activation_id") != F.greatest(F.col("transaction_id") - 60, F.lit(0)))
    assert got.count() == n and wrong.count() == 0


def test_literal_range_join(spark):
    tx = [(1, 1, 5, 10, 30), (2, 1, 5, 900, 30), (3, 1, 6, 10, 30), (4, 2, 6, 20, 30)]
    act = [(1, 1, 1, 0, 720), (2, 2, 2, 0, 720)]
    t, a, o = frames(spark, tx, act, [(1, 5, 10, 5), (2, 6, 10, 5)])
    offers = matching.activation_offers(matching.match_ready_activations(a), matching.offer_rules(o))
    for hint in (None, "merge", "broadcast", "shuffle_hash"):
        pairs = matching.candidates(matching.match_ready_transactions(t), offers, hint)
        assert found(pairs) == {1: (1, 1), 4: (2, 2)}


def test_statuses(spark):
    t, a, o = frames(spark, [(1, 1, 5, 3, 50)], [(9, 1, 7, 0, 10)], [(7, 5, 10, 2)])
    assert matching.match_ready_transactions(t.withColumn("transaction_status", F.lit("POSTED"))).count() == 1
    assert matching.match_ready_transactions(t.withColumn("transaction_status", F.lit("approvedX"))).count() == 0
    assert matching.match_ready_activations(a.withColumn("activation_status", F.lit("cancelled"))).count() == 0


def test_ties_and_unknown_policy(spark):
    # same reward and start: the lower offer id wins, then the lower activation id
    act = [(3, 1, 8, 0, 10), (2, 1, 7, 0, 10), (1, 1, 7, 0, 12)]
    t, a, o = frames(spark, [(1, 1, 5, 3, 50)], act, [(7, 5, 10, 2), (8, 5, 10, 2)])
    assert found(matching.match_redemptions(t, a, o, "r")) == {1: (1, 7)}
    with pytest.raises(ValueError, match="unknown reward policy"):
        matching.match_redemptions(t, a, o, "r", policy="double")


def test_unsupported_offer_type_raises(spark):
    t, a, o = frames(spark, [(1, 1, 5, 3, 50)], [(9, 1, 7, 0, 10)], [(7, 5, 10, 2)])
    odd = o.withColumns({"offer_type": F.lit("points"), "reward_multiplier": F.lit(0.1),
                         "max_reward_amount": F.lit(5.0)})
    with pytest.raises(Exception, match="unsupported offer_type"):
        matching.match_redemptions(t, a, odd, "r", policy="capped").collect()


def test_an_open_ended_activation_adds_only_slices_with_purchases(spark):
    tx, act, _ = frames(spark, [(1, 0, 0, 5, 9), (2, 0, 0, 6, 9), (3, 0, 0, 24 * 70, 9), (4, 1, 0, 5, 9)],
                        [(1, 0, 0, 0, 24 * 365 * 5)], [(0, 0, 1, 1)])
    placed = act.withColumn("merchant_id", F.lit(0).cast("long"))
    slices = matching.in_busy_slices(placed, tx, "activation_timestamp", "offer_expiry_timestamp", 7 * 86400)
    assert slices.count() == 2
