"""The one-to-one assignment of control cards against a plain greedy pass over all pairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spendlens.operators import assignment

SCHEMA = "id long, segment string, place long, spend double, months double, visits double"
TOLERANCES = {"spend": 100.0, "months": 12.0, "visits": 4.0}


def greedy(test, control, threshold=0.75):
    """Closest pair first, then the first test card, then the first control card (by key % 64, then key)."""
    count = 2 + len(TOLERANCES)
    pairs = []
    for t in test:
        for c in control:
            if None in t or None in c or t[1] != c[1] or any(x != x or abs(x) == float("inf") for x in (*t[3:], *c[3:])):
                continue
            distance = 0.0
            for x, y, w in zip(t[3:], c[3:], TOLERANCES.values()):
                distance = distance + abs(x - y) / w
            distance = distance + (0.0 if t[2] == c[2] else 1.0)
            if 1 - distance / count >= threshold:
                pairs.append((distance, t[0] % 64, t[0], c[0] % 64, c[0]))
    used_t, used_c, out = set(), set(), {}
    for distance, _, t, _, c in sorted(pairs):
        if t not in used_t and c not in used_c:
            used_t.add(t)
            used_c.add(c)
            out[t] = (c, distance)
    return out


def made(n, start, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(start, start + n):
        if i % 3 == 0:  # a third of all cards are equal
            rows.append((i, "A", 1, 50.0, 10.0, 2.0))
        elif i % 3 == 1:  # a dense cloud
            rows.append((i, "A", 1, 200 + draw.random() / 50, 30.0, 3.0))
        else:
            rows.append((i, draw.choice("AB"), draw.randrange(3), draw.uniform(0, 900), float(draw.randrange(90)), float(draw.randrange(9))))
    return rows


def assigned(spark, test, control, **options):
    got = assignment.assign_controls(
        spark.createDataFrame(test, SCHEMA), spark.createDataFrame(control, SCHEMA), ["segment"], ["place"], TOLERANCES, "id", **options).collect()
    assert len({r.test_id for r in got}) == len({r.control_id for r in got}) == len(got)
    assert all(r.match_quality_score == 1 - r.distance / 5 for r in got)
    return {r.test_id: (r.control_id, r.distance) for r in got}


@pytest.mark.parametrize("pairs_per_card", [1, 64])
def test_equals_greedy_over_all_pairs(spark, monkeypatch, pairs_per_card):
    """Few pairs a card force many small radii; the result stays the same."""
    monkeypatch.setattr(assignment, "PAIRS_PER_CARD", pairs_per_card)
    test, control = made(110, 0, 1), made(90, 1000, 2)
    expected = greedy(test, control)
    assert len(expected) > 60
    assert assigned(spark, test, control) == expected


def test_odd_cards(spark):
    nan, big = float("nan"), float("inf")
    test = [(1, "A", 1, 5.0, 1.0, 1.0), (2, "A", 1, nan, 1.0, 1.0), (3, None, 1, 5.0, 1.0, 1.0), (4, "A", 1, big, 1.0, 1.0), (5, "A", 1, None, 1.0, 1.0), (6, "A", 2, 5.0, 1.0, 1.0)]
    control = [(10, "A", 1, 5.0, 1.0, 1.0), (11, "A", 1, 5.0, 1.0, 1.0), (12, "A", 1, nan, 1.0, 1.0), (13, None, 1, 5.0, 1.0, 1.0), (14, "B", 1, 5.0, 1.0, 1.0)]
    assert assigned(spark, test, control) == greedy(test, control) == {1: (10, 0.0), 6: (11, 1.0)}
    far = [(i, "A", 1, 1e300 * (i % 4), 1.0, 1.0) for i in range(8)], [(20 + i, "A", 1, 1e300 * (i % 4), 1.0, 1.0) for i in range(8)]
    assert assigned(spark, *far) == greedy(*far) and len(greedy(*far)) == 8
    assert assigned(spark, test, []) == {} and assigned(spark, [], control) == {}
    assert assigned(spark, test, control, threshold=1.0) == {1: (10, 0.0)}


def test_history_window(spark):
    day = dt.date(2024, 4, 1)
    bought = [
        (1, "a", 7, 70, dt.date(2024, 3, 31), 10.0), (1, "a", 7, 70, dt.date(2024, 3, 31), 20.0), (1, "b", 8, 70, dt.date(2024, 1, 2), 30.0),
        (1, "c", 9, 71, dt.date(2024, 1, 1), 1000.0), (1, "d", 9, 71, day, 1000.0), (2, "e", 9, 71, dt.date(2022, 12, 30), 5.0), (None, "f", 1, 1, day, 1.0)]
    purchases = spark.createDataFrame(
        bought, "tokenized_cardmember_id long, transaction_id string, merchant_id long, category_id long, transaction_date date, transaction_amount double")
    cards = spark.createDataFrame([(1,), (2,), (3,)], "tokenized_cardmember_id long")
    got = {r.tokenized_cardmember_id: r for r in assignment.history_features(purchases, cards, day).collect()}
    one = got[1]
    assert (one.historical_spend_90d, one.historical_transaction_count_90d, one.average_ticket_size) == (60.0, 2, 30.0)
    assert (one.merchant_affinity_score, one.category_affinity_score, one.customer_tenure_months) == (2 / 3, 1.0, 3)
    assert (got[2].historical_spend_90d, got[2].merchant_affinity_score, got[2].customer_tenure_months) == (0.0, 0.0, 16)
    assert (got[3].historical_transaction_count_90d, got[3].customer_tenure_months) == (0, 0)
    longer = assignment.history_features(purchases, cards, day, days=91).filter("tokenized_cardmember_id = 1").first()
    assert (longer.historical_spend_90d, longer.merchant_affinity_score, longer.category_affinity_score) == (1060.0, 0.5, 0.75)
    month = assignment.history_features(purchases, cards, day, days=31).filter("tokenized_cardmember_id = 1").first()
    assert month.historical_spend_90d == 30.0


def test_no_pair_list_of_equal_cards(spark):
    """Many equal cards meet by position: as many rows as pairs, not their square."""
    cards = spark.range(4000).select(F.col("id"), F.lit("A").alias("segment"), F.lit(1).cast("long").alias("place"), *(
        F.lit(1.0).alias(f) for f in TOLERANCES))
    got = assignment.assign_controls(cards, cards.withColumn("id", F.col("id") + 10_000), ["segment"], ["place"], TOLERANCES, "id")
    assert got.count() == 4000
