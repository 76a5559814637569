"""What Catalyst makes of the operators: shuffles, pushdown, join kinds, no Python in the path."""

import re

import pytest
from pyspark.sql import functions as F

from spendlens.operators import cleaning, incrementality, marts, matching
from spendlens.plans.bindings import Domain
from spendlens.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.fixture
def domain(spark, small):
    return Domain(spark, small)


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Plans as they are when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(matching, "BROADCAST_LIMIT", -1)
    monkeypatch.setattr(matching.small_side, "__defaults__", (-1,))
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text


def test_scan_reads_only_what_it_needs(domain):
    text = plan(matching.match_ready_activations(domain.act))
    assert "EqualTo(event_type,click)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "value" in schema and "c_name" not in schema
    spend = plan(marts.merchant_daily_spend(domain.tx))
    assert "p_name" not in spend and "s_acctbal" not in spend


def test_dedupe_limits_rows_before_the_shuffle(domain):
    text = plan(cleaning.first_per_key(domain.lineitem, ["l_orderkey", "l_linenumber"]))
    above = text.split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above[0] and "WindowGroupLimit" in above[1]


def test_best_match_limits_rows_before_the_shuffle(domain):
    text = plan(matching.match_redemptions(domain.tx, domain.act, domain.offer, "r"))
    assert text.count("WindowGroupLimit") >= 2


def test_lift_join_reuses_the_aggregation_partitioning(domain, no_broadcast):
    test = incrementality.test_group_spend(domain.test, unique_ids=True)
    control = incrementality.control_group_spend(domain.control, unique_ids=True)
    parts = shuffles(plan(test)) + shuffles(plan(control))
    assert shuffles(plan(incrementality.lift(test, control))) == parts


def test_spend_and_rewards_join_without_shuffle(domain, no_broadcast):
    spend = marts.merchant_daily_spend(domain.tx, unique_ids=True)
    matched = domain.test
    rewards = marts.merchant_daily_rewards(matched, unique_ids=True)
    joined = spend.join(rewards, ["business_date", "merchant_id"], "left")
    assert shuffles(plan(joined)) == shuffles(plan(spend)) + shuffles(plan(rewards))


def test_unique_ids_need_no_row_multiplication(domain):
    assert "Expand" in plan(incrementality.test_group_spend(domain.test))
    assert "Expand" not in plan(incrementality.test_group_spend(domain.test, unique_ids=True))


def test_marts_after_the_lift_are_projections(domain):
    inc = incrementality.incrementality(domain.test, domain.control, domain.cell_offer, domain.merchant)
    assert shuffles(plan(incrementality.features(inc))) == shuffles(plan(inc))


def test_rules_are_broadcast_only_when_small(domain, no_broadcast):
    act, rules = matching.match_ready_activations(domain.act), matching.offer_rules(domain.offer)
    assert "BroadcastHashJoin" not in plan(matching.activation_offers(act, rules))


def test_rules_are_broadcast_when_small(domain):
    act, rules = matching.match_ready_activations(domain.act), matching.offer_rules(domain.offer)
    assert "BroadcastHashJoin" in plan(matching.activation_offers(act, rules))
    assert matching.small_side(rules, limit=1) is rules


def test_top_rows_are_a_distributed_top_k(spark, small):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_risk_rows"](spark, small))


@pytest.mark.parametrize("name", ["test_group_spend", "control_group_spend", "incrementality_enriched", "roas_efficiency", "risk_reasons"])
def test_flagship_multiplies_no_rows(spark, small, name):
    assert "Expand" not in plan(QUERIES[name](spark, small))


def test_two_level_counts_equal_distinct_counts(spark):
    """Repeated ids of all three kinds: transactions with several lines, cards and cells, redemptions on several rows."""
    cells = spark.range(3000).selectExpr(
        "id % 701 AS matched_redemption_id", "id % 97 AS transaction_id", "id % 5 AS offer_id", "id % 2 AS campaign_id", "id % 3 AS merchant_id",
        "id % 11 * (id % 97) AS tokenized_cardmember_id", "date_add(DATE '2024-01-01', CAST(id % 4 AS INT)) AS transaction_date",
        "CAST(id AS DOUBLE) / 8 AS transaction_amount", "1D AS calculated_reward_amount")
    plain, staged = (incrementality.test_group_spend(cells, two_level=two) for two in (False, True))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, staged.select(*plain.columns).collect()))
    assert "Expand" in plan(plain) and "Expand" not in plan(staged)
    control = cells.withColumnRenamed("matched_redemption_id", "control_transaction_id")
    plain, staged = (incrementality.control_group_spend(control, two_level=two) for two in (False, True))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, staged.select(*plain.columns).collect()))
    assert "Expand" in plan(plain) and "Expand" not in plan(staged)
    one = incrementality.test_group_spend(cells, ("matched_redemption_id",), two_level=True)
    assert plan(one).count("row_number") < plan(incrementality.test_group_spend(cells, two_level=True)).count("row_number")


def exchanges_above(text, scan):
    """For each scan of a plan, how often its rows are dealt by a hash on their way up."""
    lines = text.split("\n")
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if scan in line:
            at, dealt = depth[i], 0
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    at = depth[j]
                    dealt += "Exchange hashpartitioning" in lines[j]
            found.append(dealt)
    return found


# F1 to F11
@pytest.mark.parametrize("name", [
    "net_merchant_profit", "profitability_class", "cannibal_flags", "cannibal_score", "risk_level", "roas_efficiency", "profitability_base",
    "incrementality_enriched", "checks_incrementality", "defects_incrementality", "risk_reasons"])
def test_purchases_are_read_once_and_dealt_few_times(spark, small, no_broadcast, name):
    """By order, by product, by cell; then cells by place and by merchant. Three scans, dealt up to eight times, filled the disk."""
    from spendlens.plans import defects  # noqa: F401  registers its queries

    dealt = exchanges_above(plan(QUERIES[name](spark, small)), "FileScan parquet [l_orderkey")
    assert len(dealt) == 1 and dealt[0] <= 5


def test_group_lift_is_the_lift_of_both_groups(spark):
    """Repeated ids in and across cells and groups, missing values, negative and undefined amounts, cells of one group, no day."""
    rows = spark.range(4000).selectExpr(
        "CASE WHEN id % 53 = 0 THEN NULL ELSE id % 7 END AS line_id", "CASE WHEN id % 59 = 1 THEN NULL ELSE id % 97 END AS transaction_id",
        "CASE WHEN id % 61 = 2 THEN NULL ELSE id % 7 * (id % 97) END AS tokenized_cardmember_id",
        "CASE WHEN id % 67 = 3 THEN NULL ELSE id % 5 END AS offer_id", "CASE WHEN id % 71 = 4 THEN NULL ELSE CAST(id % 2 AS STRING) END AS campaign_id",
        "CASE WHEN id % 73 = 5 THEN NULL ELSE id % 3 END AS merchant_id",
        "CASE WHEN id % 79 = 6 THEN NULL ELSE date_add(DATE '2024-01-01', CAST(id % 11 AS INT)) END AS transaction_date",
        "CASE WHEN id % 83 = 7 THEN -1D WHEN id % 89 = 8 THEN NULL WHEN id = 77 THEN double('NaN') ELSE CAST(id AS DOUBLE) / 8 END AS transaction_amount",
        "CASE WHEN id % 43 = 9 THEN -1D WHEN id % 47 = 10 THEN NULL ELSE CAST(id % 30 AS DOUBLE) END AS calculated_reward_amount",
        "CASE WHEN id % 11 < 2 AND id % 5 = 4 THEN 'test' WHEN hash(id) % 10 > 3 THEN 'test' WHEN hash(id) % 10 > -4 THEN 'control' "
        "WHEN hash(id) % 10 > -8 THEN 'holdout' END AS assignment_group")
    test = rows.filter("assignment_group = 'test'").withColumnRenamed("line_id", "matched_redemption_id")
    control = rows.filter("assignment_group = 'control'").withColumnRenamed("line_id", "control_transaction_id")
    plain = incrementality.lift(incrementality.test_group_spend(test), incrementality.control_group_spend(control))
    terms = rows.groupBy("offer_id", "campaign_id", "merchant_id").agg(
        F.min("transaction_amount").alias("__minimum_spend"), F.max("calculated_reward_amount").alias("__reward"))
    wanted = plain.join(terms, ["offer_id", "campaign_id", "merchant_id"], "left").select(*plain.columns, *terms.columns[3:])
    got = incrementality.group_lift(rows, "line_id").select(*wanted.columns)
    assert [f.dataType for f in got.schema] == [f.dataType for f in wanted.schema]
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    cells = incrementality.test_group_spend(test).count()
    assert 0 < got.count() < cells and got.filter("test_redemption_count < test_transaction_count").count() > 0
    assert got.filter("test_cardmember_count < test_transaction_count").count() > 0
