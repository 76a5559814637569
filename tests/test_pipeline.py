"""The jobs end to end on a small lake in the full domain schema."""

import pytest
from lakes import write_raw
from pyspark.sql import functions as F

from spendlens.operators import quality
from spendlens.plans import pipeline
from spendlens.sources import contracts as C


@pytest.fixture(scope="module")
def lake(spark, small, tmp_path_factory):
    made = write_raw(spark, str(tmp_path_factory.mktemp("lake")), small)
    pipeline.run_all(made, "run_1")
    return made


def test_every_layer_is_there(lake):
    agreed = pipeline.check_ingest(lake).collect()
    assert len(agreed) == 20 and {r.status for r in agreed} == {"passed"}
    for spec in C.SOURCE_TABLES:
        clean = lake.read("silver", spec.clean_name)
        assert set(C.SILVER_METADATA) <= set(clean.columns)
        assert clean.count() <= lake.read("bronze", spec.name).count()


def test_marts_have_their_contract(lake):
    for table, columns in (
        ("gold_merchant_daily", C.MERCHANT_DAILY_COLUMNS),
        ("gold_offer_daily", C.OFFER_DAILY_COLUMNS),
        ("gold_offer_incrementality", C.INCREMENTALITY_COLUMNS),
        ("gold_incrementality_features", C.FEATURE_COLUMNS),
        ("gold_offer_cannibalization_risk", C.RISK_COLUMNS),
    ):
        mart = lake.read("gold", table)
        assert set(mart.columns) == set(columns)
        assert mart.count() > 0, table


def test_partition_folders(lake, spark):
    import os

    folder = lake.path("gold", "gold_merchant_daily")
    assert any(name.startswith("business_date=") for name in os.listdir(folder))


def test_matches_feed_the_marts(lake):
    matches = lake.read("silver", C.MATCHED_TABLE)
    offers = lake.read("gold", "gold_offer_daily")
    assert matches.count() == offers.agg(F.sum("matched_redemption_count")).first()[0]
    paid = matches.agg(F.sum("calculated_reward_amount")).first()[0]
    days = lake.read("gold", "gold_merchant_daily").agg(F.sum("reward_cost_amount")).first()[0]
    assert paid == pytest.approx(days)


def test_check_results_are_published(lake):
    results = lake.read("gold", "check_results")
    assert results.filter("status = 'failed'").count() == 0
    # 20 tables x (rows, columns, key), 7 relations and 4 money identities on the raw layer
    assert results.count() > 71


def test_running_again_gives_the_same(lake):
    before = lake.read("gold", "gold_offer_incrementality").drop("incrementality_created_at").collect()
    pipeline.incrementality(lake, "run_1")
    after = lake.read("gold", "gold_offer_incrementality").drop("incrementality_created_at").collect()
    assert sorted(map(str, before)) == sorted(map(str, after))


def test_merge_of_unchanged_dimensions_changes_nothing(lake):
    before = lake.read("silver", "dim_offer_scd").select("surrogate_scd_id", "is_current").collect()
    pipeline.version(lake, "run_2", as_of="2026-09-01")
    after = lake.read("silver", "dim_offer_scd").select("surrogate_scd_id", "is_current").collect()
    assert sorted(before) == sorted(after)


def test_orphan_stops_the_release(lake):
    specs = {s.name: lake.read("raw", s.name) for s in C.SOURCE_TABLES}
    broken = dict(specs)
    broken["fact_transactions"] = specs["fact_transactions"].filter("transaction_status <> 'refunded'")
    with pytest.raises(ValueError, match="control_transaction_to_transaction"):
        quality.ensure_passed(quality.check_relations(broken))


def test_summaries_are_published_and_agree_with_their_sources(lake):
    rows = {s.table: lake.read("gold", s.table) for s in pipeline.SUMMARIES}
    assert all(df.count() > 0 for df in rows.values())
    matches = lake.read("silver", C.MATCHED_TABLE)
    assert rows["gold_offer_funnel_daily"].agg(F.sum("redemptions")).first()[0] == matches.count()
    liability = lake.read("silver", "fact_reward_liability_clean").agg(F.sum("reward_amount")).first()[0]
    assert rows["gold_reward_liability_summary"].agg(F.sum("reward_amount")).first()[0] == pytest.approx(liability)
    tied = lake.read("silver", "fact_data_quality_reconciliation_clean").count()
    assert rows["gold_reconciliation_health_daily"].agg(F.sum("transaction_count")).first()[0] == tied
    assert rows["gold_category_performance_summary"].agg(F.sum("transaction_count")).first()[0] == lake.read("silver", "fact_transactions_clean").count()
    assert rows["gold_offer_abuse_risk_summary"].select("risk_rule_name").distinct().count() >= 2
    hidden = rows["gold_privacy_safe_offer_lift"].filter("is_suppressed")
    assert hidden.filter("visible_test_spend IS NOT NULL OR protected_cohort_size IS NOT NULL").count() == 0
    checked = {r.table_name for r in lake.read("gold", "check_results").select("table_name").distinct().collect()}
    assert set(rows) <= checked
