"""Queries over tables with planted defects: every rule of a validator finds some, and the SQL must count the same.

A plant changes one column on some rows; the same text does it in Spark (`withColumns`) and in the SQL (`REPLACE`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import finance, quality
from ..sources.contracts import RELATIONS
from .checksql import checks
from .queries import (
    CELL_SQL, DETECTED, MERCHANT_SCD, detected_hits, incremental, liability, merchant_history, query, recon, redeemed, settled,
)


def plant(df: DataFrame, defects: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in defects.items()})


def planted(source: str, defects: dict[str, str]) -> str:
    return f"(SELECT * REPLACE ({', '.join(f'{sql} AS {name}' for name, sql in defects.items())}) FROM {source})"


def where(row: str, then: str, column: str) -> str:
    return f"CASE WHEN {row} THEN {then} ELSE {column} END"


def off(value: str, formula: str, tolerance: str) -> str:
    return f"coalesce(abs({value} - ({formula})) > {tolerance}, true)"


# ------------------------------------------------------------------------------------- lift


def cell(n: int, then: str, column: str) -> str:
    return where(f"offer_id % 11 = {n}", then, column)


LIFT_DEFECTS = {
    "business_date": cell(1, "NULL", "business_date"),
    "test_transaction_count": cell(2, "test_transaction_count - 1000000", "test_transaction_count"),
    "minimum_spend_amount": cell(3, "minimum_spend_amount - 1000000", "minimum_spend_amount"),
    "test_to_control_spend_ratio": cell(4, "test_to_control_spend_ratio - 1000000", "test_to_control_spend_ratio"),
    "lift_direction": cell(5, "'sideways'", "lift_direction"),
    "average_test_spend_per_cardmember": cell(6, "average_test_spend_per_cardmember + 1", "average_test_spend_per_cardmember"),
    "incremental_revenue_amount": cell(7, "incremental_revenue_amount + 5", "incremental_revenue_amount"),
    "lift_percentage": cell(8, "lift_percentage + 2", "lift_percentage"),
    "estimated_incremental_value_after_reward": cell(
        9, "estimated_incremental_value_after_reward - 1", "estimated_incremental_value_after_reward"),
}


@query(checks("gold_offer_incrementality", planted("{inc}", LIFT_DEFECTS), CELL_SQL, [
    ("null_required", "critical", "business_date IS NULL"),
    ("invalid_count", "high", "test_transaction_count < 0"),
    ("negative_amount", "high", "minimum_spend_amount < 0 OR average_test_spend_per_cardmember < 0"),
    ("invalid_rate", "high", "test_to_control_spend_ratio < 0"),
    ("invalid_direction", "high", "lift_direction NOT IN ('positive_lift', 'negative_lift', 'no_lift')"),
    ("lift_formula", "high", off("lift_per_cardmember", "average_test_spend_per_cardmember - average_control_spend_per_cardmember", "0.01")),
    ("revenue_formula", "high", off("incremental_revenue_amount", "lift_per_cardmember * test_cardmember_count", "0.01")),
    ("lift_percentage_formula", "high", off("lift_percentage", "CASE WHEN average_control_spend_per_cardmember > 0 THEN "
                                            "lift_per_cardmember / average_control_spend_per_cardmember ELSE 0.0 END", "0.0001")),
    ("value_formula", "high", " OR ".join([
        off("estimated_incremental_margin_amount", "incremental_revenue_amount * merchant_margin_rate", "0.01"),
        off("estimated_incremental_platform_fee_amount", "incremental_revenue_amount * platform_fee_rate", "0.01"),
        off("estimated_incremental_value_after_reward", "estimated_incremental_margin_amount - total_test_reward_amount "
            "- estimated_incremental_platform_fee_amount", "0.01")])),
]))
def defects_incrementality(d):
    return quality.check_incrementality(plant(incremental(d), LIFT_DEFECTS))


# ----------------------------------------------------------------------------------- versions


def merchant(n: int, then: str, column: str) -> str:
    return where(f"merchant_id % 7 = {n}", then, column)


VERSION_DEFECTS = {
    "is_current": merchant(1, "NULL", "is_current"),
    "effective_end_date": where("merchant_id % 7 = 2", "DATE '1990-01-01'", merchant(3, "DATE '2030-01-01'", "effective_end_date")),
    "surrogate_scd_id": merchant(4, "'same'", "surrogate_scd_id"),
}
VERSIONS = planted("{scd_state}", VERSION_DEFECTS)


@query(f"""SELECT 'dim_merchant_scd' AS table_name, check_name, failure_count, severity,
       CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM (
       SELECT 'null_required' AS check_name, count(*) AS failure_count, 'critical' AS severity FROM {VERSIONS}
         WHERE surrogate_scd_id IS NULL OR merchant_id IS NULL OR is_current IS NULL
       UNION ALL SELECT 'end_before_start', count(*), 'high' FROM {VERSIONS} WHERE effective_end_date < effective_start_date
       UNION ALL SELECT 'current_with_end_date', count(*), 'high' FROM {VERSIONS} WHERE is_current AND effective_end_date IS NOT NULL
       UNION ALL SELECT 'not_exactly_one_current', count(*), 'critical' FROM (SELECT 1 FROM {VERSIONS}
         GROUP BY merchant_id HAVING count(*) FILTER (is_current) <> 1)
       UNION ALL SELECT 'duplicate_surrogate', count(*), 'critical' FROM (SELECT 1 FROM {VERSIONS}
         GROUP BY surrogate_scd_id HAVING count(*) > 1))""")
def defects_scd(d):
    return quality.check_scd(plant(merchant_history(d), VERSION_DEFECTS), MERCHANT_SCD)


# ------------------------------------------------------------------------------------- money

LIABILITY_DEFECTS = {"merchant_funded_amount": merchant(1, "merchant_funded_amount + 0.5", "merchant_funded_amount")}
SETTLED_DEFECTS = {
    "merchant_settlement_amount": merchant(2, "merchant_settlement_amount - 1", "merchant_settlement_amount"),
    "merchant_net_after_reward": merchant(3, "merchant_net_after_reward + 0.02", "merchant_net_after_reward"),
}
RECON_DEFECTS = {"settlement_delta": merchant(4, "settlement_delta + 0.011", "settlement_delta")}


@query(f"""SELECT table_name, check_name, failure_count, 'high' AS severity,
       CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM (
       SELECT 'fact_reward_liability' AS table_name, 'reward_funding_split' AS check_name, (SELECT count(*) FROM
         {planted('{liability}', LIABILITY_DEFECTS)} WHERE abs(merchant_funded_amount + platform_funded_amount - reward_amount) > 0.0101) AS failure_count
       UNION ALL SELECT 'fact_merchant_settlements', 'merchant_settlement_amount_formula', (SELECT count(*) FROM
         {planted('{settled}', SETTLED_DEFECTS)} WHERE abs(gross_transaction_amount - platform_fee_amount - merchant_settlement_amount) > 0.0101)
       UNION ALL SELECT 'fact_merchant_settlements', 'merchant_net_after_reward_formula', (SELECT count(*) FROM
         {planted('{settled}', SETTLED_DEFECTS)} WHERE abs(merchant_settlement_amount - merchant_funded_amount - merchant_net_after_reward) > 0.0101)
       UNION ALL SELECT 'fact_data_quality_reconciliation', 'reconciliation_delta_formula', (SELECT count(*) FROM
         {planted('{recon}', RECON_DEFECTS)} WHERE abs(transaction_amount - merchant_settlement_amount - platform_fee_amount - settlement_delta) > 0.0101))""")
def defects_money(d):
    return quality.check_money({
        "fact_reward_liability": plant(liability(d), LIABILITY_DEFECTS), "fact_merchant_settlements": plant(settled(d), SETTLED_DEFECTS),
        "fact_data_quality_reconciliation": plant(recon(d), RECON_DEFECTS)})


#: Settlements that are off by 0, 0.01 (within the tolerance), 0.02 and -3.
UNTIED = {"merchant_settlement_amount": "CAST(merchant_settlement_amount AS DECIMAL(18,2)) + CASE merchant_id % 4 WHEN 1 THEN 0.01 "
                                        "WHEN 2 THEN 0.02 WHEN 3 THEN -3.00 ELSE 0.00 END"}


@query(f"""SELECT t.transaction_id, CAST(delta AS DOUBLE) AS settlement_delta,
       CASE WHEN delta IS NOT NULL AND abs(delta) <= 0.01 THEN 'matched' ELSE 'mismatched' END AS reconciliation_status,
       CASE WHEN s.transaction_id IS NULL THEN 'Missing merchant settlement record'
            WHEN abs(delta) <= 0.01 THEN 'Transaction amount ties to settlement and platform fee'
            ELSE '{finance.OFF_TOLERANCE}' END AS reconciliation_reason
       FROM (SELECT t.*, s.transaction_id AS found, CAST(t.transaction_amount AS DECIMAL(18,2)) - s.merchant_settlement_amount
             - CAST(s.platform_fee_amount AS DECIMAL(18,2)) AS delta FROM {{tx}} t LEFT JOIN {planted('{settled}', UNTIED)} s USING (transaction_id)) t
       LEFT JOIN {{settled}} s ON t.transaction_id = s.transaction_id WHERE s.transaction_id IS NOT NULL""")
def defects_reconciliation(d):
    """Both sides of the tolerance."""
    untied = plant(settled(d), {k: f"CAST({v} AS DOUBLE)" for k, v in UNTIED.items()})
    out = finance.reconciliation(d.tx, untied).select("transaction_id", "settlement_delta", "reconciliation_status", "reconciliation_reason")
    return out.join(untied.select("transaction_id"), "transaction_id", "left_semi")


# --------------------------------------------------------------------------------- relations

#: Parents that lack some rows: purchases of every fifth day, redemptions of every third merchant.
KEPT_TX, KEPT_REDEEMED = "day(transaction_date) % 5 <> 0", "merchant_id % 3 <> 0"


def orphans(child: str, relation: str, column: str, rows: str, parent: str) -> str:
    return (f"SELECT '{child}' AS table_name, '{relation}' AS check_name, (SELECT count(DISTINCT {column}) FROM {rows} "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent})) AS failure_count")


TX, REDEEMED = f"(SELECT * FROM {{tx}} WHERE {KEPT_TX})", f"(SELECT * FROM {{redeemed}} WHERE {KEPT_REDEEMED})"


@query("SELECT *, 'critical' AS severity, CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM (" + " UNION ALL ".join([
    orphans("fact_offer_redemptions", "redemption_to_transaction", "transaction_id", REDEEMED, TX),
    orphans("fact_control_group_transactions", "control_transaction_to_transaction", "transaction_id", "{control_event}", TX),
    orphans("fact_reward_liability", "reward_liability_to_redemption", "redemption_id", "{liability}", REDEEMED),
    orphans("fact_reward_liability", "reward_liability_to_transaction", "transaction_id", "{liability}", TX),
    orphans("fact_merchant_settlements", "settlement_to_transaction", "transaction_id", "{settled}", TX),
    orphans("fact_fraud_risk_events", "fraud_event_to_transaction", "transaction_id", f"({DETECTED})", TX),
    orphans("fact_data_quality_reconciliation", "reconciliation_to_transaction", "transaction_id", "{recon}", TX),
]) + ")")
def defects_relations(d):
    """All seven relations, each with orphans; risk events come from detection."""
    return quality.check_relations({
        "fact_transactions": d.tx.filter(KEPT_TX), "fact_offer_redemptions": redeemed(d).filter(KEPT_REDEEMED),
        "fact_control_group_transactions": d.control_event, "fact_reward_liability": liability(d), "fact_merchant_settlements": settled(d),
        "fact_fraud_risk_events": detected_hits(d), "fact_data_quality_reconciliation": recon(d),
    }, RELATIONS)
