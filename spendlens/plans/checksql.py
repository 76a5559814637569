"""SQL side of the query catalogue: intermediate results written independently of the operators."""

from __future__ import annotations


def msum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def mavg(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE) / count({x})"


def pos(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN {n} / {d} ELSE 0.0 END"


def nz(n: str, d: str) -> str:
    return f"CASE WHEN {d} <> 0 THEN {n} / {d} ELSE 0.0 END"


def hashed(prefix: str, *cols: str) -> str:
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"'{prefix}' || sha256(concat_ws('||', {parts}))"


def image(null: str, *cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{null}')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def checks(table: str, source: str, grain: str, rules: list[tuple[str, str, str]]) -> str:
    """UNION ALL of one counting query per rule (name, severity, failing predicate)."""
    parts = [
        f"SELECT '{table}' AS table_name, 'duplicate_grain' AS check_name, count(*) AS failure_count, "
        f"'critical' AS severity FROM (SELECT 1 FROM {source} GROUP BY {grain} HAVING count(*) > 1)"
    ] if grain else []
    parts += [
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, count(*) AS failure_count, "
        f"'{severity}' AS severity FROM {source} WHERE {bad}"
        for name, severity, bad in rules
    ]
    return (
        "SELECT *, CASE WHEN failure_count = 0 THEN 'passed' ELSE 'failed' END AS status FROM ("
        + " UNION ALL ".join(parts) + ")"
    )


CELL = "business_date, offer_id, campaign_id, merchant_id"

STEPS = {
    # ------------------------------------------------------------------ matching
    "ready_tx": """
        SELECT transaction_id, tokenized_cardmember_id, merchant_id, transaction_timestamp, transaction_date,
               transaction_amount, transaction_status FROM {tx}
        WHERE transaction_id IS NOT NULL AND tokenized_cardmember_id IS NOT NULL AND merchant_id IS NOT NULL
          AND transaction_timestamp IS NOT NULL AND transaction_date IS NOT NULL AND transaction_amount >= 0
          AND lower(transaction_status) IN ('approved', 'posted', 'settled')""",
    "ready_act": """
        SELECT activation_id, tokenized_cardmember_id, offer_id, activation_timestamp, offer_expiry_timestamp,
               activation_status FROM {act}
        WHERE activation_id IS NOT NULL AND tokenized_cardmember_id IS NOT NULL AND offer_id IS NOT NULL
          AND offer_expiry_timestamp >= activation_timestamp
          AND lower(activation_status) IN ('active', 'activated', 'eligible')""",
    "rules": """
        SELECT offer_id, campaign_id, merchant_id, minimum_spend_amount, reward_amount, offer_type,
               reward_multiplier, max_reward_amount FROM {offer}
        WHERE minimum_spend_amount >= 0 AND reward_amount >= 0
        QUALIFY row_number() OVER (PARTITION BY offer_id ORDER BY campaign_id, merchant_id) = 1""",
    "act_offer": """
        SELECT a.activation_id, a.tokenized_cardmember_id, a.offer_id, r.campaign_id, r.merchant_id,
               a.activation_timestamp, a.offer_expiry_timestamp, r.minimum_spend_amount, r.reward_amount,
               r.offer_type, r.reward_multiplier, r.max_reward_amount
        FROM {ready_act} a JOIN {rules} r USING (offer_id)""",
    "pairs": """
        SELECT t.transaction_id, t.tokenized_cardmember_id, t.merchant_id, t.transaction_timestamp,
               t.transaction_date, t.transaction_amount, a.activation_id, a.offer_id, a.campaign_id,
               a.activation_timestamp, a.offer_expiry_timestamp, a.minimum_spend_amount, a.reward_amount,
               a.offer_type, a.reward_multiplier, a.max_reward_amount
        FROM {ready_tx} t JOIN {act_offer} a
          ON t.tokenized_cardmember_id = a.tokenized_cardmember_id AND t.merchant_id = a.merchant_id
         AND t.transaction_timestamp BETWEEN a.activation_timestamp AND a.offer_expiry_timestamp
         AND t.transaction_amount >= a.minimum_spend_amount""",
    "matched": f"""
        SELECT {hashed('mred_', 'transaction_id', 'activation_id', 'offer_id')} AS matched_redemption_id,
               transaction_id, activation_id, offer_id, campaign_id, merchant_id, tokenized_cardmember_id,
               transaction_timestamp, transaction_date, transaction_amount, activation_timestamp,
               offer_expiry_timestamp, minimum_spend_amount, reward_amount,
               reward_amount AS calculated_reward_amount
        FROM {{pairs}}
        QUALIFY row_number() OVER (PARTITION BY transaction_id
                ORDER BY reward_amount DESC, activation_timestamp, offer_id, activation_id) = 1""",
    "capped_pairs": """
        SELECT *, CASE offer_type WHEN 'fixed_cashback'
                  THEN CAST(round(CAST(reward_amount AS DECIMAL(18,2)), 2) AS DOUBLE)
                  ELSE CAST(round(least(CAST(transaction_amount AS DECIMAL(18,2)) *
                            CAST(reward_multiplier AS DECIMAL(9,4)), CAST(max_reward_amount AS DECIMAL(18,2))), 2)
                            AS DOUBLE) END AS calculated_reward_amount
        FROM {pairs}""",
    # ------------------------------------------------------------------ redemption to reconciliation
    "redeemed": """
        SELECT 'red_' || CAST(activation_id AS VARCHAR) AS redemption_id, transaction_id, activation_id,
               tokenized_cardmember_id, offer_id, campaign_id, merchant_id,
               transaction_timestamp AS redemption_timestamp, transaction_date AS redemption_date,
               transaction_amount,
               CASE offer_type WHEN 'fixed_cashback' THEN CAST(CAST(reward_amount AS DECIMAL(18,2)) AS DOUBLE)
                    ELSE CAST(round(least(CAST(transaction_amount AS DECIMAL(18,2)) *
                         CAST(reward_multiplier AS DECIMAL(9,4)), CAST(max_reward_amount AS DECIMAL(18,2))), 2)
                         AS DOUBLE) END AS calculated_reward_amount,
               'qualified' AS redemption_status
        FROM (SELECT t.transaction_id, t.tokenized_cardmember_id, t.merchant_id, t.transaction_timestamp,
                     t.transaction_date, t.transaction_amount, a.activation_id, o.offer_id, o.campaign_id,
                     o.reward_amount, o.offer_type, o.reward_multiplier, o.max_reward_amount
              FROM {tx} t JOIN {act} a ON t.tokenized_cardmember_id = a.tokenized_cardmember_id
                JOIN {offer} o ON a.offer_id = o.offer_id AND t.merchant_id = o.merchant_id
              WHERE t.transaction_status = 'settled' AND t.transaction_amount >= o.minimum_spend_amount
                AND t.transaction_timestamp BETWEEN a.activation_timestamp AND a.offer_expiry_timestamp
              QUALIFY row_number() OVER (PARTITION BY a.activation_id
                      ORDER BY t.transaction_timestamp, t.transaction_id) = 1)""",
    "liability": f"""
        SELECT {hashed('rew_', 'redemption_id')} AS reward_liability_id, redemption_id, transaction_id,
               activation_id, tokenized_cardmember_id, offer_id, campaign_id, merchant_id,
               redemption_date AS liability_date, redemption_timestamp AS liability_timestamp,
               calculated_reward_amount AS reward_amount, owner AS liability_owner,
               CASE owner WHEN 'merchant' THEN calculated_reward_amount WHEN 'platform' THEN 0.0
                    ELSE CAST(round(CAST(calculated_reward_amount AS DECIMAL(18,2)) * 0.75, 2) AS DOUBLE) END
                 AS merchant_funded_amount,
               CASE owner WHEN 'merchant' THEN 0.0 WHEN 'platform' THEN calculated_reward_amount
                    ELSE CAST(CAST(calculated_reward_amount AS DECIMAL(18,2)) -
                         round(CAST(calculated_reward_amount AS DECIMAL(18,2)) * 0.75, 2) AS DOUBLE) END
                 AS platform_funded_amount,
               'accrued' AS liability_status
        FROM (SELECT *, CASE merchant_id % 3 WHEN 0 THEN 'merchant' WHEN 1 THEN 'platform' ELSE 'shared' END AS owner
              FROM {{redeemed}})""",
    "settled": f"""
        SELECT {hashed('settle_', 'transaction_id')} AS settlement_id, transaction_id, redemption_id,
               reward_liability_id, merchant_id, settlement_date, gross_transaction_amount, platform_fee_rate,
               fee AS platform_fee_amount, reward_amount, liability_owner, merchant_funded_amount,
               platform_funded_amount,
               CAST(CAST(gross_transaction_amount AS DECIMAL(18,2)) - CAST(fee AS DECIMAL(18,2)) AS DOUBLE)
                 AS merchant_settlement_amount,
               CAST(CAST(gross_transaction_amount AS DECIMAL(18,2)) - CAST(fee AS DECIMAL(18,2))
                    - CAST(merchant_funded_amount AS DECIMAL(18,2)) AS DOUBLE) AS merchant_net_after_reward,
               'pending' AS settlement_status
        FROM (SELECT t.transaction_id, l.redemption_id, l.reward_liability_id, t.merchant_id,
                     t.transaction_date AS settlement_date, t.transaction_amount AS gross_transaction_amount,
                     m.platform_fee_rate,
                     CAST(round(CAST(t.transaction_amount AS DECIMAL(18,2)) *
                          CAST(m.platform_fee_rate AS DECIMAL(9,4)), 2) AS DOUBLE) AS fee,
                     coalesce(l.reward_amount, 0.0) AS reward_amount,
                     coalesce(l.liability_owner, 'none') AS liability_owner,
                     coalesce(l.merchant_funded_amount, 0.0) AS merchant_funded_amount,
                     coalesce(l.platform_funded_amount, 0.0) AS platform_funded_amount
              FROM {{tx}} t JOIN {{merchant}} m ON t.merchant_id = m.merchant_id
              LEFT JOIN (SELECT * FROM {{liability}} QUALIFY row_number() OVER (PARTITION BY transaction_id
                         ORDER BY liability_timestamp DESC, reward_liability_id DESC) = 1) l
                ON t.transaction_id = l.transaction_id
              WHERE t.transaction_status = 'settled')""",
    "recon": f"""
        SELECT {hashed('recon_', 't.transaction_id')} AS reconciliation_id, t.transaction_id, t.merchant_id,
               t.transaction_date AS reconciliation_date, t.transaction_amount,
               coalesce(s.merchant_settlement_amount, 0.0) AS merchant_settlement_amount,
               coalesce(s.platform_fee_amount, 0.0) AS platform_fee_amount,
               coalesce(s.reward_amount, 0.0) AS reward_amount,
               coalesce(s.merchant_funded_amount, 0.0) AS merchant_funded_amount,
               coalesce(s.platform_funded_amount, 0.0) AS platform_funded_amount,
               CAST(CAST(t.transaction_amount AS DECIMAL(18,2))
                    - coalesce(CAST(s.merchant_settlement_amount AS DECIMAL(18,2)), 0)
                    - coalesce(CAST(s.platform_fee_amount AS DECIMAL(18,2)), 0) AS DOUBLE) AS settlement_delta,
               CASE WHEN s.transaction_id IS NULL THEN 'mismatched' ELSE 'matched' END AS reconciliation_status,
               CASE WHEN s.transaction_id IS NULL THEN 'Missing merchant settlement record'
                    ELSE 'Transaction amount ties to settlement and platform fee' END AS reconciliation_reason
        FROM {{tx}} t LEFT JOIN {{settled}} s ON t.transaction_id = s.transaction_id""",
    # ------------------------------------------------------------------ daily marts
    "spend": f"""
        SELECT transaction_date AS business_date, merchant_id, count(DISTINCT transaction_id) AS transaction_count,
               {msum('transaction_amount')} AS gross_spend_amount,
               {mavg('transaction_amount')} AS average_transaction_amount
        FROM {{tx}} WHERE transaction_amount >= 0 GROUP BY ALL""",
    "rewards": f"""
        SELECT transaction_date AS business_date, merchant_id,
               count(DISTINCT matched_redemption_id) AS matched_redemption_count,
               count(DISTINCT transaction_id) AS redeemed_transaction_count,
               {msum('calculated_reward_amount')} AS reward_cost_amount,
               {mavg('calculated_reward_amount')} AS average_reward_amount
        FROM {{matched}} GROUP BY ALL""",
    "merchant_daily": """
        SELECT business_date, merchant_id, transaction_count, gross_spend_amount, average_transaction_amount,
               matched_redemption_count, redeemed_transaction_count,
               CASE WHEN transaction_count > 0 THEN redeemed_transaction_count / transaction_count ELSE 0.0 END
                 AS redemption_rate,
               reward_cost_amount, average_reward_amount, merchant_margin_rate, platform_fee_rate,
               gross_spend_amount * platform_fee_rate AS platform_fee_amount,
               gross_spend_amount * merchant_margin_rate AS estimated_merchant_margin_amount,
               gross_spend_amount * merchant_margin_rate - gross_spend_amount * platform_fee_rate
                 - reward_cost_amount AS merchant_net_after_reward
        FROM (SELECT s.business_date, s.merchant_id, s.transaction_count, s.gross_spend_amount,
                     s.average_transaction_amount, coalesce(r.matched_redemption_count, 0) AS matched_redemption_count,
                     coalesce(r.redeemed_transaction_count, 0) AS redeemed_transaction_count,
                     coalesce(r.reward_cost_amount, 0.0) AS reward_cost_amount,
                     coalesce(r.average_reward_amount, 0.0) AS average_reward_amount,
                     coalesce(m.merchant_margin_rate, 0.0) AS merchant_margin_rate,
                     coalesce(m.platform_fee_rate, 0.0) AS platform_fee_rate
              FROM {spend} s LEFT JOIN {rewards} r USING (business_date, merchant_id)
                   LEFT JOIN {merchant} m ON s.merchant_id = m.merchant_id)""",
    "offer_daily": f"""
        SELECT b.business_date, b.offer_id, b.campaign_id, b.merchant_id, c.campaign_name, c.campaign_start_date,
               c.campaign_end_date, o.minimum_spend_amount, o.reward_amount, b.matched_redemption_count,
               b.redeemed_transaction_count, b.gross_redeemed_spend_amount, b.reward_cost_amount,
               b.average_redeemed_transaction_amount, b.average_reward_amount,
               {pos('b.reward_cost_amount', 'b.gross_redeemed_spend_amount')} AS reward_to_redeemed_spend_ratio
        FROM (SELECT transaction_date AS business_date, offer_id, campaign_id, merchant_id,
                     count(DISTINCT matched_redemption_id) AS matched_redemption_count,
                     count(DISTINCT transaction_id) AS redeemed_transaction_count,
                     {msum('transaction_amount')} AS gross_redeemed_spend_amount,
                     {msum('calculated_reward_amount')} AS reward_cost_amount,
                     {mavg('transaction_amount')} AS average_redeemed_transaction_amount,
                     {mavg('calculated_reward_amount')} AS average_reward_amount
              FROM {{matched}} GROUP BY ALL) b
        LEFT JOIN {{offer}} o ON b.offer_id = o.offer_id AND b.campaign_id = o.campaign_id
              AND b.merchant_id = o.merchant_id
        LEFT JOIN {{campaign}} c ON b.campaign_id = c.campaign_id""",
    # ------------------------------------------------------------------ incrementality chain
    "test_cells": f"""
        SELECT *, {pos('total_test_spend_amount', 'test_cardmember_count')} AS average_test_spend_per_cardmember,
               {pos('total_test_reward_amount', 'test_redemption_count')} AS average_test_reward_per_redemption
        FROM (SELECT transaction_date AS business_date, offer_id, campaign_id, merchant_id,
                     count(DISTINCT tokenized_cardmember_id) AS test_cardmember_count,
                     count(DISTINCT transaction_id) AS test_transaction_count,
                     count(DISTINCT matched_redemption_id) AS test_redemption_count,
                     {msum('transaction_amount')} AS total_test_spend_amount,
                     {msum('calculated_reward_amount')} AS total_test_reward_amount
              FROM {{test}} WHERE transaction_amount >= 0 AND calculated_reward_amount >= 0 GROUP BY ALL)""",
    "control_cells": f"""
        SELECT *, {pos('total_control_spend_amount', 'control_cardmember_count')} AS average_control_spend_per_cardmember
        FROM (SELECT transaction_date AS business_date, offer_id, campaign_id, merchant_id,
                     count(DISTINCT tokenized_cardmember_id) AS control_cardmember_count,
                     count(DISTINCT control_transaction_id) AS control_transaction_count,
                     {msum('transaction_amount')} AS total_control_spend_amount
              FROM {{control}} WHERE transaction_amount >= 0 GROUP BY ALL)""",
    "lifted": f"""
        SELECT *, CASE WHEN lift_per_cardmember > 0 THEN 'positive_lift' WHEN lift_per_cardmember < 0
                       THEN 'negative_lift' ELSE 'no_lift' END AS lift_direction,
               {pos('average_test_spend_per_cardmember', 'average_control_spend_per_cardmember')}
                 AS test_to_control_spend_ratio
        FROM (SELECT t.*, c.control_cardmember_count, c.control_transaction_count, c.total_control_spend_amount,
                     c.average_control_spend_per_cardmember,
                     t.average_test_spend_per_cardmember - c.average_control_spend_per_cardmember
                       AS lift_per_cardmember
              FROM {{test_cells}} t JOIN {{control_cells}} c USING ({CELL}))""",
    "scaled": f"""
        SELECT *, CASE WHEN incremental_revenue_amount > 0 THEN 'positive_incremental_revenue'
                       WHEN incremental_revenue_amount < 0 THEN 'negative_incremental_revenue'
                       ELSE 'no_incremental_revenue' END AS incremental_revenue_direction,
               {pos('lift_per_cardmember', 'average_control_spend_per_cardmember')} AS lift_percentage,
               abs(incremental_revenue_amount) AS absolute_incremental_revenue_amount
        FROM (SELECT *, lift_per_cardmember * test_cardmember_count AS incremental_revenue_amount FROM {{lifted}})""",
    "inc": """
        SELECT *, estimated_incremental_margin_amount - total_test_reward_amount
                  - estimated_incremental_platform_fee_amount AS estimated_incremental_value_after_reward
        FROM (SELECT s.*, coalesce(o.minimum_spend_amount, 0.0) AS minimum_spend_amount,
                     coalesce(o.reward_amount, 0.0) AS reward_amount,
                     coalesce(m.merchant_margin_rate, 0.0) AS merchant_margin_rate,
                     coalesce(m.platform_fee_rate, 0.0) AS platform_fee_rate,
                     s.incremental_revenue_amount * coalesce(m.merchant_margin_rate, 0.0)
                       AS estimated_incremental_margin_amount,
                     s.incremental_revenue_amount * coalesce(m.platform_fee_rate, 0.0)
                       AS estimated_incremental_platform_fee_amount
              FROM {scaled} s
              LEFT JOIN {cell_offer} o ON s.offer_id = o.offer_id AND s.campaign_id = o.campaign_id
                    AND s.merchant_id = o.merchant_id
              LEFT JOIN {merchant} m ON s.merchant_id = m.merchant_id)""",
    "base": """
        SELECT * EXCLUDE (estimated_incremental_margin_amount, estimated_incremental_platform_fee_amount, margin,
                          fee_base),
               margin AS estimated_incremental_margin_amount,
               incremental_revenue_amount - margin AS estimated_incremental_cogs_amount,
               fee_base AS platform_fee_revenue_base_amount,
               fee_base * normalized_platform_fee_rate AS estimated_incremental_platform_fee_amount
        FROM (SELECT *, coalesce(merchant_margin_rate, 0.0) AS normalized_merchant_margin_rate,
                     coalesce(platform_fee_rate, 0.0) AS normalized_platform_fee_rate,
                     incremental_revenue_amount * coalesce(merchant_margin_rate, 0.0) AS margin,
                     greatest(incremental_revenue_amount, 0.0) AS fee_base FROM {inc})""",
    "net": f"""
        SELECT *, {nz('net_merchant_profit_amount', 'test_cardmember_count')} AS net_profit_per_test_cardmember,
               {nz('net_merchant_profit_amount', 'incremental_revenue_amount')}
                 AS net_profit_margin_on_incremental_revenue
        FROM (SELECT *, coalesce(total_test_reward_amount, 0.0) AS funded_reward_cost_amount,
                     estimated_incremental_margin_amount - coalesce(total_test_reward_amount, 0.0)
                       - estimated_incremental_platform_fee_amount AS net_merchant_profit_amount FROM {{base}})""",
    "classed": """
        SELECT *, CASE sign(net_merchant_profit_amount) WHEN 1 THEN 'profitable' WHEN -1 THEN 'unprofitable'
                  ELSE 'break_even' END AS profitability_status,
               incremental_revenue_amount > 0 AS incremental_revenue_positive_flag,
               net_merchant_profit_amount > 0 AS net_profit_positive_flag,
               incremental_revenue_amount > 0 AND net_merchant_profit_amount > 0 AS profitable_incremental_offer_flag,
               incremental_revenue_amount > 0 AND net_merchant_profit_amount < 0 AS spend_lift_but_profit_loss_flag,
               incremental_revenue_amount < 0 AND net_merchant_profit_amount < 0
                 AS negative_lift_and_unprofitable_flag,
               CASE WHEN incremental_revenue_amount > 0 AND net_merchant_profit_amount > 0
                    THEN 'Offer produced positive incremental revenue and positive net merchant profit.'
                    WHEN incremental_revenue_amount > 0 AND net_merchant_profit_amount < 0
                    THEN 'Offer produced incremental revenue, but reward cost and platform fee exceeded merchant margin.'
                    WHEN incremental_revenue_amount < 0 AND net_merchant_profit_amount < 0
                    THEN 'Offer underperformed control group and produced negative net merchant profit.'
                    WHEN net_merchant_profit_amount = 0
                    THEN 'Offer approximately broke even after reward cost and platform fee.'
                    ELSE 'Offer profitability requires review.' END AS profitability_explanation
        FROM {net}""",
    "feat": f"""
        SELECT * EXCLUDE (average_test_reward_per_redemption, test_to_control_spend_ratio,
                          absolute_incremental_revenue_amount, estimated_incremental_value_after_reward),
               {nz('incremental_revenue_amount', 'funded_reward_cost_amount')} AS reward_roas,
               {nz('incremental_revenue_amount', 'total_offer_cost_amount')} AS total_cost_roas,
               {nz('estimated_incremental_margin_amount', 'total_offer_cost_amount')} AS margin_roas,
               {nz('net_merchant_profit_amount', 'total_offer_cost_amount')} AS net_profit_roas,
               {nz('total_offer_cost_amount', 'incremental_revenue_amount')} AS cost_per_incremental_revenue_dollar,
               {nz('funded_reward_cost_amount', 'incremental_revenue_amount')}
                 AS reward_cost_share_of_incremental_revenue,
               {nz('estimated_incremental_platform_fee_amount', 'incremental_revenue_amount')}
                 AS platform_fee_share_of_incremental_revenue,
               CASE WHEN net_merchant_profit_amount > 0 THEN
                      CASE WHEN {nz('incremental_revenue_amount', 'total_offer_cost_amount')} >= 5
                           THEN 'highly_efficient'
                           WHEN {nz('incremental_revenue_amount', 'total_offer_cost_amount')} >= 2 THEN 'efficient'
                           ELSE 'profitable_but_low_efficiency' END
                    WHEN incremental_revenue_amount > 0 AND net_merchant_profit_amount < 0
                    THEN 'revenue_positive_but_profit_negative'
                    WHEN incremental_revenue_amount < 0 THEN 'negative_incrementality'
                    ELSE 'needs_review' END AS efficiency_status
        FROM (SELECT *, funded_reward_cost_amount + estimated_incremental_platform_fee_amount
                        AS total_offer_cost_amount FROM {{classed}})""",
    "flagged": f"""
        SELECT *, abs(test_control_spend_similarity_ratio - 1.0) <= 0.05 AS test_control_spend_near_parity_flag
        FROM (SELECT *, lift_percentage <= 0.05 AS weak_lift_flag,
                     incremental_revenue_amount < 0 AS negative_lift_flag,
                     net_merchant_profit_amount < 0 AS negative_net_profit_flag,
                     total_cost_roas < 2 AS low_total_cost_roas_flag,
                     reward_cost_share_of_incremental_revenue >= 0.25 AS high_reward_cost_share_flag,
                     net_profit_margin_on_incremental_revenue <= 0 AS low_net_profit_margin_flag,
                     incremental_revenue_amount > 0 AND net_merchant_profit_amount < 0
                       AS positive_spend_lift_but_profit_loss_flag,
                     funded_reward_cost_amount > estimated_incremental_margin_amount
                       AS reward_cost_exceeds_incremental_margin_flag,
                     {nz('average_test_spend_per_cardmember', 'average_control_spend_per_cardmember')}
                       AS test_control_spend_similarity_ratio
              FROM {{feat}})""",
    "scored": """
        SELECT *, negative_net_profit_risk_points + negative_lift_risk_points + weak_lift_risk_points
               + low_total_cost_roas_risk_points + high_reward_cost_share_risk_points
               + positive_spend_lift_but_profit_loss_risk_points
               + reward_cost_exceeds_incremental_margin_risk_points
               + test_control_spend_near_parity_risk_points AS cannibalization_risk_score
        FROM (SELECT *, CAST(negative_net_profit_flag AS INT) * 30 AS negative_net_profit_risk_points,
                     CAST(negative_lift_flag AS INT) * 25 AS negative_lift_risk_points,
                     CAST(weak_lift_flag AS INT) * 15 AS weak_lift_risk_points,
                     CAST(low_total_cost_roas_flag AS INT) * 15 AS low_total_cost_roas_risk_points,
                     CAST(high_reward_cost_share_flag AS INT) * 10 AS high_reward_cost_share_risk_points,
                     CAST(positive_spend_lift_but_profit_loss_flag AS INT) * 20
                       AS positive_spend_lift_but_profit_loss_risk_points,
                     CAST(reward_cost_exceeds_incremental_margin_flag AS INT) * 15
                       AS reward_cost_exceeds_incremental_margin_risk_points,
                     CAST(test_control_spend_near_parity_flag AS INT) * 10
                       AS test_control_spend_near_parity_risk_points
              FROM {flagged})""",
    "levelled": """
        SELECT *, cannibalization_risk_level IN ('critical', 'high') AS requires_merchant_review_flag,
               cannibalization_risk_level = 'critical' OR (positive_spend_lift_but_profit_loss_flag
                 AND reward_cost_exceeds_incremental_margin_flag) AS requires_offer_redesign_flag,
               cannibalization_risk_level = 'low' AND net_merchant_profit_amount >= 0
                 AND incremental_revenue_amount >= 0 AS safe_to_scale_flag,
               CASE cannibalization_risk_level
                 WHEN 'critical' THEN
                   'Pause or redesign offer; high likelihood of subsidized spend or negative merchant economics.'
                 WHEN 'high' THEN
                   'Review targeting, reward amount, and eligibility rules before scaling campaign.'
                 WHEN 'medium' THEN
                   'Monitor campaign economics and consider tighter segmentation or lower reward cost.'
                 ELSE 'Low cannibalization concern; campaign appears economically acceptable under current rules.'
               END AS cannibalization_action_recommendation
        FROM (SELECT *, CASE WHEN cannibalization_risk_score >= 80 THEN 'critical'
                             WHEN cannibalization_risk_score >= 50 THEN 'high'
                             WHEN cannibalization_risk_score >= 25 THEN 'medium' ELSE 'low' END
                        AS cannibalization_risk_level FROM {scored})""",
    "risk": """
        SELECT *, 'Risk level: ' || cannibalization_risk_level || ' | Score: ' ||
               CAST(cannibalization_risk_score AS VARCHAR) || ' | Driver: ' || primary_cannibalization_risk_driver
               || ' | Reason: ' || cannibalization_risk_reason AS cannibalization_risk_detail
        FROM (SELECT *, CASE primary_cannibalization_risk_driver
                 WHEN 'negative_lift_and_negative_profit' THEN
                   'Offer underperformed the control group and produced negative merchant profit.'
                 WHEN 'positive_spend_lift_but_profit_loss' THEN
                   'Offer produced incremental spend, but reward cost and platform fee exceeded merchant margin.'
                 WHEN 'reward_cost_exceeds_incremental_margin' THEN
                   'Funded reward cost exceeded estimated incremental merchant margin.'
                 WHEN 'low_total_cost_roas' THEN
                   'Offer generated weak incremental revenue relative to total offer cost.'
                 WHEN 'weak_lift' THEN 'Test group spend was only slightly above control group spend.'
                 WHEN 'test_control_spend_near_parity' THEN
                   'Test and control spend were very similar, suggesting possible subsidized organic spend.'
                 WHEN 'low_risk_profitable_offer' THEN
                   'Offer shows low cannibalization risk and acceptable merchant economics.'
                 ELSE 'Offer has mixed or minor cannibalization signals and should be monitored.'
               END AS cannibalization_risk_reason
              FROM (SELECT *, CASE WHEN negative_lift_flag AND negative_net_profit_flag
                                   THEN 'negative_lift_and_negative_profit'
                                   WHEN positive_spend_lift_but_profit_loss_flag
                                   THEN 'positive_spend_lift_but_profit_loss'
                                   WHEN reward_cost_exceeds_incremental_margin_flag
                                   THEN 'reward_cost_exceeds_incremental_margin'
                                   WHEN low_total_cost_roas_flag THEN 'low_total_cost_roas'
                                   WHEN weak_lift_flag THEN 'weak_lift'
                                   WHEN test_control_spend_near_parity_flag THEN 'test_control_spend_near_parity'
                                   WHEN safe_to_scale_flag THEN 'low_risk_profitable_offer'
                                   ELSE 'mixed_or_minor_risk_signals' END AS primary_cannibalization_risk_driver
                    FROM {levelled}))""",
    # ------------------------------------------------------------------ versioned dimensions
    "scd_state": f"""
        WITH o AS (SELECT *, {image('__NULL__', 'merchant_name', 'category_id', 'location_id',
                                    'merchant_margin_rate', 'platform_fee_rate')} AS h FROM {{merchant}}),
             n AS (SELECT *, {image('__NULL__', 'merchant_name', 'category_id', 'location_id',
                                    'merchant_margin_rate', 'platform_fee_rate')} AS h FROM {{merchant_v2}})
        SELECT 'scd_' || sha256(concat_ws('||', CAST(merchant_id AS VARCHAR),
                                          CAST(effective_start_date AS VARCHAR), h)) AS surrogate_scd_id,
               merchant_id, merchant_name, category_id, location_id, merchant_margin_rate, platform_fee_rate,
               effective_start_date, effective_end_date, effective_end_date IS NULL AS is_current,
               h AS scd_record_hash
        FROM (SELECT o.*, DATE '1995-01-01' AS effective_start_date,
                     CASE WHEN o.h <> n.h THEN DATE '1998-05-31' END AS effective_end_date
              FROM o LEFT JOIN n USING (merchant_id)
              UNION ALL
              SELECT n.*, DATE '1998-06-01', NULL FROM n JOIN o USING (merchant_id) WHERE o.h <> n.h)""",
}
