"""What every table looks like: schemas, keys, partitioning, casts, relations, mart columns.

All of this file is fixed values: the data contract of the domain.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """Contract of one source table."""

    name: str
    key: str
    schema: str
    partition: str | None = None
    timestamps: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    numerics: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()

    @property
    def clean_name(self) -> str:
        return f"{self.name}_clean"

    @property
    def clean_partition(self) -> str | None:
        return self.dates[0] if self.dates else None


@dataclass(frozen=True)
class ScdSpec:
    """Versioned dimension: which source, which key, which changes open a new version."""

    source: str
    output: str
    key: str
    tracked: tuple[str, ...]


@dataclass(frozen=True)
class Relation:
    """A child column whose values must exist in a parent column."""

    name: str
    child: str
    child_column: str
    parent: str
    parent_column: str


SOURCE_TABLES = (
    TableSpec(
        "dim_category", "category_id",
        "category_id string, category_name string, parent_category string, basket_min bigint, basket_max bigint, "
        "default_margin_rate double, seasonality string, created_at timestamp_ntz",
    ),
    TableSpec(
        "dim_location", "location_id",
        "location_id string, state string, market_area string, zip_prefix string, timezone string, "
        "created_at timestamp_ntz",
    ),
    TableSpec(
        "dim_segment", "segment_id",
        "segment_id string, segment_name string, segment_description string, expected_response_rate double, "
        "expected_incrementality_rate double, created_at timestamp_ntz",
    ),
    TableSpec(
        "dim_risk_rule", "risk_rule_id",
        "risk_rule_id string, risk_rule_name string, risk_category string, severity string, "
        "risk_rule_description string, is_active boolean, created_at timestamp_ntz",
    ),
    TableSpec(
        "dim_merchant", "merchant_id",
        "merchant_id string, merchant_name string, category_id string, location_id string, merchant_status string, "
        "merchant_margin_rate double, platform_fee_rate double, merchant_start_date date, created_at timestamp_ntz",
        numerics=("merchant_margin_rate", "platform_fee_rate"),
    ),
    TableSpec(
        "dim_campaign", "campaign_id",
        "campaign_id string, campaign_name string, campaign_objective string, campaign_start_date date, "
        "campaign_end_date date, campaign_status string, target_segment_id string, budget_amount double, "
        "created_at timestamp_ntz",
        dates=("campaign_start_date", "campaign_end_date"),
    ),
    TableSpec(
        "dim_offer", "offer_id",
        "offer_id string, campaign_id string, merchant_id string, offer_name string, offer_type string, "
        "minimum_spend_amount double, reward_amount double, reward_multiplier double, max_reward_amount double, "
        "offer_start_date date, offer_end_date date, offer_status string, created_at timestamp_ntz",
        dates=("offer_start_date", "offer_end_date"),
        numerics=("minimum_spend_amount", "reward_amount"),
    ),
    TableSpec(
        "dim_cardmember_token", "tokenized_cardmember_id",
        "tokenized_cardmember_id string, segment_id string, location_id string, account_open_date date, "
        "customer_tenure_months bigint, historical_spend_90d double, historical_transaction_count_90d bigint, "
        "average_ticket_size double, merchant_affinity_score double, category_affinity_score double, "
        "shopper_behavior_type string, is_test_eligible boolean, is_control_eligible boolean, "
        "created_at timestamp_ntz",
    ),
    TableSpec(
        "dim_privacy_consent", "consent_id",
        "consent_id string, tokenized_cardmember_id string, analytics_consent_flag boolean, "
        "merchant_reporting_consent_flag boolean, consent_effective_date date, consent_status string, "
        "created_at timestamp_ntz",
        unique=("tokenized_cardmember_id",),
    ),
    TableSpec(
        "dim_date", "date_id",
        "date_id string, calendar_date date, year bigint, quarter bigint, month bigint, month_name string, "
        "week_of_year bigint, day_of_week string, day_of_month bigint, is_weekend boolean, is_holiday boolean, "
        "holiday_name string, created_at timestamp_ntz",
        dates=("calendar_date",),
    ),
    TableSpec(
        "fact_transactions", "transaction_id",
        "transaction_id string, tokenized_cardmember_id string, merchant_id string, category_id string, "
        "location_id string, transaction_timestamp timestamp_ntz, transaction_date date, transaction_amount double, "
        "transaction_status string, shopper_behavior_type string, segment_id string, is_test_group boolean, "
        "is_control_group boolean, created_at timestamp_ntz",
        partition="transaction_date",
        timestamps=("transaction_timestamp",),
        dates=("transaction_date",),
        numerics=("transaction_amount",),
    ),
    TableSpec(
        "fact_offer_customer_assignment", "assignment_id",
        "assignment_id string, tokenized_cardmember_id string, offer_id string, campaign_id string, "
        "merchant_id string, segment_id string, assignment_group string, assignment_status string, "
        "match_group_id string, assignment_date date, shopper_behavior_type string, "
        "merchant_reporting_consent_flag boolean, created_at timestamp_ntz",
        dates=("assignment_date",),
    ),
    TableSpec(
        "fact_offer_impressions", "impression_id",
        "impression_id string, assignment_id string, tokenized_cardmember_id string, offer_id string, "
        "campaign_id string, merchant_id string, segment_id string, impression_timestamp timestamp_ntz, "
        "impression_date date, channel string, was_clicked boolean, created_at timestamp_ntz",
        partition="impression_date",
        timestamps=("impression_timestamp",),
        dates=("impression_date",),
    ),
    TableSpec(
        "fact_offer_activations", "activation_id",
        "activation_id string, impression_id string, assignment_id string, tokenized_cardmember_id string, "
        "offer_id string, campaign_id string, merchant_id string, segment_id string, "
        "activation_timestamp timestamp_ntz, activation_date date, offer_expiry_timestamp timestamp_ntz, "
        "activation_status string, created_at timestamp_ntz",
        partition="activation_date",
        timestamps=("activation_timestamp", "offer_expiry_timestamp"),
        dates=("activation_date",),
    ),
    TableSpec(
        "fact_offer_redemptions", "redemption_id",
        "redemption_id string, transaction_id string, activation_id string, assignment_id string, "
        "impression_id string, tokenized_cardmember_id string, offer_id string, campaign_id string, "
        "merchant_id string, redemption_timestamp timestamp_ntz, redemption_date date, transaction_amount double, "
        "calculated_reward_amount double, redemption_status string, created_at timestamp_ntz",
        partition="redemption_date",
        timestamps=("redemption_timestamp",),
        dates=("redemption_date",),
        numerics=("transaction_amount", "calculated_reward_amount"),
    ),
    TableSpec(
        "fact_control_group_transactions", "control_transaction_id",
        "control_transaction_id string, transaction_id string, control_assignment_id string, "
        "tokenized_cardmember_id string, merchant_id string, campaign_id string, offer_id string, "
        "segment_id string, transaction_timestamp timestamp_ntz, transaction_date date, transaction_amount double, "
        "match_group_id string, match_quality_score double, shopper_behavior_type string, created_at timestamp_ntz",
        partition="transaction_date",
        timestamps=("transaction_timestamp",),
        dates=("transaction_date",),
        numerics=("transaction_amount", "match_quality_score"),
    ),
    TableSpec(
        "fact_reward_liability", "reward_liability_id",
        "reward_liability_id string, redemption_id string, transaction_id string, activation_id string, "
        "tokenized_cardmember_id string, offer_id string, campaign_id string, merchant_id string, "
        "liability_date date, liability_timestamp timestamp_ntz, reward_amount double, liability_owner string, "
        "merchant_funded_amount double, platform_funded_amount double, liability_status string, "
        "created_at timestamp_ntz",
        partition="liability_date",
        timestamps=("liability_timestamp",),
        dates=("liability_date",),
        numerics=("reward_amount", "merchant_funded_amount", "platform_funded_amount"),
    ),
    TableSpec(
        "fact_merchant_settlements", "settlement_id",
        "settlement_id string, transaction_id string, redemption_id string, reward_liability_id string, "
        "merchant_id string, settlement_date date, gross_transaction_amount double, platform_fee_rate double, "
        "platform_fee_amount double, reward_amount double, liability_owner string, merchant_funded_amount double, "
        "platform_funded_amount double, merchant_settlement_amount double, merchant_net_after_reward double, "
        "settlement_status string, created_at timestamp_ntz",
        partition="settlement_date",
        dates=("settlement_date",),
        numerics=(
            "gross_transaction_amount",
            "platform_fee_amount",
            "merchant_settlement_amount",
            "merchant_net_after_reward",
        ),
    ),
    TableSpec(
        "fact_fraud_risk_events", "fraud_event_id",
        "fraud_event_id string, transaction_id string, redemption_id string, tokenized_cardmember_id string, "
        "merchant_id string, risk_rule_id string, risk_rule_name string, risk_category string, "
        "risk_severity string, risk_score double, event_timestamp timestamp_ntz, event_date date, "
        "risk_event_status string, risk_event_description string, created_at timestamp_ntz",
        partition="event_date",
        timestamps=("event_timestamp",),
        dates=("event_date",),
        numerics=("risk_score",),
    ),
    TableSpec(
        "fact_data_quality_reconciliation", "reconciliation_id",
        "reconciliation_id string, transaction_id string, merchant_id string, reconciliation_date date, "
        "transaction_amount double, merchant_settlement_amount double, platform_fee_amount double, "
        "reward_amount double, merchant_funded_amount double, platform_funded_amount double, "
        "settlement_delta double, reconciliation_status string, reconciliation_reason string, "
        "created_at timestamp_ntz",
        partition="reconciliation_date",
        dates=("reconciliation_date",),
        numerics=("transaction_amount", "merchant_settlement_amount", "platform_fee_amount", "settlement_delta"),
    ),
)

TABLE = {spec.name: spec for spec in SOURCE_TABLES}

SCD_TABLES = (
    ScdSpec(
        "dim_merchant_clean", "dim_merchant_scd", "merchant_id",
        ("merchant_name", "category_id", "location_id", "merchant_margin_rate", "platform_fee_rate"),
    ),
    ScdSpec(
        "dim_offer_clean", "dim_offer_scd", "offer_id",
        ("campaign_id", "merchant_id", "minimum_spend_amount", "reward_amount", "offer_start_date", "offer_end_date"),
    ),
    ScdSpec(
        "dim_campaign_clean", "dim_campaign_scd", "campaign_id",
        ("campaign_name", "campaign_start_date", "campaign_end_date"),
    ),
)

RELATIONS = (
    Relation("redemption_to_transaction",
             "fact_offer_redemptions", "transaction_id", "fact_transactions", "transaction_id"),
    Relation("control_transaction_to_transaction",
             "fact_control_group_transactions", "transaction_id", "fact_transactions", "transaction_id"),
    Relation("reward_liability_to_redemption",
             "fact_reward_liability", "redemption_id", "fact_offer_redemptions", "redemption_id"),
    Relation("reward_liability_to_transaction",
             "fact_reward_liability", "transaction_id", "fact_transactions", "transaction_id"),
    Relation("settlement_to_transaction",
             "fact_merchant_settlements", "transaction_id", "fact_transactions", "transaction_id"),
    Relation("fraud_event_to_transaction",
             "fact_fraud_risk_events", "transaction_id", "fact_transactions", "transaction_id"),
    Relation("reconciliation_to_transaction",
             "fact_data_quality_reconciliation", "transaction_id", "fact_transactions", "transaction_id"),
)

BRONZE_METADATA = ("ingestion_timestamp", "source_table_name", "source_file_path", "pipeline_run_id", "record_hash")
SILVER_METADATA = ("silver_transformed_at", "silver_pipeline_run_id", "quality_status", "validation_rule_version")
SCD_METADATA = (
    "effective_start_date",
    "effective_end_date",
    "is_current",
    "scd_record_hash",
    "scd_created_at",
    "scd_updated_at",
    "scd_pipeline_run_id",
    "scd_rule_version",
)

SILVER_RULES = "silver_rules_v1"
SCD_RULES = "scd_rules_v1"
SCD_FIRST_DATE = "2026-01-01"
MATCH_RULES = "redemption_match_rules_v1"
GOLD_RULES = "merchant_economics_rules_v1"
INCREMENTALITY_RULES = "incrementality_rules_v1"
PROFITABILITY_RULES = "incrementality_profitability_rules_v1"
CANNIBALIZATION_RULES = "cannibalization_rules_v1"

MATCHED_TABLE = "fact_matched_offer_redemptions_clean"
CELL = ("business_date", "offer_id", "campaign_id", "merchant_id")
MERCHANT_DAY = ("business_date", "merchant_id")

MATCHED_COLUMNS = (
    "matched_redemption_id",
    "transaction_id",
    "activation_id",
    "offer_id",
    "campaign_id",
    "merchant_id",
    "tokenized_cardmember_id",
    "transaction_timestamp",
    "transaction_date",
    "transaction_amount",
    "activation_timestamp",
    "offer_expiry_timestamp",
    "minimum_spend_amount",
    "reward_amount",
    "calculated_reward_amount",
    "match_rule_version",
    "match_pipeline_run_id",
    "matched_at",
    "match_deduplication_reason",
)
MERCHANT_DAILY_COLUMNS = (
    "business_date",
    "merchant_id",
    "transaction_count",
    "gross_spend_amount",
    "average_transaction_amount",
    "matched_redemption_count",
    "redeemed_transaction_count",
    "redemption_rate",
    "reward_cost_amount",
    "average_reward_amount",
    "merchant_margin_rate",
    "platform_fee_rate",
    "platform_fee_amount",
    "estimated_merchant_margin_amount",
    "merchant_net_after_reward",
    "gold_pipeline_run_id",
    "gold_rule_version",
    "gold_created_at",
)
OFFER_DAILY_COLUMNS = (
    "business_date",
    "offer_id",
    "campaign_id",
    "merchant_id",
    "campaign_name",
    "campaign_start_date",
    "campaign_end_date",
    "minimum_spend_amount",
    "reward_amount",
    "matched_redemption_count",
    "redeemed_transaction_count",
    "gross_redeemed_spend_amount",
    "reward_cost_amount",
    "average_redeemed_transaction_amount",
    "average_reward_amount",
    "reward_to_redeemed_spend_ratio",
    "gold_pipeline_run_id",
    "gold_rule_version",
    "gold_created_at",
)
INCREMENTALITY_COLUMNS = (
    "business_date",
    "offer_id",
    "campaign_id",
    "merchant_id",
    "minimum_spend_amount",
    "reward_amount",
    "merchant_margin_rate",
    "platform_fee_rate",
    "test_cardmember_count",
    "test_transaction_count",
    "test_redemption_count",
    "total_test_spend_amount",
    "total_test_reward_amount",
    "average_test_spend_per_cardmember",
    "average_test_reward_per_redemption",
    "control_cardmember_count",
    "control_transaction_count",
    "total_control_spend_amount",
    "average_control_spend_per_cardmember",
    "lift_per_cardmember",
    "lift_direction",
    "test_to_control_spend_ratio",
    "lift_percentage",
    "incremental_revenue_amount",
    "absolute_incremental_revenue_amount",
    "incremental_revenue_direction",
    "estimated_incremental_margin_amount",
    "estimated_incremental_platform_fee_amount",
    "estimated_incremental_value_after_reward",
    "incrementality_pipeline_run_id",
    "incrementality_rule_version",
    "incrementality_created_at",
)
FEATURE_COLUMNS = (
    "business_date",
    "offer_id",
    "campaign_id",
    "merchant_id",
    "minimum_spend_amount",
    "reward_amount",
    "merchant_margin_rate",
    "platform_fee_rate",
    "normalized_merchant_margin_rate",
    "normalized_platform_fee_rate",
    "test_cardmember_count",
    "test_transaction_count",
    "test_redemption_count",
    "total_test_spend_amount",
    "total_test_reward_amount",
    "control_cardmember_count",
    "control_transaction_count",
    "total_control_spend_amount",
    "average_test_spend_per_cardmember",
    "average_control_spend_per_cardmember",
    "lift_per_cardmember",
    "lift_direction",
    "lift_percentage",
    "incremental_revenue_amount",
    "incremental_revenue_direction",
    "estimated_incremental_margin_amount",
    "estimated_incremental_cogs_amount",
    "estimated_incremental_platform_fee_amount",
    "platform_fee_revenue_base_amount",
    "funded_reward_cost_amount",
    "net_merchant_profit_amount",
    "net_profit_per_test_cardmember",
    "net_profit_margin_on_incremental_revenue",
    "profitability_status",
    "incremental_revenue_positive_flag",
    "net_profit_positive_flag",
    "profitable_incremental_offer_flag",
    "spend_lift_but_profit_loss_flag",
    "negative_lift_and_unprofitable_flag",
    "profitability_explanation",
    "total_offer_cost_amount",
    "reward_roas",
    "total_cost_roas",
    "margin_roas",
    "net_profit_roas",
    "cost_per_incremental_revenue_dollar",
    "reward_cost_share_of_incremental_revenue",
    "platform_fee_share_of_incremental_revenue",
    "efficiency_status",
    "profitability_pipeline_run_id",
    "profitability_rule_version",
    "profitability_created_at",
)
RISK_FLAG_COLUMNS = (
    "weak_lift_flag",
    "negative_lift_flag",
    "negative_net_profit_flag",
    "low_total_cost_roas_flag",
    "high_reward_cost_share_flag",
    "low_net_profit_margin_flag",
    "positive_spend_lift_but_profit_loss_flag",
    "reward_cost_exceeds_incremental_margin_flag",
    "test_control_spend_similarity_ratio",
    "test_control_spend_near_parity_flag",
)
RISK_POINT_COLUMNS = (
    "negative_net_profit_risk_points",
    "negative_lift_risk_points",
    "weak_lift_risk_points",
    "low_total_cost_roas_risk_points",
    "high_reward_cost_share_risk_points",
    "positive_spend_lift_but_profit_loss_risk_points",
    "reward_cost_exceeds_incremental_margin_risk_points",
    "test_control_spend_near_parity_risk_points",
)
RISK_DECISION_COLUMNS = (
    "cannibalization_risk_score",
    "cannibalization_risk_level",
    "cannibalization_action_recommendation",
    "requires_merchant_review_flag",
    "requires_offer_redesign_flag",
    "safe_to_scale_flag",
    "primary_cannibalization_risk_driver",
    "cannibalization_risk_reason",
    "cannibalization_risk_detail",
)
RISK_INPUT_COLUMNS = (
    "business_date",
    "offer_id",
    "campaign_id",
    "merchant_id",
    "minimum_spend_amount",
    "reward_amount",
    "merchant_margin_rate",
    "platform_fee_rate",
    "test_cardmember_count",
    "test_transaction_count",
    "test_redemption_count",
    "total_test_spend_amount",
    "total_test_reward_amount",
    "control_cardmember_count",
    "total_control_spend_amount",
    "average_test_spend_per_cardmember",
    "average_control_spend_per_cardmember",
    "lift_per_cardmember",
    "lift_percentage",
    "incremental_revenue_amount",
    "incremental_revenue_direction",
    "estimated_incremental_margin_amount",
    "funded_reward_cost_amount",
    "estimated_incremental_platform_fee_amount",
    "net_merchant_profit_amount",
    "net_profit_per_test_cardmember",
    "net_profit_margin_on_incremental_revenue",
    "profitability_status",
    "profitable_incremental_offer_flag",
    "spend_lift_but_profit_loss_flag",
    "negative_lift_and_unprofitable_flag",
    "total_offer_cost_amount",
    "reward_roas",
    "total_cost_roas",
    "margin_roas",
    "net_profit_roas",
    "cost_per_incremental_revenue_dollar",
    "reward_cost_share_of_incremental_revenue",
    "platform_fee_share_of_incremental_revenue",
    "efficiency_status",
)
RISK_COLUMNS = (
    RISK_INPUT_COLUMNS
    + RISK_FLAG_COLUMNS
    + RISK_POINT_COLUMNS
    + RISK_DECISION_COLUMNS
    + ("cannibalization_pipeline_run_id", "cannibalization_rule_version", "cannibalization_created_at")
)

# Columns a broadly shared mart must not carry.
PROHIBITED_COLUMNS = (
    "card_number",
    "pan",
    "primary_account_number",
    "full_card_number",
    "account_number",
    "email",
    "phone_number",
    "real_name",
    "street_address",
)
SENSITIVE_COLUMNS = (
    "tokenized_cardmember_id",
    "consent_status",
    "privacy_eligibility_flag",
    "risk_score",
    "abuse_score",
    "risk_rule_id",
    "transaction_id",
    "activation_id",
    "redemption_id",
)
MIN_COHORT = 50
