"""Who may take part: consent, offer pool, assignment status, active rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import derive
from ..functions.rules import assignment_status

# Fixed value: offers that customers can have interacted with.
POOL_STATUSES = ("active", "expired")


def consenting_cardmembers(cardmembers: DataFrame, consents: DataFrame) -> DataFrame:
    """Cardmembers who granted both analytics and merchant reporting."""
    both = consents.filter("analytics_consent_flag AND merchant_reporting_consent_flag")
    return cardmembers.join(both, "tokenized_cardmember_id")


def offer_pool(offers: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Active or expired offers with their campaign attached."""
    return offers.filter(F.col("offer_status").isin(*POOL_STATUSES)).join(campaigns, "campaign_id", "left")


def with_assignment_status(assignments: DataFrame, cardmembers: DataFrame) -> DataFrame:
    """Set the status from the cardmember's eligibility flags."""
    flags = cardmembers.select("tokenized_cardmember_id", "is_test_eligible", "is_control_eligible")
    joined = assignments.join(flags, "tokenized_cardmember_id", "left")
    return derive(joined, {"assignment_status": assignment_status()}).drop("is_test_eligible", "is_control_eligible")


def eligible_group(assignments: DataFrame, group: str) -> DataFrame:
    return assignments.filter((F.col("assignment_group") == group) & (F.col("assignment_status") == "eligible"))


def active_rules(risk_rules: DataFrame) -> DataFrame:
    return risk_rules.filter("is_active")
