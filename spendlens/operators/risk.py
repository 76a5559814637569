"""Cannibalization risk: evidence flags, a weighted score, a level and a readable reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..functions.exprs import case, derive, ratio_nz, require
from ..sources.contracts import RISK_COLUMNS, RISK_FLAG_COLUMNS, RISK_INPUT_COLUMNS, RISK_POINT_COLUMNS
from .marts import metrics


@dataclass(frozen=True)
class Signal:
    """A scored flag: `<name>_flag` adds `points` as `<name>_risk_points`."""

    name: str
    points: int


# Thresholds, points, level bounds, texts.
WEAK_LIFT = "0.05D"
LOW_ROAS = "2D"
HIGH_REWARD_SHARE = "0.25D"
LOW_PROFIT_MARGIN = "0D"
PARITY_TOLERANCE = "0.05D"

FLAGS = {
    "weak_lift_flag": f"lift_percentage <= {WEAK_LIFT}",
    "negative_lift_flag": "incremental_revenue_amount < 0",
    "negative_net_profit_flag": "net_merchant_profit_amount < 0",
    "low_total_cost_roas_flag": f"total_cost_roas < {LOW_ROAS}",
    "high_reward_cost_share_flag": f"reward_cost_share_of_incremental_revenue >= {HIGH_REWARD_SHARE}",
    "low_net_profit_margin_flag": f"net_profit_margin_on_incremental_revenue <= {LOW_PROFIT_MARGIN}",
    "positive_spend_lift_but_profit_loss_flag": "incremental_revenue_amount > 0 AND net_merchant_profit_amount < 0",
    "reward_cost_exceeds_incremental_margin_flag": "funded_reward_cost_amount > estimated_incremental_margin_amount",
    "test_control_spend_similarity_ratio": ratio_nz(
        "average_test_spend_per_cardmember", "average_control_spend_per_cardmember"
    ),
    "test_control_spend_near_parity_flag": f"abs(test_control_spend_similarity_ratio - 1D) <= {PARITY_TOLERANCE}",
}
SIGNALS = (
    Signal("negative_net_profit", 30),
    Signal("negative_lift", 25),
    Signal("weak_lift", 15),
    Signal("low_total_cost_roas", 15),
    Signal("high_reward_cost_share", 10),
    Signal("positive_spend_lift_but_profit_loss", 20),
    Signal("reward_cost_exceeds_incremental_margin", 15),
    Signal("test_control_spend_near_parity", 10),
)
LEVELS = (("critical", 80), ("high", 50), ("medium", 25))
LOWEST_LEVEL = "low"
RECOMMENDATIONS = {
    "critical": "Pause or redesign offer; high likelihood of subsidized spend or negative merchant economics.",
    "high": "Review targeting, reward amount, and eligibility rules before scaling campaign.",
    "medium": "Monitor campaign economics and consider tighter segmentation or lower reward cost.",
    "low": "Low cannibalization concern; campaign appears economically acceptable under current rules.",
}
# Ordered: the first driver whose condition holds explains the row.
DRIVERS = (
    ("negative_lift_and_negative_profit", "negative_lift_flag AND negative_net_profit_flag",
     "Offer underperformed the control group and produced negative merchant profit."),
    ("positive_spend_lift_but_profit_loss", "positive_spend_lift_but_profit_loss_flag",
     "Offer produced incremental spend, but reward cost and platform fee exceeded merchant margin."),
    ("reward_cost_exceeds_incremental_margin", "reward_cost_exceeds_incremental_margin_flag",
     "Funded reward cost exceeded estimated incremental merchant margin."),
    ("low_total_cost_roas", "low_total_cost_roas_flag",
     "Offer generated weak incremental revenue relative to total offer cost."),
    ("weak_lift", "weak_lift_flag",
     "Test group spend was only slightly above control group spend."),
    ("test_control_spend_near_parity", "test_control_spend_near_parity_flag",
     "Test and control spend were very similar, suggesting possible subsidized organic spend."),
    ("low_risk_profitable_offer", "safe_to_scale_flag",
     "Offer shows low cannibalization risk and acceptable merchant economics."),
)
OTHER_DRIVER = (
    "mixed_or_minor_risk_signals",
    "Offer has mixed or minor cannibalization signals and should be monitored.",
)
# The small four-signal variant of the score.
PRACTICE_SIGNALS = (
    ("negative_profit_risk_points", "net_merchant_profit_amount < 0", 40),
    ("weak_lift_risk_points", f"lift_percentage <= {WEAK_LIFT}", 25),
    ("low_roas_risk_points", f"total_cost_roas < {LOW_ROAS}", 20),
    ("spend_lift_profit_loss_risk_points", "spend_lift_but_profit_loss_flag", 15),
)


def points(cond: str, value: int) -> str:
    return f"CASE WHEN {cond} THEN {value} ELSE 0 END"


def level(score: str = "cannibalization_risk_score", levels: Sequence[tuple[str, int]] = LEVELS) -> str:
    return case([(f"{score} >= {bound}", name) for name, bound in levels], LOWEST_LEVEL)


def _recommendation() -> str:
    arms = [(f"cannibalization_risk_level = '{n}'", t) for n, t in RECOMMENDATIONS.items() if n != LOWEST_LEVEL]
    return case(arms, RECOMMENDATIONS[LOWEST_LEVEL])


SCORE = {f"{s.name}_risk_points": points(f"{s.name}_flag", s.points) for s in SIGNALS} | {
    "cannibalization_risk_score": " + ".join(RISK_POINT_COLUMNS)
}
DECISION = {
    "cannibalization_risk_level": level(),
    "cannibalization_action_recommendation": _recommendation(),
    "requires_merchant_review_flag": "cannibalization_risk_level IN ('critical', 'high')",
    "requires_offer_redesign_flag": "cannibalization_risk_level = 'critical' OR "
    "(positive_spend_lift_but_profit_loss_flag AND reward_cost_exceeds_incremental_margin_flag)",
    "safe_to_scale_flag": "cannibalization_risk_level = 'low' AND NOT negative_net_profit_flag "
    "AND NOT negative_lift_flag",
}
REASON = {
    "primary_cannibalization_risk_driver": case([(cond, name) for name, cond, _ in DRIVERS], OTHER_DRIVER[0]),
    "cannibalization_risk_reason": case(
        [(f"primary_cannibalization_risk_driver = '{name}'", text) for name, _, text in DRIVERS], OTHER_DRIVER[1]
    ),
    "cannibalization_risk_detail": "concat_ws(' ', 'Risk level:', cannibalization_risk_level, '| Score:', "
    "CAST(cannibalization_risk_score AS STRING), '| Driver:', primary_cannibalization_risk_driver, "
    "'| Reason:', cannibalization_risk_reason)",
}


def flags(features: DataFrame) -> DataFrame:
    """Evidence flags on top of the profitability mart."""
    return derive(require(features, RISK_INPUT_COLUMNS, "features"), FLAGS)


def score(flagged: DataFrame) -> DataFrame:
    """Points per flag and their sum."""
    return derive(require(flagged, RISK_FLAG_COLUMNS, "flags"), SCORE)


def classify(scored: DataFrame) -> DataFrame:
    """Level, recommendation and the three action flags."""
    return derive(scored, DECISION)


def explain(classified: DataFrame) -> DataFrame:
    """Main driver, its reason text and the one-line detail."""
    return derive(classified, REASON)


def cannibalization(features: DataFrame) -> DataFrame:
    """The risk mart: a pure projection over the profitability mart."""
    return explain(classify(score(flags(features)))).select(*metrics(RISK_COLUMNS, "cannibalization"))


def practice_score(features: DataFrame) -> DataFrame:
    """Four-signal score with the same level bounds."""
    named = {name: points(cond, value) for name, cond, value in PRACTICE_SIGNALS}
    total = {"cannibalization_risk_score": " + ".join(named)}
    return derive(features, named | total | {"cannibalization_risk_level": level()})
