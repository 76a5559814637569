"""Business rules that work on single rows: rewards, funding, calendar, seasonality, labels."""

from __future__ import annotations

from .exprs import case, cents, rate, round_money

# Offer types, liability owners and the two shares of a shared reward.
OFFER_FIXED = "fixed_cashback"
OFFER_PERCENT = "percent_cashback"
MERCHANT_SHARE = "0.75"


def reward_amount(amount: str = "transaction_amount") -> str:
    """Reward of a qualifying purchase under the offer's own type; unknown types raise."""
    capped = f"LEAST({cents(amount)} * {rate('reward_multiplier')}, {cents('max_reward_amount')})"
    return (
        f"CASE offer_type WHEN '{OFFER_FIXED}' THEN {round_money(cents('reward_amount'))} "
        f"WHEN '{OFFER_PERCENT}' THEN {round_money(capped)} "
        "ELSE CAST(raise_error(concat('unsupported offer_type: ', coalesce(offer_type, 'null'))) AS DOUBLE) END"
    )


def funding_split(reward: str = "reward_amount", owner: str = "liability_owner") -> dict[str, str]:
    """Merchant and platform parts of a reward; the platform takes the rounding remainder."""
    exact = cents(reward)
    merchant = f"ROUND({exact} * {MERCHANT_SHARE}, 2)"
    unknown = f"CAST(raise_error(concat('unsupported liability_owner: ', coalesce({owner}, 'null'))) AS DOUBLE)"
    return {
        "merchant_funded_amount": f"CASE {owner} WHEN 'merchant' THEN CAST({exact} AS DOUBLE) WHEN 'platform' THEN 0D "
        f"WHEN 'shared' THEN CAST({merchant} AS DOUBLE) ELSE {unknown} END",
        "platform_funded_amount": f"CASE {owner} WHEN 'merchant' THEN 0D WHEN 'platform' THEN CAST({exact} AS DOUBLE) "
        f"WHEN 'shared' THEN CAST({exact} - {merchant} AS DOUBLE) ELSE {unknown} END",
    }


# Category, when the uplift applies, multiplier.
SEASONALITY = (
    ("dining", "{weekend}", "1.15"),
    ("retail", "{month} IN (11, 12)", "1.25"),
    ("travel", "{month} IN (6, 7, 11, 12)", "1.20"),
    ("luxury", "{month} IN (11, 12)", "1.15"),
)


def seasonality(date: str = "transaction_date", amount: str = "transaction_amount") -> dict[str, str]:
    """Category season multiplier and the adjusted amount."""
    names = {"weekend": f"weekday({date}) >= 5", "month": f"month({date})"}
    arms = " ".join(
        f"WHEN category_name = '{category}' AND {when.format(**names)} THEN {value}"
        for category, when, value in SEASONALITY
    )
    return {
        "seasonality_multiplier": f"CAST(CASE {arms} ELSE 1.00 END AS DOUBLE)",
        "seasonal_amount": round_money(f"{cents(amount)} * {rate('seasonality_multiplier')}"),
    }


# The fixed-date holidays.
HOLIDAYS = (("01-01", "New Year's Day"), ("07-04", "Independence Day"), ("12-25", "Christmas Day"))


def calendar_columns(date: str = "calendar_date") -> dict[str, str]:
    """Attributes of a calendar day; weeks start on Sunday and week 0 precedes the first one."""
    month_day = f"date_format({date}, 'MM-dd')"
    names = case([(f"{month_day} = '{d}'", n) for d, n in HOLIDAYS], "")
    week = f"CAST(floor((dayofyear({date}) + 7 - dayofweek({date})) / 7) AS BIGINT)"
    return {
        "date_id": f"date_format({date}, 'yyyyMMdd')",
        "year": f"CAST(year({date}) AS BIGINT)",
        "quarter": f"CAST(quarter({date}) AS BIGINT)",
        "month": f"CAST(month({date}) AS BIGINT)",
        "month_name": f"date_format({date}, 'MMMM')",
        "week_of_year": week,
        "day_of_week": f"date_format({date}, 'EEEE')",
        "day_of_month": f"CAST(day({date}) AS BIGINT)",
        "is_weekend": f"weekday({date}) >= 5",
        "is_holiday": f"{month_day} IN ({', '.join(repr(d) for d, _ in HOLIDAYS)})",
        "holiday_name": f"NULLIF({names}, '')",
    }


def assignment_status() -> str:
    """Eligibility of an assignment from the group and the cardmember's two eligibility flags."""
    blocked = (
        "(assignment_group = 'test' AND NOT coalesce(is_test_eligible, false)) "
        "OR (assignment_group = 'control' AND NOT coalesce(is_control_eligible, false))"
    )
    return case([(blocked, "ineligible")], "eligible")


def risk_event_status(score: str = "risk_score") -> str:
    """Review status from a risk score."""
    return case([(f"{score} >= 0.90D", "open"), (f"{score} >= 0.75D", "reviewed")], "confirmed_false_positive")


def margin_clamp(value: str) -> str:
    """Merchant margin held inside its allowed band."""
    return f"GREATEST(0.05D, LEAST(0.80D, {value}))"


def average_ticket(spend: str, count: str) -> str:
    """Average ticket to the cent; null without purchases."""
    return f"CASE WHEN {count} > 0 THEN {round_money(f'{cents(spend)} / {count}')} END"


def incrementality_quality(lift: str, reward_per_user: str) -> str:
    """Coarse reading of a lift against what it cost per user."""
    return case(
        [(f"{lift} <= 0", "no_lift"), (f"{lift} < {reward_per_user}", "weak_lift_possible_cannibalization")],
        "strong_lift",
    )


def simple_economics() -> dict[str, str]:
    """First-look campaign economics from group totals, one margin rate and two costs."""
    return {
        "lift_per_user": "test_spend / test_users - control_spend / control_users",
        "incremental_revenue": "lift_per_user * test_users",
        "incremental_profit": "incremental_revenue * margin_rate - reward_cost - platform_fee",
        "simple_roas": "CASE WHEN reward_cost <> 0 THEN incremental_revenue / reward_cost ELSE 0D END",
        "simple_risk": case(
            [("incremental_profit < 0 AND lift_per_user <= 5", "high"), ("incremental_profit < 0", "medium")], "low"
        ),
    }
