"""Privacy: cohort suppression, column gates, PII scan, masking, row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import derive, money_sum
from ..sources.contracts import MIN_COHORT, PROHIBITED_COLUMNS, SENSITIVE_COLUMNS

VISIBLE = ("visible_test_spend", "visible_control_spend", "visible_incremental_spend", "visible_reward_cost")

# Patterns of personal data in free text.
PII_PATTERNS = {
    "credit_card_number": "[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}",
    "email_address": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}",
    "phone_number": "[+]?[0-9]{0,2}[ .-]?[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}",
    "person_name": "(Mr|Mrs|Ms|Dr)[.]? [A-Z][a-z]+( [A-Z][a-z]+)?",
    "street_address": "[0-9]{1,5} [A-Z][a-z]+( [A-Z][a-z]+)? (Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr)",
}
# A cheap pattern that every match of the full one contains; rows without it are not searched further.
PII_GATES = {"email_address": "@", "phone_number": "[0-9]{3}[ .-][0-9]{4}"}


def _gated(text: Column, kind: str, search: Column, nothing: Column) -> Column:
    gate = PII_GATES.get(kind)
    return F.when(text.rlike(gate), search).otherwise(nothing) if gate else F.coalesce(search, nothing)


def cohort_lift(test: DataFrame, control: DataFrame, grain: Sequence[str], min_cohort: int = MIN_COHORT) -> DataFrame:
    """Lift per cohort in which a cohort of fewer than `min_cohort` cards shows no figures.

    A figure of one arm is shown only if that arm reaches the limit too, a difference only if both do.
    Cards are first reduced to one row per (cohort, card), so distinct cards become a plain count
    and a hot cohort is combined before the final shuffle.
    """
    card = "tokenized_cardmember_id"
    stacked = test.select(*grain, card, F.lit("test").alias("g"), "transaction_amount", "calculated_reward_amount")
    stacked = stacked.unionByName(
        control.select(
            *grain, card, F.lit("control").alias("g"), "transaction_amount",
            F.lit(None).cast("double").alias("calculated_reward_amount"),
        )
    )

    def of(group: str):
        return F.when(F.col("g") == group, F.col("transaction_amount"))

    per_card = stacked.groupBy(*grain, card).agg(
        F.bool_or(F.col("g") == "test").alias("in_test"),
        F.bool_or(F.col("g") == "control").alias("in_control"),
        money_sum(of("test")).alias("test_spend"),
        money_sum(of("control")).alias("control_spend"),
        money_sum("calculated_reward_amount").alias("reward"),
    )
    cohorts = per_card.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.count_if("in_test").alias("test_cards"),
        F.count_if("in_control").alias("control_cards"),
        F.coalesce(money_sum("test_spend"), F.lit(0.0)).alias("test_spend"),
        F.coalesce(money_sum("control_spend"), F.lit(0.0)).alias("control_spend"),
        F.coalesce(money_sum("reward"), F.lit(0.0)).alias("reward"),
    )
    small = f"cohort_size < {min_cohort}"
    test_shown, control_shown = f"test_cards >= {min_cohort}", f"control_cards >= {min_cohort}"
    incremental = "(test_spend / test_cards - control_spend / control_cards) * test_cards"
    shown = {
        "protected_cohort_size": f"CASE WHEN NOT ({small}) THEN cohort_size END",
        "visible_test_spend": f"CASE WHEN {test_shown} THEN test_spend END",
        "visible_control_spend": f"CASE WHEN {control_shown} THEN control_spend END",
        "visible_incremental_spend": f"CASE WHEN {test_shown} AND {control_shown} THEN {incremental} END",
        "visible_reward_cost": f"CASE WHEN {test_shown} THEN reward END",
        "is_suppressed": small,
        "suppression_reason": f"CASE WHEN {small} THEN 'cohort_below_{min_cohort}' END",
    }
    return derive(cohorts, shown).select(*grain, *shown)


def exposed_small_cohorts(df: DataFrame) -> DataFrame:
    """Gate on a published cohort mart: suppressed rows that still show a figure."""
    shown = F.coalesce(*(F.col(c).cast("string") for c in ("protected_cohort_size", *VISIBLE))).isNotNull()
    return df.filter(F.col("is_suppressed") & shown)


def column_gate(df: DataFrame) -> DataFrame:
    """Columns of a mart that must not be shared, with the number of values each one exposes."""
    kinds = {c: "prohibited" for c in PROHIBITED_COLUMNS} | {c: "sensitive" for c in SENSITIVE_COLUMNS}
    found = [c for c in df.columns if c.lower() in kinds]
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *(F.count(c).alias(c) for c in found))
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c.lower()]).alias("kind"), F.col(c).alias("exposed_values"))
        for c in found
    ]
    if not cells:
        empty = F.struct(
            F.lit("").alias("column_name"), F.lit("").alias("kind"), F.lit(0).cast("bigint").alias("exposed_values")
        )
        return counts.select(F.inline(F.array(empty))).filter("false")
    return counts.select(F.inline(F.array(*cells)))


def pii_scan(df: DataFrame, columns: Sequence[str], patterns: dict[str, str] = PII_PATTERNS) -> DataFrame:
    """Matches and affected rows per text column and kind of personal data, in one pass."""
    hits = {
        f"{c}|{kind}": _gated(F.col(c), kind, F.regexp_count(F.col(c), F.lit(pattern)), F.lit(0))
        for c in columns
        for kind, pattern in patterns.items()
    }
    names = {key: f"h{i}" for i, key in enumerate(hits)}
    counted = df.select(*(expr.alias(names[key]) for key, expr in hits.items()))
    totals = counted.agg(
        *(F.sum(n).alias(f"{n}_matches") for n in names.values()),
        *(F.count_if(F.col(n) > 0).alias(f"{n}_rows") for n in names.values()),
    )
    cells = []
    for key, n in names.items():
        column, kind = key.split("|")
        cells.append(F.struct(
            F.lit(column).alias("column_name"), F.lit(kind).alias("info_type"),
            F.coalesce(F.col(f"{n}_matches"), F.lit(0)).cast("bigint").alias("match_count"),
            F.col(f"{n}_rows").alias("row_count"),
        ))
    return totals.select(F.inline(F.array(*cells)))


def pii_quotes(df: DataFrame, key: str, column: str, patterns: dict[str, str] = PII_PATTERNS) -> DataFrame:
    """Every match with its row: what was found, of which kind, where."""

    def quotes(kind: str, pattern: str):
        none = F.array().cast("array<string>")
        hits = _gated(F.col(column), kind, F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0)), none)
        return F.transform(hits, lambda q: F.struct(F.lit(kind).alias("info_type"), q.alias("quote")))

    found = [quotes(kind, pattern) for kind, pattern in patterns.items()]
    return df.select(key, F.inline(F.concat(*found)))


def masked(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Identifiers replaced by the SHA-256 of a secret salt and their text: still joinable, no longer readable.

    Without the salt a small space of ids could be listed and every hash looked up.
    """
    if not salt:
        raise ValueError("masking needs a salt")
    return df.withColumns({c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in columns})


def entitled_rows(df: DataFrame, entitlements: DataFrame, on: str = "merchant_id") -> DataFrame:
    """Each grantee's rows: a fact is visible to everyone who is entitled to its merchant."""
    return df.join(entitlements.select("grantee", on).distinct(), on)


def visible_to(df: DataFrame, entitlements: DataFrame, grantee: str, on: str = "merchant_id") -> DataFrame:
    """Row filter of one grantee."""
    mine = entitlements.filter(F.col("grantee") == grantee).select(on)
    return df.join(mine, on, "left_semi")
