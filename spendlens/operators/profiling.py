"""Profiles: distributions, heavy keys, flag counts, key quality, join safety."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import derive, money_sum
from .matching import candidate_counts


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count")).orderBy(column)


def top_keys(df: DataFrame, key: str, limit: int = 10) -> DataFrame:
    """Most frequent values; ties go to the smaller value, so the cut is deterministic."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(F.desc("row_count"), key).limit(limit)


def heavy_keys(frames: Mapping[str, tuple[DataFrame, str]], limit: int = 10) -> DataFrame:
    """Most frequent values of several join keys, stacked under their labels."""
    parts = [
        top_keys(df, key, limit).select(
            F.lit(label).alias("key_name"), F.col(key).cast("string").alias("key_value"), "row_count"
        )
        for label, (df, key) in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def top_rows(df: DataFrame, order: Sequence[Column | str], keys: Sequence[str], limit: int) -> DataFrame:
    """First rows of an order, made total by the grain keys (planned as a distributed top-k)."""
    return df.orderBy(*order, *keys).limit(limit)


def flag_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How many rows carry each flag, in one row."""
    return df.agg(*(F.count_if(f).alias(f"{f.removesuffix('_flag')}_count") for f in flags))


def score_range(df: DataFrame, column: str) -> DataFrame:
    """Minimum, mean and maximum of a score."""
    return df.agg(
        F.min(column).alias("min_score"),
        (F.sum(column) / F.count(column)).alias("avg_score"),
        F.max(column).alias("max_score"),
    )


def spend_summary(df: DataFrame, by: str, amount: str = "transaction_amount") -> DataFrame:
    """Count, total, mean, minimum and maximum of an amount per group, to the cent."""
    grouped = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        money_sum(amount).alias("total"),
        F.min(amount).alias("low"),
        F.max(amount).alias("high"),
        F.count(amount).alias("n"),
    )
    out = derive(
        grouped,
        {
            "total_spend": "CAST(CAST(total AS DECIMAL(22,2)) AS DOUBLE)",
            "avg_transaction_amount": "CAST(ROUND(CAST(total AS DECIMAL(22,2)) / n, 2) AS DOUBLE)",
            "min_transaction_amount": "CAST(CAST(low AS DECIMAL(18,2)) AS DOUBLE)",
            "max_transaction_amount": "CAST(CAST(high AS DECIMAL(18,2)) AS DOUBLE)",
        },
    )
    return out.drop("total", "low", "high", "n").orderBy(by)


def funnel_totals(assignments: DataFrame, impressions: DataFrame, activations: DataFrame) -> DataFrame:
    """Funnel sizes and step rates in one row."""
    parts = [
        df.agg(*(
            (F.count(F.lit(1)) if name == own else F.lit(0).cast("bigint")).alias(name)
            for name in ("assignments", "impressions", "activations")
        ))
        for own, df in (("assignments", assignments), ("impressions", impressions), ("activations", activations))
    ]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    total = stacked.agg(*(F.sum(c).alias(c) for c in ("assignments", "impressions", "activations")))
    return derive(
        total,
        {
            "impression_rate": "CASE WHEN assignments > 0 THEN impressions / assignments END",
            "activation_rate": "CASE WHEN impressions > 0 THEN activations / impressions END",
        },
    )


def range_counters(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Any number of conditional row counts in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), *(F.count_if(F.expr(sql)).alias(name) for name, sql in conditions.items())
    )


def join_safety(tx: DataFrame, act: DataFrame, act_offers: DataFrame) -> DataFrame:
    """Is the transaction-to-offer join safe? Input sizes, candidate counts and expansion ratios.

    The candidates are counted from running sums, so the profile stays cheap on exactly the data
    for which the pair join would explode.
    """
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")

    sizes = (
        one(tx, "transactions").unionByName(one(act, "activations"))
        .unionByName(one(act_offers, "activation_offers"))
        .unionByName(
            candidate_counts(tx, act_offers)
            .agg(F.coalesce(F.sum("candidate_count"), F.lit(0)).alias("n"))
            .select(F.lit("candidates").alias("name"), "n")
        )
    )
    names = ("transactions", "activations", "activation_offers", "candidates")
    wide = sizes.agg(*(F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names))
    return derive(
        wide,
        {
            "candidates_per_transaction": "CASE WHEN transactions > 0 THEN candidates / transactions END",
            "candidates_per_activation": "CASE WHEN activations > 0 THEN candidates / activations END",
        },
    )


def period_lift(df: DataFrame, period: str, amount: str, before: str, during: str, by: str) -> DataFrame:
    """Naive before/after difference per group: weak, because seasons and trends stay in it."""
    grouped = df.groupBy(by).agg(
        F.coalesce(money_sum(F.when(F.col(period) == before, F.col(amount))), F.lit(0.0)).alias("spend_before"),
        F.coalesce(money_sum(F.when(F.col(period) == during, F.col(amount))), F.lit(0.0)).alias("spend_during"),
    )
    return derive(grouped, {"naive_lift": "spend_during - spend_before"})
