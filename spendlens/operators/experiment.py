"""Experiment design and reading: control matching, significance, balance, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.exprs import derive

# Quality a matched pair must reach, and the normal quantile of a 95 % interval.
MATCH_THRESHOLD = 0.75
Z_95 = 1.96


def _cents(column: str) -> Column:
    return F.rint(F.col(column) * 100).cast("bigint")


def moments(df: DataFrame, by: Sequence[str], value: str, prefix: str) -> DataFrame:
    """Count, mean and sample variance per group from exact integer sums of cents."""
    exact = _cents(value)
    squares = F.sum(exact.cast("decimal(19,0)") * exact.cast("decimal(19,0)"))
    grouped = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.sum(exact).alias("s"), squares.cast("double").alias("q")
    )
    out = derive(
        grouped,
        {
            f"{prefix}_n": "n",
            f"{prefix}_mean": "s / 100D / n",
            f"{prefix}_var": "CASE WHEN n > 1 THEN greatest(0D, (q - CAST(s AS DOUBLE) * s / n) / (n - 1)) / 10000D END",
        },
    )
    return out.drop("n", "s", "q")


def spend_per_card(df: DataFrame, by: Sequence[str], amount: str = "transaction_amount") -> DataFrame:
    """The unit of an experiment is the card: total spend per card and group."""
    return df.groupBy(*by, "tokenized_cardmember_id").agg((F.sum(_cents(amount)) / F.lit(100.0)).alias("spend"))


def significance(test: DataFrame, control: DataFrame, by: Sequence[str]) -> DataFrame:
    """Difference of mean spend per card with standard error, 95 % interval and verdict."""
    t = moments(spend_per_card(test, by), by, "spend", "test")
    c = moments(spend_per_card(control, by), by, "spend", "control")
    return derive(
        t.join(c, list(by)),
        {
            "mean_difference": "test_mean - control_mean",
            "standard_error": "sqrt(test_var / test_n + control_var / control_n)",
            "ci_low": f"mean_difference - {Z_95}D * standard_error",
            "ci_high": f"mean_difference + {Z_95}D * standard_error",
            "is_significant": "ci_low > 0 OR ci_high < 0",
        },
    )


def balance(test: DataFrame, control: DataFrame, by: Sequence[str]) -> DataFrame:
    """Standardized mean difference of pre-period spend; above 0.1 in size the groups differ."""
    t = moments(spend_per_card(test, by), by, "spend", "test")
    c = moments(spend_per_card(control, by), by, "spend", "control")
    return derive(
        t.join(c, list(by)),
        {
            "standardized_difference":
                "CASE WHEN test_var + control_var > 0 "
                "THEN (test_mean - control_mean) / sqrt((test_var + control_var) / 2D) END",
            "is_balanced": "abs(standardized_difference) <= 0.1D",
        },
    )


def outliers(df: DataFrame, by: Sequence[str], sigmas: float = 3.0) -> DataFrame:
    """Cards whose spend is more than `sigmas` deviations from their group's mean.

    Two distributed passes (moments, then a join back) instead of collecting a group to sort it.
    """
    cards = spend_per_card(df, by)
    stats = moments(cards, by, "spend", "group").select(*by, "group_mean", "group_var")
    joined = cards.join(stats, list(by))
    far = F.abs(F.col("spend") - F.col("group_mean")) > sigmas * F.sqrt("group_var")
    return joined.filter(far).select(*by, "tokenized_cardmember_id", "spend", "group_mean", "group_var")


# How far from the quartiles, in quartile ranges, a spend is an outlier; ranks of a sketch are exact to 1 / ACCURACY.
FENCE, ACCURACY = 1.5, 10_000


def spend_quantiles(df: DataFrame, by: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """Quartiles of the cards' spend per group and the fences around them, from mergeable sketches.

    No group is sorted or gathered: partial sketches are merged, so a hot group costs no more than others. A quantile
    is a spend whose rank is off by at most one in `accuracy`; in groups of fewer cards it is exact.
    """
    cards = spend_per_card(df, by)
    sketch = F.percentile_approx("spend", [0.25, 0.5, 0.75], accuracy)
    grouped = cards.groupBy(*by).agg(F.count("spend").alias("card_count"), sketch.alias("q"))
    return derive(grouped, {
        "first_quartile": "q[0]", "median_spend": "q[1]", "third_quartile": "q[2]",
        "lower_fence": f"first_quartile - {FENCE}D * (third_quartile - first_quartile)",
        "upper_fence": f"third_quartile + {FENCE}D * (third_quartile - first_quartile)",
    }).drop("q")


def quantile_outliers(df: DataFrame, by: Sequence[str], accuracy: int = ACCURACY) -> DataFrame:
    """Cards whose spend lies outside their group's fences, which a few huge spends do not move as they move a mean."""
    fences = spend_quantiles(df, by, accuracy)
    joined = spend_per_card(df, by).join(fences, list(by))
    far = (F.col("spend") < F.col("lower_fence")) | (F.col("spend") > F.col("upper_fence"))
    return joined.filter(far).select(*by, "tokenized_cardmember_id", "spend", "median_spend", "lower_fence", "upper_fence")


def match_controls(
    test: DataFrame, control: DataFrame, exact: Sequence[str], tolerances: Mapping[str, float],
    key: str = "tokenized_cardmember_id", threshold: float = MATCH_THRESHOLD,
) -> DataFrame:
    """Pair each test card with at most one control card, and each control card at most once.

    The score of a pair is one minus its mean feature distance in units of the tolerances. Cards
    are put into strata: equal in the exact features, and in the same step of every numeric one,
    steps being `(1 - threshold) * tolerance` wide. Any two cards of a stratum then reach the
    threshold, so no pair is formed only to be dropped. Inside a stratum both groups are lined
    up by position and joined on it: one to one, without building all pairs.
    """
    steps = {f: (1.0 - threshold) * width for f, width in tolerances.items()}
    bands = {f"__{f}": F.floor(F.col(f) / F.lit(step)) for f, step in steps.items()}
    strata = [*exact, *bands]

    def lined_up(df: DataFrame, prefix: str) -> DataFrame:
        complete = df.select(key, *exact, *tolerances).dropna()
        numbered = number_within(complete.withColumns(bands), strata, key)
        return numbered.select(
            *strata, "position", F.col(key).alias(f"{prefix}_{key}"),
            *(F.col(f).alias(f"{prefix}_{f}") for f in tolerances),
        )

    pairs = lined_up(test, "test").join(lined_up(control, "control"), [*strata, "position"])
    distance = " + ".join(f"abs(test_{f} - control_{f}) / {float(w)}D" for f, w in tolerances.items())
    scored = derive(pairs, {"match_quality_score": f"1D - ({distance}) / {len(tolerances)}D"})
    return scored.select(*exact, f"test_{key}", f"control_{key}", "match_quality_score")


def number_within(df: DataFrame, groups: Sequence[str], key: str, slices: int = 64) -> DataFrame:
    """1-based position of each row in its group, ordered by key slice and key.

    A group is cut into hash slices that are numbered independently; the offset of a slice is the
    number of rows in the slices before it. No task sorts a whole group.
    """
    number = F.xxhash64(key) if isinstance(df.schema[key].dataType, StringType) else F.col(key)
    sliced = df.withColumn("__slice", F.pmod(number, F.lit(slices)))
    within = Window.partitionBy(*groups, "__slice").orderBy(key)
    sizes = sliced.groupBy(*groups, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    null_safe = offsets.select("__offset", *(F.col(c).alias(f"__g_{c}") for c in [*groups, "__slice"]))
    ranked = sliced.withColumn("__row", F.row_number().over(within))
    on = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in [*groups, "__slice"]]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    joined = ranked.join(null_safe, condition)
    return joined.withColumn("position", F.col("__row") + F.col("__offset")).select(*df.columns, "position")
