"""Data quality as tables: every validator returns rows (table, check, failures, severity, status)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.exprs import sql_text
from ..sources.contracts import CELL, MERCHANT_DAY, RELATIONS, Relation, ScdSpec, TableSpec
from . import incrementality as inc
from . import marts, risk
from .scd import interval_faults

MONEY_TOLERANCE = "0.01D"
RATIO_TOLERANCE = "0.0001D"


@dataclass(frozen=True)
class Check:
    """A row check: `failing` is SQL that is true on a defective row."""

    name: str
    failing: str
    severity: str = "high"


def nulls(*columns: str) -> str:
    return " OR ".join(f"{c} IS NULL" for c in columns)


def below_zero(*columns: str) -> str:
    return " OR ".join(f"{c} < 0" for c in columns)


def outside_unit(*columns: str) -> str:
    return " OR ".join(f"{c} < 0 OR {c} > 1" for c in columns)


def not_in(column: str, *values: str) -> str:
    return f"{column} NOT IN ({', '.join(sql_text(v) for v in values)})"


def off(formulas: Mapping[str, str], tolerance: str, *columns: str) -> str:
    """Stored value away from its own formula by more than the tolerance; a null counts as off."""
    return " OR ".join(f"coalesce(abs({c} - ({formulas[c]})) > {tolerance}, true)" for c in columns)


def differs(formulas: Mapping[str, str], *columns: str) -> str:
    """Stored label or flag unlike its formula, nulls compared as values."""
    return " OR ".join(f"NOT ({c} <=> ({formulas[c]}))" for c in columns)


def result_rows(totals: DataFrame, names: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Turn one row of counters into check rows: (counter column, table, check, severity) each."""
    cells = F.array(
        *(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(check).alias("check_name"),
                F.coalesce(F.col(counter), F.lit(0)).cast("bigint").alias("failure_count"),
                F.lit(severity).alias("severity"),
            )
            for counter, table, check, severity in names
        )
    )
    rows = totals.select(F.inline(cells))
    status = F.when(F.col("failure_count") == 0, "passed").otherwise("failed")
    return rows.withColumn("status", status)


def as_rows(totals: DataFrame, table: str, names: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Check rows of a single table: (counter column, check, severity) each."""
    return result_rows(totals, [(counter, table, check, severity) for counter, check, severity in names])


def run_checks(df: DataFrame, table: str, grain: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """All row checks and the grain check of one table in a single pass.

    The first aggregation counts rows and failures per grain key (partially before the shuffle),
    the second adds them up, so the table is scanned once however many checks there are.
    """
    counters = [(f"__c{i}", c.name, c.severity) for i, c in enumerate(checks)]
    per_key = df.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("__n"),
        *(F.count_if(F.expr(c.failing)).alias(name) for (name, _, _), c in zip(counters, checks)),
    )
    totals = per_key.agg(
        F.count_if(F.col("__n") > 1).alias("__duplicates"), *(F.sum(name).alias(name) for name, _, _ in counters)
    )
    return as_rows(totals, table, [("__duplicates", "duplicate_grain", "critical"), *counters])


MERCHANT_DAILY_CHECKS = (
    Check("null_required", nulls(
        "business_date", "merchant_id", "transaction_count", "gross_spend_amount", "reward_cost_amount",
        "platform_fee_amount", "estimated_merchant_margin_amount", "merchant_net_after_reward"), "critical"),
    Check("negative_metric", below_zero(
        "transaction_count", "gross_spend_amount", "average_transaction_amount", "matched_redemption_count",
        "redeemed_transaction_count", "reward_cost_amount", "average_reward_amount", "platform_fee_amount",
        "estimated_merchant_margin_amount")),
    Check("invalid_rate", outside_unit("redemption_rate", "merchant_margin_rate", "platform_fee_rate")),
    Check("redeemed_over_transactions", "redeemed_transaction_count > transaction_count"),
    Check("formula_mismatch", off(marts.MERCHANT_DAILY, MONEY_TOLERANCE,
          "platform_fee_amount", "estimated_merchant_margin_amount", "merchant_net_after_reward")),
)
OFFER_DAILY_CHECKS = (
    Check("null_required", nulls(
        "business_date", "offer_id", "campaign_id", "merchant_id", "matched_redemption_count",
        "redeemed_transaction_count", "gross_redeemed_spend_amount", "reward_cost_amount",
        "reward_to_redeemed_spend_ratio"), "critical"),
    Check("negative_metric", below_zero(
        "matched_redemption_count", "redeemed_transaction_count", "gross_redeemed_spend_amount",
        "reward_cost_amount", "average_redeemed_transaction_amount", "average_reward_amount",
        "minimum_spend_amount", "reward_amount")),
    Check("invalid_ratio", outside_unit("reward_to_redeemed_spend_ratio")),
    Check("redeemed_over_matched", "redeemed_transaction_count > matched_redemption_count"),
    Check("formula_mismatch", off(marts.OFFER_DAILY, RATIO_TOLERANCE, "reward_to_redeemed_spend_ratio")),
)
INCREMENTALITY_CHECKS = (
    Check("null_required", nulls(
        "business_date", "offer_id", "campaign_id", "merchant_id", "test_cardmember_count",
        "control_cardmember_count", "total_test_spend_amount", "total_control_spend_amount",
        "average_test_spend_per_cardmember", "average_control_spend_per_cardmember", "lift_per_cardmember",
        "incremental_revenue_amount"), "critical"),
    Check("invalid_count", "test_cardmember_count <= 0 OR control_cardmember_count <= 0 OR " + below_zero(
        "test_transaction_count", "test_redemption_count", "control_transaction_count")),
    Check("negative_amount", below_zero(
        "total_test_spend_amount", "total_test_reward_amount", "total_control_spend_amount",
        "average_test_spend_per_cardmember", "average_test_reward_per_redemption",
        "average_control_spend_per_cardmember", "minimum_spend_amount", "reward_amount")),
    Check("invalid_rate", outside_unit("merchant_margin_rate", "platform_fee_rate")
          + " OR test_to_control_spend_ratio < 0"),
    Check("invalid_direction", not_in("lift_direction", "positive_lift", "negative_lift", "no_lift") + " OR "
          + not_in("incremental_revenue_direction", "positive_incremental_revenue",
                   "negative_incremental_revenue", "no_incremental_revenue")),
    Check("lift_formula", off(inc.LIFT, MONEY_TOLERANCE, "lift_per_cardmember")),
    Check("revenue_formula", off(inc.SCALED, MONEY_TOLERANCE, "incremental_revenue_amount")),
    Check("lift_percentage_formula", off(inc.SCALED, RATIO_TOLERANCE, "lift_percentage")),
    Check("value_formula", off(inc.VALUED, MONEY_TOLERANCE, "estimated_incremental_margin_amount",
          "estimated_incremental_platform_fee_amount", "estimated_incremental_value_after_reward")),
)
FEATURE_CHECKS = (
    Check("null_required", nulls(
        "business_date", "offer_id", "campaign_id", "merchant_id", "incremental_revenue_amount",
        "funded_reward_cost_amount", "estimated_incremental_margin_amount",
        "estimated_incremental_platform_fee_amount", "net_merchant_profit_amount", "profitability_status",
        "efficiency_status"), "critical"),
    Check("invalid_rate", outside_unit("normalized_merchant_margin_rate", "normalized_platform_fee_rate",
          "merchant_margin_rate", "platform_fee_rate")),
    Check("negative_cost", below_zero("funded_reward_cost_amount", "total_test_reward_amount",
          "total_offer_cost_amount", "minimum_spend_amount", "reward_amount")),
    Check("invalid_profitability_status",
          not_in("profitability_status", "profitable", "unprofitable", "break_even")),
    Check("invalid_efficiency_status", not_in("efficiency_status", "highly_efficient", "efficient",
          "profitable_but_low_efficiency", "revenue_positive_but_profit_negative", "negative_incrementality",
          "needs_review")),
    Check("margin_formula", off(inc.BASE, MONEY_TOLERANCE, "estimated_incremental_margin_amount")),
    Check("cogs_formula", off(inc.BASE, MONEY_TOLERANCE, "estimated_incremental_cogs_amount")),
    Check("platform_fee_formula", off(inc.BASE, MONEY_TOLERANCE, "platform_fee_revenue_base_amount",
          "estimated_incremental_platform_fee_amount")),
    Check("net_profit_formula", off(inc.NET, MONEY_TOLERANCE, "net_merchant_profit_amount")),
    Check("total_cost_formula", off(inc.ROAS, MONEY_TOLERANCE, "total_offer_cost_amount")),
    Check("roas_formula", off(inc.ROAS, RATIO_TOLERANCE, "reward_roas", "total_cost_roas", "margin_roas",
          "net_profit_roas")),
    Check("profitability_label", differs(inc.CLASSES, "profitability_status")),
    Check("decision_flags", differs(inc.CLASSES, "profitable_incremental_offer_flag",
          "spend_lift_but_profit_loss_flag", "negative_lift_and_unprofitable_flag")),
)
CANNIBALIZATION_CHECKS = (
    Check("null_required", nulls(
        "business_date", "offer_id", "campaign_id", "merchant_id", "incremental_revenue_amount",
        "net_merchant_profit_amount", "cannibalization_risk_score", "cannibalization_risk_level",
        "primary_cannibalization_risk_driver", "cannibalization_risk_reason",
        "cannibalization_action_recommendation", "requires_merchant_review_flag",
        "requires_offer_redesign_flag", "safe_to_scale_flag"), "critical"),
    Check("invalid_risk_level", not_in("cannibalization_risk_level", "low", "medium", "high", "critical")),
    Check("invalid_primary_driver", not_in("primary_cannibalization_risk_driver",
          *(name for name, _, _ in risk.DRIVERS), risk.OTHER_DRIVER[0])),
    Check("negative_score", "cannibalization_risk_score < 0"),
    Check("risk_points", differs(risk.SCORE, *(f"{s.name}_risk_points" for s in risk.SIGNALS))),
    Check("risk_score", differs(risk.SCORE, "cannibalization_risk_score")),
    Check("risk_level", differs(risk.DECISION, "cannibalization_risk_level")),
    Check("merchant_review_flag", differs(risk.DECISION, "requires_merchant_review_flag")),
    Check("offer_redesign_flag", differs(risk.DECISION, "requires_offer_redesign_flag")),
    Check("safe_to_scale_flag", differs(risk.DECISION, "safe_to_scale_flag")),
    Check("primary_driver", differs(risk.REASON, "primary_cannibalization_risk_driver")),
)


def with_metadata(checks: Sequence[Check], prefix: str, rule_version: str) -> tuple[Check, ...]:
    """Checks of a published mart: its metadata must be there and of the expected rule version."""
    triplet = [f"{prefix}_pipeline_run_id", f"{prefix}_rule_version", f"{prefix}_created_at"]
    return (
        *checks,
        Check("null_metadata", nulls(*triplet), "critical"),
        Check("rule_version", f"{prefix}_rule_version <> {sql_text(rule_version)}"),
    )


def check_merchant_daily(df: DataFrame, checks: Sequence[Check] = MERCHANT_DAILY_CHECKS) -> DataFrame:
    return run_checks(df, "gold_merchant_daily", MERCHANT_DAY, checks)


def check_offer_daily(df: DataFrame, checks: Sequence[Check] = OFFER_DAILY_CHECKS) -> DataFrame:
    return run_checks(df, "gold_offer_daily", CELL, checks)


def check_incrementality(df: DataFrame, checks: Sequence[Check] = INCREMENTALITY_CHECKS) -> DataFrame:
    return run_checks(df, "gold_offer_incrementality", CELL, checks)


def check_features(df: DataFrame, checks: Sequence[Check] = FEATURE_CHECKS) -> DataFrame:
    return run_checks(df, "gold_incrementality_features", CELL, checks)


def check_cannibalization(df: DataFrame, checks: Sequence[Check] = CANNIBALIZATION_CHECKS) -> DataFrame:
    return run_checks(df, "gold_offer_cannibalization_risk", CELL, checks)


def check_scd(scd: DataFrame, spec: ScdSpec) -> DataFrame:
    """Version table checks: required values, intervals, exactly one open version per key, unique ids.

    Keys without any open version are counted as well.
    """
    required = nulls(
        "surrogate_scd_id", spec.key, "effective_start_date", "is_current", "scd_record_hash",
        "scd_pipeline_run_id", "scd_rule_version", "scd_created_at", "scd_updated_at")
    per_key = scd.groupBy(spec.key).agg(
        F.count_if(F.expr(required)).alias("null_required"),
        F.count_if(F.expr("effective_end_date < effective_start_date")).alias("end_before_start"),
        F.count_if(F.expr("is_current AND effective_end_date IS NOT NULL")).alias("current_with_end_date"),
        F.count_if("is_current").alias("open"),
    )
    summed = ("null_required", "end_before_start", "current_with_end_date")
    totals = per_key.agg(
        *(F.sum(c).alias(c) for c in summed), F.count_if(F.col("open") != 1).alias("not_exactly_one_current"))
    ids = scd.groupBy("surrogate_scd_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = ids.agg(F.count_if(F.col("n") > 1).alias("duplicate_surrogate"))
    severity = {"end_before_start": "high", "current_with_end_date": "high"}
    rows = as_rows(totals, spec.output, [
        (c, c, severity.get(c, "critical")) for c in (*summed, "not_exactly_one_current")])
    return rows.unionByName(as_rows(repeated, spec.output, [("duplicate_surrogate", "duplicate_surrogate", "critical")]))


def check_intervals(scd: DataFrame, spec: ScdSpec) -> DataFrame:
    """Version table checks: versions of a key follow each other without overlap and without a gap."""
    counted = interval_faults(scd, spec.key).agg(
        F.count_if(F.col("fault") == "overlap").alias("overlaps"), F.count_if(F.col("fault") == "gap").alias("gaps"))
    return as_rows(counted, spec.output, [("overlaps", "overlapping_versions", "critical"), ("gaps", "gaps_between_versions", "high")])


# --------------------------------------------------------------- keys, relations, money formulas


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null child keys that no parent row has."""
    keys = child.select(F.col(column).alias("orphan_key")).filter("orphan_key IS NOT NULL").distinct()
    known = parent.select(F.col(parent_column).alias("orphan_key"))
    return keys.join(known, "orphan_key", "left_anti")


def check_relations(tables: Mapping[str, DataFrame], relations: Sequence[Relation] = RELATIONS) -> DataFrame:
    """Orphan counts of all relations; a relation with an absent table fails.

    Relations to the same parent column share one anti join: their child keys are stacked under
    the relation's number, so a parent is scanned and shuffled once.
    """
    known = [r for r in relations if r.child in tables and r.parent in tables]
    absent = [r for r in relations if r not in known]
    parts = []
    if absent:
        spark = next(iter(tables.values())).sparkSession
        lost = spark.range(1).select(F.lit(1).alias("absent"))
        parts.append(result_rows(lost, [("absent", r.child, f"{r.name}: table absent", "critical") for r in absent]))
    for parent, column in dict.fromkeys((r.parent, r.parent_column) for r in known):
        group = [r for r in known if (r.parent, r.parent_column) == (parent, column)]
        keys = [
            tables[r.child].select(F.col(r.child_column).alias("orphan_key")).filter("orphan_key IS NOT NULL")
            .distinct().withColumn("relation", F.lit(i))
            for i, r in enumerate(group)
        ]
        stacked = reduce(DataFrame.unionByName, keys)
        lost = stacked.join(tables[parent].select(F.col(column).alias("orphan_key")), "orphan_key", "left_anti")
        totals = lost.agg(*(F.count_if(F.col("relation") == i).alias(f"r{i}") for i in range(len(group))))
        parts.append(result_rows(totals, [(f"r{i}", r.child, r.name, "critical") for i, r in enumerate(group)]))
    return reduce(DataFrame.unionByName, parts)


def duplicate_grain(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def key_quality(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows, null keys and surplus rows of a key column, in one row.

    Grouping by the key first keeps the count of distinct keys distributed, also for a hot key.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_count"),
    )


def check_release(df: DataFrame | None, spec: TableSpec) -> DataFrame | None:
    """Raw release checks of one table: present, not empty, complete, key unique and not null.

    Returns None only for a table that is absent; `file_rows` reports those.
    """
    if df is None:
        return None
    expected = [part.strip().split(" ")[0] for part in spec.schema.split(",")]
    missing = len([c for c in expected if c not in df.columns])
    if spec.key not in df.columns:
        totals = df.agg(F.count(F.lit(1)).alias("n")).select(
            (F.col("n") == 0).cast("int").alias("empty"), F.lit(missing).alias("missing"), F.col("n").alias("bad_key")
        )
    else:
        quality = key_quality(df, spec.name, spec.key)
        totals = quality.select(
            (F.col("row_count") == 0).cast("int").alias("empty"), F.lit(missing).alias("missing"),
            (F.col("null_count") + F.col("duplicate_count")).alias("bad_key"),
        )
    return as_rows(totals, spec.name, [
        ("empty", "minimum_row_count", "critical"),
        ("missing", "required_columns", "critical"),
        ("bad_key", "primary_key_uniqueness", "critical"),
    ])


def file_rows(spark, present: Mapping[str, bool]) -> DataFrame:
    """A check row for each table: whether it exists."""
    lost = spark.createDataFrame([tuple(int(not there) for there in present.values())], [f"t{i}" for i in range(len(present))])
    return result_rows(lost, [(f"t{i}", name, "file_exists", "critical") for i, name in enumerate(present)])


def count_rows(counts: DataFrame, check: str, at_most: bool = False) -> DataFrame:
    """Check rows from `row_counts_agree`: how many rows the layers differ by, or the second has too many."""
    surplus = F.col("target_rows") - F.col("source_rows")
    off = F.greatest(surplus, F.lit(0)) if at_most else F.abs(surplus)
    rows = counts.select("table_name", F.lit(check).alias("check_name"), off.cast("bigint").alias("failure_count"), F.lit("critical").alias("severity"))
    return rows.withColumn("status", F.when(F.col("failure_count") == 0, "passed").otherwise("failed"))


# The money identities of the finance tables.
MONEY_FORMULAS = (
    ("fact_reward_liability", "reward_funding_split",
     "merchant_funded_amount + platform_funded_amount - reward_amount"),
    ("fact_merchant_settlements", "merchant_settlement_amount_formula",
     "gross_transaction_amount - platform_fee_amount - merchant_settlement_amount"),
    ("fact_merchant_settlements", "merchant_net_after_reward_formula",
     "merchant_settlement_amount - merchant_funded_amount - merchant_net_after_reward"),
    ("fact_data_quality_reconciliation", "reconciliation_delta_formula",
     "transaction_amount - merchant_settlement_amount - platform_fee_amount - settlement_delta"),
)


def check_money(tables: Mapping[str, DataFrame], tolerance: str = MONEY_TOLERANCE) -> DataFrame:
    """The money identities of all finance tables at hand, one scan per table.

    A difference is taken in whole ten-thousandths, so binary noise cannot cross the tolerance.
    """
    parts = []
    for table in dict.fromkeys(t for t, _, _ in MONEY_FORMULAS):
        if table not in tables:
            continue
        rules = [(check, residue) for t, check, residue in MONEY_FORMULAS if t == table]
        totals = tables[table].agg(*(
            F.count_if(F.expr(f"round(abs({residue}), 4) > {tolerance}")).alias(check) for check, residue in rules
        ))
        parts.append(as_rows(totals, table, [(check, check, "high") for check, _ in rules]))
    return reduce(DataFrame.unionByName, parts)


def check_rows(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Row checks without a grain: one aggregate, no shuffle of rows."""
    names = [(f"__c{i}", c.name, c.severity) for i, c in enumerate(checks)]
    totals = df.agg(*(F.count_if(F.expr(c.failing)).alias(n) for (n, _, _), c in zip(names, checks)))
    return as_rows(totals, table, names)


def row_counts_agree(layer_a: Mapping[str, DataFrame], layer_b: Mapping[str, DataFrame], at_most: bool = False):
    """Rows per table in two layers; equal, or with `at_most` not more in the second one."""
    parts = []
    for name, a in layer_a.items():
        both = a.agg(F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("m")).unionByName(
            layer_b[name].agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("m"))
        )
        parts.append(both.agg(
            F.lit(name).alias("table_name"), F.sum("n").alias("source_rows"), F.sum("m").alias("target_rows")
        ))
    ok = F.col("target_rows") <= F.col("source_rows") if at_most else F.col("target_rows") == F.col("source_rows")
    return reduce(DataFrame.unionByName, parts).withColumn("status", F.when(ok, "passed").otherwise("failed"))


# -------------------------------------------------------------------------- drift, gates, summary


def schema_drift(df: DataFrame, expected: str) -> DataFrame:
    """Expected against actual columns, with the number of non-null values each one carries.

    One row per column: `matched`, `missing`, `unexpected` or `type_changed`.
    """
    wanted = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(expected).fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(*(F.count(F.col(c)).alias(c) for c in actual))
    cells = []
    for name in dict.fromkeys([*wanted, *actual]):
        if name not in actual:
            verdict = "missing"
        elif name not in wanted:
            verdict = "unexpected"
        else:
            verdict = "matched" if wanted[name] == actual[name] else "type_changed"
        cells.append(F.struct(
            F.lit(name).alias("column_name"),
            F.lit(wanted.get(name)).cast("string").alias("expected_type"),
            F.lit(actual.get(name)).cast("string").alias("actual_type"),
            F.lit(verdict).alias("drift"),
            (F.col(name) if name in actual else F.lit(0).cast("bigint")).alias("value_count"),
        ))
    return counts.select(F.inline(F.array(*cells)))


FOOTER_READERS = 16


def _column_types(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def file_columns(spark, paths: Sequence[str], fmt: str = "parquet") -> dict[str, dict[str, str]]:
    """Columns and types of each file, from its footer alone; several files at a time."""
    with ThreadPoolExecutor(FOOTER_READERS) as pool:
        return dict(zip(paths, pool.map(lambda p: _column_types(spark.read.format(fmt).load(p).schema), paths)))


def drift_of_files(spark, paths: Sequence[str], expected: str, fmt: str = "parquet") -> DataFrame:
    """Expected against actual columns of single files: only their footers are read, no rows and no merged schema.

    One row for each column and state it has in some files: column_name, expected_type, actual_type, drift (as in
    `schema_drift`), file_count and first_path. Files whose types differ from each other are no error here. Meant for the
    new files of a load.
    """
    wanted = _column_types(StructType.fromDDL(expected))
    states: dict[tuple, list[str]] = {}
    for path, actual in file_columns(spark, sorted(paths), fmt).items():
        for name in dict.fromkeys([*wanted, *actual]):
            have, want = actual.get(name), wanted.get(name)
            verdict = "missing" if have is None else "unexpected" if want is None else "matched" if have == want else "type_changed"
            states.setdefault((name, want, have, verdict), []).append(path)
    rows = [(*state, len(found), found[0]) for state, found in states.items()]
    return spark.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string, drift string, file_count bigint, first_path string")


def unfit_files(spark, paths: Sequence[str], expected: str, fmt: str = "parquet") -> dict[str, str]:
    """Files that lack a declared column or hold it in another type, and why. New columns fit."""
    wanted = _column_types(StructType.fromDDL(expected))
    wrong = {}
    for path, actual in file_columns(spark, paths, fmt).items():
        why = [f"{c}: {actual.get(c, 'missing')} instead of {kind}" for c, kind in wanted.items() if actual.get(c) != kind]
        if why:
            wrong[path] = "; ".join(why)
    return wrong


# What a failure of each severity leads to.
ACTIONS = (("critical", "fail"), ("high", "quarantine"), ("medium", "flag"), ("low", "warn"))


def summarize(checks: DataFrame) -> DataFrame:
    """Total, passed and failed checks."""
    return checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "passed").alias("passed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )


def promotion(checks: DataFrame) -> DataFrame:
    """Per table: the strictest action its failed checks ask for, and whether it may move on.

    A failure of a severity that is null or not listed counts as critical.
    """
    order = F.when(F.col("status") == "passed", len(ACTIONS))
    for i, (severity, _) in enumerate(ACTIONS):
        order = order.when(F.col("severity") == severity, i)
    worst = checks.withColumn("__order", order.otherwise(0)).groupBy("table_name").agg(
        F.min("__order").alias("__order"), F.count_if(F.col("status") == "failed").alias("failed_checks")
    )
    action = F.lit("promote")
    for i, (_, name) in enumerate(ACTIONS):
        action = F.when(F.col("__order") == i, name).otherwise(action)
    return worst.select(
        "table_name", "failed_checks", action.alias("action"), (F.col("__order") >= 2).alias("may_promote")
    )


def ensure_passed(checks: DataFrame) -> None:
    """Action: raise if any check failed. Only failed rows (bounded by the rule list) are fetched."""
    failed = checks.filter("status = 'failed'").collect()
    if failed:
        raise ValueError(
            "failed checks: " + "; ".join(f"{r.table_name}.{r.check_name}={r.failure_count}" for r in failed)
        )


# ------------------------------------------------------------------------- test/control integrity


def mixed_groups(assignments: DataFrame) -> DataFrame:
    """Cards assigned to both test and control of one offer."""
    grouped = assignments.groupBy("tokenized_cardmember_id", "offer_id").agg(
        F.count_if(F.col("assignment_group") == "test").alias("test_assignments"),
        F.count_if(F.col("assignment_group") == "control").alias("control_assignments"),
    )
    return grouped.filter("test_assignments > 0 AND control_assignments > 0")


def exposed_controls(assignments: DataFrame, impressions: DataFrame) -> DataFrame:
    """Control assignments whose card nevertheless saw the offer."""
    keys = ["tokenized_cardmember_id", "offer_id"]
    control = assignments.filter("assignment_group = 'control'")
    return control.join(impressions.select(*keys), keys, "left_semi")


def control_without_assignment(control: DataFrame, assignments: DataFrame) -> DataFrame:
    """Control purchases of cards that hold no control assignment for the offer."""
    keys = ["tokenized_cardmember_id", "offer_id"]
    assigned = assignments.filter("assignment_group = 'control'").select(*keys)
    return control.join(assigned, keys, "left_anti")
