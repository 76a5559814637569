"""The batch jobs: raw to bronze, silver, versioned dimensions, matching and the gold marts.

Each job reads published tables, builds one lazy plan per output, writes it once beside the current
rows and validates what was written before readers see it. Published tables are the only hand-over
between jobs, so a job that lost executors or was stopped can simply be run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.exprs import stamp
from ..operators import abuse, cleaning, lineage, marts, matching, privacy, quality, risk, scd
from ..operators import incrementality as inc
from ..sources import contracts as C
from ..sources.lake import (
    LEDGER, LEDGER_SCHEMA, Lake, Published, add_source_columns, delivered_files, judged_files, without_copies,
)
from ..sources.scratch import handed_over

PARALLEL_TABLES = 4


def each(items: Iterable, job: Callable) -> list:
    """Independent tables are submitted side by side and share the cluster's free slots."""
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        return list(pool.map(job, items))


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def ingest(lake: Lake, run_id: str, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> list[Published]:
    """Raw to bronze: every raw column, source columns, event-date partitions.

    Columns that the contract does not declare are kept and fingerprinted; a declared column that is missing or has
    another type stops the table by name.
    """

    def one(spec: C.TableSpec) -> Published:
        raw = lake.read("raw", spec.name)
        ensure_declared(raw, spec)
        return lake.publish(
            add_source_columns(raw, spec.name, run_id), "bronze", spec.name, C.BRONZE_METADATA, spec.partition
        )

    return each(specs, one)


def load_new_files(lake: Lake, run_id: str, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> DataFrame:
    """Raw to bronze, new files only; returns the ledger rows of this run (files taken and files refused).

    The ledger knows every file that was taken in. New files are read alone, and of a partitioned table only the partitions
    with rows from them are written again, from their rows of other files and the new ones. Running it
    again after a stop gives the same tables: rows of files that the ledger does not know are replaced, not added.
    A file that was taken before, under its own or another path, is refused and listed; so is a file whose footer lacks a
    declared column or holds it in another type.
    """
    spark = lake.spark
    ledger = lake.read("bronze", LEDGER) if lake.exists("bronze", LEDGER) else spark.createDataFrame([], LEDGER_SCHEMA)

    def one(spec: C.TableSpec) -> DataFrame:
        judged = handed_over(without_copies(judged_files(delivered_files(lake, spec.name), ledger)), "judged-files")
        paths = [r.source_file_path for r in judged.filter("status = 'taken'").select("source_file_path").collect()]  # new files
        unfit = quality.unfit_files(spark, paths, spec.schema, lake.fmt) if paths else {}
        if len(paths) > len(unfit):
            take_in(lake, spec, run_id, [p for p in paths if p not in unfit])
        if unfit:
            listed = spark.createDataFrame(list(unfit.items()), "source_file_path string, why string")
            judged = judged.join(F.broadcast(listed), "source_file_path", "left").withColumns({
                "status": F.when(F.col("why").isNull(), F.col("status")).otherwise("refused"), "reason": F.coalesce("why", "reason")})
        return judged.select("source_table_name", "source_file_path", "file_bytes", "modified_at", "status", "reason")

    found = union(each(specs, one)).withColumn("pipeline_run_id", F.lit(run_id)).select(*ledger.columns)
    lake.publish(ledger.unionByName(found), "bronze", LEDGER)
    return lake.read("bronze", LEDGER).filter(F.col("pipeline_run_id") == run_id)


def take_in(lake: Lake, spec: C.TableSpec, run_id: str, paths: Sequence[str]) -> None:
    """Add the rows of the given raw files to a bronze table."""
    raw = lake.spark.read.format(lake.fmt).load(list(paths))
    ensure_declared(raw, spec)
    fresh = handed_over(add_source_columns(raw, spec.name, run_id), "new-rows")
    if not lake.exists("bronze", spec.name):
        lake.publish(fresh, "bronze", spec.name, C.BRONZE_METADATA, spec.partition)
        return
    others = lake.read("bronze", spec.name)
    same_file = fresh.select("source_file_path").distinct()
    if spec.partition is None or spec.partition not in fresh.columns:
        rest = others.join(F.broadcast(same_file), "source_file_path", "left_anti").select(*others.columns)
        lake.publish(rest.unionByName(fresh, allowMissingColumns=True), "bronze", spec.name, C.BRONZE_METADATA)
        return
    dates = [r[0] for r in fresh.select(spec.partition).distinct().collect()]  # a table has one partition a day
    known = F.col(spec.partition).isin([d for d in dates if d is not None])
    touched = others.filter(known | F.col(spec.partition).isNull() if None in dates else known)
    rest = touched.join(F.broadcast(same_file), "source_file_path", "left_anti").select(*others.columns)
    lake.overwrite_partitions(
        handed_over(rest.unionByName(fresh, allowMissingColumns=True), "touched-partitions"), "bronze", spec.name, spec.partition)


def ensure_declared(raw: DataFrame, spec: C.TableSpec) -> None:
    """Raise for a declared column that `raw` lacks or holds in another type. Reads the schema only."""
    held = dict(raw.dtypes)
    declared = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(spec.schema).fields}
    wrong = [f"{c}: {held.get(c, 'missing')} instead of {kind}" for c, kind in declared.items() if held.get(c) != kind]
    if wrong:
        raise ValueError(f"{spec.name} does not fit its contract: " + "; ".join(wrong))


def check_ingest(lake: Lake, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> DataFrame:
    """Raw against bronze row counts per table."""
    names = [s.name for s in specs]
    raw = lake.read_many("raw", names)
    return quality.row_counts_agree(raw, lake.read_many("bronze", names))


def rules_of(spec: C.TableSpec, columns: Sequence[str]) -> list[cleaning.RowRule]:
    return cleaning.contract_rules(spec, columns)


def refine(lake: Lake, run_id: str, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> list[Published]:
    """Bronze to silver: sort out, clean, stamp, partition by the first date column, then check.

    Rows that break their contract are written in the same pass, with their codes; `quarantine` lists them.
    """

    def one(spec: C.TableSpec) -> Published:
        bronze = lake.read("bronze", spec.name)
        order = [c for c in bronze.columns if c not in (spec.key, *C.BRONZE_METADATA)]
        placed = bronze.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        tidy = cleaning.sorted_out(placed, spec, rules_of(spec, bronze.columns), order, ("__file", "__row"))
        needed = [c for c in (spec.key, *spec.timestamps, *spec.dates, *spec.numerics, *C.SILVER_METADATA)]
        return lake.publish(cleaning.stamp_silver(tidy, run_id), "silver", spec.clean_name, needed, spec.clean_partition)

    done = each(specs, one)
    quality.ensure_passed(union([check_silver(lake, specs), check_rows_add_up(lake, specs)]))
    return done


def quarantine(lake: Lake, run_id: str, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> DataFrame:
    """The rows that the last `refine` rejected, one row per broken rule, over all tables."""
    parts = [(s.name, lake.rejected("silver", s.clean_name)) for s in specs]
    return union([
        cleaning.quarantine_records(rows, name, run_id, F.get_json_object(cleaning.PAYLOAD, "$.source_file_path")) for name, rows in parts])


def check_rows_add_up(lake: Lake, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> DataFrame:
    """Per table: bronze rows = clean + rejected rows + surplus copies, and no more clean rows than bronze rows."""

    def one(spec: C.TableSpec) -> DataFrame:
        bronze = lake.read("bronze", spec.name)
        none = F.lit(0).cast("bigint")
        rows = union([
            cleaning.surplus_rows(bronze, spec.key, rules_of(spec, bronze.columns)).select(
                "row_count", "rejected_count", "duplicate_count", none.alias("clean"), none.alias("held")),
            *(df.agg(F.count("*").alias("n")).select(
                *(none.alias(c) for c in ("row_count", "rejected_count", "duplicate_count")),
                *(F.col("n").alias(c) if c == name else none.alias(c) for c in ("clean", "held")))
              for name, df in (("clean", lake.read("silver", spec.clean_name)), ("held", lake.rejected("silver", spec.clean_name)))),
        ])
        both = rows.agg(*(F.sum(c).alias(c) for c in rows.columns))
        off = both.select(
            F.abs(F.col("row_count") - F.col("clean") - F.col("held") - F.col("duplicate_count")).alias("lost"),
            F.abs(F.col("rejected_count") - F.col("held")).alias("unlisted"),
            F.greatest(F.col("clean") - F.col("row_count"), F.lit(0)).alias("more"))
        return quality.as_rows(off, spec.clean_name, [
            ("lost", "rows_add_up", "critical"), ("unlisted", "rejected_rows_listed", "critical"), ("more", "no_more_rows_than_bronze", "critical")])

    return union([one(s) for s in specs])


def unique_rows(df: DataFrame, table: str, key: str) -> DataFrame:
    """A check row: null and surplus values of a key."""
    counted = quality.key_quality(df, table, key).select((F.col("null_count") + F.col("duplicate_count")).alias("n"))
    return quality.as_rows(counted, table, [("n", f"{key}_unique", "critical")])


def check_silver(lake: Lake, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> DataFrame:
    """Key quality of every clean table and all relations between the tables at hand."""
    clean = {s.name: lake.read("silver", s.clean_name) for s in specs}
    keys = [unique_rows(clean[s.name], s.clean_name, k) for s in specs for k in (s.key, *s.unique)]
    everything = {s.name for s in C.SOURCE_TABLES} <= set(clean)
    related = C.RELATIONS if everything else [r for r in C.RELATIONS if r.child in clean and r.parent in clean]
    return union([*keys, quality.check_relations(clean, related)]) if related else union(keys)


def version(lake: Lake, run_id: str, as_of: str | None = None, specs: Sequence[C.ScdSpec] = C.SCD_TABLES) -> None:
    """Versioned dimensions: a first snapshot, or with `as_of` a merge into the published versions."""

    def one(spec: C.ScdSpec) -> None:
        source = lake.read("silver", spec.source)
        columns = ("surrogate_scd_id", spec.key, *spec.tracked, *C.SCD_METADATA)
        if as_of is None:
            lake.publish(scd.first_snapshot(source, spec, run_id), "silver", spec.output, columns)
        else:
            state = scd.merge(lake.read("silver", spec.output), source, spec, as_of, run_id)
            lake.replace(state, "silver", spec.output, columns)

    each(specs, one)
    quality.ensure_passed(union([check_versions(lake, s) for s in specs]))


def check_versions(lake: Lake, spec: C.ScdSpec) -> DataFrame:
    versions = lake.read("silver", spec.output)
    return quality.check_scd(versions, spec).unionByName(quality.check_intervals(versions, spec))


def match(lake: Lake, run_id: str, policy: str = "flat") -> Published:
    """Matched redemptions, partitioned by transaction date. Their ids are unique, on which the marts rely."""
    rows = matching.match_redemptions(
        lake.read("silver", "fact_transactions_clean"),
        lake.read("silver", "fact_offer_activations_clean"),
        lake.read("silver", "dim_offer_clean"),
        run_id,
        policy,
    )
    return lake.publish(rows, "silver", C.MATCHED_TABLE, C.MATCHED_COLUMNS, "transaction_date", lambda written: union([
        unique_rows(written, C.MATCHED_TABLE, k) for k in ("matched_redemption_id", "transaction_id")]))


def current(lake: Lake, table: str) -> DataFrame:
    return scd.current_rows(lake.read("silver", table))


def publish_mart(
    lake: Lake, df: DataFrame, table: str, columns: Sequence[str], prefix: str, version_name: str, run_id: str,
    check: Callable[..., DataFrame], checks: Sequence[quality.Check],
) -> Published:
    """Stamp, write beside the current mart, validate, then swap; a failed check leaves the current mart as it is."""
    stamped = stamp(df, prefix, version_name, run_id).select(*columns)
    every = quality.with_metadata(checks, prefix, version_name)
    return lake.publish(stamped, "gold", table, columns, "business_date", lambda written: check(written, every))


def economics(lake: Lake, run_id: str) -> list[Published]:
    """Merchant and offer days. Clean ids are unique, so plain counts replace distinct counts."""
    matches = lake.read("silver", C.MATCHED_TABLE)
    spend = marts.merchant_daily_spend(lake.read("silver", "fact_transactions_clean"), unique_ids=True)
    rewards = marts.merchant_daily_rewards(matches, unique_ids=True)
    merchant = marts.merchant_daily_economics(spend, rewards, current(lake, "dim_merchant_scd"))
    cells = marts.offer_daily_spend(matches, unique_ids=True)
    offer = marts.offer_daily_economics(cells, current(lake, "dim_offer_scd"), current(lake, "dim_campaign_scd"))
    return [
        publish_mart(lake, merchant, "gold_merchant_daily", C.MERCHANT_DAILY_COLUMNS, "gold", C.GOLD_RULES, run_id,
                     quality.check_merchant_daily, quality.MERCHANT_DAILY_CHECKS),
        publish_mart(lake, offer, "gold_offer_daily", C.OFFER_DAILY_COLUMNS, "gold", C.GOLD_RULES, run_id,
                     quality.check_offer_daily, quality.OFFER_DAILY_CHECKS),
    ]


def incrementality(lake: Lake, run_id: str) -> Published:
    mart = inc.incrementality(
        lake.read("silver", C.MATCHED_TABLE),
        lake.read("silver", "fact_control_group_transactions_clean"),
        current(lake, "dim_offer_scd"),
        current(lake, "dim_merchant_scd"),
        unique_ids=True,
    )
    return publish_mart(
        lake, mart, "gold_offer_incrementality", C.INCREMENTALITY_COLUMNS, "incrementality", C.INCREMENTALITY_RULES,
        run_id, quality.check_incrementality, quality.INCREMENTALITY_CHECKS)


def profitability(lake: Lake, run_id: str) -> Published:
    mart = inc.features(lake.read("gold", "gold_offer_incrementality"))
    return publish_mart(
        lake, mart, "gold_incrementality_features", C.FEATURE_COLUMNS, "profitability", C.PROFITABILITY_RULES,
        run_id, quality.check_features, quality.FEATURE_CHECKS)


def cannibalization(lake: Lake, run_id: str) -> Published:
    mart = risk.cannibalization(lake.read("gold", "gold_incrementality_features"))
    return publish_mart(
        lake, mart, "gold_offer_cannibalization_risk", C.RISK_COLUMNS, "cannibalization", C.CANNIBALIZATION_RULES,
        run_id, quality.check_cannibalization, quality.CANNIBALIZATION_CHECKS)


@dataclass(frozen=True)
class Summary:
    """A gold table beside the marts: how it is built from silver tables, its grain, and what must not be in it."""

    table: str
    grain: tuple[str, ...]
    build: Callable[[Callable[[str], DataFrame]], DataFrame]
    checks: tuple[quality.Check, ...]
    partition: str | None = None


def _funnel(clean: Callable[[str], DataFrame]) -> DataFrame:
    terms = clean("dim_offer").select("offer_id", "campaign_id", "merchant_id")
    activations = clean("fact_offer_activations").drop("campaign_id", "merchant_id").join(matching.small_side(terms), "offer_id")
    return marts.offer_funnel(clean("fact_offer_impressions"), activations, clean(C.MATCHED_TABLE))


def _abuse(clean: Callable[[str], DataFrame]) -> DataFrame:
    redeemed = clean("fact_offer_redemptions").withColumnsRenamed({"redemption_timestamp": "transaction_timestamp", "redemption_date": "transaction_date"})
    events = abuse.detected_events(
        clean("fact_transactions"), redeemed, clean("fact_reward_liability"), clean("dim_merchant"), clean("dim_risk_rule"), redeemed)
    return marts.abuse_summary(events, clean(C.MATCHED_TABLE))


def _lineage(clean: Callable[[str], DataFrame]) -> DataFrame:
    day = ("transaction_date", "merchant_id")
    rows = [
        lineage.detail(clean("fact_transactions").filter("transaction_amount >= 0"), "gold_merchant_daily", "gmd", day,
                       "fact_transactions_clean", "transaction_id", "gross_spend_input"),
        lineage.detail(clean(C.MATCHED_TABLE), "gold_merchant_daily", "gmd", day, C.MATCHED_TABLE, "matched_redemption_id", "reward_cost_input"),
    ]
    return lineage.summary(union(rows), "amount >= 0", "sum per merchant and day")


def _small_cohorts() -> tuple[quality.Check, ...]:
    figures = ("protected_cohort_size", "visible_test_spend", "visible_control_spend", "visible_incremental_spend", "visible_reward_cost")
    return (quality.Check("exposed_small_cohort", "is_suppressed AND (" + " OR ".join(f"{f} IS NOT NULL" for f in figures) + ")", "critical"),)


def _not_negative(*columns: str) -> quality.Check:
    return quality.Check("negative_metric", quality.below_zero(*columns))


SUMMARIES = (
    Summary("gold_offer_funnel_daily", C.CELL, _funnel, (
        _not_negative("impressions", "activations", "redemptions", "gross_redeemed_spend", "reward_cost"),
        quality.Check("breakage_formula", "coalesce(abs(breakage_rate - (1D - redemption_rate)) > 0.0001D, true)")), "business_date"),
    Summary("gold_reward_liability_summary", (*C.CELL, "liability_owner"), lambda t: marts.liability_summary(t("fact_reward_liability")), (
        _not_negative("reward_amount", "accrued_liability", "paid_liability", "reversed_liability"),
        quality.Check("remaining_formula", "coalesce(abs(remaining_liability - (reward_amount - paid_liability - reversed_liability)) > 0.01D, true)"),
        quality.Check("funding_formula", "coalesce(abs(reward_amount - merchant_funded_amount - platform_funded_amount) > 0.01D, true)")), "business_date"),
    Summary("gold_merchant_settlement_summary", ("settlement_date", "merchant_id"), lambda t: marts.settlement_summary(t("fact_merchant_settlements")), (
        _not_negative("gross_transaction_amount", "platform_fee_amount", "settlement_count"),
        quality.Check("settlement_formula", "coalesce(abs(gross_transaction_amount - platform_fee_amount - merchant_settlement_amount) > 0.01D, true)")),
        "settlement_date"),
    Summary("gold_reconciliation_health_daily", ("reconciliation_date", "merchant_id"),
            lambda t: marts.reconciliation_health(t("fact_data_quality_reconciliation")), (
        quality.Check("counts_add_up", "transaction_count <> matched_count + mismatched_count", "critical"),
        quality.Check("invalid_rate", quality.outside_unit("match_rate"))), "reconciliation_date"),
    Summary("gold_offer_abuse_risk_summary", ("event_date", "merchant_id", "offer_id", "risk_rule_name", "risk_category", "risk_severity"), _abuse, (
        quality.Check("invalid_score", quality.outside_unit("average_risk_score")),
        quality.Check("states_over_events", "open_event_count + reviewed_event_count > risk_event_count")), "event_date"),
    Summary("gold_segment_response_summary", ("segment_id",), lambda t: marts.segment_response(
        t("fact_offer_impressions"), t("fact_offer_activations"), t(C.MATCHED_TABLE), t("dim_cardmember_token")), (
        _not_negative("cardmember_count", "impressions", "activations", "redemptions"),)),
    Summary("gold_category_performance_summary", ("category_id",), lambda t: marts.category_performance(
        t("fact_transactions"), t(C.MATCHED_TABLE), t("dim_merchant")), (_not_negative("transaction_count", "redemption_count", "reward_cost_amount"),)),
    Summary("gold_privacy_safe_offer_lift", ("merchant_id", "campaign_id"), lambda t: privacy.cohort_lift(
        t(C.MATCHED_TABLE), t("fact_control_group_transactions"), ["merchant_id", "campaign_id"]), _small_cohorts()),
    Summary("gold_metric_lineage_summary", ("gold_table_name", "gold_row_id", "source_table_name", "source_role"), _lineage, (
        quality.Check("no_source_rows", "source_row_count <= 0"),)),
)


def summaries(lake: Lake, run_id: str, wanted: Sequence[Summary] = SUMMARIES) -> list[Published]:
    """Finance, funnel, segment, abuse, privacy and lineage tables, each checked before it is swapped in."""

    def clean(name: str) -> DataFrame:
        return lake.read("silver", name if name == C.MATCHED_TABLE else f"{name}_clean")

    def one(s: Summary) -> Published:
        df = s.build(clean).withColumns({"summary_pipeline_run_id": F.lit(run_id), "summary_created_at": F.current_timestamp()})
        return lake.publish(df, "gold", s.table, s.grain, s.partition, lambda written: quality.run_checks(written, s.table, s.grain, s.checks))

    return each(wanted, one)


MART_CHECKS = (
    ("gold_merchant_daily", quality.check_merchant_daily),
    ("gold_offer_daily", quality.check_offer_daily),
    ("gold_offer_incrementality", quality.check_incrementality),
    ("gold_incrementality_features", quality.check_features),
    ("gold_offer_cannibalization_risk", quality.check_cannibalization),
)


def check_release(lake: Lake, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES) -> DataFrame:
    """Raw release: files, row counts, columns, keys, relations and money identities, as one table.

    An absent table is a failed row of its own, and fails the relations that need it.
    """
    present = {s.name: lake.exists("raw", s.name) for s in specs}
    raw = {name: lake.read("raw", name) for name, there in present.items() if there}
    parts = [quality.file_rows(lake.spark, present), *(quality.check_release(raw[s.name], s) for s in specs if s.name in raw)]
    related = [r for r in C.RELATIONS if r.child in present and r.parent in present]
    if related and raw:
        parts.append(quality.check_relations(raw, related))
    if any(t in raw for t, _, _ in quality.MONEY_FORMULAS):
        parts.append(quality.check_money(raw))
    return union(parts)


CHECK_COLUMNS = ("table_name", "check_name", "failure_count", "severity", "status")
CHECK_ROWS = "table_name string, check_name string, failure_count bigint, severity string, status string"


def report(lake: Lake, run_id: str, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES, done: Sequence[Published] = ()) -> Published:
    """All check results of a run, beside those of earlier runs, as a table of its own.

    Rows of marts that this run has published are taken from `done`; other marts are checked here.
    """
    names = [s.name for s in specs]
    layers = quality.row_counts_agree(lake.read_many("raw", names), lake.read_many("bronze", names))
    kept = [tuple(row[c] for c in CHECK_COLUMNS) for p in done for row in p.checks]
    published = {p.table for p in done if p.checks}
    parts = [
        check_release(lake, specs), quality.count_rows(layers, "raw_equals_bronze"), check_silver(lake, specs), check_rows_add_up(lake, specs),
        *(check_versions(lake, s) for s in C.SCD_TABLES if lake.exists("silver", s.output)),
        *(check(lake.read("gold", table)) for table, check in MART_CHECKS if table not in published),
    ]
    if kept:
        parts.append(lake.spark.createDataFrame(kept, CHECK_ROWS))
    results = union([p.select(*CHECK_COLUMNS) for p in parts])
    stamped = results.withColumns({"pipeline_run_id": F.lit(run_id), "checked_at": F.current_timestamp()})
    if lake.exists("gold", "check_results"):
        earlier = lake.read("gold", "check_results").filter(F.col("pipeline_run_id") != run_id)
        stamped = earlier.unionByName(stamped)
    return lake.publish(stamped, "gold", "check_results")


def run_all(lake: Lake, run_id: str, specs: Sequence[C.TableSpec] = C.SOURCE_TABLES, as_of: str | None = None) -> Published:
    """Raw to risk, end to end. With `as_of` the dimensions are merged into their published versions."""
    ingest(lake, run_id, specs)
    refine(lake, run_id, specs)
    version(lake, run_id, as_of)
    done = [match(lake, run_id), *economics(lake, run_id), incrementality(lake, run_id), profitability(lake, run_id), cannibalization(lake, run_id)]
    done += summaries(lake, run_id)
    return report(lake, run_id, specs, done)
