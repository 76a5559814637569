"""Cleaning: keyed dedupe, safe casts, silver metadata, quarantine, set operations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import present
from ..sources.contracts import SILVER_RULES, TableSpec

RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key, chosen by an explicit order (default: the smallest remaining row image).

    Catalyst turns the rank filter into a group limit on the map side, so copies of one key,
    however many, shrink to one row per task before the shuffle.
    """
    order = list(order) or [c for c in df.columns if c not in keys]
    if not order:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def cast_present(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Cast the named columns that exist; values that do not parse become null."""
    found = {c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns}
    return df.withColumns(found) if found else df


def clean(df: DataFrame, spec: TableSpec, order: Sequence[Column | str] = ()) -> DataFrame:
    """Key present and unique; numbers, timestamps and dates in their types."""
    if spec.key in df.columns:
        df = first_per_key(df.filter(F.col(spec.key).isNotNull()), [spec.key], order)
    casts = dict.fromkeys(spec.numerics, "double")
    casts |= dict.fromkeys(spec.timestamps, "timestamp")
    casts |= dict.fromkeys(spec.dates, "date")
    return cast_present(df, casts)


def clean_strict(df: DataFrame, spec: TableSpec, needed: Sequence[str], non_negative: Sequence[str]) -> DataFrame:
    """`clean`, and rows without a needed value or with a negative amount are dropped too."""
    out = clean(df, spec).filter(present(*needed))
    for name in non_negative:
        out = out.filter(F.col(name) >= 0)
    return out


def stamp_silver(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns(
        {
            "silver_transformed_at": F.current_timestamp(),
            "silver_pipeline_run_id": F.lit(run_id),
            "quality_status": F.lit("passed"),
            "validation_rule_version": F.lit(SILVER_RULES),
        }
    )


@dataclass(frozen=True)
class RowRule:
    """A defect: rows where `bad` (SQL) is true carry `code`."""

    code: str
    message: str
    bad: str


def with_violations(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Add the array of broken rules; a condition that is unknown counts as not broken."""
    hits = F.array(
        *(
            F.when(F.expr(r.bad), F.struct(F.lit(r.code).alias("code"), F.lit(r.message).alias("message")))
            for r in rules
        )
    )
    return df.withColumn("violations", F.filter(hits, lambda v: v.isNotNull()))


def accepted(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Rows that break no rule."""
    return with_violations(df, rules).filter(F.size("violations") == 0).drop("violations")


def quarantined(df: DataFrame, rules: Sequence[RowRule], table: str, run_id: str, path: str | Column) -> DataFrame:
    """One row per broken rule with the full record as JSON."""
    record = F.to_json(F.struct(*df.columns))
    source = F.lit(path) if isinstance(path, str) else path
    return with_violations(df, rules).select(
        F.lit(table).alias("source_table_name"),
        source.alias("source_file_path"),
        F.lit(run_id).alias("pipeline_run_id"),
        record.alias("record_payload"),
        F.current_timestamp().alias("quarantined_at"),
        F.inline("violations").alias("validation_error_code", "validation_error_message"),
    )


# Columns of rows that were sorted by outcome, beside the table's own.
OUTCOME, VIOLATIONS, PAYLOAD = "_outcome", "_violations", "_record_payload"
ACCEPTED, REJECTED = "accepted", "rejected"


def contract_rules(spec: TableSpec, columns: Sequence[str]) -> list[RowRule]:
    """What the contract asks of every row: a key, and values that parse. A missing value breaks only the key rule."""
    rules = [RowRule("E01", f"{spec.key} is missing", f"{spec.key} IS NULL")] if spec.key in columns else []
    for code, what, kind, names in (
        ("E02", "number", "DOUBLE", spec.numerics), ("E03", "timestamp", "TIMESTAMP", spec.timestamps), ("E04", "date", "DATE", spec.dates),
    ):
        rules += [
            RowRule(code, f"{c} is not a {what}", f"{c} IS NOT NULL AND try_cast({c} AS {kind}) IS NULL") for c in names if c in columns]
    return rules


def sorted_out(
    df: DataFrame, spec: TableSpec, rules: Sequence[RowRule], order: Sequence[Column | str] = (), place: Sequence[str] = (),
) -> DataFrame:
    """Accepted rows, one per key and in their types, and every rejected row, told apart by OUTCOME: one scan, one shuffle.

    A rejected row keeps its broken rules and its record as JSON. `place` names columns that tell rows apart, such as
    file and row number; with them a rejected row is its own group, so it takes part in no dedupe and the group limit
    before the shuffle stays. Without them equal rejected rows count once.
    """
    marked = with_violations(df, rules).withColumnRenamed("violations", VIOLATIONS)
    bad = F.size(VIOLATIONS) > 0
    business = [c for c in df.columns if c not in place]
    alone = F.struct(*(place or business))
    marked = marked.withColumns({
        OUTCOME: F.when(bad, REJECTED).otherwise(ACCEPTED),
        PAYLOAD: F.when(bad, F.to_json(F.struct(*business))),
        "__alone": F.when(bad, alone),
    })
    keys = [spec.key, "__alone"] if spec.key in df.columns else ["__alone", *business]
    one = first_per_key(marked, keys, list(order) or [c for c in business if c != spec.key]).drop("__alone", *place)
    casts = dict.fromkeys(spec.numerics, "double") | dict.fromkeys(spec.timestamps, "timestamp") | dict.fromkeys(spec.dates, "date")
    return cast_present(one, casts)


def quarantine_records(rejected: DataFrame, table: str, run_id: str, path: Column | str = "") -> DataFrame:
    """One row per broken rule of every rejected row of `sorted_out`, in the layout of the quarantine."""
    return rejected.select(
        F.lit(table).alias("source_table_name"),
        (F.lit(path) if isinstance(path, str) else path).alias("source_file_path"),
        F.lit(run_id).alias("pipeline_run_id"),
        F.col(PAYLOAD).alias("record_payload"),
        F.current_timestamp().alias("quarantined_at"),
        F.inline(VIOLATIONS).alias("validation_error_code", "validation_error_message"),
    )


def surplus_rows(df: DataFrame, key: str, rules: Sequence[RowRule]) -> DataFrame:
    """One row: rows in, rows that break a rule, and surplus rows of repeated keys among the others.

    Counted without deduping: rows per key, added up.
    """
    bad = F.size("violations") > 0
    per_key = with_violations(df, rules).groupBy(key).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"))
    good = F.col("n") - F.col("bad")
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum("bad"), F.lit(0)).alias("rejected_count"),
        F.coalesce(F.sum(F.greatest(good - 1, F.lit(0))), F.lit(0)).alias("duplicate_count"))


def append_rows(existing: DataFrame, extra: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """UNION ALL by name; columns the extra rows lack get a default or a typed null."""
    filled = extra.withColumns({c: v for c, v in (defaults or {}).items() if c not in extra.columns})
    return existing.unionByName(filled, allowMissingColumns=True).select(*existing.columns)


def control_as_transactions(control: DataFrame, merchants: DataFrame) -> DataFrame:
    """Control-group purchases in the shape of the transaction fact."""
    places = first_per_key(merchants.select("merchant_id", "category_id", "location_id"), ["merchant_id"])
    return control.join(places, "merchant_id", "left").select(
        "transaction_id",
        "tokenized_cardmember_id",
        "merchant_id",
        "category_id",
        "location_id",
        "transaction_timestamp",
        "transaction_date",
        "transaction_amount",
        F.lit("settled").alias("transaction_status"),
        "shopper_behavior_type",
        "segment_id",
        F.lit(False).alias("is_test_group"),
        F.lit(True).alias("is_control_group"),
    )
