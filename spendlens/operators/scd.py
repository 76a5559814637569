"""Slowly changing dimensions (type 2): first snapshot, incremental merge, point-in-time join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import fingerprint, joined_text, require
from ..sources.contracts import SCD_FIRST_DATE, SCD_METADATA, SCD_RULES, ScdSpec
from .cleaning import first_per_key


def _surrogate(key: str) -> Column:
    return F.concat(F.lit("scd_"), F.sha2(joined_text([key, "effective_start_date", "scd_record_hash"], None), 256))


def _versions(source: DataFrame, spec: ScdSpec, start: str, run_id: str) -> DataFrame:
    """One open version per business key, starting on `start`."""
    rows = source.select(spec.key, *spec.tracked).filter(F.col(spec.key).isNotNull())
    opened = first_per_key(rows, [spec.key]).withColumns(
        {
            "effective_start_date": F.to_date(F.lit(start)),
            "effective_end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
            "scd_record_hash": fingerprint(spec.tracked, null_as="__NULL__"),
            "scd_created_at": F.current_timestamp(),
            "scd_updated_at": F.current_timestamp(),
            "scd_pipeline_run_id": F.lit(run_id),
            "scd_rule_version": F.lit(SCD_RULES),
        }
    )
    return opened.select(_surrogate(spec.key).alias("surrogate_scd_id"), spec.key, *spec.tracked, *SCD_METADATA)


def first_snapshot(source: DataFrame, spec: ScdSpec, run_id: str, start: str = SCD_FIRST_DATE) -> DataFrame:
    """Initial load: every key gets one open version."""
    require(source, (spec.key, *spec.tracked), spec.source)
    return _versions(source, spec, start, run_id)


def current_rows(scd: DataFrame) -> DataFrame:
    return scd.filter("is_current")


def merge(
    scd: DataFrame, source: DataFrame, spec: ScdSpec, as_of: str, run_id: str, close_missing: bool = False
) -> DataFrame:
    """Next state of the dimension after a new source snapshot taken on `as_of`.

    Open versions and incoming rows meet once, in a full outer join on the business key. Each
    pair yields its outcome as an array of rows: an unchanged version stays as it is; a changed
    one is closed the day before `as_of` and a new one is opened (a version opened on `as_of`
    itself is replaced); a new key opens one; a key that vanished stays open unless
    `close_missing` (then a version that opened on `as_of` or later is dropped, as it never held).
    A snapshot older than the open version is put in its place in the history: see `insert_late`.
    """
    require(source, (spec.key, *spec.tracked), spec.source)
    columns = ["surrogate_scd_id", spec.key, *spec.tracked, *SCD_METADATA]
    old = current_rows(scd).select(F.col(spec.key).alias("k"), F.struct(*columns).alias("old"))
    new = _versions(source, spec, as_of, run_id).select(F.col(spec.key).alias("k"), F.struct(*columns).alias("new"))

    last_day = F.date_sub(F.to_date(F.lit(as_of)), 1)
    closed = F.col("old").withField("effective_end_date", last_day)
    closed = closed.withField("is_current", F.lit(False)).withField("scd_updated_at", F.current_timestamp())
    same = F.col("old.scd_record_hash") == F.col("new.scd_record_hash")
    day = F.to_date(F.lit(as_of))
    late = F.col("old.effective_start_date") > day
    same_day = F.col("old.effective_start_date") == day
    none = F.slice(F.array(F.col("old")), 1, 0)
    gone = F.when(late | same_day, none).otherwise(F.array(closed)) if close_missing else F.array(F.col("old"))
    outcome = (
        F.when(F.col("old").isNull(), F.array(F.col("new")))
        .when(F.col("new").isNull(), gone)
        .when(late | same, F.array(F.col("old")))
        .when(same_day, F.array(F.col("new")))
        .otherwise(F.array(closed, F.col("new")))
    )
    reopened = old.join(new, "k", "full_outer").select(F.inline(outcome))
    history = insert_late(scd, old.join(new, "k").filter(late).select("k", "new"), spec.key, as_of, columns)
    return history.unionByName(reopened.select(*columns))


def insert_late(scd: DataFrame, late: DataFrame, key: str, as_of: str, columns: Sequence[str]) -> DataFrame:
    """Closed history with the versions of a late snapshot (k, new) between their neighbours.

    The version that held on `as_of` ends the day before and the late one takes over its end; equal content changes
    nothing; a version that started on `as_of` is replaced. Where none held, the late one ends before the next start.
    """
    day = F.to_date(F.lit(as_of))
    rest = [c for c in columns if c not in ("effective_end_date", "is_current", "scd_updated_at")]
    versions = scd.select(F.col(key).alias("k"), F.struct(*columns).alias("v"))
    start, new = F.col("v.effective_start_date"), F.col("new")
    held = new.isNotNull() & ~F.col("v.is_current") & (start <= day) & (F.col("v.effective_end_date") >= day)
    per_key = Window.partitionBy("k")
    met = versions.join(late, "k", "left").select(
        "k", "v", "new", F.coalesce(held & (F.col("v.scd_record_hash") != F.col("new.scd_record_hash")), F.lit(False)).alias("cut"),
        F.max(F.coalesce(held, F.lit(False))).over(per_key).alias("covered"),
        F.min(F.when(start > day, start)).over(per_key).alias("next"))
    # Part 1 is the row's own version, part 2 the late one; an open version only tells where an uncovered one goes.
    parts = (
        F.when(F.col("v.is_current"), F.when(new.isNotNull() & ~F.col("covered"), F.expr("array(2)")))
        .when(F.col("cut") & (start == day), F.expr("array(2)"))
        .when(F.col("cut"), F.expr("array(1, 2)"))
        .otherwise(F.expr("array(1)"))
    )
    dealt = met.select("*", F.explode(parts).alias("part"))
    two, open_row = F.col("part") == 2, F.col("v.is_current")
    return dealt.select(
        *(F.when(two, F.col(f"new.{c}")).otherwise(F.col(f"v.{c}")).alias(c) for c in rest),
        F.when(two & open_row, F.date_sub("next", 1)).when(F.col("cut") & ~two, F.date_sub(day, 1))
        .otherwise(F.col("v.effective_end_date")).alias("effective_end_date"),
        F.lit(False).alias("is_current"),
        F.when(two, F.col("new.scd_updated_at")).when(F.col("cut"), F.current_timestamp()).otherwise(F.col("v.scd_updated_at")).alias("scd_updated_at"),
    ).select(*columns)


def as_of_join(facts: DataFrame, scd: DataFrame, key: str, date_column: str, attributes: Sequence[str]) -> DataFrame:
    """Attach the attributes that were valid on each fact's date; unmatched facts stay, with nulls.

    The key is the equi condition and the validity interval its residual, so this is one hash or
    merge join. Validity intervals of a key do not overlap, hence at most one match per fact.
    """
    versions = scd.select(
        F.col(key).alias("__key"),
        F.col("effective_start_date").alias("__from"),
        F.coalesce("effective_end_date", F.to_date(F.lit("9999-12-31"))).alias("__to"),
        *attributes,
    )
    day = F.col(date_column)
    on = (F.col(key) == F.col("__key")) & (day >= F.col("__from")) & (day <= F.col("__to"))
    return facts.join(versions, on, "left").drop("__key", "__from", "__to")


FOREVER = "DATE '9999-12-31'"


def interval_faults(
    versions: DataFrame, key: str, start: str = "effective_start_date", end: str = "effective_end_date", slice_days: int = 366,
) -> DataFrame:
    """Every version that does not begin the day after the versions of its key before it end.

    key, start, end, covered_until (the latest end of all versions that begin before, or on the same day and end no later)
    and `fault`: `overlap` if the version begins on that day or earlier, `gap` if a day lies between. The end day
    belongs to a version; a null end is open. Versions of a key are laid into slices of `slice_days` by their start, and each
    slice carries on the latest end of the slices before it, so a key with a large part of all versions is many
    tasks. Rows without a key or start are no versions.
    """
    day = F.unix_date(F.col(start))
    rows = versions.select(key, start, end, F.coalesce(F.col(end), F.expr(FOREVER)).alias("__end"), F.floor(day / slice_days).alias("__slice")).filter(
        F.col(key).isNotNull() & F.col(start).isNotNull())
    within = Window.partitionBy(key, "__slice").orderBy(start, "__end").rowsBetween(Window.unboundedPreceding, -1)
    latest = rows.groupBy(key, "__slice").agg(F.max("__end").alias("__last"))
    earlier = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select(key, "__slice", F.max("__last").over(earlier).alias("__carried"))
    joined = rows.withColumn("__within", F.max("__end").over(within)).join(carried, [key, "__slice"])
    until = joined.withColumn("covered_until", F.greatest("__within", "__carried"))
    fault = F.when(F.col(start) <= F.col("covered_until"), "overlap").when(F.col(start) > F.date_add("covered_until", 1), "gap")
    return until.select(key, start, end, "covered_until", fault.alias("fault")).filter("fault IS NOT NULL")
