"""Quarantine, loads of new files, checks before a swap and the history of checks, on a small feed."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from spendlens.operators import cleaning, quality
from spendlens.plans import pipeline
from spendlens.sources import lake as L
from spendlens.sources.contracts import TableSpec

FEED = TableSpec(
    "feed", "id", "id string, at string, day string, amount string, note string", partition="day", timestamps=("at",), dates=("day",), numerics=("amount",))
ROWS = [
    ("a", "2024-01-01 10:00:00", "2024-01-01", "1.5", "x"), ("a", "2024-01-01 10:00:00", "2024-01-01", "1.5", "x"), ("a", "2024-01-01 11:00:00", "2024-01-01", "9", "x"),
    ("b", "2024-01-02 10:00:00", "2024-01-02", None, "x"), (None, "2024-01-02 10:00:00", "2024-01-02", "2", "x"), (None, "2024-01-02 10:00:00", "2024-01-02", "2", "x"),
    ("c", "soon", "2024-01-02", "2,5", "x"), ("c", "2024-01-02 10:00:00", "2024-01-02", "3", "x"), ("d", "2024-01-02 10:00:00", "2024-01-02", "many", "x")]


def raw(spark, rows=ROWS):
    return spark.createDataFrame(rows, FEED.schema)


@pytest.fixture
def lake(spark, tmp_path):
    return L.Lake(spark, str(tmp_path))


@pytest.fixture
def refined(lake, spark):
    lake.write(raw(spark), "raw", "feed")
    pipeline.ingest(lake, "r1", [FEED])
    pipeline.refine(lake, "r1", [FEED])
    return lake


def test_rejected_rows_are_kept_with_their_codes(refined):
    clean = refined.read("silver", "feed_clean")
    assert sorted((r.id, r.amount) for r in clean.collect()) == [("a", 1.5), ("b", None), ("c", 3.0)]
    assert not {"_outcome", "_violations", "_record_payload"} & set(clean.columns)
    held = pipeline.quarantine(refined, "r1", [FEED]).collect()
    assert sorted(r.validation_error_code for r in held) == ["E01", "E01", "E02", "E02", "E03"]
    assert {r.source_table_name for r in held} == {"feed"} and all(r.source_file_path.endswith(".parquet") for r in held)
    assert any('"amount":"2,5"' in r.record_payload for r in held)


def test_rows_add_up(refined, spark):
    results = {r.check_name: r for r in pipeline.check_rows_add_up(refined, [FEED]).collect()}
    assert {r.status for r in results.values()} == {"passed"} and set(results) == {"rows_add_up", "rejected_rows_listed", "no_more_rows_than_bronze"}
    counted = cleaning.surplus_rows(raw(spark), "id", cleaning.contract_rules(FEED, ROWS and raw(spark).columns)).first()
    assert tuple(counted) == (9, 4, 2)
    path = refined.path("silver", "feed_clean")
    whole = spark.read.parquet(path)
    refined.write(whole.filter("id <> 'b' OR id IS NULL"), "silver", "feed_clean", "day")  # a lost clean row
    lost = {r.check_name: r.failure_count for r in pipeline.check_rows_add_up(refined, [FEED]).collect()}
    assert lost == {"rows_add_up": 1, "rejected_rows_listed": 0, "no_more_rows_than_bronze": 0}


def test_sorting_out_takes_one_scan_and_limits_copies(refined):
    from test_plans import plan, shuffles

    bronze = refined.read("bronze", "feed")
    placed = bronze.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    text = plan(cleaning.sorted_out(placed, FEED, cleaning.contract_rules(FEED, bronze.columns), place=("__file", "__row")))
    assert text.count("FileScan") == 1 and shuffles(text) == 1 and text.count("WindowGroupLimit") == 2


def test_a_failing_mart_leaves_the_old_one(lake, spark):
    def check(df, checks):
        return quality.check_rows(df, "gold_x", checks)

    columns = ("business_date", "v", "gold_pipeline_run_id", "gold_rule_version", "gold_created_at")
    def publish(values, run):
        df = spark.createDataFrame([("2024-01-01", v) for v in values], "business_date string, v int")
        return pipeline.publish_mart(lake, df, "gold_x", columns, "gold", "v1", run, check, [quality.Check("negative", "v < 0")])

    done = publish([1, 2], "r1")
    assert done.rows == 2 and {r.status for r in done.checks} == {"passed"}
    with pytest.raises(ValueError, match="gold_x.negative=1"):
        publish([1, -2, 3], "r2")
    assert [r.gold_pipeline_run_id for r in lake.read("gold", "gold_x").collect()] == ["r1", "r1"]


def deliver(spark, lake, name, rows):
    """One raw file, as another system would leave it."""
    folder = f"{lake.folder('raw', 'feed')}/{name}"
    raw(spark, rows).coalesce(1).write.parquet(folder)
    (part,) = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    os.rename(f"{folder}/{part}", f"{folder}/data.parquet")
    os.remove(f"{folder}/_SUCCESS")


def rows_of(lake):
    return sorted((r.id or "", r.day, r.note) for r in lake.read("bronze", "feed").select("id", F.col("day").cast("string").alias("day"), "note").collect())


def day(n, *ids, note="x"):
    return [(i, f"2024-01-0{n} 10:00:00", f"2024-01-0{n}", "1", note) for i in ids]


def test_only_new_files_are_loaded(lake, spark):
    def load(run):
        return sorted((r.source_file_path.split("/")[-2], r.status, r.reason) for r in pipeline.load_new_files(lake, run, [FEED]).collect())

    deliver(spark, lake, "one", [*day(1, "a", "b"), *day(2, "c")])
    assert load("r1") == [("one", "taken", None)] and load("r2") == []
    first = rows_of(lake)
    assert len(first) == 3
    folders = {n: sorted(os.listdir(f"{lake.path('bronze', 'feed')}/day=2024-01-0{n}")) for n in (1, 2)}

    deliver(spark, lake, "two", [*day(2, "d"), *day(3, "e")])
    shutil.copytree(f"{lake.folder('raw', 'feed')}/one", f"{lake.folder('raw', 'feed')}/zero_again")
    deliver(spark, lake, "other", [*day(3, "f", "g"), *day(3, "h")])
    got = load("r3")
    assert [g[:2] for g in got] == [("other", "taken"), ("two", "taken"), ("zero_again", "refused")] and "one/data.parquet" in got[2][2]
    assert {r[0] for r in rows_of(lake)} == set("abcdefgh") and len(rows_of(lake)) == 8
    after = {n: sorted(os.listdir(f"{lake.path('bronze', 'feed')}/day=2024-01-0{n}")) for n in (1, 2)}
    assert after[1] == folders[1] and after[2] != folders[2]  # the untouched day keeps its files
    assert load("r4") == []  # a refused file is listed once

    shutil.rmtree(f"{lake.folder('raw', 'feed')}/one")
    deliver(spark, lake, "one", day(1, "a", "b", "z"))
    assert [g[:2] for g in load("r5")] == [("one", "refused")]
    assert {r[0] for r in rows_of(lake)} == set("abcdefgh")
    assert lake.read("bronze", L.LEDGER).filter("status = 'taken'").count() == 3


def test_files_that_do_not_fit_are_refused(lake, spark):
    deliver(spark, lake, "one", day(1, "a"))
    changed = raw(spark, day(1, "b")).withColumn("amount", F.col("amount").cast("double")).drop("note").withColumn("more", F.lit(1))
    changed.coalesce(1).write.parquet(f"{lake.folder('raw', 'feed')}/two")
    raw(spark, day(2, "c")).withColumn("more", F.lit(1)).coalesce(1).write.parquet(f"{lake.folder('raw', 'feed')}/three")
    rows = {r.source_file_path.split("/")[-2]: (r.status, r.reason) for r in pipeline.load_new_files(lake, "r1", [FEED]).collect()}
    assert rows["one"] == rows["three"] == ("taken", None)
    assert rows["two"] == ("refused", "amount: double instead of string; note: missing instead of string")
    assert [r[0] for r in rows_of(lake)] == ["a", "c"]
    paths = [r.source_file_path for r in L.delivered_files(lake, "feed").collect()]
    drift = quality.drift_of_files(spark, paths, FEED.schema)
    found = {(r.column_name, r.actual_type): (r.drift, r.file_count) for r in drift.collect()}
    assert found["amount", "string"] == ("matched", 2) and found["amount", "double"] == ("type_changed", 1)
    assert found["note", None] == ("missing", 1) and found["more", "int"] == ("unexpected", 2)
    assert "FileScan" not in drift._jdf.queryExecution().executedPlan().toString()


def test_a_stopped_load_can_run_again(lake, spark):
    deliver(spark, lake, "one", day(1, "a"))
    pipeline.load_new_files(lake, "r1", [FEED])
    deliver(spark, lake, "two", [*day(1, "b"), *day(2, "c")])
    files = [r.source_file_path for r in L.delivered_files(lake, "feed").collect() if "/two/" in r.source_file_path]
    pipeline.take_in(lake, FEED, "r2", files)  # written, but stopped before the ledger
    pipeline.load_new_files(lake, "r2", [FEED])
    assert [r[0] for r in rows_of(lake)] == ["a", "b", "c"]


def test_absent_tables_are_failed_rows(lake, spark):
    lake.write(raw(spark), "raw", "feed")
    lost = TableSpec("lost", "id", "id string")
    rows = pipeline.check_release(lake, [FEED, lost]).collect()
    assert {(r.table_name, r.status) for r in rows if r.check_name == "file_exists"} == {("feed", "passed"), ("lost", "failed")}


def test_reports_of_earlier_runs_stay(refined, monkeypatch):
    monkeypatch.setattr(pipeline, "MART_CHECKS", ())
    pipeline.report(refined, "r1", [FEED])
    first = refined.read("gold", "check_results").count()
    pipeline.report(refined, "r2", [FEED], [L.Published("mart", 1, 1, tuple(pipeline.check_rows_add_up(refined, [FEED]).collect()))])
    by_run = {r.pipeline_run_id: r["count"] for r in refined.read("gold", "check_results").groupBy("pipeline_run_id").count().collect()}
    assert by_run == {"r1": first, "r2": first + 3}
    pipeline.report(refined, "r2", [FEED])
    assert refined.read("gold", "check_results").count() == 2 * first
