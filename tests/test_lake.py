"""Reading, publishing and file-level guards."""

import os

import pytest
from pyspark.sql import functions as F

from spendlens.sources import lake as L


@pytest.fixture
def lake(spark, tmp_path):
    return L.Lake(spark, str(tmp_path))


def test_publish_counts_and_contract(lake, spark):
    df = spark.range(100).withColumn("day", (F.col("id") % 3).cast("string"))
    done = lake.publish(df, "silver", "t", ["id"], "day")
    assert (done.rows, done.rows_read_back) == (100, 100)
    assert sorted(os.listdir(lake.path("silver", "t")))[-3:] == ["day=0", "day=1", "day=2"]
    assert lake.write(df, "silver", "flat", "absent_column") == 100
    with pytest.raises(ValueError, match="lacks required columns: x"):
        lake.publish(df, "silver", "t", ["x"])
    assert set(lake.read_many("silver", ["t", "flat"])) == {"t", "flat"}


def test_hot_date_is_written_by_several_tasks(lake, spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        # nine tenths of the rows share one date
        df = spark.range(200_000).select(
            F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("day"), F.sha2(F.col("id").cast("string"), 256))
        lake.write(df.toDF("day", "v"), "silver", "hot", "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(lake.path("silver", "hot") + "/day=hot") if f.endswith(".parquet")]
    assert len(files) > 1


def test_replace_reads_its_own_table(lake, spark):
    lake.publish(spark.range(5), "silver", "t")
    done = lake.replace(lake.read("silver", "t").unionByName(spark.range(5, 8)), "silver", "t")
    assert done.rows == 8 and lake.read("silver", "t").count() == 8


def test_source_columns_name_the_real_file(lake, spark):
    lake.publish(spark.range(3), "raw", "t")
    rows = L.add_source_columns(lake.read("raw", "t"), "t", "run").collect()
    assert all(r.source_file_path.endswith(".parquet") and r.source_table_name == "t" for r in rows)
    given = L.add_source_columns(spark.range(1), "t", "run", source_path="elsewhere").first()
    assert given.source_file_path == "elsewhere" and len(given.record_hash) == 64


def test_file_guards(spark):
    log = spark.createDataFrame([("f1", "r1"), ("f1", "r2"), ("f2", "r1")], "source_file_path string, pipeline_run_id string")
    assert [r.source_file_path for r in L.repeated_files(log).collect()] == ["f1"]
    incoming = spark.createDataFrame([("f1", 1), ("f3", 2)], "source_file_path string, v int")
    assert [r.source_file_path for r in L.unseen_files(incoming, log).collect()] == ["f3"]


def test_profile(lake, spark):
    lake.publish(spark.range(10).repartition(2), "raw", "t")
    row = L.table_profile({"t": lake.read("raw", "t")}).first()
    assert (row.row_count, row.file_count) == (10, 2) and row.file_bytes > 0


def passing(df):
    return df.selectExpr("'t' AS table_name", "'rows' AS check_name", "0L AS failure_count", "'high' AS severity", "'passed' AS status").limit(1)


def test_failing_checks_leave_the_old_rows(lake, spark):
    lake.publish(spark.range(5), "gold", "t", checks=passing)
    began = lake.read("gold", "t")
    with pytest.raises(L.FailedChecks, match="t.rows=3") as failure:
        lake.publish(spark.range(9), "gold", "t", checks=lambda df: passing(df).withColumns({"status": F.lit("failed"), "failure_count": F.lit(3)}))
    assert [r.status for r in failure.value.rows] == ["failed"]
    assert lake.read("gold", "t").count() == 5 and len(lake.versions("gold", "t")) == 1
    done = lake.publish(spark.range(9), "gold", "t", checks=passing)
    assert [r.status for r in done.checks] == ["passed"] and lake.read("gold", "t").count() == 9
    assert began.count() == 5  # a reader that had begun keeps its version


def test_killed_write_leaves_the_old_rows(lake, spark):
    lake.publish(spark.range(5), "silver", "t")
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="killed"):
        lake.publish(broken, "silver", "t")
    os.makedirs(f"{lake.folder('silver', 't')}/v-half-written")  # what a dead writer may leave
    assert lake.read("silver", "t").count() == 5
    lake.publish(lake.read("silver", "t").filter("id < 2"), "silver", "t")
    assert lake.read("silver", "t").count() == 2


def test_versions_come_back_and_go(lake, spark):
    for n in (1, 2, 3, 4):
        lake.publish(spark.range(n), "gold", "t")
    first = lake.versions("gold", "t")[0]
    lake.commit("gold", "t", first)
    assert lake.read("gold", "t").count() == 1
    assert lake.drop_old_versions("gold", "t", keep=2) == 2 and lake.read("gold", "t").count() == 1
    assert sorted(n for n in os.listdir(lake.folder("gold", "t")) if n.startswith("v-")) == sorted(lake.versions("gold", "t")[-2:])


def test_only_given_partitions_are_overwritten(lake, spark):
    df = spark.range(30).withColumn("day", (F.col("id") % 3).cast("string"))
    lake.write(df, "bronze", "t", "day")
    before = {n: sorted(os.listdir(f"{lake.path('bronze', 't')}/day={n}")) for n in range(3)}
    assert lake.overwrite_partitions(spark.range(100, 104).withColumn("day", F.lit("1")), "bronze", "t", "day") == 4
    after = {n: sorted(os.listdir(f"{lake.path('bronze', 't')}/day={n}")) for n in range(3)}
    assert before[0] == after[0] and before[2] == after[2] and before[1] != after[1]
    assert lake.read("bronze", "t").count() == 24
    assert lake.overwrite_partitions(df, "bronze", "new", "day") == 30
