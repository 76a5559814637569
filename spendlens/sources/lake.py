"""Reading and publishing tables of a layered lake (raw, bronze, silver, gold)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import fingerprint, require

COMMITS = "_commits"
#: Tables that hold accepted and rejected rows are partitioned by OUTCOME first; HELD are columns of rejected rows only.
OUTCOME, ACCEPTED, REJECTED = "_outcome", "accepted", "rejected"
HELD = ("_violations", "_record_payload")


@dataclass(frozen=True)
class Published:
    """What a publish did: rows that went in, rows found on reading back, results of its checks."""

    table: str
    rows: int
    rows_read_back: int
    checks: tuple[Row, ...] = ()


class FailedChecks(ValueError):
    """Checks of rows that were therefore not published; `rows` are all results."""

    def __init__(self, rows: Sequence[Row]):
        failed = [r for r in rows if r.status == "failed"]
        super().__init__("failed checks: " + "; ".join(f"{r.table_name}.{r.check_name}={r.failure_count}" for r in failed))
        self.rows = tuple(rows)


class Lake:
    """A root folder with one folder per layer and table.

    `fmt` is any Spark source name; "delta" works where its jars are on the class path.

    A table that this class wrote holds one folder per version, and commits: empty files whose names are a rising number
    and a version. Readers take the version of the last commit. A version is written whole, counted
    and checked before its commit file is made, which is one step of the file system: a writer that dies, or rows that
    fail their checks, leave the table as it was, and readers that have begun keep the version they began with. One
    writer per table at a time. Tables without commits, such as delivered raw folders, are read as they are.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def path(self, layer: str, table: str) -> str:
        """Where the current rows of a table lie."""
        done = self.versions(layer, table)
        return f"{self.folder(layer, table)}/{done[-1]}" if done else self.folder(layer, table)

    def _files(self, path: str):
        """The file system of a path, and the path, as Hadoop objects."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def exists(self, layer: str, table: str) -> bool:
        files, place = self._files(self.folder(layer, table))
        return bool(files.exists(place))

    def versions(self, layer: str, table: str) -> list[str]:
        """Versions of a table in the order of their commits; the last one is current."""
        if self.fmt == "delta":
            return []
        files, place = self._files(f"{self.folder(layer, table)}/{COMMITS}")
        if not files.exists(place):
            return []
        return [name.split(".", 1)[1] for name in sorted(s.getPath().getName() for s in files.listStatus(place)) if "." in name]

    def commit(self, layer: str, table: str, version: str) -> None:
        """Make a written version the current one. Also brings an earlier version back."""
        if self.fmt == "delta":
            return
        number = len(self.versions(layer, table)) + 1
        files, place = self._files(f"{self.folder(layer, table)}/{COMMITS}/{number:010d}.{version}")
        files.create(place, False).close()

    def drop_old_versions(self, layer: str, table: str, keep: int = 2) -> int:
        """Delete the folders of all but the last `keep` versions; their commits stay as a record."""
        done = self.versions(layer, table)
        recent, gone = set(done[-keep:]), 0
        for version in dict.fromkeys(v for v in done if v not in recent):
            files, place = self._files(f"{self.folder(layer, table)}/{version}")
            gone += bool(files.delete(place, True))
        return gone

    def read(self, layer: str, table: str, schema: str | None = None) -> DataFrame:
        """A lazy scan. With a schema no footer is opened for inference."""
        return self._read(self.path(layer, table), schema)

    def _read(self, path: str, schema: str | None = None, outcome: str = ACCEPTED) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(path)
        if OUTCOME not in df.columns:
            return df
        kept = df.filter(F.col(OUTCOME) == outcome).drop(OUTCOME)  # other folders are not read
        return kept.drop(*HELD) if outcome == ACCEPTED else kept

    def rejected(self, layer: str, table: str) -> DataFrame | None:
        """The rows that were rejected when the table was written; None if it was written without sorting out."""
        path = self.path(layer, table)
        sorted_out = OUTCOME in self.spark.read.format(self.fmt).load(path).columns
        return self._read(path, outcome=REJECTED) if sorted_out else None

    def read_many(self, layer: str, tables: Iterable[str]) -> dict[str, DataFrame]:
        return {name: self.read(layer, name) for name in tables}

    def write(self, df: DataFrame, layer: str, table: str, partition: str | None = None) -> int:
        """Replace a table and return the row count, taken from the same job as the write."""
        rows, version = self._stage(df, layer, table, partition)
        self.commit(layer, table, version)
        return rows

    def _stage(self, df: DataFrame, layer: str, table: str, partition: str | None) -> tuple[int, str]:
        """Write a version that no reader sees yet: (rows, version).

        Partitioned tables are rebalanced by the partition column: small dates share a task and
        a date that holds a large part of the rows is split over several tasks and files, which
        a plain repartition by date would send to a single one. The count is observed after that
        shuffle, in the final stage, where a task re-run after a lost executor counts once.
        """
        partitioned = [c for c in (OUTCOME, partition) if c is not None and c in df.columns]
        if partitioned:
            df = df.hint("rebalance", *partitioned)
        seen = Observation()
        accepted = F.count_if(F.col(OUTCOME) == ACCEPTED) if OUTCOME in df.columns else F.count(F.lit(1))
        writer = df.observe(seen, accepted.alias("rows")).write.format(self.fmt)
        version = f"v-{uuid.uuid4().hex}"
        if self.fmt == "delta":
            writer = writer.mode("overwrite").option("overwriteSchema", "true")
        if partitioned:
            writer = writer.partitionBy(*partitioned)
        writer.save(self._version_path(layer, table, version))
        return int(seen.get["rows"]), version

    def _version_path(self, layer: str, table: str, version: str) -> str:
        return self.folder(layer, table) if self.fmt == "delta" else f"{self.folder(layer, table)}/{version}"

    def publish(
        self, df: DataFrame, layer: str, table: str, columns: Iterable[str] = (), partition: str | None = None,
        checks: Callable[[DataFrame], DataFrame] | None = None,
    ) -> Published:
        """Contract check, write beside the current rows, read-back count, checks of the written rows, then the swap.

        `df` may read the table that it replaces. `checks` gives check rows for the written rows; if one
        failed, `FailedChecks` is raised and the table stays as it was.
        """
        require(df, columns, table)
        rows, version = self._stage(df, layer, table, partition)
        written = self._read(self._version_path(layer, table, version))
        back = written.count()
        if back != rows:
            raise ValueError(f"{table}: wrote {rows} rows but read back {back}")
        results = tuple(checks(written).collect()) if checks is not None else ()  # a row for each check
        if any(r.status == "failed" for r in results):
            raise FailedChecks(results)
        self.commit(layer, table, version)
        return Published(table, rows, back, results)

    def replace(
        self, df: DataFrame, layer: str, table: str, columns: Iterable[str] = (), partition: str | None = None
    ) -> Published:
        """Publish a result that was computed from the very table it replaces."""
        return self.publish(df, layer, table, columns, partition)

    def overwrite_partitions(self, df: DataFrame, layer: str, table: str, partition: str) -> int:
        """Replace only the partitions that `df` has rows for, in the current version; all others stay untouched.

        `df` must not read the table: hand it over first. Running it again gives the same table.
        """
        if not self.exists(layer, table):
            return self.write(df, layer, table, partition)
        seen = Observation()
        counted = df.hint("rebalance", partition).observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).save(
            self.path(layer, table))
        return int(seen.get["rows"])


def add_source_columns(df: DataFrame, table: str, run_id: str, source_path: str | None = None) -> DataFrame:
    """Bronze metadata: when, what, from which file, by which run, and the row's fingerprint.

    Without `source_path` each row carries the file it really came from.
    """
    business = df.columns
    path = F.lit(source_path) if source_path is not None else F.col("_metadata.file_path")
    return df.select(
        *business,
        F.current_timestamp().alias("ingestion_timestamp"),
        F.lit(table).alias("source_table_name"),
        path.alias("source_file_path"),
        F.lit(run_id).alias("pipeline_run_id"),
        fingerprint(business).alias("record_hash"),
    )


def unseen_files(incoming: DataFrame, ingested: DataFrame) -> DataFrame:
    """Rows from source files that have not been ingested before."""
    done = ingested.select("source_file_path").distinct()
    return incoming.join(done, "source_file_path", "left_anti")


def repeated_files(ingested: DataFrame) -> DataFrame:
    """Files that were taken in by more than one run."""
    return (
        ingested.groupBy("source_file_path")
        .agg(F.countDistinct("pipeline_run_id").alias("run_count"), F.count(F.lit(1)).alias("row_count"))
        .filter("run_count > 1")
    )


LEDGER = "file_ledger"
LEDGER_SCHEMA = (
    "source_table_name string, source_file_path string, file_bytes bigint, modified_at timestamp, pipeline_run_id string, status string, reason string")


def delivered_files(lake: Lake, table: str, pattern: str = "*.parquet") -> DataFrame:
    """path, bytes and time of every file of a raw table: a listing, no file is opened."""
    listing = lake.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return listing.load(lake.path("raw", table)).select(
        F.lit(table).alias("source_table_name"), F.col("path").alias("source_file_path"),
        F.col("length").alias("file_bytes"), F.col("modificationTime").alias("modified_at"))


def judged_files(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files the ledger has not settled: `taken`, or `refused` with the reason.

    A known path is settled if its size and time are the same; if not, it was changed after it was taken in. A new path
    with the name and size of a file of that table that was taken in from elsewhere, or that stands in the same listing
    under a smaller path, may be a repeated delivery: its `twin` is that path. `without_copies` settles those.
    """
    taken = ledger.filter("status = 'taken'").select(
        "source_table_name", "source_file_path", F.col("file_bytes").alias("known_bytes"), F.col("modified_at").alias("known_at"))
    seen = ledger.filter("status = 'refused'").select("source_table_name", "source_file_path", "file_bytes", "modified_at")
    fresh = listed.join(seen, ["source_table_name", "source_file_path", "file_bytes", "modified_at"], "left_anti")
    name = F.element_at(F.split("source_file_path", "/"), -1)
    same = ["source_table_name", "file_name", "file_bytes"]
    known = taken.select("source_table_name", name.alias("file_name"), F.col("known_bytes").alias("file_bytes"), F.col("source_file_path").alias("first_path"))
    listed_first = listed.select("source_table_name", name.alias("file_name"), "file_bytes", F.col("source_file_path").alias("first_path"))
    first = known.withColumn("rank", F.lit(0)).unionByName(listed_first.withColumn("rank", F.lit(1))).groupBy(*same).agg(
        F.min_by("first_path", F.struct("rank", "first_path")).alias("first_path"))
    joined = fresh.withColumn("file_name", name).join(taken, ["source_table_name", "source_file_path"], "left").join(first, same, "left")
    changed = (F.col("known_bytes") != F.col("file_bytes")) | (F.col("known_at") != F.col("modified_at"))
    reason = F.when(F.col("known_bytes").isNotNull(), F.when(changed, "changed after it was taken in").otherwise("known"))
    twin = F.when(F.col("known_bytes").isNull() & (F.col("first_path") != F.col("source_file_path")), F.col("first_path"))
    return joined.withColumn("reason", reason).filter("reason IS NULL OR reason <> 'known'").select(
        "source_table_name", "source_file_path", "file_bytes", "modified_at",
        F.when(F.col("reason").isNull(), "taken").otherwise("refused").alias("status"), "reason", twin.alias("twin"))


def without_copies(files: DataFrame) -> DataFrame:
    """Judged files; those whose content is that of their twin are refused. Only files with a twin are read."""
    twins = files.filter("twin IS NOT NULL").select("source_file_path", "twin")
    paths = sorted({p for row in twins.collect() for p in row})  # new files whose name and size repeat
    if not paths:
        return files.drop("twin")
    content = files.sparkSession.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("digest"))
    digests = [content.withColumnsRenamed({"path": p, "digest": d}) for p, d in (("source_file_path", "own"), ("twin", "other"))]
    copies = twins.join(digests[0], "source_file_path").join(digests[1], "twin").filter("own = other").select(
        "source_file_path", F.concat(F.lit("delivered before as "), "twin").alias("copied"))
    joined = files.join(copies, "source_file_path", "left")
    return joined.select(
        "source_table_name", "source_file_path", "file_bytes", "modified_at",
        F.when(F.col("copied").isNotNull(), "refused").otherwise(F.col("status")).alias("status"), F.coalesce("copied", "reason").alias("reason"))


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, files and bytes of file-backed tables, one row per table."""
    out = None
    for name, df in tables.items():
        per_file = df.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
        one = per_file.agg(F.count(F.lit(1)).alias("n")).agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count("path").alias("file_count"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("file_bytes"),
        )
        out = one if out is None else out.unionByName(one)
    return out
