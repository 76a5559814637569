"""Helpers shared by the text operators: hand-over tables, columns that may be missing, label samples."""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`; in local mode one of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="spendlens-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """`mapInArrow` with this package sent to the executors' Python workers once per application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        path = os.path.join(tempfile.mkdtemp(prefix="spendlens-code-"), f"{package.name}.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return df.mapInArrow(function, schema)


def learnt(sample: DataFrame, learn: Callable[[list[pa.RecordBatch]], object]):
    """What `learn` makes of a bounded sample: computed in one task, so that the driver gets a model and no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learn(list(batches)))], pa.binary())], ["model"])

    rows = map_arrow(sample.repartition(1), run, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else learn([])  # no task where Spark knows that there are no rows


def whole_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that are sorted by the integer columns `names`; about `rows` rows each."""
    held = None
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            part = pa.Table.from_batches([whole.slice(start, rows)])
            part = pa.concat_tables([held, part]) if held is not None else part
            columns = [part.column(c).to_numpy() for c in names]
            fresh = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in columns]))
            cut = fresh[-1] + 1 if len(fresh) else 0
            if cut:
                yield part.slice(0, cut)
            held = part.slice(cut)
    if held is not None and held.num_rows:
        yield held


def dealt_in_blocks(rows: DataFrame, key: str, node: str, count: str, block_rows: int) -> DataFrame:
    """`rows`, each group of equal `key` dealt out in pairs of blocks and sorted: (key, first, second, block, ...).

    A group of `count` rows has ceil(count / block_rows) blocks by a hash of `node`; every pair of blocks, and each
    block with itself, comes together once, so no task holds more than about 2 * block_rows rows of a group.
    """
    blocks = rows.withColumn("_blocks", F.ceil(F.col(count) / block_rows).cast("int"))
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64(node), "_blocks").cast("int"))
    dealt = blocks.withColumn("_partner", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.withColumn("first", F.least("block", "_partner")).withColumn("second", F.greatest("block", "_partner"))
    return dealt.drop("_blocks", "_partner", count).repartition(key, "first", "second").sortWithinPartitions(key, "first", "second")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, usable: Column | None = None,
                    columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """Up to `rows` documents with a 0/1 label, half for each value, the smallest hashes of their id first.

    Only `labels` (ids and digits) is ordered; the chosen ids, `rows` at most, are broadcast to the documents.
    Ids that are null or labelled with both values are left out. `usable` restricts the ids.
    """
    clean = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (usable if usable is not None else F.lit(True)))
        .groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("label"))
        .where("low = label").select("doc_id", F.col("label").cast("int").alias("label"))
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = clean.where("label = 1").orderBy(*order).limit(rows // 2).unionAll(
        clean.where("label = 0").orderBy(*order).limit(rows // 2))
    return (
        docs.select("doc_id", *columns).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.max("label").alias("label"), *[F.min(c).alias(c) for c in columns])
    )
