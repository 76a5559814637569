"""Metric lineage: which source rows make up which mart row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import joined_text


def row_id(prefix: str, grain: Sequence[str]) -> Column:
    """Stable readable id of a mart row."""
    return F.concat(F.lit(f"{prefix}_"), joined_text(grain, "", "_"))


def detail(source: DataFrame, mart: str, prefix: str, grain: Sequence[str], table: str, key: str, role: str) -> DataFrame:
    """One row per contributing source row. The mart row id follows from the row itself: no join."""
    return source.select(
        F.lit(mart).alias("gold_table_name"),
        row_id(prefix, grain).alias("gold_row_id"),
        F.lit(table).alias("source_table_name"),
        F.lit(key).alias("source_primary_key_column"),
        F.col(key).cast("string").alias("source_primary_key_value"),
        F.lit(role).alias("source_role"),
    )


def summary(details: DataFrame, filter_condition: str, formula: str) -> DataFrame:
    """Contributing rows per mart row and source."""
    return (
        details.groupBy("gold_table_name", "gold_row_id", "source_table_name", "source_role")
        .agg(F.count(F.lit(1)).alias("source_row_count"))
        .withColumns({"filter_condition": F.lit(filter_condition), "aggregation_formula": F.lit(formula)})
    )
