"""Column helpers. Everything here is a native Spark expression (no Python UDF)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Ordinary amounts are whole ten-thousandths below PLAIN_BELOW; they are summed as integers in two halves, so that no
# number of rows overflows. Other amounts are summed as decimals, up to FINITE_BELOW; beyond it they count as infinite.
MONEY_UNITS = 10_000
PLAIN_BELOW = 1e10
FINITE_BELOW = 1e17
HALF_BITS = 24


def ratio_pos(numerator: str, denominator: str) -> str:
    """SQL text: quotient where the denominator is positive, else 0 (null denominators too)."""
    return f"CASE WHEN {denominator} > 0 THEN {numerator} / {denominator} ELSE 0D END"


def ratio_nz(numerator: str, denominator: str) -> str:
    """SQL text: quotient where the denominator is non-zero, negative ones included, else 0."""
    return f"CASE WHEN {denominator} <> 0 THEN {numerator} / {denominator} ELSE 0D END"


def derive(df: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    """Add one column per formula; later formulas may use earlier ones.

    The formulas go into one projection through lateral column aliases, so a long chain of
    metrics stays one analysis step and collapses into a single codegen stage. A formula named
    like an existing column replaces it (and therefore cannot read the old value).
    """
    replaced = [c for c in df.columns if c in formulas]
    kept = f"* EXCEPT ({', '.join(replaced)})" if replaced else "*"
    return df.selectExpr(kept, *(f"{sql} AS {name}" for name, sql in formulas.items()))


def case(rules: Iterable[tuple[str, str]], default: str) -> str:
    """SQL text of an ordered classification; conditions are SQL, labels are plain text."""
    arms = " ".join(f"WHEN {cond} THEN {sql_text(label)}" for cond, label in rules)
    return f"CASE {arms} ELSE {sql_text(default)} END"


def sql_text(value: str) -> str:
    """Quote a text literal for Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sign_label(value: str, positive: str, negative: str, zero: str) -> str:
    """SQL text of a label by the sign of an expression."""
    return case([(f"{value} > 0", positive), (f"{value} < 0", negative)], zero)


def money_sum(amount: str | Column) -> Column:
    """Sum of a money column as double: exact, whatever the order in which partitions are merged.

    An amount stands for its shortest decimal text. Amounts of whole ten-thousandths take two integer sums; the rest,
    with up to 18 decimals, two decimal sums of their whole and broken parts, which stay empty for ordinary tables. Only
    the end result is rounded. A NaN, or both infinities, give NaN; an infinity, or an amount of FINITE_BELOW or
    more, an infinity; no amount at all gives null.
    """
    col = (F.col(amount) if isinstance(amount, str) else amount).cast("double")
    units = F.rint(col * MONEY_UNITS)
    plain = (F.abs(col) < PLAIN_BELOW) & (units / float(MONEY_UNITS) == col)
    whole_units = F.when(plain, units.cast("bigint"))
    finite = ~F.isnan(col) & (F.abs(col) < FINITE_BELOW)
    odd = F.when(~plain & finite, col)
    whole = F.floor(odd).cast("decimal(18,0)")
    broken = (odd.cast("decimal(37,18)") - whole).cast("decimal(19,18)")
    extreme = F.when(~finite, F.when(F.isnan(col), col).otherwise(F.signum(col) * float("inf")))
    plain_total = (
        F.sum(F.shiftright(whole_units, HALF_BITS)) * float(1 << HALF_BITS)
        + F.sum(whole_units.bitwiseAND((1 << HALF_BITS) - 1))
    ) / float(MONEY_UNITS)
    odd_total = F.sum(whole).cast("double") + F.sum(broken).cast("double")
    return F.coalesce(F.sum(extreme), plain_total + odd_total, plain_total, odd_total)


def money_mean(amount: str | Column) -> Column:
    """Exact mean of a money column over its non-null values, as double."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return money_sum(col) / F.count(col)


def cents(sql: str) -> str:
    """SQL text: an amount as an exact two-digit decimal; null if it is no number below 1e18."""
    return f"TRY_CAST({sql} AS DECIMAL(20,2))"


def rate(sql: str) -> str:
    """SQL text: a rate as an exact decimal with all its digits; null if it is no number below 100."""
    return f"TRY_CAST({sql} AS DECIMAL(17,15))"


def round_money(sql: str) -> str:
    """SQL text: half-up rounding of an exact decimal to cents, delivered as double."""
    return f"CAST(ROUND({sql}, 2) AS DOUBLE)"


def joined_text(columns: Sequence[str], null_as: str | None, separator: str = "||") -> Column:
    """Columns as text joined by a separator; `null_as=None` leaves nulls out."""
    parts = [F.col(c).cast("string") for c in columns]
    if null_as is not None:
        parts = [F.coalesce(p, F.lit(null_as)) for p in parts]
    return F.concat_ws(separator, *parts)


def fingerprint(columns: Sequence[str], null_as: str | None = "", length_prefixed: bool = False) -> Column:
    """SHA-256 of a row image.

    With `length_prefixed` every value carries its length and a null marker, so a null and an
    empty text, or a separator inside a value, can no longer give two rows the same image.
    """
    if not length_prefixed:
        return F.sha2(joined_text(columns, null_as), 256)
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def prefixed_hash(prefix: str, columns: Sequence[str]) -> Column:
    """Deterministic identifier: a prefix and the SHA-256 of the key columns."""
    return F.concat(F.lit(prefix), F.sha2(joined_text(columns, None), 256))


def lowered_in(column: str, values: Sequence[str]) -> Column:
    """Case-insensitive membership."""
    return F.lower(F.col(column)).isin(*values)


def present(*columns: str) -> Column:
    """True where none of the columns is null."""
    return F.expr(" AND ".join(f"{name} IS NOT NULL" for name in columns))


def require(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    """Column-name contract; raises before any job is started."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")
    return df


def stamp(df: DataFrame, prefix: str, rule_version: str, run_id: str) -> DataFrame:
    """Pipeline metadata triplet of a mart."""
    return df.withColumns(
        {
            f"{prefix}_pipeline_run_id": F.lit(run_id),
            f"{prefix}_rule_version": F.lit(rule_version),
            f"{prefix}_created_at": F.current_timestamp(),
        }
    )


def time_slice(df: DataFrame, column: str, seconds: int) -> Column:
    """Number of the time slice of a timestamp; slices follow the order of the timestamps.

    Zoneless timestamps are numbered on the wall clock, instants in UTC, so a change of clocks
    can never put a later timestamp into an earlier slice.
    """
    at = F.col(column)
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        clock = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
        return F.floor((F.unix_date(at.cast("date")).cast("bigint") * 86400 + clock) / seconds)
    return F.floor(F.unix_seconds(at) / seconds)
