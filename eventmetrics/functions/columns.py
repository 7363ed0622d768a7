"""Column functions of the metric queries, all from Spark's built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

MISSING = "—"


def time_bucket(col: Column | str, size: str) -> Column:
    """Start of the epoch-aligned bucket of width `size` that the time falls in."""
    return F.window(col, size).getField("start")


def or_zero(total: Column) -> Column:
    """Zero for the total of no values."""
    return F.coalesce(total, F.lit(0))


def compact_number(col: Column | str, prefix: str = "", suffix: str = "") -> Column:
    """A short text: 1.5M, 2.3K, 999; a dash for NULL and for NaN.

    `format_number` rounds half to even. It also groups digits, which the M and K forms
    do not show.
    """
    n = (F.col(col) if isinstance(col, str) else col).cast("double")

    def scaled(divisor: float, unit: str) -> Column:
        digits = F.translate(F.format_number(n / F.lit(divisor), 1), ",", "")
        return F.concat(F.lit(prefix), digits, F.lit(unit + suffix))

    return (
        F.when(n.isNull() | F.isnan(n), F.lit(MISSING))
        .when(n >= 1e6, scaled(1e6, "M"))
        .when(n >= 1e3, scaled(1e3, "K"))
        .otherwise(F.concat(F.lit(prefix), F.format_number(n, 0), F.lit(suffix)))
    )


def clock_label(col: Column | str) -> Column:
    """Time of day as HH:MM:SS."""
    return F.date_format(col, "HH:mm:ss")


def as_results(df: DataFrame) -> DataFrame:
    """Times without a zone and money as double, the form in which results are compared."""
    def shown(field):
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[shown(field) for field in df.schema.fields])
