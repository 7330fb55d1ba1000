"""The viewer's predicates and counts over records or loaded CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def contains_pattern(column: Column, pattern: str, *, literal: bool = False) -> Column:
    """Whether the column holds the pattern in any case; null counts as no. literal: the pattern is plain text."""
    test = F.contains(F.lower(column), F.lit(pattern.lower())) if literal else column.rlike("(?iu)" + pattern)
    return F.coalesce(test, F.lit(False))


def equals_text(column: Column, value: str) -> Column:
    return F.coalesce(column.cast("string") == value, F.lit(False))


def is_true(column: Column) -> Column:
    return F.coalesce(column.cast("boolean"), F.lit(False))


def distinct_rules(df: DataFrame, column: str) -> DataFrame:
    """The rules of a semicolon-separated column: stripped, without blanks, distinct, sorted."""
    rules = df.select(F.explode(F.split(F.coalesce(F.col(column), F.lit("")), ";")).alias("rule"))
    return rules.select(strip(F.col("rule")).alias("rule")).where("rule <> ''").distinct().orderBy("rule")


def suspicious_summary(df: DataFrame, suspicious: str, family: str) -> DataFrame:
    return df.agg(F.count_if(is_true(F.col(suspicious))).alias("suspicious"), F.count_distinct(family).alias("families"))


def is_missing(column: Column, kind: str = "string") -> Column:
    """Whether a cell is null, empty or the text `null`, or NaN in a column of a floating kind."""
    if kind in ("double", "float"):
        return column.isNull() | F.isnan(column)
    text = column.cast("string")
    return text.isNull() | text.isin("", "null")


def missing_cells(df: DataFrame) -> DataFrame:
    """field, n_missing: how many cells of each column are missing, in one pass."""
    counts = df.agg(*[F.count_if(is_missing(F.col(c), kind)).alias(c) for c, kind in df.dtypes])
    return counts.unpivot([], df.columns, "field", "n_missing")


def whole_age(column: Column) -> Column:
    """The nearest whole number, halves to the even one; null for what is no number."""
    return F.bround(column.try_cast("double")).cast("bigint")
