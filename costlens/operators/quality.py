"""Data-quality scores of cost records, each from a single pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlens.functions.calendar import hours_between
from costlens.functions.checks import within
from costlens.functions.nulls import is_missing, present
from costlens.operators.aggregate import DATE, TARGET, count_if
from costlens.operators.duplicates import count_distinct_rows

KEY_COLUMNS = (DATE, TARGET, "meter_category", "resource_location", "billing_currency_code")
MISSING_WARNING_PCT = 5.0
MISSING_CRITICAL_PCT = 10.0


def _pct(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole.cast("double")), F.lit(0.0))


def _missing_counts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [count_if(is_missing(df, name)).alias(f"missing_{name}") for name in columns]


def _completeness_columns(columns: Sequence[str], threshold_pct: float) -> dict[str, Column]:
    within("the missing-data threshold", threshold_pct, 0, 100)
    missing = F.lit(0).cast("long")
    for name in columns:
        missing = missing + F.col(f"missing_{name}")
    total = F.col("total_records")
    # Missing cells over rows: may go below zero when several columns are empty.
    rate = F.coalesce(F.try_divide((total - missing) * F.lit(100.0), total.cast("double")), F.lit(0.0))
    cells = total * F.lit(len(columns))
    return {
        "missing_cells": missing,
        "completeness_rate": rate,
        "cell_completeness_rate": F.coalesce(
            F.try_divide((cells - missing) * F.lit(100.0), cells.cast("double")), F.lit(0.0)
        ),
        "meets_threshold": rate >= F.lit(100.0 - threshold_pct),
    }


def completeness(
    df: DataFrame, columns: Sequence[str] = KEY_COLUMNS, threshold_pct: float = MISSING_WARNING_PCT
) -> DataFrame:
    """One row: missing cells of the key columns and the completeness rates."""
    used = present(columns, df)
    counted = df.agg(F.count(F.lit(1)).alias("total_records"), *_missing_counts(df, used))
    return counted.withColumns(_completeness_columns(used, threshold_pct)).select(
        "total_records", "missing_cells", "completeness_rate", "cell_completeness_rate", "meets_threshold"
    )


def missing_by_column(df: DataFrame, columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Long form: one row per key column with count, share and alert level."""
    used = present(columns, df)
    counted = df.agg(F.count(F.lit(1)).alias("total_records"), *_missing_counts(df, used))
    entries = F.array(
        *[F.struct(F.lit(name).alias("column"), F.col(f"missing_{name}").alias("missing_count")) for name in used]
    )
    return (
        counted.select("total_records", F.explode(entries).alias("e"))
        .select(
            F.col("e.column").alias("column"),
            F.col("e.missing_count").alias("missing_count"),
            _pct(F.col("e.missing_count"), F.col("total_records")).alias("missing_pct"),
        )
        .withColumn("alert_level", missing_alert(F.col("missing_pct")))
    )


def missing_alert(
    pct: Column, warning: float = MISSING_WARNING_PCT, critical: float = MISSING_CRITICAL_PCT
) -> Column:
    within("the warning level", warning, 0, 100)
    within("the critical level", critical, 0, 100)
    return F.when(pct > critical, "CRITICAL").when(pct > warning, "WARNING").otherwise("OK")


def _accuracy_aggregates(currency: str, cost_col: str, date_col: str, currency_col: str | None) -> list[Column]:
    foreign = count_if(F.col(currency_col) != currency) if currency_col else F.lit(0).cast("long")
    return [
        count_if(F.col(cost_col) < 0).alias("negative_costs"),
        count_if(F.col(cost_col) == 0).alias("zero_costs"),
        foreign.alias("foreign_currency"),
        F.min(F.to_date(date_col)).alias("min_date"),
        F.max(F.to_date(date_col)).alias("max_date"),
    ]


def accuracy(
    df: DataFrame,
    currency: str = "USD",
    cost_col: str = TARGET,
    date_col: str = DATE,
    currency_col: str = "billing_currency_code",
) -> DataFrame:
    """One row: negative, zero and foreign-currency costs and the date range.

    A null currency is not counted as foreign.
    """
    known = currency_col if currency_col in df.columns else None
    return df.agg(*_accuracy_aggregates(currency, cost_col, date_col, known)).withColumn(
        "has_issues", (F.col("negative_costs") > 0) | (F.col("foreign_currency") > 0)
    )


def consistency(df: DataFrame) -> DataFrame:
    """One row: total, distinct and duplicate records, over all columns.

    Rows are told apart by a hash first, so a row moves only if its hash repeats.
    """
    return (
        count_distinct_rows(df)
        .withColumn("duplicate_count", F.col("total_records") - F.col("distinct_records"))
        .withColumn("duplicate_pct", _pct(F.col("duplicate_count"), F.col("total_records")))
    )


def timeliness(df: DataFrame, as_of: str, max_age_hours: float = 168.0, date_col: str = DATE) -> DataFrame:
    """One row: latest date, its age at ``as_of`` and the freshness verdict."""
    return df.agg(F.max(F.to_date(date_col)).alias("latest_date")).withColumns(_timeliness_columns(as_of, max_age_hours))


def _timeliness_columns(as_of: str, max_age_hours: float) -> dict[str, Column]:
    within("the maximum age", max_age_hours, 0)
    age = hours_between(F.lit(as_of).cast("timestamp"), F.col("latest_date"))
    return {
        "hours_old": age,
        "meets_sla": F.coalesce(age <= F.lit(float(max_age_hours)), F.lit(False)),
    }


def quality_report(
    df: DataFrame,
    as_of: str,
    columns: Sequence[str] = KEY_COLUMNS,
    currency: str = "USD",
    threshold_pct: float = MISSING_WARNING_PCT,
    max_age_hours: float = 168.0,
    gate: float = 80.0,
    cost_col: str = TARGET,
    date_col: str = DATE,
    currency_col: str = "billing_currency_code",
) -> DataFrame:
    """All four checks and the weighted score as one row.

    Completeness, accuracy and timeliness share a single scan; the duplicate count
    reads every column and moves a hash per row.
    """
    used = present(columns, df)
    known = currency_col if currency_col in df.columns else None
    scanned = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *_missing_counts(df, used),
        *_accuracy_aggregates(currency, cost_col, date_col, known),
    ).withColumn("latest_date", F.col("max_date"))
    copies = consistency(df).select(F.struct("distinct_records", "duplicate_count", "duplicate_pct")).scalar()
    report = (
        scanned.withColumns(_completeness_columns(used, threshold_pct))
        .withColumn("has_issues", (F.col("negative_costs") > 0) | (F.col("foreign_currency") > 0))
        .withColumns(_timeliness_columns(as_of, max_age_hours))
        .withColumn("_copies", copies)
        .select(
            "total_records",
            "missing_cells",
            "completeness_rate",
            "cell_completeness_rate",
            "meets_threshold",
            "negative_costs",
            "zero_costs",
            "foreign_currency",
            "min_date",
            "max_date",
            "has_issues",
            "hours_old",
            "meets_sla",
            "_copies.*",
        )
    )
    return report.withColumn("quality_score", quality_score()).withColumn(
        "below_gate", F.col("quality_score") < F.lit(float(gate))
    )


def quality_score() -> Column:
    """Weighted score over the columns of ``quality_report``."""
    accurate = F.when(F.col("has_issues"), F.lit(80.0)).otherwise(F.lit(100.0))
    unique = F.lit(100.0) - F.least(F.col("duplicate_pct"), F.lit(10.0))
    timely = F.when(F.col("meets_sla"), F.lit(100.0)).otherwise(F.lit(70.0))
    return F.lit(0.3) * F.col("completeness_rate") + F.lit(0.3) * accurate + F.lit(0.2) * unique + F.lit(0.2) * timely


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Declared against actual column types; missing columns show a null type."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema}
    rows = [
        (field.name, field.dataType.simpleString(), actual.get(field.name), actual.get(field.name) == field.dataType.simpleString())
        for field in expected
    ]
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string, ok boolean")


def cast_failures(df: DataFrame, expected: T.StructType) -> DataFrame:
    """For a string feed: values per column that the declared type rejects."""
    used = [field for field in expected if field.name in df.columns]
    counted = df.agg(
        *[
            count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
            for f in used
        ]
    )
    entries = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("failures")) for f in used])
    return counted.select(F.explode(entries).alias("e")).select("e.*")
