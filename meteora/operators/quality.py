"""Quality gate and table counts in single passes.

``quality_checks`` computes every check of the gate in one aggregation and
returns a (check, observed, expected, passed) table; ``enforce`` reads that
three-row result and raises when a check fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityGateError(AssertionError):
    pass


def _row(check, observed, expected, passed):
    return F.struct(check.alias("check"), observed.alias("observed"),
                    expected.alias("expected"), passed.alias("passed"))


def quality_checks(silver: DataFrame, min_rows: int) -> DataFrame:
    s = silver.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("temperature_c").isNull()).alias("nulls"),
        F.max("time").alias("latest"),
    )
    return s.select(F.inline(F.array(
        F.struct(F.lit("row_count").alias("check"), F.col("total").cast("string").alias("observed"),
                 F.lit(f"> {min_rows}").alias("expected"), (F.col("total") > min_rows).alias("passed")),
        _row(F.lit("null_temperatures"), F.col("nulls").cast("string"), F.lit("= 0"),
             F.col("nulls") == 0),
        _row(F.lit("latest_time"), F.col("latest").cast("string"), F.lit("not null"),
             F.col("latest").isNotNull()),
    )))


def quality_report(silver: DataFrame) -> DataFrame:
    """Printed summary lines: thousands-separated count, nulls, latest."""
    s = silver.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("temperature_c").isNull()).alias("nulls"),
        F.max("time").alias("latest"),
    )
    return s.select(F.inline(F.array(
        F.struct(F.lit("Total Silver rows").alias("metric"), F.format_number("total", 0).alias("text")),
        F.struct(F.lit("Null temperatures").alias("metric"), F.col("nulls").cast("string").alias("text")),
        F.struct(F.lit("Latest timestamp").alias("metric"),
                 F.coalesce(F.col("latest").cast("string"), F.lit("None")).alias("text")),
    )))


def gate_metrics():
    """Aggregates of the gate, for ``DataFrame.observe`` on the Silver write
    (computed while the table is written: no extra scan)."""
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("temperature_c").isNull()).alias("nulls"),
            F.max("time").alias("latest")]


def checks_from_metrics(metrics: dict, min_rows: int) -> list[dict]:
    total, nulls, latest = metrics.get("total", 0), metrics.get("nulls", 0), metrics.get("latest")
    return [
        {"check": "row_count", "observed": str(total), "expected": f"> {min_rows}", "passed": total > min_rows},
        {"check": "null_temperatures", "observed": str(nulls), "expected": "= 0", "passed": nulls == 0},
        {"check": "latest_time", "observed": None if latest is None else str(latest),
         "expected": "not null", "passed": latest is not None},
    ]


def enforce_rows(rows: list[dict]) -> None:
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityGateError("; ".join(f"{r['check']}: observed {r['observed']}, expected {r['expected']}"
                                         for r in failed))


def enforce(checks: DataFrame) -> None:
    """Raise when any gate check failed (reads the three-row table)."""
    failed = [r for r in checks.collect() if not r["passed"]]
    if failed:
        raise QualityGateError("; ".join(f"{r['check']}: observed {r['observed']}, expected {r['expected']}"
                                         for r in failed))


def table_counts(**frames: DataFrame) -> DataFrame:
    """Row counts of several frames as one row (one job per frame input,
    combined through scalar subqueries)."""
    first = None
    cols = []
    for name, df in frames.items():
        c = df.select(F.count(F.lit(1))).scalar().alias(f"{name}_rows")
        cols.append(c)
        first = first or df
    return first.sparkSession.range(1).select(*cols)
