"""The four report endpoints as DataFrame functions over the published tables.

Each returns a lazy frame shaped like the endpoint's JSON (field names,
NULL/0 reported as 0); :func:`report_json` renders one as JSON lines.
Nothing here writes: reports only read the current table versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.operators.display import display_round, rate_band, table_band
from churnlens.operators.quality import latest_metrics
from churnlens.operators.reports import (
    segment_profile,
    segment_rate,
    segment_rates,
    summary,
    to_json_lines,
)
from churnlens.sources.tables import read_metrics, read_production


def summary_report(spark: SparkSession, production_base: str) -> DataFrame:
    return summary(read_production(spark, production_base))


def churn_by_contract_report(spark: SparkSession, production_base: str) -> DataFrame:
    return segment_rate(read_production(spark, production_base), "ContractType")


def analytics_report(spark: SparkSession, production_base: str) -> DataFrame:
    return segment_profile(read_production(spark, production_base), "ContractType")


def metrics_report(spark: SparkSession, metrics_path: str) -> DataFrame:
    return latest_metrics(read_metrics(spark, metrics_path))


# Reports that are one object, not a list.
ONE_ROW_REPORTS = ("summary", "kpi_display")

# Segment reports by other keys: services, charge band, tenure band.
SEGMENT_REPORTS = {
    "churn_by_service": "InternetService",
    "churn_by_charges": "MonthlyChargesCategory",
    "churn_by_tenure": "TenureCategory",
}


def kpi_display_report(spark: SparkSession, production_base: str) -> DataFrame:
    """Summary KPIs with the churn-rate colour band and tenure to 1 decimal."""
    kpis = rate_band(summary_report(spark, production_base))
    return display_round(kpis, "avg_tenure", 1, "avg_tenure_display")


def segments_report(spark: SparkSession, production_base: str) -> DataFrame:
    """All segment reports in one pass, with their colour bands."""
    keys = ("ContractType", *SEGMENT_REPORTS.values())
    return table_band(rate_band(segment_rates(read_production(spark, production_base), keys)))


def report(spark: SparkSession, name: str, production_base: str, metrics_path: str) -> DataFrame:
    """Report by name: ``summary``, ``churn_by_contract``, ``analytics``, ``metrics``,
    ``churn_by_service``, ``churn_by_charges``, ``churn_by_tenure``, ``kpi_display``,
    ``segments``."""
    if name == "metrics":
        return metrics_report(spark, metrics_path)
    builders = {
        "summary": summary_report,
        "churn_by_contract": churn_by_contract_report,
        "analytics": analytics_report,
        "kpi_display": kpi_display_report,
        "segments": segments_report,
    }
    if name in SEGMENT_REPORTS:
        return segment_rate(read_production(spark, production_base), SEGMENT_REPORTS[name])
    if name not in builders:
        known = sorted([*builders, *SEGMENT_REPORTS, "metrics"])
        raise KeyError(f"unknown report {name!r}; expected one of {known}")
    return builders[name](spark, production_base)


def report_json(spark: SparkSession, name: str, production_base: str, metrics_path: str) -> DataFrame:
    """The report as JSON lines (one object per row, in report order)."""
    return to_json_lines(report(spark, name, production_base, metrics_path))


def main(argv: list[str] | None = None) -> int:
    """``python -m churnlens.plans.reports NAME --production P --metrics M``.

    Prints the report on stdout: an object for a one-row report (``summary``,
    ``kpi_display``), else a JSON array with one object per row, in report
    order; rows are streamed partition by partition, not gathered.
    """
    import argparse
    import sys

    from churnlens.session import get_spark

    parser = argparse.ArgumentParser(description="Print a report as JSON.")
    parser.add_argument("name")
    parser.add_argument("--production", required=True, help="production table base path")
    parser.add_argument("--metrics", required=True, help="metric history path")
    args = parser.parse_args(argv)

    spark = get_spark("churnlens-report")
    out = sys.stdout
    opening, closing = ("", "") if args.name in ONE_ROW_REPORTS else ("[", "]")
    out.write(opening)
    for i, row in enumerate(report_json(spark, args.name, args.production, args.metrics).toLocalIterator()):
        out.write(("," if i else "") + row[0])
    out.write(closing + "\n")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
