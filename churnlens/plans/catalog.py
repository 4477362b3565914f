"""Registered queries and their SQL equivalents.

Every query reads the driver's tables (or frames Spark derives from them)
over their full size. Each Spark query is built from the library's
operators; the SQL next to it states the same result independently, so the
two can be checked against each other on another engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.functions.expressions import bin_right_closed, exact_avg, flag_equals, python_timestamp_text, utc_now
from churnlens.operators.anonymize import anonymize_hash, anonymize_uuid
from churnlens.operators.display import display_round, rate_band, select_field, table_band
from churnlens.operators.impute import impute, null_census
from churnlens.operators.quantile import exact_medians
from churnlens.operators.quality import (
    last_not_null,
    latest_metrics,
    metric_alerts,
    metric_trend,
    quality_metrics,
    reconcile,
    to_tall,
)
from churnlens.operators.reports import (
    band_counts,
    distinct_values,
    segment_profile,
    segment_rate,
    segment_rates,
    segment_totals,
    summary,
    to_json_lines,
)
from churnlens.plans.production import build_production, production_comparable
from churnlens.plans.stored_queries import STORED_QUERIES
from churnlens.schemas import SOURCE
from churnlens.sources.csv_source import text_to_typed
from churnlens.sources.testdata import (
    DAILY_EVENT_METRICS,
    daily_event_metrics,
    event_metric_rows,
    flagged_customers,
    lineitem_with_gaps,
    retention_csv_lines,
    retention_raw,
    retention_raw_text,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Salt of the deterministic-id example query.
HASH_SALT = "retention"
# Quantity bands of the line-item example (right-closed, last open).
QTY_EDGES = (0, 10, 25, 40, None)
QTY_LABELS = ("small", "medium", "large", "bulk")
# Decimals kept for window statistics whose float summation order differs
# between engines.
STAT_DECIMALS = 6


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned customer table the reports read."""
    return production_comparable(retention_raw(spark, sf_dir))


def q_staging_raw(spark, sf_dir):
    """Source rows as CSV text -> NA tokens -> typed staging columns."""
    return text_to_typed(retention_raw_text(spark, sf_dir), SOURCE)


def q_production_clean(spark, sf_dir):
    return _production(spark, sf_dir)


def q_summary(spark, sf_dir):
    return summary(_production(spark, sf_dir))


def q_churn_by_contract(spark, sf_dir):
    return segment_rate(_production(spark, sf_dir), "ContractType")


def q_analytics_by_contract(spark, sf_dir):
    return segment_profile(_production(spark, sf_dir), "ContractType")


def q_band_counts(spark, sf_dir):
    return band_counts(_production(spark, sf_dir))


def q_quality_metrics_wide(spark, sf_dir):
    return quality_metrics(_production(spark, sf_dir))


def q_quality_metrics_tall(spark, sf_dir):
    return to_tall(quality_metrics(_production(spark, sf_dir)))


def q_segment_services(spark, sf_dir):
    return segment_rate(_production(spark, sf_dir), "InternetService")


def q_segment_charges(spark, sf_dir):
    return segment_rate(_production(spark, sf_dir), "MonthlyChargesCategory")


def q_segment_tenure(spark, sf_dir):
    return segment_rate(_production(spark, sf_dir), "TenureCategory")


def q_rate_bands(spark, sf_dir):
    """Every segment report in one frame, with its dashboard colour bands."""
    keys = ("ContractType", "InternetService", "MonthlyChargesCategory", "TenureCategory")
    return table_band(rate_band(segment_rates(_production(spark, sf_dir), keys)))


def q_kpi_display(spark, sf_dir):
    """Summary KPIs as shown: churn-rate band, tenure to 1 decimal."""
    kpis = rate_band(summary(_production(spark, sf_dir)))
    return display_round(kpis, "avg_tenure", 1, "avg_tenure_display")


def q_null_census(spark, sf_dir):
    return null_census(retention_raw(spark, sf_dir))


def q_reconcile_counts(spark, sf_dir):
    return reconcile(retention_raw(spark, sf_dir), _production(spark, sf_dir))


def q_anonymize_hash(spark, sf_dir):
    """Salted hashes; an id that is NULL (every 31st) stays NULL."""
    customer = table(spark, sf_dir, "customer")
    gaps = customer.withColumn("c_custkey", F.when(F.col("c_custkey") % 31 != 0, F.col("c_custkey")))
    return anonymize_hash(gaps, "c_custkey", "anon_id", HASH_SALT)


def q_anonymize_uuid_shape(spark, sf_dir):
    """The full production build (random ids, clocks) checked by its invariants."""
    raw = retention_raw(spark, sf_dir).withColumn("load_timestamp", utc_now())
    prod = build_production(raw)
    ids = F.col("AnonymizedCustomerID")
    return prod.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(ids).alias("distinct_ids"),
        F.min(F.length(ids)).alias("min_len"),
        F.max(F.length(ids)).alias("max_len"),
        F.sum(F.col("processed_timestamp").isNull().cast("long")).alias("missing_clock"),
    )


def q_uuid_per_row(spark, sf_dir):
    """Random ids on every order row: count and uniqueness at volume."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    anon = anonymize_uuid(orders, "o_orderkey", "anon_id")
    return anon.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("anon_id").alias("distinct_ids"),
    )


def q_latest_metrics_topk(spark, sf_dir):
    rows = event_metric_rows(spark, sf_dir)
    return latest_metrics(rows, tiebreak=[F.col("event_id").desc()])


def q_last_not_null(spark, sf_dir):
    rows = event_metric_rows(spark, sf_dir)
    return last_not_null(rows, "metric_name", "metric_value", ["run_timestamp", "event_id"])


def _event_history(spark, sf_dir):
    return to_tall(daily_event_metrics(spark, sf_dir), DAILY_EVENT_METRICS, "run_timestamp")


def q_event_metric_history(spark, sf_dir):
    return _event_history(spark, sf_dir)


def q_metric_trend(spark, sf_dir):
    return metric_trend(_event_history(spark, sf_dir), DAILY_EVENT_METRICS)


def q_metric_alerts(spark, sf_dir):
    alerts = metric_alerts(_event_history(spark, sf_dir))
    return alerts.withColumns(
        {c: F.round(c, STAT_DECIMALS) for c in ("prior_mean", "prior_std", "pct_change")}
    )


def q_lineitem_quantity_bins(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    banded = li.withColumn("qty_band", bin_right_closed("l_quantity", QTY_EDGES, QTY_LABELS))
    return banded.groupBy("l_returnflag", "qty_band").agg(
        F.count(F.lit(1)).alias("items"),
        F.round(exact_avg(F.col("l_extendedprice").cast("decimal(12,2)")), 2).alias("avg_price"),
    )


def q_lineitem_impute(spark, sf_dir):
    gaps = lineitem_with_gaps(spark, sf_dir)
    return impute(gaps, median_int=["qty"], mean=["price"], mode=["returnflag"])


def q_lineitem_segment_profile(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        flag_equals("l_linestatus", "O").alias("open_flag"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
        F.col("l_quantity").cast("int").alias("qty"),
    )
    return segment_profile(li, "l_returnflag", "open_flag", "price", "qty", segment="returnflag")


def q_lineitem_medians(spark, sf_dir):
    """Exact medians of whole line-item columns, ranked slice by slice."""
    li = table(spark, sf_dir, "lineitem")
    cols = ("l_extendedprice", "l_quantity", "l_discount")
    medians = exact_medians(li, list(cols))
    return medians.select(*[F.col(c).alias(f"median_{c[2:]}") for c in cols])


def q_staging_csv_lines(spark, sf_dir):
    """CSV lines (quotes, NA tokens, ``25.0`` integers) -> typed staging columns."""
    lines = retention_csv_lines(spark, sf_dir)
    text = ", ".join(f"{c} string" for c in SOURCE.names)
    parsed = lines.select(F.from_csv("value", text, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return text_to_typed(parsed, SOURCE)


def q_flag_rate_bands(spark, sf_dir):
    """Segments with high, middle and low rates and NULL flags, with their colours."""
    return table_band(rate_band(segment_rate(flagged_customers(spark, sf_dir), "region", "flag")))


def _placed(report: DataFrame) -> DataFrame:
    """A report (a few rows) with the place of each row in its own order."""
    placed = report.withColumn("place", F.monotonically_increasing_id())  # ascends through a sorted frame
    return placed.withColumn("place", F.row_number().over(Window.orderBy("place")))


def q_churn_by_contract_order(spark, sf_dir):
    """The contract report with each row's place: riskiest first."""
    return _placed(segment_rate(_production(spark, sf_dir), "ContractType"))


def q_flag_rate_order(spark, sf_dir):
    """Segments by falling rate, ties and a NULL segment included."""
    df = flagged_customers(spark, sf_dir).withColumn("segment", F.concat_ws("-", "region", F.col("tenure") % 5))
    return _placed(segment_rate(df, "segment", "flag"))


def q_flag_profile(spark, sf_dir):
    """NULL flags counted as 0, NULL averages reported as 0."""
    df = flagged_customers(spark, sf_dir)
    return segment_profile(df, "region", "flag", "charges", "tenure", segment="region")


def q_flag_totals(spark, sf_dir):
    return segment_totals(flagged_customers(spark, sf_dir), "region", "flag")


def q_flag_values(spark, sf_dir):
    return distinct_values(flagged_customers(spark, sf_dir), "flag")


def q_long_tenure_customers(spark, sf_dir):
    """Rows kept by a filter, in ascending order of their id."""
    kept = _production(spark, sf_dir).filter((F.col("Tenure") > 36) & (F.col("ContractType") == "Two-Year"))
    return kept.select("CustomerID", "Tenure", "MonthlyCharges").orderBy("CustomerID")


def q_kpi_field(spark, sf_dir):
    return select_field(summary(_production(spark, sf_dir)), "churn_rate")


def q_reconcile_dropped(spark, sf_dir):
    """Staging against a production table that lost every tenth row."""
    return reconcile(retention_raw(spark, sf_dir), _production(spark, sf_dir).filter("CustomerID % 10 <> 0"))


def q_contract_json(spark, sf_dir):
    """Churn by raw contract type as JSON lines; the missing type is a null key."""
    raw = retention_raw(spark, sf_dir).withColumn("ChurnFlag", flag_equals("Churn", "Yes"))
    return to_json_lines(segment_rate(raw, "ContractType"))


def q_timestamp_text(spark, sf_dir):
    """Timestamps inside a daylight-saving gap as text, whatever the session's zone."""
    at = (
        "TIMESTAMP_NTZ'2024-03-10 02:00:00' + make_dt_interval(0, 0, 0, "
        "CAST(event_id % 3600 AS DECIMAL(18, 6)) + CAST(event_id % 4 AS DECIMAL(18, 6)) * 0.25)"
    )
    return table(spark, sf_dir, "events").select("event_id", python_timestamp_text(F.expr(at)).alias("at_text"))


QUERIES: dict[str, Query] = {
    "staging_raw": q_staging_raw,
    "production_clean": q_production_clean,
    "summary": q_summary,
    "churn_by_contract": q_churn_by_contract,
    "analytics_by_contract": q_analytics_by_contract,
    "band_counts": q_band_counts,
    "quality_metrics_wide": q_quality_metrics_wide,
    "quality_metrics_tall": q_quality_metrics_tall,
    "segment_services": q_segment_services,
    "segment_charges": q_segment_charges,
    "segment_tenure": q_segment_tenure,
    "rate_bands": q_rate_bands,
    "kpi_display": q_kpi_display,
    "null_census": q_null_census,
    "reconcile_counts": q_reconcile_counts,
    "anonymize_hash": q_anonymize_hash,
    "anonymize_uuid_shape": q_anonymize_uuid_shape,
    "uuid_per_row": q_uuid_per_row,
    "latest_metrics_topk": q_latest_metrics_topk,
    "last_not_null": q_last_not_null,
    "event_metric_history": q_event_metric_history,
    "metric_trend": q_metric_trend,
    "metric_alerts": q_metric_alerts,
    "lineitem_quantity_bins": q_lineitem_quantity_bins,
    "lineitem_impute": q_lineitem_impute,
    "lineitem_segment_profile": q_lineitem_segment_profile,
    "lineitem_medians": q_lineitem_medians,
    "staging_csv_lines": q_staging_csv_lines,
    "flag_rate_bands": q_flag_rate_bands,
    "churn_by_contract_order": q_churn_by_contract_order,
    "flag_rate_order": q_flag_rate_order,
    "flag_profile": q_flag_profile,
    "flag_totals": q_flag_totals,
    "flag_values": q_flag_values,
    "long_tenure_customers": q_long_tenure_customers,
    "kpi_field": q_kpi_field,
    "reconcile_dropped": q_reconcile_dropped,
    "contract_json": q_contract_json,
    "timestamp_text": q_timestamp_text,
    **STORED_QUERIES,
}


# ---------------------------------------------------------------------------
# SQL side (DuckDB dialect; the test tables are registered as views)
# ---------------------------------------------------------------------------

RAW_SQL = """
raw AS (
  SELECT CAST(c_custkey AS BIGINT) AS CustomerID,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(18 + (c_custkey * 7) % 63 AS INT) END AS Age,
    CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS Gender,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST((c_custkey * 5) % 61 AS INT) END AS Tenure,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE
      CAST(CAST(CAST(ROUND(ABS(c_acctbal) * 100) AS BIGINT) % 14001 AS DOUBLE) / 100 AS DECIMAL(10,2)) END AS MonthlyCharges,
    CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Month-to-Month'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN 'One-Year'
         WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Two-Year' ELSE NULL END AS ContractType,
    CASE WHEN c_nationkey % 3 = 0 THEN 'Fiber Optic' WHEN c_nationkey % 3 = 1 THEN 'DSL' ELSE NULL END AS InternetService,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(total_spend AS DECIMAL(18,2)) END AS TotalCharges,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS TechSupport,
    CASE WHEN c_custkey % 29 = 0 THEN NULL
         WHEN last_order < TIMESTAMP '2001-01-01 00:00:00' THEN 'Yes' ELSE 'No' END AS Churn
  FROM customer LEFT JOIN (
    SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(10,2))) AS total_spend, MAX(o_orderdate) AS last_order
    FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey
)"""

PROD_SQL = """
stats AS (
  SELECT CAST(TRUNC(MEDIAN(Age)) AS BIGINT) AS med_age,
         CAST(SUM(MonthlyCharges) AS DOUBLE) / COUNT(MonthlyCharges) AS mean_charge
  FROM raw
),
filled AS (
  SELECT CustomerID,
    COALESCE(CAST(Age AS BIGINT), med_age) AS Age,
    COALESCE(Gender, 'Unknown') AS Gender,
    COALESCE(Tenure, 0) AS Tenure,
    COALESCE(CAST(MonthlyCharges AS DOUBLE), mean_charge) AS MonthlyCharges,
    COALESCE(ContractType, 'Month-to-Month') AS ContractType,
    COALESCE(InternetService, 'None') AS InternetService,
    COALESCE(TotalCharges, CAST(0 AS DECIMAL(18,2))) AS TotalCharges,
    COALESCE(TechSupport, 'No') AS TechSupport,
    COALESCE(Churn, 'No') AS Churn
  FROM raw CROSS JOIN stats
),
production AS (
  SELECT CustomerID,
    CAST(Age AS INTEGER) AS Age,
    Gender,
    CAST(Tenure AS INTEGER) AS Tenure,
    CAST(MonthlyCharges AS DECIMAL(10,2)) AS MonthlyCharges,
    ContractType, InternetService, TotalCharges, TechSupport, Churn,
    CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS ChurnFlag,
    CASE WHEN MonthlyCharges > 0 AND MonthlyCharges <= 50 THEN 'Low'
         WHEN MonthlyCharges > 50 AND MonthlyCharges <= 100 THEN 'Medium'
         WHEN MonthlyCharges > 100 THEN 'High' ELSE 'nan' END AS MonthlyChargesCategory,
    CASE WHEN Tenure > 0 AND Tenure <= 12 THEN 'New'
         WHEN Tenure > 12 AND Tenure <= 36 THEN 'Medium'
         WHEN Tenure > 36 THEN 'Long' ELSE 'nan' END AS TenureCategory
  FROM filled
)"""


def _with_prod(select: str) -> str:
    return f"WITH {RAW_SQL},{PROD_SQL}\n{select}"


def _rate(flag: str) -> str:
    return f"CAST(SUM({flag}) AS DOUBLE) / COUNT({flag}) * 100"


def _avg(col: str) -> str:
    return f"CAST(SUM({col}) AS DOUBLE) / COUNT({col})"


def _segment_sql(key: str, alias: str) -> str:
    return f"""
SELECT {key} AS {alias}, COUNT(*) AS count,
  COALESCE(ROUND({_rate('ChurnFlag')}, 2), 0) AS churn_rate
FROM production GROUP BY {key}
ORDER BY churn_rate DESC NULLS LAST, {alias} ASC NULLS LAST"""


SUMMARY_SQL = f"""
SELECT COUNT(*) AS total_customers,
  COALESCE(ROUND({_rate('ChurnFlag')}, 2), 0) AS churn_rate,
  COALESCE(ROUND({_avg('MonthlyCharges')}, 2), 0) AS avg_monthly_charges,
  COALESCE(ROUND({_avg('Tenure')}, 2), 0) AS avg_tenure
FROM production"""

WIDE_METRICS_SQL = f"""
SELECT COUNT(*) AS total_records,
  ROUND({_rate('ChurnFlag')}, 2) AS churn_rate_percent,
  ROUND({_avg('MonthlyCharges')}, 2) AS avg_monthly_charges,
  ROUND({_avg('Tenure')}, 2) AS avg_tenure_months,
  COUNT(DISTINCT ContractType) AS distinct_contract_types,
  COUNT(DISTINCT Gender) AS distinct_genders
FROM production"""


def _tall_sql(wide_cte: str, names: tuple[str, ...], run_col: str | None) -> str:
    run = f", {run_col} AS run_timestamp" if run_col else ""
    parts = [
        f"SELECT '{n}' AS metric_name, CAST(COALESCE({n}, 0) AS DECIMAL(18,2)) AS metric_value{run} "
        f"FROM {wide_cte}"
        for n in names
    ]
    return "\nUNION ALL\n".join(parts)


METRIC_NAMES_SQL = (
    "total_records",
    "churn_rate_percent",
    "avg_monthly_charges",
    "avg_tenure_months",
    "distinct_contract_types",
    "distinct_genders",
)

DAILY_SQL = f"""
daily AS (
  SELECT date_trunc('day', ts) AS run_timestamp,
    COUNT(*) AS total_records,
    ROUND({_rate("CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END")}, 2) AS purchase_rate_percent,
    ROUND({_avg('CAST(value AS DECIMAL(10,2))')}, 2) AS avg_value,
    COUNT(DISTINCT user_id) AS distinct_users,
    COUNT(DISTINCT event_type) AS distinct_event_types
  FROM events GROUP BY 1
),
history AS (
{_tall_sql('daily', DAILY_EVENT_METRICS, 'run_timestamp')}
)"""

_SEGMENT_KEYS = (
    ("ContractType", "contract_type"),
    ("InternetService", "internet_service"),
    ("MonthlyChargesCategory", "monthly_charges_category"),
    ("TenureCategory", "tenure_category"),
)


def _band(col: str) -> str:
    return f"CASE WHEN {col} >= 80 THEN 'red' WHEN {col} >= 50 THEN 'yellow' ELSE 'green' END"


def _rate_bands_sql() -> str:
    parts = [
        f"SELECT '{key}' AS segment_key, {key} AS segment, COUNT(*) AS count, "
        f"COALESCE(ROUND({_rate('ChurnFlag')}, 2), 0) AS churn_rate FROM production GROUP BY {key}"
        for key, _ in _SEGMENT_KEYS
    ]
    union = "\nUNION ALL\n".join(parts)
    return _with_prod(
        f"""SELECT segment_key, segment, count, churn_rate, {_band('churn_rate')} AS rate_band,
  CASE WHEN churn_rate >= 80 THEN 'red' ELSE 'green' END AS table_band
FROM ({union}) s"""
    )


def _trend_sql() -> str:
    cols = ",\n  ".join(
        f"MAX(CASE WHEN metric_name = '{n}' THEN metric_value END) AS {n}_value,\n"
        f"  MAX(CASE WHEN metric_name = '{n}' THEN delta END) AS {n}_delta"
        for n in DAILY_EVENT_METRICS
    )
    return f"""WITH {DAILY_SQL.strip()},
d AS (
  SELECT *, metric_value - LAG(metric_value) OVER (PARTITION BY metric_name ORDER BY run_timestamp) AS delta
  FROM history
)
SELECT run_timestamp,
  {cols}
FROM d GROUP BY run_timestamp"""


ALERTS_SQL = f"""WITH {DAILY_SQL.strip()},
w AS (
  SELECT metric_name, run_timestamp, CAST(metric_value AS DOUBLE) AS metric_value,
    AVG(CAST(metric_value AS DOUBLE)) OVER (PARTITION BY metric_name ORDER BY run_timestamp
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_mean,
    STDDEV_SAMP(CAST(metric_value AS DOUBLE)) OVER (PARTITION BY metric_name ORDER BY run_timestamp
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_std,
    LAG(CAST(metric_value AS DOUBLE)) OVER (PARTITION BY metric_name ORDER BY run_timestamp) AS prev_value
  FROM history
)
SELECT metric_name, run_timestamp, metric_value,
  ROUND(prior_mean, {STAT_DECIMALS}) AS prior_mean,
  ROUND(prior_std, {STAT_DECIMALS}) AS prior_std,
  ABS(metric_value - prior_mean) > 2.0 * prior_std AS sigma_alert,
  CASE WHEN metric_name = 'total_records' THEN
    ROUND((metric_value - prev_value) / NULLIF(ABS(prev_value), 0) * 100, {STAT_DECIMALS}) END AS pct_change,
  CASE WHEN metric_name = 'total_records' THEN
    ABS((metric_value - prev_value) / NULLIF(ABS(prev_value), 0) * 100) > 10.0 END AS volume_alert
FROM w"""


def _qty_band_sql(col: str) -> str:
    edges, labels = QTY_EDGES, QTY_LABELS
    arms = []
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = f"{col} > {lo}" + (f" AND {col} <= {hi}" if hi is not None else "")
        arms.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(arms) + " ELSE 'nan' END"


LINEITEM_GAPS_SQL = """
gaps AS (
  SELECT l_orderkey, l_linenumber, l_linestatus,
    CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS qty,
    CASE WHEN l_orderkey % 5 = 1 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS price,
    CASE WHEN l_orderkey % 11 = 2 THEN NULL ELSE l_returnflag END AS returnflag
  FROM lineitem
),
flag_counts AS (
  SELECT returnflag, COUNT(*) AS n FROM gaps WHERE returnflag IS NOT NULL GROUP BY returnflag
),
gap_stats AS (
  SELECT CAST(TRUNC(MEDIAN(qty)) AS BIGINT) AS med_qty,
         CAST(SUM(price) AS DOUBLE) / COUNT(price) AS mean_price,
         (SELECT returnflag FROM flag_counts ORDER BY n DESC, returnflag ASC LIMIT 1) AS mode_flag
  FROM gaps
)"""


FLAGGED_SQL = """
f AS (
  SELECT CASE WHEN c_nationkey % 3 = 0 THEN 'north' WHEN c_nationkey % 3 = 1 THEN 'south' END AS region,
    CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_nationkey % 3 = 0 THEN CAST(c_custkey % 10 < 9 AS INT)
      WHEN c_nationkey % 3 = 1 THEN CAST(c_custkey % 10 < 6 AS INT) ELSE CAST(c_custkey % 10 < 2 AS INT) END AS flag,
    CASE WHEN c_nationkey % 3 = 1 THEN NULL ELSE CAST(ROUND(ABS(c_acctbal), 2) AS DECIMAL(10,2)) END AS charges,
    CAST(c_custkey % 61 AS INT) AS tenure
  FROM customer
)"""

_NULL_AS_ZERO = "CASE WHEN flag = 1 THEN 1 ELSE 0 END"

# The feed of the incremental load, and what is left after it.
FEED_SQL = """
near AS (SELECT * FROM customer WHERE (c_custkey // 250) % 2 = 1),
feed AS (
  SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal) FROM near
  UNION ALL SELECT * REPLACE (c_custkey + 100000000 AS c_custkey) FROM near WHERE c_custkey % 10 = 0
)"""

# Why the last digit of every third customer's id keeps the CSV line from loading.
_REJECTED_SQL = "CustomerID % 3 = 2 AND CustomerID % 10 IN (2, 3, 4, 5)"

ORACLE_SQL: dict[str, str] = {
    "incremental_load": f"""WITH {FEED_SQL}
SELECT * FROM feed UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM feed)""",
    "incremental_changes": f"""WITH {FEED_SQL}
SELECT c_custkey, CASE WHEN c_custkey > 100000000 THEN 'insert' WHEN c_custkey % 3 = 0 THEN 'update' ELSE 'unchanged' END AS change
FROM feed""",
    "version_difference": """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'added' WHEN o_orderkey % 13 = 0 THEN 'removed' ELSE 'changed' END AS difference
FROM orders WHERE (o_orderkey % 11 = 0) <> (o_orderkey % 13 = 0)
  OR (o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 7 = 0)""",
    "csv_files_loaded": f"WITH {RAW_SQL}\nSELECT * FROM raw WHERE NOT ({_REJECTED_SQL})",
    "csv_files_rejected": f"""WITH {RAW_SQL}
SELECT CustomerID AS customer_id, CASE WHEN CustomerID % 10 IN (4, 5) THEN 'fields' ELSE 'value' END AS reason,
  CASE CustomerID % 10 WHEN 2 THEN 'Age' WHEN 3 THEN 'TotalCharges' END AS column_name, true AS located
FROM raw WHERE {_REJECTED_SQL}""",
    "job_staging": f"WITH {RAW_SQL}\nSELECT *, true AS stamped FROM raw",
    "job_contract_report": _with_prod(_segment_sql("ContractType", "contract_type")),
    "job_metric_history": f"""WITH {RAW_SQL},{PROD_SQL},
wide AS ({WIDE_METRICS_SQL}), tall AS ({_tall_sql('wide', METRIC_NAMES_SQL, None)})
SELECT metric_name, metric_value, CAST(2 AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS runs FROM tall""",
    "metric_alerts_incremental": ALERTS_SQL.replace(
        "ABS(metric_value - prior_mean) > 2.0 * prior_std AS",
        "ABS(metric_value - prior_mean) - 2.0 * prior_std > 1e-9 * ABS(metric_value) AS",
    ),
    "medians_of_loads": "SELECT MEDIAN(l_extendedprice) AS median_extendedprice, MEDIAN(l_quantity) AS median_quantity, "
    "MEDIAN(l_discount) AS median_discount FROM lineitem",
    "distinct_of_loads": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, COUNT(DISTINCT {c}) AS exact, true AS within_bound FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus")
    ),
    "lineitem_modes": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, (SELECT {text} FROM lineitem GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1) AS mode"
        for c, text in (
            ("l_returnflag", "l_returnflag"),
            ("l_quantity", "CAST(l_quantity AS VARCHAR)"),
            ("l_shipdate", "strftime(l_shipdate, '%Y-%m-%d')"),
            ("l_partkey", "CAST(l_partkey AS VARCHAR)"),
        )
    ),
    "history_compacted": f"WITH {DAILY_SQL.strip()}\nSELECT * FROM history",
    "stable_ids": """
SELECT COUNT(*) AS n_ids, COUNT(*) AS n_uuids,
  COUNT(*) FILTER (WHERE c_custkey % 3 <> 0 AND c_custkey % 2 = 0) AS kept, CAST(0 AS BIGINT) AS lost
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0""",
    "job_resumed": f"""WITH {RAW_SQL},{PROD_SQL},
wide AS ({WIDE_METRICS_SQL}), tall AS ({_tall_sql('wide', METRIC_NAMES_SQL, None)})
SELECT metric_name, metric_value, CAST(1 AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS runs FROM tall""",
    "staging_csv_lines": f"WITH {RAW_SQL}\nSELECT * FROM raw",
    "flag_rate_bands": f"""WITH {FLAGGED_SQL}
SELECT region, count, churn_rate, {_band('churn_rate')} AS rate_band,
  CASE WHEN churn_rate >= 80 THEN 'red' ELSE 'green' END AS table_band
FROM (SELECT region, COUNT(*) AS count, COALESCE(ROUND({_rate('flag')}, 2), 0) AS churn_rate FROM f GROUP BY region)""",
    "churn_by_contract_order": _with_prod(
        "SELECT *, CAST(row_number() OVER (ORDER BY churn_rate DESC NULLS LAST, contract_type NULLS LAST) AS INTEGER) AS place "
        f"FROM ({_segment_sql('ContractType', 'contract_type')}) s"
    ),
    "flag_rate_order": f"""WITH {FLAGGED_SQL}, s AS (
  SELECT COALESCE(region || '-', '') || tenure % 5 AS segment, COUNT(*) AS count, COALESCE(ROUND({_rate('flag')}, 2), 0) AS churn_rate
  FROM f GROUP BY 1)
SELECT *, CAST(row_number() OVER (ORDER BY churn_rate DESC NULLS LAST, segment NULLS LAST) AS INTEGER) AS place FROM s""",
    "flag_profile": f"""WITH {FLAGGED_SQL}
SELECT COUNT(*) AS total_customers, COALESCE({_rate(_NULL_AS_ZERO)}, 0) AS churn_rate,
  COALESCE({_avg('charges')}, 0) AS avg_monthly_charges, COALESCE({_avg('tenure')}, 0) AS avg_tenure,
  region AS region_type, COUNT(*) AS region_count, COALESCE({_rate(_NULL_AS_ZERO)}, 0) AS region_churn_rate
FROM f GROUP BY region""",
    "flag_totals": f"WITH {FLAGGED_SQL}\nSELECT region, COUNT(*) AS count, CAST(SUM(flag) AS BIGINT) AS churned "
    "FROM f GROUP BY region ORDER BY region NULLS LAST",
    "flag_values": f"WITH {FLAGGED_SQL}\nSELECT DISTINCT flag FROM f ORDER BY flag NULLS LAST",
    "long_tenure_customers": _with_prod(
        "SELECT CustomerID, Tenure, MonthlyCharges FROM production "
        "WHERE Tenure > 36 AND ContractType = 'Two-Year' ORDER BY CustomerID"
    ),
    "kpi_field": _with_prod(f"SELECT churn_rate FROM ({SUMMARY_SQL}) s"),
    "reconcile_dropped": _with_prod(
        "SELECT (SELECT COUNT(*) FROM raw) AS staging_rows, "
        "(SELECT COUNT(*) FROM production WHERE CustomerID % 10 <> 0) AS production_rows, "
        "(SELECT COUNT(*) FROM raw) = (SELECT COUNT(*) FROM production WHERE CustomerID % 10 <> 0) AS matches"
    ),
    "contract_json": f"""WITH {RAW_SQL}
SELECT '{{"contract_type":' || COALESCE('"' || ContractType || '"', 'null') || ',"count":' || COUNT(*)
  || ',"churn_rate":' || COALESCE(ROUND({_rate("CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END")}, 2), 0) || '}}' AS value
FROM raw GROUP BY ContractType""",
    "timestamp_text": """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN strftime(t, '%Y-%m-%d %H:%M:%S')
  ELSE strftime(t, '%Y-%m-%d %H:%M:%S.%f') END AS at_text
FROM (SELECT event_id, TIMESTAMP '2024-03-10 02:00:00' + to_milliseconds((event_id % 3600) * 1000 + (event_id % 4) * 250) AS t
  FROM events) s""",

    "staging_raw": f"WITH {RAW_SQL}\nSELECT * FROM raw",
    "production_clean": _with_prod("SELECT * FROM production"),
    "summary": _with_prod(SUMMARY_SQL),
    "churn_by_contract": _with_prod(_segment_sql("ContractType", "contract_type")),
    "analytics_by_contract": _with_prod(
        f"""
SELECT COUNT(*) AS total_customers,
  COALESCE({_rate('CASE WHEN ChurnFlag = 1 THEN 1 ELSE 0 END')}, 0) AS churn_rate,
  COALESCE({_avg('MonthlyCharges')}, 0) AS avg_monthly_charges,
  COALESCE({_avg('Tenure')}, 0) AS avg_tenure,
  ContractType AS contract_type,
  COUNT(*) AS contract_count,
  COALESCE({_rate('CASE WHEN ChurnFlag = 1 THEN 1 ELSE 0 END')}, 0) AS contract_churn_rate
FROM production GROUP BY ContractType"""
    ),
    "band_counts": _with_prod(
        "SELECT MonthlyChargesCategory, TenureCategory, COUNT(*) AS customers "
        "FROM production GROUP BY MonthlyChargesCategory, TenureCategory"
    ),
    "quality_metrics_wide": _with_prod(WIDE_METRICS_SQL),
    "quality_metrics_tall": f"WITH {RAW_SQL},{PROD_SQL},\nwide AS ({WIDE_METRICS_SQL})\n"
    + _tall_sql("wide", METRIC_NAMES_SQL, None),
    "segment_services": _with_prod(_segment_sql("InternetService", "internet_service")),
    "segment_charges": _with_prod(
        _segment_sql("MonthlyChargesCategory", "monthly_charges_category")
    ),
    "segment_tenure": _with_prod(_segment_sql("TenureCategory", "tenure_category")),
    "rate_bands": _rate_bands_sql(),
    "kpi_display": _with_prod(
        f"""SELECT *, {_band('churn_rate')} AS rate_band, ROUND(avg_tenure, 1) AS avg_tenure_display
FROM ({SUMMARY_SQL}) s"""
    ),
    "null_census": f"WITH {RAW_SQL}\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
        f"AS null_count, ROUND(CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) "
        f"/ COUNT(*) * 100, 2) AS missing_pct FROM raw"
        for c in SOURCE.names
    ),
    "reconcile_counts": _with_prod(
        "SELECT (SELECT COUNT(*) FROM raw) AS staging_rows, "
        "(SELECT COUNT(*) FROM production) AS production_rows, "
        "(SELECT COUNT(*) FROM raw) = (SELECT COUNT(*) FROM production) AS matches"
    ),
    "anonymize_hash": f"""
SELECT c_name, c_nationkey, c_acctbal, c_mktsegment,
  sha256('{HASH_SALT}' || '|' || CAST(CASE WHEN c_custkey % 31 <> 0 THEN c_custkey END AS VARCHAR)) AS anon_id
FROM customer""",
    "anonymize_uuid_shape": """
SELECT COUNT(*) AS n_rows, COUNT(*) AS distinct_ids, CAST(36 AS INTEGER) AS min_len,
  CAST(36 AS INTEGER) AS max_len, CAST(0 AS BIGINT) AS missing_clock
FROM customer""",
    "uuid_per_row": "SELECT COUNT(*) AS n_rows, COUNT(*) AS distinct_ids FROM orders",
    "latest_metrics_topk": """
SELECT metric_name, metric_value, timestamp FROM (
  SELECT event_type AS metric_name, CASE WHEN event_id % 2 = 0 THEN 0 ELSE COALESCE(value, 0) END AS metric_value,
    CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp
  FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 10
) t""",
    "last_not_null": """
SELECT metric_name, last_metric_value, last_run_timestamp, last_event_id FROM (
  SELECT event_type AS metric_name, value AS last_metric_value, ts AS last_run_timestamp,
    event_id AS last_event_id,
    ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE value IS NOT NULL AND event_id % 2 <> 0
) t WHERE rn = 1""",
    "event_metric_history": f"WITH {DAILY_SQL.strip()}\nSELECT * FROM history",
    "metric_trend": _trend_sql(),
    "metric_alerts": ALERTS_SQL,
    "lineitem_quantity_bins": f"""
SELECT l_returnflag, {_qty_band_sql('l_quantity')} AS qty_band, COUNT(*) AS items,
  ROUND({_avg('CAST(l_extendedprice AS DECIMAL(12,2))')}, 2) AS avg_price
FROM lineitem GROUP BY 1, 2""",
    "lineitem_impute": f"""WITH {LINEITEM_GAPS_SQL.strip()}
SELECT l_orderkey, l_linenumber, l_linestatus,
  COALESCE(qty, CAST(med_qty AS DOUBLE)) AS qty,
  COALESCE(CAST(price AS DOUBLE), mean_price) AS price,
  COALESCE(returnflag, mode_flag) AS returnflag
FROM gaps CROSS JOIN gap_stats""",
    "lineitem_segment_profile": f"""
WITH li AS (
  SELECT l_returnflag, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS open_flag,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS INTEGER) AS qty
  FROM lineitem
)
SELECT COUNT(*) AS total_customers,
  COALESCE({_rate('CASE WHEN open_flag = 1 THEN 1 ELSE 0 END')}, 0) AS churn_rate,
  COALESCE({_avg('price')}, 0) AS avg_monthly_charges,
  COALESCE({_avg('qty')}, 0) AS avg_tenure,
  l_returnflag AS returnflag_type,
  COUNT(*) AS returnflag_count,
  COALESCE({_rate('CASE WHEN open_flag = 1 THEN 1 ELSE 0 END')}, 0) AS returnflag_churn_rate
FROM li GROUP BY l_returnflag""",
    "lineitem_medians": """
SELECT MEDIAN(l_extendedprice) AS median_extendedprice, MEDIAN(l_quantity) AS median_quantity,
  MEDIAN(l_discount) AS median_discount
FROM lineitem""",
}
