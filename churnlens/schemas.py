"""Table contracts and the fixed values the cleaning rules depend on.

The three tables of the retention job have explicit schemas: nothing is
inferred, and every write goes through :func:`churnlens.operators.conform.conform`
so the stored column order and types never drift.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------

SOURCE_COLUMNS = (
    "CustomerID",
    "Age",
    "Gender",
    "Tenure",
    "MonthlyCharges",
    "ContractType",
    "InternetService",
    "TotalCharges",
    "TechSupport",
    "Churn",
)

MONEY = T.DecimalType(10, 2)
# A customer's whole spend, which outgrows the money of one month.
TOTAL_MONEY = T.DecimalType(18, 2)

STAGING = T.StructType(
    [
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Tenure", T.IntegerType()),
        T.StructField("MonthlyCharges", MONEY),
        T.StructField("ContractType", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("TotalCharges", TOTAL_MONEY),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("Churn", T.StringType()),
        T.StructField("load_timestamp", T.TimestampNTZType()),
    ]
)

# Source columns only (what a CSV file carries).
SOURCE = T.StructType([STAGING[c] for c in SOURCE_COLUMNS])

PRODUCTION = T.StructType(
    [
        T.StructField("AnonymizedCustomerID", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("Tenure", T.IntegerType()),
        T.StructField("MonthlyCharges", MONEY),
        T.StructField("ContractType", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("TotalCharges", TOTAL_MONEY),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("Churn", T.StringType()),
        T.StructField("ChurnFlag", T.IntegerType()),
        T.StructField("MonthlyChargesCategory", T.StringType()),
        T.StructField("TenureCategory", T.StringType()),
        T.StructField("load_timestamp", T.TimestampNTZType()),
        T.StructField("processed_timestamp", T.TimestampNTZType()),
    ]
)

# Production content without the random id and the clock columns, keyed by
# the source id instead: the deterministic part of the table, which is what
# can be compared row for row between two engines or two runs.
PRODUCTION_COMPARABLE = T.StructType(
    [T.StructField("CustomerID", T.LongType())]
    + [
        f
        for f in PRODUCTION.fields
        if f.name not in ("AnonymizedCustomerID", "load_timestamp", "processed_timestamp")
    ]
)

# Metric values are stored as decimal(18,2): decimal(10,2) would overflow
# once a table passes 99,999,999 rows.
METRIC_VALUE = T.DecimalType(18, 2)

METRICS = T.StructType(
    [
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", METRIC_VALUE),
        T.StructField("run_timestamp", T.TimestampNTZType()),
    ]
)

# CSV lines that did not parse, with the reason and where they came from.
REJECTS = T.StructType(
    [
        T.StructField("reason", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("record", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("load_timestamp", T.TimestampNTZType()),
    ]
)

# Moments of each metric's history: enough to judge the next run without it.
METRIC_STATE = T.StructType(
    [
        T.StructField("metric_name", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("m2", T.DoubleType()),
        T.StructField("last_value", T.DoubleType()),
        T.StructField("last_timestamp", T.TimestampNTZType()),
    ]
)

# --------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# --------------------------------------------------------------------------

# Text cells read as missing: pandas' default NA token list for read_csv.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Constant fills for missing values, per column.
FILL_CONSTANTS = {
    "Gender": "Unknown",
    "Tenure": 0,
    "TotalCharges": 0.0,
    "ContractType": "Month-to-Month",
    "InternetService": "None",
    "TechSupport": "No",
    "Churn": "No",
}
# Filled with the exact median, truncated to an integer.
FILL_MEDIAN_INT = ("Age",)
# Filled with the unrounded mean.
FILL_MEAN = ("MonthlyCharges",)

# Churn flag: exactly this text (case-sensitive) is 1, anything else 0.
CHURN_YES = "Yes"

# Right-closed bins (lo, hi]; the last upper edge is open-ended.
CHARGE_EDGES = (0, 50, 100, None)
CHARGE_LABELS = ("Low", "Medium", "High")
TENURE_EDGES = (0, 12, 36, None)
TENURE_LABELS = ("New", "Medium", "Long")
# Label for values outside every bin (including 0 and negatives).
OUTSIDE_LABEL = "nan"

# Display bands for a percentage (left-closed lower bounds).
RATE_BANDS = ((80, "red"), (50, "yellow"))
RATE_BASE_BAND = "green"
TABLE_BANDS = ((80, "red"),)

# Quality metrics, in the order they are produced and stored.
METRIC_NAMES = (
    "total_records",
    "churn_rate_percent",
    "avg_monthly_charges",
    "avg_tenure_months",
    "distinct_contract_types",
    "distinct_genders",
)

# Number of newest metric rows the metrics report returns.
LATEST_METRICS_K = 10
