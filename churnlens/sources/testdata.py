"""Inputs derived from the driver's parquet tables.

The retention job works on one flat customer table. The test tables are a
star schema without NULLs, so the customer table is derived from
``customer`` joined with per-customer order totals, and NULLs are placed by a
rule on the key (every row is kept; only some cells become NULL). All of it
is lazy DataFrame code whose work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.expressions import flag_equals
from churnlens.schemas import MONEY, TOTAL_MONEY

# Customers whose newest order is older than this count as churned.
CHURN_CUTOFF = "2001-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(key: Column, modulus: int, value: Column) -> Column:
    return F.when(key % F.lit(modulus) == F.lit(0), F.lit(None)).otherwise(value)


def retention_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw customer table (source schema, with NULLs), one row per customer.

    Order totals are aggregated per customer first (partial aggregation, so a
    customer with a huge share of orders costs one row per task), then joined
    to ``customer`` on the key; the aggregate is already hash-partitioned on
    the join key, so only the customer side is shuffled for the join.
    """
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    spend = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.sum(F.col("o_totalprice").cast(MONEY)).alias("total_spend"),
            F.max("o_orderdate").alias("last_order"),
        )
    )
    joined = customer.join(spend, customer.c_custkey == spend.o_custkey, "left")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    nation = F.col("c_nationkey")
    cents = F.round(F.abs(F.col("c_acctbal")) * F.lit(100)).cast("bigint") % F.lit(14001)
    cutoff = F.to_timestamp_ntz(F.lit(CHURN_CUTOFF))
    return joined.select(
        k.cast("long").alias("CustomerID"),
        _null_when(k, 11, (F.lit(18) + (k * F.lit(7)) % F.lit(63)).cast("int")).alias("Age"),
        _null_when(k, 13, F.when(k % 2 == 0, F.lit("Male")).otherwise(F.lit("Female"))).alias(
            "Gender"
        ),
        _null_when(k, 17, ((k * F.lit(5)) % F.lit(61)).cast("int")).alias("Tenure"),
        _null_when(k, 19, (cents.cast("double") / F.lit(100)).cast(MONEY)).alias(
            "MonthlyCharges"
        ),
        F.when(seg.isin("MACHINERY", "BUILDING"), F.lit("Month-to-Month"))
        .when(seg == "AUTOMOBILE", F.lit("One-Year"))
        .when(seg == "HOUSEHOLD", F.lit("Two-Year"))
        .alias("ContractType"),
        F.when(nation % 3 == 0, F.lit("Fiber Optic"))
        .when(nation % 3 == 1, F.lit("DSL"))
        .alias("InternetService"),
        _null_when(k, 23, F.col("total_spend").cast(TOTAL_MONEY)).alias("TotalCharges"),
        _null_when(
            k, 5, F.when(k % 3 == 0, F.lit("Yes")).otherwise(F.lit("No"))
        ).alias("TechSupport"),
        _null_when(
            k,
            29,
            F.when(F.col("last_order") < cutoff, F.lit("Yes")).otherwise(F.lit("No")),
        ).alias("Churn"),
    )


def retention_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw customer table as CSV-style text: every cell a string, NULL as ''."""
    raw = retention_raw(spark, sf_dir)
    return raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in raw.columns])


def retention_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw customer table as CSV lines (one ``value`` column): every second
    row quotes its text cells, missing cells are written as changing NA tokens,
    and integers of every third row carry a fraction of zero."""
    raw = retention_raw(spark, sf_dir)
    k = F.col("CustomerID")
    cells = []
    for f in raw.schema.fields:
        text = F.col(f.name).cast("string")
        if f.dataType.typeName() == "integer":
            text = F.when(k % 3 == 0, F.concat(text, F.lit(".0"))).otherwise(text)
        elif f.dataType.typeName() == "string":
            text = F.when(k % 2 == 0, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)
        token = F.when(k % 4 == 0, F.lit("NA")).when(k % 4 == 1, F.lit("null")).otherwise(F.lit(""))
        cells.append(F.coalesce(text, token))
    return raw.select(F.concat_ws(",", *cells).alias("value"))


def flagged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a flag whose rate differs by segment (high, middle, low),
    NULL flags, and a segment without any charges."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    third = nation % 3
    hit = F.when(third == 0, k % 10 < 9).when(third == 1, k % 10 < 6).otherwise(k % 10 < 2)
    return table(spark, sf_dir, "customer").select(
        F.when(third == 0, F.lit("north")).when(third == 1, F.lit("south")).alias("region"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(hit.cast("int")).alias("flag"),
        F.when(third == 1, F.lit(None)).otherwise(F.round(F.abs("c_acctbal"), 2).cast(MONEY)).alias("charges"),
        (k % 61).cast("int").alias("tenure"),
    )


def event_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as metric-history rows: ``(metric_name, metric_value, run_timestamp, event_id)``;
    the value of every second event is NULL."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric_name"),
        _null_when(F.col("event_id"), 2, F.col("value")).alias("metric_value"),
        F.col("ts").alias("run_timestamp"),
        "event_id",
    )


DAILY_EVENT_METRICS = (
    "total_records",
    "purchase_rate_percent",
    "avg_value",
    "distinct_users",
    "distinct_event_types",
)


def daily_event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide metric row per day of events: each day read as one load run.

    ``run_timestamp`` is the day's start. The aggregate is partial, and the
    distinct counts are de-duplicated per task before the shuffle, so a day
    (or a user) holding a large share of events stays cheap.
    """
    events = table(spark, sf_dir, "events")
    # Day start via a date: zone-less all the way (date_trunc would return a
    # zoned timestamp that depends on the session time zone).
    day = F.col("ts").cast("date").cast("timestamp_ntz")
    # Sums and counts add up, so rows are grouped by (day, type, user) first and
    # both distinct counts work on those groups, not on every event.
    groups = events.groupBy(day.alias("run_timestamp"), "event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(flag_equals("event_type", "purchase")).alias("purchases"),
        F.sum(F.col("value").cast(MONEY)).alias("total"),
        F.count("value").alias("valued"),
    )
    share = F.try_divide(F.sum("purchases").cast("double"), F.sum("n")) * F.lit(100)
    average = F.try_divide(F.sum("total").cast("double"), F.sum("valued"))
    return groups.groupBy("run_timestamp").agg(
        F.sum("n").alias("total_records"),
        F.round(share, 2).alias("purchase_rate_percent"),
        F.round(average, 2).alias("avg_value"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.count_distinct("event_type").alias("distinct_event_types"),
    )


def lineitem_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with NULLs placed by key rule, for imputation at volume.

    ``qty`` (l_quantity, NULL when orderkey % 7 = 0), ``price`` (extended
    price as decimal(12,2), NULL when orderkey % 5 = 1), ``returnflag``
    (NULL when orderkey % 11 = 2); every row is kept.
    """
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("qty"),
        F.when(k % 5 == 1, F.lit(None))
        .otherwise(F.col("l_extendedprice").cast("decimal(12,2)"))
        .alias("price"),
        F.when(k % 11 == 2, F.lit(None)).otherwise(F.col("l_returnflag")).alias("returnflag"),
    )
