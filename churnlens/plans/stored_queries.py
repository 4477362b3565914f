"""Registered queries that go through files and published tables.

Each writes what Spark derives from the test tables to a new folder on shared
storage and reads it back through the library's own sources: CSV files with
rejects, the job's three tables, versions, incremental loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.expressions import utc_now
from churnlens.operators.changes import detect_changes, row_difference
from churnlens.operators.moments import advanced_state, incremental_alerts, metric_state
from churnlens.operators.quality import to_tall
from churnlens.operators.quantile import exact_medians, median_sketches, sketched_brackets
from churnlens.operators.sketches import DISTINCT_ERROR, distinct_sketches, most_frequent_value, sketched_distinct
from churnlens.plans.job import RetentionELT
from churnlens.plans.reports import report
from churnlens.schemas import METRICS, SOURCE, SOURCE_COLUMNS, STAGING
from churnlens.sinks.history import compact_history, read_history
from churnlens.sinks.id_map import anonymize_mapped, id_map_table
from churnlens.sinks.incremental import KeyedTable, load_incremental, read_keyed
from churnlens.sinks.publish import append, publish, read_published
from churnlens.sinks.storage import work_folder
from churnlens.sources.csv_source import accepted, rejected, tag_source_csv
from churnlens.sources.tables import read_metrics, read_staging
from churnlens.sources.testdata import (
    DAILY_EVENT_METRICS,
    daily_event_metrics,
    retention_raw,
    retention_raw_text,
    table,
)

# Decimals kept for statistics whose float summation order differs between engines.
STAT_DECIMALS = 6
# Loads that the incremental history comes in.
LOADS = 3


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed for the customer table: of every second block of 250 ids, rows with another
    balance (every third id), rows as they were, and new customers (every tenth id)."""
    customer = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    near = customer.filter(F.expr("c_custkey DIV 250 % 2 = 1"))
    balance = F.when(k % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    new = near.filter(k % 10 == 0).withColumn("c_custkey", k + 100_000_000)
    return near.withColumn("c_acctbal", balance).unionByName(new)


def customer_table(spark: SparkSession, sf_dir: str) -> KeyedTable:
    schema = table(spark, sf_dir, "customer").schema
    return KeyedTable(work_folder(spark, "customer"), schema, ("c_custkey",), "c_custkey DIV 250")


def q_incremental_load(spark, sf_dir):
    """The customer table after a first load and a feed of new and changed rows."""
    stored = customer_table(spark, sf_dir)
    load_incremental(table(spark, sf_dir, "customer"), stored)
    load_incremental(customer_feed(spark, sf_dir), stored)
    return read_keyed(spark, stored)


def q_incremental_changes(spark, sf_dir):
    """What each row of the feed does to the customer table."""
    changes = detect_changes(table(spark, sf_dir, "customer"), customer_feed(spark, sf_dir), ["c_custkey"])
    return changes.select("c_custkey", "change")


def q_version_difference(spark, sf_dir):
    """Rows that two published versions of the orders table do not share."""
    orders, base, k = table(spark, sf_dir, "orders"), work_folder(spark, "orders"), F.col("o_orderkey")
    old, _ = publish(orders.filter(k % 11 != 0), base)
    priority = F.when(k % 7 != 0, F.col("o_orderpriority"))
    publish(orders.filter(k % 13 != 0).withColumn("o_orderpriority", priority), base)
    before = read_published(spark, base, orders.schema, old.rsplit("/", 1)[1])
    return row_difference(before, read_published(spark, base, orders.schema), ["o_orderkey"])


def write_customer_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw customer table as CSV files: quoted throughout, quoted where needed, and raw
    lines in which every tenth customer has too few fields, one too many or a bad value."""
    path, raw, k = work_folder(spark, "customer-csv"), retention_raw_text(spark, sf_dir), F.col("CustomerID").cast("long")
    options = dict(header=True, escape='"', emptyValue="")
    raw.filter(k % 3 == 0).write.csv(path, quoteAll=True, **options)
    raw.filter(k % 3 == 1).write.mode("append").csv(path, **options)
    last = k % 10
    cells = {c: F.col(c) for c in SOURCE_COLUMNS}
    cells["Age"] = F.when(last == 2, "young").otherwise(F.col("Age"))
    cells["TotalCharges"] = F.when(last == 3, "12.5.7").otherwise(F.col("TotalCharges"))
    cells["Churn"] = F.when(last == 4, "No,again").otherwise(F.col("Churn"))
    line: Column = F.concat_ws(",", *cells.values())
    line = F.when(last == 5, F.concat_ws(",", *list(cells.values())[:4])).otherwise(line)
    # one column named like the header, written without quotes: lines as they are
    lines = raw.filter(k % 3 == 2).select(line.alias(",".join(SOURCE_COLUMNS)))
    lines.write.mode("append").csv(path, header=True, sep="\x01", quote="\x00", emptyValue="")
    return path


def q_csv_files_loaded(spark, sf_dir):
    """CSV files of different quoting, without the lines that do not parse."""
    return accepted(tag_source_csv(spark, write_customer_csv(spark, sf_dir), SOURCE))


def q_csv_files_rejected(spark, sf_dir):
    """The lines that do not parse, by customer, with the reason and whether they can be found again."""
    bad = rejected(tag_source_csv(spark, write_customer_csv(spark, sf_dir), SOURCE))
    return bad.select(
        F.split("record", ",")[0].cast("long").alias("customer_id"),
        "reason",
        "column_name",
        (F.col("file_path").endswith(".csv") & (F.col("block_start") >= 0)).alias("located"),
    )


def customer_job(spark: SparkSession, sf_dir: str) -> RetentionELT:
    """The job over CSV files of the whole customer table."""
    top = work_folder(spark, "job")
    retention_raw_text(spark, sf_dir).write.csv(f"{top}/csv", header=True, escape='"', emptyValue="")
    return RetentionELT(spark, f"{top}/staging", f"{top}/production", f"{top}/csv", f"{top}/metrics")


def q_job_staging(spark, sf_dir):
    """CSV files -> staging, read back, without the load time."""
    job = customer_job(spark, sf_dir)
    job.extract_and_load()
    staged = read_staging(spark, job.staging_path)
    return staged.select(*SOURCE.names, F.col("load_timestamp").isNotNull().alias("stamped"))


def q_job_contract_report(spark, sf_dir):
    """The contract report of the production table that the job published."""
    job = customer_job(spark, sf_dir)
    job.extract_and_load()
    job.transform()
    return report(spark, "churn_by_contract", job.production_path, job.metrics_path)


def q_job_metric_history(spark, sf_dir):
    """The metric history after two metric runs: per metric its values, rows and runs."""
    job = customer_job(spark, sf_dir)
    publish(retention_raw(spark, sf_dir).withColumn("load_timestamp", utc_now()), job.staging_path, STAGING)
    job.transform()
    for _ in range(2):
        job.generate_data_quality_metrics()
    history = read_metrics(spark, job.metrics_path)
    return history.groupBy("metric_name", "metric_value").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("run_timestamp").alias("runs")
    )


def q_metric_alerts_incremental(spark, sf_dir):
    """Alerts of the metric history, loaded in three steps, each judged by the state before it."""
    path = work_folder(spark, "history")
    to_tall(daily_event_metrics(spark, sf_dir), DAILY_EVENT_METRICS, "run_timestamp").write.parquet(f"{path}/rows")
    history = spark.read.parquet(f"{path}/rows")
    first = history.agg(F.min("run_timestamp")).scalar()
    days = F.datediff("run_timestamp", first)
    span = history.agg(F.datediff(F.max("run_timestamp"), F.min("run_timestamp")) + 1).scalar()
    state, out = metric_state(history.filter("false")), None
    for step in range(LOADS):
        rows = history.filter(F.floor(days * LOADS / span) == step)
        alerts = incremental_alerts(state, rows)
        out = alerts if out is None else out.unionByName(alerts)
        advanced_state(state, rows).write.parquet(f"{path}/state-{step}")
        state = spark.read.parquet(f"{path}/state-{step}")
    return out.withColumns({c: F.round(c, STAT_DECIMALS) for c in ("prior_mean", "prior_std", "pct_change")})


def q_medians_of_loads(spark, sf_dir):
    """Exact medians of line-item columns, bracketed by sketches stored with each of two loads."""
    li, path = table(spark, sf_dir, "lineitem"), work_folder(spark, "median-sketches")
    cols = ("l_extendedprice", "l_quantity", "l_discount")
    for load in (F.col("l_linenumber") <= 3, F.col("l_linenumber") > 3):
        median_sketches(li.filter(load), cols).coalesce(1).write.mode("append").parquet(path)
    medians = exact_medians(li, cols, sketched_brackets(spark.read.parquet(path), cols))
    return medians.select(*[F.col(c).alias(f"median_{c[2:]}") for c in cols])


def q_distinct_of_loads(spark, sf_dir):
    """Distinct counts of the orders table from sketches stored per priority, beside the exact ones."""
    orders, path, cols = table(spark, sf_dir, "orders"), work_folder(spark, "distinct-sketches"), ("o_orderkey", "o_custkey", "o_orderstatus")
    distinct_sketches(orders, cols, ["o_orderpriority"]).coalesce(1).write.parquet(path)
    guessed = sketched_distinct(spark.read.parquet(path))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in cols]).unpivot([], list(cols), "column", "exact")
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return exact.join(guessed, "column").select("column", "exact", (off <= 3 * DISTINCT_ERROR * F.col("exact")).alias("within_bound"))


def q_lineitem_modes(spark, sf_dir):
    """The most frequent values of line-item columns of few, some and very many values."""
    li, out = table(spark, sf_dir, "lineitem"), None
    for c in ("l_returnflag", "l_quantity", "l_shipdate", "l_partkey"):
        text = F.date_format(c, "yyyy-MM-dd") if c == "l_shipdate" else F.col(c).cast("string")
        row = most_frequent_value(li.select(c), c).select(F.lit(c).alias("column"), text.alias("mode"))
        out = row if out is None else out.unionByName(row)
    return out


def q_history_compacted(spark, sf_dir):
    """The event metric history, appended load by load, compacted, and appended to again."""
    path = work_folder(spark, "history")
    rows = to_tall(daily_event_metrics(spark, sf_dir), DAILY_EVENT_METRICS, "run_timestamp")
    for load in range(LOADS):
        append(rows.filter(F.pmod(F.dayofyear("run_timestamp"), F.lit(LOADS)) == load).coalesce(2), path, METRICS)
        if load < LOADS - 1:
            compact_history(spark, path, METRICS)
    return read_history(spark, path, METRICS)


def q_stable_ids(spark, sf_dir):
    """Anonymous ids of two loads that share some customers."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("key"))
    ids = id_map_table(work_folder(spark, "ids"), customer.schema["c_custkey"].dataType, parts=8)
    one = anonymize_mapped(customer.filter("key % 3 <> 0"), "c_custkey", "one", ids)
    two = anonymize_mapped(customer.filter("key % 2 = 0"), "c_custkey", "two", ids)
    return one.join(two, "key", "full").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.count_distinct(F.coalesce("one", "two")).alias("n_uuids"),
        F.count_if(F.col("one") == F.col("two")).alias("kept"),
        F.count_if(F.col("one") != F.col("two")).alias("lost"),
    )


def q_job_resumed(spark, sf_dir):
    """The metric history after a run that was started three times under one name."""
    job = customer_job(spark, sf_dir)
    for _ in range(3):
        job.run_full_pipeline("first")
    history = read_metrics(spark, job.metrics_path)
    return history.groupBy("metric_name", "metric_value").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("run_timestamp").alias("runs")
    )


STORED_QUERIES = {
    "incremental_load": q_incremental_load,
    "incremental_changes": q_incremental_changes,
    "version_difference": q_version_difference,
    "csv_files_loaded": q_csv_files_loaded,
    "csv_files_rejected": q_csv_files_rejected,
    "job_staging": q_job_staging,
    "job_contract_report": q_job_contract_report,
    "job_metric_history": q_job_metric_history,
    "metric_alerts_incremental": q_metric_alerts_incremental,
    "medians_of_loads": q_medians_of_loads,
    "distinct_of_loads": q_distinct_of_loads,
    "lineitem_modes": q_lineitem_modes,
    "history_compacted": q_history_compacted,
    "stable_ids": q_stable_ids,
    "job_resumed": q_job_resumed,
}
