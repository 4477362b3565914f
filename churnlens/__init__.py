"""Customer-retention analytics on Spark.

Load raw customer records, clean and anonymise them, publish a production
table, keep a history of data-quality metrics, and answer KPI and segment
reports -- all as lazy DataFrame plans.
"""

__version__ = "0.1.0"
