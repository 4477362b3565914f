"""Replace a personal identifier with an anonymous one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anonymize_uuid(df: DataFrame, id_col: str, out_col: str) -> DataFrame:
    """Random version-4 UUID per row in ``out_col``; ``id_col`` is dropped.

    The value is random and re-drawn whenever the plan is evaluated again
    (including a retried task), so write the result once and read it back
    instead of evaluating the same frame twice. Within one write every row
    keeps the value its committed task drew, so ids stay unique.
    """
    return df.withColumn(out_col, F.uuid()).drop(id_col)


def anonymize_hash(df: DataFrame, id_col: str, out_col: str, salt: str) -> DataFrame:
    """Deterministic salted SHA-256 (hex) of ``salt|id``; ``id_col`` is dropped.

    The same id and salt always map to the same value, so tables anonymised
    in different runs can still be joined; without the salt the mapping
    cannot be rebuilt from the ids alone. A NULL id stays NULL.
    """
    digest = F.sha2(F.concat(F.lit(f"{salt}|"), F.col(id_col).cast("string")), 256)
    return df.withColumn(out_col, digest).drop(id_col)
