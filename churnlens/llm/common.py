"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from churnlens.sinks.storage import delete_path

#: A word is a maximal run of characters other than space and TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of one Arrow batch of rows on their way to or from Python.
BATCH_BYTES = 4 << 20
#: The same where a task works on less at once and so gains nothing from more.
SMALL_BATCH_BYTES = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Rows of a few numbers, and words of text, in one file of a shared table.
FILE_ROWS = 200_000
FILE_WORDS = 2_500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Send whole texts to Python in batches of ``size`` bytes, unless the session was started with another bound.

    By default a batch has 10,000 rows and no useful bound in bytes, and a
    worker holds it several times over.
    """
    if not spark.sparkContext.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, str(size))


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none, a local session gets a temporary folder;
    on a cluster that would lose data, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="churnlens-"))
    return spark.sparkContext.getCheckpointDir()


#: Paths of shared tables written inside each ``scratch``, the innermost last.
_MADE: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the shared tables written inside, but for the last one.

    For a caller that has written what it wants from an operator: what the
    operator wrote on the way is then of no use.
    """
    _MADE.append([])
    try:
        yield
    finally:
        for path in _MADE.pop()[:-1]:
            delete_path(spark, path)


def shared_table(df: DataFrame, name: str, rows: int | None = None, words: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.

    ``rows``, at least as many as ``df`` has of a few numbers each, or ``words``,
    at least as many as its texts have, bounds the number of files, so that
    small tables do not become many tiny ones.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    if words is not None:
        df = df.coalesce(1 + words // FILE_WORDS)
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _MADE:
        _MADE[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def own_name(column: str, result: tuple[str, ...]) -> str:
    """``column``, unless the result has a column of its own by that name (then it raises)."""
    if column in result:
        raise ValueError(f"{column} is the name of a column of the result; rename the id first")
    return column


def utf8_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes."""
    return F.crc32(F.encode(text, "UTF-8"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))
