"""CSV source: header-checked, all-text read, missing-value tokens, typed casts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions.expressions import na_to_null, sql_ident
from churnlens.operators.conform import cast_to, try_cast_text
from churnlens.schemas import NA_TOKENS, SOURCE
from churnlens.sinks.storage import path_exists


CORRUPT = "__corrupt_record"
EXTRA_FIELD = "__extra_field"
REJECT = "__reject"

#: Why a line was rejected: its number of fields (or its quotes), or a value of the column named.
BAD_FIELDS, BAD_VALUE = "fields", "value"
REJECT_FIELDS = ("reason", "column_name", "record", "file_path", "block_start")


def read_text_csv(
    spark: SparkSession, path: str, multiline: bool = False, ragged: str = "fail"
) -> DataFrame:
    """Read a headed CSV file (or directory of files) with every column as text.

    Fields are split and unquoted by Spark (doubled quotes inside a quoted
    field are an escaped quote). A missing path raises ``FileNotFoundError``.
    ``multiline`` allows line breaks inside quoted fields but makes each file
    a single split, so leave it off for large inputs that do not need it.

    Every file's header is checked against the first one's while it is read:
    a file with other columns, or the same in another order, fails the read.

    ``ragged`` decides rows whose field count differs from the header:
    ``"fail"`` fails the read for any such row; ``"pad"`` fills missing
    trailing fields with NULL and still fails on a row with extra fields.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"CSV file not found: {path}")
    options = dict(header=True, escape='"', multiLine=multiline, enforceSchema=False)
    if ragged == "fail":
        return spark.read.csv(path, inferSchema=False, mode="FAILFAST", **options)
    if ragged != "pad":
        raise ValueError(f"unknown ragged mode {ragged!r}")
    header = spark.read.csv(path, inferSchema=False, **options).columns
    if not header:
        return spark.read.csv(path, inferSchema=False, **options)
    text = [T.StructField(c, T.StringType()) for c in header]
    # rows of another length are padded or cut, and kept whole in one more column
    padded = (
        spark.read.option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path, schema=T.StructType([*text, T.StructField(CORRUPT, T.StringType())]), mode="PERMISSIVE", **options)
    )
    longer = ", ".join(f"{sql_ident(c)} string" for c in [*header, EXTRA_FIELD])
    parsed = F.from_csv(F.col(CORRUPT), longer, {"escape": '"'})
    too_long = F.col(CORRUPT).isNotNull() & parsed[EXTRA_FIELD].isNotNull()
    guarded = F.when(too_long, F.raise_error(F.lit("CSV row has more fields than the header")))
    return padded.select(guarded.otherwise(F.col(header[0])).alias(header[0]), *[F.col(c) for c in header[1:]])


def _check_header(header: list[str], expected: list[str]) -> None:
    missing = [c for c in expected if c not in header]
    extra = [c for c in header if c not in expected]
    if missing or extra:
        raise ValueError(f"CSV header mismatch: missing={missing}, unexpected={extra}")


def text_to_typed(
    text: DataFrame,
    schema: T.StructType = SOURCE,
    na_tokens: tuple[str, ...] = NA_TOKENS,
) -> DataFrame:
    """All-text frame -> ``schema``: match columns by header name, NA -> NULL, cast.

    Columns are matched by name, not position, so a file with its columns in
    another order loads correctly; a missing or unexpected column raises.
    """
    expected = [f.name for f in schema.fields]
    _check_header(text.columns, expected)
    cleaned = text.select(*[na_to_null(c, na_tokens).alias(c) for c in expected])
    # A cell that is present but does not parse fails the load, whatever the
    # session's ANSI setting (with ANSI on the cast itself already fails).
    cols = []
    for f in schema.fields:
        cell = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            cols.append(cell)
            continue
        typed = cast_to(cell, T.StringType(), f.dataType)
        message = F.concat(
            F.lit(f"CSV value does not fit {f.name} {f.dataType.simpleString()}: "), cell
        )
        bad = cell.isNotNull() & typed.isNull()
        cols.append(F.when(bad, F.raise_error(message)).otherwise(typed).alias(f.name))
    return cleaned.select(*cols)


def read_source_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SOURCE,
    multiline: bool = False,
    ragged: str = "fail",
) -> DataFrame:
    """Headed CSV -> typed frame with ``schema`` (see :func:`text_to_typed`)."""
    return text_to_typed(read_text_csv(spark, path, multiline, ragged), schema)


def tag_source_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SOURCE,
    multiline: bool = False,
    na_tokens: tuple[str, ...] = NA_TOKENS,
) -> DataFrame:
    """Headed CSV -> ``schema`` plus ``__reject``, which is NULL for the rows that load.

    Where :func:`read_source_csv` fails the load, this reader tells which line
    is to blame: ``reason`` (``fields`` for a wrong number of fields or broken
    quotes, ``value`` for a cell that does not fit its type, with the first
    such ``column_name``), the ``record`` as a CSV line, its ``file_path`` and
    the ``block_start`` of the split it was read in. A header with other
    columns still fails, and so does a missing path. One scan; take the two
    kinds apart with :func:`accepted` and :func:`rejected`.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"CSV file not found: {path}")
    options = dict(header=True, escape='"', multiLine=multiline, enforceSchema=False)
    header = spark.read.csv(path, inferSchema=False, **options).columns
    expected = [f.name for f in schema.fields]
    _check_header(header, expected)
    whole = T.StructType([*[T.StructField(c, T.StringType()) for c in header], T.StructField(CORRUPT, T.StringType())])
    # a line of another length is kept whole in one more column, so no column may be pruned from the parser
    lines = (
        spark.read.option("columnPruning", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path, schema=whole, mode="PERMISSIVE", **options)
    )
    cells = {f.name: na_to_null(f.name, na_tokens) for f in schema.fields}
    typed = {
        f.name: cells[f.name] if isinstance(f.dataType, T.StringType) else try_cast_text(cells[f.name], f.dataType)
        for f in schema.fields
    }
    bad = [F.when(cells[c].isNotNull() & typed[c].isNull(), F.lit(c)) for c in expected]
    located = lines.select(
        *[typed[c].alias(c) for c in expected],
        F.col(CORRUPT),
        F.coalesce(*bad).alias("__column"),
        F.to_csv(F.struct(*[F.col(sql_ident(c)) for c in header]), {"escape": '"'}).alias("__line"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
    )
    corrupt = F.col(CORRUPT).isNotNull()
    reject = F.struct(
        F.when(corrupt, BAD_FIELDS).otherwise(BAD_VALUE).alias("reason"),
        F.when(~corrupt, F.col("__column")).alias("column_name"),
        F.coalesce(CORRUPT, "__line").alias("record"),
        F.col("__file").alias("file_path"),
        F.col("__start").alias("block_start"),
    )
    return located.select(*expected, F.when(corrupt | F.col("__column").isNotNull(), reject).alias(REJECT))


def accepted(tagged: DataFrame) -> DataFrame:
    """The rows of :func:`tag_source_csv` that load."""
    return tagged.filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(tagged: DataFrame) -> DataFrame:
    """(reason, column_name, record, file_path, block_start) of the lines that do not."""
    return tagged.filter(F.col(REJECT).isNotNull()).select(*[F.col(REJECT)[f].alias(f) for f in REJECT_FIELDS])
