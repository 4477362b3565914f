"""What changed between two states of a table, by key and row digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.expressions import row_digest, sql_ident

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"
ADDED, REMOVED, CHANGED = "added", "removed", "changed"

DIGEST = "__digest"


def compared_columns(df: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in keys and c not in ignored]


def with_digest(df: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()) -> DataFrame:
    """``df`` with the digest of the columns that make a row another one."""
    return df.withColumn(DIGEST, row_digest(compared_columns(df, keys, ignored)))


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """Join condition on the keys of two aliased frames; NULL keys match."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{left}.{sql_ident(k)}").eqNullSafe(F.col(f"{right}.{sql_ident(k)}"))
    return on


def one_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = (), ignored: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the largest ``newest_by`` (compared left to right).

    Without ``newest_by`` rows of one key must agree in all columns that
    count (repeated rows become one), else the query raises. Combined
    map-side, so a key that holds most of the rows does not meet in one task.
    Rows that tie on ``newest_by`` are told apart by their digest.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    named = {c: f"c{i}" for i, c in enumerate(rest)}
    row = F.struct(*[F.col(sql_ident(c)).alias(n) for c, n in named.items()])
    digest = row_digest(compared_columns(df, keys, ignored))
    order = F.struct(*[F.col(sql_ident(c)).alias(f"o{i}") for i, c in enumerate(newest_by)], digest.alias("d"))
    picked = df.groupBy(*[sql_ident(k) for k in keys]).agg(
        F.max_by(row, order).alias("__row"),
        (F.lit(True) if newest_by else F.min(digest) == F.max(digest)).alias("__alike"),
    )
    message = F.concat(F.lit("rows that differ share the key "), F.to_json(F.struct(*[sql_ident(k) for k in keys])))
    checked = F.when(F.col("__alike"), F.col("__row")).otherwise(F.raise_error(message))
    fields = {c: checked.getField(n).alias(c) for c, n in named.items()}
    return picked.select(*[fields.get(c, F.col(sql_ident(c))) for c in df.columns])


def detect_changes(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()
) -> DataFrame:
    """``incoming`` (one row per key) with ``change``: insert, update or unchanged.

    Only keys and digests of ``current`` take part in the join; ``current``
    may hold its digest as ``__digest``, stored when it was written.
    ``ignored`` columns (load times) do not make a row changed.
    """
    known = current if DIGEST in current.columns else with_digest(current, keys, ignored)
    known = known.select(*[sql_ident(k) for k in keys], F.col(DIGEST).alias("__known"), F.lit(True).alias("__there"))
    fresh = incoming if DIGEST in incoming.columns else with_digest(incoming, keys, ignored)
    joined = fresh.alias("i").join(known.alias("k"), same_key("i", "k", keys), "left")
    change = (
        F.when(F.col("k.__there").isNull(), INSERT)
        .when(F.col(f"i.{DIGEST}") != F.col("k.__known"), UPDATE)
        .otherwise(UNCHANGED)
    )
    return joined.select(*[F.col(f"i.{sql_ident(c)}") for c in incoming.columns], change.alias("change"))


def row_difference(old: DataFrame, new: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()) -> DataFrame:
    """(keys..., difference) of rows added, removed or changed from ``old`` to ``new``.

    Both have one row per key. Keys and digests alone are shuffled: whole rows
    are hashed where they are read. The columns of both must be the same.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    new = new.select(*[sql_ident(c) for c in old.columns])
    sides = [
        with_digest(df, keys, ignored).select(
            *[sql_ident(k) for k in keys],
            F.when(F.lit(is_old), F.col(DIGEST)).alias("__old"),
            F.when(F.lit(not is_old), F.col(DIGEST)).alias("__new"),
        )
        for df, is_old in ((old, True), (new, False))
    ]
    # a group per key: combined map-side, NULL keys meet, no outer join needed
    met = sides[0].unionByName(sides[1]).groupBy(*[sql_ident(k) for k in keys]).agg(
        F.max("__old").alias("__old"), F.max("__new").alias("__new")
    )
    difference = (
        F.when(F.col("__old").isNull(), ADDED).when(F.col("__new").isNull(), REMOVED).when(F.col("__old") != F.col("__new"), CHANGED)
    )
    return met.select(*[sql_ident(k) for k in keys], difference.alias("difference")).filter("difference is not null")
