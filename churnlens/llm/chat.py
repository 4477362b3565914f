"""Chat formatting: many record layouts to one template, with a loss mask.

The layout of a table (or of each JSON record) is recognised by a fingerprint:
the sha256 of the nested field paths that the most specific layout it holds
takes from it, so extra columns do not matter, known names among them. The
fingerprint selects a declarative ``Layout`` that turns the record into
canonical turns (id, turn, role, text).

The template marks turns as ``<|im_start|>role<|im_sep|>text<|im_end|>``.
Control strings inside roles and texts (this template's and those of other
common ones) are broken by a backslash after their first character, and
backslashes are doubled; ``unescape`` undoes both exactly.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that never appear unbroken inside a formatted text: the first
#: character, and the rest of each.
CONTROL = r"([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>)"


@dataclass(frozen=True)
class Layout:
    """How one record layout maps to turns.

    ``rows``: one row per turn, with (order, role, text) columns.
    ``array``: (array, role field, text field), one element per turn.
    ``fields``: (role, field) pairs, one turn each, before an array's turns; those in ``optional`` may be absent.
    """

    name: str
    rows: tuple[str, str, str] | None = None
    array: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()

    def paths(self) -> frozenset[str]:
        if self.rows:
            return frozenset(self.rows)
        inside = frozenset(f"{self.array[0]}[].{f}" for f in self.array[1:]) if self.array else frozenset()
        return inside | {f for _, f in self.fields}

    def variants(self) -> list[frozenset[str]]:
        """The paths with all, some and none of the optional ones."""
        drops = chain.from_iterable(combinations(self.optional, k) for k in range(len(self.optional) + 1))
        return [self.paths() - set(d) for d in drops]

    def fingerprints(self) -> list[str]:
        return [path_hash(v) for v in self.variants()]


def path_hash(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


LAYOUTS = (
    Layout("turn_rows", rows=("turn", "role", "text")),
    Layout("messages", array=("messages", "role", "content"), fields=(("system", "system"),), optional=("system",)),
    Layout("from_value", array=("conversations", "from", "value"), fields=(("system", "system"),), optional=("system",)),
    Layout(
        "instruction",
        fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
        optional=("system", "input"),
    ),
    Layout(
        "prompt", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)
    ),
    Layout(
        "completion", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system",)
    ),
)
KNOWN_PATHS = sorted(frozenset().union(*(x.paths() for x in LAYOUTS)))
#: (paths, layout), most specific first: by needed paths, then by all; the first that a record holds is taken.
VARIANTS = sorted(
    ((v, x) for x in LAYOUTS for v in x.variants()), key=lambda p: (len(p[1].optional) - len(p[1].paths()), -len(p[0]))
)
#: The declarative mapping that each fingerprint selects.
MAPPINGS = {path_hash(paths): layout for paths, layout in VARIANTS}
#: Role names of other layouts and their canonical form.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def schema_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` marks an array's elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind for p in schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint_of(schema: T.StructType) -> str:
    """sha256 of the nested field paths of the most specific shape that the schema holds
    (of all its known paths, if it holds none)."""
    known = frozenset(schema_paths(schema)) & frozenset(KNOWN_PATHS)
    return path_hash(next((paths for paths, _ in VARIANTS if paths <= known), known))


def layout_of(schema: T.StructType) -> Layout:
    """The mapping that the schema's fingerprint selects."""
    found = MAPPINGS.get(fingerprint_of(schema))
    if found is None:
        known = sorted(set(schema_paths(schema)) & set(KNOWN_PATHS))
        raise ValueError(f"no layout is registered for the field paths {known}")
    return found


def _renamed(role: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])[role], role)


def _array_turns(found: Column, role: str, text: str) -> Column:
    """Array of (role, text) of a layout by array."""

    def turn(x: Column) -> Column:
        return F.struct(_renamed(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))

    return F.transform(found, turn)


def _field_turns(layout: Layout, present) -> Column:
    """Array of (role, text) of a layout by fields; null and empty optional fields make no turn."""
    turns = [
        F.when(
            F.lit(f not in layout.optional) | (F.coalesce(present(f), F.lit("")) != ""),
            F.struct(F.lit(role).alias("role"), F.coalesce(present(f), F.lit("")).alias("text")),
        )
        for role, f in layout.fields
    ]
    return F.array_compact(F.array(*turns))


def _layout_turns(layout: Layout, found: Column | None, present) -> Column:
    """Array of (role, text) of a layout by fields, by array, or by fields beside an array."""
    turns = _field_turns(layout, present)
    if layout.array:
        items = _array_turns(found, *layout.array[1:])
        return F.coalesce(F.concat(turns, items), turns)
    return turns


def canonical_turns(df: DataFrame, id_col: str = "conv_id", fingerprint: bool = False) -> DataFrame:
    """(id, turn long, role, text) of a table in any registered layout, and the ``fingerprint`` if asked for.

    The fingerprint of the table's schema selects the mapping. Null role or
    text becomes empty; a record without turns gives no row; an unknown layout
    raises with its paths.
    """
    layout = layout_of(df.schema)
    if layout.rows:
        order, role, text = layout.rows
        turns = df.select(
            id_col, F.col(order).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
        )
    else:
        items = _layout_turns(
            layout,
            F.col(layout.array[0]) if layout.array else None,
            lambda f: F.col(f).cast("string") if f in df.columns else F.lit(None).cast("string"),
        )
        turns = df.select(id_col, F.posexplode(items).alias("turn", "t")).select(
            id_col, F.col("turn").cast("long").alias("turn"), "t.role", "t.text"
        )
    return turns.select(
        id_col,
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
        *([F.lit(fingerprint_of(df.schema)).alias("fingerprint")] if fingerprint else []),
    )


def canonical_turns_json(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """The same for JSON records of mixed layouts, fingerprinted record by record.

    Returns (id, fingerprint, layout, turn, role, text); a record of unknown
    layout, or one that is not JSON, keeps one row with null layout and turn.
    """
    v = F.try_parse_json(json_col)

    def probe(path: str) -> Column:
        outer, _, inner = path.partition("[].")
        if not inner:
            return F.try_variant_get("__v", f"$.{path}", "variant").isNotNull()
        items = F.try_variant_get("__v", f"$.{outer}", "array<variant>")
        some = F.exists(items, lambda x: F.try_variant_get(x, f"$.{inner}", "variant").isNotNull())
        return F.coalesce(some, F.lit(False))

    hits = df.select(id_col, v.alias("__v")).withColumn(
        "__hits", F.array_compact(F.array(*[F.when(probe(p), F.lit(p)) for p in KNOWN_PATHS]))
    )
    held = [
        F.when(F.size(F.array_except(F.array(*[F.lit(p) for p in sorted(paths)]), "__hits")) == 0, F.lit(path_hash(paths)))
        for paths, layout in VARIANTS
        if not layout.rows
    ]
    named = hits.withColumn("fingerprint", F.coalesce(*held, F.sha2(F.array_join("__hits", "\n"), 256)))
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    name = F.lit(None).cast("string")
    for layout in LAYOUTS:
        if layout.rows:
            continue
        found = None
        if layout.array:
            array, role, text = layout.array
            found = F.try_variant_get("__v", f"$.{array}", f"array<struct<`{role}`:string,`{text}`:string>>")
        items = _layout_turns(layout, found, lambda f: F.try_variant_get("__v", f"$.{f}", "string"))
        chosen = F.col("fingerprint").isin(layout.fingerprints())
        turns, name = F.when(chosen, items).otherwise(turns), F.when(chosen, F.lit(layout.name)).otherwise(name)
    return (
        named.select(id_col, "fingerprint", name.alias("layout"), F.posexplode_outer(turns).alias("turn", "t"))
        .select(id_col, "fingerprint", "layout", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_conversations(turns: DataFrame, id_col: str = "conv_id", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: id, formatted, loss_mask, and the fingerprint that its turns came with.

    Turns are ordered by (turn, role, text), so repeated turn numbers have one
    order. ``loss_mask`` has one entry per turn: the code points (0-based)
    where the turn and its text start, and how many of the text are under the
    loss (0 for other roles).
    """
    role, text = escape(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit(SEP))
    parts = (
        turns.withColumn("__piece", F.concat(head, text, F.lit(END)))
        .withColumn("__head", F.char_length(head))
        .withColumn("__len", F.char_length("__piece"))
    )
    before = Window.partitionBy(id_col).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    place = Window.partitionBy(id_col).orderBy("turn", "role", "text")
    placed = parts.withColumn("__start", F.coalesce(F.sum("__len").over(before), F.lit(0))).withColumn(
        "__k", F.row_number().over(place)
    )
    under = F.when(F.col("role") == loss_role, F.col("__len") - F.col("__head") - len(END)).otherwise(0)
    entry = F.struct(
        "__k",
        F.col("__piece"),
        F.struct(
            F.col("__start").alias("turn_start"),
            (F.col("__start") + F.col("__head")).alias("start"),
            under.cast("long").alias("length"),
        ).alias("mask"),
    )
    if "fingerprint" not in turns.columns:
        placed = placed.withColumn("fingerprint", F.lit(None).cast("string"))
    rows = placed.groupBy(id_col).agg(
        F.sort_array(F.collect_list(entry)).alias("__t"), F.min("fingerprint").alias("fingerprint")
    )
    return rows.select(
        id_col,
        "fingerprint",
        F.array_join(F.transform("__t", lambda x: x["__piece"]), "").alias("formatted"),
        F.transform("__t", lambda x: x["mask"]).alias("loss_mask"),
    )


def read_back(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Turns and loss texts recovered from the formatted string and its mask.

    Returns id, turns (array of role, text), loss_texts (array), formatted, fingerprint.
    """
    pieces = F.split("formatted", r"<\|im_start\|>")
    cut = formatted.withColumn("__p", F.slice(pieces, F.lit(2), F.size(pieces)))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, SEP, 1)
        skip = F.char_length(role) + len(SEP)
        text = F.substring(piece, skip + 1, F.char_length(piece) - skip - len(END))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    def masked(pair: Column) -> Column:
        span = pair["loss_mask"]
        begin = span["start"] - span["turn_start"] - len(START) + 1
        return unescape(F.substring(pair["__p"], begin.cast("int"), span["length"].cast("int")))

    spans = F.filter(F.arrays_zip("__p", "loss_mask"), lambda x: x["loss_mask"]["length"] > 0)
    return cut.select(
        id_col, F.transform("__p", turn).alias("turns"), F.transform(spans, masked).alias("loss_texts"), "formatted", "fingerprint"
    )


def union_turns(*tables: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Canonical turns of several tables, each in its own layout, with its fingerprint."""
    return reduce(DataFrame.unionByName, [canonical_turns(t, id_col, fingerprint=True) for t in tables])
