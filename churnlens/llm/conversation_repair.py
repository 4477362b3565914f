"""Conversation structure repair: cheapest edits by bidirectional Dijkstra.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Its
edit lattice has a node for every number of rows consumed and every state of
that pattern; edges keep, rerole or delete the next row, or insert an empty
one. Two heaps search it, from the start and from the accepting ends. When
they have met, both go on until no crossing can be as cheap as the best one,
and of the equally cheap crossings the one with the least concatenated audit
is taken.

At scale: faults and the order of rows are found by Spark. A task then streams
sorted conversations; of the rows of a conversation it holds one code byte
each and the lattice over them (some 300 bytes a row), never the texts. The
audits meet the texts in a second sorted stream, which emits the repaired rows
one by one. So a conversation is bounded by its audit, one cell of the result,
not by its texts.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.common import arrow_schema

SPACE = " \t\n\x0b\f\r"
DELETE, RETAG, INSERT, TRUNCATED = 4, 3, 3, 3

#: Codes of a row: number of its role's initial, and what must happen to it.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, MUST_GO, CUT_OFF = 3, 4, 8

#: Pattern states: nothing yet, after s, after u, after a; NEXT by initial, and the turn due (user or assistant).
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = ({0: AFTER_S, 1: AFTER_U}, {1: AFTER_U}, {2: AFTER_A}, {1: AFTER_U})
DUE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLES = {AFTER_U: "user", AFTER_A: "assistant"}

LEGAL = {(0, 1), (1, 2), (2, 1)}

#: Rows, and characters of text, that a stream gives out at once.
RUN_ROWS = 4096
RUN_CHARS = 1 << 20

PLAN_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLAN_DDL = ", ".join(f"{c} long" for c in PLAN_COLUMNS) + ", audit string"


def _edges(codes: bytes, node: int) -> list[tuple[str, int, int]]:
    """(edit, next node, cost) of each edit at a node, which is 4 * rows consumed + state."""
    i, state = divmod(node, 4)
    out = [("I", 4 * i + DUE[state], INSERT)]
    if i < len(codes):
        code = codes[i]
        out.append(("D", node + 4, DELETE))
        if not code & MUST_GO:
            more = TRUNCATED if code & CUT_OFF else 0
            out.append(("R", 4 * (i + 1) + DUE[state], RETAG + more))
            kept = NEXT[state].get(code & 3)
            if kept is not None:
                out.append(("K", 4 * (i + 1) + kept, more))
    return out


def _back_edges(codes: bytes, node: int) -> list[tuple[str, int, int]]:
    """(edit, previous node, cost) of each edit that leads to a node."""
    i, state = divmod(node, 4)
    due = [s for s in range(4) if DUE[s] == state]
    out = [("I", 4 * i + s, INSERT) for s in due]
    if i:
        code, before = codes[i - 1], 4 * (i - 1)
        out.append(("D", node - 4, DELETE))
        if not code & MUST_GO:
            more = TRUNCATED if code & CUT_OFF else 0
            out += [("R", before + s, RETAG + more) for s in due]
            out += [("K", before + s, more) for s in range(4) if NEXT[s].get(code & 3) == state]
    return out


class Side:
    """One of the two searches: costs, the tree of best audits, and the heap."""

    def __init__(self, starts: list[int], sign: int):
        # of equal costs the node settled first has the fewer rows behind it on this side, so free edges never lead back
        self.sign = sign
        self.cost = {node: 0 for node in starts}
        self.link: dict[int, tuple[str, int] | None] = {node: None for node in starts}
        self.settled: dict[int, int] = {}  # node -> its turn
        self.heap = [(0, sign * node) for node in starts]
        heapq.heapify(self.heap)

    def top(self) -> float:
        while self.heap and self.sign * self.heap[0][1] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else float("inf")

    def settle(self) -> int:
        node = self.sign * heapq.heappop(self.heap)[1]
        self.settled[node] = len(self.settled)
        return node

    def reach(self, node: int, cost: int, link: tuple[str, int]) -> None:
        known = self.cost.get(node)
        if known is None or cost < known:
            self.cost[node], self.link[node] = cost, link
            heapq.heappush(self.heap, (cost, self.sign * node))
        elif cost == known and self.link[node] is not None and self.less(link, self.link[node]):
            self.link[node] = link

    def less(self, one: tuple[str, int], two: tuple[str, int]) -> bool:
        if self.sign < 0:  # suffixes of one node differ in their first letter
            return one[0] < two[0]
        (a, x), (b, y) = one, two  # prefixes differ where their paths part
        while x != y:
            if self.settled[x] > self.settled[y]:
                a, x = self.link[x]
            else:
                b, y = self.link[y]
        return a < b

    def audit(self, node: int) -> str:
        letters = []
        while (link := self.link[node]) is not None:
            letters.append(link[0])
            node = link[1]
        return "".join(letters if self.sign < 0 else reversed(letters))


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and ASCII-least audit of the cheapest edits of the rows with these codes."""
    ends = [4 * len(codes) + START, 4 * len(codes) + AFTER_A]
    ahead, back = Side([START], 1), Side(ends, -1)
    best: float = 0 if not codes else float("inf")
    while (one := ahead.top()) + (two := back.top()) <= best:
        if one < two or (one == two and len(ahead.settled) <= len(back.settled)):
            node = ahead.settle()
            for letter, to, cost in _edges(codes, node):
                ahead.reach(to, one + cost, (letter, node))
                if to in back.cost:
                    best = min(best, one + cost + back.cost[to])
        else:
            node = back.settle()
            for letter, to, cost in _back_edges(codes, node):
                back.reach(to, two + cost, (letter, node))
                if to in ahead.cost:
                    best = min(best, two + cost + ahead.cost[to])
    # a cheapest path leaves the nodes settled ahead by one edge, or ends among them
    crossings = [(node, "", node) for node in ends if node in ahead.settled and ahead.cost[node] == best]
    for node in ahead.settled:
        for letter, to, cost in _edges(codes, node):
            if to not in ahead.settled and to in back.settled and ahead.cost[node] + cost + back.cost[to] == best:
                crossings.append((node, letter, to))
    return int(best), min(ahead.audit(x) + letter + (back.audit(y) if letter else "") for x, letter, y in crossings)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of a sorted partition, one after the other."""
    for batch in batches:
        for start in range(0, batch.num_rows, RUN_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, RUN_ROWS).columns), strict=True)


def _packed(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    run: list[dict] = []
    size = 0
    for row in rows:
        run.append(row)
        size += len(row.get("text") or "")
        if len(run) >= RUN_ROWS or size >= RUN_CHARS:
            yield pa.RecordBatch.from_pylist(run, schema=schema)
            run, size = [], 0
    if run:
        yield pa.RecordBatch.from_pylist(run, schema=schema)


def faulty_rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text), a ``mark`` that orders texts, the role's initial, and what the text lacks."""
    base = rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    bare, first = F.btrim("text", F.lit(SPACE)), F.left("role", F.lit(1))
    initial = F.lit(OTHER)
    for letter, number in INITIALS.items():
        initial = F.when(first == letter, number).otherwise(initial)
    return base.select(
        "*",
        F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("mark"),
        initial.alias("initial"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
    )


def plans(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``faulty_rows``: counts of faults, cost and audit."""
    again = F.row_number().over(Window.partitionBy("conv", "role", "mark").orderBy("turn")) > 1
    slim = rows.drop("text").withColumn("again", again).repartition("conv")
    ranked = slim.sortWithinPartitions("conv", "turn", "role", "mark", "again")
    ddl = f"conv {rows.schema['conv'].dataType.simpleString()}, {PLAN_DDL}"
    schema = arrow_schema(ddl)

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, group in itertools.groupby(_streams(batches), key=itemgetter(0)):
            codes, turns, first, last, before = bytearray(), 0, None, None, None
            found = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            for _, turn, initial, blank, cut_off, repeated in group:
                if turn is not None and turn != last:
                    first, last, turns = turn if first is None else first, turn, turns + 1
                fault = "blank" if blank else "duplicate" if repeated else "truncated" if cut_off else None
                if fault:
                    found[fault] += 1
                if before is not None and (before, initial) not in LEGAL:
                    found["illegal"] += 1
                before = initial
                codes.append(initial | (CUT_OFF if fault == "truncated" else MUST_GO if fault else 0))
            cost, audit = cheapest_edits(bytes(codes))
            gaps = 0 if first is None else last - first + 1 - turns
            yield {"conv": conv, "gaps": gaps, **found, "cost": cost, "audit": audit}

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(planned(batches), schema)

    return ranked.select("conv", "turn", "initial", "blank", "cut_off", "again").mapInArrow(plan, ddl)


def _met(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Each conversation's plan, then its rows in order, sorted within partitions."""
    texts = rows.select("conv", "turn", "role", "mark", "text", F.lit(1).alias("kind"))
    both = planned.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    ordered = both.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "mark")
    return ordered.select("conv", F.struct(*PLAN_COLUMNS).alias("plan"), "audit", "role", "text")


def _walk(group: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that a conversation has after its audit."""
    _, _, audit, _, _ = next(group)
    state = START
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(group)[3:]
        if edit == "D":
            continue
        state = NEXT[state][INITIALS[role[0]]] if edit == "K" else DUE[state]
        yield edit, role if edit == "K" else ROLES[state], text


def repaired_turns(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The repaired rows: (conv_col, position, edit, role, text); the rules of ``repair_report``."""
    marked = faulty_rows(rows, conv_col, turn_col, role_col, text_col)
    ddl = f"conv {marked.schema['conv'].dataType.simpleString()}, position long, edit string, role string, text string"
    schema = arrow_schema(ddl)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, group in itertools.groupby(_streams(batches), key=itemgetter(0)):
            for at, (edit, role, text) in enumerate(_walk(group)):
                yield {"conv": conv, "position": at, "edit": edit, "role": role, "text": text}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(walked(batches), schema)

    return _met(marked, plans(marked)).mapInArrow(walk, ddl).withColumnRenamed("conv", conv_col)


def repair_report(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    ids: DataFrame | None = None,
) -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn (nulls first, then role, then the text's sha256). A row's
    first fault counts: blank (white space only), duplicate (role and text
    seen earlier in the conversation), truncated (last character that is not
    white space is none of ``.!?``). Blank and duplicate rows must be deleted.
    ``illegal`` counts neighbours whose initials are not su, ua or au; ``gaps``
    the turns missing between the least and the largest. ``audit`` has one
    letter an edit (Keep, Rerole, Delete, Insert), the ASCII-least of the
    cheapest; ``repaired_sha256`` is over ``role:text`` lines.

    Null roles and texts count as one space; a role without the initial s, u
    or a (an empty one too) cannot be kept; null conversation ids are one
    conversation. Repeated rows are duplicates of each other. An empty table
    gives an empty result; further columns are ignored. ``ids`` (a column
    ``conv_col``) adds conversations without rows: zeros, an empty audit and
    the hash of nothing.
    """
    marked = faulty_rows(rows, conv_col, turn_col, role_col, text_col)
    kind = marked.schema["conv"].dataType.simpleString()
    ddl = f"conv {kind}, {PLAN_DDL}, repaired_sha256 string"
    schema = arrow_schema(ddl)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, group in itertools.groupby(_streams(batches), key=itemgetter(0)):
            head = next(group)
            digest, between = hashlib.sha256(), b""
            for _, role, text in _walk(itertools.chain([head], group)):
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            yield {"conv": conv, **head[1], "audit": head[2], "repaired_sha256": digest.hexdigest()}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(walked(batches), schema)

    found = _met(marked, plans(marked)).mapInArrow(walk, ddl)
    if ids is not None:
        every = ids.select(F.col(conv_col).alias("every")).distinct()
        found = every.join(found, F.col("every").eqNullSafe(F.col("conv")), "left").withColumn("conv", F.col("every"))
    nothing = hashlib.sha256().hexdigest()
    return found.select(
        F.col("conv").alias(conv_col),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in PLAN_COLUMNS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
