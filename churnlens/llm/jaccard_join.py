"""Similarity self-join on word n-grams by T-occurrence search.

Documents with equal shingle sets form one class and are searched once. A set
of n shingles is linked at similarity s only to sets that share at least
T = ceil(s n) of its shingles, so in DivideSkip's terms its T - NEED most
frequent inverted lists are long ones: they are never merged, and a candidate
must be found on NEED of the other, rarer lists. Those short lists are
inverted once by shingle. For each query they are heap-merged with skips
(``divide_skip``); what a pair's sizes ask beyond NEED is asked of the count
(``Threshold.occurrences``). The long lists are then probed by binary search,
which for a pair is the same as probing the partner's sorted set, and pairs
that reach the required overlap are links.

A family of many near copies shares all its lists, so merging them whole
would emit every pair within it. The search therefore runs in rounds: first
each query merges its lists restricted to a few hubs per list, and the links
found join documents into components; rounds go on, with partners in other
components only, while they leave far fewer of them; the last round takes all.
Only links inside a component that exists already are left out, so components
are exact.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import SMALL_BATCH_BYTES, bound_batches, shared_table, shuffle_width
from churnlens.llm.components import components
from churnlens.llm.shingles import set_digest, shingle_sets
from churnlens.llm.words import calls, forget

#: Similarity as a fraction, and words of a shingle.
SIMILAR = (9, 10)
SHINGLE = 3
#: Characters shingled at once: numpy takes some 50 bytes for each.
SHINGLE_CHARS = 1 << 18
#: Short lists a candidate must be on.
NEED = 2
#: Lists longer than this are probed, not merged, where NEED allows.
LONG_LIST = 64
#: Counters of the frequency sketch (a fixed size at any scale), and its slices.
SKETCH_BITS = 22
SLICE = 1 << 14
#: A list that may be longer than this is never gathered by one task; its rows are salted.
HOT_LIST = 20_000
SALTS = 1024
#: Parity bits of a set.
PARITY = 256
#: Hubs per list and round, and partners per listed row up to which all are taken.
HUBS = 4
FEW = 64
#: A round of hubs is followed by another only if it left at most this share of the partners.
SHRINK = 0.7
#: Members of one block of a list.
BLOCK = 10_000


def merge_skip(lists: list[list[int]], need: int) -> list[tuple[int, int]]:
    """(id, count) of the ids on at least ``need`` of some sorted lists.

    A heap holds the lists' heads. When too few lists share the top, further
    heads are popped and all of them skip, by binary search, to the next head.
    """
    at = [0] * len(lists)
    heap = [(x[0], i) for i, x in enumerate(lists) if x]
    heapify(heap)
    out = []
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heappop(heap)[1])
        if len(popped) >= need:
            out.append((top, len(popped)))
            for i in popped:
                at[i] += 1
        else:
            while heap and len(popped) < need - 1:
                popped.append(heappop(heap)[1])
            if not heap:
                break
            for i in popped:
                at[i] = bisect_left(lists[i], heap[0][0], max(at[i], 0))
        for i in popped:
            if at[i] < len(lists[i]):
                heappush(heap, (lists[i][at[i]], i))
    return out


def divide_skip(lists: list[list[int]], need: int, long_list: int = LONG_LIST) -> list[tuple[int, int]]:
    """(id, count) of the ids on at least ``need`` of the sorted lists: up to
    need - 1 long lists are probed by binary search for what the merged short
    ones leave over."""
    by_size = sorted(lists, key=len)
    probed: list[list[int]] = []
    while by_size and len(probed) < need - 1 and len(by_size[-1]) > long_list:
        probed.append(by_size.pop())
    out = []
    for found, count in merge_skip(by_size, need - len(probed)):
        for one in probed:
            k = bisect_left(one, found)
            count += k < len(one) and one[k] == found
        if count >= need:
            out.append((found, count))
    return out


class Threshold:
    """Similarity num/den in integers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def required(self, n: int) -> int:
        """Least overlap of a set of ``n`` shingles with any set linked to it."""
        return -(-self.num * n // self.den)

    def occurrences(self, n: int, m: int) -> int:
        """Short lists that linked sets of ``n`` and ``m`` shingles share at least.

        They share o = ceil(s (n + m) / (1 + s)) shingles. Each set's short lists
        hold all but its required(...) - NEED most frequent shingles, so at
        least o - required + NEED of the shared ones; both hold the rarest of these.
        """
        shared = -(-self.num * (n + m) // (self.num + self.den))
        return NEED + shared - max(self.required(n), self.required(m))

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        if not len(small) or self.num * len(large) > self.den * len(small):
            return False
        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
        shared = int((large[at] == small).sum())
        return self.den * shared >= self.num * (len(a) + len(b) - shared)

    def possible(self, a: Column, b: Column) -> Column:
        """Whether two sets (fields n and bits) can be linked, by their sizes and
        parity bits: the bits that differ never outnumber the shingles that do."""
        n, m = a["n"], b["n"]
        whole = self.num + self.den
        shared = F.floor((self.num * (n + m) + whole - 1) / whole)
        differ = sum(F.bit_count(a["bits"][k].bitwiseXOR(b["bits"][k])) for k in range(PARITY // 64))
        return (F.least(n, m) * self.den >= F.greatest(n, m) * self.num) & (differ <= n + m - 2 * shared)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def parity(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of a set's shingles fall in each of PARITY cells, packed."""
    odd = np.bincount((shingles & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def describe_sets(texts: DataFrame, size: int) -> DataFrame:
    """One pass over the texts: a row (doc_id, n, digest, bits) per document, and per
    task the slices (slice, counts) of its sketch of shingle frequencies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int32)
        for batch in batches:
            sets = [s for call in calls(batch["text"].tolist(), SHINGLE_CHARS) for s in shingle_sets(call, size)]
            for at in range(0, len(sets), 256):
                some = np.concatenate([np.zeros(0, np.uint64), *sets[at : at + 256]])
                np.add.at(sketch, (some >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n": [len(s) for s in sets],
                    "digest": [set_digest(s) for s in sets],
                    "bits": [parity(s) for s in sets],
                    "slice": pd.array([None] * len(sets), dtype="Int32"),
                    "counts": None,
                }
            )
        parts = np.minimum(sketch, 65535).astype("<u2").reshape(-1, SLICE)
        used = np.flatnonzero(parts.any(axis=1))
        yield pd.DataFrame(
            {
                "doc_id": pd.array([None] * len(used), dtype="Int64"),
                "n": pd.array([None] * len(used), dtype="Int64"),
                "digest": None,
                "bits": None,
                "slice": used.astype(np.int32),
                "counts": [parts[i].tobytes() for i in used],
            }
        )

    return texts.mapInPandas(run, "doc_id long, n long, digest binary, bits array<long>, slice int, counts binary")


def sum_sketch(slices: DataFrame) -> np.ndarray:
    """The summed sketch: a fixed number of counters, whatever the input."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch["slice"], batch["counts"], strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, dtype="<u2").astype(np.int64)
        yield pd.DataFrame({"slice": list(sums), "counts": [x.tobytes() for x in sums.values()]})

    total = np.zeros(1 << SKETCH_BITS, dtype=np.int64).reshape(-1, SLICE)
    dealt = slices.repartition(shuffle_width(slices.sparkSession), "slice")
    for row in dealt.mapInPandas(run, "slice int, counts binary").collect():
        total[row["slice"]] += np.frombuffer(row["counts"], dtype=np.int64)
    return total.ravel()


def short_lists(texts: DataFrame, sketch: np.ndarray, limit: Threshold, size: int) -> DataFrame:
    """(doc_id, n, digest, tokens): the shingles of each set but its T - NEED most frequent.

    Frequency is the sketch's count, ties by hash: one order for all sets,
    which is all that exactness needs. Sets too small to be linked to any
    other set have no row. ``tokens`` holds (token, hot).
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(sketch.astype(np.int32))  # 16 MB, a fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        counts = shared.value
        for batch in batches:
            sets = [s for call in calls(batch["text"].tolist(), SHINGLE_CHARS) for s in shingle_sets(call, size)]
            rows = []
            for doc_id, s in zip(batch["doc_id"].astype("Int64"), sets, strict=True):
                need = limit.required(len(s))
                if doc_id is pd.NA or limit.num * (len(s) + 1) > limit.den * len(s):
                    continue  # even one shingle more would be too different
                seen = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.lexsort((s, seen))[: len(s) - need + min(NEED, need)]
                tokens = s[order].view(np.int64)
                hot = (seen[order] > HOT_LIST).astype(np.int8)
                rows.append((int(doc_id), len(s), set_digest(s), tokens, hot))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "digest", "tokens", "hot"])

    return texts.mapInPandas(run, "doc_id long, n long, digest binary, tokens array<long>, hot array<tinyint>")


def inverted(rows: DataFrame) -> DataFrame:
    """(token, node, n) of the tokens that more than one set has in its short lists."""
    posted = rows.select(F.col("doc_id").alias("node"), "n", F.explode(F.arrays_zip("tokens", "hot")).alias("t")).select(
        "node", "n", F.col("t.tokens").alias("token"), (F.col("t.hot") == 1).alias("hot")
    )
    # the sketch never counts too low: a list that is not hot has at most HOT_LIST rows
    salted = posted.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0))
    many = F.count(F.lit(1)).over(Window.partitionBy("token", "salt"))
    return salted.withColumn("m", many).filter("m > 1 or hot").select("token", "node", "n")


def occurrence_search(partners: DataFrame, limit: Threshold) -> DataFrame:
    """Candidates (a, b) from rows (node, n, lists): DivideSkip on each row's lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            a, b = [], []
            for node, n, lists in zip(batch["node"], batch["n"], batch["lists"], strict=True):
                size: dict[int, int] = {}
                for one in lists:
                    size.update(zip(one["ids"].tolist(), one["sizes"].tolist(), strict=True))
                found = divide_skip([one["ids"].tolist() for one in lists], NEED)
                found = [i for i, count in found if count >= limit.occurrences(n, size[i])]
                a += [node] * len(found)
                b += found
            yield pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    found = partners.select("node", "n", "lists").mapInPandas(run, "a long, b long")
    return _once(found)


def _once(pairs: DataFrame) -> DataFrame:
    """Each unordered pair once, in one of the orientations it came in."""
    ends = pairs.select("a", "b", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    return ends.groupBy("lo", "hi").agg(F.min_by("a", "a").alias("a"), F.min_by("b", "a").alias("b")).select("a", "b")


def _list(members: Column) -> Column:
    """A list of (node, n, comp) sorted by node as ids and their sizes."""
    return F.struct(
        F.transform(members, lambda x: x["node"]).alias("ids"), F.transform(members, lambda x: x["n"]).alias("sizes")
    )


def hub_partners(lists: DataFrame, limit: Threshold, seed: int) -> DataFrame:
    """(node, n, lists) with each list restricted to HUBS members of other components."""
    hubs = lists.groupBy("token").agg(
        F.array_distinct(
            F.array(
                *[
                    F.min_by(F.struct("node", "n", "comp", "bits"), F.xxhash64("node", F.lit(seed * HUBS + k)))
                    for k in range(HUBS)
                ]
            )
        ).alias("hubs")
    )
    own = F.struct("n", "bits")
    kept = F.sort_array(F.filter("hubs", lambda h: (h["comp"] != F.col("comp")) & limit.possible(h, own)))
    joined = lists.join(hubs, "token").select("node", "n", kept.alias("kept")).filter(F.size("kept") > 0)
    return joined.groupBy("node", "n").agg(F.collect_list(_list(F.col("kept"))).alias("lists"))


def all_partners(lists: DataFrame, limit: Threshold, longest: int) -> DataFrame:
    """(node, n, block, lists) with all members of larger components.

    ``weight`` orders components, so each pair is searched from one side, with
    all the lists it shares: from the smaller component, whose members are few
    where a family has mostly been joined. Lists are cut into blocks by member, at
    most about BLOCK long, so no row grows with a frequent shingle; all
    occurrences of a member fall in one block, so blocks are searched apart.
    """
    rank = F.struct("weight", "comp")
    top = lists.groupBy("token").agg(F.max(rank).alias("top"))
    queries = lists.join(top, "token").filter(rank < F.col("top")).select("token", "node", "n", "comp", "weight", "bits")
    block = F.pmod(F.xxhash64("node"), F.lit(1 + longest // BLOCK)).alias("block")
    member = F.struct("node", "n", "comp", "weight", "bits")
    own = F.struct("n", "bits")
    whole = lists.groupBy("token", block).agg(F.sort_array(F.collect_list(member)).alias("all"))

    def wanted(x: Column) -> Column:
        larger = (x["weight"] > F.col("weight")) | ((x["weight"] == F.col("weight")) & (x["comp"] > F.col("comp")))
        return larger & limit.possible(x, own)

    merged = queries.join(whole, "token").select("node", "n", "block", F.filter("all", wanted).alias("kept"))
    return (
        merged.filter(F.size("kept") > 0)
        .groupBy("node", "n", "block")
        .agg(F.collect_list(_list(F.col("kept"))).alias("lists"))
    )


def verified(pairs: DataFrame, texts: DataFrame, limit: Threshold, size: int) -> DataFrame:
    """The pairs that reach the required overlap, by probing the sorted sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                known: dict[int, np.ndarray] = {}
                for node, text in (("a", "ta"), ("b", "tb")):
                    new = {k: t for k, t in zip(part[node], part[text], strict=True) if k not in known}
                    sets = [s for call in calls(list(new.values()), SHINGLE_CHARS) for s in shingle_sets(call, size)]
                    known |= dict(zip(new, sets, strict=True))
                good = [limit.links(known[a], known[b]) for a, b in zip(part["a"], part["b"], strict=True)]
                yield part.loc[good, ["a", "b"]]

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long")


def named_lists(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """``lists`` with the component of each row's node: a node is joined once, not once for each list it is on."""
    nodes = lists.groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.collect_list("token").alias("tokens"))
    named = nodes.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    return named.select(F.explode("tokens").alias("token"), "node", "n", "bits", "comp")


def link_components(
    lists: DataFrame, texts: DataFrame, bits: DataFrame, limit: Threshold, size: int, words: int
) -> DataFrame:
    """(node, component) of the linked nodes, by rounds of T-occurrence search.

    ``bits`` has (node, bits) of each; ``texts`` have at most ``words`` words.
    """
    rows, seed = lists.count(), 0
    found, comps, before = None, None, None
    open_ = lists  # components only grow: a list that is within one is never looked at again
    while True:
        if comps is None:
            known = open_.withColumn("comp", F.col("node"))
        else:
            known = shared_table(named_lists(open_, comps), "named-lists", rows)
        shares = known.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
        per_list = shares.groupBy("token").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("s"))
        mixed = per_list.filter("m * m > s")
        weights = known.groupBy("comp").agg(F.count(F.lit(1)).alias("weight"))
        known = known.join(mixed.select("token"), "token", "left_semi").join(weights, "comp")
        known = shared_table(known if comps is not None else known.join(bits, "node"), "mixed-lists", rows)
        open_ = known.drop("comp", "weight")
        todo = mixed.agg(F.sum((F.col("m") * F.col("m") - F.col("s")).cast("double") / 2), F.max("m")).first()
        if not todo[1]:
            break
        last = todo[0] <= FEW * rows or (before is not None and todo[0] > SHRINK * before)
        before = todo[0]
        lists_of = all_partners(known, limit, todo[1]) if last else hub_partners(known, limit, seed)
        new = shared_table(verified(occurrence_search(lists_of, limit), texts, limit, size), "links", words=words)
        grown = not new.isEmpty()
        if grown:
            found = new if found is None else found.unionByName(new)
            comps = components(found)
        if last:
            break
        if not grown:
            # hubs find nothing more: take all partners, however many
            lists_of = all_partners(known, limit, todo[1])
            new = shared_table(verified(occurrence_search(lists_of, limit), texts, limit, size), "links", words=words)
            if not new.isEmpty():
                found = new if found is None else found.unionByName(new)
                comps = components(found)
            break
        seed += 1
    return comps


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similar: tuple[int, int] = SIMILAR,
    size: int = SHINGLE,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id, component_id.

    Words are runs of characters other than white space, A-Z lowered. Texts
    null or without words have no shingles, are linked with nothing, and are
    components of their own. Equal sets form a class (named by its smallest
    id); a component is named by its smallest id. Rows that repeat an id
    belong to one document, which is linked by each of their texts; ids of any
    type that can be ordered will do; rows
    without an id get the component of their class, null if no row of it has
    one. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession, SMALL_BATCH_BYTES)
    limit = Threshold(*similar)
    texts = _texts(docs, id_col, text_col)
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return _numbered_components(texts, limit, size)
    texts = texts.withColumn("doc_id", F.col("doc_id").cast("long"))
    described = shared_table(describe_sets(texts, size), "shingle-sets")
    sets = described.filter("slice is null and doc_id is not null")
    if sets.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi").isEmpty():
        return _set_components(texts, described, limit, size)
    return _numbered_components(texts, limit, size)


def _numbered_components(texts: DataFrame, limit: Threshold, size: int) -> DataFrame:
    """The same for ids that are no numbers, or that rows with other texts repeat: by the row's number."""
    number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
    numbered = shared_table(texts.withColumn("row", number), "numbered-texts")
    alone = numbered.select(F.col("row").alias("doc_id"), "text")
    described = shared_table(describe_sets(alone, size), "shingle-sets")
    found = _set_components(alone, described, limit, size)
    return _document_components(found, numbered.select("row", "doc_id"))


def _document_components(found: DataFrame, numbers: DataFrame) -> DataFrame:
    """Components of numbered rows (row, doc_id) as those of their documents, whose rows join them."""
    doc = numbers.select(F.col("row").alias("doc_id"), F.col("doc_id").alias("doc"))
    rows = shared_table(found.join(doc.filter("doc_id is not null"), "doc_id", "left").drop("doc_id"), "numbered-components")
    known = rows.filter("doc is not null")
    first = known.groupBy("doc").agg(F.min("component_id").alias("b"))
    same = known.join(first, "doc").filter("component_id <> b").select(F.col("component_id").alias("a"), "b").distinct()
    whole = components(shared_table(same, "links")).select(F.col("node").alias("component_id"), "component")
    rows = rows.join(whole, "component_id", "left").withColumn("whole", F.coalesce("component", "component_id"))
    known = rows.filter("doc is not null")
    names = known.groupBy("whole").agg(F.min("doc").alias("name"))
    classes = known.filter("n_shingles > 0").groupBy("class_id").agg(F.min("doc").alias("class"))
    return (
        rows.join(names, "whole", "left")
        .join(classes, "class_id", "left")
        .select(
            F.col("doc").alias("doc_id"),
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("class")).otherwise(F.col("doc")).alias("class_id"),
            F.col("name").alias("component_id"),
        )
    )


def _set_components(texts: DataFrame, described: DataFrame, limit: Threshold, size: int) -> DataFrame:
    """The same where rows that repeat an id have equal sets, so that an id names one set."""
    sets = described.filter("slice is null").select("doc_id", "n", "digest", "bits")
    sketch = sum_sketch(described.filter("slice is not null").select("slice", "counts"))
    # equal digests have equal bits
    classes = sets.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("bits").alias("bits"))
    one_each = classes.select("digest", F.col("node").alias("doc_id"))
    rows = short_lists(texts, sketch, limit, size).join(one_each, ["doc_id", "digest"], "left_semi")
    # an upper bound of what the short lists hold, and the shingles of all sets
    short = F.col("n") - F.floor(F.col("n") * limit.num / limit.den) + NEED
    total = sets.agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("words"), F.sum(short).cast("long").alias("short")).first()
    words = total["words"] or 0
    lists = shared_table(inverted(rows), "short-lists", rows=total["short"] or 0)
    listed = lists.select(F.col("node").alias("doc_id")).distinct()
    wanted = shared_table(
        texts.join(listed, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text"), "listed-texts", words=words
    )
    bits = shared_table(classes.select("node", "bits"), "class-bits", rows=total["sets"])
    comps = link_components(lists, wanted, bits, limit, size, words)
    named = sets.drop("bits").join(classes.drop("bits"), "digest", "left")
    if comps is None:
        named = named.withColumn("component", F.lit(None).cast("long"))
    else:
        named = named.join(comps, "node", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    return named.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("doc_id")).alias("class_id"),
        own.alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` without the documents that are not the smallest id of their component."""
    found = similar_components(docs, id_col, text_col, **rule)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
