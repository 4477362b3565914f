"""Token ids in binary files: canonical length-limited Huffman code.

One code for the whole corpus is built from the global counts of the ids by
package-merge. A file is a run of independent blocks in ascending id order;
each block row holds its documents' ids and token counts, the packed codes
(first bit first) and, every STRIDE tokens, a checkpoint with the bit offset.
Decoding starts at all checkpoints of a block at once: every step looks one
code up per segment in a table over the next ``limit`` bits.
"""

from __future__ import annotations

import os
import sys
import uuid
from array import array
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import arrow_schema, bound_batches, shared_root, shared_table, utf8_crc32
from churnlens.llm.words import WordCoder, by_distinct, joined, per_process

#: Longest code, in bits (more if the alphabet needs it); block and checkpoint distances in tokens.
LIMIT = 16
BLOCK_TOKENS = 1 << 16
STRIDE = 128
#: Ids that are counted at once.
COUNTED_TOKENS = 1 << 20

#: Bytes of text whose distinct words are looked for at once: the more, the fewer there are a byte.
CALL_BYTES = 8 << 20

#: A word that stands between words of one call, and how many there are in it.
BETWEEN = "\x01"
RUN_WORDS = 128

#: Latin letters that stay one letter when lowered and under NFC (so not U+0130).
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
ONE_RUN = f"^[{LETTERS}]+$"
#: Ends the last token of a word, and of no other, in word BPE files.
WORD_END = "</w>"

TOKEN_SCHEMA = "id long, crc long, n long, ids binary"
BLOCK_SCHEMA = (
    "file_no int, block_no int, first_token long, n_tokens long, doc_ids array<long>, "
    "doc_tokens array<long>, checkpoints binary, payload binary"
)


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    levels, packages = [], weights[:0]
    for _ in range(limit):
        both = np.concatenate([weights, packages])
        by_weight = np.argsort(both, kind="stable")
        levels.append(by_weight < n)
        paired = both[by_weight][: len(both) // 2 * 2]
        packages = paired[0::2] + paired[1::2]
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_symbol in reversed(levels):
        own = int(is_symbol[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


#: For arithmetic on unsigned words of 64 bits.
_NONE, _ONE, _WORD, _WORD_BITS, _IN_WORD = (np.uint64(x) for x in (0, 1, 64, 6, 63))


class Code:
    """Canonical code over ``symbols`` (ascending) with given lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.symbols, self.lengths = symbols, lengths
        self.limit = int(lengths.max(initial=1))
        order = np.lexsort((symbols, lengths))
        step = np.int64(1) << (self.limit - lengths[order])
        left = np.cumsum(step) - step  # codes, left-aligned to ``limit`` bits
        self.codes = np.empty(len(symbols), dtype=np.int64)
        self.codes[order] = left >> (self.limit - lengths[order])
        self._order, self._step = order, step
        size = int(symbols.max(initial=-1)) + 1
        self._code_of, self._length_of = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint64)
        self._code_of[symbols], self._length_of[symbols] = self.codes, lengths

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray, limit: int = LIMIT) -> Code:
        need = max(limit, int(len(symbols) - 1).bit_length()) if len(symbols) else limit
        return cls(symbols, code_lengths(counts, need))

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every value of the next ``limit`` bits."""
        size = 1 << self.limit
        symbol, length = np.zeros(size, dtype=np.int64), np.ones(size, dtype=np.int64)
        filled = int(self._step.sum())
        symbol[:filled] = np.repeat(self.symbols[self._order], self._step)
        length[:filled] = np.repeat(self.lengths[self._order], self._step)
        return symbol, length

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
        """Packed bits and the bit offset of every ``stride``-th id."""
        if not len(ids):
            return b"", np.zeros(0, dtype="<u4")
        code, length = self._code_of[ids], self._length_of[ids]
        end = np.cumsum(length)
        marks, bits, run = (end - length)[::stride], int(end[-1]), 1
        while 2 * run * self.limit <= 64:  # neighbours become one code, while it fits a word
            if len(code) % 2:
                code, length = np.append(code, _NONE), np.append(length, _NONE)
            code = (code[0::2] << length[1::2]) | code[1::2]
            length = length[0::2] + length[1::2]
            run *= 2
        end = np.cumsum(length)
        start = end - length
        word, room = start >> _WORD_BITS, _WORD - (start & _IN_WORD)  # bits left in the word where a code starts
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        last = np.append(first[1:], len(word)) - 1
        # only the last code that starts in a word can reach into the next
        fits = length <= room
        over = np.where(fits, _NONE, length - room)
        own = np.where(fits, code << (np.maximum(room, length) - length), code >> over)
        out = np.zeros(bits // 64 + 2, dtype=np.uint64)
        out[word[first]] = np.bitwise_or.reduceat(own, first)
        last = last[over[last] > 0]
        out[word[last] + _ONE] |= code[last] << (_WORD - over[last])
        return out.astype(">u8").tobytes()[: (bits + 7) // 8], marks.astype("<u4")


class Decoder:
    def __init__(self, code: Code):
        symbol, self.length = code.tables()
        self.symbol = symbol.astype(np.uint32)
        self.limit = code.limit

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int, stride: int = STRIDE) -> np.ndarray:
        """The ``n`` ids of a block; its segments advance together."""
        data = np.frombuffer(payload + bytes(8), dtype=np.uint8).astype(np.int64)
        window = (data[:-4] << 32) | (data[1:-3] << 24) | (data[2:-2] << 16) | (data[3:-1] << 8) | data[4:]
        at = checkpoints.astype(np.int64)
        last, mask = 8 * (len(window) - 1), (1 << self.limit) - 1
        out = np.empty((stride, len(at)), dtype=np.uint32)
        for j in range(min(stride, n)):
            bits = (window[at >> 3] >> (40 - self.limit - (at & 7))) & mask
            out[j] = self.symbol[bits]
            at = np.minimum(at + self.length[bits], last)
        return out.T.ravel()[:n]


def calls_of(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``size`` bytes of ``column``, which has no nulls; a longer text is a batch of its own."""
    held, full = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch[column]).to_numpy().astype(np.int64))
        at, done = 0, 0
        while at < len(ends):
            stop = min(int(np.searchsorted(ends, done + size - full)) + 1, len(ends))
            held.append(batch.slice(at, stop - at))
            full += int(ends[stop - 1]) - done
            at, done = stop, int(ends[stop - 1])
            if full >= size:
                yield pa.concat_batches(held)
                held, full = [], 0
    if held:
        yield pa.concat_batches(held)


def ids_of(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all values of a binary column without nulls, and how many each has."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int64)
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[int(ends[0]) : int(ends[-1])]
    return data.view(kind), np.diff(ends) // np.dtype(kind).itemsize


def parts_of(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words cut before ASCII signs and digits that follow a letter, in lower case where
    that is plain, and how many parts each has. The tokenizer never joins a letter and a
    sign after it, and what it joins after the cut does not depend on what stands before."""
    parts = pc.replace_substring_regex(words, f"([{LETTERS}])([!-@\\[-`{{-~])", r"\1 \2")
    plain = pc.invert(pc.match_substring_regex(words, f"[^!-~{LETTERS}]"))
    parts = pc.if_else(plain, pc.utf8_lower(parts), parts)
    # special tokens are taken as they stand
    lists = pc.split_pattern(pc.if_else(pc.match_substring(words, "<|"), words, parts), " ")
    return lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)


def id_type(tokenizer: str) -> str:
    """The least unsigned type that holds all ids of a tokenizer file."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"


def tokenise(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, crc, n, ids as little-endian binary of ``id_type``): whole texts, then the end id.

    ``tokenizer`` is the path of a word BPE file of the tokenizers library
    (white space separates, and is dropped).
    """

    bound_batches(docs.sparkSession)
    kind = id_type(tokenizer)
    size = np.dtype(kind).itemsize

    schema = arrow_schema(TOKEN_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"

        def pack(ids: list[int]) -> bytes:
            own = array("H" if kind == "<u2" else "I", ids)
            if sys.byteorder == "big":
                own.byteswap()
            return own.tobytes()

        def make() -> Callable[[pa.Array, bytes], pa.Array]:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(tokenizer)
            mark = tok.encode(BETWEEN, add_special_tokens=False).ids
            vocab = tok.get_vocab()
            ending = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)
            ending[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True

            def batch(texts: list[str]) -> list[bytes]:
                return [pack(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

            def shares(words: list[str], between: str, after: str, ends: np.ndarray, skip: int) -> list[bytes]:
                """The ids of each word, encoded in runs, fewer calls; one of the ids ``ends`` closes
                each word, of which the last ``skip`` are not its own. Empty if their number is another."""
                runs = range(0, len(words), RUN_WORDS)
                data = b"".join(batch([between.join(words[at : at + RUN_WORDS]) + after for at in runs]))
                stop = (np.flatnonzero(ends[np.frombuffer(data, dtype=kind)]) + 1) * size
                if len(stop) != len(words):
                    return []
                start = np.concatenate([[0], stop])[:-1]
                return [data[a:b] for a, b in zip(start.tolist(), (stop - skip * size).tolist(), strict=True)]

            def encode(words: list[str]) -> list[bytes]:
                """What ends a word tells those of letters apart, others have a word between them
                that only itself encodes to."""
                letters = pc.match_substring_regex(pa.array(words, pa.large_string()), ONE_RUN).to_numpy(zero_copy_only=False)
                own = list(compress(words, letters))
                found = dict(zip(own, shares(own, " ", "", ending, 0), strict=False))
                rest = [w for w in words if w not in found]
                alone = [w for w in rest if len(mark) != 1 or BETWEEN in w or "<|" in w]
                found |= zip(alone, batch(alone), strict=True)
                rest = [w for w in rest if w not in found]
                if rest:
                    found |= zip(rest, shares(rest, f" {BETWEEN} ", f" {BETWEEN} ", np.arange(len(ending)) == mark[0], 1), strict=True)
                return list(map(found.__getitem__, words))

            # this kind of tokenizer drops white space and joins nothing across it, so the
            # ids of a text are those of its words, and theirs those of their parts
            known = WordCoder(str.split, encode)

            def of_words(words: pa.Array) -> pa.Array:
                parts, counts = parts_of(words)
                return joined(by_distinct(parts, known.packed), counts)

            def of_texts(texts: pa.Array, end: bytes) -> pa.Array:
                lists = pc.ascii_split_whitespace(texts)
                counts = pc.list_value_length(lists).to_numpy().astype(np.int64)
                words = lists.flatten().dictionary_encode()
                packed = pa.concat_arrays([of_words(words.dictionary), pa.array([end], pa.large_binary())])
                at = np.insert(words.indices.to_numpy(), np.cumsum(counts), len(packed) - 1)
                return joined(packed.take(pa.array(at)), counts + 1)

            return of_texts

        coder = per_process(f"tokens:{tokenizer}", make)
        end = pack([end_id])
        for call in calls_of(batches, "t", CALL_BYTES):
            ids = coder(call["t"].cast(pa.large_string()), end)
            n = np.diff(np.frombuffer(ids.buffers()[1], dtype=np.int64)) // size
            yield pa.RecordBatch.from_arrays([call["id"], call["crc"], pa.array(n), ids.cast(pa.binary())], schema=schema)

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"), utf8_crc32(text).alias("crc"))
    return rows.mapInArrow(run, TOKEN_SCHEMA)


def id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    """(symbol, n) over all documents; one partial count per id and task."""

    schema = arrow_schema("symbol long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            ids = ids_of(batch["ids"], kind)[0]
            for at in range(0, len(ids), COUNTED_TOKENS):
                seen = np.bincount(ids[at : at + COUNTED_TOKENS], minlength=len(total))
                seen[: len(total)] += total
                total = seen
        symbol = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(symbol), pa.array(total[symbol])], schema=schema)

    return tokens.select("ids").mapInArrow(run, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def _blocks(code: Code, kind: str):
    schema = arrow_schema(BLOCK_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_no = TaskContext.get().partitionId()
        block_no, first, held, size = 0, 0, [], 0

        def block() -> pa.RecordBatch:
            nonlocal block_no, first, held, size
            payload, marks = code.encode(np.concatenate([ids for _, _, ids in held]))
            docs, sizes = pa.concat_arrays([x[0] for x in held]), np.concatenate([x[1] for x in held])
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (docs, pa.array(sizes))]
            numbers, bits = [file_no, block_no, first, size], [marks.tobytes(), payload]
            row = [*[pa.array([x]) for x in numbers], *lists, *[pa.array([x], pa.binary()) for x in bits]]
            block_no, first, held, size = block_no + 1, first + size, [], 0
            return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            ids, sizes = ids_of(batch["ids"], kind)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            while at < len(sizes):
                # up to the document that fills the block
                stop = min(int(np.searchsorted(ends, ends[at] + BLOCK_TOKENS - size)), len(sizes))
                # what is held must not keep the whole batch
                held.append((batch["id"].slice(at, stop - at), sizes[at:stop], ids[ends[at] : ends[stop]].copy()))
                size += int(ends[stop] - ends[at])
                at = stop
                if size >= BLOCK_TOKENS:
                    yield block()
        if held:
            yield block()

    return run


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode ``docs`` and write ``path/code`` and ``path/blocks``.

    Null text is empty (the end id alone); null ids come first; rows that
    repeat an id follow each other by crc of the text; an empty table writes no blocks.
    """
    spark = docs.sparkSession
    kind = id_type(tokenizer)
    tokens = shared_table(tokenise(docs, tokenizer, end_id, id_col, text_col), "token-ids")
    counted = id_counts(tokens, kind).orderBy("symbol").collect()  # at most one row per id of the vocabulary
    code = Code.of_counts(*(np.array([r[i] for r in counted], dtype=np.int64) for i in (0, 1)))
    spark.createDataFrame(
        [(int(s), int(n)) for s, n in zip(code.symbols, code.lengths, strict=True)], "symbol long, length int"
    ).coalesce(1).write.parquet(f"{path}/code")
    ordered = tokens.repartitionByRange("id", "crc", "n").sortWithinPartitions("id", "crc", "n")
    ordered.select("id", "ids").mapInArrow(_blocks(code, kind), BLOCK_SCHEMA).write.parquet(f"{path}/blocks")


def read_code(spark: SparkSession, path: str) -> Code:
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{path}/code").collect())
    return Code(*(np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1)))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, ids as little-endian 32-bit binary): ``start`` counts the tokens of all rows before."""
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = sorted(tuple(r) for r in blocks.groupBy("file_no").agg(F.sum("n_tokens")).collect())  # a row per file
    ends = np.cumsum([0, *[s[1] for s in sizes]]).tolist()
    base = {s[0]: e for s, e in zip(sizes, ends, strict=False)}
    code = read_code(spark, path)

    schema = arrow_schema("id long, start long, ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(code)
        for batch in batches:
            for i in range(batch.num_rows):
                b = {c: batch[c][i] for c in batch.schema.names}
                n, payload = b["n_tokens"].as_py(), b["payload"].as_py()
                ids = decoder.decode(payload, np.frombuffer(b["checkpoints"].as_py(), dtype="<u4"), n).astype("<u4")
                docs, sizes = b["doc_ids"].values, b["doc_tokens"].values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(sizes)])
                starts = base[b["file_no"].as_py()] + b["first_token"].as_py() + ends[:-1]
                bounds = pa.py_buffer((4 * ends).astype(np.int32))
                found = pa.Array.from_buffers(pa.binary(), len(docs), [None, bounds, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([docs, pa.array(starts), found], schema=schema)

    return blocks.mapInArrow(run, "id long, start long, ids binary")


def token_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what ``read_token_files`` returns."""
    return tokens.select(
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def new_path(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/token-files-{uuid.uuid4().hex}"
