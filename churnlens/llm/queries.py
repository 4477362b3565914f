"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import (
    chat,
    content_sort,
    conversation_repair,
    cover_tree,
    html_layout,
    huffman,
    jaccard_join,
    line_dedup,
    merkle,
    mixing,
    pieces,
    sharding,
    toxicity,
)
from churnlens.llm.common import read_table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made record, formatted and read back."""
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.array(
            *[F.struct(F.lit(r).alias("role"), said.alias("content")) for r in ("user", "assistant")]
        ).alias("messages"),
    )
    turns = chat.union_turns(read_table(spark, sf_dir, "conversations"), extra)
    back = chat.read_back(chat.format_conversations(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "fingerprint",
    )


_OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), safe AS (
  SELECT *, length(regexp_replace(replace(role, '\', '\\'), '([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2', 'g'))
    + length(regexp_replace(replace(text, '\', '\\'), '([<\[])(\|im_start\|>|\|im_sep\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2', 'g')) + 32 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  CASE WHEN conv_id = -1 THEN sha256('messages[].content' || chr(10) || 'messages[].role')
    ELSE sha256('role' || chr(10) || 'text' || chr(10) || 'turn') END AS fingerprint
FROM safe GROUP BY conv_id
"""


def op2_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes."""
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written in the block format and read back."""
    import public_tokenizers

    path = huffman.new_path(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    huffman.write_token_files(read_table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    return huffman.token_digests(huffman.read_token_files(spark, path))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of every document."""
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.fit(docs, read_table(spark, sf_dir, "labels")).score(docs)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return html_layout.extract_text(read_table(spark, sf_dir, "pages"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    taken = mixing.mix_sources(read_table(spark, sf_dir, "documents")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 90 % of their 3-word shingles."""
    found = jaccard_join.similar_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


_OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), lists AS (
  SELECT doc_id, CASE WHEN len(ws) >= 3
    THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS l FROM w
), s AS (SELECT doc_id, len(l) AS n, unnest(l) AS g FROM lists),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (max(a.n) + max(b.n) - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT l.doc_id, len(l.l) AS n_shingles, min(r.y) AS component_id
FROM lists l JOIN reach r ON r.x = l.doc_id GROUP BY l.doc_id, len(l.l)
"""


def op8_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the digest of the text they decode to."""
    return pieces.encoded_digests(read_table(spark, sf_dir, "documents"), pieces.default_model())


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts; the row with the largest doc_id stays."""
    return content_sort.exact_duplicates(read_table(spark, sf_dir, "documents"), keep="max")


_OP9_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

def op10_dual_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every 50th vector among all others."""
    vectors = cover_tree.quantised(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return cover_tree.top_k(vectors.filter("id % 50 = 0"), vectors, 5)


_OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the long lines that at least five documents hold."""
    kept = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")
    )


_OP11_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d)
), k AS (
  SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE last <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE last IS NULL OR last = doc_id), '')) AS kept_sha256
FROM l LEFT JOIN k USING (key) GROUP BY doc_id
"""


def damaged_turns(rows: DataFrame) -> DataFrame:
    """Conversations with faults that the crc32 of ``conv_id:turn`` decides; nulls are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    marked = rows.select(
        "conv_id",
        "turn",
        said("role").alias("role"),
        said("text").alias("text"),
        (F.crc32(F.encode(F.concat(said("conv_id"), F.lit(":"), said("turn")), "UTF-8")) % 20).alias("fate"),
    )
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))
    return marked.filter("fate <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    rows = read_table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(damaged_turns(rows), ids=rows)


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    eight = f"list_reduce(range(0, 8), lambda c, b: {step}, xor(acc, CAST(ascii({text}[CAST(j AS BIGINT)]) AS BIGINT)))"
    return f"xor(list_reduce(range(1, length({text}) + 1), lambda acc, j: {eight}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _repair_sql() -> str:
    """Row by row, the least (cost, audit, repaired text) of each state of the pattern."""
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def step(state: str, edit: str, cost: str, line: str | None, when: str = "true") -> str:
        text = f"{state}.t" if line is None else f"{state}.t || CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {line}"
        return f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', 't': {text}}} END"

    def least(*options: str) -> str:
        return f"list_min([x FOR x IN [{', '.join(options)}] IF x IS NOT NULL])"

    open_, more = "NOT must_go", "CASE WHEN cut_off THEN 3 ELSE 0 END"
    own = "role || ':' || text"
    keep = lambda s, i: step(s, "K", more, own, f"{open_} AND initial = '{i}'")
    anew = lambda s, r: step(s, "R", f"3 + {more}", f"'{r}:' || text", open_)
    rows = {
        "s0": [step("s0", "D", "4", None)],
        "s1": [step("s1", "D", "4", None), keep("s0", "s")],
        "s2": [step("s2", "D", "4", None), *[f(s, x) for s in ("s0", "s1", "s3") for f, x in ((keep, "u"), (anew, "user"))]],
        "s3": [step("s3", "D", "4", None), keep("s2", "a"), anew("s2", "assistant")],
    }
    user, assistant = "'user:'", "'assistant:'"
    # an insert leads to u or a; a second one from s or the start to a
    once = {
        "s2": ["s2", *[step(s, "I", "3", user) for s in ("s0", "s1", "s3")]],
        "s3": ["s3", step("s2", "I", "3", assistant)],
    }
    twice = {"s2": ["s2"], "s3": ["s3", step("s2", "I", "3", assistant)]}
    moved = lambda new: ", ".join(f"{least(*new[s]) if s in new else s} AS {s}" for s in ("s0", "s1", "s2", "s3"))
    return f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), fate AS (SELECT *, {_crc32_sql('k')} % 20 AS f FROM raw),
rows AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(0, CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fate WHERE f <> 0
), faults AS (
  SELECT *, trim(text, {white}) AS bare,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) || role[1] AS pair
  FROM rows
), r AS (
  SELECT *, role[1] AS initial, bare = '' OR again AS must_go, right(bare, 1) NOT IN ('.', '!', '?') AS cut_off FROM faults
), begin AS (
  SELECT DISTINCT conv_id, 0 AS pos, {{'c': 0, 'a': '', 't': ''}} AS s0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s1,
    {{'c': 3, 'a': 'I', 't': 'user:'}} AS s2, {{'c': 6, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS s3 FROM conversations
), walk AS (
  SELECT conv_id, pos, s0, s1, s2, s3 FROM begin
  UNION ALL
  SELECT conv_id, pos, {moved(twice)} FROM (
    SELECT conv_id, pos, {moved(once)} FROM (
      SELECT walk.conv_id, r.pos, {moved(rows)} FROM walk JOIN r ON r.conv_id IS NOT DISTINCT FROM walk.conv_id AND r.pos = walk.pos + 1))
), ends AS (
  SELECT conv_id, {least('s0', 's3')} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1
)
SELECT e.conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
  count(*) FILTER (WHERE bare = '') AS blank, count(*) FILTER (WHERE bare <> '' AND again) AS duplicate,
  count(*) FILTER (WHERE NOT must_go AND cut_off) AS truncated,
  count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
  CAST(any_value(best.c) AS BIGINT) AS cost, any_value(best.a) AS audit, sha256(any_value(best.t)) AS repaired_sha256
FROM ends e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id GROUP BY e.conv_id
"""


def merkle_digests(docs: DataFrame) -> DataFrame:
    """Manifest of ``docs`` and its check against rows that were tampered with."""
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    own = [F.col(c) for c in fields]
    changed = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in fields]
    hit = (F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0) & F.col("n_chars").isNotNull()
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest(own).alias("leaf"), F.when(hit, merkle.leaf_digest(changed)).alias("changed"))
    proved = merkle.manifest(leaves, carried=["changed"])
    fold = merkle.folded(F.coalesce("changed", "leaf"), F.col("proof"))
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.encode(merkle.proof_text(F.col("proof")), "UTF-8"), 256).alias("proof_sha256"),
        fold.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents."""
    return merkle_digests(read_table(spark, sf_dir, "documents"))


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(_field_sql(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


def _levels_sql(start: str) -> str:
    """Lists of digests by level, from (grp, l) rows."""
    return f"""SELECT grp, 0 AS lv, l FROM {start}
  UNION ALL SELECT grp, lv + 1, list_transform(range(0, (len(l) + 1) // 2),
    lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) FROM {{self}} WHERE len(l) > 1"""


_OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, {_leaf_sql('n_chars')} AS leaf,
    CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 7 = 0 AND n_chars IS NOT NULL
      THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS used
  FROM documents
), p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
lists AS (SELECT grp, list(leaf ORDER BY pos) AS l FROM p GROUP BY grp),
low AS ({_levels_sql('lists').format(self='low')}),
sub AS (SELECT grp, l[1] AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos FROM low WHERE len(l) = 1),
tops AS (SELECT 'all' AS grp, list(subroot ORDER BY pos) AS l FROM sub),
high AS ({_levels_sql('tops').format(self='high')}),
steps AS (
  SELECT p.grp, p.pos AS leaf_pos, lv, p.pos // CAST(power(2, lv) AS BIGINT) AS k, l FROM p JOIN low USING (grp) WHERE len(l) > 1
  UNION ALL
  SELECT p.grp, p.pos, 1000 + lv, sub.pos // CAST(power(2, lv) AS BIGINT), l FROM p JOIN sub USING (grp), high WHERE len(l) > 1
), sides AS (
  SELECT grp, leaf_pos, list({{'lhs': CASE WHEN k % 2 = 1 THEN l[k] ELSE '' END,
    'rhs': CASE WHEN k % 2 = 0 THEN coalesce(l[k + 2], '') ELSE '' END}} ORDER BY lv) AS s
  FROM steps GROUP BY grp, leaf_pos
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM (
  SELECT doc_id, leaf, subroot, (SELECT l[1] FROM high WHERE len(l) = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(s, lambda x: x.lhs || x.rhs), ''), '')) AS proof_sha256,
    CASE WHEN s IS NULL THEN used ELSE list_reduce(
      list_prepend({{'lhs': used, 'rhs': ''}}, s), lambda a, x: {{'lhs': sha256(x.lhs || a.lhs || x.rhs), 'rhs': ''}}).lhs END AS folded_root
  FROM p JOIN sub USING (grp) LEFT JOIN sides ON sides.grp = p.grp AND sides.leaf_pos = p.pos
)
"""

QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_vector_bin_packing": op2_vector_bin_packing,
    "op3_huffman_tokens": op3_huffman_tokens,
    "op4_toxicity": op4_toxicity,
    "op5_html_layout": op5_html_layout,
    "op6_source_mixing": op6_source_mixing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_sentencepiece_viterbi": op8_sentencepiece_viterbi,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_dual_tree_topk": op10_dual_tree_topk,
    "op11_line_dedup": op11_line_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLE_SQL = {
    "op1_chat_formatting": _OP1_SQL,
    "op7_jaccard_join": _OP7_SQL,
    "op9_exact_dedup": _OP9_SQL,
    "op10_dual_tree_topk": _OP10_SQL,
    "op11_line_dedup": _OP11_SQL,
    "op12_conversation_repair": _repair_sql(),
    "op13_merkle_manifest": _OP13_SQL,
}
