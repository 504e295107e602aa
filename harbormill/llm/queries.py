"""The operators of this subpackage applied to their whole tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harbormill.llm import (
    cascade,
    chat,
    code_compression,
    divergence,
    embedding_dedup,
    language,
    lines,
    lm,
    multi_index,
    packing,
    pieces,
    secrets,
    simhash,
)
from harbormill.session import prepare

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# --- chat formatting ----------------------------------------------------------

# The rows added to the table.
PROBE_ID, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    out = chat.format_conversations(turns.unionByName(probe))
    read = out.select("conv_id", "segments", "formatted", "valid", chat.read_turns(F.col("formatted")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("segments"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    count(*) OVER (PARTITION BY conv_id) AS n,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM rows
), judged AS (
  SELECT *, CASE WHEN pos = 1 THEN role IN ('system', 'user') WHEN before = 'system' THEN role = 'user'
      WHEN before = 'user' THEN role = 'assistant' WHEN before = 'assistant' THEN role = 'user' ELSE false END AS fits,
    length(role) + (length(role) - length(replace(replace(role, '\', ''), '|', '')))
      + length(text) + (length(text) - length(replace(replace(text, '\', ''), '|', ''))) AS inner_chars
  FROM numbered
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(inner_chars + length('<|turn ') + length('|>' || chr(10)) + length('<|end|>' || chr(10)))::BIGINT AS formatted_chars,
  bool_and(fits) AND max(CASE WHEN pos = n THEN role END) IN ('user', 'assistant') AS valid
FROM judged GROUP BY conv_id
"""


# --- embeddings ---------------------------------------------------------------


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS src, b.vec_id AS dst FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach(src, dst) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.src, l.dst FROM reach r JOIN links l ON r.dst = l.src
), classes AS (SELECT src, min(dst) AS component_id FROM reach GROUP BY src
), counts AS (SELECT src, count(*) AS n FROM links GROUP BY src)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN counts ON counts.src = e.vec_id JOIN classes ON classes.src = e.vec_id
"""

def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return multi_index.nearest_vectors(rows, rows.where(F.col("vec_id") % 20 == 0))


# --- packing ------------------------------------------------------------------


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# --- line dedup ---------------------------------------------------------------


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = lines.repeated_lines(docs)
    d, g = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.size(F.split("text", "\n", -1)).alias("n")).alias("d"), gone.alias("g")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_key") == F.col("g.text_key"))
    removed = F.coalesce("g.removed", F.array().cast("array<int>"))
    return d.join(g, same, "left").select(
        "d.doc_id",
        F.greatest(F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed"),
    )


# --- SimHash ------------------------------------------------------------------


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- language -----------------------------------------------------------------


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.select("doc_id", "lang", "text"))
    out = language.with_language(docs.select("doc_id", "text"), model)
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


# --- LM scoring ---------------------------------------------------------------


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.backoff_scores(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


# --- secret scans -------------------------------------------------------------


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < secrets.BASE)
    return found.select(
        "doc_id",
        count(secrets.ASSIGN).alias("n_assign"),
        count(secrets.ACCESS).alias("n_access"),
        count(secrets.HEX).alias("n_hex"),
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


# --- piece encoding -----------------------------------------------------------


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECE_MODEL)
    coded = pieces.encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    both = pieces.decode_pieces(coded, model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )


# --- quality cascade ----------------------------------------------------------

OP11_REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op11_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = cascade.quality_cascade(docs, report=OP11_REPORT)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select("doc_id", *OP11_REPORT, failed.alias("base_failed"), "kept")


OP11_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), parts AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM parts)
), repeated AS (
  SELECT rid, count(DISTINCT w) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS w FROM windows WHERE times > 1) GROUP BY rid
), counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(words, lambda w: regexp_matches(w, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines
  FROM parts LEFT JOIN repeated USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND word_chars BETWEEN 3 * n_words AND 10 * n_words
    AND 10 * n_symbols <= n_words AND 10 * n_letter_words >= 8 * n_words AND 2 * n_dup_lines <= n_lines
    AND 10 * n_cut_lines <= 3 * n_lines AND 10 * n_bullet_lines <= 9 * n_lines AS kept
FROM counted
"""


# --- source divergence --------------------------------------------------------


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT rid, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs)
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 10
), langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT d.lang, d.source, coalesce(own, 0) AS own FROM docs d
  LEFT JOIN (SELECT lang, source, sum(n) AS own FROM counts GROUP BY lang, source) o ON o.lang = d.lang AND o.source = d.source
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.own + 2 * v)::HUGEINT)::HUGEINT AS p,
    (1 + (1000000000::HUGEINT * (k.n + 2)) // (total + 2 * v)::HUGEINT)::HUGEINT AS q
  FROM groups g JOIN langs USING (lang) JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), apart AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM dense WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM apart)
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


# --- vector codes -------------------------------------------------------------


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = code_compression.compress_vectors(table(spark, sf_dir, "embeddings"))
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256"
    )


def _op13_sql(rounds: int = code_compression.ROUNDS) -> str:
    """Whole numbers throughout; a round is an assignment and a mean, written out one after the other."""
    assigned = """
assigned{n} AS (
  SELECT rid, m, arg_min(e, struct_pack(d := d, e := e)) AS e, min(d) AS d FROM (
    SELECT p.rid, p.m, b.e, sum((p.c - b.c) * (p.c - b.c)) AS d FROM parts p JOIN book{n} b ON p.m = b.m AND p.j = b.j GROUP BY ALL
  ) GROUP BY rid, m
)"""
    moved = """
means{n} AS (
  SELECT p.m, a.e, p.j,
    (CASE WHEN sum(p.c) % count(*) < 0 THEN sum(p.c) // count(*) - 1 ELSE sum(p.c) // count(*) END)::BIGINT AS c
  FROM parts p JOIN assigned{n} a USING (rid, m) GROUP BY p.m, a.e, p.j
), book{next} AS (
  SELECT b.m, b.e, b.j, coalesce(k.c, b.c) AS c FROM book{n} b LEFT JOIN means{n} k ON k.m = b.m AND k.e = b.e AND k.j = b.j
)"""
    steps = [s.format(n=n, next=n + 1) for n in range(rounds) for s in (assigned, moved)] + [assigned.format(n=rounds)]
    return f"""
WITH vectors AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT rid, (i - 1) // 4 AS m, (i - 1) % 4 AS j, floor(256 * v[i])::BIGINT AS c
  FROM (SELECT rid, v, unnest(range(1, 65)) AS i FROM vectors)
), book0 AS (SELECT m, rid - 1 AS e, j, c FROM parts WHERE rid <= 64
), {", ".join(steps)}
, coded AS (
  SELECT rid, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY m) AS code, sum(d)::BIGINT AS error FROM assigned{rounds} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY m, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM vectors JOIN coded USING (rid)
"""


OP13_SQL = _op13_sql()


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op3_nearest": op3_nearest,
    "op2_packing": op2_packing,
    "op4_chat_format": op4_chat_format,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_language": op7_language,
    "op8_lm_score": op8_lm_score,
    "op9_secret_scan": op9_secret_scan,
    "op10_pieces": op10_pieces,
    "op11_quality_cascade": op11_quality_cascade,
    "op12_source_divergence": op12_source_divergence,
    "op13_vector_codes": op13_vector_codes,
}

SQL = {
    "op1_embedding_dedup": OP1_SQL,
    "op4_chat_format": OP4_SQL,
    "op11_quality_cascade": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
