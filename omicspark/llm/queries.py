"""The registered queries of the llm operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from omicspark.llm.token_counts import document_token_counts

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return document_token_counts(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, end_id=50256)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from omicspark.llm.simhash import simhash_components

    found = simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from omicspark.llm.bpe import decode, encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decode("ids", path), 256).alias("decoded_sha256"),
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from omicspark.llm.html_extract import main_text

    pages = _table(spark, sf_dir, "pages").select("page_id", "url", main_text("html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from omicspark.llm.packing import pack
    from omicspark.llm.token_files import ids_crc32

    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = pack(_table(spark, sf_dir, "documents"), path, end_id=1, vocabulary=50257)
    return packed.select("doc_id", "start", "length", ids_crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from omicspark.llm.quality import judge

    found = judge(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_OP6_SQL = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, [w FOR w IN string_split_regex(text, '[\\x20\\x09-\\x0D]+') IF w <> ''] AS ws,
         [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')] AS ls
  FROM docs),
each AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
grams AS (
  SELECT r, i, w, lag(w) OVER o AS before,
         CASE WHEN lead(w, 4) OVER o IS NOT NULL
              THEN w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o END AS g
  FROM each WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams WHERE g IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY r),
stutter AS (SELECT r, count(*) AS n FROM grams WHERE w = before GROUP BY r),
stats AS (
  SELECT d.r, doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(s.n, 0)::BIGINT AS n_stutter,
         length(regexp_replace(text, '[^\\p{Lu}]+', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(text, '[^\\p{L}]+', '', 'g'))::BIGINT AS n_letters
  FROM docs d JOIN words USING (r) LEFT JOIN covered c USING (r) LEFT JOIN stutter s USING (r)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR (n_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines)
            OR 100 * n_stutter > 20 * n_words OR 100 * n_upper > 50 * n_letters
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM base
"""


OWN_CONVERSATION = -7
OWN_TEXT = "\\### Assistant: </turn> ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from omicspark.llm.chat import format_conversations, read_loss, read_turns, text_part

    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(OWN_CONVERSATION).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(OWN_TEXT).alias("text"))
    turns = table.unionByName(own).withColumn("parts", text_part(F.col("text")))
    said = format_conversations(turns)
    back = said.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), F.array_join(read_loss(F.col("formatted"), F.col("loss_mask")), "").alias("loss"))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


_OP7_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
escaped AS (SELECT *, replace(replace(text, '\\', '\\\\'), '<|', '<\\|') AS et, replace(replace(role, '\\', '\\\\'), '<|', '<\\|') AS er FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, et)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, et) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|><|says|><|end|>') + length(er) + length(et))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from omicspark.llm.topk import exact_top_k

    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


_OP8_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM rows q JOIN rows c ON c.r <> q.r WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from omicspark.llm.langid import identify

    return identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from omicspark.llm.token_files import ids_crc32, read_token_files, write_token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    files = write_token_files(_table(spark, sf_dir, "documents"), path, vocabulary=49408, end_id=2)
    return read_token_files(files).select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), ids_crc32("ids").alias("ids_crc32"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from omicspark.llm.merkle import leaf_digest, manifest

    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        leaf_digest(["doc_id", "source", "lang", "n_chars", "text"]).alias("leaf"),
        leaf_digest(["doc_id", "source", "lang", "n_chars", F.when(tampered, lowered).otherwise(F.col("text"))]).alias("presented"),
    )
    proved = manifest(rows, "lang", ["doc_id"], "leaf", "presented")
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_OP11_SQL = """
WITH RECURSIVE
part(v) AS (SELECT 0),
docs AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND list_reduce(
      list_prepend(4294967295::BIGINT, flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])),
      lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END).xor(4294967295) % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(shown) || ':' || shown, '-')) AS presented
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM docs)),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n, coalesce('=' || lang, '') AS g
  FROM hashed),
lower(g, level, i, n, d) AS (
  SELECT g, 0, i, n, leaf FROM leaves
  UNION ALL
  SELECT g, max(level) + 1, i // 8, (max(n) + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM lower WHERE n > 1 GROUP BY g, i // 8),
subroots AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM lower WHERE n = 1),
upper(level, i, n, d) AS (
  SELECT 0, i, n, d FROM subroots
  UNION ALL
  SELECT max(level) + 1, i // 8, (max(n) + 7) // 8, sha256(string_agg(d, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY i // 8),
root AS (SELECT d FROM upper WHERE n = 1),
heights AS (SELECT g, max(level) AS h FROM lower GROUP BY g),
nodes AS (
  SELECT g, level, i, n, d, i // 8 AS run FROM lower WHERE n > 1
  UNION ALL
  SELECT s.g, h.h + u.level, u.i, u.n, u.d, u.i // 8 FROM upper u, subroots s JOIN heights h USING (g)
  WHERE u.n > 1),
sides AS (
  SELECT g, level, i,
         coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WINDOW w AS (PARTITION BY g, level, run ORDER BY i)),
climb(g, k, level, i, cur, proof) AS (
  SELECT g, i, 0, CASE WHEN n = 1 THEN (SELECT s.i FROM subroots s WHERE s.g = leaves.g) ELSE i END, presented, '' FROM leaves
  UNION ALL
  SELECT c.g, c.k, c.level + 1,
         CASE WHEN c.level + 1 = h.h THEN s.i ELSE c.i // 8 END,
         sha256(x.before || c.cur || x.after), c.proof || x.before || x.after
  FROM climb c JOIN sides x ON x.g = c.g AND x.level = c.level AND x.i = c.i JOIN heights h ON h.g = c.g JOIN subroots s ON s.g = c.g),
done AS (SELECT g, k, max_by(cur, level) AS folded, max_by(proof, level) AS proof FROM climb GROUP BY g, k)
SELECT l.doc_id, l.leaf, s.d AS subroot, r.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.d AS verified
FROM leaves l JOIN done ON done.g = l.g AND done.k = l.i JOIN subroots s ON s.g = l.g, root r
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from omicspark.llm.alignment import align, score_links

    aligned = align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    told = F.when(F.octet_length("groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    scored = score_links(aligned.withColumn("groups_sha256", told).drop("groups", "sound"))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from omicspark.llm.chunk_reuse import decode, encode

    path = public_tokenizers.path("word_bpe_49k.json")
    return encode(_table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(decode("ids", path), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_simhash": op2_simhash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_html": op4_html,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_chat": op7_chat,
    "op8_topk": op8_topk,
    "op9_langid": op9_langid,
    "op10_token_files": op10_token_files,
    "op11_merkle": op11_merkle,
    "op12_alignment": op12_alignment,
    "op13_chunk_bpe": op13_chunk_bpe,
}
SQL: dict[str, str] = {"op6_quality": _OP6_SQL, "op7_chat": _OP7_SQL, "op8_topk": _OP8_SQL, "op11_merkle": _OP11_SQL}
