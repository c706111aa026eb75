"""Registered queries of the corpus operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicator_engine.llm.conversation_repair import audit
from indicator_engine.llm.exact_dedup import exact_dedup
from indicator_engine.llm.html_extract import extract_text
from indicator_engine.llm.language_id import identify, learn
from indicator_engine.llm.mixing import mix
from indicator_engine.llm.near_dedup import near_groups
from indicator_engine.llm.neighbours import nearest
from indicator_engine.llm.sentence_pieces import segment
from indicator_engine.llm.substring_dedup import remove_repeats
from indicator_engine.llm.token_counts import count_tokens
from indicator_engine.llm.token_output import token_files
from indicator_engine.llm.top_k import top_k
from indicator_engine.llm.vector_codes import compress


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = learn(docs.where(~held_out))
    judged = identify(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's encoding of every text, whether decoding gives the text back, and the n best segmentations.

    ``n_best_scores`` and ``n_best_hashes`` have one entry for each of those, best first.
    """
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = segment(docs, path, alternatives=True, encoded=True, decoded=True)
    return pieces.select(
        "doc_id",
        F.size("encoded_ids").cast("long").alias("n_pieces"),
        F.get("piece_scores", F.lit(0)).alias("score"),
        F.get("piece_scores", F.lit(1)).alias("second_score"),
        F.size("piece_scores").alias("n_segmentations"),
        F.xxhash64("encoded_ids").alias("ids_hash"),
        F.col("piece_scores").alias("n_best_scores"),
        F.transform("piece_alternatives", lambda ids: F.xxhash64(ids)).alias("n_best_hashes"),
        (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("round_trip"),
    )


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark, table(spark, sf_dir, "documents"), words=3, threshold=85)


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = exact_dedup(spark, table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(spark, table(spark, sf_dir, "embeddings"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(spark, vectors, vectors.where("vec_id % 20 = 0"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_top_k": op4_top_k,
    "op5_sentence_pieces": op5_sentence_pieces,
    "op6_html_extract": op6_html_extract,
    "op7_near_dedup": op7_near_dedup,
    "op8_token_output": op8_token_output,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_vector_codes": op12_vector_codes,
    "op13_neighbours": op13_neighbours,
}

def _assigned(step: int) -> str:
    """Nearest entry of every part to the entries of a step (ties: the first)."""
    return f"""near{step} AS (
  SELECT p.row, p.part, min(d * 64 + b.entry) AS best FROM parts p JOIN (
    SELECT part, entry, v FROM book{step}) b USING (part),
    LATERAL (SELECT list_sum([(p.v[i] - b.v[i]) * (p.v[i] - b.v[i]) FOR i IN range(1, len(p.v) + 1)]) AS d) s
  GROUP BY p.row, p.part)"""


def _moved(step: int) -> str:
    """The entries after the assignment of the step before: floor of the mean, unused ones as they were."""
    before = step - 1
    return f"""means{step} AS (
  SELECT part, entry, list(CAST(floor(CAST(total AS DOUBLE) / n) AS BIGINT) ORDER BY i) AS v FROM (
    SELECT p.part, best % 64 AS entry, i, sum(p.v[i]) AS total, count(*) AS n
    FROM near{before} JOIN parts p USING (row, part), range(1, len(p.v) + 1) t(i) GROUP BY ALL)
  GROUP BY ALL),
book{step} AS (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{before} b LEFT JOIN means{step} m USING (part, entry))"""


ORACLE = {
    "op3_mixing": r"""
WITH rows AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix:' || doc_id) AS ord
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS turn
  FROM rows GROUP BY source),
weighted AS (
  SELECT source, source_size,
         CASE (turn - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         CASE (turn - 1) % 3 WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS ramp,
         source_size * 2.0::DOUBLE AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS goal
  FROM sources),
levels AS (
  SELECT *, cap / w AS ratio,
         (goal - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size, ramp,
         least(cap, coalesce(max(CASE WHEN level < ratio THEN level END) OVER () * w, cap)) AS target
  FROM levels),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, t.ramp,
         CAST(coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.ord, r.doc_id, r.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS passes
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(size * passes + greatest(0, least(
         CAST(floor(target - passes * source_size) AS BIGINT) - start, size)) AS BIGINT) AS taken
  FROM placed)
SELECT doc_id, size, source_size, target, taken,
       CASE WHEN taken <= 0 THEN NULL
            WHEN ramp = 0 THEN start / target
            ELSE (sqrt((1 - ramp) * (1 - ramp) + 4 * ramp * (start / target)) - (1 - ramp)) / (2 * ramp) END AS position
FROM counted
""",
    "op4_top_k": """
WITH vectors AS (
  SELECT vec_id, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 5
""",
    "op10_exact_dedup": r"""
WITH rows AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM rows WINDOW g AS (PARTITION BY text_sha256)
""",
    "op11_conversation_repair": r"""
WITH RECURSIVE bytes AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
              lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
sums AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv,
         xor(list_reduce([4294967295]::BIGINT[] || [CAST(ord(c) AS BIGINT) FOR c IN string_split(
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')],
             lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS fault
  FROM conversations, bytes),
damaged AS (
  SELECT conv, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM sums, range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv) AS n, substr(role, 1, 1) AS initial,
         lag(substr(role, 1, 1)) OVER w AS before
  FROM damaged WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text))),
judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS state
  FROM placed),
priced AS (SELECT *, state IN ('b', 'd') AS must, CASE state WHEN 't' THEN 5 ELSE 0 END AS k FROM judged),
back(conv, i, c) AS (
  SELECT conv, n + 1, [0, 10, 5, 0]::BIGINT[] FROM (SELECT DISTINCT conv, n FROM priced)
  UNION ALL
  SELECT conv, i, [least(m[1], 5 + least(m[3], 5 + m[4])), least(m[2], 5 + least(m[3], 5 + m[4])),
                   least(m[3], 5 + m[4]), least(m[4], 5 + m[3])]
  FROM (SELECT p.conv, p.i, CASE WHEN must THEN [2 + c[1], 2 + c[2], 2 + c[3], 2 + c[4]] ELSE
          [least(2 + c[1], 1 + k + c[3], CASE initial WHEN 's' THEN k + c[2] WHEN 'u' THEN k + c[3] END),
           least(2 + c[2], 1 + k + c[3], CASE initial WHEN 'u' THEN k + c[3] END),
           least(2 + c[3], 1 + k + c[4], CASE initial WHEN 'a' THEN k + c[4] END),
           least(2 + c[4], 1 + k + c[3], CASE initial WHEN 'u' THEN k + c[3] END)] END AS m
        FROM back b JOIN priced p ON p.conv = b.conv AND p.i = b.i - 1)),
walk(conv, step, i, s, edit, role, text) AS (
  SELECT conv, 0, CAST(1 AS BIGINT), 1, '', '', '' FROM back WHERE i = 1
  UNION ALL
  SELECT conv, step + 1, CASE edit WHEN 'I' THEN i ELSE i + 1 END,
         CASE edit WHEN 'D' THEN s WHEN 'K' THEN kept ELSE moved END, edit,
         CASE WHEN edit = 'K' THEN role WHEN moved = 3 THEN 'user' ELSE 'assistant' END,
         CASE edit WHEN 'I' THEN '' ELSE text END
  FROM (SELECT *, CASE WHEN here[s] = 2 + later[s] THEN 'D' WHEN here[s] = 5 + here[moved] THEN 'I'
                       WHEN here[s] = k + later[kept] THEN 'K' ELSE 'R' END AS edit
        FROM (SELECT w.conv, w.step, w.i, w.s, p.role, p.text, p.k, b.c AS here, a.c AS later,
                     CASE w.s WHEN 3 THEN 4 ELSE 3 END AS moved,
                     CASE WHEN p.initial = 's' AND w.s = 1 THEN 2 WHEN p.initial = 'u' AND w.s <> 3 THEN 3
                          WHEN p.initial = 'a' AND w.s = 3 THEN 4 END AS kept
              FROM walk w JOIN back b ON b.conv = w.conv AND b.i = w.i
              LEFT JOIN back a ON a.conv = w.conv AND a.i = w.i + 1
              LEFT JOIN priced p ON p.conv = w.conv AND p.i = w.i
              WHERE a.c IS NOT NULL OR b.c[w.s] > 0))),
edited AS (
  SELECT conv, string_agg(edit, '' ORDER BY step) AS audit,
         sha256(coalesce(string_agg(role || ':' || text, chr(10) ORDER BY step) FILTER (edit <> 'D'), '')) AS sha
  FROM walk WHERE step > 0 GROUP BY conv),
faults AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (state = 'b') AS blank,
         count(*) FILTER (state = 'd') AS duplicate, count(*) FILTER (state = 't') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(c[1], 0) AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM sums) LEFT JOIN faults USING (conv) LEFT JOIN edited USING (conv)
LEFT JOIN (SELECT conv, c FROM back WHERE i = 1) USING (conv)
""",
    "op12_vector_codes": f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
         [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (
  SELECT row, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v
  FROM kept, range(16) t(part)),
book0 AS (SELECT part, row - 1 AS entry, v FROM parts WHERE row <= 64),
{_assigned(0)}, {_moved(1)}, {_assigned(1)}, {_moved(2)}, {_assigned(2)},
coded AS (
  SELECT row, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code,
         CAST(sum(best // 64) AS BIGINT) AS error
  FROM near2 GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (row)
""",
}
