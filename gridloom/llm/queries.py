"""The queries of this subpackage, with SQL for those whose whole result SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1, repeating; 150% of all sizes, at most 2 epochs."""
    from .mixing import cycle_weights, mix

    return mix(table(spark, sf_dir, "documents"), cycle_weights((5, 2, 1)), share=1.5, cap=2.0).select("doc_id", "size", "source_size", "target", "taken")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of all documents on 2-word shingles at 0.8."""
    from .minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


OP2_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.r AS component_id, d.doc_id = m.r AS kept
FROM documents d JOIN (SELECT d, min(r) AS r FROM reach GROUP BY d) m ON m.d = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    from .chat import format_chats, read_back

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    return read_back(format_chats(rows.unionByName(extra)))


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + length(text) + 20
    + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '\', '')))
    + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '<s>', ''))) // 3
    + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '</s>', ''))) // 4
    + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '[INST]', ''))) // 6
    + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '[/INST]', ''))) // 7 AS chars
  FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a machine trained on labels outside the held-out fold."""
    from .toxicity import fold_of, score_texts, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), use=fold_of("doc_id", 5) != 0)
    scored = score_texts(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    from .pii import report

    return report(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, its edited text and its successor."""
    from .fingerprint import edited_pairs

    return edited_pairs(table(spark, sf_dir, "documents"))


def op8_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those outside fold 2 of 7."""
    from .ctw import score
    from .toxicity import fold_of

    return score(table(spark, sf_dir, "documents"), fold_of("doc_id", 7) != 2)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20-word windows that start earlier elsewhere, removed from all documents."""
    from .substring import removal_report

    return removal_report(table(spark, sf_dir, "documents"), k=20)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every 50th vector among all others."""
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS t FROM w WHERE len(w) >= 20),
dup AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, s + unnest(range(0, 20)) AS i FROM dup),
kept AS (
  SELECT x.doc_id, string_agg(x.t, ' ' ORDER BY x.i) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM w) x LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.i = x.i
  WHERE g.i IS NULL GROUP BY x.doc_id
)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_near_duplicates, op3_chat, op4_toxicity, op5_packing, op6_pii, op7_fingerprints, op8_scoring, op9_repeats, op10_neighbours)}


def oracle_sql() -> dict[str, str]:
    return {"op2_near_duplicates": OP2_SQL, "op3_chat": OP3_SQL, "op9_repeats": OP9_SQL}
