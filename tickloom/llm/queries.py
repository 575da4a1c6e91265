"""The queries of this package: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many lines it has, how many went, and the text that stays as a digest and as itself."""
    from .lines import dedup_lines

    found = dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"), "text")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and each benchmark item that it contains; clean documents have none."""
    from .decontaminate import matches

    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import assign

    return assign(table(spark, sf_dir, "documents"), shards=24)


def vocabulary() -> str:
    """The vocabulary file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary(), 1024)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .shared import shared_path
    from .tokenfiles import digests, write

    folder = shared_path(spark, "token-ids")
    write(table(spark, sf_dir, "documents"), folder, vocabulary())
    return digests(spark, folder)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import dedup_substrings

    found = dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_language_model_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


def pieces() -> str:
    """The piece model that the alignment query uses."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .alignment import alignment

    return alignment(table(spark, sf_dir, "documents"), vocabulary(), pieces())


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import edits

    return edits(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


#: Windows of 20 words told apart as text; a word goes if a window over it has the text of an earlier one.
SUBSTRINGS_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS i, words FROM texts WHERE len(words) >= 20),
windows AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(words[i : i + 19], ' ') ORDER BY doc_id, i) AS n FROM starts),
covered AS (SELECT DISTINCT doc_id, i + unnest(range(20)) AS place FROM windows WHERE n > 1),
every AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.place) AS text FROM every e LEFT JOIN covered c ON e.doc_id = c.doc_id AND e.place = c.place WHERE c.place IS NULL GROUP BY e.doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id LEFT JOIN (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id) r ON t.doc_id = r.doc_id"""


#: All scores of the anchors, positives and windows told by their ranks.
NEGATIVES_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id AND len(a.v) = len(r.v)),
positives AS (SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op8_substring_dedup": SUBSTRINGS_SQL, "op12_hard_negative_mining": NEGATIVES_SQL}
