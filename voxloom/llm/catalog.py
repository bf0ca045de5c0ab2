"""The opN queries over the driver's tables, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import find_leaks
from .line_dedup import apply_bitmaps, line_bitmaps
from .lm_score import language_scores
from .near_dedup import near_duplicates
from .packing import ByteVocabulary, pack_documents, sequences
from .quality import quality_rules
from .secrets import KINDS, scan_secrets
from .sentencepiece_stream import Vocabulary, encode_documents
from .span_dedup import remove_repeats
from .tables import documents, fold, table
from .toxicity import ToxicityModel, train


def toxicity_model(spark: SparkSession, sf_dir: str) -> ToxicityModel:
    """Learned from the labels of the four folds that are not held out."""
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0)
    return train(documents(spark, sf_dir), labels)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity_model(spark, sf_dir)
    scored = documents(spark, sf_dir).select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


#: The public BPE model whose ids op2 gives; a parameter of the operators.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(documents(spark, sf_dir), Vocabulary.load(PIECE_MODEL))
    return coded.select(F.col("id").alias("doc_id"), "n_tokens", "ids", "round_trip", "decoded")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return apply_bitmaps(docs, line_bitmaps(docs, min_docs=10)).select(
        "doc_id", F.col("__line_total").alias("n_lines"), F.col("__line_dropped").alias("n_dropped"), F.sha2("__line_kept", 256).alias("kept_sha256")
    )


OP3_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
keyed AS (
  SELECT doc_id, i, lines[i] AS line,
         translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM split)),
frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY doc_id
"""


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = language_scores(documents(spark, sf_dir), fold(F.col("doc_id")) != 1)
    return scored.select(F.col("id").alias("doc_id"), (~F.col("in_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: All shingles meet all, so this is for small tables.
OP5_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS shingle
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS inter
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY x, y),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * inter >= 80 * (a.n + b.n - inter)),
reach AS (SELECT doc_id, doc_id AS other FROM words UNION SELECT r.doc_id, y FROM reach r JOIN links ON x = r.other)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(other)::BIGINT AS component_id, r.doc_id = min(other) AS kept
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), size=4, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


#: The public byte-level vocabulary whose ids op6 packs, with its pattern; parameters of the operator.
BYTE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def byte_vocabulary() -> ByteVocabulary:
    import public_tokenizers

    return ByteVocabulary.load(BYTE_RANKS, public_tokenizers.PATTERN)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = sequences(pack_documents(documents(spark, sf_dir), byte_vocabulary()))
    return packed.select(
        "shard", "row", "n_tokens", F.col("segments.id").alias("doc_ids"), F.col("segments.piece").alias("pieces"), "cu_seqlens",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("positions", 256).alias("positions_sha256"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(documents(spark, sf_dir))
    names = F.array(*map(F.lit, KINDS))
    text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


def op9_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select(
        "doc_id", F.size("__span_removed").cast("long").alias("n_removed"), F.col("__span_removed").alias("removed"),
        F.length("__span_kept").cast("long").alias("kept_chars"), F.sha2("__span_kept", 256).alias("kept_sha256"),
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), (F.size("matches") > 0).alias("contaminated"),
        F.array_sort(F.col("matches.item")).alias("item_ids"), F.coalesce(F.array_max("matches.similarity"), F.lit(0.0)).alias("similarity"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_line_dedup": op3_line_dedup,
    "op4_lm_score": op4_lm_score,
    "op5_near_dedup": op5_near_dedup,
    "op6_packing": op6_packing,
    "op7_secrets": op7_secrets,
    "op8_quality_rules": op8_quality_rules,
    "op9_span_dedup": op9_span_dedup,
    "op10_decontaminate": op10_decontaminate,
}

ORACLES: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op5_near_dedup": OP5_SQL,
}
