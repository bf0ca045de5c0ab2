"""Named queries over the driver's tables and the SQL that says the same.

No table of the driver holds audio, so queries exercise the operators through proxies:
``conversations`` stands for segments (conversation = channel, role = speaker, turn =
segment), ``documents`` for segments with a text and a duration (``n_chars / 150``),
``labels`` for the manifest of rows already done, and ``embeddings`` for waveforms and
quantised codes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import audio, text, tokens, vocab
from ..operators import pairs, tables
from ..sources.transcripts import parse_transcripts, valid_segments
from ..operators.models import stub_decoder
from ..sources.work import work_folder
from ..streaming.chunks import Chunking, chunk_bounds, decode_stream
from ..streaming.ingest import drained
from .training_rows import rows_v1, rows_v2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _long(c: Column) -> Column:
    return c.cast("long")


# Proxy columns, and the same in SQL.


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with a duration and codes (one code for each letter of the language's name, none for 'es')."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text", "lang", "source", (F.col("n_chars") / 150.0).alias("duration"), F.when(F.col("lang") == "es", F.array()).otherwise(F.array(F.lit(1), F.lit(2))).cast("array<int>").alias("codes"))


_SEGMENTS = "(SELECT doc_id, text, lang, source, n_chars / 150.0::DOUBLE AS duration, CASE WHEN lang = 'es' THEN [] ELSE [1, 2] END AS codes FROM documents)"


def _codes(spark: SparkSession, sf_dir: str, n: int = 63) -> DataFrame:
    """embeddings quantised: nine frames of seven."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.transform(F.slice("embedding", 1, n), lambda x: F.floor((x.cast("double") + 1) * 3).cast("long")).alias("codes"))


_CODES = "(SELECT vec_id, list_transform(embedding[1:63], lambda x: floor((x::DOUBLE + 1) * 3)::BIGINT) AS codes FROM embeddings)"
_PAIR_GROUP = ["conv_id", "role"]


# Transcripts to segments.


def _transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as transcript documents, every third under a ``segments`` key."""
    c = table(spark, sf_dir, "conversations")
    start = F.col("turn") * 700
    one = F.struct("turn", F.struct(F.col("text").alias("text"), start.alias("start_ms"), (start + F.length("text") % 800).alias("end_ms"), F.col("role").alias("speaker_id")).alias("s"))
    whole = c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]).alias("s"))
    body = F.to_json("s")
    return whole.select(
        F.concat(F.lit("audio_"), F.col("conv_id").cast("string"), F.lit(".json")).alias("file"),
        F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit('{"segments":'), body, F.lit("}"))).otherwise(body).alias("json"),
    )


@query(
    """SELECT conv_id || '_seg_' || idx AS audio_id, conv_id::VARCHAR AS recording, idx::BIGINT AS idx, role AS speaker_id, 'unknown' AS gender, 'unknown' AS dialect, 'neutral' AS tone,
       round((length(text) % 800) / 1000.0, 6)::DOUBLE AS duration_sec
       FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx FROM conversations)
       WHERE text IS NOT NULL AND regexp_matches(text, '\\S') AND length(text) % 800 >= 300"""
)
def seg_explode_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S07, F01, F02, W05, X03, X17, X18."""
    found = valid_segments(parse_transcripts(_transcripts(spark, sf_dir), "file", "json"))
    return found.select("audio_id", "recording", "idx", "speaker_id", "gender", "dialect", "tone", F.round("duration_sec", 6).alias("duration_sec"))


@query("SELECT vec_id, embedding[(vec_id % 50)::INT + 1 : least((vec_id % 50)::INT + 20, 64)] AS samples FROM embeddings")
def seg_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W04 at 1000 samples a second: a millisecond is a sample."""
    e = table(spark, sf_dir, "embeddings")
    start = F.col("vec_id") % 50
    return e.select("vec_id", audio.slice_by_time(F.col("embedding"), start, start + 20, 1000).alias("samples"))


# Filters.


@query(
    """SELECT doc_id FROM documents WHERE length(text) > 0 AND NOT regexp_matches(text, '\\p{Nd}') AND NOT regexp_matches(text, '([a-zA-Z]\\.){2,}')
       AND NOT regexp_matches(text, '[A-Z]{2,}') AND right(text, 1) IN ('.', ',', '?', '!') AND position('£' IN text) = 0 AND position('$' IN text) = 0"""
)
def text_quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12."""
    return table(spark, sf_dir, "documents").where(text.text_quality(F.col("text"))).select("doc_id")


@query(f"SELECT doc_id, round(duration, 6) AS duration FROM {_SEGMENTS} WHERE duration BETWEEN 0.5 AND 15.0 AND len(codes) > 0")
def duration_codes_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F03, F04."""
    return _segments(spark, sf_dir).where(pairs.eligible(F.col("duration"), F.col("codes"))).select("doc_id", F.round("duration", 6).alias("duration"))


@query(
    f"""SELECT doc_id, CASE WHEN len(codes) > 0 THEN codes WHEN duration BETWEEN 0.1 AND 200 AND length(text) > 0 THEN [length(text)::INT] ELSE [] END AS codes FROM {_SEGMENTS}"""
)
def encode_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes stay; rows out of range get none."""
    s = _segments(spark, sf_dir)
    samples = F.when(F.length("text") > 0, F.array(F.lit(0.0))).otherwise(F.array().cast("array<double>"))
    return s.select("doc_id", tables.codes_or(F.col("codes"), tables.encode_eligible(samples, F.col("duration")), F.array(F.length("text"))).alias("codes"))


@query("SELECT page_id, url FROM pages WHERE position('/en/' IN url) > 0 OR position('/de/' IN url) > 0")
def channel_path_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F08."""
    return table(spark, sf_dir, "pages").where(text.in_channels(F.col("url"), ["en", "de"])).select("page_id", "url")


@query("SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src2')")
def channel_directory_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F09."""
    return table(spark, sf_dir, "documents").where(text.channel_directory(F.col("source"), ["src1", "src2"])).select("doc_id", "source")


@query(
    f"""SELECT count(*) FILTER (WHERE len(codes) > 0 AND duration BETWEEN 0.5 AND 15) AS kept, count(*) FILTER (WHERE len(codes) = 0) AS skipped_no_codes,
        count(*) FILTER (WHERE len(codes) > 0 AND NOT duration BETWEEN 0.5 AND 15) AS skipped_duration FROM {_SEGMENTS}"""
)
def skip_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A09, codes tested first."""
    return tables.skip_counters(_segments(spark, sf_dir), F.col("duration"), F.col("codes"))


@query(
    f"""SELECT count(*) FILTER (WHERE len(codes) > 0 AND duration BETWEEN 0.5 AND 15) AS kept, count(*) FILTER (WHERE len(codes) = 0 AND duration BETWEEN 0.5 AND 15) AS skipped_no_codes,
        count(*) FILTER (WHERE NOT duration BETWEEN 0.5 AND 15) AS skipped_duration FROM {_SEGMENTS}"""
)
def skip_counters_duration_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A09, duration tested first."""
    return tables.skip_counters(_segments(spark, sf_dir), F.col("duration"), F.col("codes"), codes_first=False)


@query("SELECT count(*) AS before, count(*) FILTER (WHERE n_chars < 2000) AS after, count(*) FILTER (WHERE NOT n_chars < 2000) AS removed FROM documents")
def filter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, F14."""
    return tables.filter_delta(table(spark, sf_dir, "documents"), F.col("n_chars") < 2000)


# Resume.


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J03, U02, F07."""
    return tables.pending(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"]).select("doc_id", "source")


@query("SELECT doc_id FROM labels UNION SELECT doc_id FROM documents WHERE lang = 'en'")
def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S21, U03."""
    done = table(spark, sf_dir, "documents").where("lang = 'en'")
    return tables.merged_manifest(table(spark, sf_dir, "labels"), done, ["doc_id"])


@query("SELECT user_id, count(*)::BIGINT AS n, round(sum(value), 6) AS total FROM events GROUP BY user_id")
def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§2.10: the events file arrives as a stream, is taken in once, and is aggregated."""
    found = drained(spark, f"{sf_dir}/events.parquet", ["event_id", "user_id", "value"])
    return found.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


# Pairs.


@query("SELECT conv_id, role, count(*)::BIGINT AS n FROM conversations GROUP BY conv_id, role HAVING count(*) >= 2")
def valid_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11, J04, A01."""
    return pairs.valid_speakers(table(spark, sf_dir, "conversations"), _PAIR_GROUP)


@query(
    """SELECT r.conv_id, r.role, r.turn AS ref, t.turn AS target, r.text AS ref_text, t.text AS target_text
       FROM conversations r JOIN conversations t ON r.conv_id = t.conv_id AND r.role = t.role AND r.turn <> t.turn"""
)
def pairs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload joined to the pairs of keys."""
    c = table(spark, sf_dir, "conversations")
    found = pairs.all_pairs(c, _PAIR_GROUP, "turn")
    for side in ("ref", "target"):
        own = c.select(*_PAIR_GROUP, F.col("turn").alias(side), F.col("text").alias(f"{side}_text"))
        found = found.join(own, [*_PAIR_GROUP, side])
    return found


@query(
    """WITH k AS (SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY ('0x' || substr(md5(turn::VARCHAR), 1, 15))::BIGINT % 16, turn) - 1 AS place,
         count(*) OVER (PARTITION BY conv_id, role) AS n FROM conversations),
       g AS (SELECT DISTINCT conv_id, role, n, n * (n - 1) AS m FROM k WHERE n >= 2),
       d AS (SELECT *, (((2305843009213693951 % m) * i + ('0x' || substr(md5('42|' || conv_id || '|' || role), 1, 15))::BIGINT % m) % m)::BIGINT AS number
             FROM (SELECT g.*, unnest(range(0, least(m, 3))) AS i FROM g)),
       p AS (SELECT *, number // (n - 1) AS r, number % (n - 1) + CASE WHEN number % (n - 1) >= number // (n - 1) THEN 1 ELSE 0 END AS t FROM d)
       SELECT p.conv_id, p.role, a.turn AS ref, b.turn AS target FROM p
       JOIN k a ON a.conv_id = p.conv_id AND a.role = p.role AND a.place = p.r JOIN k b ON b.conv_id = p.conv_id AND b.role = p.role AND b.place = p.t"""
)
def pairs_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pairs of each speaker."""
    return pairs.capped_pairs(table(spark, sf_dir, "conversations"), _PAIR_GROUP, "turn", 3)


@query(
    """WITH g AS (SELECT least(count(*) * (count(*) - 1), 5) AS p FROM conversations GROUP BY conv_id, role HAVING count(*) >= 2)
       SELECT count(*)::BIGINT AS speakers, sum(p)::BIGINT AS total_pairs, avg(p) AS avg_pairs, min(p)::BIGINT AS min_pairs, max(p)::BIGINT AS max_pairs FROM g"""
)
def pair_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A07, A08."""
    return pairs.pair_stats(table(spark, sf_dir, "conversations"), _PAIR_GROUP, cap=5)


@query(
    """WITH s AS (SELECT conv_id || '_seg_' || turn AS audio_id, role FROM conversations),
       k AS (SELECT CASE WHEN contains(audio_id, '_seg_') THEN regexp_extract(audio_id, '^(.*)_seg_', 1) ELSE audio_id END AS recording, role FROM s)
       SELECT recording, role, count(*)::BIGINT AS n FROM k GROUP BY recording, role"""
)
def recording_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X01-X03 and the recording scope of speakers."""
    c = table(spark, sf_dir, "conversations")
    base = text.transcript_base(F.concat(F.lit("audio_"), F.col("conv_id").cast("string"), F.lit(".json")))
    s = c.select(text.segment_id(base, F.col("turn")).alias("audio_id"), "role")
    return s.groupBy(pairs.speaker_key("recording").alias("recording"), "role").agg(F.count("*").alias("n"))


# Statistics.


@query("SELECT count(*)::BIGINT AS segments, list_sort(list(DISTINCT source)) AS channels, count(DISTINCT lang)::BIGINT AS speakers, round(sum(n_chars / 150.0::DOUBLE) / 3600, 6) AS hours FROM documents")
def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A02-A05."""
    s = tables.dataset_stats(_segments(spark, sf_dir), "source", "lang", "duration")
    return s.withColumn("hours", F.round("hours", 6))


@query("SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source")
def channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A06."""
    return tables.channel_counts(table(spark, sf_dir, "documents"), "source")


@query(
    """SELECT round(sum(v), 4) AS total_sec, round(avg(v), 6) AS avg_sec, min(v) AS min_sec, max(v) AS max_sec, round(count(*) / sum(v), 6) AS segments_per_sec,
       round(sum(v * 2) / sum(v), 6) AS realtime_factor, round(656300 / (count(*) / sum(v)) / 3600, 4) AS eta_hours FROM (SELECT abs(value) + 0.5 AS v FROM events)"""
)
def rate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, A12."""
    e = table(spark, sf_dir, "events").select((F.abs("value") + 0.5).alias("v"))
    s = tables.rate_stats(e.withColumn("a", F.col("v") * 2), "v", "a")
    digits = {"total_sec": 4, "avg_sec": 6, "segments_per_sec": 6, "realtime_factor": 6}
    s = s.withColumn("eta_hours", F.round(tables.eta_hours(F.lit(656300), F.col("segments_per_sec")), 4))
    return s.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    """SELECT source, sum(strlen(text))::BIGINT AS bytes, round(count(*) * 0.35 / 1024, 6)::DOUBLE AS estimated_gb, round(sum(strlen(text)) / 1048576.0 / 2, 6)::DOUBLE AS mb_per_sec,
       ceil(count(*) / 70.0)::BIGINT AS batches FROM documents GROUP BY source"""
)
def size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13-A15, A17, X19."""
    n = F.count("*")
    size = F.sum(F.octet_length("text"))
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        size.alias("bytes"), F.round(tables.estimated_gb(n), 6).alias("estimated_gb"), F.round(tables.mb_per_second(size, F.lit(2)), 6).alias("mb_per_sec"), tables.batch_count(n, 70).alias("batches")
    )


# Lookups.


@query(
    """WITH p AS (SELECT regexp_extract(url, '^([a-z]+://[^/]+/)', 1) || substr(regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1), 1, 2) AS prefix, url FROM pages)
       SELECT a.prefix, min(b.url) AS url FROM (SELECT DISTINCT prefix FROM p WHERE length(prefix) > 2) a JOIN pages b ON starts_with(b.url, a.prefix) GROUP BY a.prefix"""
)
def prefix_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The host is the directory."""
    p = table(spark, sf_dir, "pages").select("url")
    rest = F.substring(F.regexp_extract("url", r"^[a-z]+://[^/]+/(.*)$", 1), 1, 2)
    prefixes = p.select(F.concat(F.regexp_extract("url", r"^([a-z]+://[^/]+/)", 1), rest).alias("prefix")).where(F.length("prefix") > 2)
    return tables.first_with_prefix(prefixes, p, "prefix", "url")


@query("SELECT c.c_custkey, c.c_nationkey::VARCHAR AS channel, coalesce(n.n_name, c.c_nationkey::VARCHAR) AS folder FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON c.c_nationkey = n.n_nationkey")
def channel_map_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of some regions only, the key where there is none."""
    names = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("channel"), F.col("n_name").alias("folder"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("channel"))
    return tables.lookup_with_default(c, names, "channel", "folder")


# Strings.

_ATTRIBUTES = "CASE WHEN lang = 'en' THEN 'MSA' ELSE 'unknown' END"


@query(
    f"""WITH a AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'male' WHEN doc_id % 3 = 1 THEN 'female' ELSE 'unknown' END AS g, {_ATTRIBUTES} AS d, CASE WHEN doc_id % 2 = 0 THEN 'formal' ELSE 'unknown' END AS t,
         trim(regexp_replace(text, '\\s+', ' ', 'g')) AS p FROM documents)
       SELECT doc_id, '<|' || g || '|><|' || d || '|><|' || t || '|> ' || p AS v1, '[' || g || '|' || d || '|' || t || '] ' || p AS v2,
         '<|TEXT_PROMPT_START|>' || p || '<|TEXT_PROMPT_END|><|SPEECH_GENERATION_START|><|speech_1|><|SPEECH_GENERATION_END|>' AS chat,
         'user: Convert the text to speech:<|TEXT_PROMPT_START|>' || p || ' ' || g || '<|TEXT_PROMPT_END|>' || chr(10) || 'assistant:<|SPEECH_GENERATION_START|><|speech_1|>' AS prompt FROM a"""
)
def vocab_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X04, X09-X13."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    raw = (
        F.when(i % 3 == 0, "male").when(i % 3 == 1, "female").otherwise("robot"),
        F.when(F.col("lang") == "en", "MSA").otherwise(F.col("lang")),
        F.when(i % 2 == 0, "formal").otherwise("angry"),
    )
    p = text.collapse_spaces(F.col("text"))
    code = F.lit("<|speech_1|>")
    return d.select(
        "doc_id", vocab.condition_v1(*raw, p).alias("v1"), vocab.condition_v2(*raw, p).alias("v2"), vocab.chat_v1(p, code).alias("chat"),
        vocab.prompt_v1(p, vocab.validated(raw[0], vocab.GENDERS), code).alias("prompt"),
    )


@query("SELECT unnest(['<|male|>', '<|female|>', '<|unknown|>', '<|MSA|>', '<|Egyptian|>', '<|Levantine|>', '<|Gulf|>', '<|Iraqi|>', '<|Maghrebi|>', '<|Yemeni|>', '<|Sudanese|>', '<|neutral|>', '<|formal|>', '<|conversational|>', '<|enthusiastic|>', '<|analytical|>', '<|empathetic|>', '<|serious|>', '<|humorous|>']) AS token")
def special_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nineteen different tokens."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, vocab.special_tokens()))).alias("token"))


@query(
    """SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name, lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '(\\.[^.]+)$', 1)) AS extension,
       CASE WHEN starts_with(url, 'https://') THEN 's3a://out/' || substr(url, 9) ELSE url END AS moved FROM pages"""
)
def path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X16, S19, F10."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", text.file_name(u).alias("name"), text.file_extension(u).alias("extension"), text.relocate(u, "https://", "s3a://out/").alias("moved"))


@query(f"SELECT vec_id, list_aggregate(list_transform(codes, lambda c: '<|speech_' || c || '|>'), 'string_agg', '') AS tokens FROM {_CODES}")
def codes_to_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X08."""
    return _codes(spark, sf_dir).select("vec_id", tokens.codes_to_text(F.col("codes")).alias("tokens"))


@query(f"SELECT vec_id, codes FROM {_CODES}")
def tokens_to_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads back what X08 wrote, between other text."""
    t = F.concat(F.lit("a 12 "), tokens.codes_to_text(F.col("codes")), F.lit("<|speech_|>"))
    return _codes(spark, sf_dir).select("vec_id", tokens.text_to_codes(t).alias("codes"))


# Token layout.

_LAYERS = f"(SELECT vec_id, codes[1:9] AS a, codes[10:27] AS b, codes[28:63] AS c FROM {_CODES})"
_INTERLEAVED = f"""(SELECT vec_id, flatten(list_transform(range(0, 9), lambda i: [a[i + 1] + 128266, b[2 * i + 1] + 132362, c[4 * i + 1] + 136458, c[4 * i + 2] + 140554,
   b[2 * i + 2] + 144650, c[4 * i + 3] + 148746, c[4 * i + 4] + 152842])) AS tokens FROM {_LAYERS})"""


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("codes")
    return _codes(spark, sf_dir).select("vec_id", F.slice(c, 1, 9).alias("a"), F.slice(c, 10, 18).alias("b"), F.slice(c, 28, 36).alias("c"))


@query(f"SELECT vec_id, tokens FROM {_INTERLEAVED}")
def snac_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y01."""
    return _layers(spark, sf_dir).select("vec_id", tokens.interleave(F.col("a"), F.col("b"), F.col("c")).alias("tokens"))


@query(f"SELECT vec_id, a, b, c FROM {_LAYERS}")
def snac_deinterleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y02, of what Y01 made."""
    a, b, c = tokens.deinterleave(F.col("tokens"))
    return snac_interleave(spark, sf_dir).select("vec_id", a.alias("a"), b.alias("b"), c.alias("c"))


_DEDUPED = f"""(SELECT vec_id, flatten(list_transform(list_filter(range(0, 9), lambda i: i = 0 OR codes[i * 7 + 1] <> codes[(i - 1) * 7 + 1]), lambda i: codes[i * 7 + 1 : i * 7 + 7])) AS codes FROM {_CODES})"""


@query(f"SELECT vec_id, codes FROM {_DEDUPED}")
def frame_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W02, F17."""
    return _codes(spark, sf_dir).select("vec_id", tokens.frame_dedup(F.col("codes")).alias("codes"))


_SEQUENCE = f"""(SELECT vec_id, codes, [128259, 128000] || [vec_id, 7] || [128009, 128260, 128261, 128257] || codes || codes || [128258, 128262] AS ids FROM {_DEDUPED})"""


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(F.col("vec_id"), F.lit(7).cast("long"))
    return frame_dedup(spark, sf_dir).select("vec_id", "codes", words.alias("words"), tokens.assemble(words, F.col("codes"), F.col("codes")).alias("ids"))


@query(f"SELECT vec_id, ids, len(ids) < 100 AS valid FROM {_SEQUENCE}")
def sequence_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y03, F14, F16."""
    return _sequences(spark, sf_dir).select("vec_id", "ids", tokens.fits(F.col("ids"), 100).alias("valid"))


@query(
    f"""SELECT vec_id, list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN i <= 8 + len(codes) THEN -100 ELSE ids[i] END) AS labels_v2,
        list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN i <= list_position(ids, 128257) + len(codes) THEN -100 ELSE ids[i] END) AS labels_v1 FROM {_SEQUENCE}"""
)
def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y04, Y05."""
    ids, codes = F.col("ids"), F.col("codes")
    return _sequences(spark, sf_dir).select(
        "vec_id", tokens.label_mask_v2(ids, F.col("words"), codes).alias("labels_v2"), tokens.label_mask_v1(ids, tokens.START_OF_SPEECH, F.size(codes)).alias("labels_v1")
    )


@query(f"SELECT vec_id, codes || [vec_id % 5][1 : (vec_id % 2)::INT] AS raw, codes AS cut FROM {_DEDUPED}")
def cut_at_eos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generated tail with part of a frame before its end."""
    codes = F.col("codes")
    raw = F.concat(codes, F.slice(F.array(F.col("vec_id") % 5), F.lit(1), (F.col("vec_id") % 2).cast("int")))
    end = F.array(F.lit(tokens.END_OF_SPEECH), F.lit(tokens.END_OF_AI), F.lit(3)).cast("array<long>")
    prompt = F.array(F.lit(1), F.lit(2)).cast("array<long>")
    return frame_dedup(spark, sf_dir).select("vec_id", raw.alias("raw"), tokens.cut_generated(F.concat(prompt, raw, end), F.lit(2)).alias("cut"))


@query(f"SELECT vec_id, codes[1:3] || [7, 8, 9] || codes[5:] AS spliced FROM (SELECT vec_id, codes[1:3] || [-5] || codes[5:] AS codes FROM {_CODES})")
def template_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X14."""
    c = F.col("codes")
    ids = F.concat(F.slice(c, 1, 3), F.array(F.lit(-5).cast("long")), F.slice(c, 5, 100))
    return _codes(spark, sf_dir).select("vec_id", tokens.splice(ids, -5, F.array(F.lit(7), F.lit(8), F.lit(9)).cast("array<long>")).alias("spliced"))


@query(f"SELECT vec_id, codes || list_transform(range(0, (8 - len(codes) % 8) % 8), lambda i: -100) AS padded FROM {_DEDUPED}")
def pad_collate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y07."""
    return frame_dedup(spark, sf_dir).select("vec_id", tokens.pad_to_multiple(F.col("codes"), 8, tokens.IGNORE).alias("padded"))


# Waveforms.


@query(
    """WITH s AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, embedding FROM embeddings),
       x AS (SELECT label, i * 20 + j - 1 AS pos, embedding[j]::DOUBLE AS v, 1 - j / 65.0::DOUBLE AS w FROM (SELECT *, unnest(range(1, 65)) AS j FROM s))
       SELECT label, pos::BIGINT AS pos, round(sum(v * w) / sum(w), 6) AS sample FROM x GROUP BY label, pos"""
)
def overlap_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings of a label are the frames of a waveform."""
    e = table(spark, sf_dir, "embeddings")
    number = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    whole = audio.overlap_add(e.select("label", number.alias("i"), "embedding"), ["label"], "i", "embedding", 20)
    return whole.select("label", F.posexplode("audio").alias("pos", "sample")).select("label", _long(F.col("pos")).alias("pos"), audio.rounded(F.col("sample"), 6).alias("sample"))


@query("SELECT vec_id, list_transform(range(1, 33), lambda i: round((embedding[i]::DOUBLE + embedding[i + 32]::DOUBLE) / 2, 6)) AS mono, 64 / 16000.0::DOUBLE AS duration FROM embeddings")
def stereo_to_mono(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X20, X22, X23."""
    e = F.col("embedding").cast("array<double>")
    mixed = audio.mono(F.slice(e, 1, 32), F.slice(e, 33, 32))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform(mixed, lambda x: audio.rounded(x, 6)).alias("mono"), audio.duration_sec(F.col("embedding"), 16000).alias("duration"))


@query(
    """WITH d AS (SELECT doc_id, n_chars AS n, doc_id % 40 AS r, unnest(range(0, n_chars // 25 + 1)) AS k FROM documents),
       f AS (SELECT doc_id, k, r + k * 25 AS done FROM d WHERE n - r - k * 25 >= 30)
       SELECT doc_id, k::BIGINT AS k, greatest(done - 51, 0)::BIGINT AS start, (done + 30)::BIGINT AS stop, ((done - greatest(done - 51, 0)) * 480)::BIGINT AS first,
         ((done - greatest(done - 51, 0)) * 480 + 12960)::BIGINT AS last FROM f"""
)
def stream_chunk_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as characters."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.inline(chunk_bounds(F.col("n_chars"), F.col("doc_id") % 40)))


# Training rows and streamed decoding, with plug-ins that SQL can follow.


def _spelled(text_: str) -> list[int]:
    """Stand-in for a tokenizer: an id for each character."""
    return [ord(c) for c in text_]


def _levels(audio_) -> tuple[list[int], list[int], list[int]]:
    """Stand-in for a layered codec: seven samples to a frame, a level for each."""
    n = len(audio_) // 7
    levels = [int((float(x) + 1) * 3 // 1) for x in audio_]
    return levels[:n], levels[n : 3 * n], levels[3 * n : 7 * n]


def _pairs_to_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as pairs: the first four frames are the reference's, the others the target's."""
    v, w = F.col("vec_id"), F.col("label")
    e = table(spark, sf_dir, "embeddings").join(_codes(spark, sf_dir), "vec_id")
    sides = {"ref": (v, 1, 28), "target": (w, 29, 35)}
    return e.select(
        "vec_id",
        F.when(v % 11 == 0, "").otherwise(F.concat(F.lit("Take  "), v.cast("string"))).alias("ref_text"),
        F.concat(F.lit("Say "), w.cast("string")).alias("target_text"),
        *[F.when(x % 3 == 0, "male").when(x % 3 == 1, "female").otherwise("robot").alias(f"{s}_gender") for s, (x, _, _) in sides.items()],
        *[F.when(x % 2 == 0, "MSA").otherwise("Nowhere").alias(f"{s}_dialect") for s, (x, _, _) in sides.items()],
        *[F.when(x % 2 == 0, "formal").otherwise("angry").alias(f"{s}_tone") for s, (x, _, _) in sides.items()],
        *[F.slice("codes", a, n).alias(f"{s}_codes") for s, (_, a, n) in sides.items()],
        *[F.struct(F.slice("embedding", a, n).alias("array")).alias(f"{s}_audio") for s, (_, a, n) in sides.items()],
    )


def _condition_sql(x: str, phones: str, left: str, between: str, right: str) -> str:
    return f"""'{left}' || CASE WHEN {x} % 3 = 0 THEN 'male' WHEN {x} % 3 = 1 THEN 'female' ELSE 'unknown' END || '{between}' || CASE WHEN {x} % 2 = 0 THEN 'MSA' ELSE 'unknown' END
         || '{between}' || CASE WHEN {x} % 2 = 0 THEN 'formal' ELSE 'unknown' END || '{right}' || {phones}"""


_SPOKEN = f"""(SELECT e.vec_id, label, codes, embedding, CASE WHEN e.vec_id % 11 = 0 THEN '' ELSE 'take ' || e.vec_id END AS rp, 'say ' || label AS tp
  FROM embeddings e JOIN {_CODES} c ON e.vec_id = c.vec_id)"""
_SPEECH = "list_aggregate(list_transform(codes[{}:{}], lambda c: '<|speech_' || c || '|>'), 'string_agg', '')"


@query(
    f"""WITH a AS (SELECT vec_id, rp, {_SPEECH.format(1, 28)} AS r, {_SPEECH.format(29, 63)} AS t,
         {_condition_sql('vec_id', 'rp', '<|', '|><|', '|> ')} || ' ' || {_condition_sql('label', 'tp', '<|', '|><|', '|> ')} AS said FROM {_SPOKEN}),
       i AS (SELECT vec_id, rp, length(r) AS n, list_transform(string_split('<|TEXT_PROMPT_START|>' || said || '<|TEXT_PROMPT_END|><|SPEECH_GENERATION_START|>' || r || t
         || '<|SPEECH_GENERATION_END|>', ''), lambda c: unicode(c)::BIGINT) AS ids FROM a),
       v AS (SELECT *, rp <> '' AND len(ids) < 960 AS valid FROM i)
       SELECT vec_id, CASE WHEN valid THEN ids ELSE [] END AS input_ids,
         CASE WHEN valid THEN list_transform(range(1, len(ids) + 1), lambda k: CASE WHEN k <= list_position(ids, 71) + n THEN -100 ELSE ids[k] END) ELSE [] END AS labels, valid FROM v"""
)
def training_rows_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chat layout; the marker is the first capital G, of the speech's start."""
    return rows_v1(_pairs_to_train(spark, sf_dir), lambda: str.lower, lambda: _spelled, ord("G"), 960, ["vec_id"])


def _frames_sql(array: str, n: int) -> str:
    """Seven-token frames of a level list whose layers lie one after another, without repeats."""
    woven = f"""list_transform(range(0, {n}), lambda i: [{array}[i + 1] + 128266, {array}[{n} + 2 * i + 1] + 132362, {array}[{3 * n} + 4 * i + 1] + 136458,
      {array}[{3 * n} + 4 * i + 2] + 140554, {array}[{n} + 2 * i + 2] + 144650, {array}[{3 * n} + 4 * i + 3] + 148746, {array}[{3 * n} + 4 * i + 4] + 152842])"""
    return f"flatten(list_transform(list_filter(range(0, {n}), lambda i: i = 0 OR {array}[i + 1] <> {array}[i]), lambda i: ({woven})[i + 1]))"


@query(
    f"""WITH a AS (SELECT vec_id, rp, codes[1:28] AS f, codes[29:63] AS g,
         {_condition_sql('vec_id', 'rp', '[', '|', '] ')} || ' | ' || {_condition_sql('label', 'tp', '[', '|', '] ')} AS said FROM {_SPOKEN}),
       b AS (SELECT vec_id, rp, list_transform(string_split(said, ''), lambda c: unicode(c)::BIGINT) AS words, {_frames_sql('f', 4)} AS r, {_frames_sql('g', 5)} AS t FROM a),
       i AS (SELECT *, [128259, 128000] || words || [128009, 128260, 128261, 128257] || r || t || [128258, 128262] AS ids FROM b),
       v AS (SELECT *, rp <> '' AND len(ids) < 110 AS valid FROM i)
       SELECT vec_id, CASE WHEN valid THEN ids ELSE [] END AS input_ids,
         CASE WHEN valid THEN list_transform(range(1, len(ids) + 1), lambda k: CASE WHEN k <= len(words) + 6 + len(r) THEN -100 ELSE ids[k] END) ELSE [] END AS labels, valid FROM v"""
)
def training_rows_framed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The framed layout, codes from the audio."""
    return rows_v2(_pairs_to_train(spark, sf_dir), lambda: str.lower, lambda: _spelled, lambda: _levels, 110, ["vec_id"])


@query(
    """WITH e AS (SELECT user_id, event_id % 100 AS token, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
       g AS (SELECT *, ((n - 7) // 5 + 1) * 5 AS done FROM e WHERE n >= 7)
       SELECT user_id::VARCHAR AS request, (CASE WHEN user_id % 2 = 0 THEN n + 1 ELSE done END * 4)::BIGINT AS n_samples,
         CASE WHEN user_id % 2 = 1 THEN round(sum(CASE WHEN i < done THEN (token / 512.0::DOUBLE - 1) * 4 ELSE 0 END), 6) END AS total
       FROM g GROUP BY user_id, n, done"""
)
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events as tokens of a request; those of even users end, the rest wait for more.

    The last chunk of a request begins one overlap earlier, so one token sounds twice, blended."""
    sizes, base = Chunking(hop=4, chunk=5, forward=2, back=10, overlap=1), work_folder(spark)
    e, own = table(spark, sf_dir, "events"), Window.partitionBy("user_id")
    last = (F.col("user_id") % 2 == 0) & (F.col("event_id") == F.max("event_id").over(own))
    e = e.withColumns({"last": last, "n": F.count("*").over(own)}).where("n >= 7")
    e.select(F.col("user_id").cast("string").alias("request"), F.col("event_id").alias("seq"), (F.col("event_id") % 100).alias("token"), "last").write.parquet(f"{base}/in")
    arriving = spark.readStream.schema("request string, seq long, token long, last boolean").parquet(f"{base}/in")
    sound = decode_stream(arriving, lambda: stub_decoder(sizes.hop), sizes)
    sound.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    given = spark.read.schema("request string, samples array<double>").parquet(f"{base}/out")
    added = F.aggregate("samples", F.lit(0.0), lambda a, x: a + x)
    return given.groupBy("request").agg(F.sum(F.size("samples")).alias("n_samples"), F.when(F.col("request").cast("long") % 2 == 1, F.round(F.sum(added), 6)).alias("total"))


# Order, limits and unions.


@query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang, NULL FROM documents WHERE lang = 'de'")
def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U01, S20."""
    d = table(spark, sf_dir, "documents")
    return tables.union_all([d.where("lang = 'en'").select("doc_id", "lang", "source"), d.where("lang = 'de'").select("doc_id", "lang")])


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row, floor((row_number() OVER (ORDER BY doc_id) - 1) / 70)::BIGINT AS chunk FROM documents")
def row_range_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W06, L06."""
    return tables.chunked(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 70).select("doc_id", "row", "chunk")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 10")
def topn_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report."""
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(10)
