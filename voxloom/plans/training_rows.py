"""Pairs to training rows, for both sequence layouts: Y13, Y14, P04, P05, F13-F16.

Models are called for as few values as can be (phonemes, token ids, codec layers); all
layout, masks and validity are expressions.  Invalid rows have empty arrays, and
:func:`valid_rows` takes them and the column away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tokens, vocab
from ..functions.text import collapse_spaces
from ..operators.models import Factory, phonemizer, plugged, tokenizer


def _phones(pairs: DataFrame, phonemize: Factory) -> DataFrame:
    p = phonemizer(phonemize)
    return pairs.withColumns({f"__{s}": collapse_spaces(p(F.col(f"{s}_text"))) for s in ("ref", "target")})


def _conditioned(side: str, form) -> Column:
    return form(F.col(f"{side}_gender"), F.col(f"{side}_dialect"), F.col(f"{side}_tone"), F.col(f"__{side}"))


def _spoken() -> Column:
    """both phoneme texts are there."""
    return F.coalesce((F.length("__ref") > 0) & (F.length("__target") > 0), F.lit(False))


def _rows(valid: Column, ids: Column, labels: Column, keep: list[str]) -> list:
    empty = F.array().cast("array<bigint>")
    ok = F.coalesce(valid, F.lit(False))
    return [*keep, F.when(ok, ids).otherwise(empty).alias("input_ids"), F.when(ok, labels).otherwise(empty).alias("labels"), ok.alias("valid")]


def rows_v1(pairs: DataFrame, phonemize: Factory, tokenize: Factory, marker: int, max_length: int, keep: list[str] | None = None) -> DataFrame:
    """Chat layout: text prompt, then speech tokens of reference and target; labels are the target's.

    ``marker`` is the id of the start of speech; a row without it, or of ``max_length`` ids
    or more, is invalid."""
    t = tokenizer(tokenize)
    told = _phones(pairs, phonemize).withColumn("__codes", tokens.codes_to_text(F.col("ref_codes")))
    text = F.concat(_conditioned("ref", vocab.condition_v1), F.lit(" "), _conditioned("target", vocab.condition_v1))
    chat = vocab.chat_v1(text, F.concat("__codes", tokens.codes_to_text(F.col("target_codes"))))
    coded = told.withColumns({"__ids": t(chat), "__ref_ids": t(F.col("__codes"))})
    ids = F.col("__ids")
    valid = _spoken() & tokens.fits(ids, max_length) & (F.array_position(ids, F.lit(marker).cast("long")) > 0)
    return coded.select(*_rows(valid, ids, tokens.label_mask_v1(ids, marker, F.size("__ref_ids")), keep or []))


def rows_v2(pairs: DataFrame, phonemize: Factory, tokenize: Factory, encode_layers: Factory, max_length: int, keep: list[str] | None = None) -> DataFrame:
    """Framed layout: codes come from the audio, in frames of seven without repeats."""
    t = tokenizer(tokenize)
    def packed() -> object:
        import json

        model = encode_layers()
        return lambda audio: json.dumps({k: [int(x) for x in part] for k, part in zip("abc", model(_floats(audio)), strict=True)})

    encode = plugged(packed, T.StringType())
    form = "a array<bigint>, b array<bigint>, c array<bigint>"
    told = _phones(pairs, phonemize)
    coded = told.withColumns({f"__{s}_layers": F.from_json(encode(F.col(f"{s}_audio.array")), form) for s in ("ref", "target")})
    framed = coded.withColumns({f"__{s}_codes": tokens.frame_dedup(tokens.interleave(*[F.col(f"__{s}_layers.{k}") for k in "abc"])) for s in ("ref", "target")})
    text = F.concat(_conditioned("ref", vocab.condition_v2), F.lit(" | "), _conditioned("target", vocab.condition_v2))
    whole = framed.withColumn("__words", t(text))
    ids = tokens.assemble(F.col("__words"), F.col("__ref_codes"), F.col("__target_codes"))
    valid = _spoken() & (F.size("__ref_codes") > 0) & (F.size("__target_codes") > 0) & tokens.fits(ids, max_length)
    return whole.select(*_rows(valid, ids, tokens.label_mask_v2(ids, F.col("__words"), F.col("__ref_codes")), keep or []))


def _floats(audio):
    import numpy as np

    return np.asarray(audio, np.float32)


def valid_rows(rows: DataFrame) -> DataFrame:
    """F13, P05."""
    return rows.where("valid").drop("valid")
