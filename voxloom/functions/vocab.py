"""Speaker attributes: the allowed values, conditioning prefixes, prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
GENDERS = ("male", "female", "unknown")
DIALECTS = ("MSA", "Egyptian", "Levantine", "Gulf", "Iraqi", "Maghrebi", "Yemeni", "Sudanese", "unknown")
TONES = ("neutral", "formal", "conversational", "enthusiastic", "analytical", "empathetic", "serious", "humorous")
UNKNOWN = "unknown"


def validated(value: Column, allowed: tuple[str, ...]) -> Column:
    """The value if allowed, else ``unknown``; null is not allowed."""
    return F.when(value.isin(*allowed), value).otherwise(F.lit(UNKNOWN))


def special_tokens() -> list[str]:
    """A token for each attribute value, each once, in order of first use."""
    return list(dict.fromkeys(f"<|{v}|>" for v in (*GENDERS, *DIALECTS, *TONES)))


def _attributes(gender: Column, dialect: Column, tone: Column) -> tuple[Column, Column, Column]:
    return validated(gender, GENDERS), validated(dialect, DIALECTS), validated(tone, TONES)


def condition_v1(gender: Column, dialect: Column, tone: Column, phones: Column) -> Column:
    """``<|g|><|d|><|t|> phones``."""
    g, d, t = _attributes(gender, dialect, tone)
    return F.concat(F.lit("<|"), g, F.lit("|><|"), d, F.lit("|><|"), t, F.lit("|> "), phones)


def condition_v2(gender: Column, dialect: Column, tone: Column, phones: Column) -> Column:
    """X11: ``[g|d|t] phones``."""
    g, d, t = _attributes(gender, dialect, tone)
    return F.concat(F.lit("["), g, F.lit("|"), d, F.lit("|"), t, F.lit("] "), phones)


def chat_v1(text: Column, codes: Column) -> Column:
    """The training template around text and speech tokens."""
    return F.concat(F.lit("<|TEXT_PROMPT_START|>"), text, F.lit("<|TEXT_PROMPT_END|><|SPEECH_GENERATION_START|>"), codes, F.lit("<|SPEECH_GENERATION_END|>"))


def prompt_v1(ref_text: Column, text: Column, ref_codes: Column) -> Column:
    """The prompt that generation continues."""
    return F.concat(
        F.lit("user: Convert the text to speech:<|TEXT_PROMPT_START|>"), ref_text, F.lit(" "), text,
        F.lit("<|TEXT_PROMPT_END|>\nassistant:<|SPEECH_GENERATION_START|>"), ref_codes,
    )
