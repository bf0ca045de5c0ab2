"""Text predicates and string functions of the segment and training tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_present(text: Column) -> Column:
    """some character is not Unicode white space; null is absent."""
    return F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def text_quality(text: Column) -> Column:
    """Speakable text.

    Not empty; no digit of any script; no dotted acronym; no two capitals in a row;
    ends in ``.``, ``,``, ``?`` or ``!`` (not the Arabic question mark); no pound or
    dollar sign.  Null fails."""
    spoken = (
        (F.length(text) > 0) & ~text.rlike(r"\p{Nd}") & ~text.rlike(r"([a-zA-Z]\.){2,}") & ~text.rlike(r"[A-Z]{2,}")
        & F.right(text, F.lit(1)).isin(".", ",", "?", "!") & ~text.contains("£") & ~text.contains("$")
    )
    return F.coalesce(spoken, F.lit(False))


def collapse_spaces(text: Column) -> Column:
    """Words of any Unicode white space joined by single spaces."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def transcript_base(file_name: Column) -> Column:
    """Every ``audio_`` and ``.json`` goes from a transcript's file name."""
    return F.replace(F.replace(file_name, F.lit("audio_"), F.lit("")), F.lit(".json"), F.lit(""))


def segment_id(base: Column, index: Column) -> Column:
    """``{base}_seg_{index}``."""
    return F.concat(base, F.lit("_seg_"), index.cast("string"))


def recording_key(audio_id: Column) -> Column:
    """What stands before the last ``_seg_``; the whole id where there is none."""
    return F.when(audio_id.contains("_seg_"), F.regexp_extract(audio_id, r"(?s)^(.*)_seg_", 1)).otherwise(audio_id)


def file_name(path: Column) -> Column:
    """The part after the last slash."""
    return F.substring_index(path, "/", -1)


def file_extension(path: Column) -> Column:
    """The extension with its dot, lower-cased; empty where there is none."""
    return F.lower(F.regexp_extract(file_name(path), r"(\.[^.]+)$", 1))


def relocate(path: Column, old: str, new: str) -> Column:
    """The prefix ``old`` replaced by ``new``, at the start only."""
    return F.when(path.startswith(old), F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))).otherwise(path)


def in_channels(path: Column, channels: list[str] | None) -> Column:
    """the key contains ``/{channel}/`` for one of the channels; all pass without any."""
    if not channels:
        return F.lit(True)
    found = F.lit(False)
    for c in channels:
        found = found | path.contains(f"/{c}/")
    return found


def channel_directory(channel: Column, channels: list[str] | None) -> Column:
    """the directory's name is one of the channels, which prunes partitions."""
    return channel.isin(channels) if channels else F.lit(True)
