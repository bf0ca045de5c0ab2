"""Token layout as array expressions: all JVM-side, one row at a time, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids of the speech vocabulary.
START_OF_TEXT, END_OF_TEXT = 128000, 128009
START_OF_SPEECH, END_OF_SPEECH = 128257, 128258
START_OF_HUMAN, END_OF_HUMAN = 128259, 128260
START_OF_AI, END_OF_AI = 128261, 128262
PAD, AUDIO_START = 128263, 128266
SLOT_SIZE, FRAME = 4096, 7
IGNORE = -100
#: Of each slot of a frame: the layer it comes from, that layer's codes per frame, and which of them.
SLOTS = ((0, 1, 0), (1, 2, 0), (2, 4, 0), (2, 4, 1), (1, 2, 1), (2, 4, 2), (2, 4, 3))


def _indices(n: Column) -> Column:
    """0 .. n-1, empty for n of 0 or less."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def interleave(layer1: Column, layer2: Column, layer3: Column) -> Column:
    """Three layers of n, 2n and 4n codes to seven tokens a frame; slot s adds its offset."""
    layers = (layer1, layer2, layer3)

    def frame(i: Column) -> Column:
        return F.array(*[F.get(layers[layer], i * per + at).cast("long") + AUDIO_START + SLOT_SIZE * s for s, (layer, per, at) in enumerate(SLOTS)])

    return F.flatten(F.transform(_indices(F.size(layer1)), frame))


def deinterleave(tokens: Column) -> tuple[Column, Column, Column]:
    """The exact inverse; an incomplete last frame is left out."""
    frames = _indices(F.floor(F.size(tokens) / FRAME).cast("int"))

    def layer(which: int) -> Column:
        own = [(s, at) for s, (k, _, at) in enumerate(SLOTS) if k == which]
        return F.flatten(F.transform(frames, lambda i: F.array(*[F.get(tokens, i * FRAME + s).cast("long") - AUDIO_START - SLOT_SIZE * s for s, _ in own])))

    return layer(0), layer(1), layer(2)


def whole_frames(codes: Column) -> Column:
    """whether the length is a multiple of seven; null for null."""
    return F.size(codes) % FRAME == 0


def frame_dedup(codes: Column) -> Column:
    """Frame 0 stays, and each frame whose first token differs from the frame's before it.

    Dropped frames share their first token with the last kept one, so the neighbour decides.
    Null where the length is not a multiple of seven."""
    kept = F.filter(_indices((F.size(codes) / FRAME).cast("int")), lambda i: (i == 0) | (F.get(codes, i * FRAME) != F.get(codes, (i - 1) * FRAME)))
    return F.when(whole_frames(codes), F.flatten(F.transform(kept, lambda i: F.slice(codes, i * FRAME + 1, F.lit(FRAME)))))


def _ids(*values: int) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def text_sequence(text_ids: Column) -> Column:
    return F.concat(_ids(START_OF_HUMAN, START_OF_TEXT), text_ids, _ids(END_OF_TEXT, END_OF_HUMAN))


def assemble(text_ids: Column, ref_codes: Column, target_codes: Column) -> Column:
    """The whole training sequence of the second layout."""
    return F.concat(text_sequence(text_ids), _ids(START_OF_AI, START_OF_SPEECH), ref_codes, target_codes, _ids(END_OF_SPEECH, END_OF_AI))


def mask_before(ids: Column, start: Column) -> Column:
    """The ids with those before the 0-based ``start`` ignored."""
    return F.transform(ids, lambda x, i: F.when(i < start, F.lit(IGNORE).cast("long")).otherwise(x.cast("long")))


def label_mask_v2(ids: Column, text_ids: Column, ref_codes: Column) -> Column:
    """Labels begin at the target's codes and include both end tokens."""
    return mask_before(ids, F.size(text_ids) + 4 + 2 + F.size(ref_codes))


def label_mask_v1(ids: Column, marker: int, ref_length: Column) -> Column:
    """Labels begin after the marker and the reference's tokens; null without the marker."""
    at = F.array_position(ids, F.lit(marker).cast("long"))
    return F.when(at > 0, mask_before(ids, at + ref_length))


def cut_generated(ids: Column, prompt_length: Column) -> Column:
    """What follows the prompt, up to the first end of speech, then of turn, in whole frames."""
    tail = F.slice(ids, prompt_length + 1, F.greatest(F.size(ids) - prompt_length, F.lit(0)))

    def until(codes: Column, token: int) -> Column:
        at = F.array_position(codes, F.lit(token).cast("long"))
        return F.when(at > 0, F.slice(codes, F.lit(1), (at - 1).cast("int"))).otherwise(codes)

    cut = until(until(tail, END_OF_SPEECH), END_OF_AI)
    return F.slice(cut, F.lit(1), (F.floor(F.size(cut) / FRAME) * FRAME).cast("int"))


def codes_to_text(codes: Column) -> Column:
    """``<|speech_i|>`` of each code, joined."""
    return F.array_join(F.transform(codes, lambda c: F.concat(F.lit("<|speech_"), c.cast("string"), F.lit("|>"))), "")


def text_to_codes(text: Column) -> Column:
    """The codes of all speech tokens in a text, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"<\|speech_(\d+)\|>"), F.lit(1)), lambda x: x.cast("long"))


def splice(ids: Column, placeholder: int, replacement: Column) -> Column:
    """The first placeholder id replaced by a list of ids; null without one."""
    at = F.array_position(ids, F.lit(placeholder).cast("long")).cast("int")
    return F.when(at > 0, F.concat(F.slice(ids, F.lit(1), at - 1), replacement, F.slice(ids, at + 1, F.greatest(F.size(ids) - at, F.lit(0)))))


def pad_to_multiple(ids: Column, multiple: int, value: int) -> Column:
    """Filled up to the next multiple of a length."""
    missing = F.pmod(-F.size(ids), F.lit(multiple))
    return F.concat(ids, F.array_repeat(F.lit(value).cast("long"), missing))


def fits(ids: Column, max_length: int) -> Column:
    """strictly shorter than the limit."""
    return F.size(ids) < max_length
