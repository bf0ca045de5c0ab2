"""Opaque models as plug-ins: codecs, phonemizers, tokenizers.

Real weights are not part of this engine.  A plug-in is a factory that a worker calls
once per task; what it gives is applied batch by batch.  The stubs below are simple
deterministic stand-ins for tests: they are not codecs or phonemizers.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A factory of functions from one value to one value.
Factory = Callable[[], Callable]


def plugged(factory: Factory, kind: T.DataType) -> Callable[..., Column]:
    """A column function of a model that is loaded once per task; null stays null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for values in batches:
            yield pd.Series([None if v is None else model(v) for v in values], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, kind)


def phonemizer(factory: Factory) -> Callable[..., Column]:
    """Text to phonemes."""
    return plugged(factory, T.StringType())


def tokenizer(factory: Factory) -> Callable[..., Column]:
    """Text to ids."""
    return plugged(factory, T.ArrayType(T.LongType()))


def codec_encoder(factory: Factory) -> Callable[..., Column]:
    """Waveform to codes."""
    return plugged(lambda: (lambda audio, model=factory(): [int(c) for c in model(np.asarray(audio, np.float32))]), T.ArrayType(T.IntegerType()))


def codec_decoder(factory: Factory) -> Callable[..., Column]:
    """Codes to waveform."""
    return plugged(lambda: (lambda codes, model=factory(): [float(x) for x in model(np.asarray(codes))]), T.ArrayType(T.FloatType()))


def stub_phonemizer() -> Callable[[str], str]:
    """Lower-cased letters and end marks; text without letters gives the empty text."""
    return lambda text: " ".join(re.findall(r"[^\W\d_]+|[.,?!]", text.lower()))


def stub_tokenizer(vocabulary: int = 100_000) -> Callable[[str], list[int]]:
    """An id of each special token, word or mark, by its checksum."""
    return lambda text: [zlib.crc32(p.encode()) % vocabulary for p in re.findall(r"<\|[^|]*\|>|\w+|[^\w\s]", text)]


def stub_token_id(token: str, vocabulary: int = 100_000) -> int:
    return zlib.crc32(token.encode()) % vocabulary


def stub_encoder(hop: int = 320) -> Callable[[np.ndarray], np.ndarray]:
    """The level of each ``hop`` samples, of 1024."""

    def encode(audio: np.ndarray) -> np.ndarray:
        whole = len(audio) // hop * hop
        return np.clip((audio[:whole].reshape(-1, hop).mean(1) + 1) * 512, 0, 1023).astype(np.int32)

    return encode


def stub_layers(hop: int = 1280) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Three layers of n, 2n and 4n levels."""

    def encode(audio: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(audio) // hop
        level = lambda parts: np.clip((audio[: n * hop].reshape(parts * n, -1).mean(1) + 1) * 2048, 0, 4095).astype(np.int64)
        return (level(1), level(2), level(4)) if n else (np.zeros(0, np.int64),) * 3

    return encode


def stub_decoder(hop: int = 480) -> Callable[[np.ndarray], np.ndarray]:
    """Each code as ``hop`` equal samples."""
    return lambda codes: np.repeat(np.asarray(codes, np.float64) / 512 - 1, hop)
