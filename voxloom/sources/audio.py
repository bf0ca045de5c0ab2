"""Audio files to 16 kHz mono waveforms, and back: S08, S09, S23, J05."""

from __future__ import annotations

import io
import subprocess
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Names that hold one of these go through a transcoder first.
TRANSCODED = (".webm", ".part", ".m4a")
#: Seconds after which a transcoder is stopped and its file left out.
TRANSCODE_LIMIT = 600

Decoder = Callable[[bytes, int], np.ndarray]


def decode_wav(content: bytes, rate: int = 16000) -> np.ndarray:
    """PCM of 8, 16 or 32 bits: channels averaged, resampled linearly to ``rate``."""
    with wave.open(io.BytesIO(content)) as w:
        width, channels, own = w.getsampwidth(), w.getnchannels(), w.getframerate()
        data = w.readframes(w.getnframes())
    kinds = {1: (np.uint8, 128.0, 128.0), 2: ("<i2", 0.0, 32768.0), 4: ("<i4", 0.0, 2147483648.0)}
    kind, zero, scale = kinds[width]
    samples = ((np.frombuffer(data, kind).astype(np.float64) - zero) / scale).reshape(-1, channels).mean(1)
    if own != rate and len(samples):
        n = round(len(samples) * rate / own)
        samples = np.interp(np.arange(n) * own / rate, np.arange(len(samples)), samples)
    return samples.astype(np.float32)


def encode_wav(samples: np.ndarray, rate: int = 24000) -> bytes:
    """16-bit mono."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(np.asarray(samples, np.float64), -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def transcode(content: bytes, program: tuple[str, ...] = ("ffmpeg", "-i", "pipe:0", "-ar", "16000", "-ac", "1", "-f", "wav", "pipe:1")) -> bytes:
    """Through an external program on standard input and output."""
    done = subprocess.run(program, input=content, capture_output=True, timeout=TRANSCODE_LIMIT, check=True)
    return done.stdout


def scan_audio(spark: SparkSession, path: str, rate: int = 16000, decode: Decoder = decode_wav, wanted: DataFrame | None = None) -> DataFrame:
    """(path, audio, error) of all files below a path, or of the ``wanted`` paths of them, each decoded once."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    if wanted is not None:
        found = found.join(wanted.select("path").distinct(), "path", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audio, errors = [], []
            for name, content in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                try:
                    if any(x in name.lower() for x in TRANSCODED):
                        content = transcode(content)
                    audio.append(decode(content, rate))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a broken file is skipped, with its reason
                    audio.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:300])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(audio, pa.list_(pa.float32())), pa.array(errors, pa.string())], names=["path", "audio", "error"])

    return found.select("path", "content").mapInArrow(run, "path string, audio array<float>, error string")
