"""Chunked decoding of a token stream: T01-T05, W07.

A chunk is decoded once enough tokens have come after it, with some tokens before and
after for context, and overlap-added to what came before.  State is the tokens that
context can still need and the samples that a later chunk still overlaps, so it is
bounded by the chunk's constants, not by the stream.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

Decoder = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Chunking:
    """Sizes in tokens (frames), and samples per token."""

    rate: int = 24_000
    hop: int = 480
    chunk: int = 25
    forward: int = 5
    back: int = 50
    overlap: int = 1

    @property
    def stride(self) -> int:
        return self.chunk * self.hop


def chunk_bounds(tokens: Column, reference: Column, sizes: Chunking | None = None) -> Column:
    """What each chunk that a stream of so many tokens (with the reference's
    before them) has fired decodes: its number, the tokens ``start`` to ``stop``, and the
    samples ``first`` to ``last`` of their sound that it keeps."""
    s = sizes or Chunking()
    fired = F.floor((tokens - reference - s.chunk - s.forward) / s.chunk).cast("int") + 1

    def bounds(k: Column) -> Column:
        done = (reference + k * s.chunk).cast("long")
        start = F.greatest(done - s.back - s.overlap, F.lit(0).cast("long"))
        # A chunk fires with the last token it waits for, so the overlap after it is not there yet.
        stop = done + s.chunk + s.forward
        first = (done - start) * s.hop
        return F.struct(k.cast("long").alias("k"), start.alias("start"), stop.alias("stop"), first.alias("first"), (first + (s.chunk + 2 * s.overlap) * s.hop).alias("last"))

    return F.when(fired > 0, F.transform(F.sequence(F.lit(0), fired - 1), bounds)).otherwise(F.array().cast("array<struct<k:bigint,start:bigint,stop:bigint,first:bigint,last:bigint>>"))


def ramp(n: int) -> np.ndarray:
    """The falling weights of n samples."""
    return 1 - np.arange(1, n + 1) / (n + 1)


@dataclass
class ChunkDecoder:
    """One request's decoding.  ``push`` and ``finish`` give samples in order."""

    decode: Decoder
    sizes: Chunking = field(default_factory=Chunking)
    tokens: list[int] = field(default_factory=list)  # from number ``base`` on
    base: int = 0
    done: int = 0  # tokens decoded
    tail: list[float] = field(default_factory=list)  # weighted sums past what was given
    weight: list[float] = field(default_factory=list)

    @staticmethod
    def after(reference: list[int], decode: Decoder, sizes: Chunking | None = None) -> ChunkDecoder:
        """Starts behind a reference's tokens, which are context only."""
        return ChunkDecoder(decode, sizes or Chunking(), list(reference), 0, len(reference))

    def _add(self, samples: np.ndarray) -> None:
        w, n = ramp(len(samples)), len(samples)
        grown = max(n, len(self.tail))
        total, weight = np.zeros(grown), np.zeros(grown)
        total[: len(self.tail)] = self.tail
        weight[: len(self.weight)] = self.weight
        total[:n] += w * samples
        weight[:n] += w
        self.tail, self.weight = total.tolist(), weight.tolist()

    def _give(self, n: int) -> np.ndarray:
        out = np.array(self.tail[:n]) / np.array(self.weight[:n])
        self.tail, self.weight = self.tail[n:], self.weight[n:]
        return out

    def push(self, new: list[int]) -> np.ndarray:
        """Samples that are final after these tokens."""
        s, out = self.sizes, []
        for token in new:
            self.tokens.append(token)
            end = self.base + len(self.tokens)
            if end - self.done < s.chunk + s.forward:
                continue
            start = max(self.done - s.back - s.overlap, 0)
            stop = self.done + s.chunk + s.forward + s.overlap
            sound = self.decode(np.array(self.tokens[start - self.base : stop - self.base]))
            first = (self.done - start) * s.hop
            self._add(sound[first : first + (s.chunk + 2 * s.overlap) * s.hop])
            out.append(self._give(min(s.stride, len(self.tail))))
            self.done += s.chunk
            drop = max(self.done - s.back - s.overlap, 0) - self.base
            if drop > 0:
                self.tokens, self.base = self.tokens[drop:], self.base + drop
        return np.concatenate(out) if out else np.zeros(0)

    def finish(self) -> np.ndarray:
        """The rest, decoded as one chunk that begins one overlap earlier."""
        s = self.sizes
        end = self.base + len(self.tokens)
        left = end - self.done
        if left <= 0:
            return self._give(len(self.tail)) if self.tail else np.zeros(0)
        start = max(end - (s.back + s.overlap + left), 0, self.base)
        first = (end - start - left - s.overlap) * s.hop
        sound = self.decode(np.array(self.tokens[start - self.base :]))
        self._add(sound[first:] if first >= 0 else sound[len(sound) + first :] if len(sound) + first > 0 else sound)
        self.done = end
        return self._give(len(self.tail))

    def dump(self) -> str:
        return json.dumps([self.tokens, self.base, self.done, self.tail, self.weight])

    def load(self, text: str) -> None:
        self.tokens, self.base, self.done, self.tail, self.weight = json.loads(text)


def decode_stream(stream: DataFrame, decoder: Callable[[], Decoder], sizes: Chunking | None = None) -> DataFrame:
    """(request, samples) of a stream of (request, seq, token, last).

    Tokens of a request are put in order of ``seq`` within a batch; ``last`` ends it."""
    sizes = sizes or Chunking()

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        one = ChunkDecoder(decoder(), sizes)
        if state.exists:
            one.load(state.get[0])
        rows = pd.concat(list(batches)).sort_values("seq")
        out = [one.push(rows["token"].dropna().astype(int).tolist())]
        if rows["last"].any():
            out.append(one.finish())
            state.remove()
        else:
            state.update((one.dump(),))
        samples = np.concatenate(out)
        if len(samples):
            yield pd.DataFrame({"request": [key[0]], "samples": [samples.tolist()]})

    return stream.groupBy("request").applyInPandasWithState(run, "request string, samples array<double>", "state string", "append", GroupStateTimeout.NoTimeout)
