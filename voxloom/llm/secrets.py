"""Secret scans: base patterns, and a character convolutional network beside them.

One pass over the texts finds the base spans and every candidate: a maximal run of
12 or more characters of the secret alphabet, or of 8 or more after a colon or an equals
sign.  It writes them with 32 characters of context before and 16 after to a table in the
shared folder, a small fraction of the input.  The network, its calibration and its threshold
come from all different candidates, each counted once however many copies it has: in numpy on
the driver up to ``max_each`` of a kind.  Beyond that the driver's few thousand are only where
replicas begin.  All candidates are dealt to shares of ``REPLICA`` by hash, each share teaches a
replica, and the network is the mean of the replicas; scores for calibration and threshold are
summed and ordered in tables.

Labelled findings are what the base patterns cover; all else is unlabelled, not negative.

* Each finding is shown as it is, in the context of an unlabelled candidate (so the
  pattern's own words are masked and the value has to tell), and redrawn: a random value
  of another alphabet and length, so that forms the patterns do not know are findings too.
* Unlabelled candidates weigh as negatives by the probability that they are none, as
  estimated by a network that was trained without them; an unlabelled key hardly counts.
* A fifth of the findings and negatives calibrates the scores by Platt scaling, another
  fifth sets the threshold: the highest one that still keeps ``least_recall`` of the
  findings, ``MOST_THRESHOLD`` at most.  Training uses the other three.

A second pass over the table scores every candidate that base findings do not cover whole.

No shuffle moves texts, only candidates with their context.  Where the driver does not take
all, fifths and the halves that judge each other go by the hash of the run.

Cases: null and empty texts have no spans.  Runs of any length are learned from and scored
in overlapping pieces, and the largest score counts.  Without any finding, or without any
other candidate, there is nothing to learn from and base spans alone are given.  Repeated
rows get equal spans; an empty table gives no rows.  Only the id and the text are read.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Scratch
from .worker import keep, one_thread

# The base patterns with the least length of what they must have found.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12
KINDS = ("assign", "access", "hex", "model")

CANDIDATE = re.compile(r"""[A-Za-z0-9+/_.=-]{12,}|(?:(?<=[:=])|(?<=[:=][\x20"'])|(?<=[:=]\x20["']))[A-Za-z0-9+/_.=-]{8,}""")
# Alphabets that findings are redrawn in, and names and marks before short ones.
ALPHABETS = (
    string.ascii_letters + string.digits, string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-",
    string.ascii_uppercase + string.digits, string.ascii_lowercase + string.digits, "0123456789ABCDEF", "0123456789abcdef", string.ascii_letters,
)
NAMES, MARKS = ("pwd", "pass", "auth", "key", "credential", "client", "private", "bearer", "token", "secret", "password"), ("=", ": ", " = ", ":", ' = "', ': "')
#: Redrawn findings, all together; the threshold's upper end.
REDRAWN, MOST_THRESHOLD = 2000, 0.8
#: What an unlabelled candidate that looks like a finding still weighs as a negative, so that
#: kinds of which the corpus has many are learned.
LEAST_WEIGHT = 0.25
BEFORE, BODY, AFTER, SHORT = 32, 64, 16, 19
#: Candidates of a replica, the least of findings or others that it gets if there are so many, the
#: rate that it begins with, and the runs from which on parts are split by runs.
REPLICA, LEAST_SHARED, RATE, FEW = 30_000, 1000, 1e-3, 100
#: Parts of the hashes' range that samples are drawn by.
SPREAD = 1 << 40
WIDTH = BEFORE + BODY + AFTER
#: What fills a piece: no text has it.
GAP = "\ud800"


Finding = tuple[str, str, str]  # what stands before a run, the run, what stands after it


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of each base finding, in that order.

    Runs of AKIA or hex digits are maximal, so asking for the length within the
    pattern finds just the runs that pass."""
    found = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)] + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    return sorted(found)


def candidates(text: str) -> Iterator[tuple[int, int]]:
    for m in CANDIDATE.finditer(text):
        yield m.start(), m.end()


def pieces(rows: Iterable[Finding]) -> tuple[np.ndarray, np.ndarray]:
    """Character codes of candidates in their contexts, a row for each piece of a body; and how
    many pieces each candidate has."""
    parts, sizes = [], []
    for before, body, after in rows:
        left, right = before.rjust(BEFORE, GAP), after.ljust(AFTER, GAP)
        starts = range(0, max(1, len(body) - BODY // 4), BODY * 3 // 4)
        sizes.append(len(starts))
        for at in starts:
            parts += (left, body[at : at + BODY].ljust(BODY, GAP), right)
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WIDTH)
    return np.where(codes == ord(GAP), 0, np.minimum(codes + 1, 127)).astype(np.uint8), np.array(sizes, np.int64)


def windows(before: str, body: str, after: str) -> np.ndarray:
    """Character codes of a candidate in its context: one row for each piece of its body."""
    return pieces([(before, body, after)])[0]


class CharacterNetwork:
    """Embedding, one convolution, maxima over body and context, one hidden layer."""

    KERNEL = 5

    def __init__(self, seed: int = 7, embed: int = 12, filters: int = 24, hidden: int = 16):
        rng = np.random.default_rng(seed)
        scale = lambda *s: (rng.standard_normal(s) * np.sqrt(2 / s[0])).astype(np.float32)
        self.p = {
            "embed": (rng.standard_normal((128, embed)) * 0.5).astype(np.float32), "conv": scale(self.KERNEL * embed, filters), "conv_b": np.zeros(filters, np.float32),
            "dense": scale(2 * filters, hidden), "dense_b": np.zeros(hidden, np.float32), "out": scale(hidden, 1), "out_b": np.zeros(1, np.float32),
        }

    def pooled(self, codes: np.ndarray, places: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Maxima over body and context, and where they are.

        A character's share in a filter is looked up, not multiplied anew.  Bodies of up to
        ``SHORT`` characters leave out most of their padding, which is the same everywhere."""
        p, k = self.p, self.KERNEL
        looked = p["embed"] @ p["conv"].reshape(k, -1, p["conv"].shape[1])  # place in the kernel, code, filter
        out = np.empty((len(codes), 2 * looked.shape[2]), looked.dtype)
        where = np.empty(out.shape, np.int64) if places else None
        short = ~codes[:, BEFORE + SHORT : BEFORE + BODY].any(1)
        for part, body in ((np.flatnonzero(short), SHORT + k), (np.flatnonzero(~short), BODY)):
            for at in range(0, len(part), 128):
                rows = part[at : at + 128]
                own = np.concatenate([codes[rows, : BEFORE + body], codes[rows, BEFORE + BODY :]], 1)
                n = own.shape[1] - k + 1
                conv = looked[0][own[:, :n]]
                for j in range(1, k):
                    conv += looked[j][own[:, j : j + n]]
                mid = np.arange(n) + k // 2
                inside = (mid >= BEFORE) & (mid < BEFORE + body)
                begin, end = np.flatnonzero(inside)[[0, -1]]
                if not places:
                    halves = conv[:, begin : end + 1].max(1), np.maximum(conv[:, :begin].max(1), conv[:, end + 1 :].max(1))
                    out[rows] = np.concatenate(halves, 1)
                    continue
                best = np.concatenate([np.flatnonzero(x)[conv[:, x].argmax(1)] for x in (inside, ~inside)], 1)
                filters = looked.shape[2]
                out[rows] = np.concatenate([np.take_along_axis(conv, b[:, None], 1)[:, 0] for b in (best[:, :filters], best[:, filters:])], 1)
                # A place after the padding stands further right in the whole piece.
                where[rows] = best + (BODY - body) * (best >= BEFORE + body - k)
        return out + np.concatenate([p["conv_b"]] * 2), where

    def forward(self, codes: np.ndarray, places: bool = True) -> tuple[np.ndarray, tuple]:
        p = self.p
        pooled, where = self.pooled(codes, places)
        active = np.maximum(pooled, 0)
        hidden = active @ p["dense"] + p["dense_b"]
        relu = np.maximum(hidden, 0)
        return (relu @ p["out"] + p["out_b"])[:, 0], (codes, where, pooled, active, hidden, relu)

    def gradients(self, cache: tuple, error: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss; ``error`` is each row's score minus its label."""
        p, (codes, where, pooled, active, hidden, relu) = self.p, cache
        d = (error / len(error)).astype(relu.dtype)[:, None]
        g = {"out": relu.T @ d, "out_b": d.sum(0)}
        d = d @ p["out"].T * (hidden > 0)
        g |= {"dense": active.T @ d, "dense_b": d.sum(0)}
        d = d @ p["dense"].T * (pooled > 0)
        filters, k = p["conv"].shape[1], self.KERNEL
        g["conv_b"] = d[:, :filters].sum(0) + d[:, filters:].sum(0)
        # What reaches a character's share in a filter, then the two factors of it.
        met = codes[np.arange(len(codes))[:, None, None], where[:, :, None] + np.arange(k)]
        cell = (np.arange(k) * len(p["embed"]) + met) * filters + np.tile(np.arange(filters), 2)[:, None]
        looked = np.bincount(cell.ravel(), np.repeat(d.ravel(), k), k * len(p["embed"]) * filters).reshape(k, -1, filters)
        conv = p["conv"].reshape(k, -1, filters)
        g["embed"] = (looked @ conv.transpose(0, 2, 1)).sum(0).astype(d.dtype)
        g["conv"] = (p["embed"].T @ looked).reshape(p["conv"].shape).astype(d.dtype)
        return g

    def copy(self) -> CharacterNetwork:
        other = CharacterNetwork()
        other.p = {k: v.copy() for k, v in self.p.items()}
        return other

    def fit(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 3e-3, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        t, steps = 0, epochs * -(-len(labels) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                part = order[at : at + batch]
                z, cache = self.forward(codes[part])
                grads = self.gradients(cache, weights[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]))
                t += 1
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.p[k] -= rate * (1 - (t - 1) / steps) * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)


@dataclass
class SecretModel:
    """A trained network, its calibration (slope, constant) and its threshold."""

    network: CharacterNetwork
    slope: float
    constant: float
    threshold: float

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.network.forward(codes[at : at + 256], False)[0] for at in range(0, len(codes), 256)] or [np.zeros(0)])
        return self.calibrated(z)

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.constant, -40, 40)))


def platt(scores: np.ndarray, labels: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and constant of a logistic fit with smoothed targets, by Newton's method."""
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([scores, np.ones_like(scores)], 1).astype(float)
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (q - target) + 1e-3 * (w - [1, 0]))
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def redrawn(rng: np.random.Generator, others: list[Finding]) -> Finding:
    """A random value in the context of an unlabelled candidate; a short one after a mark."""
    alphabet = ALPHABETS[int(rng.integers(len(ALPHABETS)))]
    short = rng.random() < 0.35
    length = int(rng.integers(8, 16)) if short else int(rng.integers(16, 65))
    while True:
        value = "".join(alphabet[k] for k in rng.integers(len(alphabet), size=length).tolist())
        # Values whose kinds of characters hardly change could be words or numbers.
        kinds = [c.isdigit() + 2 * c.islower() + 4 * c.isupper() for c in value]
        if 4 * sum(x != y for x, y in zip(kinds, kinds[1:], strict=False)) >= length:
            break
    before, _, after = others[int(rng.integers(len(others)))]
    if short or rng.random() < 0.2:
        before = before[-16:] + " " + NAMES[int(rng.integers(len(NAMES)))] + MARKS[int(rng.integers(len(MARKS)))]
    return before[-BEFORE:], value, after


def learned(positive: list[Finding], negative: list[Finding], weights: np.ndarray | None = None) -> CharacterNetwork:
    """A network fitted to all pieces of each row; ``weights`` are those of the negatives."""
    codes, sizes = pieces((*positive, *negative))
    labels = np.repeat([1.0, 0.0], [len(positive), len(negative)])
    weights = np.concatenate([np.ones(len(positive)), np.ones(len(negative)) if weights is None else weights])
    network = CharacterNetwork()
    network.fit(codes, np.repeat(labels, sizes), np.repeat(weights, sizes))
    return network


def scored(network: CharacterNetwork, rows: list[Finding]) -> np.ndarray:
    """The largest score of each row's pieces."""
    out = []
    for at in range(0, len(rows), 512):
        codes, sizes = pieces(rows[at : at + 512])
        out.append(np.maximum.reduceat(network.forward(codes, False)[0].astype(float), np.cumsum(sizes) - sizes))
    return np.concatenate(out) if out else np.zeros(0)


def shown(positive: list[Finding], others: list[Finding], rng: np.random.Generator) -> list[list[Finding]]:
    """Each finding as it is, in another context, and redrawn."""
    many = max(1, REDRAWN // len(positive))
    return [[x, (*others[int(rng.integers(len(others)))][:1], x[1], x[2]), *(redrawn(rng, others) for _ in range(many))] for x in positive]


def by_run(unlabelled: list[Finding]) -> list[list[Finding]]:
    """Rows of one run together, wherever it stands."""
    groups: dict[str, list[Finding]] = {}
    for x in unlabelled:
        groups.setdefault(x[1], []).append(x)
    return list(groups.values())


def varied(groups: list[list[Finding]], rng: np.random.Generator) -> list[list[Finding]]:
    """Negatives with variants: a word is one in capitals too, and an address or a number one
    with other digits."""
    seen, out = {g[0][1] for g in groups}, []
    numbers = sum(any(map(str.isdigit, g[0][1])) for g in groups)
    for k, own in enumerate(groups):
        before, run, after = own[0]
        if run.isalpha() and run.islower():
            new = [run.upper()] if k % 4 == 0 else []
        else:
            new = [re.sub("[0-9]", lambda _: str(rng.integers(10)), run) for _ in range(min(8, REDRAWN // max(1, numbers)))]
        new = [x for x in dict.fromkeys(new) if x not in seen]
        seen.update(new)
        out.append([*own, *((before, x, after) for x in new)])
    return out


def trust(positive: list[Finding], unlabelled: list[list[Finding]]) -> np.ndarray:
    """How far each unlabelled group is a negative: its probability of not being a finding, by
    a network that saw the other half of the groups and not this one."""
    out = np.zeros(len(unlabelled))
    for half in (0, 1):
        rest = [x for g in unlabelled[1 - half :: 2] or unlabelled for x in g]
        out[half::2] = 1 / (1 + np.exp(np.clip(scored(learned(positive, rest), [g[0] for g in unlabelled[half::2]]), -30, 30)))
    return out


def train(positive: list[Finding], unlabelled: list[Finding], least_recall: float = 0.95, seed: int = 5) -> SecretModel | None:
    """Fit, calibrate and set the threshold from findings and other candidates."""
    if not positive or not unlabelled:
        return None
    rng = np.random.default_rng(seed)
    groups = shown(positive, unlabelled, rng)
    if len(groups) < 5:  # few findings are split by how they are shown
        groups = [[x] for g in groups for x in g]
    unlabelled = by_run(unlabelled)
    weights = LEAST_WEIGHT + (1 - LEAST_WEIGHT) * trust([x for g in groups for x in g], unlabelled)
    negative = varied(unlabelled, rng)
    order = rng.permutation(len(groups))
    parts = [[x for k in order[p::5] for x in groups[k]] for p in range(5)]
    true = [x for k in order[1::5] for x in groups[k][:2]]  # findings' own values, with and without their context
    order = rng.permutation(len(negative))
    fit = [k for p in (2, 3, 4) for k in order[p::5]] or [*order]
    network = learned([x for p in parts[2:] for x in p], [x for k in fit for x in negative[k]], np.array([weights[k] for k in fit for _ in negative[k]]))
    model = SecretModel(network, 1.0, 0.0, 1.0)
    others = [negative[k][0] for k in order[0::5] if weights[k] > 0.6] or [negative[int(np.argmax(weights))][0]]
    model.slope, model.constant = platt(scored(network, parts[0] + others), np.repeat([1.0, 0.0], [len(parts[0]), len(others)]))
    found = np.sort(model.calibrated(scored(network, true)))
    model.threshold = min(MOST_THRESHOLD, float(found[int((1 - least_recall) * len(found))]))
    return model


# Learning from more than the driver takes: replicas of one network, each with a share of all
# candidates, and the mean of what they have become.


@dataclass
class Share:
    """Findings and other candidates that one replica learns from.

    ``first`` are findings that no share before has too; ``many`` is how often each is redrawn;
    ``few`` tells of findings and of the others whether their runs are too few to be split by."""

    number: int
    positive: list[Finding]
    first: list[bool]
    negative: list[Finding]
    many: int
    few: tuple[bool, bool]

    def __post_init__(self) -> None:
        self.rng = np.random.default_rng((5, self.number))
        others = self.negative or self.positive
        shown = [[x, (*others[int(self.rng.integers(len(others)))][:1], x[1], x[2]), *(redrawn(self.rng, others) for _ in range(self.many))] for x in self.positive]
        self.shown = [x for g in shown for x in g]
        self.part = np.array([(crc32(("".join(x) if self.few[0] else x[1]).encode()) // 2 + k * self.few[0]) % 5 for x, g in zip(self.positive, shown, strict=True) for k in range(len(g))], int)
        self.own = np.array([self.few[0] or k < 2 for g in shown for k in range(len(g))], bool)
        self.new = np.repeat(np.array(self.first, bool), [len(g) for g in shown])
        self.groups = by_run(self.negative)
        self.run = np.array([crc32(g[0][1].encode()) for g in self.groups], np.int64)

    def _fit(self, network: CharacterNetwork, positive: list[Finding], negative: list[Finding], weights: np.ndarray, epochs: int, rate: float) -> None:
        """Both classes weigh the same, however many rows they have."""
        codes, sizes = pieces((*positive, *negative))
        labels = np.repeat([1.0, 0.0], [len(positive), len(negative)])
        weights = np.concatenate([np.full(len(positive), weights.sum() / max(1, len(positive))), weights])
        weights = weights * (len(weights) / max(1e-9, weights.sum()))
        network.fit(codes, np.repeat(labels, sizes), np.repeat(weights, sizes), epochs, rate=rate, seed=11 + self.number)

    def halves(self, networks: list[CharacterNetwork], epochs: int, rate: float) -> list[CharacterNetwork]:
        """Two networks, each taught by the runs that the other judges."""
        for half, network in enumerate(networks):
            rest = [x for g, run in zip(self.groups, self.run, strict=True) if self.few[1] or run % 2 != half for x in g]
            self._fit(network, self.shown, rest, np.ones(len(rest)), epochs, rate)
        return networks

    def weights(self, halves: list[CharacterNetwork]) -> np.ndarray:
        """What each group weighs as a negative, by the network that has not seen it."""
        out = np.zeros(len(self.groups))
        for half, network in enumerate(halves):
            at = np.flatnonzero(self.run % 2 == half)
            out[at] = 1 / (1 + np.exp(np.clip(scored(network, [self.groups[k][0] for k in at]), -30, 30)))
        return LEAST_WEIGHT + (1 - LEAST_WEIGHT) * out

    def whole(self, network: CharacterNetwork, halves: list[CharacterNetwork], epochs: int, rate: float) -> list[CharacterNetwork]:
        """The network itself, without the fifths that calibrate it and set its threshold."""
        weights, negative = self.weights(halves), varied(self.groups, self.rng)
        fit = [k for k, run in enumerate(self.run) if self.few[1] or run // 2 % 5 > 1]
        self._fit(network, [x for x, p in zip(self.shown, self.part, strict=True) if p > 1], [x for k in fit for x in negative[k]], np.array([weights[k] for k in fit for _ in negative[k]]), epochs, rate)
        return [network]

    def scores(self, network: CharacterNetwork, halves: list[CharacterNetwork]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(0, scores and weights of the others, 1, of findings, 2, of those that set the threshold)."""
        weights = self.weights(halves)
        at = np.flatnonzero(np.full(len(self.run), self.few[1]) | (self.run // 2 % 5 == 0))
        yield 0, scored(network, [self.groups[k][0] for k in at]), weights[at]
        for use, rows in ((1, self.new & (self.part == 0)), (2, self.new & self.own & (self.part == 1))):
            z = scored(network, [self.shown[k] for k in np.flatnonzero(rows)])
            yield use, z, np.ones(len(z))


def deal(seen: DataFrame, findings: int, others: int) -> DataFrame:
    """(share, rows): all different candidates, about ``REPLICA`` to a share.  Where findings
    or others are so few that a share would get less than ``LEAST_SHARED``, shares have them
    in common; ``first`` marks one of the copies."""
    shares = -(-(findings + others) // REPLICA)
    slices = [max(1, min(shares, n // LEAST_SHARED)) for n in (others, findings)]
    slices = F.when(F.col("label") == 1, slices[1]).otherwise(slices[0])
    rows = seen.select("label", "before", "body", "after").distinct().withColumn("slice", F.pmod(F.xxhash64("after", "body", "before"), slices).cast("int"))
    rows = rows.withColumn("share", F.explode(F.sequence("slice", F.lit(shares - 1), slices)))
    row = F.struct("label", "before", "body", "after", (F.col("share") == F.col("slice")).alias("first"))
    return rows.repartition(min(shares, 4000), "share").groupBy("share").agg(F.sort_array(F.collect_list(row)).alias("rows"))


def shares_of(batch: pa.RecordBatch, many: int, few: tuple[bool, bool]) -> Iterator[Share]:
    for k in range(batch.num_rows):
        rows = batch.column(1)[k].values
        label, first = (rows.field(c).to_pylist() for c in ("label", "first"))
        all_rows = list(zip(*(rows.field(c).to_pylist() for c in ("before", "body", "after")), strict=True))
        positive = [i for i, x in enumerate(label) if x]
        yield Share(batch.column(0)[k].as_py(), [all_rows[i] for i in positive], [first[i] for i in positive], [x for x, y in zip(all_rows, label, strict=True) if not y], many, few)


def averaged(shares: DataFrame, many: int, few: tuple[bool, bool], teach: Callable[[Share], list[CharacterNetwork]]) -> list[CharacterNetwork]:
    """The mean of the networks that each share leads to; a task sends the sum of its shares'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        total, n = None, 0
        for batch in batches:
            for share in shares_of(batch, many, few):
                flat = np.stack([np.concatenate([x.p[k].ravel().astype(float) for k in sorted(x.p)]) for x in teach(share)])
                total, n = flat if total is None else total + flat, n + 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["n", "total"])

    n, total = 0, 0.0
    for r in shares.mapInArrow(run, "n long, total array<double>").collect():  # some 60 KB a task
        n, total = n + r.n, total + np.array(r.total)
    size = sum(x.size for x in CharacterNetwork().p.values())
    out = []
    for flat in (total / n).reshape(-1, size):
        network, at = CharacterNetwork(), 0
        for k in sorted(network.p):
            shape = network.p[k].shape
            network.p[k] = flat[at : at + network.p[k].size].reshape(shape).astype(np.float32)
            at += network.p[k].size
        out.append(network)
    return out


def platt_of(scores: DataFrame, steps: int = 50) -> tuple[float, float]:
    """``platt`` over a table of (use, z), summed where it lies; both classes weigh the same."""
    count = {r.use: r["count"] for r in scores.groupBy("use").count().collect()}
    n0, n1 = count.get(0, 0), count.get(1, 0)
    target = F.when(F.col("use") == 1, (n1 + 1) / (n1 + 2)).otherwise(1 / (n0 + 2))
    weight = F.when(F.col("use") == 1, (n0 + n1) / (2 * max(1, n1))).otherwise((n0 + n1) / (2 * max(1, n0)))
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        q = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("z") * float(w[0]) + float(w[1])))))
        rows = scores.select("z", weight.alias("w"), q.alias("q"), target.alias("t")).select("z", (F.col("w") * (F.col("q") - F.col("t"))).alias("d"), (F.col("w") * F.col("q") * (1 - F.col("q"))).alias("h"))
        z, d, h = F.col("z"), F.col("d"), F.col("h")
        g1, g0, h2, h1, h0 = rows.agg(F.sum(z * d), F.sum(d), F.sum(z * z * h), F.sum(z * h), F.sum(h)).first()
        step = np.linalg.solve(np.array([[h2, h1], [h1, h0]]) + 1e-3 * np.eye(2), np.array([g1, g0]) + 1e-3 * (w - [1, 0]))
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train_all(seen: DataFrame, start: list[tuple], findings: int, others: int, least_recall: float, scratch: Scratch) -> SecretModel:
    """The model of all candidates in ``seen``: ``start``, a few thousand (label, finding), is
    only where the replicas begin."""
    runs = {r.label: r["count"] for r in seen.select("label", "body").distinct().groupBy("label").count().collect()}
    few = (runs.get(1, 0) < FEW, runs.get(0, 0) < FEW)
    many = max(1, REDRAWN // findings)
    shares = scratch.save(deal(seen, findings, others))
    begin = [r[1:] for r in start if r[0]], [r[1:] for r in start if not r[0]]
    first = Share(SPREAD, begin[0], [True] * len(begin[0]), begin[1], many, few)
    early = first.halves([CharacterNetwork(), CharacterNetwork()], 8, 3e-3)
    early += first.whole(CharacterNetwork(), early, 8, 3e-3)
    halves = averaged(shares, many, few, lambda share: share.halves([x.copy() for x in early[:2]], 1, RATE))
    network = averaged(shares, many, few, lambda share: share.whole(early[2].copy(), halves, 1, RATE))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        for batch in batches:
            for share in shares_of(batch, many, few):
                for use, z, weights in share.scores(network, halves):
                    yield pa.RecordBatch.from_arrays([pa.array([use] * len(z), pa.int32()), pa.array(z, pa.float64()), pa.array(weights, pa.float64())], names=["use", "z", "weight"])

    scores = scratch.save(shares.mapInArrow(run, "use int, z double, weight double"))
    trusted = (F.col("use") == 0) & (F.col("weight") > 0.6)
    if scores.where(trusted).isEmpty():
        trusted = F.col("use") == 0
    model = SecretModel(network, *platt_of(scores.where(trusted | (F.col("use") == 1))), 1.0)
    own = scores.where("use = 2").select((F.col("z") * (1.0 if model.slope >= 0 else -1.0)).alias("z"))
    # Of n rising scores the one at (1 - least_recall) * n, whole numbers only.
    found = own.orderBy("z").limit(int((1 - least_recall) * own.count()) + 1).agg(F.max("z")).first()[0]
    model.threshold = min(MOST_THRESHOLD, float(model.calibrated(np.array(found if model.slope >= 0 else -found))))
    return model


def _overlaps(start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(s < end and start < e for s, _, e in spans)


def _covered(start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    """Whether spans, by rising start, leave nothing of a run."""
    for s, _, e in spans:
        if s <= start < e:
            start = e
    return start >= end


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans, found) of each text: base spans, and candidates with their context and label."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    seen = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("before", pa.string()), ("body", pa.string()), ("after", pa.string()), ("label", pa.int32()), ("covered", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep("secrets", "", dict)
        for batch in batches:
            spans, found = [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                found.append([
                    {"start": s, "end": e, "before": text[max(0, s - BEFORE) : s], "body": text[s:e], "after": text[e : e + AFTER], "label": int(_overlaps(s, e, base)), "covered": _covered(s, e, base)}
                    for s, e in candidates(text)
                ])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span)), pa.array(found, pa.list_(seen))], names=["id", "spans", "found"])

    schema = (
        f"id {docs.schema[id_col].dataType.simpleString()}, spans array<struct<start:int,kind:int,end:int>>,"
        " found array<struct<start:int,end:int,before:string,body:string,after:string,label:int,covered:boolean>>"
    )
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_each: int = 3000, least_recall: float = 0.95) -> DataFrame:
    """(id, spans) of each text; a span is (start, kind, end, score), kind a number in KINDS.

    All different candidates are learned from.  ``max_each`` bounds those that the driver takes:
    positives, negatives, and negatives that are short runs without a digit.  Of larger
    corpora the driver's are where replicas begin, which then learn from all."""
    scratch = Scratch(docs.sparkSession, "secrets")
    table = scratch.save(find(docs, id_col, text_col))
    body = F.substring("f.body", 1, 4 * BODY).alias("body")
    seen = table.select(F.explode("found").alias("f")).select("f.label", "f.before", body, "f.after").withColumn("hash", F.xxhash64("before", "body", "after"))
    # Plain words are drawn apart, so they do not crowd out the negatives that look like keys.
    seen = seen.withColumn("kind", F.when(F.col("label") == 1, 1).when(F.col("body").rlike("[0-9]") | (F.length("body") >= 20), 0).otherwise(2))
    # Copies are one candidate, in the counts as in the sample.
    counts = {r.kind: r["count"] for r in seen.select("kind", "hash").distinct().groupBy("kind").count().collect()}
    share = lambda k: int(SPREAD * min(1.0, max_each / max(1, counts.get(k, 0))))
    sample = seen.where(F.pmod("hash", F.lit(SPREAD)) < F.when(F.col("kind") == 1, share(1)).when(F.col("kind") == 0, share(0)).otherwise(share(2)))
    rows = sorted((r.label, r.before, r.body, r.after) for r in sample.drop("hash", "kind").distinct().collect())  # about three times max_each at most
    if max(counts.values(), default=0) > max_each and counts.get(1) and len(counts) > 1:
        model = train_all(seen, rows, counts[1], sum(counts.values()) - counts[1], least_recall, scratch)
    else:
        model = train([r[1:] for r in rows if r[0]], [r[1:] for r in rows if not r[0]], least_recall)
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        for batch in batches:
            base, found = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            todo = [(r, f) for r, x in enumerate(found) for f in x if not f["covered"]] if model else []
            scores = model.calibrated(scored(model.network, [(f["before"], f["body"], f["after"]) for _, f in todo])) if todo else []
            added: dict[int, list[dict]] = {}
            for (r, f), score in zip(todo, scores, strict=True):
                if score >= model.threshold:
                    added.setdefault(r, []).append({"start": f["start"], "kind": 3, "end": f["end"], "score": float(score)})
            spans = [sorted([{**s, "score": 1.0} for s in x] + added.get(r, []), key=lambda s: (s["start"], s["kind"])) for r, x in enumerate(base)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], names=["id", "spans"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, spans array<struct<start:int,kind:int,end:int,score:double>>"
    return table.mapInArrow(run, schema)
