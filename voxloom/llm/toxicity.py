"""Toxicity: a logistic classifier regularised by counterfactuals.

A document's features are its words and their prefixes, each again where it occurs
several times, so that inflected forms of a stem share evidence and a stem that is
frequent in a text counts for more than one met by chance.  Next to log-loss and an L2
penalty, the objective has a term for each labelled sentence that names a group:
the sentence is written again with other group names and with neutral nouns, and
the square of the change in its score is penalised.  Group names so end with the
weight of the neutral nouns, and a neutral mention of a group is not held against
a text.

Scale: labels are joined to the corpus once, as a hash sample of at most about
``max_labelled`` rows (the documented bound of what the classifier is fitted on).
Feature counts are shuffled, and only the ``max_features`` most telling features
and the sample's own active features reach the driver, where numpy fits the
weights.  Scoring is one pass without a shuffle; the model is a dictionary of at
most ``max_features`` entries.

Cases: null and empty texts have no features and score the model's base rate.
Null labels are left out; of several labels of one id, or of equal texts, the largest counts.  With
no labelled rows, or one class only, every text scores the smoothed base rate.
Repeated rows get equal scores.  Null ids are scored and never learned from.  Only
the named columns are read, so extra ones cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import Scratch
from .worker import keep

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+")
#: Lengths of prefixes that are features.
PREFIXES = range(3, 9)
#: Numbers of occurrences from which a feature counts again.
TIMES = (1, 2, 3, 5)

# Group names by the slot of a sentence they fill, neutral nouns first.
IDENTITY_SLOTS = (
    ("people", "folks", "neighbors", "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists",
     "immigrants", "refugees", "foreigners", "lesbians", "gays", "blacks", "whites", "asians", "africans", "arabs",
     "mexicans", "europeans", "americans"),
    ("person", "neighbor", "colleague", "woman", "man", "muslim", "christian", "jew", "hindu", "buddhist", "atheist",
     "immigrant", "refugee", "foreigner", "lesbian", "american", "african", "arab", "mexican", "european", "asian"),
    ("young", "tall", "gay", "straight", "transgender", "black", "white", "jewish", "disabled", "deaf", "blind", "old"),
    ("menschen", "leute", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge"),
    ("gens", "personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés"),
    ("gente", "personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados"),
)
SLOT_OF = {w: k for k, slot in enumerate(IDENTITY_SLOTS) for w in slot}


def word_features(word: str) -> list[str]:
    """A lower-case word and its proper prefixes, told apart by their mark."""
    return [word + "$", *(word[:n] for n in PREFIXES if n <= len(word))]


def features_of(words: Iterable[str]) -> set[str]:
    """Features of a bag of words: which occur, and which do so repeatedly."""
    totals: Counter[str] = Counter()
    for word, n in Counter(words).items():
        for f in word_features(word):
            totals[f] += n
    return {f if k == 1 else f"{f}#{k}" for f, n in totals.items() for k in TIMES if n >= k}


def text_features(text: str | None) -> set[str]:
    return features_of(WORD.findall((text or "").lower()))


def counterfactuals(text: str, variants: int = 4) -> Iterator[tuple[set[str], set[str]]]:
    """Features of each sentence that names a group, and of its rewritings."""
    for sentence in SENTENCE.findall(text.lower()):
        words = WORD.findall(sentence)
        for at in [k for k, w in enumerate(words) if w in SLOT_OF]:
            slot = IDENTITY_SLOTS[SLOT_OF[words[at]]]
            own = slot.index(words[at])
            others = [w for w in slot[:2] if w != words[at]] + [slot[(own + 1 + 3 * k) % len(slot)] for k in range(variants)]
            before = features_of(words)
            for other in dict.fromkeys(w for w in others if w != words[at]):
                yield before, features_of([*words[:at], other, *words[at + 1 :]])


@dataclass
class ToxicityModel:
    """Weights of features, and the score's constant."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def logit(self, text: str | None) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in text_features(text))

    def score(self, text: Column) -> Column:
        """Probability of the label 1 of a text column."""
        return F.pandas_udf(self._scorer(), T.DoubleType())(F.coalesce(text.cast("string"), F.lit("")))

    def _scorer(self):
        bias = self.bias
        steps: dict[str, list[tuple[int, float]]] = {}
        for f, w in self.weights.items():
            name, _, k = f.partition("#")
            steps.setdefault(name, []).append((int(k or 1), w))

        name = hashlib.md5(repr(sorted(self.weights.items())).encode()).hexdigest()

        def found(memo: dict, word: str) -> tuple[str, ...]:
            if len(memo) > 300_000:
                memo.clear()
            memo[word] = hit = tuple(f for f in word_features(word) if f in steps)
            return hit

        def one(memo: dict, text: str) -> float:
            totals: dict[str, int] = {}
            for w, n in Counter(WORD.findall(text.lower())).items():
                hit = memo.get(w)
                if hit is None:
                    hit = found(memo, w)
                for f in hit:
                    totals[f] = totals.get(f, 0) + n
            z = bias + sum(w for f in sorted(totals) for k, w in steps[f] if totals[f] >= k)
            return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

        def score(texts: pd.Series) -> pd.Series:
            memo = keep("toxicity", name, dict)
            return pd.Series([one(memo, t) for t in texts], dtype=float)

        return score


def fit(
    active: list[np.ndarray], labels: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], n_features: int,
    l2: float = 1e-3, swap_penalty: float = 1.0, steps: int = 300,
) -> tuple[np.ndarray, float]:
    """Weights and constant by full-batch Adam.  ``active``: each row's feature numbers;
    ``swaps``: feature numbers of a sentence before and after a swap."""

    def sparse(rows: Iterable[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows = list(rows)
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)

    n, m = len(labels), len(swaps)
    row, col = sparse(active)
    srow, scol = sparse(np.concatenate(s) for s in swaps)
    sign = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in swaps] + [np.zeros(0)])
    y = labels.astype(float)
    weight = np.where(y > 0, n / (2 * max(1.0, y.sum())), n / (2 * max(1.0, n - y.sum()))) ** 0.5
    w, b = np.zeros(n_features), math.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col], n) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        gradient = np.r_[np.bincount(col, error[row], n_features) + l2 * w, error.sum()]
        if m:
            change = np.bincount(srow, sign * w[scol], m)
            gradient[:-1] += swap_penalty * np.bincount(scol, sign * change[srow], n_features) / m
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        step = 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8) * min(1.0, 2 * (1 - t / (steps + 1)))
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def _few(batches: Iterator[pa.RecordBatch], n: int = 200) -> Iterator[tuple[list[int], list[str]]]:
    """(labels, texts) of a few rows at a time, which bounds what their features take."""
    keep("toxicity", "fit", dict)
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            part = batch.slice(at, n)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    max_labelled: int = 12_000, max_features: int = 2048, min_documents: int = 8, least_g2: float = 25.0, swap_penalty: float = 1.0,
) -> ToxicityModel:
    """Fit to the rows of ``docs`` that ``labels`` (id, label) covers.

    ``max_labelled`` bounds the sample that is learned from, by a hash of the id, so
    it is the same sample in every run.  A feature is kept if ``min_documents`` of the
    sample have it and its G-squared with the label is ``least_g2`` or more."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__label"))
    total = known.count()
    share = min(1.0, max_labelled / max(1, total))
    chosen = known.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(share * 1_000_000))  # about max_labelled rows at most

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, texts in _few(batches):
            found = [sorted(text_features(t)) for t in texts]
            flat = pa.array([f for x in found for f in x], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(label, [len(x) for x in found]), pa.int32()), flat], names=["label", "feature"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Equal texts are one row, with the largest of their labels.
    texts = docs.select(F.col(id_col).alias("__id"), text.alias("text"))
    sample = scratch.save(texts.join(F.broadcast(chosen), "__id").groupBy("text").agg(F.max("__label").alias("label")).select("label", "text"))
    size, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    base = ToxicityModel(math.log((toxic + 0.5) / (size - toxic + 0.5)) if size else -2.2)
    if not toxic or toxic == size:
        return base
    n1 = F.sum("label").cast("double")
    n0 = F.count("*") - n1
    e = lambda share: (n0 + n1) * share
    p = toxic / size
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    # G-squared of the feature's two cells; the other two add little for rare features.
    telling = (
        sample.mapInArrow(extract, "label int, feature string").groupBy("feature")
        .agg(F.count("*").alias("n"), (2 * (part(n1, e(p)) + part(n0, e(1 - p)))).alias("g2"))
        .where((F.col("n") >= min_documents) & (F.col("g2") >= least_g2))
        .orderBy(F.desc("g2"), "feature").limit(max_features)
    )
    names = [r.feature for r in telling.collect()]  # at most max_features
    names += sorted({w + "$" for slot in IDENTITY_SLOTS for w in slot} - set(names))
    number = {f: k for k, f in enumerate(names)}

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lambda found: sorted(number[f] for f in found if f in number)
        for label, texts in _few(batches):
            pairs = [[(known(a), known(b)) for a, b in counterfactuals(t)] for t in texts]
            columns = [label, [known(text_features(t)) for t in texts], [[a for a, _ in x] for x in pairs], [[b for _, b in x] for x in pairs]]
            kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["label", "active", "before", "after"])

    shape = "label int, active array<int>, before array<array<int>>, after array<array<int>>"
    rows = sample.mapInArrow(compact, shape).collect()  # about max_labelled rows
    rows.sort(key=lambda r: (r.label, r.active))
    swaps = [(np.array(a, np.int64), np.array(b, np.int64)) for r in rows for a, b in zip(r.before, r.after, strict=True)]
    weights, bias = fit([np.array(r.active, np.int64) for r in rows], np.array([r.label for r in rows]), swaps, len(names), swap_penalty=swap_penalty)
    scratch.drop(sample)
    return ToxicityModel(bias, {f: float(w) for f, w in zip(names, weights, strict=True) if abs(w) > 1e-6})
