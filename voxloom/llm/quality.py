"""Quality rules as weak supervision, in DataFrame functions only.

Every rule looks at one statistic of the text and votes *good* (1), *bad* (-1)
or abstains (0).  Rules are weak and overlap: noise of one kind (symbols, repetition,
shouting) is seen by two or three of them, and some rules, such as the one on short
texts, are often wrong.  Dawid-Skene expectation-maximisation over the table of vote
patterns estimates how often each rule votes *bad* among bad and among good documents.
The posterior probability of *good* decides, in place of a filter that all rules must
pass: one bad vote can be outvoted, and a rule that votes bad as often among good
documents as among bad ones weighs nothing.

The plan scans the text once, without a shuffle: all statistics are array
expressions within the row, written to the shared folder as a narrow table.  The
one shuffle is the count of patterns, combined on the map side; their number is bounded
by the rules (``3 ** len(RULES)``), not by the corpus.

Cases: a null text counts as empty; an empty text has no words and fails the
base rule.  Repeated rows give repeated results.  Null ids stay null.  An empty
table gives no rows and the accuracies of the priors.  Columns other than the id and
the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Scratch
from .tables import WS

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Votes good below or at ``good``, bad above ``bad``, and abstains between."""

    name: str
    value: Callable[[], Column]
    good: float
    bad: float


def _per_word(name: str) -> Column:
    return F.col(name) / F.greatest(F.col("n_words"), F.lit(1))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


RULES = (
    Rule("short", lambda: -F.col("n_words").cast("double"), -200, -100),
    Rule("word_length", lambda: F.abs(_per_word("word_chars") - 6.0), 2.0, 4.0),
    Rule("symbols", lambda: _per_word("n_symbols"), 0.05, 0.1),
    Rule("symbol_runs", lambda: _per_word("n_symbol_runs"), 0.01, 0.05),
    Rule("letters", lambda: -_share("n_letters", "word_chars"), -0.9, -0.8),
    Rule("wordless", lambda: _per_word("n_wordless"), 0.05, 0.2),
    Rule("dup_lines", lambda: _share("n_dup_lines", "n_lines"), 0.1, 0.3),
    Rule("repeats", lambda: _per_word("n_repeat_words"), 0.2, 0.4),
    Rule("distinct", lambda: -_per_word("n_distinct"), -0.4, -0.25),
    Rule("capitals", lambda: _share("n_capitals", "word_chars"), 0.1, 0.3),
    Rule("shouting", lambda: _per_word("n_bangs"), 0.1, 0.4),
)


def _without(text: Column, characters: str) -> Column:
    """Text less some characters; a chain of plain replaces is a byte search each."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of each whole text, as longs, one row per row of ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("id"),
        F.length(_without(text, WS)).alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).alias("n_symbols"),
        (F.length(text) - F.length(_without(text, "!"))).alias("n_bangs"),
        (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))).alias("n_capitals"),
        F.length(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", "")).alias("n_letters"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]{{3,}}")).alias("n_symbol_runs"),
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.expr(f"filter(split(coalesce(cast(`{text_col}` as string), ''), '\\n'), x -> rlike(x, '[^\\\\x20\\\\x09-\\\\x0D]'))").alias("lines"),
    )
    counted = split.select(
        "id", "word_chars", "n_symbols", "n_bangs", "n_capitals", "n_letters", "n_symbol_runs",
        F.size("words").alias("n_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.expr(r"size(filter(words, w -> not rlike(w, '[A-Za-z\\x{80}-\\x{10FFFF}]')))").alias("n_wordless"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.expr(
            "if(size(words) < 3, cast(array() as array<bigint>),"
            " transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])))"
        ).alias("windows"),
    )
    kept = [c for c in counted.columns if c != "windows"]
    # Windows sorted by hash with their position put equal ones side by side in n log n steps;
    # a text without any repeated window skips that.
    ordered = counted.select(
        *kept,
        F.expr(
            "if(size(array_distinct(windows)) = size(windows), null,"
            " sort_array(transform(windows, (h, i) -> struct(h as h, i as i))))"
        ).alias("ordered"),
    )
    repeated = ordered.select(
        *kept,
        F.expr(
            "sort_array(transform(filter(ordered, (w, k) ->"
            " (k > 0 and ordered[k - 1].h = w.h) or (k < size(ordered) - 1 and ordered[k + 1].h = w.h)), w -> w.i))"
        ).alias("at"),
    )
    # Each repeated window adds the words that the one before it does not cover already.
    covered = F.expr(
        "coalesce(aggregate(transform(at, (p, k) -> if(k = 0, 3, least(3, p - at[k - 1]))), 0, (a, b) -> a + b), 0)"
    )
    return repeated.select(
        "id", *[F.col(c).cast("long").alias(c) for c in kept if c != "id"], covered.cast("long").alias("n_repeat_words")
    )


#: Beta priors as (mean, weight in documents): the share of good documents, and a rule's
#: chance of voting bad among good and among bad ones.  They steer a corpus of a few rows;
#: beyond that the votes decide.
GOOD, BAD_IF_GOOD, BAD_IF_BAD = (0.8, 10.0), (0.05, 10.0), (0.3, 10.0)


@dataclass
class LabelModel:
    """Share of good documents, and each rule's chance of voting bad by class."""

    good: float = GOOD[0]
    bad_if_good: list[float] = field(default_factory=lambda: [BAD_IF_GOOD[0]] * len(RULES))
    bad_if_bad: list[float] = field(default_factory=lambda: [BAD_IF_BAD[0]] * len(RULES))

    def log_odds(self, votes: tuple[int, ...]) -> float:
        total = math.log(self.good / (1 - self.good))
        for v, g, b in zip(votes, self.bad_if_good, self.bad_if_bad, strict=True):
            total += math.log(g / b) if v < 0 else math.log((1 - g) / (1 - b)) if v > 0 else 0.0
        return total


def _beta(part: float, whole: float, prior: tuple[float, float]) -> float:
    """Mean of a share under a Beta prior; never 0 or 1."""
    mean, weight = prior
    return (part + mean * weight) / (whole + weight)


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], steps: int = 200, settled: float = 1e-9) -> LabelModel:
    """Fit to (votes, count) rows.

    One constraint keeps the classes from changing places: where a rule's bad vote comes out
    likelier among good documents than among bad ones, both get the rate of all, and the
    rule weighs nothing."""
    model = LabelModel()
    total = sum(n for _, n in patterns)
    for _ in range(steps if total else 0):
        weights = [(v, n, 1 / (1 + math.exp(-max(-50.0, min(50.0, model.log_odds(v)))))) for v, n in patterns]
        nxt = LabelModel(_beta(sum(n * p for _, n, p in weights), total, GOOD), [], [])
        for j in range(len(RULES)):
            cast = [(v[j], n, p) for v, n, p in weights if v[j]]
            good, bad = sum(n * p for _, n, p in cast), sum(n * (1 - p) for _, n, p in cast)
            bad_votes = sum(n * p for v, n, p in cast if v < 0), sum(n * (1 - p) for v, n, p in cast if v < 0)
            g, b = _beta(bad_votes[0], good, BAD_IF_GOOD), _beta(bad_votes[1], bad, BAD_IF_BAD)
            if g > b:
                g = b = (sum(bad_votes) + 1) / (good + bad + 2)
            nxt.bad_if_good.append(g)
            nxt.bad_if_bad.append(b)
        moved = max(abs(x - y) for x, y in zip([model.good, *model.bad_if_good, *model.bad_if_bad], [nxt.good, *nxt.bad_if_good, *nxt.bad_if_bad], strict=True))
        model = nxt
        if moved < settled:
            break
    return model


def votes(stats: DataFrame) -> DataFrame:
    """``stats`` with one vote column per rule."""
    return stats.withColumns(
        {
            f"vote_{r.name}": F.when(r.value() <= r.good, 1).when(r.value() > r.bad, -1).otherwise(0)
            for r in RULES
        }
    )


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Statistics, votes, posterior of *good* and verdict of each document.

    Columns: the id, the statistics (``n_words`` ... ``n_repeat_words``), a vote
    per rule, ``base_failed``, ``posterior`` and ``kept``."""
    scratch = Scratch(docs.sparkSession, "quality")
    voted = scratch.save(votes(features(docs, id_col, text_col)))
    names = [f"vote_{r.name}" for r in RULES]
    patterns = voted.groupBy(*names).count().collect()  # at most 3 ** len(RULES) rows
    model = expectation_maximisation(sorted((tuple(row[n] for n in names), row["count"]) for row in patterns))
    odds = F.lit(math.log(model.good / (1 - model.good)))
    for name, g, b in zip(names, model.bad_if_good, model.bad_if_bad, strict=True):
        odds += F.when(F.col(name) < 0, math.log(g / b)).when(F.col(name) > 0, math.log((1 - g) / (1 - b))).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("posterior", 1 / (1 + F.exp(-odds)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
        .withColumnRenamed("id", id_col)
    )
