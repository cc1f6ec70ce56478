"""Quality rules by weak supervision, in DataFrame operations only.

Each rule votes that a document is good or bad, or abstains. Expectation
maximisation estimates from the votes of all documents, without labels, how
often each rule is right about good and about bad documents, and the
posterior probability of good quality decides instead of a list of limits that
all must pass.
The votes of the corpus are counted by pattern; there are at most
``3 ** len(RULES)`` patterns, whatever the number of documents, and only their
counts come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.plans.handoff import written

from .common import WORD

# Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is it that was for on are with as at by an this be from or "
    "le la les des et en un une que dans pour par sur est pas du de qui avec au "
    "der die das und ist mit den von zu dem nicht ein eine sich auf für im auch "
    "el los las del y con por su para al lo como se más"
).split()


@dataclass(frozen=True)
class Rule:
    """Votes by two SQL conditions on the measures; neither holds: it abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 20", "n_words >= 80"),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("lines", "n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0"),
    Rule("repeats", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.05 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    Rule("capitals", "n_capitals > 0.3 * n_letters", "n_capitals <= 0.1 * n_letters"),
    Rule("function_words", "n_function < 0.02 * n_words", "n_function >= 0.08 * n_words"),
    Rule("shouting", "n_shouts > 0.2 * n_words", "n_shouts <= 0.02 * n_words"),
    Rule("sentences", "n_stops < 0.01 * n_words", "n_stops BETWEEN 0.03 * n_words AND 0.4 * n_words"),
    Rule("letters", "n_letters < 0.6 * word_chars", "n_letters >= 0.8 * word_chars"),
)
#: Posterior probability of good quality from which a document is kept.
KEEP = 0.5
ROUNDS = 100


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_window_words(words: Column, size: int = 3) -> Column:
    """How many words stand in windows of ``size`` words that occur at least twice in ``words``.

    Windows are compared by 64-bit hashes. Only if some hash repeats are
    windows sorted with their places; the places of those equal to a neighbour
    then cover ``min(size, distance to the next such place)`` words each.
    """

    def window(ws: Column) -> Column:
        starts = F.slice(ws, 1, F.greatest(F.size(ws) - (size - 1), F.lit(0)))
        return F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, size)]))

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        def cover(p: Column) -> Column:
            each = F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size))))
            return F.aggregate(each, F.lit(0), lambda a, x: a + x)

        return let(let(placed, places), cover)

    return let(
        let(words, window), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0))
    )


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id`` and what the rules look at. A null text counts as empty.

    Whole texts are measured. Other columns of ``df`` are not used.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    def lines(kept: Column) -> Column:
        return F.struct(
            F.size(kept).cast("long").alias("n_lines"),
            (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
        )

    def words(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_words"),
            repeated_window_words(found).cast("long").alias("n_repeat_words"),
            F.size(F.filter(found, lambda w: w.isin(*FUNCTION_WORDS))).cast("long").alias("n_function"),
        )

    with_a_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.select(
        "doc_id",
        let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), words).alias("w"),
        let(with_a_word, lines).alias("l"),
        without(r"[\x20\x09-\x0D]+").cast("long").alias("word_chars"),
        (F.length(text) - without(r"[#*$%&|<>]+")).cast("long").alias("n_symbols"),
        without(r"\P{L}+").cast("long").alias("n_letters"),
        (F.length(text) - without(r"\p{Lu}+")).cast("long").alias("n_capitals"),
        (F.length(text) - without(r"!+")).cast("long").alias("n_shouts"),
        (F.length(text) - without(r"[.!?]+")).cast("long").alias("n_stops"),
    ).select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_letters", "n_capitals", "n_shouts", "n_stops")


def votes(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """Each rule's vote on the measures: -1 bad, 1 good, 0 abstains."""
    return [F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in rules]


@dataclass(frozen=True)
class QualityModel:
    """``prior`` of good; ``rates``: for each rule the chances of the votes (-1, 0, 1) on bad and on good documents."""

    prior: float
    rates: tuple[tuple[tuple[float, ...], tuple[float, ...]], ...]

    def log_odds(self) -> list[tuple[float, ...]]:
        """What each vote (-1, 0, 1) of each rule adds to the log-odds of good."""
        return [tuple(math.log(g / b) for b, g in zip(bad, good, strict=True)) for bad, good in self.rates]

    def accuracy(self, rule: int) -> float:
        """How often the rule is right when it votes."""
        bad, good = self.rates[rule]
        right = (1 - self.prior) * bad[0] + self.prior * good[2]
        return right / (right + (1 - self.prior) * bad[2] + self.prior * good[0])


def fit_quality(patterns: list[tuple[tuple[int, ...], int]], rules: int = len(RULES)) -> QualityModel:
    """Expectation maximisation over the counts of vote patterns.

    Bad documents are bad in different ways, so few rules see any one of them:
    the start takes a document with a bad vote for bad. One document of each
    kind smooths the rates. A rule that comes out worse than chance (it votes
    bad more often on good documents) is taken to say nothing. Without documents
    nothing is learnt, and every rate is a third.
    """
    if not patterns:
        return QualityModel(0.5, (((1 / 3,) * 3,) * 2,) * rules)
    total = sum(n for _, n in patterns)
    chance = [0.9 if -1 not in v else 0.4 / v.count(-1) for v, _ in patterns]
    for _ in range(ROUNDS):
        prior = (sum(n * p for (_, n), p in zip(patterns, chance, strict=True)) + 1) / (total + 2)
        rates = []
        for r in range(rules):
            bad, good = [1.0] * 3, [1.0] * 3
            for (v, n), p in zip(patterns, chance, strict=True):
                bad[v[r] + 1] += n * (1 - p)
                good[v[r] + 1] += n * p
            bad, good = [x / sum(bad) for x in bad], [x / sum(good) for x in good]
            if bad[0] < good[0]:
                bad = good
            rates.append((tuple(bad), tuple(good)))
        model = QualityModel(prior, tuple(rates))
        added, base = model.log_odds(), math.log(prior / (1 - prior))
        odds = [base + sum(added[r][x + 1] for r, x in enumerate(v)) for v, _ in patterns]
        chance = [1 / (1 + math.exp(-max(-500.0, min(500.0, x)))) for x in odds]
    return model


def vote_patterns(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> list[tuple[tuple[int, ...], int]]:
    """How many documents have each pattern of votes, in a fixed order."""
    columns = [v.alias(f"v{k}") for k, v in enumerate(votes(rules))]
    counted = measures.select(*columns).groupBy(*[f"v{k}" for k in range(len(rules))]).agg(F.count("*").alias("n"))
    return sorted((tuple(row[:-1]), row[-1]) for row in counted.collect())


def posterior(model: QualityModel, rules: tuple[Rule, ...] = RULES) -> Column:
    """Probability of good quality of a row of measures."""
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for vote, (bad, none, good) in zip(votes(rules), model.log_odds(), strict=True):
        odds = odds + F.when(vote < 0, bad).when(vote > 0, good).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def judge_quality(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The measures of every document with ``probability`` of good quality.

    The model is fitted on the votes on all documents of ``df``. Null and empty
    texts are documents without words, on which most rules abstain or vote bad.
    Repeated rows count, and are judged, row by row. An empty table
    gives no rows.
    """
    measures = written(measure(df, id_col, text_col))
    model = fit_quality(vote_patterns(measures, rules), len(rules))
    return measures.withColumn("probability", posterior(model, rules))
