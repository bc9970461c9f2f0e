"""Text quality by weak supervision: rules vote or abstain, a label model weighs them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import from_texts
from lumbung.session import stage

SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(0x41, 0x5B))
CONTINUATIONS = bytes(range(0x80, 0xC0))
LETTERS = CAPITALS + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
MARKS = b"!?"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_letters",
    "n_distinct_words", "n_marked", "n_bytes",
)


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words inside windows of three words that occur twice or more; words are numbers below ``distinct``."""
    if len(ids) < 4:
        return 0
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct > 2_000_000:  # three numbers would not fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + ids[2:]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.isin(windows, twice)
    covered = np.zeros(len(ids), bool)
    for i in range(3):
        covered[i : i + len(starts)] |= starts
    return int(covered.sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The values of ``MEASURES``; a null text has no words."""
    text = text or b""
    words = text.split()  # on ASCII white space
    index = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    size = len(text)
    blanks = size - sum(map(len, words))
    return (
        len(words),
        len(text.translate(None, CONTINUATIONS)) - blanks,
        size - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(ids, max(len(index), 1)),
        len(lines),
        size - len(text.translate(None, CAPITALS)),
        size - len(text.translate(None, LETTERS)),
        len(index),
        size - len(text.translate(None, MARKS)),
        size,
    )


def measures(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``MEASURES`` of every text, beside the columns ``keep``."""
    fields = ", ".join(f"{name} bigint" for name in MEASURES)
    empty = [[]] * len(MEASURES)
    return from_texts(docs, text_col, keep, fields, lambda: lambda texts: list(zip(*map(measure, texts))) or empty)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, good where ``good`` holds, and abstains elsewhere."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("repeats", "n_repeat_words > 0.3 * n_words", "n_repeat_words <= 0.1 * n_words"),
    Rule("lines", "n_dup_lines > 0.3 * n_lines", "n_lines >= 3 and n_dup_lines <= 0.1 * n_lines"),
    Rule("capitals", "n_capitals > 0.3 * n_letters", "n_capitals <= 0.15 * n_letters"),
    Rule("marks", "n_marked > 0.2 * n_words", "n_marked <= 0.05 * n_words"),
    Rule("word_length", "word_chars not between 2 * n_words and 15 * n_words", "word_chars between 3 * n_words and 12 * n_words"),
    Rule("letters", "n_letters < 0.6 * n_bytes", "n_letters >= 0.75 * n_bytes"),
    Rule("variety", "n_words >= 20 and n_distinct_words < 0.1 * least(n_words, 1000)", "n_distinct_words >= 0.3 * least(n_words, 1000)"),
)


@dataclass(frozen=True)
class LabelModel:
    """``weights[j][v]`` is the log odds for good that vote v (0 bad, 1 abstain, 2 good) of rule j gives."""

    prior: float
    weights: tuple[tuple[float, float, float], ...]

    def posterior(self, votes: list[Column]) -> Column:
        """Probability of good quality."""
        odds = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for vote, (bad, none, good) in zip(votes, self.weights):
            odds = odds + F.when(vote == 0, bad).when(vote == 1, none).otherwise(good)
        return 1 / (1 + F.exp(-odds))


# Prior votes of one rule, as shares of (bad, abstain, good) among good and among bad texts. They
# name the classes, and count like this many texts, so that a rule without votes keeps its weight.
GOOD, BAD, STRENGTH = (0.01, 0.19, 0.80), (0.30, 0.20, 0.50), 50.0
PRIOR, ROUNDS = 0.9, 100
# A rule is better than chance: a bad vote is at least so many times likelier on a bad text than on a good one.
BETTER = 10.0


def better_than_chance(tallies: np.ndarray) -> np.ndarray:
    """Shares of votes (class, rule, vote) that fit ``tallies`` best and keep every rule informative."""
    total = tallies.sum(2)
    bad = tallies[:, :, 0] / total
    tied = tallies[:, :, 0].sum(0) / (total[1] + BETTER * total[0])
    weak = bad[0] < BETTER * bad[1]
    bad = np.where(weak, np.stack([np.minimum(BETTER * tied, 0.9), tied]), bad)
    rest = tallies[:, :, 2] / np.maximum(tallies[:, :, 1] + tallies[:, :, 2], 1e-12)
    both = tallies[:, :, 2].sum(0) / np.maximum(tallies[:, :, 1:].sum((0, 2)), 1e-12)
    rest = np.where(rest[1] < rest[0], both, rest)
    return np.clip(np.stack([bad, (1 - bad) * (1 - rest), (1 - bad) * rest], axis=2), 1e-6, 1)


def fit_label_model(patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Expectation maximisation over distinct vote patterns: (patterns x rules) in 0..2, and their counts.

    Rules are taken as independent given the class; each has its own shares of votes in either
    class, which is its accuracy on good and on bad texts.
    """
    patterns, counts = np.asarray(patterns, int), np.asarray(counts, float)
    seen = np.stack([patterns == v for v in range(3)], axis=2).astype(float)  # pattern, rule, vote
    start = STRENGTH * np.array([[BAD] * patterns.shape[1], [GOOD] * patterns.shape[1]])  # class, rule, vote
    shares, prior = better_than_chance(start), PRIOR
    for _ in range(ROUNDS):
        logs = np.log(np.array([1 - prior, prior]))[None] + np.einsum("prv,crv->pc", seen, np.log(shares))
        good = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        weight = np.stack([1 - good, good], axis=1) * counts[:, None]
        shares = better_than_chance(np.einsum("pc,prv->crv", weight, seen) + start)
        prior = (weight[:, 1].sum() + STRENGTH * PRIOR) / (counts.sum() + STRENGTH)
    ratio = np.log(shares[1] / shares[0])
    return LabelModel(float(prior), tuple(tuple(map(float, r)) for r in ratio))


def votes(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """0 bad, 1 abstain, 2 good, for columns of ``measures``; a text without words gets no good vote."""
    return [
        F.when(F.expr(r.bad), 0).when(F.expr(f"n_words > 0 and ({r.good})"), 2).otherwise(1).alias(f"vote_{r.name}")
        for r in rules
    ]


def learn(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> LabelModel:
    """The label model of all texts that pass the base rules.

    At most 3 ** len(rules) vote patterns with counts reach the driver.
    """
    cast = votes(rules)
    names = [f"v{i}" for i in range(len(cast))]
    passed = measured.where(~base_failed()).select(*(v.alias(n) for v, n in zip(cast, names)))
    found = passed.groupBy(*names).count().collect()
    return fit_label_model(np.array([r[:-1] for r in found]).reshape(-1, len(cast)), np.array([r[-1] for r in found]))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: ``id_col``, the measures, the votes, base_failed, quality (posterior) and kept.

    Kept are texts that pass the base rules and whose posterior probability of good quality reaches
    ``threshold``. A null or empty text has no words and fails. Null ids stay, repeated rows give
    repeated results (and count in the model each time), an empty table gives an empty result, other
    columns are not read. The measures are staged once: the model needs those of all texts.
    """
    measured = stage(measures(docs, [id_col], text_col), "measures")
    model = learn(measured)
    cast = votes()
    judged = measured.withColumns({f"vote_{r.name}": v for r, v in zip(RULES, cast)})
    judged = judged.withColumn("base_failed", base_failed()).withColumn("quality", model.posterior(cast))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    Texts are measured twice, once for the model and once beside the row itself, so that no text is
    shuffled or written twice.
    """
    model = learn(measures(docs, [], text_col))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    text = names[text_col]
    kept = measures(plain, list(names.values()), text).where(~base_failed() & (model.posterior(votes()) >= threshold))
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))
