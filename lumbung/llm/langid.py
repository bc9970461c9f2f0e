"""Language identification by unigram piece models that sum over all segmentations of a word."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import TEXT, fresh, from_texts, map_arrow
from lumbung.session import stage

MODEL = "piece_bpe_32k.model"
UNKNOWN = "und"
#: Runs of letters; a longer run is scored in parts of this length.
LONGEST_WORD = 40
WORD = re.compile(r"[^\W\d_]{1,%d}" % LONGEST_WORD)
FLOOR, UNSEEN, SMOOTHING = 1e-6, 1e-6, 0.01
CACHED_CELLS = 2_000_000


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[str, int]:
    """The pieces of a public vocabulary and their numbers; its own scores are not used."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    kept = [p for p in pieces if p == "▁" or p.removeprefix("▁").isalpha()]
    return {p: i for i, p in enumerate(kept)}


class Lattices:
    """The pieces at all places of words of one length, as numbers into a table of probabilities.

    Row ``len(pieces)`` of that table stands for an unknown character, the row after it for no piece.
    """

    def __init__(self, pieces: dict[str, int], words: list[str]):
        self.n = len(words[0]) + 1
        unknown, none = len(pieces), len(pieces) + 1
        longest = min(self.n, max(map(len, pieces), default=1))
        get = pieces.get
        self.spans = [(s, e) for e in range(1, self.n + 1) for s in range(max(0, e - longest), e)]
        rows = []
        for word in words:
            marked = "▁" + word
            rows.append([get(marked[s:e], unknown if e == s + 1 else none) for s, e in self.spans])
        self.ids = np.array(rows, np.int32).reshape(len(words), len(self.spans)).T.copy()

    def forward(self, table: np.ndarray) -> np.ndarray:
        """(place, word, language) sums of the probabilities of all segmentations up to a place."""
        alpha = np.zeros((self.n + 1, self.ids.shape[1], table.shape[1]))
        alpha[0] = 1
        for (s, e), ids in zip(self.spans, self.ids):
            alpha[e] += alpha[s] * table[ids]
        return alpha

    def expected(self, table: np.ndarray, language: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(language, piece, expected count) of all pieces, for words with a language and a count each."""
        column = np.arange(len(language))
        chances = lambda ids: table[ids, language]
        alpha, beta = np.zeros((2, self.n + 1, len(language)))
        alpha[0] = beta[self.n] = 1
        for (s, e), ids in zip(self.spans, self.ids):
            alpha[e] += alpha[s] * chances(ids)
        for (s, e), ids in sorted(zip(self.spans, self.ids), key=lambda x: -x[0][0]):
            beta[s] += beta[e] * chances(ids)
        whole = np.maximum(alpha[self.n], 1e-300)
        for (s, e), ids in zip(self.spans, self.ids):
            found = alpha[s] * chances(ids) * beta[e] / whole * counts
            some = (found > 0) & (ids < len(table) - 2)
            yield language[some], ids[some], found[some]


def by_length(words: Iterable[str]) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    return groups


class Scorer:
    """Log probabilities of words in every language, remembered up to a bound."""

    def __init__(self, pieces: dict[str, int], table: np.ndarray):
        self.pieces, self.table = pieces, table
        self.most = max(20_000, CACHED_CELLS // max(1, table.shape[1]))
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, self.table.shape[1]))

    def learn(self, words: set[str]) -> None:
        fresh_ = sorted(words.difference(self.rows))
        parts = [self.scores]
        for group in by_length(fresh_).values():
            for i in range(0, len(group), 2000):
                some = group[i : i + 2000]
                alpha = Lattices(self.pieces, some).forward(self.table)[-1]
                parts.append(np.log(np.maximum(alpha, 1e-300)))
                start = len(self.rows)
                self.rows.update(zip(some, range(start, start + len(some))))
        self.scores = np.concatenate(parts)

    def texts(self, texts: list[list[str]]) -> np.ndarray:
        """Sums over the words of each text."""
        if len(self.rows) > self.most:
            self.clear()
        self.learn(set().union(*texts))
        out = np.zeros((len(texts), self.table.shape[1]))
        for i, words in enumerate(texts):
            if words:
                out[i] = self.scores[list(map(self.rows.__getitem__, words))].sum(0)
        return out


class Model:
    """Piece probabilities per language, over the pieces of a vocabulary and one unknown character."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    @classmethod
    def normalised(cls, languages: list[str], counts: np.ndarray) -> Model:
        shares = (counts + SMOOTHING) / (counts + SMOOTHING).sum(0)
        rest = np.repeat([[UNSEEN], [0.0]], max(1, len(languages)), axis=1)[:, : len(languages)]
        return cls(languages, np.concatenate([np.maximum(shares, FLOOR), rest]))


def _word_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, word, n) of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {}
            for language, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(language, Counter()).update(words_of(t))
            rows = [(lang_, w, n) for lang_, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([r[0] for r in rows], pa.string()), "word": pa.array([r[1] for r in rows], pa.string()),
                 "n": pa.array([r[2] for r in rows], pa.int64())}
            )

    source = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias(TEXT))
    return map_arrow(source, run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, lang_col: str, text_col: str, path: str, sample: int = 2000, rounds: int = 3) -> Model:
    """Fit piece probabilities by expectation maximisation on labelled texts.

    About ``sample`` different texts of each language are used, chosen by their hash. Words are
    counted by Spark, each round sums the expected counts of the pieces over all segmentations on
    the executors, and the driver gets one number per language and piece (32,000 pieces at most, so
    the table of a hundred languages has 26 MB).
    """
    spark = docs.sparkSession
    labelled = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("body")).where(
        "lang is not null and body is not null"
    )
    labelled = labelled.withColumn("hash", F.xxhash64("body"))
    # Copies of a text count once, so that no text rules the model and the sample has the size it should.
    sizes = {r["lang"]: r["count"] for r in labelled.select("lang", "hash").distinct().groupBy("lang").count().collect()}
    languages, pieces = sorted(sizes), vocabulary(path)
    if not languages:
        return Model([], np.zeros((len(pieces) + 2, 0)))
    limits = F.create_map(*(F.lit(x) for lang in languages for x in (lang, int(min(1.0, sample / sizes[lang]) * (1 << 30)))))
    chosen = labelled.where(F.pmod("hash", F.lit(1 << 30)) < F.element_at(limits, F.col("lang")))
    chosen = chosen.groupBy("lang", "hash").agg(F.min("body").alias("body"))
    counted = stage(_word_counts(chosen, "lang", "body"), "lang-words")
    number = {lang: i for i, lang in enumerate(languages)}
    model = Model.normalised(languages, np.ones((len(pieces), len(languages))))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model.table)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, table = vocabulary(path), shared.value
            sums = np.zeros((len(pieces), len(number)))
            for batch in batches:
                lang, word, n = (batch.column(i).to_pylist() for i in range(3))
                places: dict[int, list[int]] = {}
                for i, w in enumerate(word):
                    places.setdefault(len(w), []).append(i)
                for group in places.values():
                    lattices = Lattices(pieces, [word[i] for i in group])
                    language = np.array([number[lang[i]] for i in group])
                    counts = np.array([n[i] for i in group], float)
                    for a, b, c in lattices.expected(table, language, counts):
                        np.add.at(sums, (b, a), c)
            piece, language = np.nonzero(sums)
            yield pa.RecordBatch.from_pydict(
                {"language": pa.array(language, pa.int32()), "piece": pa.array(piece, pa.int32()), "n": pa.array(sums[piece, language])}
            )

        sums = map_arrow(counted, run, "language int, piece int, n double").groupBy("language", "piece").agg(F.sum("n").alias("n"))
        counts = np.zeros((len(pieces), len(languages)))
        for language, piece, n in sums.collect():
            counts[piece, language] = n
        model = Model.normalised(languages, np.round(counts, 6))
    return model


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str, path: str) -> DataFrame:
    """The columns ``keep``, lang_pred and score of every row; see ``identify``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        scorer = Scorer(vocabulary(path), model.table)

        def judge(words: list[str], sums: np.ndarray) -> tuple[str, float]:
            if not model.languages or not has_letter(words):
                return UNKNOWN, 0.0
            best = int(sums.argmax())
            return model.languages[best], float(1 / np.exp(sums - sums[best]).sum())

        def run(texts: list[bytes | None]):
            found = []
            for i in range(0, len(texts), 500):
                words = [words_of((t or b"").decode("utf-8", "replace")) for t in texts[i : i + 500]]
                found += map(judge, words, scorer.texts(words))
            return [f[0] for f in found], [f[1] for f in found]

        return run

    return from_texts(docs, text_col, keep, "lang_pred string, score double", make)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    model_path: str | None = None,
    sample: int = 2000,
) -> DataFrame:
    """Per row: ``id_col``, held_out, lang_pred (a language learned, or ``und``) and score (0 to 1).

    Rows whose crc32(id as text) leaves 2 modulo 4 are held out: their language is never read.
    Languages are learned from the others that have an id, a text and a language. A text gets the
    language under which its words are most probable; the score is the probability of that
    language among all learned ones, taken as equally likely before. Null texts and texts without a
    letter, and all texts if nothing was learned, are ``und`` with score 0. Of equally probable
    languages the first in alphabetical order is taken. Null ids stay and aren't held out, repeated
    rows give repeated results, an empty table gives an empty result, other columns are not read.
    """
    path = model_path or public_tokenizers.path(MODEL)
    rest = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))
    model = fit(docs.where(rest != 2), lang_col, text_col, path, sample)
    held = fresh(docs, "held_out")
    marked = docs.select(id_col, text_col, F.coalesce(rest == 2, F.lit(False)).alias(held))
    found = predict(marked, model, [id_col, held], text_col, path)
    return found.withColumnRenamed(held, "held_out")
