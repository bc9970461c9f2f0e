"""Toxicity by a convolutional text classifier over hashed words, with thresholds per language."""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import fresh, from_texts
from lumbung.session import stage

WORD = re.compile(r"\w+")
BUCKETS, EMBEDDING, FILTERS, WIDTHS, STEM = 1 << 15, 16, 8, (1, 2, 3), 4
PAD = max(WIDTHS) - 1
#: Common function words; a text counts as written in the language of which it has most, by its words alone.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it with as was on are by this be or an from",
    "de": "der die und das ist nicht von mit den im zu ein eine auf für dem sich des auch als",
    "fr": "le la les et est des une un du que qui dans pour sur pas au avec ce par plus",
    "es": "el los las de y en que es una un por con para se su como no más lo del",
}
LANGUAGES = (*FUNCTION_WORDS, "other")
SAMPLE_BYTES = 64 << 20  # of bucket numbers, 8 for each word, that the driver trains on at most


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) + 1


class Buckets(dict):
    """Word to its two buckets in one number, that of the word and that of its beginning; 0 pads."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        number = self[word] = _bucket(word) << 32 | _bucket(word[:STEM] + "-")
        return number

    def of(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _votes() -> np.ndarray:
    table = np.zeros((BUCKETS, len(FUNCTION_WORDS)), np.int16)
    for i, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            table[_bucket(w), i] = 1
    return table


def pack(texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All buckets in a row, each text followed by padding, and where the texts start."""
    pad = np.zeros(PAD + 1, np.int64)
    ids = np.concatenate([x for t in texts for x in (t, pad)])
    return ids, np.cumsum([0] + [len(t) + len(pad) for t in texts[:-1]])


@dataclass
class Gradients:
    out: np.ndarray
    offset: float
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    rows: np.ndarray  # of the embedding that have a gradient
    embedding: np.ndarray


@dataclass
class Network:
    """Embeddings, one bank of filters per width, max pooling over the whole text, a logistic layer."""

    embedding: np.ndarray
    filters: list[np.ndarray]  # (width, embedding, filter)
    bias: list[np.ndarray]
    out: np.ndarray
    offset: float
    thresholds: np.ndarray

    @classmethod
    def start(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        embedding = draw(0.1, BUCKETS, EMBEDDING)
        embedding[0] = 0
        return cls(
            embedding,
            [draw(0.3, w, EMBEDDING, FILTERS) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(0.3, FILTERS * len(WIDTHS)),
            -2.0,
            np.zeros(len(LANGUAGES)),
        )

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        """A word is the sum of the embeddings of itself and of its first ``STEM`` letters."""
        return self.embedding[ids >> 32] + self.embedding[ids & 0xFFFFFFFF]

    def convolve(self, ids: np.ndarray) -> list[np.ndarray]:
        """(place, filter) values of every bank; a window starts at its place."""
        n = len(ids) - PAD
        vectors = self.vectors(ids)
        return [
            sum(vectors[j : j + n] @ bank[j] for j in range(len(bank))) + bias
            for bank, bias in zip(self.filters, self.bias)
        ]

    def logits(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        ids, starts = pack(texts)
        # A text's places end with its first padding: windows behind it would reach into the next text.
        ends = np.r_[starts[1:], len(ids)] - PAD
        cuts = np.stack([starts, ends], axis=1).ravel()[:-1]
        pooled = [np.maximum.reduceat(bank, cuts)[::2] for bank in self.convolve(ids)]
        return np.maximum(np.concatenate(pooled, axis=1), 0).astype(float) @ self.out + self.offset

    def gradients(self, texts: Sequence[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> Gradients:
        """Of the weighted logistic loss of ``texts``; a filter's goes to the window with its largest value."""
        ids, starts = pack(texts)
        ends = np.r_[starts[1:], len(ids)] - PAD
        banks = self.convolve(ids)
        where = [np.array([a + bank[a:b].argmax(0) for a, b in zip(starts, ends)]) for bank in banks]
        pooled = np.concatenate([np.take_along_axis(bank, at, 0) for bank, at in zip(banks, where)], axis=1)
        active = np.maximum(pooled, 0)
        logit = active @ self.out + self.offset
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * weight
        back = (error[:, None] * self.out[None] * (pooled > 0)).astype(np.float32)
        filters, bias, rows, changes = [], [], [], []
        for k, (bank, at) in enumerate(zip(self.filters, where)):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            gradient = np.zeros_like(bank)
            for j in range(len(bank)):
                words = ids[at + j]
                gradient[j] = np.einsum("tfe,tf->ef", self.vectors(words), own)
                change = (own[:, :, None] * bank[j].T[None]).reshape(-1, EMBEDDING)
                rows += [words.ravel() >> 32, words.ravel() & 0xFFFFFFFF]
                changes += [change, change]
            filters.append(gradient)
            bias.append(own.sum(0))
        row, inverse = np.unique(np.concatenate(rows), return_inverse=True)
        total = np.zeros((len(row), EMBEDDING), np.float32)
        np.add.at(total, inverse, np.concatenate(changes))
        total[row == 0] = 0  # padding stays zero
        return Gradients(active.T @ error, float(error.sum()), filters, bias, row, total)

    def language(self, texts: Sequence[np.ndarray], votes: np.ndarray) -> np.ndarray:
        ids, starts = pack(texts)
        counts = np.add.reduceat(votes[ids >> 32], starts, dtype=np.int64)
        return np.where(counts.max(1) > 0, counts.argmax(1), len(FUNCTION_WORDS))

    def scores(self, texts: Sequence[np.ndarray], votes: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 at the threshold of the text's language."""
        margin = self.logits(texts) - self.thresholds[self.language(texts, votes)]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def train(
    texts: Sequence[np.ndarray], labels: np.ndarray, seed: int = 5, epochs: int = 8, batch: int = 32, rate: float = 0.05
) -> Network:
    """Fit a network by Adagrad on whole texts; a quarter of them only sets the thresholds.

    Both classes weigh the same. Words are hidden at random, so that no single one decides.
    """
    rng, net = np.random.default_rng(seed), Network.start(seed)
    labels = np.asarray(labels, float)
    order = rng.permutation(len(texts))
    held, used = order[: len(order) // 4], order[len(order) // 4 :]
    rate_bad = labels[used].mean() if len(used) else 0.0
    if not 0 < rate_bad < 1:  # nothing to tell apart
        net.out[:] = 0
        net.offset = float(np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5)))
        return net
    weight = np.where(labels == 1, 0.5 / rate_bad, 0.5 / (1 - rate_bad))
    state = [np.full_like(p, 1e-3) for p in (net.embedding, *net.filters, *net.bias, net.out)]
    moment = 1e-3

    def step(parameter: np.ndarray, past: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        past[at] += gradient**2
        parameter[at] -= rate * gradient / np.sqrt(past[at])

    for _ in range(epochs):
        for part in np.array_split(rng.permutation(used), max(1, len(used) // batch)):
            shown = [np.where(rng.random(len(texts[i])) < 0.1, 0, texts[i]) for i in part]
            g = net.gradients(shown, labels[part], weight[part] / len(part))
            step(net.out, state[-1], (g.out + 1e-4 * net.out).astype(np.float32))
            moment += g.offset**2
            net.offset -= rate * g.offset / np.sqrt(moment)
            for k, (bank, own) in enumerate(zip(net.filters, g.filters)):
                step(bank, state[1 + k], own)
                step(net.bias[k], state[1 + len(WIDTHS) + k], g.bias[k])
            step(net.embedding, state[0], g.embedding, g.rows)
    calibrate(net, [texts[i] for i in held], labels[held])
    return net


def calibrate(net: Network, texts: Sequence[np.ndarray], labels: np.ndarray, least: int = 10) -> None:
    """Set the threshold of each language to the middle of the range of logits with the fewest mistakes.

    Languages with fewer than ``least`` texts of either class share the threshold of all texts.
    """
    if not len(texts):
        return

    def best(logits: np.ndarray, labels: np.ndarray) -> float:
        order = np.argsort(logits, kind="stable")
        values, marks = logits[order], labels[order]
        wrong = np.r_[0, np.cumsum(marks)] + (len(marks) - marks.sum() - np.r_[0, np.cumsum(1 - marks)])
        wrong = np.where(np.r_[True, values[1:] > values[:-1], True], wrong, np.inf)  # equal logits stay together
        edges = np.r_[values[0] - 1, (values[1:] + values[:-1]) / 2, values[-1] + 1]
        fewest = np.flatnonzero(wrong == wrong.min())
        widths = [values[min(i, len(values) - 1)] - values[max(i - 1, 0)] for i in fewest]
        return float(edges[fewest[int(np.argmax(widths))]])

    logits = np.concatenate([net.logits(texts[i : i + 64]) for i in range(0, len(texts), 64)])
    language = net.language(texts, _votes())
    net.thresholds[:] = best(logits, labels) if 0 < labels.mean() < 1 else 0.0
    for i in range(len(LANGUAGES)):
        own = labels[language == i]
        if min(own.sum(), len(own) - own.sum()) >= least:
            net.thresholds[i] = best(logits[language == i], own)


def fitting(sizes: Sequence[tuple], most: int) -> list:
    """Ids of ``sizes`` (id, label, bytes, hash) in the order of their hashes, of each label until ``most`` bytes are full."""
    room: dict[int, int] = {}
    taken = []
    for doc, label, size, _ in sorted(sizes, key=lambda r: (r[3], str(r[0]))):
        if size <= room.get(label, most):
            room[label] = room.get(label, most) - size
            taken.append(doc)
    return taken


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> Network:
    """Train on about ``sample`` labelled texts of each class at most, chosen by a hash of their id.

    Spark picks the labels (the larger one where a document has several), joins them with their texts
    (one where several rows share an id) and hashes the words; the driver gets the bucket numbers of
    that bounded sample and trains on them. Where these are more than SAMPLE_BYTES, fewer texts are
    taken, whole ones, each class up to half of it.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id"))
    known = known.agg(F.max(F.col(label_col).cast("int")).alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes:
        return train([], np.zeros(0))
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, int(min(1.0, sample / n) * (1 << 30)))))
    chosen = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < F.element_at(share, F.col("label")))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("body"))
    joined = texts.join(F.broadcast(chosen), texts["doc"] == chosen["label_id"]).select("doc", "label", "body")

    def make():
        buckets = Buckets()
        return lambda batch: [[buckets.of((t or b"").decode("utf-8", "replace")).tobytes() for t in batch]]

    one = joined.groupBy("doc", "label").agg(F.min(F.struct(F.xxhash64("body").alias("h"), "body")).alias("first"))
    hashed = stage(from_texts(one.select("doc", "label", "first.body"), "body", ["doc", "label"], "words binary", make), "toxicity-sample")
    sizes = hashed.select("doc", "label", F.octet_length("words"), F.xxhash64("doc")).collect()
    taken = fitting([tuple(r) for r in sizes], SAMPLE_BYTES // 2)
    rows = (hashed if len(taken) == len(sizes) else hashed.where(F.col("doc").isin(taken))).collect()
    rows.sort(key=lambda r: (str(r[0]), r[1], bytes(r[2])))
    return train([np.frombuffer(bytes(r[2]), np.int64) for r in rows], np.array([r[1] for r in rows]))


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = 2500,
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, held_out, score (0 to 1) and predicted (1 if score >= 0.5).

    Rows whose crc32(id as text) is divisible by 5 are held out: their labels are never read. Scores
    depend on the text alone; its language, which picks the threshold that becomes 0.5, is told from
    its function words. Null and empty texts are scored like a text without words. Null ids stay,
    aren't held out and have no label; repeated rows give repeated results; without documents the
    result is empty; without usable labels all scores are equal; other columns are not read.
    ``sample`` bounds the training texts of each class.
    """
    rest = lambda c: F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(5))
    net = fit(docs, labels.where(rest(id_col) != 0), id_col, text_col, label_col, sample)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        net, votes, buckets = shared.value, _votes(), Buckets()

        def run(texts: list[bytes | None]):
            found, waiting, size = [], [], 0
            for t in texts:
                waiting.append(buckets.of((t or b"").decode("utf-8", "replace")))
                size += len(waiting[-1])
                if size > 50_000:
                    found += net.scores(waiting, votes).tolist()
                    waiting, size = [], 0
            if waiting:
                found += net.scores(waiting, votes).tolist()
            return [found, [int(s >= 0.5) for s in found]]

        return run

    held = fresh(docs, "held_out")
    marked = docs.select(id_col, text_col, F.coalesce(rest(id_col) == 0, F.lit(False)).alias(held))
    found = from_texts(marked, text_col, [id_col, held], "score double, predicted int", make)
    return found.withColumnRenamed(held, "held_out")
