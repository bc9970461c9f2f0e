"""Importance resampling towards a target: hashed n-gram gains, Gumbel noise, and exact ranks.

Scores are sorted by regular sampling: each task sorts its rows into runs, keys at regular places of the
runs give the splitters, runs are exchanged in slices between splitters, every segment merges its slices,
and the numbers of rows in the segments before give exact ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import TEXT, arrow_fields, from_texts, map_arrow
from lumbung.session import stage

#: Lower-cases A-Z and turns every ASCII character that is neither a letter nor a digit into a space.
PLAIN = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
CHUNK = 1 << 20  # bytes of text that are split into words at a time
RUN = 1 << 16  # rows of a sorted run
SEGMENT = 1 << 19  # rows of a segment, about
PER_SEGMENT = 32  # regular samples for each segment
MOST_SEGMENTS = 1 << 15  # so the driver gets a million samples at most


# Features and gains


def words_in(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text`` in lists, each from about CHUNK bytes; no word is split over two lists."""
    at = 0
    while at < len(text):
        part = text[at : at + CHUNK].translate(PLAIN)
        if at + CHUNK < len(text):
            end = part.rfind(b" ")
            size = CHUNK
            while end < 0 and at + size < len(text):  # a word longer than the chunk
                size *= 2
                part = text[at : at + size].translate(PLAIN)
                end = part.rfind(b" ")
            if at + size < len(text):
                part = part[: end + 1]
        at += len(part)
        yield part.split()


def feature_buckets(text: bytes, ngrams: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features) of each part of ``text``; features may reach back into the part before."""
    carried: list[bytes] = []
    for words in words_in(text):
        hashes = [np.fromiter(map(crc32, words), np.uint32, len(words))]
        if ngrams > 1:
            both = carried + words
            for n in range(2, ngrams + 1):
                runs = [b" ".join(both[i : i + n]) for i in range(max(0, len(carried) - n + 1), len(both) - n + 1)]
                hashes.append(np.fromiter(map(crc32, runs), np.uint32, len(runs)))
            carried = both[-(ngrams - 1) :]
        yield len(words), np.concatenate(hashes) % np.uint32(buckets)


def bucket_counts(table: DataFrame, text_col: str, ngrams: int, buckets: int) -> np.ndarray:
    """How many features of all texts lie in each bucket; tasks add up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py() or b"", ngrams, buckets):
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    texts = table.select(F.col(text_col).cast("string").cast("binary").alias(TEXT))
    counts = map_arrow(texts, run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for bucket, n in counts.collect():
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket floor(1000 ln(target share / source share)), both shares smoothed by one count a bucket."""
    s_all, t_all = float(source.sum() + len(source)), float(target.sum() + len(target))
    ratio = [(t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def score_documents(
    docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, ngrams: int, seed: int
) -> DataFrame:
    """(id, n_features, n_words, weight, score, tie) of every row: the array of gains is looked up for all features at once."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def make():
        gain = shared.value

        def weigh(text: bytes) -> tuple[int, int, int]:
            n, n_words, total = 0, 0, 0
            for words, found in feature_buckets(text, ngrams, len(gain)):
                n, n_words, total = n + len(found), n_words + words, total + int(gain[found].sum())
            return n, n_words, total // n if n else 0

        return lambda texts: list(zip(*(weigh(t or b"") for t in texts))) or [(), (), ()]

    id_ = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("body"))
    found = from_texts(id_, "body", ["id"], "n_features bigint, n_words bigint, weight bigint", make)
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    return found.withColumn("score", F.col("weight") + noise).withColumn("tie", F.monotonically_increasing_id())


# Sorting by regular sampling

#: Columns of a row while it is sorted; the first KEYS of them, and tie, give the order.
SORTED = ("down", "known", "id", "n_features", "tie", "weight")
KEYS = 5
KEY = np.dtype([(c, np.int64) for c in SORTED[:KEYS]])


def in_order(rows: np.ndarray) -> np.ndarray:
    """``rows`` (one column of SORTED each) sorted; a stable merge sort, so runs that are sorted already are merged."""
    return rows[np.lexsort(rows[:, KEYS - 1 :: -1].T)]


def keys_of(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows[:, :KEYS]).view(KEY).ravel()


def _rows(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(-1, len(SORTED))


def sorted_runs(scored: DataFrame) -> DataFrame:
    """(n, blob): the rows of ``scored`` in sorted runs of RUN rows at most, whatever the size of a partition."""
    known = F.col("id").isNotNull().cast("bigint")
    columns = scored.select(
        (-F.col("score")).alias("down"), known.alias("known"), F.coalesce("id", F.lit(0)).alias("id"), "n_features", "tie", "weight"
    )

    def give(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = in_order(np.concatenate(parts))
        return pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64()), pa.array([rows.tobytes()])], names=["n", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(SORTED))], axis=1).astype(np.int64)
            for at in range(0, len(rows), RUN):
                part = rows[at : at + RUN]
                if parts and size + len(part) > RUN:
                    yield give(parts)
                    parts, size = [], 0
                parts.append(part)
                size += len(part)
        if size:
            yield give(parts)

    return map_arrow(columns, run, "n bigint, blob binary")


def regular_splitters(runs: DataFrame, total: int, segment: int) -> np.ndarray:
    """Keys that cut the rows of all ``runs`` into about equal segments of ``segment`` rows or fewer.

    Every run gives the keys at regular places, as many as make PER_SEGMENT for a segment over all
    runs. Splitters only decide which task sorts what, not the ranks.
    """
    segments = min(MOST_SEGMENTS, max(1, -(-total // segment), min(32, -(-total // 1000))))
    step = max(1, total // (segments * PER_SEGMENT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                chosen = _rows(blob)[step // 2 :: step]
                if len(chosen):
                    yield pa.RecordBatch.from_arrays([pa.array([chosen.tobytes()])], names=["blob"])

    blobs = [r[0] for r in map_arrow(runs.select("blob"), run, "blob binary").collect()]
    if not blobs:
        return np.zeros(0, KEY)
    sample = keys_of(in_order(np.concatenate([_rows(bytes(b)) for b in blobs])))
    return sample[[len(sample) * i // segments for i in range(1, segments)]]


def slices(runs: DataFrame, splitters: np.ndarray, with_rows: bool) -> DataFrame:
    """(segment, n) of the slice of every run between two splitters, and its rows as blob if wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                rows = _rows(blob)
                cuts = np.r_[0, np.searchsorted(keys_of(rows), splitters), len(rows)]
                some = np.flatnonzero(np.diff(cuts))
                columns = {"segment": pa.array(some, pa.int64()), "n": pa.array(np.diff(cuts)[some], pa.int64())}
                if with_rows:
                    columns["blob"] = pa.array([rows[cuts[i] : cuts[i + 1]].tobytes() for i in some.tolist()], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return map_arrow(runs.select("blob"), run, "segment bigint, n bigint" + ", blob binary" * with_rows)


RANKED = "id bigint, n_features bigint, weight bigint, score bigint, rank bigint"


def rank_rows(scored: DataFrame, percent: int, segment: int = SEGMENT) -> DataFrame:
    """(id, n_features, weight, score, rank): ranks 1, 2, ... for the highest ``percent`` of the rows (rounded down), else null.

    Higher scores come first, then smaller ids (null before all others), then fewer features, then
    the place in ``scored``, a stored table whose column tie differs in every row. Rows that share
    a score or an id are cut apart like any others, as the order is total.
    """
    runs = stage(sorted_runs(scored), "sorted-runs")
    total = runs.agg(F.sum("n")).first()[0] or 0
    splitters = regular_splitters(runs, total, segment)
    sizes = np.zeros(len(splitters) + 1, np.int64)
    for i, n in slices(runs, splitters, False).groupBy("segment").agg(F.sum("n")).collect():
        sizes[i] = n
    before, drawn = np.cumsum(sizes) - sizes, percent * total // 100
    fields = arrow_fields(RANKED)

    def merge(number: int, blobs: list[bytes]) -> pa.RecordBatch:
        rows = in_order(np.concatenate([_rows(b) for b in blobs]))
        rank = before[number] + 1 + np.arange(len(rows))
        column = dict(zip(SORTED, rows.T))
        made = (np.ma.array(column["id"], mask=column["known"] == 0), column["n_features"], column["weight"], -column["down"],
                np.ma.array(rank, mask=rank > drawn))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, fields)], names=[f.name for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != current and blobs:
                    yield merge(current, blobs)
                    blobs = []
                current = number
                blobs.append(blob)
        if blobs:
            yield merge(current, blobs)

    exchanged = slices(runs, splitters, True).select("segment", "blob").repartition("segment").sortWithinPartitions("segment")
    return map_arrow(exchanged, run, RANKED)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    ngrams: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    least_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, n_features, weight, score and rank (null if not drawn).

    Features are the runs of 1 to ``ngrams`` consecutive words, hashed into ``buckets``; words are
    runs of lower-cased ASCII letters, digits and all characters beyond ASCII. weight is the floored
    mean of the gains of a document's features, that is by how much more often they occur in
    ``target`` than in ``docs``, in thousandths of the natural logarithm. score adds Gumbel noise that
    depends on ``seed`` and the id alone, so the highest scores are a draw without replacement in
    proportion to exp(weight / 1000). Of the rows with at least ``least_words`` words the highest
    ``percent`` per cent are drawn, ranked by score, then smaller id.

    Ids are whole numbers; a null id counts as smaller than all others and draws its noise from the
    empty text; rows that share an id have the same noise, and those with fewer features come first.
    Null and empty texts have no features, weight 0 and no rank. An empty target leaves only the
    smoothing, an empty table gives an empty result; other columns are not read. Texts are read
    twice, for the counts and for the scores; only ids and numbers are shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    gain = gains(bucket_counts(docs, f"`{text_col}`", ngrams, buckets), bucket_counts(target, f"`{target_text_col}`", ngrams, buckets))
    scored = stage(score_documents(docs, gain, id_col, text_col, ngrams, seed), "scores")
    ranked = rank_rows(scored.where(F.col("n_words") >= least_words), percent)
    short = scored.where(F.col("n_words") < least_words).select(
        "id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank")
    )
    return ranked.union(short).select(F.col("id").cast(kind).alias(id_col), "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, with their columns, whose id ``resample`` draws; rows that share an id come or go together."""
    drawn = resample(docs, target, id_col, **options).where("rank is not null").select(F.col(id_col).alias("drawn_id"))
    drawn = stage(drawn.distinct(), "drawn")
    return docs.join(drawn, F.col(f"`{id_col}`").eqNullSafe(drawn["drawn_id"]), "left_semi")
