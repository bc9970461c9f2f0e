"""Benchmark passages in documents, found by spaced seeds and checked by aligned overlap."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import TEXT, arrow_fields, fresh, map_arrow

#: Scripts written without blanks between words; each of their characters is a token.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
RUNS, HAS_UNSPACED = re.compile(r"\w+"), re.compile(f"[{UNSPACED}]")
TOKEN = re.compile(rf"[^\W{UNSPACED}]+|(?=\w)[{UNSPACED}]")
BOUNDARY = re.compile(r"\W")
MOST_MASKS = 6
PART = 1 << 20  # characters of a text that are compared at a time
PAIRS = 1 << 20  # meeting seeds that are held at a time
TOGETHER = 1 << 16  # tokens of texts that are compared at once


def tokens(lowered: str) -> list[str]:
    return (TOKEN if HAS_UNSPACED.search(lowered) else RUNS).findall(lowered)


def parts(text: str) -> Iterator[list[str]]:
    """The tokens of ``text``, from about PART characters at a time."""
    text, at = text.lower(), 0
    while at < len(text):
        end = BOUNDARY.search(text, at + PART) if at + PART < len(text) else None
        stop = end.start() if end else len(text)
        yield tokens(text[at:stop])
        at = stop


@lru_cache(maxsize=64)
def masks(width: int, misses: int) -> tuple[str, ...]:
    """Masks that lose nothing: however ``misses`` of ``width`` tokens are replaced, one of them fits where it skips all of these.

    Drawn from a fixed seed, the heaviest that take MOST_MASKS at most. Each mask that is added covers
    the most patterns of replaced tokens that are left, until none is.
    """
    patterns = np.array([sum(1 << i for i in c) for c in combinations(range(width), misses)], np.int64)
    for weight in range(width, 1, -1):
        rng, found = np.random.default_rng(width * 100 + weight), {((1 << weight) - 1, weight)}
        for _ in range(400 if 2 < weight < width else 0):
            span = int(rng.integers(weight, max(weight, width - 2) + 1))
            inner = rng.choice(np.arange(1, span - 1), weight - 2, replace=False)
            found.add((1 | 1 << span - 1 | sum(1 << int(i) for i in inner), span))
        tried = sorted(found)
        covers = np.stack([np.any([patterns & m << o == 0 for o in range(width - span + 1)], axis=0) for m, span in tried])
        left, chosen = np.ones(len(patterns), bool), []
        while left.any() and len(chosen) < MOST_MASKS:
            best = int((covers & left).sum(axis=1).argmax())
            chosen.append(f"{tried[best][0]:b}")
            left &= ~covers[best]
        if not left.any():
            return tuple(chosen)
    return ("1",)


FACTORS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) | 1 for i in range(1, 65)], np.uint64)


def seeds(ids: np.ndarray, mask: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the seeds of ``ids`` under ``mask``; token 0 stands for any other and ends a seed."""
    places = [i for i, c in enumerate(mask) if c == "1"]
    for p in places:
        starts = starts[ids[starts + p] > 0]
    hashes = np.zeros(len(starts), np.uint64)
    for factor, p in zip(FACTORS, places, strict=False):
        hashes += ids[starts + p].astype(np.uint64) * factor
    return starts, hashes ^ (hashes >> np.uint64(31))


class Seeds:
    """The seeds of all items that are compared over ``width`` tokens, ``misses`` of which may differ."""

    def __init__(self, width: int, misses: int, items: list[tuple[int, np.ndarray]]):
        self.width, self.least = width, width - misses
        self.tables = []
        for mask in masks(width, misses):
            found = [(i, *seeds(ids, mask, np.arange(len(ids) - len(mask) + 1))) for i, ids in items]
            hashes = np.concatenate([f[2] for f in found])
            owner = np.concatenate([np.full(len(f[1]), f[0]) for f in found])
            order = np.argsort(hashes, kind="stable")
            self.tables.append((mask, hashes[order], owner[order], np.concatenate([f[1] for f in found])[order]))

    def hits(self, ids: np.ndarray, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(items, starts in ``ids``, places in the item) of the seeds in common.

        ``known`` counts the tokens that occur in the benchmark: only windows with enough of them are looked at.
        """
        enough = known[self.width :] - known[: -self.width] >= self.least
        if not enough.any():
            return
        windows = np.r_[0, np.cumsum(enough)]
        shortest = min(len(t[0]) for t in self.tables)
        at = np.arange(len(ids) - shortest + 1)
        near = at[windows[np.minimum(at, len(enough) - 1) + 1] > windows[np.maximum(at - (self.width - shortest), 0)]]
        for mask, hashes, owner, place in self.tables:
            start, own = seeds(ids, mask, near[near <= len(ids) - len(mask)])
            low = np.searchsorted(hashes, own, "left")
            count = np.searchsorted(hashes, own, "right") - low
            start, low, count = start[count > 0], low[count > 0], count[count > 0]
            if not len(start):
                continue
            cuts = np.searchsorted(np.cumsum(count) // PAIRS, np.arange(int(count.sum()) // PAIRS + 2))
            for a, b in zip(cuts[:-1], cuts[1:]):
                s, lo, n = start[a:b], low[a:b], count[a:b]
                met = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                yield owner[met], np.repeat(s, n), place[met]


class Index:
    """Benchmark items as token numbers, and their seeds by the width that they are compared over."""

    def __init__(self, items: list[tuple[object, str]], window: int, share: float, least: int):
        self.window = window
        self.vocabulary: dict[str, int] = {}
        self.names, self.items, self.shares = [], [], []
        widths: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for name, text in items:
            words = tokens((text or "").lower())
            if not words:
                continue
            number = self.vocabulary.setdefault
            ids = np.array([number(w, len(self.vocabulary) + 1) for w in words], np.int64)
            width, own = min(window, len(ids)), share if len(ids) >= least else 1.0
            misses = sum(1 for k in range(1, width + 1) if (width - k) / width >= own)
            widths.setdefault((width, misses), []).append((len(self.items), ids))
            self.names.append(name)
            self.items.append(ids)
            self.shares.append(own)
        self.seeds = [Seeds(*key, own) for key, own in sorted(widths.items())]

    def overlap(self, ids: np.ndarray, item: int, diagonal: int) -> float:
        """Largest share of equal tokens in an aligned window."""
        own = self.items[item]
        begin, end = max(0, -diagonal), min(len(own), len(ids) - diagonal)
        width = min(self.window, len(own))
        if end - begin < width:
            return 0.0
        same = np.cumsum(np.r_[0, ids[begin + diagonal : end + diagonal] == own[begin:end]])
        return int((same[width:] - same[:-width]).max()) / width

    def _compare(self, found: list[dict], owners: list[int], texts: list[np.ndarray]) -> None:
        """Compare several parts of texts at once, with gaps between them that no window can cross."""
        sizes = np.array([len(t) + self.window for t in texts])
        begins = np.cumsum(sizes) - sizes
        ids = np.zeros(sizes.sum(), np.int64)
        for text, at in zip(texts, begins.tolist()):
            ids[at : at + len(text)] = text
        known = np.r_[0, np.cumsum(ids > 0)]
        met, longest = np.zeros(0, np.int64), max(map(len, self.items), default=0)
        span = longest + int(sizes.max())
        for group in self.seeds:
            for item, start, place in group.hits(ids, known):
                text = np.searchsorted(begins, start, "right") - 1
                diagonal = start - begins[text] - place  # the document's place less the item's
                met = np.union1d(met, (text * len(self.items) + item) * span + diagonal + longest)
        for both, diagonal in zip((met // span).tolist(), (met % span - longest).tolist()):
            text, item = divmod(both, len(self.items))
            name, result = self.names[item], found[owners[text]]
            if result.get(name, 0) < 1 and (share := self.overlap(texts[text], item, diagonal)) >= self.shares[item]:
                result[name] = max(result.get(name, 0), share)

    def find(self, texts: Iterator[str]) -> list[dict[object, float]]:
        """For each text its items with their largest overlap by id.

        Parts of a text overlap by all but one token of a window, so each window is in one of them.
        """
        found, owners, waiting, size = [], [], [], 0
        for text in texts:
            found.append({})
            before = np.zeros(0, np.int64)
            for words in parts(text):
                ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
                ids = np.concatenate([before, ids]) if len(before) else ids
                before = ids[max(0, len(ids) - self.window + 1) :]
                owners.append(len(found) - 1)
                waiting.append(ids)
                size += len(ids)
                if size > TOGETHER:
                    self._compare(found, owners, waiting)
                    owners, waiting, size = [], [], 0
        if waiting:
            self._compare(found, owners, waiting)
        return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_bytes`` of text; items without id or text are left out."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).where(
        "item is not null and text is not null"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for b in range(n):
        yield [tuple(r) for r in items.where(block == b).distinct().collect()]


#: Blocks that one pass over the documents takes in turn, and bytes of documents that wait for the next block.
PASS, WAITING = 16, 32 << 20


def _search(found: DataFrame, body: str, items: str, overlaps: str, blocks: list, options: tuple) -> DataFrame:
    """Add what the ``blocks`` have to the columns ``items`` and ``overlaps`` of all rows; one block is open at a time."""
    schema = found.schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    fields = arrow_fields(ddl)
    at = {n: schema.names.index(n) for n in (body, items, overlaps)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: list[tuple[int, Index]] = []

        def index(i: int) -> Index:
            if not opened or opened[0][0] != i:
                opened[:] = []
                opened.append((i, Index(blocks[i].value, *options)))
            return opened[0][1]

        def searched(waiting: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            results = [
                [dict(zip(*r)) for r in zip(batch.column(at[items]).to_pylist(), batch.column(at[overlaps]).to_pylist())]
                for batch in waiting
            ]
            for i in sorted(range(len(blocks)), key=lambda i: not opened or opened[0][0] != i):  # the open one first
                for batch, rows in zip(waiting, results):
                    texts = ((t.as_py() or b"").decode("utf-8", "replace") for t in batch.column(at[body]))
                    for result, new in zip(rows, index(i).find(texts)):
                        for name, share in new.items():
                            result[name] = max(result.get(name, 0), share)
            for batch, rows in zip(waiting, results):
                pairs = [sorted(r.items()) for r in rows]
                columns = list(batch.columns)
                columns[at[items]] = pa.array([[p[0] for p in r] for r in pairs], fields[at[items]].type)
                columns[at[overlaps]] = pa.array([[p[1] for p in r] for r in pairs], fields[at[overlaps]].type)
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if len(blocks) == 1 or size > WAITING:
                yield from searched(waiting)
                waiting, size = [], 0
        yield from searched(waiting)

    return map_arrow(found, run, ddl)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 20,
    share: float = 0.8,
    least: int = 8,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """Per row: the columns ``keep``, contaminated, item_ids (ascending) and overlaps (the largest of each id).

    A document holds an item if, aligned without gaps, at least ``share`` of the tokens in some
    ``window`` consecutive tokens of the item (in all of a shorter item) are equal; an item of fewer
    than ``least`` tokens must be there as it is. Tokens are lower-case runs of letters and digits, and
    single characters of scripts that put no blanks between words. Candidates are alignments in which
    document and item share a seed: equal hashes under one of the ``masks`` for their width, which skip
    positions. Every way to replace as many tokens as the rule allows leaves one of these seeds, so no
    alignment that meets the rule is lost; all are then counted token by token.

    The hashes of the items are the small side of this join. Items are broadcast in blocks of about
    ``block_bytes`` of text; a worker opens one block after the other for the documents that it has,
    so its memory does not grow with the benchmark, and one pass over the documents takes PASS blocks.
    Null or empty texts, and all documents when the benchmark is empty, are clean; items that are
    null or have no token are left out; repeated rows give repeated results; other columns are not read.
    """
    spark = docs.sparkSession
    body = fresh(docs, TEXT)
    kind = benchmark.schema[item_col].dataType.simpleString()
    items, overlaps = fresh(docs, "item_ids_"), fresh(docs, "overlaps_")
    found = docs.select(
        *keep, F.col(text_col).cast("string").cast("binary").alias(body),
        F.array().cast(f"array<{kind}>").alias(items), F.array().cast("array<double>").alias(overlaps),
    )
    blocks = []
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        if len(blocks) == PASS:
            found, blocks = _search(found, body, items, overlaps, blocks, (window, share, least)), []
        blocks.append(spark.sparkContext.broadcast(block))
    found = _search(found, body, items, overlaps, blocks, (window, share, least))
    return found.select(*keep, (F.size(items) > 0).alias("contaminated"), F.col(items).alias("item_ids"), F.col(overlaps).alias("overlaps"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with their columns, in which ``find_leaks`` finds no benchmark item."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    judged = find_leaks(plain, benchmark, list(names.values()), names[text_col], **options)
    return judged.where(~F.col("contaminated")).select(*(F.col(n).alias(c) for c, n in names.items()))
