"""Exact removal of repeated byte strings by suffix arrays over content-defined shards.

Any two equal strings of 100 bytes contain the same grams at the same places, and so the same
smallest gram hash, their anchor. Every text is cut into pieces: the longest runs of windows with one
anchor. Equal windows always lie in pieces with equal anchors, so only these have to meet. Of equal
pieces only the earliest goes on, the others are repeats as a whole; a piece whose anchor no other
piece has can't hold a repeat. What is left, different pieces with one anchor, is sorted by suffix
arrays with common prefixes; where they fill several arrays, the arrays are merged by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import TEXT, arrow_fields, map_arrow
from lumbung.session import stage

GRAM = 24
CHUNK = 1 << 19  # bytes of text that are cut into pieces at a time
BLOCK = 1 << 19  # bytes of pieces in one suffix array
SHARD = 8 << 20  # bytes of text for one shard
SENT = 10 << 20  # bytes of pieces, 48 each, that a task gathers before it sends those that differ
MOST_HOT = 2_000_000  # hot anchors at most, 16 MB
PLACE = np.uint64((1 << 28) - 1)
BASE = 0x9E3779B97F4A7C15 | 1
MASK64 = (1 << 64) - 1


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 1 << 64, (2, 256), np.uint64, endpoint=False)


class _Powers:
    """Powers of BASE and of its inverse modulo 2 ** 64, made as far as needed."""

    size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.size < n:
            self.size = max(n, CHUNK + (1 << 18))
            both = []
            for b in (BASE, pow(BASE, -1, 1 << 64)):
                steps = np.full(self.size, b, np.uint64)
                steps[0] = 1
                both.append(np.cumprod(steps, dtype=np.uint64))
            self.powers, self.inverse = both
        return self.powers[:n], self.inverse[:n]


_powers = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(values: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hashes of all grams, from halves of doubling length."""
    power = lambda n: np.uint64(pow(BASE, n, 1 << 64))
    size, done, total, rest = 1, 0, None, gram
    while rest:
        if rest & 1:
            if total is None:
                total, done = values, size
            else:
                n = len(total) - size
                total, done = total[:n] * power(size) + values[done : done + n], done + size
        rest >>= 1
        if rest:
            values = values[:-size] * power(size) + values[size:]
            size *= 2
    return _mix(total)


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    over = width - size
    return np.minimum(keys[: len(keys) - over], keys[over:]) if over else keys


class Pieces:
    """The pieces of some texts: anchor hash h, content hash s, text, start and number of windows."""

    def __init__(self, texts: list[bytes], length: int, hot: np.ndarray):
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        n = len(data) - length + 1
        empty = np.zeros(0, np.int64)
        self.h = self.s = empty.view(np.uint64)
        self.text = self.start = self.windows = empty
        if n <= 0:
            return
        values = _table()[0][data]
        hashes = gram_hashes(values, GRAM)
        places = np.arange(len(hashes), dtype=np.uint64)
        anchor = (smallest(hashes & ~PLACE | places, length - GRAM + 1) & PLACE).astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)[:n]
        valid = np.arange(n) + length <= ends[owner]
        new = valid.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(new)
        if not len(starts):
            return
        # A run ends where the next one begins, or with the last window of its text.
        last = ends[owner[starts]] - length + 1
        windows = np.minimum(np.r_[starts[1:], n], last) - starts
        h = hashes[anchor[starts]]
        loose = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h if len(hot) else np.zeros(len(h), bool)
        if loose.any():  # each window of a hot anchor becomes a piece with an anchor of its own
            count = np.where(loose, windows, 1)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            single = np.repeat(loose, count)
            starts, windows, h = np.repeat(starts, count) + offset, np.repeat(windows, count), np.repeat(h, count)
            windows[single] = 1
        stop = starts + windows + length - 1
        self.s = self._content(values, starts, stop) ^ _mix(windows.astype(np.uint64))
        if loose.any():
            other = self._content(_table()[1][data], starts[single], stop[single])
            h = h.copy()
            h[single] = other
        self.h, self.windows, self.text = h, windows, owner[starts]
        self.start = starts - np.r_[0, ends][self.text]

    @staticmethod
    def _content(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        powers, inverse = _powers.upto(len(values))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers, dtype=np.uint64)])
        return _mix((sums[stops] - sums[starts]) * inverse[starts])


def first_of_equal(h, s, *order) -> tuple[np.ndarray, np.ndarray]:
    """Sort by (h, s, order); the permutation, and which rows come first among equal (h, s)."""
    at = np.lexsort((*reversed(order), s, h))
    first = np.ones(len(at), bool)
    first[1:] = (h[at][1:] != h[at][:-1]) | (s[at][1:] != s[at][:-1])
    return at, first


def _batch(columns: dict[str, np.ndarray], fields: list[pa.Field]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in fields], names=[f.name for f in fields])


def _slices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(doc, row, offset, bytes) of texts with columns doc, row and text; a long text comes in slices that share no window."""
    for batch in batches:
        for i in range(0, batch.num_rows, 100):
            part = batch.slice(i, 100)
            for doc, row, text in zip(*(part.column(c).to_pylist() for c in range(3))):
                if text is not None and len(text) >= length:
                    for at in range(0, len(text) - length + 1, CHUNK):
                        yield doc, row, at, text[at : at + CHUNK + length - 1]


def _cut_up(batches: Iterator[pa.RecordBatch], length: int, hot: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """The pieces of chunks of about CHUNK bytes, as columns h, s, doc, row, start and stop."""

    def cut(slices: list[tuple]) -> dict[str, np.ndarray]:
        p = Pieces([x[3] for x in slices], length, hot)
        doc, row, offset = (np.array([x[i] for x in slices], np.int64)[p.text] for i in range(3))
        start = p.start + offset
        return {"h": p.h, "s": p.s, "doc": doc, "row": row, "start": start, "stop": start + p.windows + length - 1}

    waiting, size = [], 0
    for piece in _slices(batches, length):
        waiting.append(piece)
        size += len(piece[3])
        if size >= CHUNK:
            yield cut(waiting)
            waiting, size = [], 0
    if waiting:
        yield cut(waiting)


REPEAT = "doc bigint, row bigint, start int, stop int"


def joined(doc: np.ndarray, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """The spans (doc, row, start, stop), those that overlap or touch in one row as one; a span that starts later also ends later."""
    at = np.lexsort((start, row, doc))
    d, r, a, b = doc[at], row[at], start[at], stop[at]
    new = np.r_[True, (d[1:] != d[:-1]) | (r[1:] != r[:-1]) | (a[1:] > b[:-1])][: len(at)]
    last = np.r_[new[1:], True][: len(at)]
    return [d[new], r[new], a[new], b[last]]


def find_pieces(keyed: DataFrame, length: int, hot: np.ndarray, shards: int) -> DataFrame:
    """Rows (shard, blob): repeats among the pieces that a task has gathered (shard -1), and the packed pieces of a shard.

    Of equal pieces gathered only the earliest is sent, so a passage that a third of all texts share
    costs one piece in some hundred thousand, not one per text. Repeats that touch are one row, so
    the windows of a hot anchor, each a piece, give a row for each stretch and not for each byte.
    """
    ddl = "shard int, blob binary"
    fields, shared = arrow_fields(ddl), keyed.sparkSession.sparkContext.broadcast(hot)

    def send(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        p = {name: np.concatenate([x[name] for x in parts]) for name in parts[0]}
        at, first = first_of_equal(p["h"], p["s"], p["doc"], p["row"], p["start"])
        again, at = at[~first], at[first]
        blobs = [(-1, pack(*joined(*(p[c][again] for c in ("doc", "row", "start", "stop")))))] if len(again) else []
        shard = (p["h"][at] % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        at, shard = at[order], shard[order]
        bounds = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(shard)]
        columns = [p[c][at].view(np.int64) for c in ("h", "s", "doc", "row", "start", "stop")]
        blobs += [(int(shard[a]), pack(*(c[a:b] for c in columns))) for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.RecordBatch.from_arrays([pa.array([b[i] for b in blobs], f.type) for i, f in enumerate(fields)], names=["shard", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for part in _cut_up(batches, length, shared.value):
            if len(part["h"]):
                parts.append(part)
                size += 48 * len(part["h"])
            if size >= SENT:
                yield send(parts)
                parts, size = [], 0
        if parts:
            yield send(parts)

    return map_arrow(keyed, run, ddl)


def pack(*columns: np.ndarray) -> bytes:
    return np.concatenate([c.astype(np.int64) for c in columns]).tobytes()


def unpack(blobs: list[bytes], n: int) -> list[np.ndarray]:
    parts = [np.frombuffer(b, np.int64).reshape(n, -1) for b in blobs]
    return list(np.concatenate(parts, axis=1)) if parts else [np.zeros(0, np.int64)] * n


SETTLED = "doc bigint, row bigint, start int, stop int, h bigint"


def settle_pieces(found: DataFrame) -> DataFrame:
    """(doc, row, start, stop, h): spans that are repeats as a whole (h null), and pieces to be compared with others of anchor h.

    Repeats of a shard that touch are one span.
    """
    fields = arrow_fields(SETTLED)

    def settle(shard: int, blobs: list[bytes]) -> pa.RecordBatch:
        if shard < 0:
            doc, row, start, stop = unpack(blobs, 4)
            return _batch({"doc": doc, "row": row, "start": start, "stop": stop, "h": np.ma.masked_all(len(row), np.int64)}, fields)
        h, s, doc, row, start, stop = unpack(blobs, 6)
        at, first = first_of_equal(h, s, doc, row, start)
        again, kept = at[~first], at[first]
        shared = h[kept][1:] == h[kept][:-1]
        open_ = kept[np.r_[False, shared] | np.r_[shared, False]]
        spans = joined(*(c[again] for c in (doc, row, start, stop)))
        both = [np.concatenate([span, c[open_]]) for span, c in zip(spans, (doc, row, start, stop))]
        mark = np.ma.array(np.concatenate([np.zeros(len(spans[0]), np.int64), h[open_]]), mask=np.arange(len(both[0])) < len(spans[0]))
        return _batch({**dict(zip(("doc", "row", "start", "stop"), both)), "h": mark}, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != current or shard < 0:
                    if blobs:
                        yield settle(current, blobs)
                    current, blobs = shard, []
                blobs.append(blob)
        if blobs:
            yield settle(current, blobs)

    local = found.where("shard < 0")
    shards = found.where("shard >= 0").repartition("shard").sortWithinPartitions("shard")
    return map_arrow(local, run, SETTLED).union(map_arrow(shards, run, SETTLED))


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order: by their first eight bytes, then by Larsson-Sadakane refinement.

    Sorted groups keep the number of their first place; each round sorts the members of unsorted
    groups by the group that follows ``depth`` bytes later, and doubles the depth.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    first = np.zeros(n, np.uint64)
    for i in range(8):
        first = first << np.uint64(8) | padded[i : i + n].astype(np.uint64)
    order = np.argsort(first)
    new = np.r_[True, first[order][1:] != first[order][:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    # Zero padding ties with zero bytes of the text; a shorter suffix must come first, which the next rounds settle.
    depth = 8
    if n < 8 or not data[-8:].all():
        rank[:n], depth = np.unique(data, return_inverse=True)[1], 1
        order = np.argsort(rank[:n])
        new = np.r_[True, rank[order][1:] != rank[order][:-1]]
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        size = np.diff(np.r_[np.flatnonzero(new), n])
        unsorted = np.flatnonzero(np.repeat(size > 1, size))
        if not len(unsorted):
            return order
        members = order[unsorted]
        key = rank[members] * (n + 1) + rank[np.minimum(members + depth, n)] + 1
        at = np.argsort(key)
        order[unsorted] = members[at]
        key = key[at]
        split = np.r_[True, key[1:] != key[:-1]]
        new[unsorted] = split
        rank[order[unsorted]] = unsorted[np.maximum.accumulate(np.where(split, np.arange(len(unsorted)), 0))]
        depth *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in order, the bytes it shares with the one before, counted up to ``most``.

    Kasai's walk: the next suffix of a text shares at least one byte less than this one did. All
    stretches (``starts``, ``lengths``) of the data are walked side by side.
    """
    n = len(data)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    shared = np.zeros(n, np.int64)
    padded = np.append(data, np.uint8(0))
    h = np.zeros(len(starts), np.int64)
    for step in range(int(lengths.max(initial=0))):
        lane = np.flatnonzero(lengths > step)
        here = starts[lane] + step
        rank = place[here]
        lane, here, rank = lane[rank > 0], here[rank > 0], rank[rank > 0]
        before = order[rank - 1]
        own = np.maximum(h[lane] - 1, 0)
        active = np.arange(len(lane))
        while len(active):
            a, b, c = here[active], before[active], own[active]
            more = (c < most) & (a + c < n) & (b + c < n)
            more &= padded[np.minimum(a + c, n)] == padded[np.minimum(b + c, n)]
            active = active[more]
            own[active] += 1
        h[:] = 0
        h[lane] = own
        shared[rank] = own
    return shared


class Block:
    """One suffix array over pieces (h, doc, row, start, bytes), which come in order of h and place."""

    def __init__(self, pieces: list[tuple], length: int):
        self.data = np.frombuffer(b"".join(p[4] for p in pieces), np.uint8)
        self.length = length
        self.h, doc, row, start = (np.array([p[i] for p in pieces], np.int64) for i in range(4))
        sizes = np.array([len(p[4]) for p in pieces])
        begins = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(pieces)), sizes)
        offset = np.arange(len(self.data)) - begins[owner]
        order = suffix_array(self.data)
        shared = common_prefixes(self.data, order, begins, sizes, length)
        group = np.empty(len(self.data), np.int64)
        group[order] = np.cumsum(shared < length)
        window = np.flatnonzero(offset <= sizes[owner] - length)
        # A piece that comes before another in the block also does so in the table, so places compare like texts.
        at = np.lexsort((window, group[window]))
        window = window[at]
        again = np.r_[False, group[window][1:] == group[window][:-1]] if len(window) else np.zeros(0, bool)
        self.first, self.again = window[~again], window[again]
        self.owner, self.doc, self.row, self.place = owner, doc[owner], row[owner], start[owner] + offset

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """Two hashes of each window, as records that sort."""
        out = np.empty(len(windows), [("a", np.uint64), ("b", np.uint64)])
        for name, table in zip("ab", _table()):
            out[name] = Pieces._content(table[self.data], windows, windows + self.length)
        return out


class Merger:
    """Blocks of one shard in turn; an anchor whose pieces fill several blocks is merged over them by binary search."""

    def __init__(self, length: int):
        self.length, self.h, self.seen = length, None, np.zeros(0, [("a", np.uint64), ("b", np.uint64)])

    def repeats(self, pieces: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(doc, row, start) of the windows that equal an earlier one in this block or in those before."""
        block = Block(pieces, self.length)
        found = [block.again]
        anchor = block.h[block.owner[block.first]]
        if len(self.seen) and block.h[0] == self.h:
            own = block.first[anchor == self.h]
            keys = block.keys(own)
            at = np.minimum(np.searchsorted(self.seen, keys), len(self.seen) - 1)
            found.append(own[self.seen[at] == keys])
        last = block.h[-1]
        keys = block.keys(block.first[anchor == last])
        self.seen = np.union1d(self.seen, keys) if last == self.h else np.sort(keys)
        self.h = last
        windows = np.concatenate(found)
        return block.doc[windows], block.row[windows], block.place[windows]


def compare_pieces(pieces: DataFrame, length: int) -> DataFrame:
    """(doc, row, start, stop): repeated windows among pieces (h, doc, row, start, body) with one anchor."""
    fields = arrow_fields(REPEAT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, merger = [], 0, Merger(length)

        def flush() -> pa.RecordBatch:
            doc, row, at = merger.repeats(waiting)
            order = np.lexsort((at, row, doc))
            d, r, a = doc[order], row[order], at[order]
            if not len(r):
                return _batch({"doc": d, "row": r, "start": a, "stop": a}, fields)
            new = np.r_[True, (d[1:] != d[:-1]) | (r[1:] != r[:-1]) | (a[1:] != a[:-1] + 1)]
            end = np.r_[np.flatnonzero(new)[1:] - 1, len(r) - 1]
            return _batch({"doc": d[new], "row": r[new], "start": a[new], "stop": a[end] + length}, fields)

        for batch in batches:
            for piece in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if size > BLOCK:
                    yield flush()
                    waiting, size = [], 0
                waiting.append(piece)
                size += len(piece[4])
        if waiting:
            yield flush()

    return map_arrow(pieces.repartition("h").sortWithinPartitions("h", "doc", "row", "start"), run, REPEAT)


def hot_anchors(keyed: DataFrame, length: int, sample: int = 4_000, share: float = 0.001, pieces: int = 20) -> np.ndarray:
    """Anchors, in order, with at least this many different pieces in a share of the texts, of ``sample`` texts at least.

    It only decides how work is split, not what is found: windows of a hot anchor are dealt out by
    their own content, and an anchor that is not hot has some ten thousand pieces in all at most.
    Of more than MOST_HOT anchors only those with most pieces are hot, so what is broadcast does not
    grow with the corpus; the others then have more pieces, each anchor's in one task, in blocks.
    """
    total = keyed.count()
    part = min(1.0, max(sample / max(1, total), share))
    chosen = keyed.where(F.pmod(F.xxhash64("doc", "row"), F.lit(1 << 30)) < int(part * (1 << 30)))
    ddl = "h bigint, n bigint"
    fields = arrow_fields(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _cut_up(batches, length, np.zeros(0, np.uint64)):
            at, first = first_of_equal(p["h"], p["s"])
            h, n = np.unique(p["h"][at[first]], return_counts=True)
            yield _batch({"h": h.view(np.int64), "n": n}, fields)

    counts = map_arrow(chosen, run, ddl).groupBy("h").agg(F.sum("n").alias("n"))
    hot = stage(counts.where(F.col("n") >= pieces), "hot-anchors")
    found = 0
    for n, anchors in hot.groupBy("n").count().orderBy(F.desc("n")).collect():
        found += anchors
        if found > MOST_HOT:
            hot = hot.where(F.col("n") > n)
            break
    rows = hot.select("h").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


KEY = ["doc", "row"]


def repeats(base: DataFrame, length: int) -> DataFrame:
    """(doc, row, spans) of the repeated strings of ``base`` (doc, row, __text)."""
    keyed = base.select(*KEY, TEXT)
    size = keyed.agg(F.sum(F.octet_length(TEXT))).first()[0] or 0
    hot = hot_anchors(keyed, length)
    found = find_pieces(keyed, length, hot, max(1, -(-size // SHARD)))
    settled = stage(settle_pieces(found), "settled-pieces")
    whole = settled.where("h is null").select(*KEY, "start", "stop")
    wanted = settled.where("h is not null").groupBy(*KEY).agg(F.collect_list(F.struct("h", "start", "stop")).alias("wanted"))
    texts = keyed.join(wanted, KEY).select(*KEY, TEXT, F.explode("wanted").alias("w"))
    body = F.substring(F.col(TEXT), F.col("w.start") + 1, F.col("w.stop") - F.col("w.start"))
    pieces = texts.select("w.h", *KEY, "w.start", body.alias("body"))
    spans = stage(whole.union(compare_pieces(pieces, length)), "repeated-spans")
    return spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns of ``docs`` as c0, c1, ..., beside doc (the id), row and __text.

    doc and row name a row, the same in every job. row is 0 for an id that occurs once; the rows of
    all others are stored with numbers in the order in which they are read.
    """
    doc = F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-(1 << 63)).cast("bigint"))
    plain = docs.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)), doc.alias("doc"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias(TEXT),
    )
    several = stage(plain.groupBy("doc").count().where("count > 1").select("doc"), "repeated-ids")
    if several.isEmpty():
        return plain.withColumn("row", F.lit(0).cast("bigint"))
    numbered = plain.join(several, "doc", "left_semi").withColumn("row", F.monotonically_increasing_id())
    single = plain.join(several, "doc", "left_anti").withColumn("row", F.lit(0).cast("bigint"))
    return single.unionByName(stage(numbered, "rows-of-repeated-ids"))


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Maximal runs of bytes that ``spans`` cover."""
    runs: list[list[int]] = []
    for start, stop in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return runs


def cut(text: bytes, runs: list[list[int]]) -> bytes:
    kept, at = [], 0
    for start, stop in runs:
        kept.append(text[at:start])
        at = stop
    return b"".join([*kept, text[at:]])


def _cut_texts(base: DataFrame, keep: list[str], length: int, ddl: str, give) -> DataFrame:
    """The columns ``keep`` of ``base`` and what ``give`` makes of a text and its repeated runs."""
    joined = base.join(repeats(base, length), KEY, "left").select(
        *keep, TEXT, F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops")
    )
    schema = ", ".join([f"{c} {base.schema[c].dataType.simpleString()}" for c in keep] + [ddl])
    fields, n = arrow_fields(schema), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(n, n + 3)))
            made = [give(t, merged(list(zip(a or (), b or ())))) for t, a, b in rows]
            columns = list(zip(*made)) or [()] * (len(fields) - n)
            arrays = [batch.column(i) for i in range(n)] + [pa.array(c, f.type) for c, f in zip(columns, fields[n:])]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    return map_arrow(joined, run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Per row: ``id_col``, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256.

    Removed is every byte in a string of ``length`` bytes that also starts earlier: in a row with a
    smaller id, or earlier in the same text. Ids are whole numbers; a null id is smaller than all
    others, rows with one id are taken in the order in which the table is read. Texts are compared
    as UTF-8 bytes and as they were before anything was removed; strings never span two texts. Null
    and empty texts, and those shorter than ``length``, lose nothing. An empty table gives an empty
    result; other columns are not read. ``docs`` should be a stored table (or a projection of one),
    because it is read several times; how it is split into tasks may change in between, as rows are
    told apart by their ids. Rows of ids that occur several times are stored with numbers first.

    Strings are held to be equal if their hashes are: 64 bits of the anchor and 64 of the piece where
    whole pieces meet, 128 bits of the window where an anchor's pieces fill several arrays. Inside an
    array the bytes are compared. The chance that any two of n different pieces pass for equal is
    about n ** 2 / 2 ** 129.
    """

    def give(text: bytes | None, runs: list[list[int]]) -> tuple:
        text = text or b""
        removed = sum(b - a for a, b in runs)
        return len(text), removed, len(runs), hashlib.sha256(cut(text, runs)).hexdigest()

    base = _keyed(docs.select(id_col, text_col), id_col, text_col)
    fields = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return _cut_texts(base, ["c0"], length, fields, give).withColumnRenamed("c0", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """All rows and columns of ``docs``, with the repeated bytes cut out of the texts.

    Where a cut splits a character, what is left of it goes too. A null text stays null.
    """

    def give(text: bytes | None, runs: list[list[int]]) -> tuple:
        return (None if text is None else cut(text, runs).decode("utf-8", "ignore") if runs else text.decode("utf-8", "replace"),)

    names = {f"c{i}": c for i, c in enumerate(docs.columns)}
    keep = [n for n, c in names.items() if c != text_col]
    done = _cut_texts(_keyed(docs, id_col, text_col), keep, length, "kept string", give)
    return done.select(*(F.col("kept" if c == text_col else n).alias(c) for n, c in names.items()))
