"""Near copies by SimHash fingerprints, compared at the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lumbung.llm.arrow import fresh, from_texts, map_arrow
from lumbung.llm.components import components
from lumbung.session import stage

SEED = 42
BITS = 64
#: The anchors are the words of the perfect Hamming code on 63 bits (bit 63 is left out, which only
#: brings fingerprints closer): every fingerprint lies within this distance of exactly one anchor.
COVERING_RADIUS = 1
LENGTH = 63


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, repeats included; 0 without words."""
    words = (text or b"").lower().split()  # both on ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The columns ``keep`` and ``fingerprint`` (a signed long) of every row; see ``fingerprint``."""
    return from_texts(
        docs, text_col, keep, "fingerprint bigint", lambda: lambda texts: [[signed(fingerprint(t, shingle)) for t in texts]]
    )


@lru_cache(maxsize=4)
def _masks(weight: int) -> tuple[np.ndarray, np.ndarray]:
    """All 63-bit patterns of at most ``weight`` ones, and their syndromes, ordered by syndrome."""
    masks, syndromes = [], []
    for w in range(weight + 1):
        for places in combinations(range(LENGTH), w):
            syndrome = 0
            for p in places:
                syndrome ^= p + 1
            masks.append(sum(1 << p for p in places))
            syndromes.append(syndrome)
    order = np.argsort(syndromes, kind="stable")
    return np.array(masks, np.uint64)[order], np.array(syndromes)[order]


def anchors(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the value, anchor) for all anchors within ``radius`` of the 63-bit ``values``.

    The syndrome of a value is the exclusive or of the numbers 1..63 of its one bits, and 0 for
    anchors. Flipping a pattern of bits with the same syndrome therefore leads to an anchor.
    """
    masks, syndromes = _masks(radius)
    bounds = np.searchsorted(syndromes, np.arange(65))
    mine = np.zeros(len(values), np.int64)
    for p in range(LENGTH):
        mine ^= (values >> np.uint64(p) & np.uint64(1)).astype(np.int64) * (p + 1)
    index, found = [], []
    for s in range(64):
        rows = np.flatnonzero(mine == s)
        own = masks[bounds[s] : bounds[s + 1]]
        if len(rows) and len(own):
            index.append(np.repeat(rows, len(own)))
            found.append((values[rows][:, None] ^ own[None]).ravel())
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(index), np.concatenate(found)


def spanning_links(values: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within ``distance`` bits that join the same values as all such links do."""
    rest = values
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            value = queue.pop()
            near = np.bitwise_count(rest ^ value) <= distance
            if near.any():
                found = rest[near]
                yield np.full(len(found), value), found
                queue.extend(found)
                rest = rest[~near]


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links (u > v) that connect the distinct ``fingerprint`` of ``prints`` like all pairs within ``distance`` do.

    Each fingerprint goes to every anchor within the covering radius plus half the distance,
    rounded up: for a pair x, y there is a z halfway between them, and the anchor that covers z is
    that close to both, so every pair meets at some anchor (the full distance would do too, with
    20 times the copies). At an anchor only fingerprints inside a small ball can meet, at most
    ``2 * V(63, radius)`` of them (4034 for distance 2), whatever the data, because equal
    fingerprints have been merged: there are no hot anchors.
    """
    radius = COVERING_RADIUS + -(-distance // 2)
    distinct = prints.select("fingerprint").distinct()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(0, len(values), 4096):
                part = values[i : i + 4096]
                index, anchor = anchors(part.view(np.uint64) & np.uint64((1 << 63) - 1), radius)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(part[index])], names=["anchor", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_a, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def meet(anchor: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            sizes = np.diff(np.r_[starts, len(anchor)])
            two = starts[sizes == 2]
            near = np.bitwise_count(fp[two].view(np.uint64) ^ fp[two + 1].view(np.uint64)) <= distance
            pairs = [(fp[two[near]], fp[two[near] + 1])]
            for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
                pairs += [
                    (a.view(np.int64), b.view(np.int64))
                    for a, b in spanning_links(fp[start : start + size].view(np.uint64), distance)
                ]
            a, b = (np.concatenate(side) for side in zip(*pairs))
            both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["u", "v"])

        for batch in batches:
            anchor = np.concatenate([held_a, batch.column(0).to_numpy()])
            fp = np.concatenate([held_f, batch.column(1).to_numpy()])
            last = np.searchsorted(anchor, anchor[-1]) if len(anchor) else 0
            held_a, held_f = anchor[last:], fp[last:]
            if last:
                yield meet(anchor[:last], fp[:last])
        if len(held_a):
            yield meet(held_a, held_f)

    spreaded = map_arrow(distinct, spread, "anchor bigint, fp bigint")
    sorted_ = spreaded.repartition("anchor").sortWithinPartitions("anchor")
    return map_arrow(sorted_, compare, "u bigint, v bigint").distinct()


def classes(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(fingerprint, root): the smallest fingerprint that each distinct one reaches over links."""
    prints = prints.select("fingerprint").distinct()
    roots = components(links(prints, distance))
    named = prints.join(roots, prints["fingerprint"] == roots["u"], "left")
    return named.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


#: A fingerprint is heavy if at least this many rows and this part of all rows have it, so there are 10,000 of them at most.
HEAVY_ROWS, HEAVY_PART = 1_000, 10_000


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """Per row: ``id_col``, fingerprint (16 hex digits) and component_id, the smallest id reachable over links.

    Texts without words, null ones included, have fingerprint zero and are linked like any other.
    Null ids stay null and are no component's id unless it has no other; repeated rows give repeated
    results; an empty table gives an empty result; other columns are not read. Texts are read whole
    and only once: what follows works on a staged table of ids and fingerprints.
    """
    prints = stage(fingerprints(docs, [id_col], text_col, shingle), "fingerprints")
    least = prints.groupBy("fingerprint").agg(F.min(f"`{id_col}`").alias("least"), F.count(F.lit(1)).alias("n"))
    named = stage(least.join(classes(prints, distance), "fingerprint"), "classes")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = stage(named.select("fingerprint", "root", "n").join(ids, "root").select("fingerprint", "component_id", "n"), "components")
    total = named.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n") >= max(HEAVY_ROWS, total // HEAVY_PART)
    # Rows of heavy fingerprints stay where they are; the others meet their component by fingerprint.
    few = F.broadcast(of_print.where(heavy).select("fingerprint", "component_id"))
    light = prints.join(few, "fingerprint", "left_anti").join(of_print.where(~heavy), "fingerprint").select(*prints.columns, "component_id")
    found = prints.join(few, "fingerprint").select(*prints.columns, "component_id").union(light)
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select(f"`{id_col}`", text, "component_id")


def keep_one(docs: DataFrame, text_col: str = "text", shingle: int = 3, distance: int = 2, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, with their columns, without all but one document of each group of near copies.

    The smallest id stays; of rows that share this id, one with the smallest hash of its columns.
    A group without any id keeps one row in the same way.
    """
    key, comp, mine = fresh(docs, "__key"), fresh(docs, "__component"), fresh(docs, "__id")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn(key, F.xxhash64(*columns, *(c.isNull() for c in columns)))  # nulls alone leave no trace
    prints = stage(fingerprints(keyed, [id_col, key], text_col, shingle).withColumnsRenamed({id_col: mine}), "fingerprints")
    named = classes(prints, distance)
    # One row for each fingerprint comes out of the tasks, however many rows have it.
    order = F.struct(F.col(mine).isNull().alias("none"), mine, key)
    firsts = prints.groupBy("fingerprint").agg(F.min(order).alias("first"))
    best = firsts.join(named, "fingerprint").groupBy("root").agg(F.min("first").alias("best"))
    chosen = stage(best.select(F.col(f"best.{mine}").alias(mine), F.col(f"best.{key}").alias(comp)), "kept")
    kept = keyed.join(chosen, F.col(f"`{id_col}`").eqNullSafe(F.col(mine)) & (F.col(key) == F.col(comp)), "left_semi").drop(key)
    repeated = stage(prints.groupBy(mine, key).count().where("count > 1").select(mine, F.col(key).alias(comp)), "repeated")
    if repeated.isEmpty():
        return kept
    return kept.dropDuplicates()
