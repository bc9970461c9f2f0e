"""Token ids in binary shards, with a minimal perfect hash index from document keys to places in them.

A shard is a range of documents in ascending order: their ids one after the other, each document closed
by the end id, then a table of its documents. Spark's text writer writes the files: its line separator is
the end id, so every line is a document and the commit protocol covers lost tasks.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.llm.arrow import arrow_fields, map_arrow
from lumbung.session import stage, stage_path

MODEL = "word_bpe_49k.json"
CACHED_WORDS, CACHED_LENGTH = 500_000, 64
#: Letters that are one character in every normal form and have one lower case, and all that texts without odd words are of.
LETTERS, BLANKS = "A-Za-zÀ-ÖØ-öø-ÿ", r" \t\n\r"
PLAIN = rf"{BLANKS}!-~{LETTERS}"
#: Parts of a tokenizer's pattern, and what they match among these characters.
CLASSES = {r"[\p{L}]": f"[{LETTERS}]", r"[\p{N}]": "[0-9]", r"[^\s\p{L}\p{N}]": r"[!-/:-@\[-`{-~]"}
#: A null id; it comes before all others, which must be larger.
NULL_ID = -(1 << 63)
#: Bytes of text that a document costs beside its own when shards are cut, so shards of short texts are bounded too.
OVERHEAD = 64
MAGIC = b"TOKENIDS"
TAIL = "<8sIIQ"  # magic, shard, documents, ids
PART = 1 << 16  # keys in one part of the index
COPIES = 4096  # rows of one key that are numbered at a time


# Encoding


def ends_words(config: dict) -> bool:
    """Whether white space ends every token of a tokenizer and leaves none: its words can then be encoded one by one."""
    steps = config.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    first = steps[0] if steps else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    alternatives = pattern.split("|")
    blank = r"(\[\\p\{[LN]\}\]\+?|\[\^\\s\\p\{L\}\\p\{N\}\]\+|'[a-z]+)"
    return (
        first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
        and all(re.fullmatch(blank, a) for a in alternatives)
        and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in config.get("added_tokens", []))
    )


def plain_steps(config: dict) -> bool:
    """Whether letters reach the model as they are but for their case: lower-cased, then as characters that stand for bytes."""
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    own = [s["type"] for s in steps if not (s["type"] == "Replace" and s["pattern"].get("Regex") == "\\s+")]
    pieces = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    last = pieces[-1] if len(pieces) == 2 else {}
    return (
        sorted(own) == ["Lowercase", "NFC"] and last.get("type") == "ByteLevel"
        and not last.get("use_regex") and not last.get("add_prefix_space") and not config["model"].get("dropout")
        and not any(t["normalized"] for t in config.get("added_tokens", []))
    )


def piece_patterns(config: dict) -> tuple[re.Pattern, re.Pattern]:
    """What finds the pieces that a tokenizer with plain_steps encodes by themselves: in plain texts, and in all texts.

    In all texts, words with other characters or with added tokens stay whole. Each match takes a blank before it.
    """
    pattern = config["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    # Runs of letters or digits come first, as they are the most; no other alternative begins with these.
    alternatives = sorted(pattern.split("|"), key=lambda a: not a.startswith(r"[\p"))
    own = [CLASSES[a.rstrip("+")] + "+" * a.endswith("+") if a[0] == "[" else f"(?i:{a})" for a in alternatives]
    odd = "|".join([f"[^{PLAIN}]", *(re.escape(t["content"]) for t in config.get("added_tokens", []))])
    whole = rf"(?<![^{BLANKS}])(?=[^{BLANKS}]*?(?:{odd}))[^{BLANKS}]++"
    return re.compile(rf"[{BLANKS}]?({'|'.join(own)})"), re.compile(rf"[{BLANKS}]?({'|'.join([whole, *own])})")


class Words(dict):
    """Ids of words as bytes; a word that is looked up for the first time is encoded, and remembered unless it is long."""

    def __init__(self, encode):
        super().__init__({"": b""})
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts by the tokenizer's library, as bytes; what was seen before is looked up.

    Looked up are the pieces that the library cuts words into, as there are far fewer of them than words with
    their marks. A piece of plain letters goes to the library's model at once, as its other steps do nothing
    to it but lower its case; all other pieces, and words with other characters, take all steps.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.words = ends_words(config)
        self.type = id_type(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.cached, self.known, self.letters = cached, Words(self._word), {}
        if self.words and plain_steps(config):
            self.model, as_bytes = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.only_letters = re.compile(f"[{LETTERS}]+").fullmatch
            low = [chr(c) for c in range(0x61, 0x100) if self.only_letters(chr(c)) and chr(c) == chr(c).lower()]
            self.letters = str.maketrans({c: as_bytes(c)[0][0] for c in low})
            self.plain, self.all = piece_patterns(config)
            self.odd, self.added = re.compile(f"[^{PLAIN}]"), [t["content"] for t in config.get("added_tokens", [])]

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.type.char}", *ids)

    def _encode(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if not self.letters or not self.only_letters(word):
            return self._encode(word)
        low = word.lower()
        if low != word:
            return self.known[low]
        return self._bytes([p.id for p in self.model.tokenize(word.translate(self.letters))])

    def __call__(self, text: str) -> bytes:
        if not self.words:
            return self._encode(text)
        if len(self.known) > self.cached:
            self.known = Words(self._word)
        if self.letters:
            odd = self.odd.search(text) or any(t in text for t in self.added)
            words = (self.all if odd else self.plain).findall(text)
        else:
            words = text.replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self.known.__getitem__, words))


def id_type(size: int) -> np.dtype:
    """Ids take two bytes where all fit."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, so that words stay known from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


# Shards


def shard_starts(sizes: DataFrame, shard_bytes: int) -> np.ndarray:
    """The first id of each shard of about ``shard_bytes`` of text at most; an id that fills several shards starts several.

    ``sizes`` has doc and bytes. Sizes are added up by id, sorted in ranges and cut one after the
    other. The driver gets a number for each shard: 12 MB for 100 TB in shards of 64 MB.
    """
    each = sizes.groupBy("doc").agg(F.sum("bytes").alias("bytes"))
    each = stage(each, "document-sizes")
    total = each.agg(F.sum("bytes")).first()[0] or 0
    shard_bytes = max(1 << 20, min(shard_bytes, total // 64))
    ranges = max(1, total // (16 * shard_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room = 0
        for batch in batches:
            starts = []
            for doc, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if size > room:
                    starts += [doc] * max(1, size // shard_bytes)
                    room = shard_bytes
                room -= min(size, room)
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64())], names=["doc"])

    cut = each.repartitionByRange(ranges, "doc").sortWithinPartitions("doc")
    return np.array(sorted(r[0] for r in map_arrow(cut.select("doc", "bytes"), run, "doc bigint").collect()), np.int64)


def _encoded(docs: DataFrame, starts: np.ndarray, path: str, end: bytes) -> DataFrame:
    """(shard, doc, ids) of every row; rows of an id that has several shards are dealt out in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, n = encoder(path), 0
        for batch in batches:
            doc = batch.column(0).to_numpy().astype(np.int64)
            high = np.maximum(np.searchsorted(starts, doc, "right") - 1, 0)
            low = np.minimum(np.searchsorted(starts, doc, "left"), high)
            shard = low + (n + np.arange(len(doc))) % (high - low + 1)
            n += len(doc)
            for i in range(0, len(doc), 100):
                texts = batch.column(1).slice(i, 100).to_pylist()
                ids = [encode((t or b"").decode("utf-8", "replace")) + end for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[i : i + 100], pa.int32()), pa.array(doc[i : i + 100]), pa.array(ids, pa.binary())],
                    names=["shard", "doc", "ids"],
                )

    return map_arrow(docs.select("doc", "body"), run, "shard int, doc bigint, ids binary")


def _lines(encoded: DataFrame, width: int, shards: int) -> DataFrame:
    """The lines of all files: documents of a shard without their end id, then its table.

    A task gets one shard and so writes a file of one: readers take files as a whole, several times over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, names, sizes = None, [], []

        def table() -> bytes:
            n = np.array(sizes, "<u4")
            return np.array(names, "<i8").tobytes() + n.tobytes() + struct.pack(TAIL, MAGIC, current, len(n), int(n.sum(dtype=np.int64)))

        for batch in batches:
            lines = []
            for shard, doc, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if shard != current and names:
                    lines.append(table())
                    names, sizes = [], []
                current = shard
                names.append(doc)
                sizes.append(len(ids) // width)
                lines.append(ids[:-width])
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["line"])
        if names:
            yield pa.RecordBatch.from_arrays([pa.array([table()], pa.binary())], names=["line"])

    ordered = encoded.repartitionById(max(1, shards), "shard").sortWithinPartitions("shard", "doc", "ids")
    return map_arrow(ordered, run, "line binary").select(F.col("line").cast("string").alias("line"))


def blocks(content: bytes, type_: np.dtype) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, place of its payload in the file, ids, document keys, their numbers of ids) of each shard in a file, the last first."""
    stop, width = len(content), type_.itemsize
    while stop:
        tail = stop - width - struct.calcsize(TAIL)
        magic, shard, docs, ids = struct.unpack_from(TAIL, content, tail)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        sizes, names = tail - 4 * docs, tail - 12 * docs
        begin = names - ids * width
        yield (
            shard, begin, np.frombuffer(content, type_, ids, begin),
            np.frombuffer(content, "<i8", docs, names), np.frombuffer(content, "<u4", docs, sizes),
        )
        stop = begin


# The index


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers n different keys from 0 to n - 1 without storing them.

    Keys hash into a row of bits, twice as many as keys. A key that is alone at its bit keeps it; the
    others try again on a next, smaller row. The number of a key is the number of bits set before
    its own, which takes one look at each row and at a count stored for every 64 bits.
    """

    SPREAD = 2

    def __init__(self, rows: list[np.ndarray]):
        self.rows = rows
        counts = [np.bitwise_count(r).astype(np.int64) for r in rows]
        sizes = np.array([0, *(c.sum() for c in counts)], np.int64).cumsum()
        self.before = [c.cumsum() - c + at for c, at in zip(counts, sizes)]
        self.size = int(sizes[-1])

    @staticmethod
    def _place(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
        salt = np.uint64((row + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        return (_mix(keys + salt) >> np.uint64(11)) % np.uint64(bits)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        rows, rest = [], keys
        while len(rest):
            bits = -(-cls.SPREAD * len(rest) // 64) * 64
            place = cls._place(rest, len(rows), bits)
            hits = np.bincount(place.astype(np.int64), minlength=bits)
            rows.append(np.packbits(hits == 1, bitorder="little").view(np.uint64))
            rest = rest[hits[place.astype(np.int64)] > 1]
            if len(rows) > 200:
                raise ValueError("keys must differ")
        return cls(rows)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1, or that of some other key, for one that was not there when the hash was built."""
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for i, (row, before) in enumerate(zip(self.rows, self.before)):
            place = self._place(keys[open_], i, 64 * len(row))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            here = (row[word] >> bit & np.uint64(1)).astype(bool)
            below = row[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_[here]] = (before[word] + np.bitwise_count(below))[here]
            open_ = open_[~here]
        return found


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


#: What the index stores at the number of a key.
ENTRY = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("place", "<u4"), ("size", "<u4"), ("offset", "<u8"), ("copies", "<u8")])


def pack_part(keys: np.ndarray, entries: np.ndarray) -> bytes:
    """A part of the index: the rows of its hash, and the entries in the order of their keys' numbers."""
    hash_ = PerfectHash.build(keys)
    slots = np.zeros(len(keys), ENTRY)
    slots[hash_.numbers(keys)] = entries
    head = np.array([len(hash_.rows), *map(len, hash_.rows)], "<u4")
    return head.tobytes() + b"".join(r.tobytes() for r in hash_.rows) + slots.tobytes()


class Part:
    """A part of the index, opened for lookups."""

    def __init__(self, blob: bytes):
        n = int(np.frombuffer(blob, "<u4", 1)[0])
        sizes = np.frombuffer(blob, "<u4", n, 4).astype(np.int64)
        ends = 4 + 4 * n + 8 * np.r_[0, sizes].cumsum()
        self.hash = PerfectHash([np.frombuffer(blob, np.uint64, s, at) for s, at in zip(sizes.tolist(), ends.tolist())])
        self.slots = np.frombuffer(blob, ENTRY, self.hash.size, int(ends[-1]))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are there, their entries); an unknown key passes for a known one once in 2 ** 32."""
        numbers = self.hash.numbers(keys)
        there = numbers >= 0
        if not len(self.slots):
            return there, self.slots
        there &= self.slots["fingerprint"][numbers] == fingerprint(keys)
        return there, self.slots[numbers[there]]


def _part(doc, parts: int):
    return F.pmod(F.xxhash64(doc), F.lit(parts)).cast("int")


def build_index(catalog: DataFrame) -> DataFrame:
    """(part, blob): the index over the keys of ``catalog`` (doc, shard, place, offset, size), by hash in parts of about PART keys."""
    first = F.min(F.struct("shard", "place", "offset", "size")).alias("first")
    entries = stage(catalog.groupBy("doc").agg(first, F.count(F.lit(1)).alias("copies")).select("doc", "first.*", "copies"), "entries")
    parts = max(1, -(-entries.count() // PART))
    dealt = entries.select(_part("doc", parts).alias("part"), "doc", "shard", "place", "offset", "size", "copies")
    names = ("shard", "place", "offset", "size", "copies")

    def pack(part: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        keys = table["doc"].to_numpy().astype(np.int64).view(np.uint64)
        rows = np.zeros(len(keys), ENTRY)
        rows["fingerprint"] = fingerprint(keys)
        for name in names:
            rows[name] = table[name].to_numpy()
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pack_part(keys, rows)], pa.binary())], names=["part", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting = None, []
        for batch in batches:
            part = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if part[a] != current and waiting:
                    yield pack(current, waiting)
                    waiting = []
                current = int(part[a])
                waiting.append(batch.slice(a, b - a))
        if waiting:
            yield pack(current, waiting)

    return map_arrow(dealt.repartition("part").sortWithinPartitions("part"), run, "part int, blob binary")


def look_up(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc, shard, place, offset, size, copies) of the distinct ``keys`` (doc) that the ``index`` knows.

    A part of the index passes by once, before the keys that fall into it.
    """
    parts = (index.agg(F.max("part")).first()[0] or 0) + 1
    own = keys.select("doc").distinct().select(_part("doc", parts).alias("part"), F.lit(None).cast("binary").alias("blob"), "doc")
    both = index.select("part", "blob", F.lit(None).cast("bigint").alias("doc")).union(own)
    ddl = "doc bigint, shard int, place bigint, offset bigint, size bigint, copies bigint"
    fields = arrow_fields(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = None, None
        for batch in batches:
            at = 0
            numbers, blobs = batch.column(0).to_pylist(), batch.column(1)
            marks = np.flatnonzero(blobs.is_valid().to_numpy(zero_copy_only=False)).tolist()
            for stop in [*marks, len(numbers)]:
                # Keys before the next blob belong to the part that is open, if the index has theirs at all.
                docs = batch.column(2).slice(at, stop - at).to_numpy(zero_copy_only=False).astype(np.int64)
                docs = docs[np.array(numbers[at:stop]) == number]
                if len(docs):
                    there, found = part.find(docs.view(np.uint64))
                    columns = [docs[there], *(found[n].astype(np.int64) for n in ("shard", "place", "offset", "size", "copies"))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], names=[f.name for f in fields])
                if stop < len(numbers):
                    part, number = Part(blobs[stop].as_py()), numbers[stop]
                    at = stop + 1

    order = F.col("blob").isNull()
    return map_arrow(both.repartition("part").sortWithinPartitions("part", order), run, ddl)


# Writing and reading


CATALOG = "doc bigint, shard int, place bigint, offset bigint, size bigint"


def _read(files: DataFrame, type_: np.dtype, what: str) -> DataFrame:
    """Rows of all documents in ``files`` (content), each in the place where the tables of the shards say.

    ``what`` is catalog (the tables alone), crc32 (of the ids as four bytes each) or ids.
    """
    extra = {"catalog": "", "crc32": ", ids_crc32 bigint", "ids": ", ids array<int>"}[what]
    ddl = CATALOG + extra
    fields = arrow_fields(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for shard, _, ids, docs, sizes in blocks(memoryview(content.as_buffer()), type_):
                    ends = sizes.astype(np.int64).cumsum()
                    for a in range(0, len(docs), 1000):
                        b = min(a + 1000, len(docs))
                        made = [docs[a:b], np.full(b - a, shard), np.arange(a, b), ends[a:b] - sizes[a:b], sizes[a:b].astype(np.int64)]
                        if what != "catalog":
                            rows = [ids[e - n : e].astype("<u4") for e, n in zip(ends[a:b].tolist(), sizes[a:b].tolist())]
                            made.append([crc32(r.tobytes()) for r in rows] if what == "crc32" else [r.astype(np.int32) for r in rows])
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, fields)], names=[f.name for f in fields])

    return map_arrow(files.select("content"), run, ddl)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/ids")


def write_ids(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
    model_path: str | None = None, end_id: int = 2, shard_bytes: int = 64 << 20,
) -> None:
    """Write the token ids of all rows to ``folder``: ids (the shards), index (key to place) and shards (sizes and starts).

    Every text is encoded whole by the tokenizers library without added special tokens and closed by
    ``end_id``. Documents stand in ascending order of ``id_col``, whole numbers above -2 ** 63; a null
    id comes first; rows that share an id stand together in any order. A null text is an empty one.
    Shards have about ``shard_bytes`` of text, less where that would make fewer than 64 of them.
    Texts are read twice, once for their sizes; ids are shuffled once.
    """
    spark, path = docs.sparkSession, model_path or public_tokenizers.path(MODEL)
    plain = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NULL_ID)).alias("doc"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("body"),
    )
    type_ = encoder(path).type
    end = np.array([end_id], type_).tobytes()
    sizes = plain.select("doc", (F.coalesce(F.octet_length("body"), F.lit(0)) + OVERHEAD).cast("bigint").alias("bytes"))
    starts = shard_starts(sizes, shard_bytes)
    lines = _lines(_encoded(plain, starts, path, end), type_.itemsize, len(starts))
    separator = {"lineSep": end.decode("latin-1"), "encoding": "ISO-8859-1", "compression": "none"}
    lines.write.options(**separator).text(f"{folder}/ids")
    catalog = stage(_read(_files(spark, folder), type_, "catalog"), "token-catalog")
    build_index(catalog).write.parquet(f"{folder}/index")
    # One row for each shard: starts are sums over the shards before.
    each = catalog.groupBy("shard").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("docs", "ids")]
    each.select("shard", "docs", "ids", *sums, F.lit(type_.itemsize).alias("width")).write.parquet(f"{folder}/shards")


def fetch(spark: SparkSession, folder: str, keys: DataFrame, id_col: str = "doc_id", what: str = "ids") -> DataFrame:
    """The documents in ``folder`` whose ids are in ``keys``: ``id_col``, start, n_tokens and ids (or ids_crc32, as ``what`` says).

    The index gives the first place of every key and how many rows have it; these stand in a row, and
    what lies at their places is read from the files. start counts the ids of all documents before.
    Ids unknown to the index have no row, repeated keys count once, a null key finds the null ids.
    """
    kind = keys.schema[id_col].dataType.simpleString()
    wanted = keys.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(NULL_ID)).alias("doc"))
    shards = spark.read.parquet(f"{folder}/shards")
    width = shards.agg(F.max("width")).first()[0]
    index = spark.read.parquet(f"{folder}/index")
    found = look_up(index, wanted).join(shards.select("shard", "docs_before"), "shard").select(
        "doc", (F.col("docs_before") + F.col("place")).alias("first"), (F.col("docs_before") + F.col("place") + F.col("copies") - 1).alias("last")
    )
    many = F.col("last") - F.col("first") >= COPIES
    few = found.where(~many).select("doc", F.explode(F.sequence("first", "last")).alias("number"))
    begins = found.where(many).select("doc", "last", F.explode(F.sequence("first", "last", F.lit(COPIES))).alias("first"))
    dealt = begins.repartition("first").select(
        "doc", F.explode(F.sequence("first", F.least("last", F.col("first") + COPIES - 1))).alias("number")
    )
    type_ = np.dtype("<u2" if width in (None, 2) else "<u4")
    rows = _read(_files(spark, folder), type_, what).join(shards.select("shard", "docs_before", "ids_before"), "shard")
    extra = "ids_crc32" if what == "crc32" else what
    rows = rows.select(
        (F.col("docs_before") + F.col("place")).alias("number"), (F.col("ids_before") + F.col("offset")).alias("start"), F.col("size").alias("n_tokens"), extra
    )
    named = F.when(F.col("doc") != NULL_ID, F.col("doc")).cast(kind).alias(id_col)
    return few.union(dealt).join(rows, "number").select(named, "start", "n_tokens", extra)


def write_and_read(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write ``docs`` to the shared folder and fetch every document through the index: ``id_col``, start, n_tokens, ids_crc32.

    ids_crc32 is that of all ids of the document, the end id included, as four bytes each. Repeated
    rows give repeated results, an empty table an empty result, other columns are not read.
    """
    spark = docs.sparkSession
    folder = stage_path(spark, "token-ids")
    write_ids(docs, folder, id_col, text_col, **options)
    return fetch(spark, folder, docs.select(F.col(f"`{id_col}`").alias(id_col)), id_col, "crc32")
