"""Token counts by byte-pair merging over a heap and a linked list.

No identifiers are produced: a text has as many tokens as initial symbols minus merges.
"""

from __future__ import annotations

from functools import lru_cache
from heapq import heapify, heappop, heappush

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import from_texts

MODEL = "piece_bpe_32k.model"
CACHED_WORDS = 1_000_000
CACHED_LENGTH = 64
# Bits of an entry of the heap: rank, place of the left symbol, length of the pair in characters.
PLACE, RANK = 12, 52
LENGTHS, PLACES = (1 << PLACE) - 1, (1 << RANK - PLACE) - 1


class Merges:
    """The merge ranks of a piece vocabulary with byte fallback and a leading space mark."""

    def __init__(self, scores: dict[str, float]):
        order = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        if any("▁" in piece.lstrip("▁") for piece in scores):
            raise ValueError("a piece spans two words")
        self.characters = {c for piece in scores for c in piece}
        if any(c not in scores for c in self.characters):
            raise ValueError("a character of a piece is no piece itself")
        # One integer orders a pair by rank, then place, and also carries its length.
        self.keys = {piece: order[score] << RANK | len(piece) for piece, score in scores.items()}

    def count(self, word: str) -> int:
        """Tokens of one word: repeatedly merge the adjacent pair of lowest rank, leftmost first.

        A symbol is named by its first character; ``size`` gives its length and so its successor,
        ``before`` its predecessor. Entries whose pair has changed meanwhile are skipped.
        """
        n, get = len(word), self.keys.get
        tokens = n
        if not self.characters.issuperset(word):  # byte fallback
            tokens += sum(len(c.encode("utf-8", "surrogatepass")) - 1 for c in word if c not in self.characters)
        heap = [key | i << PLACE for i in range(n - 1) if (key := get(word[i : i + 2]))]
        heapify(heap)
        size, before = [1] * n, list(range(-1, n - 1))
        while heap:
            key = heappop(heap)
            left, length = key >> PLACE & PLACES, key & LENGTHS
            here = size[left]
            right = left + here
            if not here or right >= n or here + size[right] != length:
                continue
            tokens -= 1
            size[left], size[right] = length, 0
            after = left + length
            if after < n:
                before[after] = left
                if key := get(word[left : after + size[after]]):
                    heappush(heap, key | left << PLACE)
            first = before[left]
            if first >= 0 and (key := get(word[first:after])):
                heappush(heap, key | first << PLACE)
        return tokens


class Counter:
    """Counts whole texts. No piece spans two words, so words are counted apart and remembered."""

    def __init__(self, merges: Merges, cached: int = CACHED_WORDS):
        self.merges, self.cached, self.known = merges, cached, {}

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        words, runs = text.replace("▁", " ").split(" "), 0
        if "" in words:  # marks of several spaces in a row belong to the word that follows
            joined, marks = [], 0
            for word in words:
                if word and not marks:
                    joined.append(word)
                elif word:
                    runs += self.merges.count("▁" * (marks + 1) + word)
                    marks = 0
                else:
                    marks += 1
            words = joined
            if marks:
                runs += self.merges.count("▁" * marks)
        known = self.known
        if len(known) > self.cached:
            known.clear()
        long = 0
        for word in set(words).difference(known):
            if len(word) <= CACHED_LENGTH:
                known[word] = self.merges.count("▁" + word)
            else:
                long += 1
        if long:
            runs += sum(self.merges.count("▁" + w) for w in words if len(w) > CACHED_LENGTH)
            words = [w for w in words if len(w) <= CACHED_LENGTH]
        return runs + sum(map(known.__getitem__, words))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per Python worker, so that words stay known from task to task."""
    return Counter(load(path))


@lru_cache(maxsize=2)
def load(path: str) -> Merges:
    """Merge ranks from the pieces and scores of a vocabulary file; its encoder is not used."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return Merges({model.id_to_piece(i): model.get_score(i) for i in plain})


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, limit: int = 4096
) -> DataFrame:
    """Per row: ``id_col``, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Exactly the counts of the vocabulary's own library, without begin or end tokens; strings that
    look like special tokens are ordinary text. A null text counts as empty: 0 bytes, 0 tokens. A
    null id stays null, repeated rows give repeated results, an empty table an empty result; other
    columns are not read. Texts are never cut: a word of n characters takes n log n steps.
    """
    path = model_path or public_tokenizers.path(MODEL)

    def make():
        count = counter(path)

        def run(texts: list[bytes | None]):
            texts = [t or b"" for t in texts]
            tokens = [count(t.decode("utf-8", "replace")) for t in texts]
            return [len(t) for t in texts], tokens

        return run

    counted = from_texts(docs.select(id_col, text_col), text_col, [id_col], "n_bytes bigint, n_tokens bigint", make)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
