"""Repair of conversation structure by the cheapest edits, with an audit of what was done.

Edits are found by dynamic programming over the rows of a conversation. Every audit is a linked list
of edit letters whose prefix is shared with other audits; each link knows its ancestors at powers of
two and a rolling hash, so two audits of equal cost are compared by searching the length of their
common prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.arrow import arrow_fields, map_arrow

SPACES = " \t\n\x0b\x0c\r"
#: What has been said so far: nothing, a system row, a user row last, an assistant row last.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
TURN = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
SPOKEN = {USER: "user", ASSISTANT: "assistant"}
DELETE, REROLE, INSERT, UNFINISHED = 3, 2, 2, 1


class Audits:
    """Audits as links: a link is an edit letter after another link; 0 is the empty audit."""

    BASE, PRIME = 0x9E3779B97F4A7C15, (1 << 61) - 1

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[0]]  # up[k][i] is the ancestor of i that is 2 ** k links before

    def __len__(self) -> int:
        return len(self.letter)

    def append(self, before: int, letter: str) -> int:
        link, depth = len(self.letter), self.depth[before] + 1
        self.letter.append(letter)
        self.depth.append(depth)
        self.hash.append((self.hash[before] * self.BASE + ord(letter)) % self.PRIME)
        if depth >> len(self.up):
            self.up.append([0] * link)  # all links so far are less deep, their ancestor is the empty audit
        for table in self.up:
            table.append(before)
            before = table[before]
        return link

    def same(self, a: int, b: int) -> bool:
        """Whether two links of one depth end equal audits; equal hashes are verified letter by letter down to a shared link."""
        if a == b or self.hash[a] != self.hash[b]:
            return a == b
        first = self.up[0]
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = first[a], first[b]
        return True

    def lift(self, a: int, depth: int) -> int:
        """The ancestor of ``a`` at ``depth``."""
        rest = self.depth[a] - depth
        for table in self.up:
            if rest & 1:
                a = table[a]
            rest >>= 1
        return a

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` comes before ``b`` as text: their first different letter follows their longest common prefix."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, depth), self.lift(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        for table in reversed(self.up):
            if not self.same(table[x], table[y]):
                x, y = table[x], table[y]
        return self.letter[x] < self.letter[y]

    def text(self, a: int) -> str:
        letters = []
        while a:
            letters.append(self.letter[a])
            a = self.up[0][a]
        return "".join(reversed(letters))

    def settle(self, ends: list[int]) -> tuple[str, Audits, list[int]]:
        """(what all audits in ``ends`` begin with as links, the rest of the links alone, the new ends)."""
        depth = min(self.depth[a] for a in ends)
        last = [self.lift(a, depth) for a in ends]
        while len(set(last)) > 1:
            last = [self.up[0][a] for a in last]
        shared, alive = last[0], set()
        for a in ends:
            while a != shared and a not in alive:
                alive.add(a)
                a = self.up[0][a]
        rest, name = Audits(), {shared: 0}
        for a in sorted(alive):  # a link comes after those before it
            name[a] = rest.append(name[self.up[0][a]], self.letter[a])
        return self.text(shared), rest, [name[a] for a in ends]


class Repair:
    """The cheapest edits of the rows added so far, for each state they can end in: (cost, audit).

    Links that no audit ends in any more go when there are more than ``most``, and what all audits
    begin with becomes plain text.
    """

    def __init__(self, most: int = 100_000):
        self.audits, self.done, self.most = Audits(), [], most
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}
        self._insert()

    def _offer(self, best: dict[int, tuple[int, int]], state: int, cost: int, before: int, letter: str) -> None:
        if state not in best or cost < best[state][0]:
            best[state] = cost, self.audits.append(before, letter)
        elif cost == best[state][0]:
            link = self.audits.append(before, letter)
            if self.audits.less(link, best[state][1]):
                best[state] = cost, link

    def _insert(self) -> None:
        """Insert rows where that is the cheapest way to a state; the cheapest state first, as inserting costs."""
        open_ = {START, SYSTEM, USER, ASSISTANT}
        while some := open_ & self.best.keys():
            state = min(some, key=lambda s: self.best[s][0])
            open_.remove(state)
            if TURN[state] in open_:
                cost, link = self.best[state]
                self._offer(self.best, TURN[state], cost + INSERT, link, "I")

    def add(self, initial: str, unfinished: bool, must_go: bool, times: int = 1) -> None:
        """Add a row, or ``times`` rows that have to go."""
        for _ in range(times):
            best: dict[int, tuple[int, int]] = {}
            for state, (cost, link) in self.best.items():
                self._offer(best, state, cost + DELETE, link, "D")
                if not must_go:
                    cost += UNFINISHED * unfinished
                    if (state, initial) in NEXT:
                        self._offer(best, NEXT[state, initial], cost, link, "K")
                    self._offer(best, TURN[state], cost + REROLE, link, "R")
            self.best = best
            self._insert()
            # Behind an assistant row the rest costs at most one deletion more than at the start, and no more than behind a system row.
            if START in best and best[START][0] > best[ASSISTANT][0] + DELETE:
                del best[START]
            if SYSTEM in best and best[SYSTEM][0] > best[ASSISTANT][0]:
                del best[SYSTEM]
            if len(self.audits) > self.most:
                states = list(best)
                text, self.audits, ends = self.audits.settle([best[s][1] for s in states])
                self.done.append(text)
                self.best = {s: (best[s][0], link) for s, link in zip(states, ends)}
                self.most = max(self.most, 2 * len(self.audits))

    def result(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits to a whole conversation; of several, the audit that comes first as text."""
        cost, link = self.best[ASSISTANT]
        if START in self.best:
            other, end = self.best[START]
            if other < cost or other == cost and self.audits.less(end, link):
                cost, link = other, end
        return cost, "".join([*self.done, self.audits.text(link)])


# Rows


def _rows(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text and digest (of the text); a null role or text is one space."""
    plain = rows.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"),
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))),
    )
    return plain.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


#: Rows of a conversation come in this order.
ORDER = ("turn", "role", "digest")
CODES = "blank boolean, unfinished boolean, n bigint, said boolean"


def _codes(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one: conv, turn, role, digest, blank, unfinished, n (how many), said (in an earlier turn).

    Copies are counted inside each task before they are shuffled, and what is said in one turn only
    needs no partner, so neither a row nor a conversation that repeats without end is gathered.
    """
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    marked = rows.select(
        "conv", *ORDER, (body == "").alias("blank"), (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("unfinished")
    )
    own = marked.groupBy("conv", *ORDER, "blank", "unfinished").agg(F.count(F.lit(1)).alias("n"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    several = own.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(turn).alias("first"), F.count(F.lit(1)).alias("turns")
    )
    several = several.where("turns > 1").select("c", "r", "d", "first")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return own.join(several, same, "left").select(
        "conv", *ORDER, "blank", "unfinished", "n", F.coalesce(F.col("first") < turn, F.lit(False)).alias("said")
    )


AUDIT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
LEGAL = {"su", "ua", "au"}


class Report:
    """What is wrong with the rows of one conversation, and its repair."""

    def __init__(self):
        self.repair = Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.before = self.least = self.last = None

    def add(self, turn: int | None, role: str, blank: bool, unfinished: bool, n: int, said: bool) -> None:
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.illegal += n - 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.turns += 1
            self.least, self.last = (turn if self.least is None else self.least), turn
        if blank or said:
            self.blank += n * blank
            self.duplicate += n * (not blank)
            self.repair.add(initial, False, True, n)
            return
        self.duplicate += n - 1
        self.truncated += unfinished
        self.repair.add(initial, unfinished, False)
        self.repair.add(initial, False, True, n - 1)

    def result(self) -> tuple:
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


def _by_conversation(
    batches: Iterator[pa.RecordBatch], fields: list[pa.Field], begin: Callable, row: Callable, end: Callable
) -> Iterator[pa.RecordBatch]:
    """Walk over rows whose first column is the conversation, in order; ``begin``, ``row`` and ``end`` yield result rows."""
    made, size, current, state = [], 0, None, None

    def batch() -> pa.RecordBatch:
        columns = list(zip(*made)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], names=[f.name for f in fields])

    for rows in batches:
        for conv, *values in zip(*(rows.column(i).to_pylist() for i in range(rows.num_columns))):
            if state is None or conv != current:
                if state is not None:
                    made.extend(end(current, state))
                current, state = conv, begin()
            made.extend(row(conv, state, *values))
            if len(made) >= 1000:
                yield batch()
                made.clear()
    if state is not None:
        made.extend(end(current, state))
    yield batch()


def audits(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """conv and the columns of AUDIT for each conversation of ``rows`` (as from ``_rows``), and of ``ids`` (conv) without rows."""
    kind = rows.schema["conv"].dataType.simpleString()
    codes = _codes(rows).withColumn("place", F.lit(1))
    if ids is not None:
        empty = [F.lit(None).cast(codes.schema[c].dataType).alias(c) for c in codes.columns[1:-1]]
        codes = codes.union(ids.distinct().select("conv", *empty, F.lit(0)))
    codes = codes.select("conv", "place", "turn", "role", "blank", "unfinished", "n", "said", "digest")
    sorted_ = codes.repartition("conv").sortWithinPartitions("conv", "place", *ORDER)
    ddl = f"conv {kind}, {AUDIT}"
    fields = arrow_fields(ddl)

    def row(conv, report: Report, place, turn, role, blank, unfinished, n, said, digest) -> tuple:
        if place:
            report.add(turn, role, blank, unfinished, n, said)
        return ()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_conversation(batches, fields, Report, row, lambda conv, report: [(conv, *report.result())])

    return map_arrow(sorted_, run, ddl)


class Replay:
    """Applies an audit to the rows of a conversation as they pass by."""

    def __init__(self):
        self.audit, self.at, self.state, self.place = "", 0, START, 0
        self.digest = hashlib.sha256()

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self.state = TURN[self.state]
            yield SPOKEN[self.state], "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of what stands in the place of a row, and before it."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        self.state = NEXT[self.state, role[:1]] if edit == "K" else TURN[self.state]
        yield (role if edit == "K" else SPOKEN[self.state]), text, edit

    def take(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.place else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.place += 1


def _replayed(rows: DataFrame, found: DataFrame, digests: bool) -> DataFrame:
    """Rows and the audits of their conversations pass by in order, once: repaired rows, or the digest of each conversation."""
    kind = rows.schema["conv"].dataType.simpleString()
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "digest", "role", "text")]
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    first = found.select("conv", F.lit(0).alias("place"), *none, F.struct(*numbers, "audit").alias("found"))
    own = rows.select(
        "conv", F.lit(1), "turn", "digest", "role", "text", F.lit(None).cast(first.schema["found"].dataType)
    )
    sorted_ = first.union(own).repartition("conv").sortWithinPartitions("conv", "place", *ORDER)
    result = f"{AUDIT}, repaired_sha256 string" if digests else "place bigint, role string, text string, edit string"
    ddl = f"conv {kind}, {result}"
    fields = arrow_fields(ddl)

    def given(conv, replay: Replay, parts) -> Iterator[tuple]:
        for role, text, edit in parts:
            if not digests:
                yield conv, replay.place, role, text, edit
            replay.take(role, text)

    def row(conv, replay: Replay, place, turn, digest, role, text, found) -> Iterator[tuple]:
        if place:
            yield from given(conv, replay, replay.row(role, text))
        else:
            replay.audit, replay.found = found["audit"], tuple(found[n] for n in numbers)

    def end(conv, replay: Replay) -> Iterator[tuple]:
        yield from given(conv, replay, replay.inserted())
        if digests:
            yield (conv, *replay.found, replay.audit, replay.digest.hexdigest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_conversation(batches, fields, Replay, row, end)

    return map_arrow(sorted_.select("conv", "place", "turn", "digest", "role", "text", "found"), run, ddl)


# The operator


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Break about a quarter of the ``rows``, told by the crc32 of ``conversation:turn`` modulo 20, nulls as one space.

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats the row, 4 makes it the user's.
    """
    known = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    case = F.crc32(F.concat_ws(":", known(conv_col), known(turn_col)).cast("binary")) % 20
    changed = rows.select(F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`"), known(role_col).alias("r"), known(text_col).alias("t"), case.alias("case"))
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("t", ".!?", "")).otherwise(F.col("t"))
    times = F.explode(F.when(F.col("case") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    whole = changed.where("case != 0").withColumn("times", times)
    return whole.select(
        F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`"), F.when(F.col("case") == 4, "user").otherwise(F.col("r")).alias(role_col), text.alias(text_col)
    )


def repair(
    rows: DataFrame, ids: DataFrame | None = None,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Per conversation of ``rows``: ``conv_col``, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    The rows of a conversation are taken by turn (null first); rows of one turn by role, then by the
    SHA-256 of the text, so equal rows stand together. A row is blank if its text has nothing but
    spaces, else a duplicate if an earlier row has its role and text, else truncated if the last
    character that is no space is none of ``.!?``. gaps counts the whole numbers missing between the
    least and the largest turn; illegal the neighbours whose roles' initials are not su, ua or au.

    Edits make the roles' initials ``(s?(ua)+)?``: K keeps a row (cost 0), R makes it the user's or
    the assistant's (2), D deletes it (3; blank rows and duplicates must go), I inserts an empty row
    (2); a truncated row that stays costs 1 more. audit has the letters of the cheapest edits in
    order, the first as text of several; repaired_sha256 is the hash of the repaired rows as
    ``role:text``, joined by newlines.

    Conversations in ``ids`` (a column ``conv_col``) that have no row get zeros, an empty audit and
    the hash of nothing. A null conversation is one like any other, null roles and texts are one
    space, roles with other initials can't be kept, other columns are not read, an empty table gives
    an empty result. Texts are shuffled once, for the hash; edits are found on codes. A hash runs
    over one conversation in order, so that is one task's work however long it is, but rows pass by
    and are not gathered: what is held is an audit.
    """
    plain = _rows(rows, conv_col, turn_col, role_col, text_col)
    named = None if ids is None else ids.select(F.col(f"`{conv_col}`").alias("conv"))
    return _replayed(plain, audits(plain, named), True).withColumnRenamed("conv", conv_col)


def repaired(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """The repaired rows: ``conv_col``, place (from 0), role, text and edit (K, R or I); see ``repair``."""
    plain = _rows(rows, conv_col, turn_col, role_col, text_col)
    return _replayed(plain, audits(plain), False).withColumnRenamed("conv", conv_col)
