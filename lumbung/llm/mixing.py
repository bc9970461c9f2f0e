"""Mixing sources to target weights: budgets over a domain, language and source tree, filled by seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.arrow import fresh
from lumbung.session import stage

LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Targets:
    """Relative whole-number weights of the children at each level; unlisted ones get ``default``.

    ``domains`` names the domain of a source; other sources belong to ``other``. ``share`` is the
    budget as a share of all tokens (in thousandths), and no leaf is read more than ``epochs`` times.
    """

    domains: Mapping[str, str] = field(default_factory=dict)
    domain: Mapping[str, int] = field(default_factory=dict)
    lang: Mapping[str, int] = field(default_factory=dict)
    source: Mapping[str, int] = field(default_factory=dict)
    default: int = 1
    other: str = "other"
    share: int = 1000
    epochs: int = 4
    seed: int = 17

    def domain_of(self, source: Column) -> Column:
        return _lookup(self.domains, source, self.other)

    def weight(self, level: str, name: Column) -> Column:
        return _lookup(getattr(self, level), name, self.default).cast("decimal(38,0)")


def _lookup(table: Mapping, key: Column, default: object) -> Column:
    if not table:
        return F.lit(default)
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce(key, F.lit(""))), F.lit(default))


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fill(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Share ``budget`` of each parent among its children by ``weight``, none above its ``capacity``.

    A child that can't use its share leaves the rest to its siblings, again by weight. In order of
    capacity per weight, child k is exhausted exactly if its capacity is at most its part of what
    those before it leave; all later ones then share the remainder. Amounts are whole tokens,
    rounded down. A parent's budget never exceeds the capacity of its children, so a shortage leaves
    a subtree only when all of it is exhausted, and then its siblings have taken it one level up.
    """
    order = Window.partitionBy(*parents).orderBy(F.col("capacity") / F.col("weight"), *LEVELS[: len(parents) + 1])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0).cast("decimal(38,0)"))
    ranked = nodes.withColumn("left", left.cast("decimal(38,0)")).withColumn("rest", F.sum("weight").over(after).cast("decimal(38,0)"))
    exhausted = F.expr("cast(capacity * rest as decimal(38,0)) <= cast(weight * left as decimal(38,0))")
    ranked = ranked.withColumn("exhausted", exhausted)
    part = F.struct("left", "rest")
    open_ = Window.partitionBy(*parents)
    first = F.max(F.when(~F.col("exhausted"), F.struct(F.col("left").alias("left"), F.col("rest").alias("rest")))).over(open_)
    ranked = ranked.withColumn("first", first)
    amount = F.expr("cast(weight * first.left as decimal(38,0)) div first.rest").cast("decimal(38,0)")
    return ranked.withColumn("amount", F.when(F.col("exhausted"), F.col("capacity")).otherwise(amount)).drop(
        "left", "rest", "exhausted", "first"
    )


def leaf_budgets(leaves: DataFrame, targets: Targets) -> DataFrame:
    """(domain, lang, source, available, amount) for every leaf (domain, lang, source, available) that has tokens and weight.

    Only leaf rows are handled here, one per source, language and domain.
    """
    weights = {f"weight_{n}": targets.weight(n, F.col(n)) for n in LEVELS}
    leaves = leaves.where("available > 0").withColumns(weights).where(" and ".join(f"{w} > 0" for w in weights))
    leaves = leaves.withColumn("capacity", (F.col("available") * targets.epochs).cast("decimal(38,0)"))
    level = None
    for depth in range(1, 4):
        keys, parents = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
        nodes = leaves.groupBy(*keys).agg(
            F.sum("capacity").cast("decimal(38,0)").alias("capacity"),
            F.sum("available").cast("decimal(38,0)").alias("available"),
            F.max(f"weight_{LEVELS[depth - 1]}").alias("weight"),
        )
        if level is None:  # a row per domain
            every = Window.partitionBy()
            wanted = F.floor(F.sum("available").over(every) * targets.share / 1000).cast("decimal(38,0)")
            nodes = nodes.withColumn("budget", F.least(wanted, F.sum("capacity").over(every).cast("decimal(38,0)")))
        else:
            nodes = nodes.join(level.select(*parents, F.col("amount").alias("budget")), parents)
        level = fill(nodes, parents)
    return level.select(*LEVELS, "available", F.col("amount").cast("bigint").alias("amount"))


def plan(docs: DataFrame, targets: Targets, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(domain, lang, source, epochs, cutoff) for every leaf: full passes, and the order key up to which one more goes."""
    source, lang = F.coalesce(F.col(source_col).cast("string"), F.lit("")), F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    narrow = docs.select(
        targets.domain_of(source).alias("domain"), lang.alias("lang"), source.alias("source"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), n_tokens(F.col(text_col).cast("string")).alias("tokens"),
    )
    narrow = stage(narrow, "mix-tokens")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("tokens").cast("decimal(38,0)").alias("available"))
    budgets = leaf_budgets(leaves, targets)
    passes = budgets.withColumn("epochs", F.expr("amount div available")).withColumn(
        "rest", F.expr("cast(amount - epochs * available as bigint)")
    )
    passes = stage(passes.select(*LEVELS, "epochs", "rest"), "mix-budgets")
    # Of the last pass a prefix is taken. Its documents are first summed in slices of the order, so
    # that only the slice in which the budget ends is walked document by document.
    keyed = narrow.join(passes.where("rest > 0"), list(LEVELS)).withColumn(
        "key", order_key(targets.seed, F.col("epochs"), F.col("id"))
    )
    keyed = keyed.withColumn("slice", F.substring("key", 1, 4))
    slices = keyed.groupBy(*LEVELS, "slice").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"), F.max("key").alias("key"))
    upto = Window.partitionBy(*LEVELS).orderBy("slice")
    slices = slices.withColumn("upto", F.sum("tokens").over(upto)).withColumn("before", F.col("upto") - F.col("tokens"))
    whole = slices.where("upto <= rest").select(*LEVELS, "key")
    broken = slices.where("before <= rest and upto > rest").select(*LEVELS, "slice", "before")
    inside = keyed.join(broken, [*LEVELS, "slice"]).groupBy(*LEVELS, "key", "before", "rest").agg(F.sum("tokens").alias("tokens"))
    walk = Window.partitionBy(*LEVELS).orderBy("key")
    taken = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(walk)).where("upto <= rest").select(*LEVELS, "key")
    cutoffs = whole.union(taken).groupBy(*LEVELS).agg(F.max("key").alias("cutoff"))
    return stage(passes.join(cutoffs, list(LEVELS), "left").select(*LEVELS, "epochs", "cutoff"), "mix-plan")


def order_key(seed: int, epoch: Column, id_: Column) -> Column:
    """The place of a document in an epoch: documents are read in ascending order of this key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), id_))


def mix(
    docs: DataFrame,
    targets: Targets = Targets(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that the mixture reads, with their columns, ``domain`` and ``copies`` (times read).

    The budget goes down a tree of domains, languages and sources by the weights of ``targets``; what
    a node can't use goes to its siblings, and to those of its parents only when these are
    exhausted. A leaf's amount is read in seeded orders: whole passes, then the longest prefix of the
    next order that fits. Tokens are words. Null texts have none; a leaf without tokens is not read,
    texts without tokens are read with their leaf. Null languages and sources are the empty name, a
    null id the empty id. Rows with the same id in a leaf share a place in the order and are read
    together or not at all. An empty table gives an empty result. Where ``docs`` has a column
    ``domain`` or ``copies``, the new one gets a trailing underscore.
    The plan has one row per leaf and is joined by leaf, so no document is shuffled with its text.
    """
    domain, copies = fresh(docs, "domain"), fresh(docs, "copies")
    leaf = [fresh(docs, f"__{n}") for n in (*LEVELS, "epochs", "cutoff")]
    decided = plan(docs, targets, id_col, text_col, lang_col, source_col).toDF(*leaf)
    source, lang = F.coalesce(F.col(source_col).cast("string"), F.lit("")), F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    met = docs.join(decided, (lang == F.col(leaf[1])) & (source == F.col(leaf[2])))
    key = order_key(targets.seed, F.col(leaf[3]), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    times = F.col(leaf[3]) + F.when(key <= F.col(leaf[4]), 1).otherwise(0)
    met = met.withColumns({copies: times.cast("bigint"), domain: F.col(leaf[0])})
    return met.where(F.col(copies) > 0).select(*(F.col(f"`{c}`") for c in docs.columns), domain, copies)
