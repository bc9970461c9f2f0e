"""Names, labels and keyword tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbung.sources.literals import sql_value


def upper_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def lower_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def normalize_region(c: Column) -> Column:
    """Upper-case a region name and expand its usual abbreviations."""
    name = upper_key(c)
    name = F.regexp_replace(name, r"^D\.I\.", "DI")
    name = F.regexp_replace(name, r"^D\.K\.I\.", "DKI")
    name = F.regexp_replace(name, r"KEP\.", "KEPULAUAN")
    return F.regexp_replace(name, "KEPULAUAN KEPULAUAN", "KEPULAUAN")


def contains_any(c: Column, words: Sequence[str]) -> Column:
    """True where the lower-cased label holds at least one of the words."""
    label = F.lower(F.trim(c))
    return reduce(or_, [label.contains(w.lower()) for w in words])


def contains_all(c: Column, words: Sequence[str]) -> Column:
    """True where the lower-cased label holds every word; null labels hold none."""
    label = F.coalesce(F.lower(c), F.lit(""))
    return F.forall(F.array(*[F.lit(w.lower()) for w in words]), lambda w: label.contains(w))


def label_by_content(c: Column, labels: Mapping[str, str]) -> Column:
    """First label whose needle occurs in the text (any case); other text stays as it is."""
    lowered = F.lower(c)
    out = None
    for needle, label in labels.items():
        test = lowered.contains(needle.lower())
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(c)


def code_by_name(column: str, codes: Mapping[str, int]) -> Column:
    """Integer code of an exact name (any case); 0 for every other or missing name."""
    cases = " ".join(f"WHEN {sql_value(name.lower())} THEN {code}" for name, code in codes.items())
    return F.expr(f"CASE lower({column}) {cases} ELSE 0 END")


def split_label(c: Column, separator: str = "_", default: str = "TIDAK DIKETAHUI") -> tuple[Column, Column]:
    """``MARKET_CITY`` at its first separator; without one the market is ``default``."""
    at = F.instr(c, separator)
    whole = F.trim(c)
    market = F.when(at > 0, F.trim(F.substring_index(c, separator, 1))).otherwise(F.lit(default))
    city = F.when(at > 0, F.trim(c.substr(at + F.lit(len(separator)), F.length(c)))).otherwise(whole)
    return market, city


def file_label(path: Column) -> Column:
    """File name without folder and without its extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[A-Za-z0-9]+$", "")


def is_real_region(name: Column, code: Column, totals: Sequence[str] = ("indonesia", "")) -> Column:
    """False for the national total, for blank names and for rows without a region code."""
    return (
        F.coalesce(F.trim(code), F.lit("")) != ""
    ) & ~F.coalesce(lower_key(name), F.lit("")).isin(*totals)
