import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import prose  # noqa: E402

from lumbung.session import stage  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside or give to their results.
CLASHING = ["row", "doc", "h", "key", "fingerprint", "held_out", "score", "domain", "copies", "kept", "__text", "__row", "tokens", "c0", "u", "TYPE"]


@pytest.fixture(scope="session")
def table(spark):
    """Rows as a stored table with the columns of documents."""

    def make(rows, schema=SCHEMA):
        rows = [(*r, *[None] * (len(schema.split(",")) - len(r))) for r in rows]
        return stage(spark.createDataFrame(rows, schema), "test")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    plain = prose(1, 120)
    return [
        (1, plain, "en", "src1", 5),
        (1, plain, "en", "src1", 5),
        (2, plain, "en", "src2", 5),
        (3, None, "de", "src1", None),
        (None, prose(2, 90), None, None, None),
        (None, None, None, None, None),
        (4, "", "fr", "src3", 0),
        (5, " \t\n ", "fr", "src3", 4),
        (6, prose(3, 30_000), "en", "src1", 1),
        (7, "x" * 50_000, None, "src9", 1),
        (8, "é漢字🎈 ▁▁ <s> \x00 end", "es", "src1", 1),
        (9, prose(4, 200), "en", None, 1),
    ]


@pytest.fixture(scope="session")
def odd(table, odd_rows):
    """The odd rows, with extra columns of clashing names."""
    from pyspark.sql import functions as F

    return stage(table(odd_rows).withColumns({c: F.lit(f"extra {c}") for c in CLASHING}), "odd")


@pytest.fixture(scope="session")
def empty(table):
    return table([])
