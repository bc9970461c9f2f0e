"""Per-text Python work on Spark partitions, in Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

TEXT = "__text"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Most bytes of a batch; a batch and what is made of it are in memory several times over.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES, SPARKS_OWN = "4m", "67108864b"


def prepare(df: DataFrame) -> None:
    """Let Python workers that see this folder import the package, and keep their batches small.

    Workers that don't see it need the package installed or in --py-files. Batches of texts get
    4 MB at most, unless the session sets another limit than Spark's own of 64 MB.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if df.sparkSession.conf.get(BATCH) == SPARKS_OWN:
        df.sparkSession.conf.set(BATCH, BATCH_BYTES)


def arrow_fields(ddl: str) -> list[pa.Field]:
    return [pa.field(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(ddl)]


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    prepare(df)
    return df.mapInArrow(run, ddl)


def from_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: str,
    make: Callable[[], Callable[[list[bytes | None]], Sequence[Sequence]]],
) -> DataFrame:
    """The columns ``keep`` of every row of ``df`` and the columns ``fields`` computed from its text.

    ``make`` runs once per task and returns a function from a batch of UTF-8 texts to one list per
    field. Rows are neither moved nor dropped, repeated rows stay repeated.
    """
    source = df.select(*keep, F.col(text).cast("string").cast("binary").alias(TEXT))
    kept = [source.schema[c] for c in keep]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            columns = work(batch.column(TEXT).to_pylist())
            names = [f.name for f in out_schema]
            arrays = [batch.column(c) for c in names[: len(kept)]]
            for field, values in zip(out_schema[len(kept) :], columns):
                arrays.append(pa.array(values, field.type))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    out_schema = arrow_fields(ddl)
    return map_arrow(source, run, ddl)
