"""Sets of tables that change together: every load writes new folders, and one pointer file names those that hold.

    <folder>/versions/<load>/<table>/...   written once, never changed
    <folder>/pointers/<number>             one line of JSON: the folder of each table, see Version

A table that is laid out by a column may be spread over the folders of several loads: a load then writes only
the values of that column whose rows have changed, and its pointer names older folders for all others.
A load is visible from the moment its pointer is complete. Until then, and if it breaks at any step, readers
get the version before; a pointer that is cut short does not count. Versions stay readable until ``drop_old``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class LoadConflict(RuntimeError):
    """Another load has published the version that this one wanted to."""


@dataclass(frozen=True)
class Version:
    """``tables`` has the folder of each table, relative to that of the set, where the last load wrote it.

    ``parts`` has, for tables that are spread over loads, each folder with the values of the
    column ``layout`` that hold there; ``sums`` the checksum of the rows of each value.
    """

    number: int
    tables: Mapping[str, str]
    parts: Mapping[str, Mapping[str, list]] = field(default_factory=dict)
    sums: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    layout: Mapping[str, str] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {*self.tables.values(), *(place for spread in self.parts.values() for place in spread)}


def _files(spark: SparkSession, folder: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all pointers, complete or not, the newest first."""
    files, path = _files(spark, folder)
    place = path(f"{folder}/pointers")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted((int(name) for name in names if name.isdigit()), reverse=True)


def read_version(spark: SparkSession, folder: str, number: int) -> Version | None:
    """The version with this number; None if its pointer is missing or incomplete."""
    files, path = _files(spark, folder)
    place = path(f"{folder}/pointers/{number:012d}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    if not text.endswith("\n"):
        return None
    return Version(**json.loads(text))


def current(spark: SparkSession, folder: str) -> Version | None:
    """The newest complete version, None if there is none."""
    return next((v for n in _numbers(spark, folder) if (v := read_version(spark, folder, n))), None)


def value_of(column: str) -> Column:
    """The value of a layout's column as it is named in a version."""
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def read_table(spark: SparkSession, folder: str, version: Version, table: str, schema: str | None = None) -> DataFrame:
    """A table as ``version`` has it; older folders give only the values that still hold there, without a scan of the others."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    spread = version.parts.get(table) or {version.tables[table]: []}
    parts = []
    for place, values in spread.items():
        part = reader.parquet(f"{folder}/{place}")
        parts.append(part.where(value_of(version.layout[table]).isin(values)) if len(spread) > 1 else part)
    return reduce(DataFrame.unionByName, parts)


def changed(
    old: Version | None, table: str, sums: Mapping[str, str], place: str, most: int = 8
) -> tuple[list[str], dict[str, list]]:
    """(values of the layout that a load has to write at ``place``, parts of the new version).

    Values whose checksum is the one of the old version stay where they are. All are written if there
    is none, or if rows would lie in more than ``most`` folders.
    """
    before = old.sums.get(table, {}) if old else {}
    parts = {}
    for folder, values in (old.parts.get(table, {}) if old else {}).items():
        kept = [v for v in values if v in sums and before.get(v) == sums[v]]
        if kept:
            parts[folder] = kept
    same = {v for values in parts.values() for v in values}
    if len(parts) >= most:
        same, parts = set(), {}
    new = sorted(set(sums) - same)
    return new, {**parts, place: new} if new or not parts else parts


def new_load() -> str:
    """A folder, relative to that of the set, for the tables of one load."""
    return f"versions/{time.strftime('%Y%m%d-%H%M%S', time.gmtime())}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, folder: str, new: Version, after: int | None = None) -> Version:
    """Make ``new`` the current version, in one step; it gets the next free number.

    ``after`` is the number of the version that the load started from: if a newer one has been
    published since, nothing changes and LoadConflict is raised.
    """
    last = current(spark, folder)
    if after is not None and (last.number if last else 0) != after:
        raise LoadConflict(f"{folder} has changed since version {after}")
    files, path = _files(spark, folder)
    version = replace(new, number=max(_numbers(spark, folder), default=0) + 1)
    place = path(f"{folder}/pointers/{version.number:012d}")
    try:
        stream = files.create(place, False)  # fails if it is there
    except Exception as error:
        if files.exists(place):
            raise LoadConflict(f"{folder} already has version {version.number}") from error
        raise
    try:
        stream.write(bytearray(f"{json.dumps(asdict(version))}\n", "utf-8"))
    finally:
        stream.close()
    return version


def discard(spark: SparkSession, folder: str, load: str) -> None:
    """Delete the folder of a load that was not published."""
    files, path = _files(spark, folder)
    files.delete(path(f"{folder}/{load}"), True)


def drop_old(spark: SparkSession, folder: str, keep: int = 2, hours: float = 24) -> list[str]:
    """Delete pointers but the ``keep`` newest complete ones, and loads that none of these name.

    Loads younger than ``hours`` stay, as they may not be published yet. Returns the deleted loads.
    """
    files, path = _files(spark, folder)
    numbers = _numbers(spark, folder)
    kept = [v for n in numbers if (v := read_version(spark, folder, n))][: max(keep, 1)]
    if not kept:
        return []
    for number in numbers:
        if number < kept[0].number and number not in {v.number for v in kept}:
            files.delete(path(f"{folder}/pointers/{number:012d}"), False)
    named = {place.split("/")[1] for v in kept for place in v.folders()}
    oldest, gone = (time.time() - hours * 3600) * 1000, []
    for status in files.listStatus(path(f"{folder}/versions")):
        name = status.getPath().getName()
        if name not in named and status.getModificationTime() <= oldest:
            files.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
