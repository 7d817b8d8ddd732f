"""Which files a table consists of: one small pointer file that every write replaces at once.

A write puts its rows under a folder of its own, ``run=<id>/<partition>``, and then makes the
next pointer, which names the runs of every partition. A reader resolves the newest pointer, so
it sees the content before a write or after it and nothing between; a run that stops
anywhere leaves the old content, and its files are in nobody's way. What only older pointers
name is deleted one write later, so that readers under way keep their files.

Pointers are numbered and made by a rename that fails if the name is taken: of two writers that
started from the same content, the second one is refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

FOLDER = "_pointer"
KEPT_POINTERS = 2


class ConcurrentWrite(RuntimeError):
    """Another write replaced the content this one started from."""


@dataclass(frozen=True)
class Pointer:
    """``parts``: partition (a path such as ``p_month=202401``, empty for a table without) → its runs.

    ``keys``: the same for the buckets of the table's key index. ``sources``: for a table that
    is derived from another, the partitions and runs of that one it was made from. ``distinct``:
    whether no two rows have the declared key in common.
    """

    number: int = 0
    parts: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    keys: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    sources: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    distinct: bool = False

    def folders(self) -> set[str]:
        """Every folder it names, below the table's."""
        data = {f"run={run}/{part}".rstrip("/") for part, runs in self.parts.items() for run in runs}
        return data | {f"_keys/run={run}/{bucket}" for bucket, runs in self.keys.items() for run in runs}


def file_system(spark: SparkSession, text: str):
    """Hadoop's file system of a path, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = file_system(spark, path)
    return files.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    files, folder = file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the files below a folder."""
    files, folder = file_system(spark, path)
    found = files.getContentSummary(folder)
    return found.getFileCount(), found.getLength()


def delete(spark: SparkSession, path: str) -> None:
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def _numbers(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(name[1:-5]) for name in children(spark, f"{table}/{FOLDER}") if name.endswith(".json") and name[0] == "v")


def _file(table: str, number: int) -> str:
    return f"{table}/{FOLDER}/v{number:010d}.json"


def _load(spark: SparkSession, table: str, number: int) -> Pointer:
    files, path = file_system(spark, _file(table, number))
    stream = files.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    named = ({k: tuple(v) for k, v in found[name].items()} for name in ("parts", "keys", "sources"))
    return Pointer(number, *named, found.get("distinct", False))


def current(spark: SparkSession, table: str) -> Pointer:
    """The newest pointer of a table folder; one without any has no partitions."""
    numbers = _numbers(spark, table)
    return _load(spark, table, numbers[-1]) if numbers else Pointer()


def next_run(before: Pointer) -> str:
    """A new run; later runs sort behind earlier ones."""
    return f"r{before.number + 1:010d}-{uuid.uuid4().hex[:8]}"


def commit(
    spark: SparkSession, table: str, before: Pointer, parts: Mapping[str, tuple[str, ...]],
    keys: Mapping[str, tuple[str, ...]], sources: Mapping[str, tuple[str, ...]] | None = None, distinct: bool = False,
) -> Pointer:
    """Make the pointer after ``before``, or raise :class:`ConcurrentWrite` if there is one already."""
    after = Pointer(before.number + 1, parts, keys, sources or {}, distinct)
    jvm = spark._jvm
    target = _file(table, after.number)
    files, temporary = file_system(spark, f"{table}/{FOLDER}/.v{after.number}-{uuid.uuid4().hex}")
    files.mkdirs(temporary.getParent())
    stream = files.create(temporary, True)
    try:
        stream.write(bytearray(json.dumps(
            {"parts": parts, "keys": keys, "sources": after.sources, "distinct": distinct}, sort_keys=True).encode()))
    finally:
        stream.close()
    # A rename that never replaces a file, unlike that of the file system's own interface.
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(temporary, jvm.org.apache.hadoop.fs.Path(target), options)
    except Exception as error:
        files.delete(temporary, False)
        if exists(spark, target):
            raise ConcurrentWrite(f"{table} was written by someone else since version {before.number}") from error
        raise
    _clean(spark, table, before, after)
    return after


def _clean(spark: SparkSession, table: str, before: Pointer, after: Pointer) -> None:
    """Delete what pointers before the last two named and these do not, then those pointers."""
    old = [number for number in _numbers(spark, table) if number <= after.number - KEPT_POINTERS]
    kept = before.folders() | after.folders()
    for number in old:
        for folder in _load(spark, table, number).folders() - kept:
            delete(spark, f"{table}/{folder}")
        delete(spark, _file(table, number))


def abandoned(spark: SparkSession, table: str, before_ms: int) -> list[str]:
    """Run folders that no kept pointer names and that were begun before a time, left by stopped writes.

    Deleting them is left to the operator of the tables, who knows how long a write may take.
    """
    named = {f for number in _numbers(spark, table) for f in _load(spark, table, number).folders()}
    found = []
    for base in ("", "_keys/"):
        for name in children(spark, f"{table}/{base}".rstrip("/")):
            folder = f"{base}{name}"
            if name.startswith("run=") and not any(f == folder or f.startswith(folder + "/") for f in named):
                files, path = file_system(spark, f"{table}/{folder}")
                if files.getFileStatus(path).getModificationTime() < before_ms:
                    found.append(f"{table}/{folder}")
    return found
