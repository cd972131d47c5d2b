"""Listing and moving files through Hadoop's file system, so that any storage Spark reads will do."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession

from lakeforge.partitions import Period, parse


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    n_bytes: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def entries(spark: SparkSession, path: str) -> list[Entry]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted((Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(p)), key=lambda e: e.name)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, s = _fs(spark, source)
    _, t = _fs(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"{source} could not be moved to {target}")


def partitions(found: list, column: str) -> list[tuple[Period, str]]:
    """Of listed entries the directories ``column=<period>`` of any granularity, by start; strays are skipped."""
    out = []
    for e in found:
        head, _, value = e.name.partition("=")
        if e.is_dir and head == column and (p := parse(value)):
            out.append((p, e.path))
    return sorted(out)


def list_partitions(spark: SparkSession, root: str, column: str) -> list[tuple[Period, str]]:
    return partitions(entries(spark, root), column)


def partition_containing(found: list[tuple[Period, str]], day: date) -> tuple[Period, str] | None:
    """The narrowest partition whose period holds the day."""
    held = [x for x in found if x[0].start <= day <= x[0].end]
    return min(held, key=lambda x: ((x[0].end - x[0].start).days, x[0])) if held else None


def loose_files(found: list) -> list[str]:
    """Files that lie under the root itself (of any period)."""
    return [e.path for e in found if not e.is_dir and e.name.endswith(".parquet")]


def leaf_files(spark: SparkSession, path: str) -> list[str]:
    """All data files below a path."""
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isFile():
        return [path]
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next().getPath()
        if f.getName().endswith(".parquet") and not f.getName().startswith(("_", ".")):
            out.append(f.toString())
    return sorted(out)


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getLen()


def _read(fs, p) -> str | None:
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file; where a writer was lost between taking the old text away and putting the new one, the new one."""
    fs, p = _fs(spark, path)
    text = _read(fs, p)
    return text if text is not None else _read(*_fs(spark, path + ".new"))


def _put(fs, p, text: str) -> None:
    stream = fs.create(p, True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A reader sees the old text or the new, also after a crash at any step: the text is written as ``.part``, complete as
    ``.new``, and then takes the place of the old one; ``read_text`` takes ``.new`` where the place is empty."""
    fs, p = _fs(spark, path)
    part, new = (_fs(spark, path + x)[1] for x in (".part", ".new"))
    if fs.exists(new):  # left by a lost writer
        if not fs.exists(p):
            fs.rename(new, p)
        else:
            fs.delete(new, False)
    _put(fs, part, text)
    if not fs.rename(part, new):
        raise OSError(f"{path} could not be written")
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(new, p):
        raise OSError(f"{path} could not be written")


def write_in_place(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    _put(fs, p, text)


def create_new(spark: SparkSession, path: str, text: str = "") -> bool:
    """Creates a file unless it is there; whether it was created."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    if not fs.createNewFile(p):
        return False
    if text:
        _put(fs, p, text)
    return True


def age_seconds(spark: SparkSession, path: str) -> float | None:
    import time

    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else None
