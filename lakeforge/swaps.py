"""Replacing directories of a dataset so that a crash at any point loses nothing.

New directories are written below ``_staged-<id>`` beside the old ones.  Then ``_swap-<id>.json`` names every move; once it
is there the swap is decided.  The moves follow (old aside, new in place), then the old ones and the file are deleted.  A
swap that was interrupted is finished by the next writer, and readers see its result before that: where a swap file is
found, a target whose new directory has not been moved yet is read from there.  Names with a leading underscore are
invisible to other scans.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from lakeforge.sources import files

STAGED, SWAP, OLD = "_staged-", "_swap-", "_old-"


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_dir: bool


def new_staging(root: str) -> str:
    return f"{root}/{STAGED}{uuid.uuid4().hex}"


def swap(spark: SparkSession, root: str, staged: str, names: list[str], drop: list[str] = []) -> None:
    """Puts ``<staged>/<name>`` in the place of ``<root>/<name>`` for every name and removes the entries of ``drop``."""
    id_ = staged.rpartition(STAGED)[2]
    files.write_text(spark, f"{root}/{SWAP}{id_}.json", json.dumps({"names": names, "drop": [d for d in drop if d not in names]}))
    _finish(spark, root, id_)


def _pending(spark: SparkSession, root: str) -> list[str]:
    return [e.name.removeprefix(SWAP).removesuffix(".json") for e in files.entries(spark, root) if e.name.startswith(SWAP) and e.name.endswith(".json")]


def _manifest(spark: SparkSession, root: str, id_: str) -> dict | None:
    text = files.read_text(spark, f"{root}/{SWAP}{id_}.json")
    return json.loads(text) if text else None


def _finish(spark: SparkSession, root: str, id_: str) -> None:
    m = _manifest(spark, root, id_)
    if m is None:
        return
    for name in m["names"]:
        new, target, old = f"{root}/{STAGED}{id_}/{name}", f"{root}/{name}", f"{root}/{OLD}{id_}/{name}"
        if files.exists(spark, new):
            if files.exists(spark, target):
                files.move(spark, target, old)
            files.move(spark, new, target)
    for name in m["drop"]:
        files.delete(spark, f"{root}/{name}")
    files.delete(spark, f"{root}/{OLD}{id_}")
    files.delete(spark, f"{root}/{SWAP}{id_}.json")
    files.delete(spark, f"{root}/{STAGED}{id_}")


def recover(spark: SparkSession, root: str) -> None:
    """Finishes decided swaps and clears what undecided ones staged.  For the holder of the lock."""
    for id_ in _pending(spark, root):
        _finish(spark, root, id_)
    for e in files.entries(spark, root):
        if e.is_dir and e.name.startswith(STAGED):
            files.delete(spark, e.path)


def entries(spark: SparkSession, root: str) -> list[Entry]:
    """What the dataset's directory holds, decided swaps counted as done."""
    found = {e.name: Entry(e.name, e.path, e.is_dir) for e in files.entries(spark, root)}
    for id_ in _pending(spark, root):
        m = _manifest(spark, root, id_)
        for name in m["names"] if m else ():
            new = f"{root}/{STAGED}{id_}/{name}"
            if files.exists(spark, new):
                found[name] = Entry(name, new, True)
            elif name not in found:  # moved since the listing
                found[name] = Entry(name, f"{root}/{name}", True)
        for name in m["drop"] if m else ():
            found.pop(name, None)
    return sorted((e for n, e in found.items() if not n.startswith(("_", "."))), key=lambda e: e.name)
