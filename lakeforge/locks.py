"""One writer at a time: a lock file that its holder keeps fresh."""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from lakeforge.sources import files


class LockedError(RuntimeError):
    """Another writer holds the lake."""


@contextmanager
def writing(spark: SparkSession, path: str, stale_after: float = 600.0, beat: float = 60.0):
    """Holds the lock.

    The holder rewrites its token every ``beat`` seconds, so a lock whose file has not changed for ``stale_after`` seconds
    belongs to a process that is gone and is taken over.  A holder never deletes a lock that bears another's token."""
    token = uuid.uuid4().hex
    _take(spark, path, token, stale_after)
    stop = threading.Event()

    def keep_fresh() -> None:
        while not stop.wait(beat):
            if files.read_text(spark, path) == token:
                files.write_in_place(spark, path, token)

    thread = threading.Thread(target=keep_fresh, daemon=True)
    thread.start()
    try:
        yield
    finally:
        stop.set()
        thread.join()
        if files.read_text(spark, path) == token:
            files.delete(spark, path)


def _take(spark: SparkSession, path: str, token: str, stale_after: float) -> None:
    if files.create_new(spark, path, token):
        return
    seen, age = files.read_text(spark, path), files.age_seconds(spark, path)
    if age is not None and age < stale_after:
        raise LockedError(f"{path} is held since {age:.0f} s")
    # only one of several takers can move the stale file; one that moved a fresh lock instead puts it back
    aside = f"{path}.{token}"
    try:
        files.move(spark, path, aside)
    except OSError as e:
        raise LockedError(path) from e
    if files.read_text(spark, aside) != seen:
        files.move(spark, aside, path)
        raise LockedError(path)
    files.delete(spark, aside)
    if not files.create_new(spark, path, token):
        raise LockedError(path)
