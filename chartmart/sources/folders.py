"""Moving, removing and locking folders of a warehouse, on any file system Spark writes to."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    """File system and path object."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _place(spark, path)
    return files.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder; none if it is not there."""
    files, at = _place(spark, path)
    found = files.listStatus(at) if files.exists(at) else []
    return [status.getPath().getName() for status in found if status.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    files, at = _place(spark, path)
    files.delete(at, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    files, at = _place(spark, old)
    _, to = _place(spark, new)
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"cannot move {old} to {new}")


def replace(spark: SparkSession, fresh: str, path: str, names: Iterable[str]) -> None:
    """Puts the folders ``names`` of ``fresh`` in place of those of ``path``.

    Only names are moved. If one cannot be, those moved before go back; the old folders are removed
    when all are in place.
    """
    old, done = f"{path}/_old/{uuid.uuid4().hex}", []
    try:
        for name in names:
            if exists(spark, f"{path}/{name}"):
                move(spark, f"{path}/{name}", f"{old}/{name}")
                done.append((f"{path}/{name}", f"{old}/{name}"))
            move(spark, f"{fresh}/{name}", f"{path}/{name}")
            done.append((f"{fresh}/{name}", f"{path}/{name}"))
    except Exception:
        for origin, now in reversed(done):
            move(spark, now, origin)
        raise
    remove(spark, f"{path}/_old")


@contextmanager
def exclusive(
    spark: SparkSession, path: str, owner: str, wait: float = 3600, pause: float = 1.0
) -> Iterator[None]:
    """One owner at a time: a lock file below ``path`` that file systems create atomically.

    An owner that broke off finds its own lock and goes on. Others wait, then stop with the owner's
    name, so that a lock whose owner will not come back can be removed.
    """
    files, at = _place(spark, f"{path}/_lock")
    until = time.monotonic() + wait
    while True:
        try:
            out = files.create(at, False)
            out.write(bytearray(owner.encode()))
            out.close()
            break
        except Exception:  # noqa: BLE001
            holder = _text(spark, f"{path}/_lock")
            if holder == owner:
                break
            if time.monotonic() > until:
                raise TimeoutError(f"{path}/_lock is held by {holder!r}") from None
            time.sleep(pause)
    try:
        yield
    finally:
        remove(spark, f"{path}/_lock")


def _text(spark: SparkSession, path: str) -> str | None:
    """What a small file says, null if it is gone meanwhile."""
    files, at = _place(spark, path)
    try:
        stream = files.open(at)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text
    except Exception:  # noqa: BLE001
        return None
