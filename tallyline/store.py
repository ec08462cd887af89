"""Paths in the store that Spark reads: exclusive claims, listing and removal, through Hadoop's file systems."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tallyline.contracts import ContractError


def _open(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist yet; whether this call was the one that created it.

    The file system decides between two callers. Hadoop's local one only looks before it creates, so a local
    path is created with the operating system's own exclusive flag. An object store must offer conditional
    writes for this to be exclusive; where it does not, one writer at a time has to be arranged for elsewhere."""
    system, at = _open(spark, path)
    system.mkdirs(at.getParent())
    if system.getScheme() == "file":
        try:
            Path(system.makeQualified(at).toUri().getPath()).open("x").close()
        except FileExistsError:
            return False
        return True
    try:
        system.create(at, False).close()
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() in ("FileAlreadyExistsException", "AlreadyBeingCreatedException"):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a whole folder; a path that does not exist is fine."""
    system, at = _open(spark, path)
    system.delete(at, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in order."""
    system, at = _open(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(at) or [])


def size(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of all files below ``paths``."""
    return sum(system.getContentSummary(at).getLength() for system, at in (_open(spark, p) for p in paths))


@contextmanager
def sole_successor(spark: SparkSession, path: str, unchanged: Callable[[], bool], what: str) -> Iterator[None]:
    """Optimistic concurrency: the block may add the one entry that follows the state a writer started from.

    The right to do so is claimed at ``path``, a name made from that state, after everything is written and checked;
    ``unchanged`` looks once more under the claim. Of two writers that started from one state the later raises. A
    block that fails gives the right back; a writer that dies inside it leaves its claim, which stops all
    later ones until the file is removed, once that writer is known to be gone."""
    if not claim(spark, path):
        raise ContractError(f"another {what} from the same state is done or being published; start again ({path})")
    try:
        if not unchanged():
            raise ContractError(f"another {what} was published meanwhile; start again")
        yield
    except BaseException:
        if unchanged():
            remove(spark, path)
        raise
