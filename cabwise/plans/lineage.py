"""Intermediates that survive executor loss, and their removal.

A reused intermediate is written once as Parquet into the shared folder named
by ``spark.checkpoint.dir``: a lost executor then costs a re-read, columns and
filters are pruned in the scan, and a random operator downstream
(``sampleBy``) sees the same rows on every recomputation.

Every path has one owner. Inside ``with intermediates() as own:`` it is that
object, and ``own.release()`` deletes its paths and no others, so that a result
can be given up while others that were built in the same session stay
readable. Outside of such a block the application owns the path;
:func:`release_staged` and the end of the process delete what is left of all.
"""

from __future__ import annotations

import atexit
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cabwise.session import staging_path


class Intermediates:
    """The paths that one result's tables were written to."""

    def __init__(self):
        self._paths: list[tuple[SparkSession, str]] = []

    def add(self, spark: SparkSession, path: str) -> None:
        self._paths.append((spark, path))

    def release(self) -> int:
        """Delete these paths; returns how many there were. Results that read them are void."""
        paths, self._paths = self._paths, []
        for spark, path in paths:
            if spark.sparkContext._jsc is None:  # a stopped context can't reach its file system
                continue
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        return len(paths)


_OWNER: ContextVar[Intermediates | None] = ContextVar("owner", default=None)
_OWNERS: dict[str, list[Intermediates]] = {}


def _of_application(spark: SparkSession) -> list[Intermediates]:
    """All owners of this application's paths; the first one is the application itself."""
    return _OWNERS.setdefault(spark.sparkContext.applicationId, [Intermediates()])


@contextmanager
def intermediates():
    """Tables written inside the block belong to the object it yields.

    A block within a block: the inner one's tables are its own."""
    own = Intermediates()
    token = _OWNER.set(own)
    try:
        yield own
    finally:
        _OWNER.reset(token)


def tracked_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that its owner removes."""
    path = staging_path(spark, name)
    owners, own = _of_application(spark), _OWNER.get()
    if own is not None and own not in owners:
        owners.append(own)
    (own or owners[0]).add(spark, path)
    return path


def staged(df: DataFrame, name: str, read_schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once and read it back (with another schema of equal layout, if given)."""
    path = tracked_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(read_schema or df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete every path of this application, whoever owns it; returns how many there were."""
    return sum(own.release() for own in _OWNERS.pop(spark.sparkContext.applicationId, []))


@atexit.register
def _release_all() -> None:
    for owners in list(_OWNERS.values()):
        for own in owners:
            own.release()
