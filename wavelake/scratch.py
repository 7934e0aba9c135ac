"""Written copies of intermediate tables, with an owner and a release.

A copy cuts the lineage and lets several readers share one computation, as a
cache would, but it outlives a lost executor.  It lies below the shared
checkpoint folder (``session.scratch_path``) and takes disk until it is
released, so every copy has an owner and a count of uses:

* ``store(df, name)`` writes a copy and returns it; the innermost open
  ``scope`` owns it, else the session.
* A ``scope`` gives its uses back when its block ends.  What the block hands
  on must be written by then, or handed over to the scope around it with
  ``keep``.
* ``using(copy)`` counts one more reader for a block.

A copy without uses is deleted at once.  What the session owns goes when the
driver ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from .session import delete_path, scratch_path


class Copy:
    """A written table and how many readers still need it."""

    def __init__(self, spark: SparkSession, path: str, df: DataFrame):
        self.spark, self.path, self.df, self.uses = spark, path, df, 0

    @property
    def alive(self) -> bool:
        return self.uses >= 0

    def acquire(self) -> Copy:
        if not self.alive:
            raise RuntimeError(f"{self.path} was released")
        self.uses += 1
        return self

    def release(self) -> None:
        if self.uses > 0:
            self.uses -= 1
            if not self.uses:
                self.uses = -1
                delete_path(self.spark, self.path)


class Scope:
    """Owner of the copies made while it is the innermost one."""

    def __init__(self, spark: SparkSession, outer: Scope | None = None):
        self.spark, self.outer, self.copies = spark, outer, []

    def own(self, copy: Copy) -> Copy:
        self.copies.append(copy.acquire())
        return copy

    def keep(self, copy: Copy) -> Copy:
        """Hand a copy of this scope over to the one around it, or to the
        session: it outlives the block."""
        if copy not in self.copies:
            raise ValueError("not a copy of this scope")
        return self.outer.own(copy) if self.outer is not None else copy.acquire()

    def close(self) -> None:
        for copy in self.copies:
            copy.release()
        self.copies = []


_INNER: ContextVar[Scope | None] = ContextVar("wavelake_scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Copies written inside are released at the end, also after an error."""
    own = Scope(spark, _INNER.get())
    token = _INNER.set(own)
    try:
        yield own
    finally:
        _INNER.reset(token)
        own.close()


def write(df: DataFrame, name: str, form: str = "parquet", **options: str) -> Copy:
    """Write a copy; the innermost scope, or the session, has one use of it."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, name)
    df.write.format(form).options(**options).save(path)
    copy = Copy(spark, path, spark.read.format(form).options(**options).schema(schema).load(path))
    inner = _INNER.get()
    return inner.own(copy) if inner is not None else copy.acquire()


def store(df: DataFrame, name: str) -> DataFrame:
    """``write``, as a frame to read on."""
    return write(df, name).df


@contextmanager
def using(copy: Copy) -> Iterator[DataFrame]:
    """One more reader of a copy, for the length of a block."""
    copy.acquire()
    try:
        yield copy.df
    finally:
        copy.release()
