"""Intermediate results as tables in the shared folder: they cut a plan, survive lost executors, and are removed when done."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_lists: list[list[tuple[SparkSession, str]]] = []


class _Own(threading.local):
    """Each thread's results: what one query releases is never another's that runs beside it."""

    def __init__(self):
        self.held: list[tuple[SparkSession, str]] = []
        _lists.append(self.held)


_mine = _Own()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir. Where that is unset a folder of our own, on a single machine only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="labeldiff-")
    return _own[app]


def place(spark: SparkSession, tag: str, root: str | None = None) -> str:
    """A new path for an intermediate result; ``release`` removes it."""
    path = f"{root or shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _mine.held.append((spark, path))
    return path


def held(df: DataFrame, tag: str = "held", root: str | None = None) -> DataFrame:
    """df as written and read back."""
    path = place(df.sparkSession, tag, root)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many results this thread holds; for ``release``."""
    return len(_mine.held)


def release(since: int = 0, keep: int = 0) -> None:
    """Removes the results that this thread has held since ``since`` but for the last ``keep``. Nothing may read them afterwards."""
    removed(_mine.held, since, keep)


def removed(held_: list[tuple[SparkSession, str]], since: int = 0, keep: int = 0) -> None:
    for spark, path in held_[since : len(held_) - keep]:
        context = spark.sparkContext
        if context._jsc is None:
            continue
        p = context._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)
    del held_[since : len(held_) - keep]


@atexit.register
def _at_end() -> None:
    for own in _lists:
        try:
            removed(own)
        except Exception:  # the session may be gone, and its files with it
            own.clear()
