"""What the operators of this subpackage share: the shared folder, written tables, column picking."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is absent a temporary folder serves, in local mode alone: on a cluster
    a machine's own folder would lose rows, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="seine-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table written to the shared folder: cuts the lineage, outlives executors.

    Results are lazy, so such a table stays until ``drop`` or ``release``, or the end of a ``scope``.
    """
    path = scratch_dir(df.sparkSession, name)
    recorded(df.sparkSession).append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made, once what was made from them is written itself."""
    for t in tables:
        _remove(t.sparkSession, [t._scratch_path])


def recorded(spark: SparkSession) -> list[str]:
    """Paths in the shared folder that this program wrote and has not removed."""
    context = spark.sparkContext
    if not hasattr(context, "_seine_scratch"):
        context._seine_scratch = []
    return context._seine_scratch


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        delete(spark, path)
        with contextlib.suppress(ValueError):
            recorded(spark).remove(path)


def release(spark: SparkSession) -> None:
    """Removes all that was written and is left, once no result is needed any more."""
    _remove(spark, list(recorded(spark)))


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes the tables written inside when it ends, or when something fails, but those handed to what it gives."""
    before, kept = set(recorded(spark)), set()

    def keep(table: DataFrame) -> DataFrame:
        kept.add(table._scratch_path)
        return table

    try:
        yield keep
    except BaseException:
        kept.clear()
        raise
    finally:
        _remove(spark, [p for p in recorded(spark) if p not in before | kept])


def delete(spark: SparkSession, path: str) -> None:
    """Removes a path in the shared folder."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body's lambdas use it."""
    return F.transform(F.array(value), body)[0]


def task() -> int:
    """The number of the partition that runs."""
    context = TaskContext.get()
    return context.partitionId() if context else 0


def text_digest(text: Column) -> Column:
    """16 bytes that stand for a text in joins; a null text is an empty one."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)
