"""Sessions, and the package on the workers."""

from __future__ import annotations

import contextlib
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    """A session for tests and benchmarks on this machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("seine")
    for k, v in (SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.ui.enabled": "false"} | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the workers, once a context, so that their functions can import it."""
    context = spark.sparkContext
    if getattr(context, "_seine_shipped", False):
        return
    top = Path(__file__).resolve().parent
    at = Path(tempfile.mkdtemp(prefix="seine-code-")) / "seine.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, Path("seine") / p.relative_to(top))
    context.addPyFile(str(at))
    context._seine_shipped = True


#: Bytes of an Arrow batch: a batch of whole texts is then as small as one of numbers, whatever their length.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the workers, small batches, and memory given back after each task.

    The size of batches is read when a plan runs, so it is set for the session, unless someone has set it.
    """
    ship_package(df.sparkSession)
    if BATCH_SETTING not in df.sparkSession.conf.getAll:
        df.sparkSession.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")

    def run(batches):
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system, which allocators of long-lived workers else keep."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where there is no such library
        ctypes.CDLL("libc.so.6").malloc_trim(0)
